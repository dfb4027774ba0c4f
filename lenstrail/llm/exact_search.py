"""Exact top-k inner products by distributed histogram selection.

Every query is scored against every vector; scores are never stored.  A pass counts all scores
of each query in equal bins over the range that still can hold its kth value; the counts of all tasks
are added, and the bin that the kth score lies in becomes the next, narrower range.  When a bin is
one score wide, its score is the kth value exactly.  A last pass keeps the rows above it and, of
those that equal it, as many of the smallest ids as are missing.

Queries are dealt in groups and vectors in slots, both bounded in rows; a task holds one group and
one slot.  A task hands on the bins from the top down to the one that holds its own kth score: lower
ones cannot hold the global one.  So at most k rows a query and slot are shuffled in a pass.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.llm.vector_codes import LARGEST, usable, whole
from lenstrail.sources.tables import cut_lineage

SCALE = 256
EVERY = 50
K = 5
BINS = 1024
SLOT = 65_536  # vectors a task holds
GROUP = 16_384  # queries a task holds
LEAST_SLOTS = 24
ROWS = 16  # queries scored at a time


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Vectors of one length as a matrix of whole numbers."""
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.astype(np.int64).reshape(len(column), -1)


def _scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Exact inner products.  Doubles hold them where no sum can pass 2**53."""
    def size(x: np.ndarray) -> int:
        return int(np.abs(x).max()) if x.size else 0

    if size(queries) * size(vectors) * max(1, queries.shape[1]) < 1 << 53:
        return (queries.astype(np.float64) @ vectors.T.astype(np.float64)).astype(np.int64)
    return queries @ vectors.T


class _Task:
    """Queries of one group and vectors of one slot, of one length."""

    def __init__(self, table: pa.Table):
        asks = np.array(table.column("asks").to_pylist(), bool)
        numbers = _numbers(table.column("components"))
        self.uid = table.column("uid").to_numpy()
        self.queries, self.vectors = np.flatnonzero(asks), np.flatnonzero(~asks)
        self.q, self.v = numbers[self.queries], numbers[self.vectors]
        self.copies = table.column("copies").to_numpy()[self.vectors]
        place = {u: i for i, u in enumerate(self.uid[self.vectors].tolist())}
        self.own = np.array([place.get(u, -1) for u in self.uid[self.queries].tolist()], np.int64)

    def blocks(self):
        """(positions of queries, their scores, copies that count for each query and vector)."""
        for low in range(0, len(self.queries), ROWS):
            at = np.arange(low, min(low + ROWS, len(self.queries)))
            copies = np.broadcast_to(self.copies, (len(at), len(self.copies)))
            own = self.own[at]
            if (own >= 0).any():
                copies = copies.copy()
                copies[np.flatnonzero(own >= 0), own[own >= 0]] -= 1
            yield at, _scores(self.q[at], self.v), copies


def _histograms(k: int, bins: int):
    """Counts per query and bin of the range; bin `bins` is all above it."""

    def run(table: pa.Table) -> pa.Table:
        task = _Task(table)
        low = table.column("low").to_numpy()[task.queries]
        step = table.column("step").to_numpy()[task.queries]
        uid = task.uid[task.queries]
        out_uid, out_bin, out_n = [], [], []
        for at, scores, copies in task.blocks():
            bin_ = np.minimum((scores - low[at, None]) // step[at, None], bins)
            inside = bin_ >= 0
            row = np.broadcast_to(np.arange(len(at))[:, None], scores.shape)
            key = row[inside] * (bins + 1) + bin_[inside]
            count = np.bincount(key, weights=copies[inside], minlength=len(at) * (bins + 1))
            count = count.astype(np.int64).reshape(len(at), bins + 1)
            before = np.cumsum(count[:, ::-1], axis=1)[:, ::-1] - count
            r, b = np.nonzero((count > 0) & (before < k))
            out_uid.append(uid[at[r]])
            out_bin.append(b)
            out_n.append(count[r, b])
        none = [np.empty(0, np.int64)]
        return pa.table(
            {
                "uid": pa.array(np.concatenate(out_uid or none), pa.int64()),
                "bin": pa.array(np.concatenate(out_bin or none), pa.int32()),
                "n": pa.array(np.concatenate(out_n or none), pa.int64()),
            }
        )

    return run


def _winners(k: int):
    """Rows above the kth score of a query, and the least ids among those that equal it."""

    def run(table: pa.Table) -> pa.Table:
        task = _Task(table)
        least = table.column("low").to_numpy()[task.queries]
        uid = task.uid[task.queries]
        ids = table.column("vec_id").to_pylist()
        ids = [ids[i] for i in task.vectors.tolist()]
        order = np.empty(len(ids), np.int64)
        order[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))] = np.arange(len(ids))
        found: dict[str, list] = {"uid": [], "vec_id": [], "score": [], "copies": []}

        def hand_on(query: int, which: np.ndarray, scores: np.ndarray, copies: np.ndarray) -> None:
            which = which[np.lexsort((order[which], -scores[which]))][:k]  # later ones cannot be among the first k
            found["uid"] += [uid[query]] * len(which)
            found["vec_id"] += [ids[i] for i in which]
            found["score"] += scores[which].tolist()
            found["copies"] += copies[which].tolist()

        for at, scores, copies in task.blocks():
            hits = (scores >= least[at, None]) & (copies > 0)
            for r in np.flatnonzero(hits.any(axis=1)).tolist():
                hand_on(int(at[r]), np.flatnonzero(hits[r]), scores[r], copies[r])
        return pa.table(
            {
                "uid": pa.array(found["uid"], pa.int64()),
                "vec_id": pa.array(found["vec_id"], pa.int64()),
                "score": pa.array(found["score"], pa.int64()),
                "copies": pa.array(found["copies"], pa.int64()),
            }
        )

    return run


def top_k(
    vectors: DataFrame,
    *,
    k: int = K,
    every: int = EVERY,
    scale: int = SCALE,
    bins: int = BINS,
    slot: int = SLOT,
    group: int = GROUP,
) -> DataFrame:
    """The k best vectors of each query: query_id, rank, vec_id, score.

    Queries are the rows whose vec_id is divisible by `every`; each is compared with all rows but
    itself, by the inner product of floor(scale * x).  Ties go to the smaller vec_id, NULL last.  A
    NULL vec_id is no query.  Vectors that are NULL or hold NULL or non-finite components take no
    part.  Equal rows count each, also as partners of each other; an id with several different
    vectors asks once with each.  A vector meets those of its own length only.  Fewer than k
    partners give fewer rows.  Other columns are ignored; no rows give no rows.  Components too
    large for exact sums stop the job with an error.
    """
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole_rows = rows.where(usable()).select("vec_id", whole(scale).alias("components"))
    units = whole_rows.groupBy("vec_id", "components").agg(F.count("*").alias("copies"))
    units = cut_lineage(units.withColumn("uid", F.monotonically_increasing_id()))  # stored: a rerun of a task keeps its ids
    norm = F.aggregate("components", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    asks = F.coalesce(F.col("vec_id") % every == 0, F.lit(False))
    largest = F.max(F.coalesce(F.array_max(F.transform("components", F.abs)), F.lit(0)))
    facts = units.agg(
        F.count("*").alias("n"), F.count_if(asks).alias("queries"), largest.alias("largest"), F.max(norm).alias("norm")
    ).first()
    if (facts.largest or 0) > LARGEST:
        raise ValueError(f"a scaled component of {facts.largest} is beyond {LARGEST}: sums would not fit a long")
    bound = math.ceil(math.sqrt(facts.norm or 0) * (1 + 1e-9)) + 1  # of a length; no inner product is beyond its square
    low, step = -bound * bound, -(-(2 * bound * bound + 1) // bins)
    slots, groups = max(LEAST_SLOTS, -(-facts.n // slot)), max(1, -(-facts.queries // group))

    units = units.withColumn("width", F.size("components"))
    held = units.select(
        "width",
        F.pmod(F.xxhash64("uid"), F.lit(slots)).cast("int").alias("slot"),
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group"),
        "uid", "vec_id", "components", "copies",
        F.lit(False).alias("asks"), F.lit(0).cast("long").alias("low"), F.lit(1).cast("long").alias("step"),
    )
    queries = units.where(asks).select("width", "uid", "vec_id", "components", "copies")
    marks = queries.select("uid").withColumns({"low": F.lit(low).cast("long"), "step": F.lit(step).cast("long")})

    def tasks(marks: DataFrame) -> DataFrame:
        """Both sides of all (group, slot) pairs."""
        dealt = queries.join(marks, "uid").select(
            "width",
            F.explode(F.sequence(F.lit(0), F.lit(slots - 1))).alias("slot"),
            F.pmod(F.xxhash64(F.lit(1), "uid"), F.lit(groups)).cast("int").alias("group"),
            "uid", "vec_id", "components", "copies", F.lit(True).alias("asks"), "low", "step",
        )
        return held.union(dealt).groupBy("width", "group", "slot")

    down = Window.partitionBy("uid").orderBy(F.desc("bin"))
    while step:
        counts = tasks(marks).applyInArrow(_histograms(k, bins), "uid long, bin int, n long")
        counts = counts.groupBy("uid", "bin").agg(F.sum("n").alias("n")).withColumn("so_far", F.sum("n").over(down))
        kth = counts.where(F.col("so_far") >= k).groupBy("uid").agg(F.max("bin").alias("bin"))
        # With fewer than k partners no bin reaches k: the range stays at its lower end, and all are taken.
        finer = -(-step // bins) if step > 1 else 0
        moved = F.col("low") + F.coalesce(F.col("bin").cast("long"), F.lit(0)) * F.lit(step).cast("long")
        marks = cut_lineage(
            marks.join(kth, "uid", "left").select("uid", moved.alias("low"), F.lit(max(finer, 1)).cast("long").alias("step"))
        )
        step = finer
    found = tasks(marks).applyInArrow(_winners(k), "uid long, vec_id long, score long, copies long")
    # Each candidate as often as it is there, but never more than k times.
    found = found.withColumn("copy", F.explode(F.sequence(F.lit(1), F.least("copies", F.lit(k)).cast("int"))))
    best = Window.partitionBy("uid").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "copy")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    asked = queries.select("uid", F.col("vec_id").alias("query_id"), F.col("copies").alias("times"))
    return (
        ranked.join(asked, "uid")
        .withColumn("time", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
        .select("query_id", "rank", "vec_id", "score")
    )


ORACLE = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS e, row_number() OVER () AS rid
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.rid, q.vec_id AS query_id, c.vec_id, CASE WHEN len(q.e) = 0 THEN 0 ELSE list_dot_product(q.e, c.e)::BIGINT END AS score
  FROM kept q JOIN kept c ON q.rid != c.rid AND len(q.e) = len(c.e) WHERE q.vec_id % {EVERY} = 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= {K}
"""
