"""Links near-equal vectors by cross-polytope hashing.

A vector is rotated by three rounds of random signs and a fast Hadamard transform; its hash
is the coordinate of largest size with its sign.  A table joins `k` such hashes into a bucket.
Every vector is filed in one bucket per table and also looks into those that swap one hash
for its second best.  Candidates are screened with half-precision copies inside the bucket, which
hands on a forest that joins them into clusters, never the pairs.  Inside a cluster all pairs
are verified in double precision on the whole vectors, block by block, and counted there.

The number of tables is computed so that a pair exactly at the threshold is met with
probability `recall`: the chance per table is measured on random pairs at that angle.  `k` follows
the number of vectors, so that buckets of unrelated vectors stay small at every size.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import components
from lenstrail.llm.suffix_dedup import mixed
from lenstrail.sources.tables import cut_lineage

COSINE = 0.9
RECALL = 0.9995
BLOCK = 1024
EXACT_BLOCK = 2048  # vectors of a cluster that one task compares with as many others
SCREEN = 0.01  # more than half precision and summation can lose
ROUNDING = 1e-12  # cosines nearer to the threshold are computed again, pair by pair

_U = np.uint64


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row; the width is a power of two."""
    rows, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(rows, width // (2 * step), 2, step)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), axis=2).reshape(rows, width)
        step *= 2
    return x


def _signs(table: int, part: int, width: int) -> np.ndarray:
    return np.random.default_rng([17, table, part]).choice(np.array([-1.0, 1.0], np.float32), (3, width))


def hashes(unit: np.ndarray, table: int, part: int) -> tuple[np.ndarray, np.ndarray]:
    """Best and second best signed coordinate of each row after rotation."""
    width = max(2, 1 << (unit.shape[1] - 1).bit_length())
    x = np.zeros((len(unit), width), np.float32)
    x[:, : unit.shape[1]] = unit
    for sign in _signs(table, part, width):
        x = hadamard(x * sign) / np.float32(math.sqrt(width))
    size = np.abs(x)
    two = np.argpartition(size, width - 2, axis=1)[:, -2:]
    at = np.arange(len(x))
    swap = size[at, two[:, 0]] > size[at, two[:, 1]]
    first, second = np.where(swap, two[:, 0], two[:, 1]), np.where(swap, two[:, 1], two[:, 0])
    return first * 2 + (x[at, first] < 0), second * 2 + (x[at, second] < 0)


def probes(unit: np.ndarray, table: int, k: int) -> np.ndarray:
    """Bucket keys (rows, 1 + k): the own bucket, then one with each hash swapped."""
    best, other = zip(*(hashes(unit, table, part) for part in range(k)), strict=True)
    out = np.empty((len(unit), 1 + k), np.uint64)
    for swapped in range(-1, k):
        key = np.full(len(unit), _U((table << 16) ^ unit.shape[1]))
        for part in range(k):
            h = other[part] if part == swapped else best[part]
            key = mixed(key * _U(0x9E3779B97F4A7C15) + h.astype(np.uint64) + _U(1))
        out[:, swapped + 1] = key
    return out


def chance(width: int, k: int, cosine: float, pairs: int = 1500, tables: int = 3) -> float:
    """Share of random pairs at that cosine of which one looks into the other's bucket."""
    rng = np.random.default_rng(23)
    a = rng.standard_normal((pairs, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((pairs, width))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.maximum(np.linalg.norm(b, axis=1, keepdims=True), 1e-12)
    b = cosine * a + math.sqrt(1 - cosine**2) * b
    met = 0.0
    for table in range(tables):
        x, y = probes(a, table, k), probes(b, table, k)
        met += ((x == y[:, :1]).any(axis=1) | (y == x[:, :1]).any(axis=1)).mean()
    return met / tables


def plan(n: int, width: int, cosine: float, recall: float) -> tuple[int, int]:
    """Hashes per bucket and number of tables for n vectors."""
    k = max(1, round(math.log(max(n, 2) / 4) / math.log(max(2 * width, 4))))
    p = min(max(chance(width, k, cosine), 0.01), 0.999)
    return k, max(2, math.ceil(math.log(1 - recall) / math.log(1 - p)))


def _matrix(column) -> list[np.ndarray | None]:
    """Rows as float64 vectors; None where NULL, zero or with a component that is no number."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = array.values.to_numpy(zero_copy_only=False).astype(np.float64)  # NULL components become NaN
    offsets, valid = array.offsets.to_numpy(), array.is_valid().to_numpy(zero_copy_only=False)
    out: list[np.ndarray | None] = []
    for a, b, ok in zip(offsets[:-1].tolist(), offsets[1:].tolist(), valid.tolist(), strict=True):
        v = flat[a:b]
        out.append(v if ok and b > a and np.isfinite(v).all() and v.any() else None)
    return out


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max()
    return v / math.sqrt(v @ v)


def cosine_of(a: np.ndarray, b: np.ndarray) -> float:
    return float(_unit(a) @ _unit(b))


def forest(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Least index that each of 0..n-1 reaches by the links (x, y)."""
    low = np.arange(n)
    while len(x):
        a, b = low[x], low[y]
        least = np.minimum(a, b)
        np.minimum.at(low, a, least)
        np.minimum.at(low, b, least)
        while (low != low[low]).any():
            low = low[low]
        apart = low[x] != low[y]
        x, y = x[apart], y[apart]
    return low


def _linked(unit: np.ndarray, other: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of two arrays of unit vectors reach the cosine, whatever the block they are in."""
    value = unit @ other.T
    hit = value >= cosine
    for r, c in np.argwhere(np.abs(value - cosine) < ROUNDING).tolist():
        hit[r, c] = math.fsum(unit[r] * other[c]) >= cosine
    return hit


def _compared(members: DataFrame, cosine: float) -> DataFrame:
    """All pairs inside each cluster of (node, cluster, copies, embedding), compared in blocks.

    Rows are (node, links): vectors linked with it, to be summed, and (a, b): links that join
    nodes, a forest per task.  Rows grow with the number of blocks, not with pairs.
    """
    parts = members.groupBy("cluster").agg(F.ceil(F.count("*") / EXACT_BLOCK).cast("int").alias("parts"))
    placed = members.join(parts, "cluster").withColumn("part", F.pmod(F.xxhash64(F.lit(2), "node"), F.col("parts")).cast("int"))
    tasks = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "node",
        "cluster",
        "copies",
        "embedding",
        F.least("part", "other").alias("p"),
        F.greatest("part", "other").alias("q"),
        (F.col("part") > F.col("other")).alias("second"),
    )

    def count(table: pa.Table) -> pa.Table:
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        unit = np.array([_unit(v) for v in _matrix(table.column("embedding"))])
        second = np.array(table.column("second").to_pylist(), bool)
        same = table.column("p")[0].as_py() == table.column("q")[0].as_py()
        every = np.arange(len(node))
        left, right = (every, every) if same else (np.flatnonzero(~second), np.flatnonzero(second))
        hit = _linked(unit[left], unit[right], cosine)
        if same:
            np.fill_diagonal(hit, False)
        links = np.zeros(len(node), np.int64)
        links[left] = hit @ copies[right]
        if not same:
            links[right] = hit.T @ copies[left]
        r, c = np.nonzero(hit)
        low = forest(len(node), left[r], right[c])
        ends = np.flatnonzero(low != every)
        none, some = [None] * len(ends), [None] * len(node)
        return pa.Table.from_pydict(
            {
                "node": pa.array([*node.tolist(), *none], pa.int64()),
                "links": pa.array([*links.tolist(), *none], pa.int64()),
                "a": pa.array([*some, *node[low[ends]].tolist()], pa.int64()),
                "b": pa.array([*some, *node[ends].tolist()], pa.int64()),
            }
        )

    return tasks.groupBy("cluster", "p", "q").applyInArrow(count, "node long, links long, a long, b long")


def near_vectors(vectors: DataFrame, *, cosine: float = COSINE, recall: float = RECALL) -> DataFrame:
    """Row per vector (vec_id, embedding): vec_id, n_links, component_id, kept.

    NULL, empty or zero vectors and those with NULL or non-finite components link with
    nothing; vectors of different lengths do not link.  Equal vectors are one node and
    are never paired with each other; each still counts as a link.  Rows with equal vec_id count
    each; a NULL vec_id is never the smallest unless all are.  Other columns are ignored; no
    rows give no rows.
    """
    id_type = dict(vectors.dtypes)["vec_id"]
    rows = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))

    def screen(batches):
        for batch in batches:
            good = [v is not None for v in _matrix(batch.column("embedding"))]
            yield batch.append_column("good", pa.array(good, pa.bool_()))

    node = F.when(F.col("good"), F.shiftrightunsigned(F.xxhash64("embedding"), 1))
    rows = rows.mapInArrow(screen, f"vec_id {id_type}, embedding array<double>, good boolean").withColumn("node", node)
    rows = cut_lineage(rows)
    nodes = (
        rows.where("node IS NOT NULL")
        .groupBy("node")
        .agg(F.min("vec_id").alias("first_id"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    )
    nodes = cut_lineage(nodes)
    widths = [tuple(r) for r in nodes.groupBy(F.size("embedding").alias("w")).count().orderBy(F.desc("count")).limit(64).collect()]
    n_all = nodes.count()
    plans = {w: plan(n, w, cosine, recall) for w, n in widths}  # rarer widths use the plan of all

    def file(batches):
        for batch in batches:
            found = [_unit(v) for v in _matrix(batch.column("embedding"))]
            ids = batch.column("node").to_numpy()
            by_width: dict[int, list[int]] = {}
            for i, v in enumerate(found):
                by_width.setdefault(len(v), []).append(i)
            for width, at in by_width.items():
                k, tables = plans.get(width) or plan(n_all, width, cosine, recall)
                unit = np.array([found[i] for i in at])
                code = [u.tobytes() for u in unit.astype(np.float16)]
                own = ids[at]
                for table in range(tables):
                    keys = probes(unit, table, k).astype(np.int64)
                    for p in range(k + 1):
                        yield pa.RecordBatch.from_pydict(
                            {
                                "bucket": pa.array(keys[:, p]),
                                "node": pa.array(own, pa.int64()),
                                "filed": pa.array([p == 0] * len(at), pa.bool_()),
                                "code": pa.array(code, pa.binary()),
                            }
                        )

    filed = nodes.select("node", "embedding").mapInArrow(file, "bucket long, node long, filed boolean, code binary")
    size = filed.groupBy("bucket").agg(F.sum(F.col("filed").cast("long")).alias("n_filed"), F.count("*").alias("n"))
    large = (
        size.where((F.col("n") > BLOCK) & (F.col("n_filed") > 0))
        .select("bucket", F.ceil(F.col("n_filed") / BLOCK).cast("int").alias("across"), F.ceil(F.col("n") / BLOCK).cast("int").alias("down"))
    )
    # A crowded bucket is cut in blocks: filed vectors by `i`, those that look by `j`.
    placed = filed.join(large, "bucket", "left").withColumns({"across": F.coalesce("across", F.lit(1)), "down": F.coalesce("down", F.lit(1))})
    spot = F.pmod(F.xxhash64("node"), F.col("across")).cast("int"), F.pmod(F.xxhash64(F.lit(1), "node"), F.col("down")).cast("int")
    columns = ("bucket", "i", "j", "node", "code")
    # In buckets of one block a filed vector is one row that both lies and looks.
    single = (F.col("across") == 1) & (F.col("down") == 1)
    one = placed.where(single).select("bucket", F.lit(0).alias("i"), F.lit(0).alias("j"), "node", "code", F.col("filed").alias("lies"))
    many_looks = placed.where(~single).withColumn("j", spot[1]).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("across") - 1))).select(*columns, F.lit(False).alias("lies"))
    many_lies = placed.where(~single & F.col("filed")).withColumn("i", spot[0]).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("down") - 1))).select(*columns, F.lit(True).alias("lies"))
    tasks = one.union(many_looks).union(many_lies)

    def pair(table: pa.Table) -> pa.Table:
        """Candidates of a bucket as a forest: each node with the first one it reaches."""
        node, place = np.unique(table.column("node").to_numpy(), return_inverse=True)
        low = every = np.arange(len(node))
        lies = np.array(table.column("lies").to_pylist(), bool)
        if lies.any() and len(node) > 1:
            raw = table.column("code").to_pylist()
            unit = np.frombuffer(b"".join(raw), np.float16).reshape(len(raw), -1).astype(np.float32)
            r, c = np.nonzero(unit @ unit[lies].T >= cosine - SCREEN)
            low = forest(len(node), place[r], place[lies][c])
        ends = np.flatnonzero(low != every)
        return pa.Table.from_pydict({"a": pa.array(node[low[ends]], pa.int64()), "b": pa.array(node[ends], pa.int64())})

    candidates = cut_lineage(tasks.groupBy("bucket", "i", "j").applyInArrow(pair, "a long, b long").distinct())
    clusters = components(candidates).select(F.col("id").alias("node"), F.col("component").alias("cluster"))
    members = nodes.join(clusters, "node").select("node", "cluster", "copies", "embedding")
    compared = cut_lineage(_compared(members, cosine))
    groups = components(compared.where("a IS NOT NULL").select("a", "b")).withColumnRenamed("id", "node")
    known = nodes.select("node", "first_id", "copies")
    linked = compared.where("a IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    known = known.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    name = known.groupBy("component").agg(F.min("first_id").alias("component_id"))
    known = known.join(linked, "node", "left").join(name, "component")
    out = rows.select("vec_id", "node").join(
        known.select("node", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n")), "node", "left"
    )
    alone = F.col("node").isNull()
    component = F.when(alone, F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.when(alone, F.lit(0)).otherwise(F.col("n")).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )


ORACLE = f"""
WITH RECURSIVE good AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x != 0)) > 0),
links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
    ON x.vec_id != y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= {COSINE}),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, e.vec_id = component_id AS kept
FROM embeddings e JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
"""
