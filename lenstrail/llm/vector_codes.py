"""Compresses vectors to codes of one codebook entry per part, trained by active-entry Lloyd rounds.

Components become whole numbers, so that sums, means and distances are exact and a run can be
repeated bit by bit whatever the partitioning.  A vector is cut into equal parts; each part position
has a codebook, which starts with the parts of the vectors of smallest id.

A round assigns every part to its nearest entry and moves each entry to the floor of its parts'
mean.  State is kept per vector: the assigned entries and the exact distances to them.  Where the
assigned entry did not move, no entry at rest can have come nearer, so only the moved entries are
compared with the stored distance; other parts scan the whole codebook.  Ties go to the lower index
in both.

Rounds are narrow: state is a map over the state before, held by the executors, and recomputed from
the scan if an executor is lost.  Only sums and counts per entry (parts x entries x components of a
part) leave the tasks; their number does not depend on the input.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.sources.tables import cut_lineage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 26  # scaled components up to this size have squared distances that fit a long


def usable(embedding: str = "embedding") -> Column:
    """Whether the vector is there and each component is a finite number."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(embedding).isNotNull() & ~bad


def whole(scale: int, embedding: str = "embedding") -> Column:
    """Components as floor(scale * x)."""
    return F.transform(embedding, lambda x: F.floor(x * F.lit(float(scale))))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column whose lists all have `width` numbers."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    return ((points[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)


def assign(
    points: np.ndarray, entries: np.ndarray, moved: np.ndarray, code: np.ndarray | None, distance: np.ndarray | None
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and exact squared distance of each point, from those before the entries in `moved` moved."""
    if code is None:
        scan = np.arange(len(points))
        code, distance = np.empty(len(points), np.int64), np.empty(len(points), np.int64)
    else:
        code, distance = code.copy(), distance.copy()
        stayed = ~moved[code]
        scan, rest = np.flatnonzero(~stayed), np.flatnonzero(stayed)
        active = np.flatnonzero(moved)
        if len(rest) and len(active):
            to_active = distances(points[rest], entries[active])
            best = to_active.argmin(axis=1)
            near, index = to_active[np.arange(len(rest)), best], active[best]
            better = (near < distance[rest]) | ((near == distance[rest]) & (index < code[rest]))
            code[rest[better]], distance[rest[better]] = index[better], near[better]
    if len(scan):
        to_all = distances(points[scan], entries)
        code[scan] = to_all.argmin(axis=1)
        distance[scan] = to_all.min(axis=1)
    return code, distance


class Codebooks:
    """Entries (parts, entries, components) and which of them the last round moved."""

    def __init__(self, entries: np.ndarray, moved: np.ndarray | None = None):
        self.entries = entries
        self.moved = np.ones(entries.shape[:2], bool) if moved is None else moved

    def updated(self, sums: dict[tuple[int, int, int], tuple[int, int]]) -> Codebooks:
        """Each entry at the floor of the mean of its parts; an entry without parts stays."""
        entries = self.entries.copy()
        for (part, entry, place), (total, count) in sums.items():
            entries[part, entry, place] = total // count
        return Codebooks(entries, (entries != self.entries).any(axis=2))

    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()


def _assigned(state: DataFrame, books: Codebooks) -> DataFrame:
    entries, moved = books.entries, books.moved
    parts, _, size = entries.shape
    first = "code" not in state.columns

    def run(batches):
        for batch in batches:
            points = matrix(batch.column("components"), parts * size).reshape(len(batch), parts, size)
            n = len(points)
            code, distance = np.empty((n, parts), np.int64), np.empty((n, parts), np.int64)
            if not first:
                old_code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(n, parts)
                old_distance = matrix(batch.column("distance"), parts)
            for low in range(0, n, 2048):
                at = slice(low, low + 2048)
                for p in range(parts):
                    before = (None, None) if first else (old_code[at, p].astype(np.int64), old_distance[at, p])
                    code[at, p], distance[at, p] = assign(points[at, p], entries[p], moved[p], *before)
            raw = code.astype(np.uint8)
            offsets = pa.array(np.arange(0, (n + 1) * parts, parts, dtype=np.int32))
            kept = {c: batch.column(c) for c in ("vec_id", "label", "components")}
            kept["code"] = pa.array([row.tobytes() for row in raw], pa.binary())
            kept["distance"] = pa.ListArray.from_arrays(offsets, pa.array(distance.ravel()))
            yield pa.RecordBatch.from_pydict(kept)

    types = dict(state.dtypes)
    schema = f"vec_id {types['vec_id']}, label {types['label']}, components array<int>, code binary, distance array<bigint>"
    return state.mapInArrow(run, schema)


def _sums(state: DataFrame, books: Codebooks) -> dict[tuple[int, int, int], tuple[int, int]]:
    """Sum and count of the parts of each entry, by component.  Added up in each task first."""
    parts, k, size = books.entries.shape

    def run(batches):
        total, count = np.zeros((parts, k, size), np.int64), np.zeros((parts, k), np.int64)
        for batch in batches:
            points = matrix(batch.column("components"), parts * size).reshape(len(batch), parts, size)
            code = np.frombuffer(b"".join(batch.column("code").to_pylist()), np.uint8).reshape(len(batch), parts)
            for p in range(parts):
                np.add.at(total[p], code[:, p], points[:, p])
                count[p] += np.bincount(code[:, p], minlength=k)
        p, e, i = (x.ravel() for x in np.indices(total.shape))
        used = count[p, e] > 0
        yield pa.RecordBatch.from_pydict(
            {
                "part": pa.array(p[used], pa.int32()),
                "entry": pa.array(e[used], pa.int32()),
                "place": pa.array(i[used], pa.int32()),
                "total": pa.array(total.ravel()[used]),
                "n": pa.array(count[p, e][used]),
            }
        )

    per_task = state.mapInArrow(run, "part int, entry int, place int, total long, n long")
    rows = per_task.groupBy("part", "entry", "place").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n")
    )
    return {(r.part, r.entry, r.place): (int(r.total), r.n) for r in rows.collect()}  # parts x components of a part x entries


def _start(kept: DataFrame, parts: int, entries: int) -> Codebooks | None:
    """Codebooks of the first vectors; None without any.  Stops at vectors that do not fit together."""
    widest = F.max(F.coalesce(F.array_max(F.transform("components", F.abs)), F.lit(0)))
    facts = kept.agg(F.min(F.size("components")).alias("least"), F.max(F.size("components")).alias("most"), widest.alias("largest")).first()
    if facts.least is None:
        return None
    if facts.least != facts.most or facts.most % parts:
        raise ValueError(f"vectors have {facts.least} to {facts.most} components; all must have one number of them, a multiple of {parts}")
    if facts.largest > LARGEST:
        raise ValueError(f"a scaled component of {facts.largest} is beyond {LARGEST}: squared distances would not fit a long")
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "components").limit(entries).collect()
    rows = np.array([r.components for r in first], np.int64).reshape(len(first), parts, -1)
    return Codebooks(rows.transpose(1, 0, 2).copy())


def compress(
    vectors: DataFrame, *, scale: int = SCALE, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks | None]:
    """Row per usable vector (vec_id, label, code binary, distance array<bigint>), and the codebooks.

    Vectors that are NULL or hold NULL or non-finite components are dropped.  Equal ids are rows of
    their own; the codebooks start with the smallest ids, NULL ids last, rows of one id by their
    components.  With fewer vectors than entries the codebooks are as short.  Vectors without any
    component get entry 0 at distance 0.  Other columns are ignored.  Without vectors there are no
    rows and no codebooks.  Vectors of different lengths, lengths that the parts do not divide, and
    components too large for exact distances stop the job with an error.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte per part: 1 to 256 entries")
    rows = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(usable())
    kept = rows.select("vec_id", "label", whole(scale).alias("components"))
    books = _start(kept, parts, entries)
    state = kept.withColumn("components", F.col("components").cast("array<int>"))
    if books is None:
        empty = state.select("vec_id", "label", F.lit(b"").alias("code"), F.array().cast("array<bigint>").alias("distance"))
        return empty.limit(0), None
    held = None
    for _ in range(rounds):
        state = _assigned(state, books).persist(StorageLevel.MEMORY_AND_DISK)
        books = books.updated(_sums(state, books))
        if held is not None:
            held.unpersist()
        held = state
    coded = cut_lineage(_assigned(state, books).drop("components"))
    if held is not None:
        held.unpersist()
    return coded, books


def vector_codes(vectors: DataFrame, **options) -> DataFrame:
    """Row per usable vector: vec_id, code (two hex digits a part), error, label_error, codebooks_sha256.

    `label_error` sums the error over vectors of the same label, NULL labels together.
    """
    coded, books = compress(vectors, **options)
    shown = coded.select(
        "vec_id",
        "label",
        F.lower(F.hex("code")).alias("code"),
        F.aggregate("distance", F.lit(0).cast("long"), lambda a, b: a + b).alias("error"),
    )
    totals = shown.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return shown.join(totals, F.col("label").eqNullSafe(F.col("of")), "left").select(
        "vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256")
    )


def _oracle() -> str:
    steps = []
    for r in range(ROUNDS + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT rid, p, min((d, k)) AS best FROM (
    SELECT x.rid, x.p, b.k, sum((x.c - b.c) * (x.c - b.c))::BIGINT AS d
    FROM points x JOIN b{r} b ON x.p = b.p AND x.i = b.i GROUP BY ALL) GROUP BY ALL)""")
        if r < ROUNDS:
            steps.append(f"""
m{r} AS (
  SELECT a.p, a.best[2] AS k, x.i, sum(x.c)::BIGINT AS s, count(*) AS n
  FROM a{r} a JOIN points x ON a.rid = x.rid AND a.p = x.p GROUP BY ALL),
b{r + 1} AS MATERIALIZED (
  SELECT b.p, b.k, b.i, CASE WHEN m.n IS NULL THEN b.c ELSE (s - ((s % n) + n) % n) // n END AS c
  FROM b{r} b LEFT JOIN m{r} m ON b.p = m.p AND b.k = m.k AND b.i = m.i)""")
    chain = ",".join(steps)
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS e,
         row_number() OVER (ORDER BY vec_id NULLS LAST, e) AS rid
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
flat AS (SELECT rid, unnest(e) AS c, unnest(range(len(e))) AS pos, len(e) // {PARTS} AS w FROM kept),
points AS MATERIALIZED (SELECT rid, pos // w AS p, pos % w AS i, c FROM flat),
b0 AS MATERIALIZED (SELECT p, rid - 1 AS k, i, c FROM points WHERE rid <= {ENTRIES}),{chain},
sha AS (SELECT sha256(string_agg(c::VARCHAR, ',' ORDER BY p, k, i)) AS codebooks_sha256 FROM b{ROUNDS}),
coded AS (
  SELECT rid, string_agg(format('{{:02x}}', best[2]), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
  FROM a{ROUNDS} GROUP BY rid)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN coded USING (rid) CROSS JOIN sha
"""


ORACLE = _oracle()
