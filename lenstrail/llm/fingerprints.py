"""Digests of statistically improbable features.

A window of WINDOW bytes starts at every byte.  A window's entropy falls in one of CLASSES
classes; how often each class occurs in the whole corpus ranks it by rarity.  In every run of
RUN neighbouring windows the rarest one gains a point; windows with enough points are features.  A feature sets five bits in a
Bloom filter of 2048 bits; after 160 features the next filter begins.

Two digests compare filter by filter: common bits above those expected by chance, over the most
that could be common; each filter of the shorter digest takes its best match.
"""

from __future__ import annotations

import base64
import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import buckets_for, short_batches, slices, text_bytes
from lenstrail.llm.suffix_dedup import _BYTES, Powers, mixed

WINDOW = 64
CLASSES = 256
RUN, POINTS = 64, 4
BITS, FILLED, HASHES = 2048, 160, 5

_U = np.uint64
_SCALE = 1 << 32
_PART = np.array([round(c * math.log2(c) * _SCALE) if c else 0 for c in range(WINDOW + 1)], np.int64)  # c * log2(c)
_STEP = np.concatenate(([0], np.diff(_PART)))  # of the c-th byte of a value


def window_starts(data: np.ndarray) -> np.ndarray:
    return np.arange(max(len(data) - WINDOW + 1, 0))


def _part_sums(data: np.ndarray) -> np.ndarray:
    """Sum of c * log2(c) over the counts of each window's bytes, in whole numbers, so exact anywhere.

    From one window to the next a byte leaves and one enters.  Places sorted by byte value tell
    how often a byte occurs in the WINDOW bytes from it on, and up to it.
    """
    order = np.argsort(data, kind="stable")
    place = data[order].astype(np.int64) * (2 * len(data) + 2 * WINDOW) + order
    rank = np.arange(len(data))
    onward, upto = np.empty(len(data), np.int64), np.empty(len(data), np.int64)
    onward[order] = np.searchsorted(place, place + WINDOW) - rank
    upto[order] = rank + 1 - np.searchsorted(place, place - WINDOW, side="right")
    out = np.empty(len(data) - WINDOW + 1, np.int64)
    out[0] = _PART[np.bincount(data[:WINDOW])].sum()
    out[1:] = _STEP[upto[WINDOW:]] - _STEP[onward[: len(out) - 1]]
    return np.cumsum(out, out=out)


def entropy_classes(data: np.ndarray, at: np.ndarray, block: int = 1 << 16) -> np.ndarray:
    """Class of the entropy of the bytes in each window; `at` rises."""
    out = np.empty(len(at), np.int64)
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, block):
        i, j = np.searchsorted(at, [low, low + block])
        if i == j:
            continue
        sums = _part_sums(data[low : low + block + WINDOW - 1])[at[i:j] - low]
        bits = np.log2(WINDOW) - sums / (_SCALE * WINDOW)
        out[i:j] = np.clip(bits / np.log2(WINDOW) * CLASSES, 0, CLASSES - 1)
    return out


class Windows:
    """A text's bytes with the rarity of its windows."""

    def __init__(self, data: np.ndarray, rank: np.ndarray, powers: Powers):
        self.data, self.powers = data, powers
        self.rarity = rank.astype(np.uint8)[entropy_classes(data, window_starts(data))]

    def features(self) -> np.ndarray:
        return _chosen(self.data, self.rarity, self.powers)


def _rarest(rarity: np.ndarray, run: int) -> np.ndarray:
    """Place of the first rarest window of each run, from minima of doubling width."""
    low = rarity.astype(np.int64) << 32 | np.arange(len(rarity))
    width = 1
    while 2 * width <= run:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if width < run:
        low = np.minimum(low[: width - run], low[run - width :])
    return low & 0xFFFFFFFF


def _chosen(data: np.ndarray, rarity: np.ndarray, powers: Powers) -> np.ndarray:
    """Hashes of the windows that are rarest in enough runs, in order.

    A text without windows is one feature as a whole.
    """
    if not len(data):
        return np.zeros(0, np.uint64)
    if not len(rarity):
        return np.array([int.from_bytes(hashlib.sha1(data.tobytes()).digest()[:8], "little")], np.uint64)
    points = np.bincount(_rarest(rarity, min(RUN, len(rarity))), minlength=len(rarity))
    at = np.flatnonzero(points >= min(POINTS, points.max()))
    up, down = powers.to(len(data) + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTES[data] * up[: len(data)], dtype=np.uint64)))
    return mixed((prefix[at + WINDOW] - prefix[at]) * down[at])


def spliced(a: Windows, n_a: int, b: Windows, n_b: int, rank: np.ndarray, powers: Powers) -> np.ndarray:
    """Features of the first n_a bytes of a followed by the first n_b of b.

    Only windows across the seam are new; the others are taken over.
    """
    data = np.concatenate((a.data[:n_a], b.data[:n_b]))
    seam = Windows(data[max(0, n_a - WINDOW + 1) : n_a + WINDOW - 1], rank, powers)
    left, right = (w.rarity[: max(n - WINDOW + 1, 0)] for w, n in ((a, n_a), (b, n_b)))
    return _chosen(data, np.concatenate((left, seam.rarity, right)), powers)


def filters(hashes: np.ndarray) -> np.ndarray:
    """Bit tables (filters, BITS) of the distinct features in order of appearance."""
    _, first = np.unique(hashes, return_index=True)
    hashes = hashes[np.sort(first)]
    out = np.zeros((-(-len(hashes) // FILLED), BITS), bool)
    row = np.arange(len(hashes)) // FILLED
    for k in range(HASHES):
        out[row, ((hashes >> _U(11 * k)) % _U(BITS)).astype(np.int64)] = True
    return out


def encoded(table: np.ndarray) -> str:
    return ".".join(base64.b64encode(np.packbits(f).tobytes()).decode() for f in table)


def decoded(text: str) -> np.ndarray:
    parts = [np.unpackbits(np.frombuffer(base64.b64decode(p), np.uint8)).astype(bool) for p in text.split(".")] if text else []
    return np.array(parts, bool).reshape(-1, BITS)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1.  Two empty digests are alike, an empty and another one are not."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    x, y = a.astype(np.float32), b.astype(np.float32)
    common, n_a, n_b = x @ y.T, x.sum(axis=1)[:, None], y.sum(axis=1)[None, :]
    chance, most = n_a * n_b / BITS, np.minimum(n_a, n_b)
    score = np.clip((common - chance) / np.maximum(most - chance, 1e-9), 0, 1)
    return float(score.max(axis=1).mean())


def entropy_ranks(docs: DataFrame) -> list[int]:
    """Rank of each entropy class over all windows of all texts; the rarest is 0."""

    def count(batches):
        total = np.zeros(CLASSES, np.int64)
        for part in slices(batches):
            for text in part.column("text").to_pylist():
                data = np.frombuffer((text or "").encode(), np.uint8)
                if len(data) >= WINDOW:
                    total += np.bincount(entropy_classes(data, window_starts(data)), minlength=CLASSES)
        yield pa.RecordBatch.from_pydict({"class": pa.array(range(CLASSES), pa.int32()), "n": pa.array(total)})

    counted = short_batches(docs).select(F.col("text").cast("string").alias("text")).mapInArrow(count, "class int, n long")
    n = {r["class"]: r.n for r in counted.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # CLASSES rows
    order = sorted(range(CLASSES), key=lambda c: (n.get(c) or 0, c))
    return [order.index(c) for c in range(CLASSES)]


def _neighbours(docs: DataFrame, parts: int) -> DataFrame:
    """doc_id, text, part, lent: ranges of doc_id, each with the document that follows its last.

    Documents run by falling doc_id, NULL at the end.  Ranges come from quantiles of the ids; only
    the ids at their edges, at most `parts`, reach the driver.
    """
    ids = docs.select(F.col("doc_id").cast("long").alias("d"))
    cuts = sorted(set(ids.where("d IS NOT NULL").approxQuantile("d", [k / parts for k in range(1, parts)], 0.2 / parts)))
    order = F.coalesce(F.col("d"), F.lit(-(1 << 63)))
    part = F.lit(0)
    if cuts:
        edges = F.array(*[F.lit(int(c)) for c in cuts])
        part = F.size(F.filter(edges, lambda c: c <= order))
    ids = ids.withColumn("part", part)
    top = {r.part: r.d for r in ids.groupBy("part").agg(F.max("d").alias("d")).collect()}
    held = sorted(top)
    # The first document of a range follows the last one of the next higher range.
    lend = [(p, top[p], held[(k + 1) % len(held)]) for k, p in enumerate(held)] if len(held) > 1 else []
    own = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("doc_id").cast("long").alias("d")).withColumn("part", part)
    places = F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("lent")))
    if lend:
        table = F.create_map(*[x for p, _, to in lend for x in (F.lit(p), F.lit(to))])
        tops = F.create_map(*[x for p, d, _ in lend for x in (F.lit(p), F.lit(d).cast("long"))])
        also = F.struct(table[F.col("part")].alias("part"), F.lit(True).alias("lent"))
        places = F.when(F.col("d").eqNullSafe(tops[F.col("part")]), F.array(places[0], also)).otherwise(places)
    return own.withColumn("place", F.explode(places)).select("doc_id", "text", "d", "place.part", "place.lent")


def fingerprint(docs: DataFrame) -> DataFrame:
    """Row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next.

    NULL text is empty; an empty text has an empty fingerprint.  A single document is followed
    by itself.  Documents with one doc_id run by text, falling; other columns are ignored; no
    rows give no rows.  Texts are shuffled once, by range of doc_id.
    """
    rank = np.array(entropy_ranks(docs))
    parts = buckets_for(text_bytes(docs), 6 << 20)
    doc_type = dict(docs.dtypes)["doc_id"]
    rows = _neighbours(docs, parts).repartition(parts, "part")
    rows = rows.sortWithinPartitions("part", "lent", F.col("d").desc_nulls_last(), F.col("text").desc_nulls_last())
    rows = rows.select("doc_id", "text", "part", "lent")

    def run(batches):
        powers = Powers()

        def read(doc_id, text):
            windows = Windows(np.frombuffer(text.encode(), np.uint8), rank, powers)
            return doc_id, text, filters(windows.features()), windows

        def result(row, after):
            doc_id, text, own, windows = row
            half = len(text) // 2
            keep, more = text[: len(text) - half].encode(), after[1][:half].encode()
            changed = filters(spliced(windows, len(keep), after[3], len(more), rank, powers))
            sha = hashlib.sha256(keep + more).hexdigest()
            return doc_id, len(text), sha, encoded(own), encoded(changed), likeness(own, changed), likeness(own, after[2])

        first = last = None  # rows of the current range
        at = lent_seen = None
        for part in slices(batches, 1 << 20):
            kind = part.schema.field("doc_id").type
            done = []
            for doc_id, text, p, lent in zip(*(part.column(c).to_pylist() for c in ("doc_id", "text", "part", "lent")), strict=True):
                if p != at:
                    if last is not None:
                        done.append(result(last, first))
                    at, first, last, lent_seen = p, None, None, False
                if lent and lent_seen:
                    continue
                row = read(doc_id, text or "")
                if last is not None:
                    done.append(result(last, row))
                    last = None
                if lent:
                    lent_seen = True
                else:
                    first, last = first or row, row
            yield _batch(done, kind)
        if last is not None:
            yield _batch([result(last, first)], kind)

    return short_batches(rows).mapInArrow(
        run,
        f"doc_id {doc_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double",
    )


def _batch(rows: list[tuple], doc_kind: pa.DataType) -> pa.RecordBatch:
    kinds = (
        ("doc_id", doc_kind),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    )
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_pydict({name: pa.array(c, kind) for c, (name, kind) in zip(columns, kinds, strict=True)})
