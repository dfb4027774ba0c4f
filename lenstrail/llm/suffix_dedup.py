"""Removes bytes of long repeated strings, by two-stage suffix sorting.

A byte goes if a string of GRAM bytes that covers it also starts earlier.  Suffixes of a
whole corpus do not fit one sort, so the work is dealt out by content first:

1. Every string of GRAM bytes (gram) has a minimizer, the least hash of its SEED-byte parts;
   runs of grams with one minimizer form a stretch.  Equal grams have equal minimizers, so
   they can only meet in stretches of one minimizer.
2. Stretches are grouped by minimizer.  Of equal stretches all but the first are repeats
   as a whole.  A first stretch whose minimizer no other stretch shares has no repeats.
3. What is left - different stretches around one minimizer, at the ends of repeats - is sorted
   as suffixes: those smaller than their successors directly, the others induced by a scan
   over the buckets of first bytes; adjacent common prefixes of GRAM bytes or more mark
   equal grams, of which the first in corpus order stays.  Of the grams of a crowded minimizer
   only the first of its kind in a task goes on, so no string, however common, meets in one sort.
4. The repeats return to their documents.

Groups are sized from the bytes of the input, and rows travel as packed binary columns.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.llm.common import buckets_for, short_batches, slices, text_bytes
from lenstrail.sources.tables import cut_lineage

GRAM = 100
SEED = 32
WINDOW = GRAM - SEED + 1
HOT = 1 << 16  # different stretches around one minimizer above which their grams part
ONE_SORT = 1 << 20  # bytes; a suffix sort takes about a hundred times the memory of its bytes

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_BYTES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) | _U(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Powers:
    """Powers of the hash base and of its inverse, grown as texts need them."""

    def __init__(self):
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def to(self, n: int):
        if len(self.up) < n:
            m = max(n, 1 << 17)
            self.up = np.cumprod(np.concatenate(([_U(1)], np.full(m - 1, _BASE))), dtype=np.uint64)
            self.down = np.cumprod(np.concatenate(([_U(1)], np.full(m - 1, _BASE_INVERSE))), dtype=np.uint64)
        return self.up[:n], self.down[:n]


def gram_hashes(x: np.ndarray, size: int) -> np.ndarray:
    """Polynomial hashes of all `size`-long runs of x, by doubling."""
    base = int(_BASE)
    out, have, part, at, step = None, 0, x, x, 1
    while True:
        if size & step:
            if out is None:
                out, have = part, step
            else:
                n = len(x) - have - step + 1
                out = part[:n] * _U(pow(base, have, 1 << 64)) + out[step : step + n]
                have += step
        if step * 2 > size:
            return out
        part = part[:-step] * _U(pow(base, step, 1 << 64)) + part[step:]
        step *= 2


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    n, step = len(x) - width + 1, 1
    while step * 2 <= width:
        x = least(x[:-step], x[step:])
        step *= 2
    rest = width - step
    return least(x[:n], x[rest : rest + n])


def stretches(data: np.ndarray, powers: Powers):
    """(minimizer, hash of the bytes, start, number of grams, whether a gram may repeat inside).

    In order of start, without gaps: each gram belongs to one stretch.
    """
    n = len(data)
    x = _BYTES[data]
    seed = mixed(gram_hashes(x, SEED))
    low = sliding(seed, WINDOW, np.minimum)
    start = np.concatenate(([0], np.flatnonzero(low[1:] != low[:-1]) + 1))
    count = np.diff(np.concatenate((start, [len(low)])))
    key = low[start]
    up, down = powers.to(n + 1)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(x * up[:n], dtype=np.uint64)))
    end = start + count + GRAM - 1
    whole = mixed((prefix[end] - prefix[start]) * down[start] + end.astype(np.uint64) - start.astype(np.uint64))
    # A gram can only repeat inside a stretch if its minimizer occurs there twice.
    padded = np.concatenate((np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)))
    at = np.flatnonzero(sliding(padded, WINDOW, np.maximum) == seed)
    twice = seed[at[1:]][seed[at[1:]] == seed[at[:-1]]]
    inside = np.isin(key, twice) if len(twice) else np.zeros(len(key), bool)
    return key, whole, start, count, inside


# Two-stage suffix sorting --------------------------------------------------------------


def _words(data: np.ndarray) -> np.ndarray:
    """Eight bytes from each position on as one big-endian number, zeros behind the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8))).astype(np.uint64)
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = (out << _U(8)) | padded[k : k + len(data)]
    return out


def _sort_direct(at: np.ndarray, words: np.ndarray, depth: int) -> np.ndarray:
    """Positions in order of their first `depth` bytes, eight at a time; only ties go on."""
    order = at[np.argsort(words[at], kind="stable")]
    group = np.zeros(len(order), np.int64)
    live = np.arange(len(order))
    n = len(words)
    for k in range(0, depth, 8):
        if not len(live):
            break
        p = order[live] + k
        w = np.where(p < n, words[np.minimum(p, n - 1)], _U(0))
        o = np.lexsort((w, group[live]))
        order[live] = order[live][o]
        w, g = w[o], group[live]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (w[1:] != w[:-1])))
        group[live] = live[np.maximum.accumulate(np.where(new, np.arange(len(live)), 0))]
        tied = ~new | np.concatenate((~new[1:], [False]))
        live = live[tied]
    return order


def suffix_array(data: np.ndarray, depth: int = GRAM) -> np.ndarray:
    """Positions of `data` in order of the `depth` bytes from there on (ties in any order).

    Stage one sorts the suffixes that are smaller than their successors.  Stage two goes
    over the buckets of first bytes in rising order; the suffix before each one found, if
    it is larger than its successor, is next in the bucket of its first byte.
    """
    n = len(data)
    if n == 0:
        return np.zeros(0, np.int64)
    # smaller[i]: suffix i < suffix i + 1; the last suffix is larger than the empty one
    change = np.flatnonzero(data[1:] != data[:-1])
    smaller = np.zeros(n, bool)
    if len(change):
        following = np.searchsorted(change, np.arange(n))
        has = following < len(change)
        c = change[np.minimum(following, len(change) - 1)]
        smaller = has & (data[np.minimum(c + 1, n - 1)] > data[c])
    direct = _sort_direct(np.flatnonzero(smaller), _words(data), depth)
    direct_bucket = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(found, byte):
        """Preceding larger suffixes of `found` to their buckets; returns those of this one."""
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        first = data[before]
        same = before[first == byte]
        rest = before[first != byte]
        if len(rest):
            b = data[rest]
            o = np.argsort(b, kind="stable")
            cuts = np.flatnonzero(np.diff(b[o])) + 1
            for part in np.split(rest[o], cuts):
                waiting[data[part[0]]].append(part)
        return same

    waiting[data[n - 1]].append(np.array([n - 1]))
    out = []
    for byte in range(256):
        wave = np.concatenate(waiting[byte]) if waiting[byte] else np.zeros(0, np.int64)
        while len(wave):
            out.append(wave)
            wave = induce(wave, byte)
        part = direct[direct_bucket[byte] : direct_bucket[byte + 1]]
        if len(part):
            out.append(part)
            induce(part, byte)
    return np.concatenate(out)


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int = GRAM) -> np.ndarray:
    """Common bytes of each suffix in `order` with the one before it, up to `depth`."""
    words = _words(data)
    n = len(data)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, depth, 8):
        a, b = order[live] + k, order[live - 1] + k
        inside = (a < n) & (b < n)
        live, a, b = live[inside], a[inside], b[inside]
        differ = words[a] ^ words[b]
        equal = differ == 0
        part = live[~equal]
        d = differ[~equal]
        leading = np.zeros(len(d), np.int64)
        for byte in range(7):
            leading += (d >> _U(8 * (7 - byte))) == 0
        out[part] = k + leading
        live = live[equal]
        out[live] = k + 8
    return np.minimum(out, depth)


def repeated_grams(strings: list[bytes], rank: list[tuple]) -> list[np.ndarray]:
    """For each string the offsets of grams that also start in a string of lower rank, or
    earlier in the same one.  `rank` orders the strings by the place they come from."""
    if not strings:
        return []
    lengths = np.array([len(s) for s in strings])
    # 0xFF never occurs in UTF-8; it parts the strings
    data = np.frombuffer(b"\xff".join(strings) + b"\xff", np.uint8)
    starts = np.concatenate(([0], np.cumsum(lengths[:-1] + 1)))
    by_rank = sorted(range(len(strings)), key=lambda k: rank[k])
    place = np.empty(len(strings), np.int64)
    place[by_rank] = np.arange(len(strings))
    order = suffix_array(data)
    owner = np.searchsorted(starts, order, side="right") - 1
    offset = order - starts[owner]
    whole = offset + GRAM <= lengths[owner]  # suffixes that start a gram
    prefix = common_prefixes(data, order)
    run = np.cumsum(prefix < GRAM)[whole]
    owner, offset = owner[whole], offset[whole]
    o = np.lexsort((offset, place[owner], run))
    repeat = np.concatenate(([False], run[o][1:] == run[o][:-1])) if len(o) else np.zeros(0, bool)
    owner, offset = owner[o][repeat], offset[o][repeat]
    o = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[o], np.arange(1, len(strings)))
    return np.split(offset[o], cuts)


def crowded_grams(strings: list[bytes], rank: list[tuple]) -> list[np.ndarray]:
    """As `repeated_grams`, for more bytes than one sort takes: grams are grouped by hash and compared in full.

    Holds 16 bytes a gram; most grams around a crowded minimizer are alone with their hash.
    """
    by_rank = sorted(range(len(strings)), key=lambda k: rank[k])
    data = np.frombuffer(b"".join(strings[k] for k in by_rank), np.uint8)
    ends = np.cumsum([len(strings[k]) for k in by_rank])
    hashes, places = [], []
    for low in range(0, len(data) - GRAM + 1, ONE_SORT):
        h = mixed(gram_hashes(_BYTES[data[low : low + ONE_SORT + GRAM - 1]], GRAM))
        at = np.arange(low, low + len(h))
        inside = at + GRAM <= ends[np.searchsorted(ends, at, side="right")]
        hashes.append(h[inside])
        places.append(at[inside])
    h, at = np.concatenate(hashes), np.concatenate(places)
    o = np.argsort(h, kind="stable")  # places of one hash stay in order of rank
    h, at = h[o], at[o]
    again = np.flatnonzero(h[1:] == h[:-1]) + 1
    grams = np.lib.stride_tricks.sliding_window_view(data, GRAM)
    step = max(1, ONE_SORT // GRAM)
    unequal = [(grams[at[a]] != grams[at[a - 1]]).any(axis=1) for a in np.split(again, range(step, len(again), step))]
    found = at[again]
    odd = np.unique(h[again[np.concatenate(unequal)]])
    if len(odd):  # different grams of one hash
        found = [found[~np.isin(h[again], odd)]]
        for low in np.searchsorted(h, odd).tolist():
            seen: set[bytes] = set()
            for k in at[low : np.searchsorted(h, h[low], side="right")].tolist():
                gram = data[k : k + GRAM].tobytes()
                if gram in seen:
                    found.append(np.array([k]))
                seen.add(gram)
        found = np.concatenate(found)
    found = np.sort(found)
    owner = np.searchsorted(ends, found, side="right")
    starts = np.concatenate(([0], ends[:-1]))
    parts = np.split(found - starts[owner], np.searchsorted(owner, np.arange(1, len(strings))))
    out: list[np.ndarray] = [parts[0]] * len(strings)
    for k, part in zip(by_rank, parts, strict=True):
        out[k] = part
    return out


# Packed columns ------------------------------------------------------------------------

PLACE = np.dtype([("doc", "<i8"), ("text", "<i8"), ("start", "<u4"), ("count", "<u4"), ("kind", "u1")])
REPEAT, SORT, SORT_HOT = 0, 1, 2


def packed(columns: list[np.ndarray]) -> bytes:
    """Columns one behind the other, compressed: ids and places repeat, hashes do not."""
    import zstandard as zstd

    return zstd.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(c).tobytes() for c in columns))


def unpacked(blobs, kinds: list[str]) -> list[np.ndarray]:
    import zstandard as zstd

    width = sum(np.dtype(k).itemsize for k in kinds)
    parts: list[list[np.ndarray]] = [[] for _ in kinds]
    reader = zstd.ZstdDecompressor()
    for blob in blobs:
        raw = reader.decompress(blob)
        n, at = len(raw) // width, 0
        for k, kind in enumerate(kinds):
            parts[k].append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
    return [np.concatenate(p) if p else np.zeros(0, k) for p, k in zip(parts, kinds, strict=True)]


KINDS = ["<u8", "<u8", "<i8", "<i8", "<u4", "<u4", "u1"]  # minimizer, bytes, doc, text, start, count, flag
HOME = ["<i8", "<i8", "<u4", "<u4", "u1"]  # doc, text, start, count, kind


def dealt(columns: list[np.ndarray], bucket: np.ndarray):
    """Rows (bucket, packed columns) of all buckets that occur."""
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    starts = np.concatenate(([0], cuts)) if len(bucket) else []
    ends = np.concatenate((cuts, [len(bucket)])) if len(bucket) else []
    keys = [int(bucket[s]) for s in starts]
    blobs = [packed([c[order[s:e]] for c in columns]) for s, e in zip(starts, ends, strict=True)]
    return pa.RecordBatch.from_pydict({"bucket": pa.array(keys, pa.int32()), "blob": pa.array(blobs, pa.binary())})


def _home(doc: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    return (mixed(doc.astype(np.uint64) ^ mixed(text.astype(np.uint64))) % _U(n)).astype(np.int32)


def _runs(doc: np.ndarray, text: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    """Single grams as runs (doc, text, start, count, REPEAT)."""
    o = np.lexsort((at, text, doc))
    doc, text, at = doc[o], text[o], at[o].astype(np.int64)
    new = np.ones(len(at), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate((first, [len(at)])))
    return [doc[first], text[first], at[first].astype("<u4"), count.astype("<u4"), np.full(len(first), REPEAT, np.uint8)]


def _first_of(columns: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Columns in order of (minimizer, bytes, doc, text, start), and which are first of their bytes."""
    key, whole, doc, text, start = columns[:5]
    order = np.lexsort((start, text, doc, whole, key))
    columns = [c[order] for c in columns]
    first = np.ones(len(order), bool)
    first[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    return columns, first


NO_ID = np.iinfo(np.int64).max  # NULL doc_id comes last


def _ids(column: pa.ChunkedArray) -> np.ndarray:
    return column.fill_null(NO_ID).to_numpy().astype(np.int64)


def dedup(docs: DataFrame) -> DataFrame:
    """`docs` with each row's kept bytes and figures added.

    Columns added: kept (binary), n_bytes, n_removed, n_spans, kept_sha256; columns of `docs`
    with these names are replaced.  Order is by doc_id, NULL last, then by a hash of the
    text.  Rows equal in both are one document: they are compared with all others, not with
    each other, and all get the same result.  NULL or empty text has no bytes; texts below
    GRAM bytes keep all.  No rows give no rows.
    """
    added = ["kept", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    docs = short_batches(docs).select(*[c for c in docs.columns if c not in added])
    n = buckets_for(text_bytes(docs))
    n_sorts = 4 * n
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), F.col("text").cast("string").alias("text")
    )

    def deal(batches):
        powers = Powers()
        for part in slices(batches, 6 << 20):
            found: list[list[np.ndarray]] = [[] for _ in KINDS]
            seen = set()
            for doc, key, text in zip(_ids(part.column("doc_id")).tolist(), part.column("key").to_pylist(), part.column("text").to_pylist(), strict=True):
                data = np.frombuffer((text or "").encode(), np.uint8)
                if len(data) < GRAM or (doc, key) in seen:
                    continue
                seen.add((doc, key))
                minimizer, whole, start, count, inside = stretches(data, powers)
                for column, values in zip(found, (minimizer, whole, np.full(len(start), doc), np.full(len(start), key), start, count, inside), strict=True):
                    column.append(values)
            if not found[0]:
                continue
            columns = [np.concatenate(c).astype(k) for c, k in zip(found, KINDS, strict=True)]
            # Repeats inside the slice are known here: one row per content and slice goes on.
            columns, first = _first_of(columns)
            again = ~first
            yield dealt([c[first] for c in columns], (columns[0][first] % _U(n)).astype(np.int32))
            back = [c[again] for c in columns[2:6]]
            yield dealt([*back, np.full(again.sum(), REPEAT, np.uint8)], n + _home(back[0], back[1], n))

    def compare(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        blobs = table.column("blob").to_pylist()
        if bucket >= n:  # repeats found in a slice, on their way to their documents
            return pa.Table.from_pydict({"bucket": pa.array([bucket - n] * len(blobs), pa.int32()), "blob": pa.array(blobs, pa.binary())})
        columns, first = _first_of(unpacked(blobs, KINDS))
        # Equal rows come from equal documents that different slices held.
        same = np.zeros(len(first), bool)
        same[1:] = ~first[1:] & (columns[2][1:] == columns[2][:-1]) & (columns[3][1:] == columns[3][:-1]) & (columns[4][1:] == columns[4][:-1])
        key = columns[0]
        start = np.concatenate(([True], key[1:] != key[:-1]))
        group = np.cumsum(start) - 1
        different = np.bincount(group, first)[group]
        sort = first & ((different > 1) | (columns[6] > 0))
        back = ~first & ~same
        kind = np.where(back, REPEAT, np.where(different > HOT, SORT_HOT, SORT)).astype(np.uint8)
        keep = back | sort
        out = [c[keep] for c in columns[2:6]]
        return pa.Table.from_batches([dealt([*out, kind[keep]], _home(out[0], out[1], n))])

    places = (
        keyed.mapInArrow(deal, "bucket int, blob binary").groupBy("bucket").applyInArrow(compare, "bucket int, blob binary")
    )
    places = cut_lineage(places)

    def gather(key, left: pa.Table, right: pa.Table) -> pa.Table:
        """Bytes of the stretches to sort, dealt by minimizer; right: places, left: texts."""
        columns = unpacked(right.column("blob").to_pylist(), HOME)
        ask = columns[4] != REPEAT
        doc, text, start, count, kind = (c[ask] for c in columns)
        order = np.lexsort((start, text, doc))
        texts = _by_key(left)
        rows: dict[str, list] = {c: [] for c in ASK.names}
        seen: set[bytes] = set()
        again: list[tuple[int, int, int]] = []
        for d, t, s, c, k in zip(*(x[order].tolist() for x in (doc, text, start, count, kind)), strict=True):
            data = texts[d, t]
            piece = data[s : s + c + GRAM - 1]
            x = _BYTES[np.frombuffer(piece, np.uint8)]
            if k == SORT:
                where = [(int(mixed(gram_hashes(x, SEED)).min()), s, piece)]
            else:  # grams of a crowded minimizer part, each to the place of its own hash
                where = []
                for i, h in enumerate(mixed(gram_hashes(x, GRAM)).tolist()):
                    gram = piece[i : i + GRAM]
                    if gram in seen:  # the first in this task stands for it
                        again.append((d, t, s + i))
                    else:
                        seen.add(gram)
                        where.append((h, s + i, gram))
            for part, at, raw in where:
                for name, value in zip(rows, (part % n_sorts, part, d, t, at, raw), strict=True):
                    rows[name].append(value)
        if again:
            runs = _runs(*(np.array(c, np.int64) for c in zip(*again, strict=True)))
            for name, value in zip(rows, (n_sorts + key[0].as_py(), 0, 0, 0, 0, packed(runs)), strict=True):
                rows[name].append(value)
        rows["part"] = np.array(rows["part"], np.uint64).view(np.int64)
        return pa.Table.from_pydict(rows, schema=ASK)

    ASK = pa.schema([("bucket", pa.int32()), ("part", pa.int64()), ("doc", pa.int64()), ("key", pa.int64()), ("start", pa.int64()), ("bytes", pa.binary())])

    def settle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        if bucket >= n_sorts:  # repeats found in a task, on their way to their documents
            return pa.Table.from_pydict({"bucket": pa.array([bucket - n_sorts] * table.num_rows, pa.int32()), "blob": table.column("bytes")})
        part = table.column("part").to_numpy()
        lengths = pc.binary_length(table.column("bytes")).to_numpy()
        order = np.argsort(part, kind="stable")
        edge = np.concatenate(([True], np.diff(part[order]) != 0, [True]))
        alone = edge[:-1] & edge[1:] & (lengths[order] == GRAM)  # a gram without another of its hash
        order = order[~alone]
        # Equal grams lie in one part, so parts are sorted by themselves, some at a time.
        before = np.concatenate(([0], np.cumsum(lengths[order])))
        starts = np.flatnonzero(np.diff(part[order], prepend=part[order][:1] - 1) != 0).tolist()
        cuts = [0]
        for at, end in zip(starts, [*starts[1:], len(order)], strict=False):
            if at > cuts[-1] and before[end] - before[cuts[-1]] > ONE_SORT:
                cuts.append(at)
        found: list[tuple] = []
        for low, high in zip(cuts, [*cuts[1:], len(order)], strict=True):
            some = table.take(pa.array(order[low:high]))
            doc, key, start = (some.column(c).to_numpy() for c in ("doc", "key", "start"))
            how = crowded_grams if before[high] - before[low] > ONE_SORT else repeated_grams
            repeats = how(some.column("bytes").to_pylist(), list(zip(doc.tolist(), key.tolist(), start.tolist(), strict=True)))
            n_each = [len(r) for r in repeats]
            if sum(n_each):
                found.append((np.repeat(doc, n_each), np.repeat(key, n_each), np.concatenate(repeats) + np.repeat(start, n_each)))
        none = np.zeros(0, np.int64)
        out = _runs(*(np.concatenate(c) for c in zip(*found, strict=True))) if found else _runs(none, none, none)
        return pa.Table.from_batches([dealt(out, _home(out[0], out[1], n))])

    def bundle(batches):
        """All columns of `docs`, several rows to a compressed bundle, dealt to their places."""
        options = pa.ipc.IpcWriteOptions(compression="zstd")
        for part in slices(batches, 6 << 20, "__text"):
            home = _home(_ids(part.column("__doc")), part.column("__key").to_numpy().astype(np.int64), n)
            order = np.argsort(home, kind="stable")
            part = part.take(pa.array(order)).combine_chunks()
            edges = np.concatenate(([0], np.flatnonzero(np.diff(home[order])) + 1, [len(order)]))
            keys, blobs = [], []
            for s, e in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, part.schema, options=options) as w:
                    w.write_table(part.slice(s, e - s))
                keys.append(int(home[order[s]]))
                blobs.append(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_pydict({"bucket": pa.array(keys, pa.int32()), "rows": pa.array(blobs, pa.binary())})

    def bundles(frame):
        named = frame.select("*", F.col("doc_id").cast("long").alias("__doc"), F.xxhash64("text").alias("__key"), F.col("text").cast("string").alias("__text"))
        return named.mapInArrow(bundle, "bucket int, rows binary").groupBy("bucket")

    settled = (
        bundles(docs.select("doc_id", "text"))
        .cogroup(places.groupBy("bucket"))
        .applyInArrow(gather, "bucket int, part long, doc long, key long, start long, bytes binary")
        .groupBy("bucket")
        .applyInArrow(settle, "bucket int, blob binary")
    )

    schema = docs.withColumns(
        {
            "kept": F.lit(b""),
            "n_bytes": F.lit(0).cast("long"),
            "n_removed": F.lit(0).cast("long"),
            "n_spans": F.lit(0).cast("long"),
            "kept_sha256": F.lit(""),
        }
    ).schema

    def finish(key, left: pa.Table, right: pa.Table) -> pa.Table:
        *columns, kind = unpacked(right.column("blob").to_pylist(), HOME)
        doc, text, start, count = (c[kind == REPEAT] for c in columns)
        order = np.lexsort((start, text, doc))
        doc, text, start, count = (c[order].astype(np.int64) for c in (doc, text, start, count))
        new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (text[1:] != text[:-1])))) if len(doc) else np.zeros(0, np.int64)
        edges = [*new.tolist(), len(doc)]
        spans = {(int(doc[a]), int(text[a])): (start[a:b], start[a:b] + count[a:b] + GRAM - 1) for a, b in zip(edges[:-1], edges[1:], strict=True)}
        out = []
        for blob in left.column("rows").to_pylist():
            rows = pa.ipc.open_stream(blob).read_all()
            columns: dict[str, list] = {c: [] for c in added}
            for d, t, value in zip(_ids(rows.column("__doc")).tolist(), rows.column("__key").to_pylist(), rows.column("__text").to_pylist(), strict=True):
                data = (value or "").encode()
                kept, n_removed, n_spans = cut_out(data, *spans.get((d, t), (None, None)))
                for name, v in zip(added, (kept, len(data), n_removed, n_spans, hashlib.sha256(kept).hexdigest()), strict=True):
                    columns[name].append(v)
            rows = rows.drop_columns(["__doc", "__key", "__text"])
            types = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            for (name, values), kind in zip(columns.items(), types, strict=True):
                rows = rows.append_column(name, pa.array(values, kind))
            out.append(rows)
        if not out:
            return _empty(schema)
        return pa.concat_tables(out)

    return bundles(docs).cogroup(places.union(settled).groupBy("bucket")).applyInArrow(finish, schema)


def _empty(schema) -> pa.Table:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema).empty_table()


def _by_key(table: pa.Table) -> dict[tuple[int, int], bytes]:
    out = {}
    for blob in table.column("rows").to_pylist():
        rows = pa.ipc.open_stream(blob).read_all()
        for d, t, value in zip(_ids(rows.column("__doc")).tolist(), rows.column("__key").to_pylist(), rows.column("__text").to_pylist(), strict=True):
            out[d, t] = (value or "").encode()
    return out


def cut_out(data: bytes, start, end) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and maximal removed runs; starts rise."""
    if start is None or not len(start):
        return data, 0, 0
    end = np.maximum.accumulate(end)
    new = np.concatenate(([True], start[1:] > end[:-1]))
    first = start[new]
    last = end[np.concatenate((np.flatnonzero(new)[1:] - 1, [len(end) - 1]))]
    kept, at = [], 0
    for a, b in zip(first.tolist(), last.tolist(), strict=True):
        kept.append(data[at:a])
        at = b
    kept.append(data[at:])
    return b"".join(kept), int((last - first).sum()), len(first)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row."""
    return dedup(docs.select("doc_id", "text")).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def trimmed_documents(docs: DataFrame) -> DataFrame:
    """`docs` with repeated bytes cut from `text`; what is left of a cut character is U+FFFD.

    Rows whose whole text goes are kept with an empty text.  A column n_chars is counted anew.
    """
    out = dedup(docs).withColumn("text", F.make_valid_utf8(F.col("kept").cast("string")))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out.select(*docs.columns)
