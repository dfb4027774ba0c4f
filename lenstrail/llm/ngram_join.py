"""Joins documents whose sets of word n-grams have a Jaccard similarity of a threshold or more.

1. Each text becomes the set of hashes of its runs of five words (lower case).  Texts with
   one set are a class; all later work is on classes.
2. MinHash values in bands propose pairs.  In each band the members are first compared with
   the least one (the leader); verified links make components.
3. A candidate's MinHash values are compared in steps.  After m of n agree, the posterior
   probability of reaching the threshold under a uniform prior is P(Binomial(n + 1, t) <= m);
   a pair below the tolerance is dropped.  What stays is verified on the whole sets.
4. Components that meet in a band are compared in the same way, in blocks.  Those with
   candidates left form clusters.
5. All pairs of a cluster are verified exactly, block by block, which counts links and joins
   components; pairs are never listed.  Sets of a large cluster travel as differences from its leader's.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from itertools import chain
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lenstrail.llm.common import components, counted, let_go, short_batches, slices
from lenstrail.llm.suffix_dedup import mixed
from lenstrail.sources.tables import cut_lineage

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
STEP = 16
TOLERANCE = 1e-7
BLOCK = 512
BLOCK_BYTES = 1 << 20
DIFF_BLOCK = 2048
DIFF_BYTES = 8 << 20
AT_ONCE = 1 << 18  # characters split into words at a time

_U = np.uint64
_WORD = re.compile(r"\w+")
_RANDOM = np.random.default_rng(61)
_FACTOR = _RANDOM.integers(1, 1 << 63, HASHES, dtype=np.uint64) | _U(1)
_SHIFT = _RANDOM.integers(0, 1 << 63, HASHES, dtype=np.uint64)
_PLACE = _RANDOM.integers(1, 1 << 63, 16, dtype=np.uint64) | _U(1)


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode())
        return value


_KNOWN = _Hashes()


def shingle_sets(texts: Iterable[str | None], words: int = WORDS) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of the runs of `words` words of each text, one by one.

    A text of fewer words has one run, of all its words; a text without words has none.
    Words, which take many times the memory of the text, are held for few texts at a time.
    """
    held, n = [], 0
    for text in texts:
        held.append(text)
        n += len(text or "")
        if n >= AT_ONCE:
            yield from _shingle_sets(held, words)
            held, n = [], 0
    yield from _shingle_sets(held, words)


def _shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    pieces = [_WORD.findall(t.lower()) if t else [] for t in texts]
    flat = np.fromiter(map(_KNOWN.__getitem__, chain.from_iterable(pieces)), np.uint64)
    out, at = [], 0
    for p in pieces:
        h = flat[at : at + len(p)]
        at += len(p)
        n = len(h)
        if not n:
            out.append(h)
            continue
        k = min(n, words)
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += h[j : n - k + 1 + j] * _PLACE[j]
        out.append(np.unique(mixed(total + _U(k))))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(HASHES, ~_U(0))
    for k in range(0, len(shingles), 2048):
        part = shingles[k : k + 2048]
        low = np.minimum(low, (part[None, :] * _FACTOR[:, None] + _SHIFT[:, None]).min(axis=1))
    return low


def band_keys(low: np.ndarray) -> np.ndarray:
    rows = mixed(low).reshape(BANDS, ROWS)
    key = np.arange(BANDS, dtype=np.uint64)
    for j in range(ROWS):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + rows[:, j])
    return key.astype(np.int64)


def least_matches(threshold: float, tolerance: float) -> list[tuple[int, int]]:
    """(values compared, least agreeing values to go on) at each step."""
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, 0
        while True:
            total += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if total >= tolerance:
                break
            m += 1
        out.append((n, m))
    return out


def stays(a: np.ndarray, b: np.ndarray, steps) -> np.ndarray:
    """Which pairs of rows of two signature arrays keep a posterior above the tolerance."""
    live = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    before = 0
    for n, least in steps:
        matches = matches + (a[live, before:n] == b[live, before:n]).sum(axis=1)
        keep = matches >= least
        live, matches, before = live[keep], matches[keep], n
        if not len(live):
            break
    out = np.zeros(len(a), bool)
    out[live] = True
    return out


def similar(inter, n_a, n_b, threshold: float):
    return inter >= threshold * (n_a + n_b - inter) - 1e-9


def _signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


def sketches(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, text_key, class (hash of the set; NULL without words), signature, bands."""
    doc_type = dict(docs.dtypes)["doc_id"]

    def run(batches):
        for part in slices(batches, 4 << 20):
            columns: dict[str, list] = {k: [] for k in ("class", "signature", "bands")}
            for s in shingle_sets((t.as_py() for t in part.column("text")), words):
                low = signature(s) if len(s) else None
                node = int(mixed(mixed(s).sum(dtype=np.uint64, keepdims=True) + _U(len(s)))[0] >> _U(1)) if len(s) else None
                columns["class"].append(node)
                columns["signature"].append((low >> _U(40)).astype(np.uint8).tobytes() if len(s) else None)
                columns["bands"].append(band_keys(low) if len(s) else None)
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": part.column("doc_id").combine_chunks(),
                    "text_key": part.column("text_key").combine_chunks(),
                    "class": pa.array(columns["class"], pa.int64()),
                    "signature": pa.array(columns["signature"], pa.binary()),
                    "bands": pa.array(columns["bands"], pa.list_(pa.int64())),
                }
            )

    rows = short_batches(docs).select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {doc_type}, text_key long, class long, signature binary, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, words: int, threshold: float) -> DataFrame:
    """Pairs (a, b) of classes whose sets reach the threshold.

    The text of b goes to a's group; groups of a busy class are parted, with a's text in each.
    """
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(1 << 20)))
    per = salted.groupBy("a").agg(F.greatest(F.ceil(F.count("*") / BLOCK), F.lit(1)).alias("parts"))
    salted = salted.join(per, "a").withColumn("salt", (F.col("salt") % F.col("parts")).cast("int"))
    asked = salted.select(F.col("b").alias("class"), "a", "salt").union(
        per.select(F.col("a").alias("class"), "a", F.explode(F.sequence(F.lit(0), F.col("parts").cast("int") - 1)))
    )

    def compare(table: pa.Table) -> pa.Table:
        a = table.column("a")[0].as_py()
        nodes = table.column("class").to_pylist()
        texts = table.column("text")
        own = next(shingle_sets([texts[nodes.index(a)].as_py()], words))
        sets = shingle_sets((t.as_py() for t in texts), words)
        found = [
            n
            for n, s in zip(nodes, sets, strict=True)
            if n != a and similar(len(np.intersect1d(own, s, assume_unique=True)), len(own), len(s), threshold)
        ]
        return pa.Table.from_pydict({"a": pa.array([a] * len(found), pa.int64()), "b": pa.array(found, pa.int64())})

    return asked.join(texts, "class").groupBy("a", "salt").applyInArrow(compare, "a long, b long")


def _across(members: DataFrame, signs: DataFrame, steps) -> DataFrame:
    """Pairs (a, b) of components between which candidates stay; a forest for each task.

    `members` has band, class, component: bands that hold several components; `signs` class, signature.

    Members of a component too large for a block get blocks of their own, the rest share blocks;
    two blocks of one large component are not paired.
    """
    members = cut_lineage(members)
    size = members.groupBy("band", "component").agg(F.count("*").alias("n"))
    total = size.groupBy("band", F.when(F.col("n") > BLOCK, F.col("component")).otherwise(-1).alias("owner")).agg(
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("many")
    )
    # A band of one block is one task.  Only the others, which are few, are looked up.
    several = F.sum("many").over(W.partitionBy("band")) > 1
    total = counted(total.withColumn("several", several).where("several").drop("several"))
    blocks = total.select("band", "owner", F.explode(F.sequence(F.lit(0), F.col("many") - 1)).alias("part"))
    one, two = blocks, blocks.select("band", F.col("owner").alias("owner2"), F.col("part").alias("part2"))
    pairs = (
        one.join(two, "band")
        .where("(owner, part) <= (owner2, part2) AND (owner != owner2 OR owner = -1)")
        .withColumn("task", F.xxhash64("band", "owner", "part", "owner2", "part2"))
    )
    sides = pairs.select("band", "owner", "part", "task", F.lit(0).alias("side")).union(
        pairs.where("(owner, part) != (owner2, part2)").select("band", "owner2", "part2", "task", F.lit(1))
    )
    sides = counted(sides)
    busy = total.where("owner != -1").select("band", F.col("owner").alias("component"), "owner")
    named = members.join(signs, "class").join(busy, ["band", "component"], "left").withColumn("owner", F.coalesce("owner", F.lit(-1)))
    parts = F.coalesce("many", F.lit(1))
    placed = named.join(total, ["band", "owner"], "left").withColumn("part", F.pmod(F.xxhash64("class"), parts).cast("int"))
    # In a band of several blocks a part without sides has nothing to be compared with.
    dealt = placed.join(sides, ["band", "owner", "part"], "left").where("task IS NOT NULL OR many IS NULL")
    dealt = dealt.select(
        F.coalesce("task", F.xxhash64("band")).alias("task"), F.coalesce("side", F.lit(0)).alias("side"), "class", "component", "signature"
    )

    def compare(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        component = table.column("component").to_numpy()
        signs = _signatures(table.column("signature"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        root = {c: c for c in component.tolist()}

        def find(c):
            while root[c] != c:
                c = root[c]
            return c

        for i in left.tolist():
            js = right if len(right) else left[left > i]
            js = js[component[js] != component[i]]
            js = js[stays(np.broadcast_to(signs[i], (len(js), HASHES)), signs[js], steps)]
            for c in np.unique(component[js]).tolist():
                x, y = sorted((find(component[i].item()), find(c)))
                root[y] = x
        pairs = [(find(c), c) for c in root if find(c) != c]
        return pa.Table.from_pydict(
            {"a": pa.array([x for x, _ in pairs], pa.int64()), "b": pa.array([y for _, y in pairs], pa.int64())}
        )

    return dealt.groupBy("task").applyInArrow(compare, "a long, b long").distinct()


def _differences(members: DataFrame, texts: DataFrame, words: int) -> DataFrame:
    """(class, n, of_leader, minus, diff): each set as its difference from the set of its cluster's leader.

    `n` and `of_leader` are the sizes of both sets, `minus` how many of the leader's shingles are missing, `diff` the
    hashes in one of the two sets only.  Each text moves once, to a group that also has the leader's.
    """
    per = members.groupBy("cluster").agg(F.min("class").alias("leader"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    asked = (
        members.join(per, "cluster")
        .where("class != leader")
        .select("class", "cluster", F.pmod(F.xxhash64(F.lit(3), "class"), F.col("parts")).cast("int").alias("salt"), F.lit(False).alias("leads"))
    )
    leaders = per.select(F.col("leader").alias("class"), "cluster", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt"), F.lit(True).alias("leads"))

    def cut(table: pa.Table) -> pa.Table:
        leads = np.array(table.column("leads").to_pylist(), bool)
        text = table.column("text")
        first = int(np.flatnonzero(leads)[0])
        own = next(shingle_sets([text[first].as_py()], words))
        out: dict[str, list] = {k: [] for k in ("class", "n", "of_leader", "minus", "diff")}
        rows = np.flatnonzero(~leads).tolist()
        if table.column("salt")[0].as_py() == 0:
            rows.append(first)  # the leader itself, once
        for i, s in zip(rows, shingle_sets((text[i].as_py() for i in rows), words), strict=True):
            plus = np.setdiff1d(s, own, assume_unique=True)
            minus = np.setdiff1d(own, s, assume_unique=True)
            for name, value in zip(out, (table.column("class")[i].as_py(), len(s), len(own), len(minus), np.concatenate((minus, plus)).tobytes()), strict=True):
                out[name].append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds, strict=True)})

    grouped = asked.union(leaders).join(texts, "class").groupBy("cluster", "salt")
    return grouped.applyInArrow(cut, "class long, n long, of_leader long, minus long, diff binary")


def _linked(table: pa.Table, sets: list[np.ndarray], sizes: np.ndarray, minus: np.ndarray, base: int, second: np.ndarray, same: bool, threshold: float) -> pa.Table:
    """Links of a block, or between two, whose sets are those of `base` shingles but for the differences `sets`.

    Two such sets share base - minus of one - minus of the other + the differences they have in common.
    """
    node, copies = table.column("class").to_numpy(), table.column("copies").to_numpy().astype(float)
    component = table.column("component").to_numpy()
    row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = seen > 1
    number = np.cumsum(shared) - 1
    keep = shared[at]
    row, at = row[keep], number[at[keep]]
    order = np.argsort(at, kind="stable")
    row, at = row[order], at[order]
    left, right = (np.arange(len(sets)),) * 2 if same else (np.flatnonzero(~second), np.flatnonzero(second))
    where_l, where_r = np.full(len(sets), -1), np.full(len(sets), -1)
    where_l[left], where_r[right] = np.arange(len(left)), np.arange(len(right))
    inter = np.zeros((len(left), len(right)), np.float32)
    width = 2048
    for k in range(0, int(shared.sum()), width):
        a, b = np.searchsorted(at, [k, k + width])
        r, c = row[a:b], at[a:b] - k
        x = np.zeros((len(left), width), np.float32)
        m = where_l[r] >= 0
        x[where_l[r[m]], c[m]] = 1
        if same:
            y = x
        else:
            y = np.zeros((len(right), width), np.float32)
            m = where_r[r] >= 0
            y[where_r[r[m]], c[m]] = 1
        inter += x @ y.T
    both = inter.astype(float) + base - minus[left][:, None] - minus[right][None, :]
    hit = similar(both, sizes[left][:, None], sizes[right][None, :], threshold)
    if same:
        np.fill_diagonal(hit, False)
        ids, links = node[left], hit @ copies[right]
    else:
        ids = np.concatenate((node[left], node[right]))
        links = np.concatenate((hit @ copies[right], hit.T @ copies[left]))
    r, c = np.nonzero(hit & (component[left][:, None] != component[right][None, :]))
    joined = np.unique(np.sort(np.column_stack((component[left][r], component[right][c])), axis=1), axis=0)
    none, some = [None] * len(joined), [None] * len(ids)
    return pa.Table.from_pydict(
        {
            "class": pa.array([*ids.tolist(), *none], pa.int64()),
            "links": pa.array([*np.rint(links).astype(np.int64).tolist(), *none], pa.int64()),
            "a": pa.array([*some, *joined[:, 0].tolist()], pa.int64()),
            "b": pa.array([*some, *joined[:, 1].tolist()], pa.int64()),
        }
    )


LINKS = "class long, links long, a long, b long"


def _compared(nodes: DataFrame, texts: DataFrame, words: int, threshold: float, count_links: bool) -> DataFrame:
    """All pairs inside each cluster of (class, component, cluster, copies), verified in blocks.

    Rows are (class, links): documents of other classes that reach the threshold, to be summed,
    and (a, b): components that a link joins, once per task.  A cluster that one block of BLOCK_BYTES
    of text and BLOCK texts holds is one task.  The sets of a larger one are stored once as differences from its
    leader; these are dealt to pairs of blocks, each a task that multiplies their sparse incidence
    tables.  Without counts, blocks of one component, which is joined already, are not paired.
    Rows grow with the number of blocks, never with pairs of documents.
    """
    sized = nodes.join(texts.select("class", F.octet_length("text").alias("bytes")), "class")
    fits = sized.groupBy("cluster").agg(((F.sum("bytes") <= BLOCK_BYTES) & (F.count("*") <= BLOCK)).alias("fits"))
    placed = cut_lineage(nodes.join(fits, "cluster"))

    def count(table: pa.Table) -> pa.Table:
        sets = list(shingle_sets((t.as_py() for t in table.column("text")), words))
        sizes = np.array([len(s) for s in sets], float)
        return _linked(table, sets, sizes, np.zeros(len(sets)), 0, np.zeros(len(sets), bool), True, threshold)

    small = placed.where("fits").drop("fits").join(texts, "class").groupBy("cluster").applyInArrow(count, LINKS)

    large = placed.where("NOT fits").drop("fits")
    diffs = cut_lineage(_differences(large, texts, words).join(large, "class"))
    owner = F.lit(-1).cast("long")
    if not count_links:
        of_one = diffs.groupBy("cluster", "component").agg((F.count("*") > DIFF_BLOCK).alias("many"))
        diffs = diffs.join(of_one, ["cluster", "component"])
        owner = F.when(F.col("many"), F.col("component")).otherwise(owner)
    diffs = diffs.withColumn("owner", owner)
    parts = F.greatest(F.ceil(F.count("*") / DIFF_BLOCK), F.ceil(F.sum(F.octet_length("diff")) / DIFF_BYTES)).cast("int")
    total = counted(diffs.groupBy("cluster", "owner").agg(parts.alias("parts")))
    blocks = total.select("cluster", "owner", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    two = blocks.select("cluster", F.col("owner").alias("owner2"), F.col("part").alias("part2"))
    pairs = blocks.join(two, "cluster").where("(owner, part) <= (owner2, part2) AND (owner != owner2 OR owner = -1)")
    pairs = pairs.withColumns({"task": F.xxhash64("cluster", "owner", "part", "owner2", "part2"), "same": F.expr("(owner, part) = (owner2, part2)")})
    sides = pairs.select("cluster", "owner", "part", "task", "same", F.lit(False).alias("second")).union(
        pairs.where("NOT same").select("cluster", "owner2", "part2", "task", "same", F.lit(True))
    )
    sides = counted(sides)
    located = diffs.join(total, ["cluster", "owner"]).withColumn("part", F.pmod(F.xxhash64(F.lit(1), "class"), F.col("parts")).cast("int"))
    dealt = located.join(sides, ["cluster", "owner", "part"]).select(
        "cluster", "task", "same", "second", "class", "component", "copies", "n", "of_leader", "minus", "diff"
    )

    def count_differences(table: pa.Table) -> pa.Table:
        sets = [np.frombuffer(d, np.uint64) for d in table.column("diff").to_pylist()]
        sizes, minus = (table.column(c).to_numpy().astype(float) for c in ("n", "minus"))
        second = np.array(table.column("second").to_pylist(), bool)
        return _linked(table, sets, sizes, minus, table.column("of_leader")[0].as_py(), second, table.column("same")[0].as_py(), threshold)

    return small.union(dealt.groupBy("cluster", "task").applyInArrow(count_differences, LINKS))


def _rep(frame_doc: str = "doc_id"):
    """Sorts documents of a class: by doc_id, NULL last, then by text hash."""
    return F.struct(F.col(frame_doc).isNull().alias("no_id"), F.col(frame_doc).alias("doc_id"), F.col("text_key").alias("text_key"))


def _texts_of(nodes: DataFrame, docs: DataFrame) -> DataFrame:
    """(class, text) of the first document of each class in `nodes` (class, rep), stored."""
    wanted = nodes.select("class", F.col("rep.doc_id").alias("__doc"), F.col("rep.text_key").alias("__key"))
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), F.col("text").cast("string").alias("text"))
    found = keyed.join(wanted, (F.col("text_key") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__doc")))
    return cut_lineage(found.select("class", "text").dropDuplicates(["class"]))


def ngram_join(
    docs: DataFrame, *, words: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, count_links: bool = True
) -> DataFrame:
    """Row per document: doc_id, class_id, n_links, kept, text_class, text_key.

    class_id is the smallest doc_id that links reach, n_links the number of other documents
    whose sets reach `threshold` (NULL without `count_links`), kept marks the one document
    of each class that stays, text_class identifies equal sets (a 63-bit hash of the set),
    text_key is the hash of the text.

    NULL and wordless texts link with nothing: class_id is their own doc_id.  NULL doc_id
    comes last; of rows with one doc_id the text hash decides which is kept, and rows equal
    in both are marked alike.  Other columns are ignored; no rows give no rows.
    """
    steps = least_matches(threshold, tolerance)
    found = cut_lineage(sketches(docs, words))
    real = found.where("class IS NOT NULL")
    classes = real.groupBy("class").agg(F.min(_rep()).alias("rep"), F.count("*").alias("copies"))
    signs = real.select("class", "signature").dropDuplicates(["class"])
    in_band = real.select("class", "bands").dropDuplicates(["class"]).select("class", F.explode("bands").alias("band"))
    leaders = in_band.groupBy("band").agg(F.min("class").alias("a"), F.max("class").alias("last")).where("a != last")
    shared = cut_lineage(in_band.join(leaders.select("band", "a"), "band"))  # bands with company

    def prune(batches):
        for batch in batches:
            if batch.num_rows:
                keep = stays(_signatures(batch.column("s")), _signatures(batch.column("signature")), steps)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    first = shared.where("class != a").select("a", F.col("class").alias("b")).distinct()
    first = cut_lineage(
        first.join(signs.withColumnRenamed("class", "b"), "b")
        .join(signs.select(F.col("class").alias("a"), F.col("signature").alias("s")), "a")
        .select("a", "b", "signature", "s")
        .mapInArrow(prune, "a long, b long")
    )
    ends = first.select(F.col("a").alias("class")).union(first.select("b")).distinct()
    texts = _texts_of(classes.join(ends, "class"), docs)
    linked = cut_lineage(_verified(first, texts, words, threshold))
    let_go(docs.sparkSession)
    groups = counted(components(linked).withColumnRenamed("id", "class"))
    located = shared.join(groups, "class", "left").select("band", "class", F.coalesce("component", "class").alias("component"))
    apart = located.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("band")
    crossed = cut_lineage(_across(located.join(apart, "band"), signs, steps))
    let_go(docs.sparkSession)
    clusters = components(crossed).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
    nodes = classes.join(groups, "class", "left").withColumn("component", F.coalesce("component", "class"))
    nodes = cut_lineage(nodes.join(clusters, "component", "left"))
    # Without counts, components that no candidate joins are settled.
    inner = nodes.where("cluster IS NOT NULL")
    if count_links:
        inner = nodes.join(groups.select("class"), "class", "left_semi").where("cluster IS NULL").unionByName(inner)
    inner = inner.withColumn("cluster", F.coalesce("cluster", "component"))
    texts = texts.union(_texts_of(inner.join(ends, "class", "left_anti"), docs))
    compared = cut_lineage(_compared(inner.select("class", "component", "cluster", "copies"), texts, words, threshold, count_links))
    let_go(docs.sparkSession)
    merged = components(compared.where("a IS NOT NULL").select("a", "b")).select(
        F.col("id").alias("component"), F.col("component").alias("whole")
    )
    nodes = nodes.join(merged, "component", "left").withColumn("component", F.coalesce("whole", "component"))
    name = nodes.groupBy("component").agg(F.min("rep").alias("first"))
    if count_links:
        links = compared.where("a IS NULL").groupBy("class").agg(F.sum("links").alias("links"))
        nodes = nodes.join(links, "class", "left")
        n_links = F.coalesce("links", F.lit(0)) + F.col("copies") - 1
    else:
        n_links = F.lit(None).cast("long")
    known = cut_lineage(nodes.join(name, "component").select("class", "first", n_links.alias("class_links")))
    alone = F.col("class").isNull()
    own = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_key") == F.col("first.text_key"))
    return found.join(known, "class", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
        F.when(alone, F.lit(0 if count_links else None)).otherwise(F.col("class_links")).cast("long").alias("n_links"),
        (alone | own).alias("kept"),
        F.col("class").alias("text_class"),
        "text_key",
    )


def distinct_documents(docs: DataFrame, **options) -> DataFrame:
    """One row of `docs` per class: the one with the smallest doc_id; columns are kept.

    Of rows equal in doc_id and text one stays, unless the text has no words.
    """
    kept = ngram_join(docs, count_links=False, **options).where("kept").select(
        F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key"), F.col("text_class").isNull().alias("__bare")
    )
    kept = kept.distinct()
    keyed = docs.withColumn("__own", F.xxhash64("text"))
    out = keyed.join(kept, (F.col("__own") == F.col("__key")) & F.col("doc_id").eqNullSafe(F.col("__doc")))
    same = F.row_number().over(W.partitionBy("__own", "doc_id").orderBy("doc_id"))
    return out.withColumn("__row", same).where("__row = 1 OR __bare").select(*docs.columns)
