import re

import pytest

from lenstrail.llm import mixing


def brute_targets(sizes, most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total = left = sum(sizes.values())
    out, open_ = {}, set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] >= most * sizes[s]]
        if not over:
            return out | share
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.discard(s)
    assert total >= 0
    return out


ROWS = [
    (i, ("w" * (i % 7 + 1) + " ") * (i % 50 + 1), s)
    for i, s in enumerate(["a"] * 400 + ["b"] * 60 + ["c"] * 5 + [None] * 40 + ["é"] * 200 + ["zz"] * 30)
]


def test_targets_and_words_taken(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string").repartition(5)
    got = mixing.mix(df).collect()
    assert len(got) == len(ROWS)
    sizes = {}
    for _, text, source in ROWS:
        sizes[source] = sizes.get(source, 0) + len(text.split())
    want = brute_targets(sizes)
    taken = {}
    for r in got:
        assert r.size == len(ROWS[r.doc_id][1].split()) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size and r.taken == r.size * r.copies
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source, words in taken.items():
        assert abs(words - want[source]) <= 25.01, source
    again = mixing.mix(df.repartition(2)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_few_bins_give_the_same_draw(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, source string")
    one, many = (sorted((r.doc_id, r.copies) for r in mixing.mix(df, bins=b).collect()) for b in (1, 4096))
    assert one == many


def test_words_are_counted_as_stated(spark):
    texts = [None, "", " \t\n\x0b\x0c\r ", "a", " a  b\x0bc ", "a\xa0b\x85c\x1cd", "x y"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [r[0] for r in df.select(mixing.word_count(df.text)).collect()]
    assert got == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def test_edge_rows_and_documents(spark):
    rows = [(1, None, None, 1), (2, "", "a", 1), (None, "one two", "a", 1), (3, "x " * 100, "b", 1), (3, "x " * 100, "b", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size int")
    got = mixing.mix(df).collect()
    assert len(got) == 5 and sum(r.size for r in got) == 202
    out = mixing.mixed_documents(df)
    assert out.columns == df.columns
    copies = {}
    for r in mixing.mix(df).collect():
        copies[r.doc_id] = copies.get(r.doc_id, 0) + r.copies
    count = {}
    for r in out.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {k: v for k, v in copies.items() if v}
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_documents(df.limit(0)).count() == 0
    empty = spark.createDataFrame([(1, "", "a"), (2, None, "b")], "doc_id long, text string, source string")
    assert [(r.taken, r.target) for r in mixing.mix(empty).collect()] == [(0, 0.0), (0, 0.0)]
