"""The corpus pipeline: every stage on rows of all kinds against what it should keep, and the run as a whole."""

import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lenstrail.llm import mixing, toxicity
from lenstrail.llm.catalog import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, copies int, text_key string"


def documents(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefghijkl") for _ in range(rng.randint(3, 8))) for _ in range(900)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = say(60)
    rows = []
    for i in range(90):
        text = say(rng.randint(15, 60))
        if i % 6 == 0:
            text = f"{text} horrid vilest nasty horrid {say(5)}"
        if i % 9 == 1:
            text = f"{say(10)}. {passage}. {say(12)}"
        if i % 10 == 3 and rows:
            text = rng.choice(rows)[1] or text  # an exact copy
        if i % 10 == 7 and rows:
            text = (rng.choice(rows)[1] or text) + " ending"  # a near copy
        rows.append((i * 2, text, "en", "abc"[i % 3]))
    rows += [(200, None, None, None), (202, "", "en", "a"), (None, "no id here at all", "en", "b"), rows[4], rows[4], (204, " \n ", "en", None)]
    return [(d, t, lang, s, len(t or ""), True, 7, "x") for d, t, lang, s in rows]


def labels():
    return [(i * 2, 1, int(i % 6 == 0)) for i in range(90)]


@pytest.fixture
def folder(spark, tmp_path):
    spark.createDataFrame(documents(), SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels(), "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def table(df):
    return Counter(tuple(r) for r in df.collect())


def shingles(text, k=5):
    w = re.findall(r"\w+", (text or "").lower())
    return {tuple(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))} if w else set()


def classes(rows, threshold=0.8):
    """Least doc_id (NULL last) of every group that links of similar texts reach."""
    key = lambda d: (d is None, d or 0)
    rows = [r for r in rows if shingles(r[1])]
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9 and group[i] != group[j]:
                group = [group[i] if g == group[j] else g for g in group]
    return {min((rows[i][0] for i in range(len(rows)) if group[i] == g), key=key) for g in set(group)}


def trimmed(rows, gram=100):
    """Texts without the bytes of strings of `gram` bytes that also start earlier."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - gram + 1):
            if data[i : i + gram] in seen:
                gone[i : i + gram] = b"\1" * gram
            seen.add(data[i : i + gram])
        out[doc_id] = bytes(b for b, g in zip(data, gone, strict=True) if not g).decode()
    return out


def test_stages_keep_what_they_should(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    done = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs
        out = stage(spark, docs, folder)
        assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = done[name] = spark.read.parquet(f"{folder}/{name}")
        if name == "toxicity":
            bad = {r.doc_id for r in toxicity.toxicity(before, spark.read.parquet(f"{folder}/labels.parquet")).collect() if r.predicted}
            assert table(docs) == Counter({r: n for r, n in table(before).items() if r[0] not in bad})
            assert 5 < len(bad) < 25
        elif name == "ngram_join":
            rows = [(r.doc_id, r.text) for r in before.distinct().collect()]
            wanted = classes(rows)
            assert Counter(r.doc_id for r in docs.collect() if (r.text or "").split()) == Counter({d: 1 for d in wanted})
            assert {None if r.text is None else r.text for r in docs.collect() if not (r.text or "").split()} == {None, "", " \n "}
        elif name == "suffix_dedup":
            want = trimmed([(r.doc_id, r.text) for r in before.collect()])
            assert {r.doc_id: r.text or "" for r in docs.collect()} == want
            assert any(len(t) < len(r.text or "") for r in before.collect() for t in [want[r.doc_id]])
        elif name == "mixing":
            want = Counter({r.doc_id: r.copies for r in mixing.mix(before).collect() if r.copies})
            assert Counter(r.doc_id for r in docs.collect()) == want
    assert not {r.doc_id for r in done["mixing"].collect()} - {r.doc_id for r in done["suffix_dedup"].collect()}


def test_run_packs_every_token_of_what_is_kept(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
    tokens = Tokenizer.from_file(tokenizer_path())
    want = Counter()
    for r in docs.collect():
        want[r.doc_id] += len(tokens.encode(r.text or "", add_special_tokens=False).ids) + 1
    pieces = corpus_pipeline.run(spark, folder).collect()
    got = Counter()
    for p in pieces:
        got[p.doc_id] += p.length
    assert got == want
    assert len({(p.sequence_id, p.offset) for p in pieces}) == len(pieces) and all(p.offset + p.length <= 2048 for p in pieces)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
