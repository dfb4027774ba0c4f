import hashlib
import random

import numpy as np
import pytest

import corpus_pipeline
from lenstrail.llm import suffix_dedup as S

GRAM = S.GRAM


def brute(rows):
    """Result per distinct (doc_id, text); rows come in corpus order."""
    seen, out = set(), {}
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - GRAM + 1):
            gram = data[i : i + GRAM]
            if gram in seen:
                gone[i : i + GRAM] = True
            seen.add(gram)
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out[doc_id, text] = (len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeé ü") for _ in range(rng.randint(1, 6))) for _ in range(60)]
    say = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage, base = say(60), say(200)
    rows = []
    for i in range(60):
        kind = i % 6
        if kind == 0:
            text = say(rng.randint(0, 80)) + passage + say(rng.randint(0, 80))
        elif kind == 1:
            text = base
        elif kind == 2:
            at = rng.randint(0, len(base))
            text = base[:at] + say(3) + base[at:]
        elif kind == 3:
            text = rng.choice(["a", "ab", "abc "]) * rng.randint(0, 300)
        elif kind == 4:
            text = say(rng.randint(0, 200))
        else:
            text = passage[rng.randint(0, 40) :] + passage
        rows.append((i * 7, text))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    got = S.digest(spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)).collect()
    want = brute(rows)
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id, texts[r.doc_id]], r.doc_id


def test_crowded_minimizers_part(spark, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2)
    rows = corpus(5)
    got = S.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, texts = brute(rows), dict(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id, texts[r.doc_id]]


def test_a_crowded_string_does_not_meet_in_one_sort(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(S, "HOT", 2)
    sort, log = S.repeated_grams, str(tmp_path / "sorted")

    def logged(strings, rank):
        with open(log, "a") as f:
            f.write(f"{sum(map(len, strings))}\n")
        return sort(strings, rank)

    monkeypatch.setattr(S, "ONE_SORT", 8_000, raising=False)
    monkeypatch.setattr(S, "repeated_grams", logged)
    rng = random.Random(7)
    say = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    line = say(180)
    rows = [(i, say(60) + line + say(60)) for i in range(400)]
    got = S.digest(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want, texts = brute(rows), dict(rows)
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id, texts[r.doc_id]]
    with open(log) as f:
        assert max(map(int, f)) <= 8_000  # all copies of one string have 40 000 bytes


def test_the_pipeline_stage_cuts_a_crowded_line_in_small_sorts(spark, tmp_path, monkeypatch):
    sort, log = S.repeated_grams, str(tmp_path / "sorted")

    def logged(strings, rank):
        with open(log, "a") as f:
            f.write(f"{sum(map(len, strings))}\n")
        return sort(strings, rank)

    monkeypatch.setattr(S, "HOT", 2)
    monkeypatch.setattr(S, "ONE_SORT", 8_000, raising=False)
    monkeypatch.setattr(S, "repeated_grams", logged)
    line = "".join(random.Random(2).choice("abcdefgh ") for _ in range(180))
    rows = [(i, hashlib.sha256(b"%d" % i).hexdigest() + line + hashlib.sha256(b"-%d" % i).hexdigest()) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, texts = brute(rows), dict(rows)
    for r in corpus_pipeline.cut_repeats(spark, docs, "").collect():
        assert hashlib.sha256(r.text.encode()).hexdigest() == want[r.doc_id, texts[r.doc_id]][3]
    with open(log) as f:
        assert max(map(int, f)) <= 8_000


@pytest.mark.parametrize("collide", [False, True])
def test_more_bytes_than_one_sort_takes(monkeypatch, collide):
    monkeypatch.setattr(S, "ONE_SORT", 700)
    if collide:
        mixed = S.mixed
        monkeypatch.setattr(S, "mixed", lambda x: mixed(x) % np.uint64(40))
    rng = random.Random(11)
    say = lambda n: bytes(rng.choice(b"abc") for _ in range(n))
    line = say(130)
    strings = [say(rng.randint(0, 90)) + line[rng.randint(0, 25) :] + say(rng.randint(0, 90)) for _ in range(60)]
    strings += [b"ab" * 90, b"ab" * 70, line, say(100)]
    rank = [(rng.randint(0, 5), i, 0) for i in range(len(strings))]
    got = S.crowded_grams(strings, rank)
    want = S.repeated_grams(strings, rank)
    assert [g.tolist() for g in got] == [sorted(w.tolist()) for w in want]


def test_edge_rows_and_columns(spark):
    long = "x1y2" * 60
    rows = [(1, None, "a"), (2, "", "b"), (None, long, "c"), (3, long, None), (3, long, "twice"), (4, long + "!", "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_removed string")
    got = {(r.doc_id, r.text): r for r in S.dedup(df).collect()}
    assert S.dedup(df).count() == 6
    want = brute([(1, None), (2, ""), (3, long), (4, long + "!"), (None, long)])
    for key, value in want.items():
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == value, key
    assert S.dedup(df.limit(0)).count() == 0


def test_trimmed_text_is_valid(spark):
    a = "äöü" * 40
    df = spark.createDataFrame([(1, a, 9), (2, "x" + a, 9)], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in S.trimmed_documents(df).collect()}
    assert out[2].text[0] == "x" and out[2].n_chars == len(out[2].text)
    assert S.trimmed_documents(df).columns == df.columns


def test_suffix_sort_and_prefixes():
    rng = random.Random(3)
    for _ in range(40):
        n = rng.choice([1, 2, 7, 60, 500])
        letters = rng.choice([b"a", b"ab", b"abcz"])
        data = np.frombuffer(bytes(rng.choice(letters) for _ in range(n)), np.uint8)
        order = S.suffix_array(data)
        raw = data.tobytes()
        parts = [raw[i : i + GRAM] for i in order]
        assert sorted(order.tolist()) == list(range(n)) and parts == sorted(parts)
        common = S.common_prefixes(data, order)
        for k in range(1, n):
            same = 0
            while same < min(len(parts[k]), len(parts[k - 1])) and parts[k][same] == parts[k - 1][same]:
                same += 1
            assert common[k] == same
