import random
import zlib

import numpy as np

from lenstrail.llm import quality, toxicity


def corpus(n=900, seed=1):
    rng = random.Random(seed)
    syllables = ["er", "on", "th", "in", "ea", "st", "re", "an"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 120))]
        good, toxic = i % 3 != 0, i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rng.randrange(len(words))] = rng.choice(["vilezo", "grubak", "nastib"]) + rng.choice(["", "ta", "mi"])
        text = " ".join(words) if good else " ".join(w.upper() + "!!" for w in words)
        docs.append((i, text, "en"))
        if i % 2 == 0:
            labels.append((i, int(good), int(toxic)))
    return docs, labels


def frames(spark, docs, labels):
    return (
        spark.createDataFrame(docs, "doc_id long, text string, score string").repartition(3),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_quality_on_held_out_rows(spark):
    docs, labels = corpus()
    got = {r.doc_id: r for r in quality.quality(*frames(spark, docs, labels)).collect()}
    assert len(got) == len(docs)
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7)
    right = [got[i].predicted == int(i % 3 != 0) for i, r in got.items() if r.held_out]
    assert np.mean(right) > 0.97


def test_toxicity_on_held_out_rows(spark):
    docs, labels = corpus(seed=2)
    got = {r.doc_id: r for r in toxicity.toxicity(*frames(spark, docs, labels)).collect()}
    for r in got.values():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
    right = [got[i].predicted == int(i % 5 == 0) for i, r in got.items() if r.held_out]
    assert np.mean(right) > 0.95


def test_held_out_labels_do_not_matter(spark):
    docs, labels = corpus(300)
    for module, n, out in ((quality.quality, 4, 2), (toxicity.toxicity, 3, 1)):
        changed = [(d, 1 - q, 1 - t) if zlib.crc32(str(d).encode()) % n == out else (d, q, t) for d, q, t in labels]
        one, two = (sorted((r.doc_id, r.score) for r in module(*frames(spark, docs, x)).collect()) for x in (labels, changed))
        assert one == two


def test_edge_rows(spark):
    docs, labels = corpus(200)
    odd = [(None, "erer", "x"), (5000, None, "x"), (5001, "", "x"), (5002, "word " * 50_000, "x"), (3, docs[3][1], "x")]
    bad_labels = [(None, 1, 1), (2, None, None), (99_999, 1, 1), (4, 0, 0), (4, 0, 0)]
    for module in (quality.quality, toxicity.toxicity):
        got = module(*frames(spark, docs + odd, labels + bad_labels)).collect()
        assert len(got) == 205 and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if r.doc_id in (5000, 5001)}) == 1
        d, none = frames(spark, docs, [])
        assert module(d, none).count() == 200
        assert module(d.limit(0), none).count() == 0


def test_risk_never_goes_below_zero():
    """With positives hidden among the unlabelled the classifier still finds them."""
    rng = np.random.default_rng(3)
    positive = (rng.random((300, 20)) < np.r_[[0.6] * 4, [0.1] * 16]).astype(float)
    hidden = (rng.random((300, 20)) < np.r_[[0.6] * 4, [0.1] * 16]).astype(float)
    negative = (rng.random((700, 20)) < 0.1).astype(float)
    w, b = toxicity.train(positive, np.vstack((hidden, negative)), 0.3)
    z = lambda x: x @ w + b
    assert (z(hidden) > 0).mean() > 0.8 and (z(negative) > 0).mean() < 0.1


def test_clean_documents_keep_columns(spark):
    docs, labels = corpus(300)
    d, l = frames(spark, docs, labels)
    out = toxicity.clean_documents(d, toxicity.fit(d, l))
    assert out.columns == d.columns
    gone = {i for i, _, _ in docs} - {r.doc_id for r in out.collect()}
    assert len(gone & {i for i in range(0, 300, 5)}) > 50 and len(gone) < 65
