import hashlib
import random

import numpy as np

from lenstrail.llm import fingerprints as P


def data_of(text):
    return np.frombuffer(text.encode(), np.uint8)


def say(rng, n):
    return " ".join("".join(rng.choice("abcdefghé ") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_splice_equals_reading_anew():
    rng, powers = random.Random(1), P.Powers()
    rank = np.random.default_rng(1).permutation(P.CLASSES)
    for _ in range(60):
        a, b = say(rng, rng.randint(0, 90)), say(rng, rng.randint(0, 90))
        half = len(a) // 2
        keep, more = a[: len(a) - half], b[:half]
        got = P.spliced(P.Windows(data_of(a), rank, powers), len(keep.encode()), P.Windows(data_of(b), rank, powers), len(more.encode()), rank, powers)
        assert got.tolist() == P.Windows(data_of(keep + more), rank, powers).features().tolist()


def test_entropy_classes():
    rng = random.Random(2)
    data = data_of(say(rng, 30000))
    at = P.window_starts(data)
    got = P.entropy_classes(data, at, block=1000)
    for i in range(0, len(at), 97):
        _, n = np.unique(data[at[i] : at[i] + P.WINDOW], return_counts=True)
        bits = -(n / P.WINDOW * np.log2(n / P.WINDOW)).sum()
        assert abs(got[i] - min(bits / 6 * P.CLASSES, P.CLASSES - 1)) <= 1.01


def test_likeness():
    rng, powers = random.Random(3), P.Powers()
    rank = np.arange(P.CLASSES)
    base = say(rng, 3000)
    f = lambda t: P.filters(P.Windows(data_of(t), rank, powers).features())
    x = f(base)
    assert len(x) > 1 and P.likeness(x, x) == 1
    assert (P.decoded(P.encoded(x)) == x).all()
    assert P.likeness(x, f(base[:100] + "new" + base[100:])) > 0.9
    assert P.likeness(x, f(say(rng, 3000))) < 0.1
    assert P.likeness(f(""), f("")) == 1 and P.likeness(f(""), x) == 0


def test_rows_follow_each_other(spark):
    rng = random.Random(4)
    rows = [(i * 5, say(rng, rng.randint(0, 120)), "x") for i in range(150)]
    rows += [(901, None, "n"), (902, "", "e"), (903, "ab", "s"), (None, say(rng, 50), "null id")]
    rows.append((9000, rows[3][1], "copy"))
    mixed = rows[:]
    rng.shuffle(mixed)
    df = spark.createDataFrame(mixed, "doc_id long, text string, fingerprint string").repartition(6)
    got = {r.doc_id: r for r in P.fingerprint(df).collect()}
    order = sorted(rows, key=lambda r: -10 if r[0] is None else r[0], reverse=True)
    assert len(got) == len(rows)
    for (doc_id, text, _), after in zip(order, order[1:] + order[:1], strict=True):
        text, more = text or "", after[1] or ""
        edited = text[: len(text) - len(text) // 2] + more[: len(text) // 2]
        r = got[doc_id]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert abs(r.near_next - P.likeness(P.decoded(r.fingerprint), P.decoded(got[after[0]].fingerprint))) < 1e-9
    assert got[9000].fingerprint == got[15].fingerprint


def test_few_rows(spark):
    df = spark.createDataFrame([(4, "abcdefgh" * 20)], "doc_id long, text string")
    (r,) = P.fingerprint(df).collect()
    assert r.near_next == 1 and r.n_chars == 160
    assert P.fingerprint(df.limit(0)).count() == 0


def test_every_window_counts():
    rng, powers = random.Random(5), P.Powers()
    data = data_of(say(rng, 200))
    assert P.window_starts(data).tolist() == list(range(len(data) - P.WINDOW + 1))
    rank = np.random.default_rng(5).permutation(P.CLASSES)
    rarity = P.Windows(data, rank, powers).rarity
    runs = np.lib.stride_tricks.sliding_window_view(rarity, P.RUN)
    assert (P._rarest(rarity, P.RUN) == runs.argmin(axis=1) + np.arange(len(runs))).all()
    apart = 0
    for _ in range(300):  # half of a short text is replaced
        a, b, c = (say(rng, 80).encode()[:150] for _ in range(3))
        one, two = (P.Windows(np.frombuffer(x, np.uint8), rank, powers).features() for x in (a + b, a + c))
        apart += not np.isin(one, two).any()
    assert apart <= 30
