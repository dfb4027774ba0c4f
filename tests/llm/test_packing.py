import random
import zlib

import numpy as np
import pytest

from lenstrail.llm import packing
from lenstrail.llm.tokens import WordTokenizer

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path("word_bpe_49k.json")


def ids_of(text):
    return tokenizers.Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids


TEXTS = ["", "don't <|endoftext|> x", "naïve ÀÉ ß µ ² 12 ½ it's...''s", "日本 语", "á é İ Σς", "x\x85y\xa0z", "\x1c a\x0bb", "We'RE'll 'S", "A" * 500]


def test_ids_equal_the_tokenizers():
    rng = random.Random(1)
    letters = "abcdeABC éÉßñ.,!?'\"-_0123²¼ªº\n\t$%"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(rng.randint(0, 300))) for _ in range(300)]
    for got, text in zip(WordTokenizer(PATH, most_words=50).encode(texts), texts, strict=True):
        assert got.tolist() == ids_of(text)


def brute_cost(ends, penalty, window):
    at, best = [0, *ends], [0.0]
    powers = {window >> k for k in range(4)}
    for j in range(1, len(at)):
        costs = []
        for i in range(j):
            n = at[j] - at[i]
            if n <= window:
                costs.append(best[i] + (0 if n in powers else window - n))
        best.append(min(costs) + (penalty[j - 1] if j < len(at) - 1 else 0))
    return best[-1]


@pytest.mark.parametrize("seed", range(12))
def test_cuts_have_the_least_cost(seed):
    rng = np.random.default_rng(seed)
    ends = np.cumsum(rng.integers(1, 20, 60))
    penalty = rng.choice([0.0, 1.0, 7.0], 60)
    cuts = packing.best_cuts(ends, penalty, 32)
    at = [0, *ends[cuts].tolist()]
    lengths = np.diff(at)
    assert at[-1] == ends[-1] and (lengths <= 32).all()
    cost = sum(0 if n in (32, 16, 8, 4) else 32 - n for n in lengths) + penalty[cuts[:-1]].sum()
    assert cost == brute_cost(ends.tolist(), penalty.tolist(), 32)


def test_every_id_lies_in_one_piece(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(rng.randint(1, 9)))
    texts = TEXTS + [" ".join(word() + rng.choice(["", "", "."]) for _ in range(rng.randint(0, 900))) for _ in range(150)]
    texts += [None, "abc " * 30_000]
    rows = [(i, t, 1) for i, t in enumerate(texts)] + [(None, "no id", 1), (7, texts[7], 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int").repartition(3)
    pieces = packing.pack(df, PATH).collect()
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    for doc_id, text, _ in rows:
        ids = np.array([*ids_of(text or ""), 1], "<u4")
        copies = 2 if doc_id == 7 else 1
        parts = sorted(by_doc[doc_id], key=lambda p: p.start)
        assert sum(p.length for p in parts) == copies * len(ids)
        for p in parts:
            assert p.doc_tokens == len(ids) and p.length > 0
            assert p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
        if copies == 1:
            assert [p.start for p in parts] == np.cumsum([0, *[p.length for p in parts][:-1]]).tolist()
    padding = total = 0
    for parts in by_sequence.values():
        parts.sort(key=lambda p: p.offset)
        assert [p.offset for p in parts] == np.cumsum([0, *[p.length for p in parts][:-1]]).tolist()
        n = sum(p.length for p in parts)
        assert n <= 2048
        total += n
        padding += 0 if n & (n - 1) == 0 else 2048 - n
    assert padding < 0.05 * total
    assert packing.pack(df.limit(0), PATH).count() == 0
