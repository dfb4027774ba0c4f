import hashlib
import math

import numpy as np
import pytest

from lenstrail.llm import vector_codes as V

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    size = len(kept[0][1]) // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    cut = lambda v, p: v[p * size : (p + 1) * size]
    books = [[cut(r[1], p) for r in first] for p in range(parts)]

    def nearest(v, p):
        d = [sum((a - b) ** 2 for a, b in zip(cut(v, p), e, strict=True)) for e in books[p]]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(parts):
            code = [nearest(v, p)[0] for _, v, _ in kept]
            for e in range(len(first)):
                mine = [cut(v, p) for (_, v, _), c in zip(kept, code, strict=True) if c == e]
                if mine:
                    books[p] = [*books[p][:e], [sum(x) // len(mine) for x in zip(*mine, strict=True)], *books[p][e + 1 :]]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for i, v, lab in kept:
        near = [nearest(v, p) for p in range(parts)]
        out.append((i, "".join(f"{c:02x}" for c, _ in near), sum(d for _, d in near), lab))
    total = {}
    for _, _, error, lab in out:
        total[lab] = total.get(lab, 0) + error
    return sorted(((i, c, e, total[lab], sha) for i, c, e, lab in out), key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in V.vector_codes(df, **options).collect()), key=repr)


def vectors(n, width, seed, step=None):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(width) * 0.2
        v = np.round(v / step) * step if step else v
        rows.append((int(i * 7 % n), [float(np.float32(x)) for x in v], int(i % 3) if i % 5 else None))
    return rows


@pytest.mark.parametrize("step", [None, 0.1])  # coarse steps give many ties
def test_against_plain_lloyd(spark, step):
    rows = vectors(300, 16, 1, step)
    rows += [(5, None, 1), (6, [None] + [0.1] * 15, 1), (7, [float("nan")] * 16, 2), (8, [float("-inf")] * 16, 2)]
    rows += [rows[3]] * 20 + [(None, [0.5] * 16, None), (rows[0][0], [0.25] * 16, 9)]
    for parts in (1, 5):
        assert got(spark.createDataFrame(rows, SCHEMA).repartition(parts)) == brute(rows)


def test_active_entries_give_what_a_full_scan_gives():
    rng = np.random.default_rng(2)
    points = rng.integers(-6, 7, (500, 3))
    entries = rng.integers(-6, 7, (16, 3))
    code, distance = V.assign(points, entries, np.ones(16, bool), None, None)
    for _ in range(40):
        after = entries.copy()
        some = rng.random(16) < 0.3
        after[some] += rng.integers(-2, 3, (int(some.sum()), 3))
        moved = (after != entries).any(axis=1)
        entries = after
        code, distance = V.assign(points, entries, moved, code, distance)
        full, exact = V.assign(points, entries, moved, None, None)
        assert (code == full).all() and (distance == exact).all()


def test_few_vectors_empty_vectors_and_none(spark):
    rows = vectors(5, 8, 3)
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    none = spark.createDataFrame([(1, [], 2), (2, [], None)], SCHEMA)
    assert [r[1:4] for r in got(none)] == [("00" * 8, 0, 0)] * 2
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(df.limit(0)) == [] and got(df.where("embedding IS NULL")) == []
    assert V.vector_codes(df.limit(0)).columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


def test_clashing_columns_and_vectors_that_do_not_fit(spark):
    rows = vectors(40, 8, 4)
    wide = spark.createDataFrame([(*r, "c", 1, b"x") for r in rows], SCHEMA + ", code string, error int, components binary")
    assert got(wide) == brute(rows)
    with pytest.raises(ValueError, match="components"):
        V.vector_codes(spark.createDataFrame([(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], SCHEMA))
    with pytest.raises(ValueError, match="multiple"):
        V.vector_codes(spark.createDataFrame([(1, [0.0] * 9, 1)], SCHEMA))
    with pytest.raises(ValueError, match="beyond"):
        V.vector_codes(spark.createDataFrame([(1, [1e9] * 8, 1)], SCHEMA))
