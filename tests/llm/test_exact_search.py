import math

import numpy as np
import pytest

from lenstrail.llm import exact_search as S

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, k=5, every=50, scale=256):
    kept = [(i, [math.floor(scale * float(np.float32(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (q, v) in enumerate(kept):
        if q is None or q % every:
            continue
        found = [(-sum(x * y for x, y in zip(v, w, strict=True)), c is None, c or 0, c) for b, (c, w) in enumerate(kept) if a != b and len(w) == len(v)]
        out += [(q, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def got(df, **options):
    return sorted((tuple(r) for r in S.top_k(df, **options).collect()), key=repr)


def vectors(n, width, seed, step=0.0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        v = rng.standard_normal(width) * 0.3
        v = np.round(v / step) * step if step else v
        rows.append((int(i * 11 % n), [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize(("step", "bins", "slot", "group"), [(0.0, 1024, 65536, 16384), (0.5, 4, 10, 2), (0.5, 64, 40, 3)])
def test_against_all_scores_sorted(spark, step, bins, slot, group):
    rows = vectors(260, 6, 5, step)
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(4), bins=bins, slot=slot, group=group) == brute(rows)


def test_ties_copies_and_rows_without_part(spark):
    rows = vectors(60, 4, 6, 0.5)
    rows += [(0, rows[0][1])] * 3 + [(50, [1.0] * 4)] * 2 + [(50, [0.5] * 4), (7, rows[0][1])]
    rows += [(None, [9.0] * 4), (None, rows[1][1]), (100, None), (150, [None] * 4), (200, [float("inf")] * 4), (250, [2.0, 1.0]), (3, [0.5, 0.5])]
    rows += [(300, [0.0] * 4), (-50, [1.0, 0.0, 0.0, 0.0])]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(3)) == brute(rows)


def test_one_vector_repeats_in_most_rows(spark):
    rows = [(i, [0.5, 0.5]) for i in range(2000)] + [(2000, [0.75, 0.75])]
    out = got(spark.createDataFrame(rows, SCHEMA).repartition(8), slot=100)
    assert len(out) == 41 * 5 and [r for r in out if r[0] == 2000] == [(2000, r + 1, r, 49152) for r in range(5)]
    assert {r[2] for r in out if r[0] == 50} == {2000, 0, 1, 2, 3}


def test_few_partners_empty_vectors_and_none(spark):
    df = spark.createDataFrame([(0, [1.0], "a"), (50, [2.0], "b"), (100, [], "c"), (150, [], "d")], SCHEMA + ", score string")
    assert got(df) == [(0, 1, 50, 131072), (100, 1, 150, 0), (150, 1, 100, 0), (50, 1, 0, 131072)]
    assert got(df.limit(0)) == [] and got(df.where("vec_id % 50 = 1")) == []
    assert got(df.where("vec_id = 0")) == []
    assert S.top_k(df.limit(0)).columns == ["query_id", "rank", "vec_id", "score"]


def test_large_components(spark):
    rows = [(i, [float(2**17 - i), float(i - 2**17)]) for i in range(51)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    with pytest.raises(ValueError, match="beyond"):
        S.top_k(spark.createDataFrame([(0, [1e12])], SCHEMA))
