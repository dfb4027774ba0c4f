import numpy as np

from lenstrail.llm import embedding_dedup as E


def brute(rows, cosine=0.9):
    good = {}
    for k, (_, v) in enumerate(rows):
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good[k] = np.array(v, float) / np.linalg.norm(np.array(v, float))
    links = {k: [j for j in good if j != k and len(good[j]) == len(good[k]) and good[j] @ good[k] >= cosine] for k in good}
    out = {}
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[rows[k][0]] = (len(links.get(k, ())), min(rows[j][0] for j in seen))
    return out


def corpus(n=400, width=48, seed=1):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        kind = i % 4
        v = rng.standard_normal(width)
        if kind and rows:
            base = np.array(rows[rng.integers(len(rows))][1])
            v = base + rng.standard_normal(width) * np.linalg.norm(base) / np.sqrt(width) * rng.choice([0.0, 0.2, 0.45, 0.5])
        rows.append((int(i * 3 + 2), [float(np.float32(x)) for x in v]))
    return rows


def check(spark, rows):
    got = {r.vec_id: r for r in E.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)).collect()}
    want = brute(rows)
    assert {k: (r.n_links, r.component_id) for k, r in got.items()} == want
    assert all(r.kept == (k == r.component_id) for k, r in got.items())


def test_equals_brute_force(spark):
    check(spark, corpus())


def test_crowded_buckets_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(E, "BLOCK", 8)
    check(spark, corpus(160, seed=2))


def test_edge_rows(spark):
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [float("nan"), 1.0]), (6, [1.0, 0.0]), (7, [1.0, 0.0]), (8, [2.0, 0.1]), (9, [1.0])]
    check(spark, rows)
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, kept int")
    assert E.near_vectors(df).count() == 0


def test_transform_keeps_lengths():
    x = np.random.default_rng(0).standard_normal((5, 16)).astype(np.float32)
    y = E.hadamard(x)
    assert np.allclose((y**2).sum(1), 16 * (x**2).sum(1), rtol=1e-5)
    assert np.allclose(E.hadamard(y), 16 * x, atol=1e-4)


def test_recall_of_the_plan():
    k, tables = E.plan(50_000, 64, 0.9, 0.9995)
    assert 1 - (1 - E.chance(64, k, 0.9)) ** tables > 0.999


def test_forest_gives_the_least_index_of_each_group():
    low = E.forest(7, np.array([5, 3, 6, 6]), np.array([3, 1, 4, 6]))
    assert low.tolist() == [0, 1, 2, 1, 4, 1, 4]
    assert E.forest(0, np.zeros(0, int), np.zeros(0, int)).tolist() == []
