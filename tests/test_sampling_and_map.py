import hashlib
import random
from collections import Counter

import pytest

from conftest import rows
from lenstrail.operators import density, sampling


def digest(key):
    return hashlib.md5(("" if key is None else key).encode()).hexdigest()


@pytest.mark.parametrize("partitions", [1, 7])
@pytest.mark.parametrize("n", [0, 1, 100, 999, 1000, 5000])
def test_exact_sample(spark, n, partitions):
    data = [(str(i), i) for i in range(1000)]
    df = spark.createDataFrame(data, "id string, v int").repartition(partitions)
    want = sorted(data, key=lambda r: digest(r[0]))[:n]
    assert rows(sampling.exact_sample(df, "id", n, hex_digits=2)) == sorted(want, key=repr)


@pytest.mark.parametrize("n", [10, 400, 700, 899])
def test_exact_sample_with_copies(spark, n):
    data = [("same", 1)] * 300 + [("same", 2)] * 50 + [(str(i), i) for i in range(500)] + [(None, 0)] * 50
    df = spark.createDataFrame(data, "id string, v int")
    got = Counter(tuple(r) for r in sampling.exact_sample(df, "id", n, hex_digits=1).collect())
    want = Counter(sorted(data, key=lambda r: (digest(r[0]), r[1]))[:n])
    assert got == want


@pytest.mark.parametrize("n", [1, 350, 420, 899, 1000])
@pytest.mark.parametrize("digits, most", [(1, 10), (4, 10), (2, 70)])
def test_exact_sample_refines_the_edge(spark, n, digits, most):
    """One key holds most rows, all different; no task sorts more than `most` of them."""
    data = [("same", v % 350) for v in range(400)] + [(str(i), i) for i in range(500)] + [(None, None)] * 20
    df = spark.createDataFrame(data, "id string, v int").repartition(6)
    got = Counter(tuple(r) for r in sampling.exact_sample(df, "id", n, hex_digits=digits, most=most).collect())
    assert got == Counter(sorted(data, key=lambda r: (digest(r[0]), r[1] or 0))[:n])


def test_ranges_of_one_key_are_small(spark):
    rows = spark.range(5000).selectExpr("'k' AS _md5", "id % 1250 AS v", "id AS w", "1L AS _copies")
    kept, need = sampling._edge_range(rows, ["v", "w"], 2600, 200)
    sizes = {r["_range"]: r["count"] for r in kept.groupBy("_range").count().collect()}
    assert max(sizes.values()) <= 200 and 0 < need <= sizes[0]
    assert sum(n for r, n in sizes.items() if r < 0) + need == 2600


def test_hash_split_is_complete_and_stable(spark):
    df = spark.range(1000).withColumnRenamed("id", "user_id")
    a, b = sampling.hash_split(df, "user_id", 0.8)
    c, _ = sampling.hash_split(df.repartition(7), "user_id", 0.8)
    assert a.count() + b.count() == 1000
    assert 700 < a.count() < 900
    assert rows(a) == rows(c)


def test_bernoulli_sample(spark):
    df = spark.range(2000)
    assert 200 < sampling.bernoulli_sample(df, 0.2, 3).count() < 600


def nearest_hexagon(lat, lon, radius):
    """Brute force: the closest of all hexagon centres around the point."""
    x, y = (lon - 12.49) * 82870.0, (lat - 41.89) * 111320.0
    r0 = round(y / (1.5 * radius))
    best = None
    for r in range(r0 - 2, r0 + 3):
        q0 = round(x / (3**0.5 * radius) - r / 2)
        for q in range(q0 - 2, q0 + 3):
            cx, cy = radius * 3**0.5 * (q + r / 2), radius * 1.5 * r
            d = (cx - x) ** 2 + (cy - y) ** 2
            best = min(best or (d, q, r), (d, q, r))
    return best[1:]


def test_hexagons_are_the_nearest_centres(spark):
    rnd = random.Random(2)
    pts = [(rnd.uniform(41.88, 41.90), rnd.uniform(12.48, 12.50)) for _ in range(400)] + [(None, 12.5)]
    df = spark.createDataFrame(pts, "latitude double, longitude double")
    for radius in (10, 80):
        want = Counter(nearest_hexagon(lat, lon, radius) for lat, lon in pts if lat is not None)
        got = {(r.hq, r.hr): r["count"] for r in density.hexbin_density(df, radius_m=radius).collect()}
        assert got == want


def test_centres_and_view(spark):
    df = spark.createDataFrame(
        [("A", "1", "2"), ("A", "3", "4"), ("B", "bad", "0"), ("Unknown", "1", "1"), ("C", "5", "5")],
        "roi string, latitude string, longitude string",
    )
    pts = density.map_points(df)
    assert rows(density.roi_centres(pts)) == [("A", 2.0, 3.0, 2), ("C", 5.0, 5.0, 1)]
    assert rows(density.roi_centres(pts, top=1)) == [("A", 2.0, 3.0, 2)]
    assert rows(density.view_centre(pts.limit(0))) == [(41.89, 12.49, 0)]
