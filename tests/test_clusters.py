import random

import pytest

from conftest import rows
from lenstrail.operators import clusters, summary


def frame(spark, pts, cluster="int"):
    return spark.createDataFrame(pts, f"cluster {cluster}, latitude double, longitude double")


def brute_hull(pts):
    """Points that are not inside or on an edge: every other point lies left of some line."""
    pts = sorted(set(pts))
    vertices = set()
    for a in pts:
        for b in pts:
            if a == b:
                continue
            sides = [(b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0]) for p in pts]
            on_line = [p for p, s in zip(pts, sides) if s == 0]
            if all(s >= 0 for s in sides) and {a, b} == {min(on_line), max(on_line)}:
                vertices |= {a, b}
    return vertices


@pytest.mark.parametrize("partitions", [1, 6])
def test_hulls_equal_brute_force(spark, partitions):
    rnd = random.Random(partitions)
    clouds = {c: [(rnd.randrange(12), rnd.randrange(12)) for _ in range(60)] for c in (1, 2)}
    clouds[3] = [(rnd.randrange(3), 7) for _ in range(20)]  # one line
    clouds[4] = [(0, 0), (0, 1), (1, 0)]  # too few
    clouds[5] = [(0, 0), (0, 1), (1, 0), (1, 0)]  # four photos, three places
    pts = [(c, float(lat), float(lon)) for c, cloud in clouds.items() for lon, lat in cloud]
    pts += [(9, None, 1.0), (None, 1.0, 1.0)]
    got = {}
    for r in clusters.cluster_hulls(frame(spark, pts).repartition(partitions)).collect():
        got.setdefault(r.cluster, []).append((r.idx, r.lon, r.lat))
    assert set(got) == {1, 2, 5}
    for c, found in got.items():
        ring = [(lon, lat) for _, lon, lat in sorted(found)]
        assert set(ring) == brute_hull(clouds[c])
        assert ring[0] == min(ring)
        turns = [
            (b[0] - a[0]) * (d[1] - b[1]) - (b[1] - a[1]) * (d[0] - b[0])
            for a, b, d in zip(ring, ring[1:] + ring[:1], ring[2:] + ring[:2])
        ]
        assert all(t > 0 for t in turns)


def test_labels(spark):
    pts = [(0, 41.89, 12.4925), (0, 41.89, 12.4925), (1, 42.1, 12.7)]
    got = clusters.cluster_labels(frame(spark, pts))
    assert rows(got.select("cluster", "label", "photos")) == [
        (0, "Colosseo (Cl. 0)", 2),
        (1, "Outer zone (Cl. 1)", 1),
    ]
    named = clusters.label_points(frame(spark, [*pts, (7, 1.0, 1.0)]), got)
    assert {r.label for r in named.collect()} == {"Colosseo (Cl. 0)", "Outer zone (Cl. 1)", None}


def test_nearest_prefers_the_earlier_centre(spark):
    df = frame(spark, [(9, 0.0, 1.0), (9, 0.0, 1.9), (9, None, 1.0)]).drop("cluster")
    got = clusters.assign_nearest(df, [(5, 0.0, 0.0), (6, 0.0, 2.0)])
    assert [r.cluster for r in got.collect()] == [5, 6, None]


def test_kmeans_finds_separate_groups(spark):
    rnd = random.Random(4)
    centres = [(41.7, 12.3), (41.9, 12.5), (42.1, 12.7)]
    pts = [
        (i % 3, centres[i % 3][0] + rnd.gauss(0, 0.002), centres[i % 3][1] + rnd.gauss(0, 0.002)) for i in range(300)
    ]
    df = frame(spark, pts + [pts[0]] * 200).withColumnRenamed("cluster", "truth")
    found = clusters.kmeans_clusters(df, k=3)
    pairs = {(r.truth, r.cluster) for r in found.collect()}
    assert len(pairs) == 3 and len({p[1] for p in pairs}) == 3
    assert clusters.silhouette(found, fraction=1).first()[0] > 0.95
    assert clusters.silhouette(found, fraction=0.5).first()[0] > 0.9
    assert sum(r["count"] for r in clusters.cluster_sizes(found).collect()) == 500


def test_summary(spark):
    clustered = spark.createDataFrame(
        [(0, "A"), (0, "A"), (1, "B"), (2, "Unknown")], "cluster int, roi string"
    )
    timed = spark.createDataFrame([("u", "2010"), ("u", "2011"), ("v", "2011"), ("w", "2010")], "user_id string, year string")
    assert summary.exec_summary(clustered, timed, n=2).collect() == [
        ("total_photos", 1, None, 4, None),
        ("top_cluster", 1, "0", 2, 0.5),
        ("top_cluster", 2, "1", 1, 0.25),
        ("mapped_photos", 1, None, 3, None),
        ("top_roi", 1, "A", 2, None),
        ("top_roi", 2, "B", 1, None),
        ("peak_year", 1, "2010", 2, None),
        ("top_user", 1, None, 2, None),
    ]
    empty = summary.exec_summary(clustered.limit(0), timed.limit(0)).collect()
    assert [(r.section, r.value) for r in empty] == [("total_photos", 0), ("mapped_photos", 0), ("top_user", None)]
