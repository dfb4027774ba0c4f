"""Facts that trained results must satisfy, stays with gaps, sketches, and the report of the writing pass."""

import datetime as dt
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from conftest import rows
from lenstrail.operators import clean, clusters, profiles, trends, views
from lenstrail.sources.tables import own_session


def some_visits(n=400, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        t = dt.datetime(2010, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 6 * 24 * 60, 30))
        out.append((str(i), rnd.choice("abc"), t.strftime("%Y-%m-%d %H:%M:%S"), rnd.choice(["A", "B", "C", "Unknown"])))
    return out


def by_user(data, known_only):
    users = {}
    for _, user, t, roi in data:
        if roi != "Unknown" or not known_only:
            users.setdefault(user, []).append((dt.datetime.fromisoformat(t), roi))
    return {u: sorted(set(v)) if known_only else sorted(v) for u, v in users.items()}


@pytest.mark.parametrize("hours", [1, 6, 30, None])
def test_moves_within_a_gap(spark, visits, hours):
    data = some_visits(90)
    types = spark.createDataFrame([(u, u.upper()) for u in "abc"], "user_id string, user_type string")
    want = {}
    for user, seen in by_user(data, True).items():
        for (t, a), (u, b) in zip(seen, seen[1:], strict=False):
            if a != b and (hours is None or u - t <= dt.timedelta(hours=hours)):
                want[a, b, user.upper()] = want.get((a, b, user.upper()), 0) + 1
    gap = hours and hours * 3600
    got = {tuple(r)[:3]: r.weight for r in views.od_matrix(visits(data).repartition(5), types, max_gap=gap).collect()}
    assert got == want


@pytest.mark.parametrize("hours", [1, 7])
def test_stays_go_on_over_midnight(visits, hours):
    data = some_visits(120)
    want = []
    for user, seen in by_user(data, False).items():
        stay = [seen[0][0]]
        for t, _ in seen[1:]:
            if t - stay[-1] > dt.timedelta(hours=hours):
                want.append((user, stay[0], stay[-1], len(stay)))
                stay = []
            stay.append(t)
        want.append((user, stay[0], stay[-1], len(stay)))
    got = [(r.user_id, r.first, r.last, r.photos) for r in views.stays(visits(data).repartition(4), max_gap=hours * 3600).collect()]
    assert sorted(got) == sorted(want)
    assert any(first.date() != last.date() for _, first, last, _ in want)


def test_sketches_merge(spark):
    df = spark.range(40_000).select(
        F.concat(F.lit("u"), (F.col("id") % 9000).cast("string")).alias("user_id"),
        F.concat(F.lit("r"), (F.col("id") % 3).cast("string")).alias("roi"),
        F.timestamp_seconds(F.col("id") % 5 * 86_400).alias("timestamp"),
    )
    sketches = trends.user_sketches(df).repartition(7)
    (whole,) = trends.sketched_overview(sketches).collect()
    assert whole.photos == 40_000 and abs(whole.users - 9000) < 9000 * 0.05
    one = trends.sketched_overview(sketches.where("day >= '1970-01-03'"), "roi").collect()
    exact = {r.roi: r.n for r in df.where("timestamp >= '1970-01-03'").groupBy("roi").agg(F.count_distinct("user_id").alias("n")).collect()}
    assert all(abs(r.users - exact[r.roi]) <= exact[r.roi] * 0.05 for r in one) and len(one) == 3
    assert rows(trends.sketched_overview(sketches.limit(0))) == [(0, 0)]


RAW = "id string, owner struct<id: string>, title string, dateTaken string, geoData struct<latitude: string, longitude: string>, tags array<struct<value: string>>"


def test_report_of_the_pass_that_writes(spark, tmp_path):
    data = [(str(i), (None if i % 7 == 0 else "u",), "t", "2010-01-01 00:00:00" if i % 5 else "?", (str(41.9 if i % 3 else 0), "12.5"), None) for i in range(500)]
    spark.createDataFrame(data, RAW).write.parquet(str(tmp_path / "raw"))
    raw = own_session(spark).read.parquet(str(tmp_path / "raw"))
    cleaning = clean.Cleaning(raw)
    cleaning.photos.write.parquet(str(tmp_path / "clean"))
    assert rows(cleaning.report(spark)) == rows(clean.clean_report(raw))
    assert cleaning.report(spark).first().clean == spark.read.parquet(str(tmp_path / "clean")).count()
    none = clean.Cleaning(raw.limit(0))
    none.photos.write.parquet(str(tmp_path / "none"))
    assert rows(none.report(spark)) == rows(clean.clean_report(raw.limit(0)))


def test_forest_as_rows_gives_its_predictions_here_and_in_duckdb(spark, tmp_path):
    rnd = random.Random(2)
    data = [(f"u{i}", rnd.randrange(1, 200), rnd.randrange(1, 9), rnd.randrange(0, 90)) for i in range(400)]
    users = spark.createDataFrame([(u, n, r, d, n / (d + 1), float(d > 30) if i % 9 else 1.0) for i, (u, n, r, d) in enumerate(data)],
                                  "user_id string, total_photos long, unique_rois long, days_active int, photos_per_day double, label double")
    model, test = profiles.fit_relevance(users, num_trees=11)
    want = {r.user_id: r.prediction for r in model.transform(test).collect()}
    nodes = profiles.forest_nodes(model, str(tmp_path / "model"))
    assert {r.user_id: r.prediction for r in profiles.route(test, nodes).collect()} == want
    assert len(set(want.values())) == 2
    nodes.write.parquet(str(tmp_path / "nodes"))
    test.select("user_id", *profiles.MODEL_FEATURES).write.parquet(str(tmp_path / "users"))
    found = duckdb.connect().execute(f"""
        WITH RECURSIVE nodes AS (SELECT * FROM '{tmp_path}/nodes/*.parquet'), users AS (SELECT * FROM '{tmp_path}/users/*.parquet'),
        way AS (
          SELECT user_id, tree, 0 AS node FROM users, (SELECT DISTINCT tree FROM nodes)
          UNION ALL
          SELECT a.user_id, a.tree, CASE WHEN CASE feature WHEN 'total_photos' THEN total_photos WHEN 'unique_rois' THEN unique_rois
            WHEN 'days_active' THEN days_active ELSE photos_per_day END <= threshold THEN n.left ELSE n.right END
          FROM way a JOIN nodes n USING (tree, node) JOIN users u ON u.user_id = a.user_id WHERE n.feature IS NOT NULL)
        SELECT user_id, CASE WHEN sum(votes[2]) > sum(votes[1]) THEN 1.0 ELSE 0.0 END
        FROM way JOIN nodes n USING (tree, node) WHERE n.feature IS NULL GROUP BY user_id""").fetchall()
    assert {u: float(p) for u, p in found} == want


def test_facts_of_centres_and_silhouette(spark):
    rnd = random.Random(5)
    data = [(41.8 + 0.1 * (i % 3) + rnd.gauss(0, 0.004), 12.4 + 0.1 * (i % 3) + rnd.gauss(0, 0.004)) for i in range(600)]
    df = spark.createDataFrame(data, "latitude double, longitude double")
    centres = clusters.fit_centres(df, k=3)
    facts = clusters.centre_facts(clusters.assign_nearest(df, centres), centres).collect()
    assert sum(f.photos for f in facts) == 600 and all(f.strays == 0 and f.offset < 1e-3 for f in facts)
    moved = [(i, lat + 0.2, lon) for i, lat, lon in centres]
    assert max(f.offset for f in clusters.centre_facts(clusters.assign_nearest(df, centres), moved).collect()) > 0.1
    wrong = clusters.assign_nearest(df, centres).withColumn("cluster", (F.col("cluster") + 1) % 3)
    assert all(f.strays == f.photos for f in clusters.centre_facts(wrong, centres).collect())
    for clustered in (clusters.assign_nearest(df, centres), df.withColumn("cluster", F.floor(F.rand(1) * 4).cast("int"))):
        stored = clustered.cache()
        assert abs(clusters.exact_silhouette(stored).first()[0] - clusters.silhouette(stored).first()[0]) < 1e-9
    one = df.withColumn("cluster", F.lit(1))
    assert clusters.exact_silhouette(one).first()[0] == 0.0
