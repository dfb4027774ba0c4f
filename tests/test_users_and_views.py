import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lenstrail.operators import profiles, trends, views


def at(day, second=0):
    return str(datetime(2010, 1, 1) + timedelta(days=day, seconds=second))


def test_segments_by_days(visits):
    data = []
    for days in (0, 7, 8, 30, 31):
        data += [(f"{days}a", f"u{days:02d}", at(0, 86399), "A"), (f"{days}b", f"u{days:02d}", at(days), "Unknown")]
    got = profiles.user_profiles(visits(data)).orderBy("user_id").collect()
    assert [r.days_active for r in got] == [0, 7, 8, 30, 31]
    assert [r.user_type for r in got] == ["Tourist"] * 2 + ["Recurring Visitor"] * 2 + ["Resident"]
    assert [r.label for r in got] == [0.0, 0.0, 0.0, 0.0, 1.0]
    assert [r.unique_rois for r in got] == [2] * 5  # Unknown is one of them
    assert got[2].photos_per_day == 2 / 9


def test_single_photo_and_default_date(visits):
    df = visits([("1", "a", at(0), "A"), ("2", "b", "0001-01-03 00:00:00", "A"), ("3", "b", at(0), "B")])
    table = profiles.user_profiles(df)
    got = {r.user_id: r for r in table.drop("first_seen", "last_seen").collect()}
    assert (got["a"].hour_stddev, got["a"].user_type) == (0.0, "Tourist")
    assert got["b"].user_type == "Resident"
    later = profiles.user_profiles(df, min_year=2000).filter("user_id = 'b'").first()
    assert later.user_type == "Tourist"


def test_many_regions_make_a_user_relevant(visits):
    df = visits([(str(i), "u", at(0, i), f"R{i}") for i in range(5)])
    assert profiles.user_profiles(df).first()["label"] == 1.0


def test_histogram_leaves_out_long_stays(spark):
    df = spark.createDataFrame([(d,) for d in (0, 12, 13, 364, 365)], "days_active int")
    assert rows(profiles.days_active_hist(df)) == [(0, 2), (13, 1), (364, 1)]


def brute_moves(data, types):
    out = Counter()
    by_user = {}
    for _, user, ts, roi in data:
        if roi != "Unknown":
            by_user.setdefault(user, []).append((ts, roi))
    for user, seq in by_user.items():
        seq.sort()
        for (_, a), (_, b) in zip(seq, seq[1:]):
            if a != b:
                out[a, b, types.get(user)] += 1
    return sorted(((a, b, t, n) for (a, b, t), n in out.items()), key=repr)


@pytest.mark.parametrize("partitions", [1, 7])
def test_od_matrix_with_a_dominant_user(spark, visits, partitions):
    rnd = random.Random(partitions)
    data = []
    for i in range(3000):
        # one user holds a third of all rows, and a third of theirs share one second
        user = "hot" if i % 3 == 0 else f"u{rnd.randrange(40)}"
        second = 0 if user == "hot" and rnd.random() < 0.3 else rnd.randrange(86400 * 9)
        data.append((str(i), user, at(0, second), rnd.choice(["A", "B", "C", "Unknown"])))
    types = {"hot": "Resident", **{f"u{i}": rnd.choice(["Tourist", "Resident"]) for i in range(39)}}
    users = spark.createDataFrame(list(types.items()), "user_id string, user_type string")
    df = visits(data).repartition(partitions)
    assert rows(views.od_matrix(df, users)) == brute_moves(data, types)

    heat = Counter((r, int(t[11:13]), types.get(u)) for _, u, t, r in data if r != "Unknown")
    assert rows(views.hourly_heatmap(df, users)) == sorted(((*k, n) for k, n in heat.items()), key=repr)


def test_od_matrix_edges(spark, visits):
    data = [
        ("1", "one", at(0), "A"),  # a single photo
        ("2", "stay", at(0), "A"),
        ("3", "stay", at(5), "A"),  # same region again
        ("4", "days", at(0, 86399), "A"),
        ("5", "days", at(1, 0), "B"),  # over midnight
        ("6", "days", at(400), "Unknown"),
        ("7", "days", at(900), "A"),  # a gap, and an unknown place in between
    ]
    users = spark.createDataFrame([("days", "Tourist")], "user_id string, user_type string")
    assert rows(views.od_matrix(visits(data), users)) == [("A", "B", "Tourist", 1), ("B", "A", "Tourist", 1)]


def test_gems_keep_regions_of_recurring_visitors(spark, visits):
    df = visits(
        [("1", "t", at(0), "A"), ("2", "r", at(0), "A"), ("3", "r", at(0), "A"), ("4", "v", at(0), "B")]
    )
    users = spark.createDataFrame(
        [("t", "Tourist"), ("r", "Resident"), ("v", "Recurring Visitor")], "user_id string, user_type string"
    )
    want = [("A", 1, 2, 3, 0.75), ("B", 0, 0, 0, 1.0)]
    assert rows(views.hidden_gems(df, users)) == want
    assert rows(views.hidden_gems_from_heatmap(views.hourly_heatmap(df, users))) == want
    assert rows(views.local_spots(views.hidden_gems(df, users), 1)) == [("B", 1.0)]


def test_peak_hour_grain(spark):
    heat = spark.createDataFrame(
        [("A", 9, "Tourist", 5), ("A", 10, "Tourist", 4), ("A", 10, "Resident", 4), ("B", 3, "x", 2), ("B", 2, "y", 2)],
        "roi string, hour int, user_type string, count bigint",
    )
    assert rows(views.peak_hour(heat)) == [("A", 9, 5), ("B", 2, 2)]
    assert rows(views.peak_hour(heat, per="total")) == [("A", 10, 8), ("B", 2, 2)]


def test_trends(spark, visits):
    df = visits(
        [("1", "a", "1999-12-31 23:59:59", "A"), ("2", "a", "2000-01-01 00:00:00", "B"), ("3", "b", at(0), "Unknown")]
    )
    assert rows(trends.yearly_trend(df)) == [(2000, 1), (2010, 1)]
    assert rows(trends.top_rois(df, 1)) == [("A", 1)]
    assert rows(trends.top_users(df, 1)) == [("a", 2)]
    assert rows(trends.overview_kpis(df)) == [(3, 2, 1999, 2010, 2)]
    assert rows(trends.overview_kpis(df.limit(0))) == [(0, 0, None, None, 0)]
    timed = df.withColumn("day_name", F.date_format("timestamp", "EEEE")).withColumn("hour", F.hour("timestamp"))
    week = trends.weekday_counts(timed).collect()
    assert [(r.day_name, r["count"]) for r in week] == [
        ("Monday", 0), ("Tuesday", 0), ("Wednesday", 0), ("Thursday", 0), ("Friday", 2), ("Saturday", 1), ("Sunday", 0),
    ]
    grid = trends.day_hour_grid(timed)
    assert grid.count() == 168
    assert grid.agg(F.sum("count")).first()[0] == 3


def test_filters(spark):
    df = spark.createDataFrame(
        [("2010", 1, "A"), ("2011", 2, "B"), ("2012", 2, None)], "year string, month int, roi string"
    )
    assert trends.filter_photos(df).count() == 3
    assert rows(trends.filter_photos(df, years=[2011, 2012], months=[2], rois=["B"])) == [("2011", 2, "B")]
    assert rows(trends.filter_values(df, ["month", "roi"])) == [
        ("month", "1"), ("month", "2"), ("roi", "A"), ("roi", "B"),
    ]


def test_relevance_model_learns_its_rule(spark):
    rnd = random.Random(1)
    data = []
    for i in range(400):
        days, rois = rnd.randrange(80), rnd.randrange(1, 9)
        data.append((f"u{i}", 10, rois, days, 10 / (days + 1), 1.0 if days > 30 or rois > 4 else 0.0))
    table = spark.createDataFrame(
        data,
        "user_id string, total_photos bigint, unique_rois bigint, days_active int, photos_per_day double, label double",
    )
    predicted = profiles.user_relevance_model(table, num_trees=10)
    assert 40 < predicted.count() < 130
    assert profiles.accuracy(predicted).first()["accuracy"] > 0.9
