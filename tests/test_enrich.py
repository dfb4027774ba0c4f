import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from lenstrail.config import ROIS, Roi
from lenstrail.operators import cells, enrich
from lenstrail.operators.cells import box_cells
from lenstrail.sources.tables import roi_table


def points(spark, values):
    return spark.createDataFrame(
        [(str(i), lat, lon) for i, (lat, lon) in enumerate(values)],
        "photo_id string, latitude double, longitude double",
    )


def edges(rois):
    for r in rois:
        for lat in (r.lat_min, r.lat_max, r.lat_min - 1e-9, r.lat_max + 1e-9):
            for lon in (r.lon_min, r.lon_max, r.lon_min - 1e-9, r.lon_max + 1e-9):
                yield lat, lon


def by_hand(lat, lon, rois):
    if lat is None or lon is None:
        return "Unknown"
    return next(
        (r.name for r in rois if r.lat_min <= lat <= r.lat_max and r.lon_min <= lon <= r.lon_max), "Unknown"
    )


OVERLAPPING = (
    Roi("small", 41.90, 41.91, 12.50, 12.51),
    Roi("large", 41.89, 41.95, 12.45, 12.55),
    Roi("cross", 41.88, 41.96, 12.505, 12.507),
)


@pytest.mark.parametrize("rois", [ROIS, OVERLAPPING])
@pytest.mark.parametrize(
    "options",
    [
        {"strategy": "case"},
        {"strategy": "grid"},
        {"strategy": "grid", "max_broadcast_cells": 0},
        {"strategy": "grid", "max_broadcast_cells": 0, "busy": 40},
    ],
)
def test_strategies_agree_with_plain_loop(spark, rois, options):
    rnd = random.Random(5)
    values = [*edges(rois), (None, 12.5), (41.9, None), (0.0, 0.0)]
    values += [(rnd.uniform(41.88, 41.92), rnd.uniform(12.44, 12.52)) for _ in range(500)]
    values += [(41.905, 12.506)] * 300  # a third of the rows in one place
    got = enrich.enrich_roi(points(spark, values), rois, **options)
    assert got.columns == ["photo_id", "latitude", "longitude", "roi"]
    assert {r["photo_id"]: r["roi"] for r in got.collect()} == {
        str(i): by_hand(lat, lon, rois) for i, (lat, lon) in enumerate(values)
    }
    assert got.count() == len(values)


def test_many_boxes_take_the_grid(spark):
    many = [Roi(f"r{i}", 41 + i * 0.001, 41.0009 + i * 0.001, 12.0, 12.001) for i in range(100)]
    got = enrich.enrich_roi(points(spark, [(41.0505, 12.0005), (42.5, 12.0)]), many)
    assert [r["roi"] for r in got.orderBy("photo_id").collect()] == ["r50", "Unknown"]


def random_boxes(n, seed):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        lat, lon = rnd.uniform(-89, 89), rnd.uniform(-179, 179)
        tall, wide = (rnd.choice([0.0, 10 ** rnd.uniform(-5, 1.5)]) for _ in range(2))
        out.append(Roi(f"r{i}", lat, lat + tall, lon, lon + wide))
    return [*out, Roi("world", -90.0, 90.0, -180.0, 180.0)] if seed % 2 else out


@pytest.mark.parametrize("seed, options", [(1, {}), (2, {"max_broadcast_cells": 0, "busy": 30})])
def test_boxes_of_all_sizes(spark, seed, options):
    rois = random_boxes(150, seed)
    rnd = random.Random(seed + 10)
    corners = [(r.lat_min, r.lon_max) for r in rois] + [r.centre for r in rois]
    values = corners + [(rnd.uniform(-90, 90), rnd.uniform(-180, 180)) for _ in range(100)] + [(None, None)]
    got = enrich.enrich_roi(points(spark, values), rois, strategy="grid", **options)
    assert {r["photo_id"]: r["roi"] for r in got.collect()} == {str(i): by_hand(lat, lon, rois) for i, (lat, lon) in enumerate(values)}


@pytest.mark.parametrize("options", [{}, {"max_broadcast_cells": 0, "busy": 30}])
@pytest.mark.parametrize("most", [16, 1])
def test_overlapping_boxes_leave_short_lists(spark, monkeypatch, options, most):
    monkeypatch.setattr(cells, "MOST", most, raising=False)
    lengths, cut = [], cells.cut_lineage

    def watched(df):
        out = cut(df)
        if "boxes" in out.columns:
            lengths.append(out.agg(F.max(F.size("boxes"))).first()[0])
        return out

    monkeypatch.setattr(cells, "cut_lineage", watched)
    rnd = random.Random(3)
    rois = []
    for i in range(1500):
        side, lat, lon = 0.2 / 2 ** rnd.randrange(6), rnd.uniform(41.0, 41.3), rnd.uniform(12.0, 12.3)
        rois.append(Roi(f"r{i}", lat, lat + side, lon, lon + side * rnd.randint(1, 3)))
    rois += [Roi(f"same{i}", 41.35, 41.45, 12.35, 12.45) for i in range(300)]
    values = [(r.lat_min, r.lon_max) for r in rois[::20]] + [(r.lat_max, r.lon_min) for r in rois[7::20]]
    values += [(rnd.uniform(40.9, 41.6), rnd.uniform(11.9, 12.6)) for _ in range(300)] + [(None, 12.1)]
    got = enrich.enrich_roi(points(spark, values), rois, strategy="grid", **options)
    assert {r["photo_id"]: r["roi"] for r in got.collect()} == {str(i): by_hand(lat, lon, rois) for i, (lat, lon) in enumerate(values)}
    assert len(lengths) == 1 and lengths[0] <= 100  # 300 and more before


def test_a_box_lies_in_few_cells(spark):
    boxes = roi_table(spark, random_boxes(300, 1))
    filed = box_cells(boxes).select(F.explode("boxes.roi").alias("roi")).groupBy("roi").count()
    assert filed.count() == 301 and filed.agg(F.max("count")).first()[0] <= 9


def test_capture_stats(visits):
    df = visits([("1", "u", "2010-01-01 00:00:00", "A"), ("2", "u", "2010-01-01 00:00:00", "Unknown")])
    assert rows(enrich.roi_capture_stats(df)) == [(2, 1, 0.5)]
    assert rows(enrich.roi_capture_stats(df.limit(0))) == [(0, 0, 0.0)]


def test_time_features(visits):
    df = visits([("1", "u", "2024-02-04 23:59:59", "A"), ("2", "u", "0001-01-03 00:00:00", "A")])
    got = enrich.time_features(df).select("photo_id", "hour", "month", "day_of_week", "day_name", "year")
    assert rows(got) == [("1", 23, 2, 1, "Sunday", "2024"), ("2", 0, 1, 4, "Wednesday", "0001")]
