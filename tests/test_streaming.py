import datetime as dt

from conftest import rows
from lenstrail.config import ROIS
from lenstrail.streaming import hourly

PHOTO = "photo_id string, timestamp timestamp, latitude double, longitude double"
HERE, THERE = ROIS[0].centre, ROIS[1].centre


def arrive(spark, folder, photos):
    data = [(str(i), t, *at) for i, (t, at) in enumerate(photos)]
    spark.createDataFrame(data, PHOTO).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, out, late):
    counts = hourly.hourly_rois(hourly.photo_stream(spark, folder, PHOTO), late=late)
    query = hourly.keep_updates(counts, out)
    query.awaitTermination()
    return query, {(r.hour.isoformat(), r.roi): r["count"] for r in hourly.latest(spark, out).collect()}


def at(day, hour, minute=0):
    return dt.datetime(2010, 5, day, hour, minute)


def test_counts_go_on_over_batches_and_restarts(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [(at(1, 9, 5), HERE), (at(1, 9, 50), HERE), (at(1, 10), THERE), (at(1, 10), (41.7, 12.3)), (dt.datetime(1, 1, 3), HERE)])
    _, first = run(spark, folder, out, "1 day")
    assert first == {("2010-05-01T09:00:00", "Colosseo"): 2, ("2010-05-01T10:00:00", "Vaticano"): 1}
    arrive(spark, folder, [(at(1, 9, 59), HERE), (at(1, 11), HERE)])
    query, both = run(spark, folder, out, "1 day")
    assert both == first | {("2010-05-01T09:00:00", "Colosseo"): 3, ("2010-05-01T11:00:00", "Colosseo"): 1}
    assert query.lastProgress is None or query.lastProgress.batchId >= 1
    _, again = run(spark, folder, out, "1 day")  # nothing new
    assert again == both


def test_late_photos_are_dropped_and_their_state_with_them(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    arrive(spark, folder, [(at(1, 9), HERE), (at(2, 9), HERE)])
    run(spark, folder, out, "1 hour")
    arrive(spark, folder, [(at(1, 9, 30), HERE), (at(2, 8, 30), HERE), (at(3, 9), HERE)])
    query, got = run(spark, folder, out, "1 hour")
    # The first is behind the watermark (one hour before the latest photo of the batch before).
    assert got == {(f"2010-05-0{d}T0{h}:00:00", "Colosseo"): 1 for d, h in ((1, 9), (2, 9), (2, 8), (3, 9))}
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    kept = [s.numRowsTotal for p in query.recentProgress for s in p.stateOperators][-1]
    assert dropped >= 1 and kept < 4


def test_no_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    _, got = run(spark, str(tmp_path / "in"), str(tmp_path / "out"), "1 hour")
    assert got == {}
    assert rows(hourly.latest(spark, str(tmp_path / "never"))) == []
