from pyspark.sql import functions as F

from conftest import rows
from lenstrail.config import Box
from lenstrail.functions.columns import parse_timestamp
from lenstrail.operators import clean

# As a scan with a schema of its own would give them: coordinates as numbers.
RAW = (
    "id string, owner struct<id: string>, title string, dateTaken string, "
    "geoData struct<latitude: double, longitude: double>, tags array<struct<value: string>>"
)

ISO = "2010-05-01 10:11:12"


def raw(spark, *records):
    """Records as (id, user, date, lat, lon, tags)."""
    return spark.createDataFrame(
        [
            (i, (u,) if u else None, "t", d, (lat, lon), [(t,) for t in tags] if tags is not None else None)
            for i, u, d, lat, lon, tags in records
        ],
        RAW,
    )


def test_timestamp_formats(spark):
    texts = {
        ISO: "2010-05-01 10:11:12",
        "May 1, 2010 1:02:03 PM": "2010-05-01 13:02:03",
        "Dec 31, 2010 12:00:00 AM": "2010-12-31 00:00:00",
        "0001-01-03 00:00:00": "0001-01-03 00:00:00",
        "2010-5-1 10:11:12": None,
        "2010-05-01": None,
        "May 1, 2010 1:02:03\u202fPM": None,
        " 2010-05-01 10:11:12": None,
        "not a date": None,
        "": None,
        None: None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    parsed = df.select("text", F.date_format(parse_timestamp(F.col("text")), "yyyy-MM-dd HH:mm:ss"))
    assert dict(rows(parsed)) == texts
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        plain = F.coalesce(
            F.try_to_timestamp("text", F.lit("yyyy-MM-dd HH:mm:ss")),
            F.try_to_timestamp("text", F.lit("MMM d, yyyy h:mm:ss a")),
        )
        same = df.filter(~plain.eqNullSafe(parse_timestamp(F.col("text"))))
        assert same.count() == 0
    spark.conf.set("spark.sql.ansi.enabled", "true")


def test_validity_rules_and_report(spark):
    df = raw(
        spark,
        ("ok", "u", ISO, 41.9, 12.5, ["a"]),
        ("edge", "u", ISO, 41.6, 12.8, None),
        ("nouser", None, ISO, 41.9, 12.5, []),
        ("nodate", "u", "x", 41.9, 12.5, []),
        ("nolat", "u", ISO, None, 12.5, []),
        ("zero", "u", ISO, 41.9, 0.0, []),
        ("out", "u", ISO, 42.2000001, 12.5, []),
    )
    assert [r[0] for r in rows(clean.clean_photos(df).select("photo_id"))] == ["edge", "ok"]
    assert {r[0] for r in rows(clean.clean_photos(df, box=None).select("photo_id"))} == {"edge", "ok", "out"}
    report = clean.clean_report(df).first().asDict()
    assert report == {
        "raw": 7,
        "clean": 2,
        "dropped": 5,
        "no_user": 1,
        "bad_date": 1,
        "no_position": 1,
        "zero_position": 1,
        "outside_city": 1,
        "drop_pct": 500 / 7,
    }
    assert clean.clean_report(df.limit(0)).first()["drop_pct"] == 0.0
    assert clean.clean_photos(df, box=Box(42.2, 43, 12, 13)).count() == 1


def test_tags_become_plain_text(spark):
    df = raw(spark, ("1", "u", ISO, 41.9, 12.5, ["a", "B"]), ("2", "u", ISO, 41.9, 12.5, None))
    assert rows(clean.clean_photos(df).select("photo_id", "tags")) == [("1", ["a", "B"]), ("2", None)]


def test_alias_resolution(spark):
    df = spark.createDataFrame([("x", "y")], "DateTaken string, id string")
    names = ("dateTaken", "DateTaken", "datetaken")
    assert clean.resolve_alias(df, names, "t").first().asDict() == {"t": "x", "id": "y"}
    assert clean.resolve_alias(df.drop("DateTaken"), names, "t").first()["t"] is None
    both = df.toDF("datetaken", "DateTaken")
    assert clean.resolve_alias(both, names, "t").first().asDict() == {"t": "y"}
