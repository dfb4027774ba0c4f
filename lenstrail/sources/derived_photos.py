"""Raw photo records derived from the `events` and `documents` tables.

The test tables hold no photos, so every event becomes one raw record: valid or broken,
inside a region, elsewhere in the city or outside, by integer arithmetic on its ids.  The
tags are the distinct tokens of a whole document.  All rows and whole texts are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lenstrail.config import CITY_BOX, ROIS
from lenstrail.sources.tables import spread

_BOXES = [roi[1:] for roi in ROIS] + [CITY_BOX, CITY_BOX]


def _micro(degrees: float) -> int:
    return round(degrees * 1_000_000)


def _coordinate(low: int, high: int, step: Column, outside: int) -> Column:
    """Degrees from whole micro-degrees, so that box edges are hit exactly."""
    slot = ((F.col("event_id") * 7 + F.col("user_id")) % 12).cast("int")
    lows = F.array(*[F.lit(_micro(b[low])).cast("bigint") for b in _BOXES])
    spans = F.array(*[F.lit(_micro(b[high]) - _micro(b[low])).cast("bigint") for b in _BOXES])
    inside = F.get(lows, slot) + F.floor(F.get(spans, slot) * step / 1000)
    odd = F.col("event_id") % 3
    broken = F.when(odd == 0, F.lit(0).cast("bigint")).when(odd == 2, F.lit(outside).cast("bigint"))
    return F.when(slot == 11, broken).otherwise(inside) / 1_000_000.0


def derive_photos(spark: SparkSession, folder: str) -> DataFrame:
    """Nested raw records, one per event."""
    events = spread(spark.read.parquet(f"{folder}/events.parquet"))
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    event, user = F.col("event_id"), F.col("user_id")
    cohort = user % 3
    shifted = F.timestamp_add("DAY", -(event % 5800).cast("int"), F.col("ts"))
    taken = F.when(cohort == 0, shifted).otherwise(F.col("ts"))
    week = F.floor((F.dayofmonth("ts") - 1) / 7)
    owner = (
        F.when(event % 97 == 0, None)
        .when(cohort == 1, F.format_string("u%d-%d", user, week))
        .otherwise(F.format_string("u%d", user))
    )
    date_text = (
        F.when(event % 89 == 0, "not a date")
        .when((event % 83 == 0) & (user % 10 == 0), "0001-01-03 00:00:00")
        .when(event % 2 == 0, F.date_format(taken, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.date_format(taken, "MMM d, yyyy h:mm:ss a"))
    )
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    words = documents.select("doc_id", F.array_distinct(F.split("text", " ")).alias("words"))
    doc_count = documents.agg(F.count("*")).scalar()
    events = events.withColumn("doc_id", event % doc_count).join(words, "doc_id", "left")
    no_words = F.array().cast("array<string>")
    own = F.concat(F.coalesce("words", no_words), F.array(F.lit("Rome"), F.upper("event_type")))
    values = F.when(event % 17 == 0, None).when(event % 13 == 0, no_words).otherwise(own)
    return events.select(
        event.cast("string").alias("id"),
        F.struct(owner.alias("id")).alias("owner"),
        F.concat_ws(" ", "event_type", event.cast("string")).alias("title"),
        date_text.alias("dateTaken"),
        F.struct(
            _coordinate(0, 1, (event * 7919) % 1001, 45_460_000).alias("latitude"),
            _coordinate(2, 3, (event * 104729) % 1001, 9_190_000).alias("longitude"),
        ).alias("geoData"),
        F.transform(values, lambda v: F.struct(v.alias("value"))).alias("tags"),
    )
