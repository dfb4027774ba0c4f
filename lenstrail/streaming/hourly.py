"""Photos per region and hour as a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from lenstrail.config import FIRST_REAL_YEAR, ROIS, Roi
from lenstrail.functions.columns import from_year, is_known_roi
from lenstrail.operators.enrich import enrich_roi
from lenstrail.sources.tables import read_or_empty

HOURS = "hour timestamp, roi string, count long"


def photo_stream(spark: SparkSession, path: str, schema: StructType | str, *, files: int = 1) -> DataFrame:
    """Photos as their Parquet files arrive in a folder, at most `files` in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def hourly_rois(
    photos: DataFrame, *, late: str, rois: Sequence[Roi] = ROIS, min_year: int = FIRST_REAL_YEAR
) -> DataFrame:
    """Counts (hour, roi, count) of photos in known regions, from `min_year` on (1970 at the earliest,
    where Spark's watermark starts).

    The state holds one count per hour and region that may still change.  A photo more than `late` behind
    the latest one seen in earlier micro-batches is dropped, and its hour leaves the state.
    """
    timely = photos.where(from_year(min_year)).withWatermark("timestamp", late)
    placed = enrich_roi(timely, rois, strategy="case").where(is_known_roi())
    return (
        placed.groupBy(F.window("timestamp", "1 hour").alias("window"), "roi")
        .agg(F.count("*").alias("count"))
        .select(F.col("window.start").alias("hour"), "roi", "count")
    )


def keep_updates(counts: DataFrame, out: str) -> StreamingQuery:
    """Writes what each micro-batch changed to a partition of `out` and ends when all files are read.

    A micro-batch that runs again replaces its own partition, so a restart after a loss counts nothing
    twice.  Progress lies beside the table and a later call goes on from there.
    """

    def store(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{out}/updates/batch={batch}")

    return (
        counts.writeStream.outputMode("update")
        .option("checkpointLocation", f"{out}/progress")
        .trigger(availableNow=True)
        .foreachBatch(store)
        .start()
    )


def latest(spark: SparkSession, out: str) -> DataFrame:
    """The table that the updates add up to: the last count written for each hour and region."""
    updates = read_or_empty(spark, f"{out}/updates", f"{HOURS}, batch long")
    return updates.groupBy("hour", "roi").agg(F.max_by("count", "batch").alias("count"))
