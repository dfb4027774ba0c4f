"""Cleaning of raw photo records: alias resolution, flattening, validity, report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lenstrail.config import CITY_BOX, DATE_FIELDS, DATE_FORMATS, Box
from lenstrail.functions.columns import in_box, parse_timestamp


def resolve_alias(df: DataFrame, names: Sequence[str], target: str) -> DataFrame:
    """Rename the first of `names` that exists to `target`; a NULL text column if none does.

    Names are compared exactly.  The other spellings are dropped, so the result has no
    ambiguous column even where names resolve without regard to case.
    """
    found = next((n for n in names if n in df.columns), None)
    if found is None:
        return df.withColumn(target, F.lit(None).cast("string"))
    spare = [f"_other_{i}" for i, n in enumerate(df.columns) if n in names and n != found]
    renamed = df.toDF(
        *[
            target if n == found else f"_other_{i}" if n in names else n
            for i, n in enumerate(df.columns)
        ]
    )
    return renamed.drop(*spare)


def flatten(
    raw: DataFrame,
    *,
    date_fields: Sequence[str] = DATE_FIELDS,
    formats: Sequence[str] = DATE_FORMATS,
) -> DataFrame:
    """Nested record to flat columns, with the capture date parsed; drops no row."""
    return resolve_alias(raw, date_fields, "_taken").select(
        F.col("id").alias("photo_id"),
        F.col("owner.id").alias("user_id"),
        F.col("title"),
        parse_timestamp(F.col("_taken"), formats).alias("timestamp"),
        F.col("geoData.latitude").try_cast("double").alias("latitude"),
        F.col("geoData.longitude").try_cast("double").alias("longitude"),
        F.col("tags.value").alias("tags"),
    )


def geofence(df: DataFrame, box: Box = CITY_BOX) -> DataFrame:
    return df.filter(in_box(box))


def clean_photos(
    raw: DataFrame,
    *,
    date_fields: Sequence[str] = DATE_FIELDS,
    formats: Sequence[str] = DATE_FORMATS,
    box: Box | None = CITY_BOX,
) -> DataFrame:
    """Photos with a user, a date and a usable position; `box=None` switches the geofence off.

    A narrow transformation: the output keeps the partitioning of the scan.
    """
    return _valid(flatten(raw, date_fields=date_fields, formats=formats), box)


def _valid(flat: DataFrame, box: Box | None) -> DataFrame:
    known = flat.filter(
        F.col("user_id").isNotNull()
        & F.col("timestamp").isNotNull()
        & F.col("latitude").isNotNull()
        & F.col("longitude").isNotNull()
        & (F.col("latitude") != 0.0)
        & (F.col("longitude") != 0.0)
    )
    return geofence(known, box) if box else known


def reject_reason(box: Box | None = CITY_BOX) -> Column:
    """First rule a flat record breaks; NULL for a valid one."""
    reason = (
        F.when(F.col("user_id").isNull(), "no_user")
        .when(F.col("timestamp").isNull(), "bad_date")
        .when(F.col("latitude").isNull() | F.col("longitude").isNull(), "no_position")
        .when((F.col("latitude") == 0.0) | (F.col("longitude") == 0.0), "zero_position")
    )
    return reason.when(~in_box(box), "outside_city") if box else reason


REASONS = ("no_user", "bad_date", "no_position", "zero_position", "outside_city")


def _counts(box: Box | None) -> list[Column]:
    reason = reject_reason(box)
    return [
        F.count(F.lit(1)).alias("raw"),
        F.count_if(reason.isNull()).alias("clean"),
        F.count(reason).alias("dropped"),
        *[F.count_if(reason == name).alias(name) for name in REASONS],
    ]


def _with_pct(counts: DataFrame) -> DataFrame:
    pct = F.coalesce(F.try_divide(F.col("dropped") * 100.0, F.col("raw")), F.lit(0.0))
    return counts.withColumn("drop_pct", pct)


def clean_report(
    raw: DataFrame,
    *,
    date_fields: Sequence[str] = DATE_FIELDS,
    formats: Sequence[str] = DATE_FORMATS,
    box: Box | None = CITY_BOX,
) -> DataFrame:
    """One row: raw, clean, dropped, drop_pct and one count per reject reason, in one pass."""
    return _with_pct(flatten(raw, date_fields=date_fields, formats=formats).agg(*_counts(box)))


class Cleaning:
    """Cleaned photos and, once an action has read them all, the report of the same pass.

    Use a frame of a session of its own (`tables.own_session`): in Spark 4.1 a session that has observed
    can no longer be shipped to executors, which fitted models try, as they hold the session they were fitted in.
    """

    def __init__(
        self,
        raw: DataFrame,
        *,
        date_fields: Sequence[str] = DATE_FIELDS,
        formats: Sequence[str] = DATE_FORMATS,
        box: Box | None = CITY_BOX,
    ):
        self._seen = Observation()
        flat = flatten(raw, date_fields=date_fields, formats=formats)
        self.photos = _valid(flat.observe(self._seen, *_counts(box)), box)

    def report(self, spark: SparkSession) -> DataFrame:
        """As `clean_report`, from what the first action on `photos` counted; waits for that action."""
        counts = self._seen.get
        names = ("raw", "clean", "dropped", *REASONS)
        row = [tuple(counts.get(n, 0) for n in names)]
        return _with_pct(spark.createDataFrame(row, ", ".join(f"{n} long" for n in names)))
