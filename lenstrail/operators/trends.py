"""Rankings, trends over time, and headline figures.

Dashboard figures leave out rows whose grouping key is NULL.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.config import FIRST_PLAUSIBLE_YEAR, FIRST_REAL_YEAR, WEEKDAYS
from lenstrail.functions.columns import from_year, is_known_roi


def top_rois(df: DataFrame, n: int | None = None) -> DataFrame:
    """Photos per known region, most photographed first."""
    ranked = (
        df.filter(is_known_roi())
        .groupBy("roi")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "roi")
    )
    return ranked if n is None else ranked.limit(n)


def yearly_trend(df: DataFrame, *, min_year: int = FIRST_REAL_YEAR) -> DataFrame:
    """Photos per calendar year from `min_year` on."""
    return (
        df.filter(from_year(min_year))
        .groupBy(F.year("timestamp").alias("year"))
        .agg(F.count("*").alias("count"))
        .orderBy("year")
    )


def top_users(df: DataFrame, n: int = 5) -> DataFrame:
    return (
        df.groupBy("user_id")
        .agg(F.count("*").alias("count"))
        .orderBy(F.desc("count"), "user_id")
        .limit(n)
    )


def overview_kpis(df: DataFrame, *, min_plausible_year: int = FIRST_PLAUSIBLE_YEAR) -> DataFrame:
    """One row: photos, users, regions seen, first and last plausible year.

    Two narrow passes: everything but the users comes from an aggregate with a row per
    region, and the distinct users from their column alone.  One aggregate with two
    distinct columns would expand every row instead.
    """
    year = F.year("timestamp")
    plausible = F.when(year >= min_plausible_year, year)
    per_roi = df.groupBy("roi").agg(
        F.count("*").alias("n"), F.min(plausible).alias("first"), F.max(plausible).alias("last")
    )
    users = df.agg(F.count_distinct("user_id")).scalar()
    return per_roi.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("photos"),
        F.count_if(is_known_roi()).alias("rois"),
        F.min("first").alias("first_year"),
        F.max("last").alias("last_year"),
    ).withColumn("users", users)


def user_sketches(df: DataFrame, *, lg_k: int = 12) -> DataFrame:
    """(roi, day, photos, users): photos and a mergeable sketch of their users, per region and day.

    A sketch has at most 2**lg_k bytes, however many users it stands for; NULL users count in photos only.
    """
    return df.groupBy("roi", F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("photos"), F.hll_sketch_agg("user_id", lg_k).alias("users")
    )


def sketched_overview(sketches: DataFrame, *by: str) -> DataFrame:
    """Photos and estimated users per `by`, from sketches that any filter may have thinned out.

    Sketches are merged, so a user of several days or regions counts once.  The standard error is
    about 1.04 / sqrt(2**lg_k), 1.6 % for 12.
    """
    return sketches.groupBy(*by).agg(
        F.coalesce(F.sum("photos"), F.lit(0)).alias("photos"),
        F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("users")), F.lit(0)).alias("users"),
    )


def filter_photos(
    df: DataFrame,
    *,
    years: Sequence[str] = (),
    months: Sequence[int] = (),
    user_types: Sequence[str] = (),
    rois: Sequence[str] = (),
    clusters: Sequence[int] = (),
) -> DataFrame:
    """Keep the listed values; an empty list leaves its column unfiltered."""
    wanted = {
        "year": [str(y) for y in years],
        "month": months,
        "user_type": user_types,
        "roi": rois,
        "cluster": clusters,
    }
    for column, values in wanted.items():
        if values:
            df = df.filter(F.col(column).isin(list(values)))
    return df


def filter_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct values of several columns as rows (column, value), in one pass.

    Distinct combinations come first, so that few rows are multiplied by the columns.
    """
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    return (
        df.select(*columns)
        .distinct()
        .select(pairs.alias("pair"))
        .select("pair.column", "pair.value")
        .filter(F.col("value").isNotNull())
        .distinct()
        .orderBy("column", "value")
    )


def default_rois(df: DataFrame, n: int = 2) -> DataFrame:
    """The first `n` known regions by name: the preset of the trend filters."""
    return df.filter(is_known_roi()).select("roi").distinct().orderBy("roi").limit(n)


def _count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count("*").alias("count")).orderBy(*keys)


def month_roi(df: DataFrame) -> DataFrame:
    return _count_by(df, "month", "roi")


def hour_roi(df: DataFrame) -> DataFrame:
    return _count_by(df, "hour", "roi")


def _day_name(idx: Column) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), idx)


def weekday_counts(df: DataFrame) -> DataFrame:
    """Photos per weekday, Monday first; all seven days are present."""
    days = df.sparkSession.range(1, 8).select(F.col("id").cast("int").alias("day_idx"))
    counts = df.dropna(subset=["day_name"]).groupBy("day_name").agg(F.count("*").alias("count"))
    return (
        days.withColumn("day_name", _day_name(F.col("day_idx")))
        .join(counts, "day_name", "left")
        .select("day_idx", "day_name", F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("day_idx")
    )


def day_hour_grid(df: DataFrame) -> DataFrame:
    """Photos per weekday and hour: 7 x 24 rows, zeros filled in."""
    cells = df.sparkSession.range(7 * 24).select(
        (F.floor(F.col("id") / 24) + 1).cast("int").alias("day_idx"),
        (F.col("id") % 24).cast("int").alias("hour"),
    )
    counts = (
        df.dropna(subset=["day_name", "hour"]).groupBy("day_name", "hour").agg(F.count("*").alias("count"))
    )
    return (
        cells.withColumn("day_name", _day_name(F.col("day_idx")))
        .join(counts, ["day_name", "hour"], "left")
        .select("day_idx", "day_name", "hour", F.coalesce("count", F.lit(0)).alias("count"))
        .orderBy("day_idx", "hour")
    )
