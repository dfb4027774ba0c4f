"""Pre-aggregated views that need the user type of a photo."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.functions.columns import is_known_roi, localness


def add_user_type(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Left join of user_type.  Callers aggregate to few rows per user first."""
    return df.join(profiles.select("user_id", "user_type"), "user_id", "left")


def of_user_types(df: DataFrame, profiles: DataFrame, types: Sequence[str]) -> DataFrame:
    """Rows whose user has one of the types; an empty list keeps all rows.

    A semi-join on one profile per user: it multiplies no rows, and adaptive execution splits
    the rows of a busy user.
    """
    if not types:
        return df
    return df.join(profiles.filter(F.col("user_type").isin(list(types))).select("user_id"), "user_id", "left_semi")


def hourly_heatmap(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Photos per (roi, hour, user_type) in known regions.

    Counted per user first: a user then brings at most (regions x 24) rows to the join,
    whatever their share of the photos.
    """
    per_user = (
        df.filter(is_known_roi())
        .groupBy("user_id", "roi", F.hour("timestamp").alias("hour"))
        .agg(F.count("*").alias("n"))
    )
    return (
        add_user_type(per_user, profiles)
        .groupBy("roi", "hour", "user_type")
        .agg(F.sum("n").alias("count"))
        .orderBy("roi", "hour", "user_type")
    )


def _gems(counts: DataFrame, amount: str) -> DataFrame:
    sides = counts.groupBy("roi").pivot("user_type", ["Tourist", "Resident"]).agg(F.sum(amount)).na.fill(0)
    return (
        sides.withColumn("total", F.col("Tourist") + F.col("Resident"))
        .withColumn("localness_index", localness(F.col("Resident"), F.col("total")))
        .orderBy(F.desc("localness_index"), "roi")
    )


def hidden_gems(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """Photos of tourists and residents per known region, and (residents+1)/(both+1).

    Recurring visitors do not count, but a region only they visit keeps its row.
    """
    per_user = df.filter(is_known_roi()).groupBy("user_id", "roi").agg(F.count("*").alias("n"))
    return _gems(add_user_type(per_user, profiles), "n")


def hidden_gems_from_heatmap(heatmap: DataFrame) -> DataFrame:
    """The same view from a stored heat map, without going back to the photos."""
    return _gems(heatmap, "count")


def peak_hour(heatmap: DataFrame, *, per: str = "cell") -> DataFrame:
    """Busiest hour of each region; the earlier hour wins a tie.

    `cell` takes the largest single (hour, user_type) count, `total` the largest sum over
    user types.
    """
    if per == "total":
        heatmap = heatmap.groupBy("roi", "hour").agg(F.sum("count").alias("count"))
    elif per != "cell":
        raise ValueError(f"unknown grain {per!r}")
    return (
        heatmap.groupBy("roi")
        .agg(F.max(F.struct(F.col("count"), (-F.col("hour")).alias("earlier"))).alias("top"))
        .select("roi", (-F.col("top.earlier")).alias("peak_hour"), F.col("top.count").alias("count"))
        .orderBy("roi")
    )


def local_spots(gems: DataFrame, n: int = 10) -> DataFrame:
    return gems.select("roi", "localness_index").orderBy(F.desc("localness_index"), "roi").limit(n)


def od_matrix(df: DataFrame, profiles: DataFrame, *, max_gap: int | None = None) -> DataFrame:
    """Moves between known regions: (source, target, user_type, weight).

    A move joins two consecutive photos of a user, in time order, that lie in different
    regions; photos of the same second are ordered by region name.  Repeated (user,
    second, region) rows can only give moves within a region and are dropped first.
    With `max_gap`, photos more than so many seconds apart make no move: the later one begins
    another stay in the city.

    The sequence is cut by day.  A first window finds the moves inside a day; they are
    counted, and only the first and last row of each day keep their time.  A second window
    over that short list links the last row of a day to the first of the next.  No task
    holds more than one user's day, or one user's day ends and move counts, and the counts
    stay partitioned by user for the join.
    """
    visits = (
        df.filter(is_known_roi())
        .select("user_id", "timestamp", "roi")
        .distinct()
        .withColumn("day", F.to_date("timestamp"))
    )
    in_day = Window.partitionBy("user_id", "day").orderBy("timestamp", "roi")
    steps = visits.withColumns(
        {
            "next_roi": F.lead("roi").over(in_day),
            "next_at": F.lead("timestamp").over(in_day),
            "previous_roi": F.lag("roi").over(in_day),
        }
    )
    last = F.col("next_roi").isNull()
    day_end = last | F.col("previous_roi").isNull()
    moved = (F.col("roi") != F.col("next_roi")) & _near("timestamp", "next_at", max_gap)
    short = (
        steps.filter(day_end | moved)
        .groupBy(
            "user_id",
            F.col("roi").alias("source"),
            F.when(moved, F.col("next_roi")).alias("target"),
            last.alias("last"),
            F.when(day_end, F.col("timestamp")).alias("at"),
        )
        .agg(F.count("*").alias("n"))
    )
    days = Window.partitionBy("user_id").orderBy("at", "source")
    linked = short.withColumns({"next_day": F.lead("source").over(days), "next_at": F.lead("at").over(days)})
    over_night = F.when(F.col("last") & _near("at", "next_at", max_gap), F.col("next_day"))
    per_user = (
        linked.withColumn("target", F.coalesce("target", over_night))
        .filter(F.col("target").isNotNull() & (F.col("source") != F.col("target")))
        .groupBy("user_id", "source", "target")
        .agg(F.sum("n").alias("n"))
    )
    return (
        add_user_type(per_user, profiles)
        .groupBy("source", "target", "user_type")
        .agg(F.sum("n").alias("weight"))
        .orderBy(F.desc("weight"), "source", "target", "user_type")
    )


def _near(before: str, after: str, max_gap: int | None) -> Column:
    """Whether two times are at most `max_gap` seconds apart."""
    if max_gap is None:
        return F.lit(True)
    return F.unix_seconds(after) - F.unix_seconds(before) <= max_gap


def stays(df: DataFrame, *, max_gap: int) -> DataFrame:
    """Stretches of a user's photos without a pause above `max_gap` seconds: (user_id, first, last, photos).

    Islands are found in each day of a user by itself; there are at most a day's length / `max_gap` + 1 of
    them.  A second window over these short rows joins the ones that go on over midnight, so no
    task holds all photos of a busy user.  Photos with NULL user or time are left out.
    """
    photos = (
        df.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
        .groupBy("user_id", "timestamp")
        .agg(F.count("*").alias("n"))
        .withColumn("day", F.to_date("timestamp"))
    )

    def islands(rows: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(start)
        opens = F.when(F.col("_before").isNull() | ~_near("_before", start, max_gap), 1).otherwise(0)
        return rows.withColumn("_before", F.lag(end).over(order)).withColumn("_opens", opens).withColumn("island", F.sum("_opens").over(order))

    in_day = (
        islands(photos, ["user_id", "day"], "timestamp", "timestamp")
        .groupBy("user_id", "day", "island")
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"), F.sum("n").alias("photos"))
        .drop("island")
    )
    return (
        islands(in_day, ["user_id"], "first", "last")
        .groupBy("user_id", "island")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"), F.sum("photos").alias("photos"))
        .drop("island")
    )
