"""Executive summary of a clustered and a time-featured photo table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.functions.columns import is_known_roi, with_share


def _ranked(counts: DataFrame, key: str, amount: str, n: int) -> DataFrame:
    """First `n` rows by amount, with their rank.  For aggregates with few rows."""
    top = counts.orderBy(F.desc(amount), key).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc(amount), key)))


def exec_summary(clustered: DataFrame, time_df: DataFrame, *, n: int = 3) -> DataFrame:
    """Rows (section, rank, name, value, share).

    Sections: total photos, largest clusters, photos in known regions, busiest regions,
    peak year, most active user.  The cluster and region figures all come from one
    (cluster, roi) aggregate.
    """
    cube = clustered.groupBy("cluster", "roi").agg(F.count("*").alias("n"))
    whole = cube.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("value"))
    mapped = cube.agg(F.coalesce(F.sum(F.when(is_known_roi(), F.col("n"))), F.lit(0)).alias("value"))

    clusters = with_share(cube.groupBy("cluster").agg(F.sum("n").alias("value")), "value")
    rois = cube.filter(is_known_roi()).groupBy("roi").agg(F.sum("n").alias("value"))
    years = time_df.filter(F.col("year").isNotNull()).groupBy("year").agg(F.count("*").alias("value"))
    users = time_df.filter(F.col("user_id").isNotNull()).groupBy("user_id").agg(F.count("*").alias("value"))

    one, none = F.lit(1), F.lit(None).cast("string")

    def rows(df: DataFrame, section: str, rank: Column, name: Column, share: Column | None = None) -> DataFrame:
        part = F.lit(None).cast("double") if share is None else share
        return df.select(
            F.lit(section).alias("section"),
            rank.cast("int").alias("rank"),
            name.cast("string").alias("name"),
            F.col("value"),
            part.alias("share"),
        )

    parts = [
        rows(whole, "total_photos", one, none),
        rows(
            _ranked(clusters.filter(F.col("cluster").isNotNull()), "cluster", "value", n),
            "top_cluster",
            F.col("rank"),
            F.col("cluster"),
            F.col("share"),
        ),
        rows(mapped, "mapped_photos", one, none),
        rows(_ranked(rois, "roi", "value", n), "top_roi", F.col("rank"), F.col("roi")),
        rows(_ranked(years, "year", "value", 1), "peak_year", F.col("rank"), F.col("year")),
        rows(users.agg(F.max("value").alias("value")), "top_user", one, none),
    ]
    return reduce(DataFrame.unionAll, parts)
