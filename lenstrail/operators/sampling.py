"""Samples and splits that do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, GroupedData, Window
from pyspark.sql import functions as F

from lenstrail.sources.tables import cut_lineage


def _uniform(keys: Sequence[str], seed: int) -> Column:
    """Number in [0, 1) from the md5 of the keys as text, NULL as an empty text."""
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), *parts)), 1, 12), 16, 10).cast("long") / float(1 << 48)


def hash_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """Split in two by the md5 of `key`; rows with equal keys stay together."""
    low = _uniform([key], seed) < share
    return df.filter(low), df.filter(~low)


def bernoulli_sample(df: DataFrame, fraction: float = 0.2, seed: int = 1, keys: Sequence[str] = ()) -> DataFrame:
    """Each row with chance `fraction` by the md5 of `keys` (all columns if none are given)."""
    return df.filter(_uniform(keys or df.columns, seed) < fraction)


MOST = 100_000  # rows that one task sorts


def exact_sample(df: DataFrame, key: str, n: int, *, hex_digits: int = 4, most: int = MOST) -> DataFrame:
    """Exactly `n` rows (all rows if there are fewer): those with the smallest md5 of `key`, then by all columns.

    Sorting for a large `n` would bring `n` rows of every partition into one task.  Instead, rows
    are counted per md5 prefix (at most 16**hex_digits counters), which finds the prefix where the
    sample ends.  While more than `most` rows share it, only they are counted again, by further
    digits.  Rows of one key that are still more are cut by ranges of their columns.  Equal rows
    travel as one row with a count, so copies cost nothing.  The counting passes run here.
    """
    if n <= 0:
        return df.limit(0)
    columns = df.columns
    keyed = df.withColumn("_md5", F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))))
    edge, need, rows, digits = "", n, most + 1, 0
    while rows > most and digits < 32:
        digits = min(32, digits + hex_digits)
        found = _edge(keyed.filter(F.col("_md5").startswith(edge)).groupBy(F.substring("_md5", 1, digits).alias("_at")), "_at", need)
        if found is None:
            return df
        edge, rows, need = found["_at"], found["_rows"], need - found["_before"]
    prefix = F.substring("_md5", 1, digits)
    below = keyed.filter(prefix < edge).select(*columns)
    at_edge = keyed.filter(prefix == edge).groupBy("_md5", *columns).agg(F.count("*").alias("_copies"))
    if rows <= most:
        at_edge = at_edge.withColumn("_range", F.lit(0))
    else:
        at_edge, need = _edge_range(at_edge, columns, need, most)
    order = Window.partitionBy("_range").orderBy("_md5", *columns)
    earlier = F.sum("_copies").over(order.rowsBetween(Window.unboundedPreceding, -1))
    # Ranges before the one where the sample ends have a negative number and stay whole.
    take = F.when(F.col("_range") < 0, F.col("_copies")).otherwise(F.least(F.col("_copies"), F.lit(need) - F.coalesce(earlier, F.lit(0))))
    cut = (
        at_edge.withColumn("_take", take)
        .filter("_take > 0")
        .select(*columns, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_take"))).alias("_copy"))
        .drop("_copy")
    )
    return below.unionAll(cut)


def _edge(counted: GroupedData, at: str, need: int, rows: Column | None = None):
    """The group in which the first `need` rows end, its rows, and those before it; None if all are fewer.

    One task sees the counters only; their number is fixed by the digits or the ranges.
    """
    before = F.sum("_rows").over(Window.orderBy(at).rowsBetween(Window.unboundedPreceding, -1))
    return (
        counted.agg((F.count("*") if rows is None else F.sum(rows)).alias("_rows"))
        .withColumn("_before", F.coalesce(before, F.lit(0)))
        .filter((F.col("_before") < need) & (F.col("_before") + F.col("_rows") >= need))
        .first()
    )


def _edge_range(rows: DataFrame, columns: Sequence[str], need: int, most: int) -> tuple[DataFrame, int]:
    """Distinct rows of one key with the range of columns they lie in, up to the one where the sample ends.

    That range is 0 and those before it are negative; also, how many rows of range 0 are taken.
    """
    ranges = max(1, -(-2 * rows.count() // most))
    dealt = rows.repartitionByRange(ranges, *columns).withColumn("_range", F.spark_partition_id())
    stored = cut_lineage(dealt)
    found = _edge(stored.groupBy("_range"), "_range", need, F.col("_copies"))
    last = found["_range"]
    kept = stored.filter(F.col("_range") <= last).withColumn("_range", F.col("_range") - F.lit(last))
    return kept, need - found["_before"]
