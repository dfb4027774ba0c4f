"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import math

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lenstrail.sources.tables import cut_lineage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(doc_id: str, n: int) -> Column:
    """Remainder of crc32 of the id's decimal text; a NULL id counts as an empty text."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % n


def text_bytes(docs: DataFrame, text: str = "text") -> int:
    """Bytes of all texts.  One number; one pass over the column."""
    return docs.agg(F.sum(F.octet_length(text))).first()[0] or 0


def buckets_for(n_bytes: int, each: int = 8 << 20, least: int = 24) -> int:
    """How many groups keep each group near `each` bytes, whatever the size of the input."""
    return max(least, math.ceil(n_bytes / each))


def short_batches(df: DataFrame, rows: int = 500) -> DataFrame:
    """`df`, with Spark's default of 10 000 rows an Arrow batch lowered for its session.

    A batch of whole texts is held by the executor and by its Python worker at once; Spark
    bounds its rows, not its bytes.  A bound that the caller has set stays.
    """
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if conf.get(name) == "10000":
        conf.set(name, str(rows))
    return df


def slices(batches, size: int = 8 << 20, text: str = "text"):
    """Arrow tables of about `size` bytes of text, cut from a stream of record batches.

    A row longer than that makes a table of its own.
    """
    held, n = [], 0
    for batch in batches:
        lengths = pc.binary_length(batch.column(text)).fill_null(0).to_pylist()
        start = 0
        for i, length in enumerate(lengths):
            if n and n + length > size:
                held.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(held)
                held, n, start = [], 0, i
            n += length
        held.append(batch.slice(start))
    held = [b for b in held if b.num_rows]
    if held:
        yield pa.Table.from_batches(held)
    del held
    pa.default_memory_pool().release_unused()  # workers are used again by later stages


def let_go(spark: SparkSession) -> None:
    """Have the driver's JVM collect garbage, upon which Spark removes shuffle files of frames that are gone.

    Jobs of many short rounds else leave the files of all rounds on the executors' disks, since a driver
    with little to do collects late.
    """
    gc.collect()
    spark._jvm.System.gc()


MIN_TASKS = 4
LINKS_A_TASK = 100_000
MAX_BROADCAST = 100_000


def tasks_for(n: int) -> int:
    """Tasks that so many short rows need."""
    return max(MIN_TASKS, math.ceil(n / LINKS_A_TASK))


def counted(df: DataFrame) -> DataFrame:
    """`df` stored, read by as many tasks as its rows need, and broadcast while they are at most MAX_BROADCAST."""
    stored = cut_lineage(df)
    n = stored.coalesce(df.sparkSession.sparkContext.defaultParallelism).count()
    stored = stored.coalesce(tasks_for(n))
    return F.broadcast(stored) if n <= MAX_BROADCAST else stored


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every end of `edges` (a, b): the smallest id that links reach.

    Alternates a star step over all neighbours with one over smaller neighbours, so the
    number of rounds grows with the logarithm of the longest chain.  Minima are combined
    before each shuffle, and the joins back are split by adaptive execution where one
    node has very many links.  Each round is checkpointed.  Links are counted, and handed to
    the next shuffle by as many tasks as they need: each task of a shuffle leaves files of its own,
    and the driver keeps books of it.  While their ends are few, minima are broadcast.
    """
    stars = (
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u != v")
        .distinct()
    )
    stars = cut_lineage(stars)
    before, n = None, stars.coalesce(edges.sparkSession.sparkContext.defaultParallelism).count()
    while n:
        tasks = tasks_for(n)
        few = 2 * n <= MAX_BROADCAST  # ends
        stars = stars.coalesce(tasks)
        both = stars.union(stars.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        if few:
            lowest = F.broadcast(lowest.coalesce(tasks))
        large = both.join(lowest, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).coalesce(tasks).distinct()
        if few:
            large = large.coalesce(tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        if few:
            least = F.broadcast(least.coalesce(tasks))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = cut_lineage(small.union(least.select("u", F.col("m").alias("v"))).coalesce(tasks).distinct().coalesce(tasks))
        now = stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        del both, lowest, large, least, small
        let_go(stars.sparkSession)
        if now == before:
            break
        before, n = now, now[0]
    ends = stars.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return ends.union(stars.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct().coalesce(tasks_for(n))
