"""Mixes sources to target weights by Pareto order sampling.

Targets: sources in code point order, NULL last, weigh 1, 2, 3, repeating, and share the
words of all documents.  A target stops at `most` times its source's size; what is cut off
is shared again by weight until none is above.

Sample: every document first gets floor(target / size of its source) whole copies.  For
the rest of the target documents of a source are ranked by

    odds of a uniform number / inclusion odds,

where the inclusion odds are those of the fraction still wanted, times the document's size
over the source's mean size, and the first in rank that fill the rest are taken once more.
The size in words is so fixed, and the chances are unequal.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from lenstrail.sources.tables import cut_lineage

MOST = 3
BINS = 4096
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """(source, source_size, n_docs, target) from (source, source_size, n_docs).

    Runs on one row per source.  A source is capped if its cap is at most what it would get
    once all sources with a lower cap per weight are capped.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    by_cap = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by_cap.rowsBetween(W.unboundedPreceding, -1), by_cap.rowsBetween(0, W.unboundedFollowing)
    every = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = (F.col("total") - F.col("cap_before")) / F.col("weight_left")
    capped = (
        sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("cap", F.col("source_size") * F.lit(most))
        .withColumn("total", F.sum("source_size").over(every))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("weight_left", F.sum("weight").over(after))
        .withColumn("capped", F.col("cap") <= level * F.col("weight"))
    )
    spent = F.sum(F.when(F.col("capped"), F.col("cap")).otherwise(0)).over(every)
    open_weight = F.sum(F.when(F.col("capped"), 0).otherwise(F.col("weight"))).over(every)
    share = (F.col("total") - spent) * F.col("weight") / open_weight
    return capped.select(
        "source",
        "source_size",
        "n_docs",
        F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"),
    )


def mix(docs: DataFrame, *, most: int = MOST, bins: int = BINS, seed: str = SEED) -> DataFrame:
    """Row per document: doc_id, size, source_size, target, taken, and source, text_key, copies.

    `text_key` is a hash of the text; rows equal in doc_id, source and size are drawn
    together, so they get the same number of copies.  NULL doc_id draws as an empty text,
    NULL text has size 0, NULL source is a source.  Documents of size 0 take nothing
    (copies of them are the whole ones).  Other columns are ignored; no rows give no rows.

    The draw hashes doc_id, so it does not depend on partitioning.  No source meets in one
    task: words are summed per source and bin of the rank, and only the one bin in which a
    source's target is reached is ordered (a source of 10^10 documents: about 2.4 million).
    """
    hex12 = F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 12)
    sized = cut_lineage(
        docs.select(
            "doc_id",
            "source",
            F.xxhash64("text").alias("text_key"),
            word_count(F.col("text")).alias("size"),
            ((F.conv(hex12, 16, 10).cast("long") + 0.5) / float(1 << 48)).alias("u"),
        )
    )
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    goal = cut_lineage(
        targets(per_source, most)
        .withColumn("ratio", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
        .withColumn("whole", F.floor("ratio"))
        .withColumn("left", F.col("target") - F.col("whole") * F.col("source_size"))
    )
    part = F.col("ratio") - F.col("whole")
    odds = part / (1 - part) * (F.col("size") * F.col("n_docs") / F.col("source_size"))
    rank = F.col("u") / (1 - F.col("u")) / odds
    drawn = (
        sized.join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        .drop("s")
        .withColumn("rank", F.when((F.col("size") > 0) & (part > 0), rank / (1 + rank)).otherwise(1.0))
        .withColumn("bin", F.least(F.floor(F.col("rank") * bins), F.lit(bins - 1)))
    )
    per_bin = drawn.groupBy("source", "bin", "left").agg(F.sum("size").alias("words"))
    up_to = F.sum("words").over(W.partitionBy("source").orderBy("bin"))
    edge = (
        per_bin.withColumn("up_to", up_to)
        .where((F.col("up_to") > F.col("left")) & (F.col("up_to") - F.col("words") <= F.col("left")))
        .groupBy(F.col("source").alias("s"))
        .agg(F.min(F.struct("bin", (F.col("up_to") - F.col("words")).alias("before"))).alias("edge"))
        .select("s", F.col("edge.bin").alias("edge_bin"), F.col("edge.before").alias("before"))
    )
    cut = drawn.join(edge, F.col("source").eqNullSafe(F.col("s")), "left").drop("s")
    at_edge = F.col("bin") == F.col("edge_bin")
    ties = W.partitionBy("source", "bin", "rank", "doc_id")
    so_far = F.sum("size").over(W.partitionBy("source", "bin").orderBy("rank", "doc_id")) - F.sum("size").over(ties)
    inner = cut.where(at_edge).withColumn("extra", (F.col("before") + so_far + F.col("size") / 2 <= F.col("left")).cast("long"))
    outer = cut.where(F.col("edge_bin").isNull() | ~at_edge).withColumn(
        "extra", ((F.col("size") > 0) & (F.col("edge_bin").isNull() | (F.col("bin") < F.col("edge_bin")))).cast("long")
    )
    extra = F.when(part > 0, F.col("extra")).otherwise(0)
    return outer.unionByName(inner).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * (F.col("whole") + extra)).alias("taken"),
        "source",
        "text_key",
        (F.col("whole") + extra).alias("copies"),
    )


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """`docs` with every row as often as the mix takes it; columns are kept."""
    plan = mix(docs, **options).groupBy("doc_id", "source", "text_key").agg(F.max("copies").alias("copies"))
    plan = plan.select(*[F.col(c).alias(f"__{c}") for c in plan.columns])
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    on = (
        F.col("doc_id").eqNullSafe(F.col("__doc_id"))
        & F.col("source").eqNullSafe(F.col("__source"))
        & (F.col("__key") == F.col("__text_key"))
    )
    taken = keyed.join(plan.where("__copies > 0"), on)
    return taken.withColumn("__n", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))).select(*docs.columns)


ORACLE = f"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         (CAST('0x' || substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) + 0.5::DOUBLE)
           / 281474976710656::DOUBLE AS u
  FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n_docs FROM sized GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, source_size * {MOST} AS cap,
                   sum(source_size) OVER ()::BIGINT AS total FROM sources),
levels AS (
  SELECT *, coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS cap_before,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weight_left
  FROM weighed WINDOW o AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST)),
capped AS (SELECT *, cap <= (total - cap_before)::DOUBLE / weight_left * weight AS capped FROM levels),
goal AS (
  SELECT source, source_size, n_docs,
         CASE WHEN capped THEN cap::DOUBLE ELSE ((total - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT * weight)::DOUBLE
           / (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::BIGINT END AS target FROM capped),
parts AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS ratio FROM goal),
lefts AS (SELECT *, floor(ratio)::BIGINT AS whole, target - floor(ratio)::BIGINT * source_size AS left_over FROM parts),
ranked AS (
  SELECT d.*, source_size, target, whole, left_over, ratio - whole AS part,
         u / (1 - u) / ((ratio - whole) / (1 - (ratio - whole)) * ((size * n_docs)::DOUBLE / source_size)) AS q
  FROM sized d JOIN lefts l ON d.source IS NOT DISTINCT FROM l.source),
drawn AS (SELECT *, CASE WHEN size > 0 AND part > 0 THEN q / (1 + q) ELSE 1 END AS rank FROM ranked),
cut AS (
  SELECT *, (sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id) - sum(size) OVER (PARTITION BY source, rank, doc_id))::DOUBLE
           + size / 2.0::DOUBLE <= left_over AS extra FROM drawn)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       (size * (whole + CASE WHEN part > 0 AND extra AND size > 0 THEN 1 ELSE 0 END))::BIGINT AS taken,
       source, (whole + CASE WHEN part > 0 AND extra AND size > 0 THEN 1 ELSE 0 END)::BIGINT AS copies
FROM cut
"""
