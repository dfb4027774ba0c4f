"""Frequent region sets, association rules, and what the dashboard derives from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth, FPGrowthModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.config import FIRST_REAL_YEAR, ROIS, Roi
from lenstrail.functions.columns import from_year, is_known_roi
from lenstrail.sources.tables import cut_lineage, roi_table


def user_transactions(df: DataFrame, *, min_year: int = FIRST_REAL_YEAR) -> DataFrame:
    """Sorted set of known regions per user.

    Repeats are dropped by a hash aggregation on (user, region) first, so only a user's few
    distinct regions are sorted and gathered, however many photos there are.
    """
    return (
        df.filter(is_known_roi() & from_year(min_year))
        .select("user_id", "roi")
        .distinct()
        .groupBy("user_id")
        .agg(F.sort_array(F.collect_list("roi")).alias("items"))
    )


def mine(tx: DataFrame, min_support: float = 0.01, min_confidence: float = 0.05) -> FPGrowthModel:
    """FP-growth model.  Mining makes several passes, so the transactions are materialised."""
    items = cut_lineage(tx.select("items"))
    return FPGrowth(itemsCol="items", minSupport=min_support, minConfidence=min_confidence).fit(items)


def frequent_itemsets(tx: DataFrame, min_support: float = 0.01) -> DataFrame:
    """(items, freq) for all sets in at least `min_support` of the transactions."""
    found = mine(tx, min_support).freqItemsets
    return found.select(F.sort_array("items").alias("items"), "freq")


def top_itemsets(itemsets: DataFrame, n: int = 10) -> DataFrame:
    return itemsets.orderBy(F.desc("freq"), "items").limit(n)


def association_rules(tx: DataFrame, min_support: float = 0.01, min_confidence: float = 0.05) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support); antecedents are sorted."""
    return mine(tx, min_support, min_confidence).associationRules.withColumn(
        "antecedent", F.sort_array("antecedent")
    )


def top_rules(rules: DataFrame, n: int = 10, by: str = "lift") -> DataFrame:
    # Lifts of different rules can agree up to the last bits; compare them rounded.
    return rules.orderBy(F.desc(F.round(by, 9)), "antecedent", "consequent").limit(n)


def filter_rules(
    rules: DataFrame, *, min_lift: float = 1.0, exclude: str = "Vaticano", n: int | None = 10
) -> DataFrame:
    """Rules with lift above `min_lift` that do not lead to `exclude`, surest first."""
    kept = (
        rules.filter((F.col("lift") > min_lift) & ~F.array_contains("consequent", exclude))
        .select("antecedent", "consequent", "confidence", "lift")
        .orderBy(F.desc(F.round("confidence", 9)), "antecedent", "consequent")
    )
    return kept if n is None else kept.limit(n)


def flow_links(rules: DataFrame, *, min_confidence: float = 0.20, n: int = 20) -> DataFrame:
    """Links of the flow diagram.  A rule runs from its first antecedent to its consequent;
    rules with the same ends merge."""
    return (
        rules.filter(F.col("confidence") >= min_confidence)
        .groupBy(
            F.sort_array("antecedent")[0].alias("source"),
            F.col("consequent")[0].alias("target"),
        )
        .agg(
            F.max("confidence").alias("confidence"),
            F.avg("lift").alias("lift"),
            F.sum("support").alias("support"),
        )
        .orderBy(F.desc(F.round("confidence", 9)), "source", "target")
        .limit(n)
        .withColumn("thickness", (F.col("confidence") * 100).cast("int"))
    )


def flow_nodes(links: DataFrame) -> DataFrame:
    """Names at either end of the links, numbered from 0 in name order."""
    names = links.select(F.explode(F.array("source", "target")).alias("node")).distinct()
    return names.withColumn("idx", F.row_number().over(Window.orderBy("node")) - 1)


def flow_link_indices(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """Links with the numbers of their ends.  Both frames are as small as the diagram."""
    ends = [
        nodes.select(F.col("node").alias(end), F.col("idx").alias(f"{end}_idx")) for end in ("source", "target")
    ]
    return links.join(ends[0], "source").join(ends[1], "target")


def start_places(rules: DataFrame, rois: Sequence[Roi] = ROIS) -> DataFrame:
    """Known regions that occur in an antecedent: where a recommendation can start."""
    return (
        rules.select(F.explode("antecedent").alias("source"))
        .filter(F.col("source").isin([r.name for r in rois]))
        .distinct()
    )


def next_step(rules: DataFrame, rois: Sequence[Roi] = ROIS, n: int = 3) -> DataFrame:
    """The `n` likeliest next regions for every start: (source, rank, target, prob, lift).

    A rule counts for each region in its antecedent; per pair the surest rule is kept,
    higher lift first among equals.
    """
    names = [r.name for r in rois]
    pairs = rules.select(
        F.explode("antecedent").alias("source"),
        F.col("consequent")[0].alias("target"),
        F.struct(F.col("confidence").alias("prob"), "lift").alias("rule"),
    ).filter(F.col("source").isin(names) & F.col("target").isin(names) & (F.col("source") != F.col("target")))
    best = pairs.groupBy("source", "target").agg(F.max("rule").alias("rule")).select("source", "target", "rule.*")
    order = Window.partitionBy("source").orderBy(F.desc(F.round("prob", 9)), F.desc(F.round("lift", 9)), "target")
    return (
        best.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n)
        .select("source", "rank", "target", "prob", "lift")
    )


def next_step_arcs(
    recs: DataFrame, rois: Sequence[Roi] = ROIS, *, strong: float = 0.25, scale: float = 15
) -> DataFrame:
    """Recommendations as map arcs: end points, width and whether the move is a strong one."""
    centres = roi_table(recs.sparkSession, rois).select("roi", "centre_lat", "centre_lon")

    def end(name: str) -> DataFrame:
        return F.broadcast(centres.toDF(name, f"{name}_lat", f"{name}_lon"))

    return (
        recs.join(end("source"), "source")
        .join(end("target"), "target")
        .withColumn("width", F.col("prob") * scale)
        .withColumn("strong", F.col("prob") > strong)
    )
