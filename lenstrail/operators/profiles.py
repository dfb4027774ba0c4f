"""User profiles, segments and the relevance classifier."""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lenstrail.config import MANY_ROIS, RESIDENT_DAYS, TOURIST_DAYS
from lenstrail.functions.columns import from_year, relevance, user_type, with_share
from lenstrail.operators.sampling import hash_split
from lenstrail.sources.tables import cut_lineage

MODEL_FEATURES = ("total_photos", "unique_rois", "days_active", "photos_per_day")


def user_profiles(
    df: DataFrame,
    *,
    resident_days: int = RESIDENT_DAYS,
    tourist_days: int = TOURIST_DAYS,
    many_rois: int = MANY_ROIS,
    min_year: int | None = None,
) -> DataFrame:
    """One row per user.

    One aggregation with one distinct column: Spark first reduces to (user, roi) on the
    map side, so a user with a large share of all photos is small before the shuffle on
    user.  `Unknown` counts as a region.  Default dates count unless `min_year` drops them.
    """
    if min_year is not None:
        df = df.filter(from_year(min_year))
    days, rois = F.col("days_active"), F.col("unique_rois")
    return (
        df.groupBy("user_id")
        .agg(
            F.min("timestamp").alias("first_seen"),
            F.max("timestamp").alias("last_seen"),
            F.count("photo_id").alias("total_photos"),
            F.count_distinct("roi").alias("unique_rois"),
            F.stddev(F.hour("timestamp")).alias("hour_stddev"),
        )
        .withColumn("days_active", F.datediff("last_seen", "first_seen"))
        .withColumn("photos_per_day", F.col("total_photos") / (days + 1))
        .na.fill(0)
        .withColumn("label", relevance(days, rois, resident_days, many_rois))
        .withColumn("user_type", user_type(days, resident_days, tourist_days))
    )


def user_segments(profiles: DataFrame) -> DataFrame:
    """Users per user_type, with their share of all users."""
    counts = profiles.filter(F.col("user_type").isNotNull()).groupBy("user_type").agg(F.count("*").alias("users"))
    return with_share(counts, "users")


def days_active_hist(profiles: DataFrame, *, max_days: int = 365, width: int = 13) -> DataFrame:
    """Histogram of days_active below `max_days`, in fixed bins of `width` days."""
    low = (F.floor(F.col("days_active") / width) * width).cast("int")
    return (
        profiles.filter(F.col("days_active") < max_days)
        .groupBy(low.alias("bin_start"))
        .agg(F.count("*").alias("users"))
        .orderBy("bin_start")
    )


def top_contributors(profiles: DataFrame, n: int = 10) -> DataFrame:
    return (
        profiles.select("user_id", "user_type", "total_photos", "unique_rois", "days_active")
        .orderBy(F.desc("total_photos"), "user_id")
        .limit(n)
    )


def fit_relevance(
    profiles: DataFrame,
    *,
    num_trees: int = 100,
    seed: int = 42,
    train_share: float = 0.8,
) -> tuple[RandomForestClassificationModel, DataFrame]:
    """A random forest over the users of the training share, and the held-out users with their features.

    The label is a rule over two of the features, so near-perfect accuracy is expected.
    The split hashes user_id and does not change with the partitioning.  Training makes
    several passes; the profiles are materialised first.
    """
    data = cut_lineage(profiles.select("user_id", *MODEL_FEATURES, "label"))
    vectors = VectorAssembler(inputCols=list(MODEL_FEATURES), outputCol="features").transform(data)
    train, test = hash_split(vectors, "user_id", train_share)
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees, seed=seed)
    return forest.fit(train), test


def user_relevance_model(profiles: DataFrame, **options) -> DataFrame:
    """Predictions of a random forest for the held-out users."""
    model, test = fit_relevance(profiles, **options)
    return model.transform(test).select("user_id", *MODEL_FEATURES, "label", "prediction")


def forest_nodes(model: RandomForestClassificationModel, folder: str) -> DataFrame:
    """The trees as rows, written under `folder`: (tree, node, feature, threshold, left, right, votes).

    A leaf has no feature.  `votes` is the share of each class among a node's training rows.
    """
    model.write().overwrite().save(folder)
    node = F.col("nodeData")
    total = F.aggregate(node.impurityStats, F.lit(0.0), lambda a, x: a + x)
    leaf = node.leftChild < 0
    return SparkSession.active().read.parquet(f"{folder}/data").select(
        F.col("treeID").alias("tree"),
        node["id"].alias("node"),
        F.when(~leaf, F.get(F.array(*[F.lit(f) for f in MODEL_FEATURES]), node.split.featureIndex)).alias("feature"),
        F.when(~leaf, F.get(node.split.leftCategoriesOrThreshold, 0)).alias("threshold"),
        F.when(~leaf, node.leftChild).alias("left"),
        F.when(~leaf, node.rightChild).alias("right"),
        F.transform(node.impurityStats, lambda x: x / total).alias("votes"),
    )


def route(users: DataFrame, nodes: DataFrame, *, depth: int = 5) -> DataFrame:
    """Predictions of a forest of node rows: (user_id, prediction), by a join per level of the trees.

    Trees are bounded by their number and depth, so nodes are broadcast; users stay where they are.
    Votes of the trees are added in order, as the model adds them; a tie goes to the lower class.
    """
    trees = nodes.agg(F.max("tree")).first()[0] + 1
    if nodes.count() > trees * 2 ** (depth + 1):
        raise ValueError("trees are deeper than stated")
    table = F.broadcast(nodes.withColumnsRenamed({"tree": "_tree", "node": "_node"}))
    at = users.select("user_id", F.map_from_arrays(F.array(*[F.lit(f) for f in MODEL_FEATURES]), F.array(*[F.col(f).cast("double") for f in MODEL_FEATURES])).alias("values"))
    at = at.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("node", F.lit(0))
    for _ in range(depth):
        here = at.join(table, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
        goes = F.when(F.element_at("values", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.select("user_id", "values", "tree", F.when(F.col("feature").isNull(), F.col("node")).otherwise(goes).alias("node"))
    ends = at.join(table, (F.col("tree") == F.col("_tree")) & (F.col("node") == F.col("_node")))
    votes = F.array_sort(F.collect_list(F.struct("tree", "votes")))

    def added(of: int):
        return F.aggregate("votes", F.lit(0.0), lambda a, v: a + v["votes"][of])

    return (
        ends.groupBy("user_id")
        .agg(votes.alias("votes"))
        .select("user_id", F.when(added(1) > added(0), 1.0).otherwise(0.0).alias("prediction"))
    )


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.count("*").alias("users"),
        F.avg((F.col("prediction") == F.col("label")).cast("double")).alias("accuracy"),
    )
