"""Hot-spot clusters: K-Means, quality, naming and hulls."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.config import ROIS, Roi
from lenstrail.functions.columns import nearest
from lenstrail.operators.sampling import bernoulli_sample
from lenstrail.sources.tables import cut_lineage

Centres = list[tuple[int, float, float]]


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=["latitude", "longitude"], outputCol="features").transform(df)


def fit_centres(df: DataFrame, *, k: int = 10, seed: int = 1) -> Centres:
    """K-Means centres as (cluster, latitude, longitude).

    Training iterates over the data, so equal positions are merged into one weighted point
    beforehand, and the points are materialised.
    """
    points = df.groupBy("latitude", "longitude").agg(F.count("*").cast("double").alias("photos"))
    model = KMeans(k=k, seed=seed, weightCol="photos").fit(_vectors(cut_lineage(points)))
    return [(i, float(c[0]), float(c[1])) for i, c in enumerate(model.clusterCenters())]


def assign_nearest(df: DataFrame, centres: Sequence[tuple]) -> DataFrame:
    """Add `cluster`: the first element of the nearest centre; ties go to the earlier one."""
    return df.withColumn("cluster", nearest(centres, F.col("latitude"), F.col("longitude"))["name"])


def kmeans_clusters(df: DataFrame, *, k: int = 10, seed: int = 1) -> DataFrame:
    """Photos with their K-Means cluster.  The numbers name the clusters of one run only."""
    return assign_nearest(df, fit_centres(df, k=k, seed=seed))


def centre_facts(df: DataFrame, centres: Centres) -> DataFrame:
    """What a K-Means result must satisfy, per cluster: photos, strays and offset.

    `strays` are members that another centre is nearer to; `offset` is the distance in degrees of the centre
    from the mean of its members, which the last round of training bounds.  Every member is
    compared with every centre; what is shuffled is one row per cluster and task.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    squares = F.array(*[F.struct(((lat - a) * (lat - a) + (lon - b) * (lon - b)).alias("square"), F.lit(i).alias("cluster")) for i, a, b in centres])
    mine = F.get(F.filter(squares, lambda s: s.cluster == F.col("cluster")), 0).square
    stray = mine > F.array_min(F.transform(squares, lambda s: s.square))
    held = df.groupBy("cluster").agg(
        F.count("*").alias("photos"), F.count_if(stray).alias("strays"), F.avg("latitude").alias("_lat"), F.avg("longitude").alias("_lon")
    )
    at = F.create_map(*[x for i, a, b in centres for x in (F.lit(i), F.array(F.lit(a), F.lit(b)))])[F.col("cluster")]
    return held.select("cluster", "photos", "strays", F.hypot(F.col("_lat") - at[0], F.col("_lon") - at[1]).alias("offset"))


def exact_silhouette(clustered: DataFrame) -> DataFrame:
    """Mean squared-Euclidean silhouette of all rows, from sums per cluster.

    The mean squared distance of a point to a cluster is |p|^2 - 2 p.s / n + q / n, with the cluster's
    size n, sum s and sum of squares q; so one row per cluster is all that points are compared with.
    A point alone in its cluster counts 0, as does one cluster in all.
    """
    lat, lon = F.col("latitude"), F.col("longitude")
    origin = clustered.agg(F.avg(lat), F.avg(lon)).first()  # near the points, so that little is lost by subtraction
    moved = clustered.where(lat.isNotNull() & lon.isNotNull() & F.col("cluster").isNotNull()).select(
        "cluster", (lat - F.lit(origin[0])).alias("y"), (lon - F.lit(origin[1])).alias("x")
    )
    sums = moved.groupBy("cluster").agg(
        F.count("*").alias("n"), F.sum("y").alias("sy"), F.sum("x").alias("sx"), F.sum(F.col("y") * F.col("y") + F.col("x") * F.col("x")).alias("q")
    )
    # One row per cluster, as many as were asked for.
    known = F.array(*[F.struct(*[F.lit(r[c]).alias(c) for c in ("cluster", "n", "sy", "sx", "q")]) for r in sums.collect()])
    square = F.col("y") * F.col("y") + F.col("x") * F.col("x")

    def total(c: Column) -> Column:
        """Sum of squared distances from a point to the members of a cluster."""
        return F.greatest(square * c.n - 2 * (F.col("y") * c.sy + F.col("x") * c.sx) + c.q, F.lit(0.0))

    own = F.get(F.transform(F.filter("known", lambda c: c.cluster == F.col("cluster")), lambda c: F.when(c.n > 1, total(c) / (c.n - 1))), 0)
    other = F.array_min(F.transform(F.filter("known", lambda c: c.cluster != F.col("cluster")), lambda c: total(c) / c.n))
    value = F.try_divide(F.col("other") - F.col("own"), F.greatest("other", "own"))
    scored = moved.withColumn("known", known).withColumns({"own": own, "other": other})
    either = F.col("own").isNull() | F.col("other").isNull()
    return scored.agg(F.avg(F.when(either, 0.0).otherwise(F.coalesce(value, F.lit(0.0)))).alias("silhouette"))


def silhouette(clustered: DataFrame, *, fraction: float = 1.0, seed: int = 1) -> DataFrame:
    """One row: mean squared-Euclidean silhouette of all rows, or of a sample on request."""
    rows = clustered.select("latitude", "longitude", F.col("cluster").cast("int").alias("prediction"))
    if fraction < 1:
        rows = bernoulli_sample(rows, fraction, seed)
    value = ClusteringEvaluator().evaluate(_vectors(rows))
    return clustered.sparkSession.createDataFrame([(value,)], "silhouette double")


def cluster_sizes(clustered: DataFrame) -> DataFrame:
    return clustered.groupBy("cluster").agg(F.count("*").alias("count")).orderBy("cluster")


def cluster_centres(clustered: DataFrame) -> DataFrame:
    """Mean position and size per cluster; rows without a position are left out."""
    return (
        clustered.dropna(subset=["latitude", "longitude"])
        .groupBy("cluster")
        .agg(F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"), F.count("*").alias("photos"))
    )


def cluster_labels(clustered: DataFrame, rois: Sequence[Roi] = ROIS, *, max_deg: float = 0.015) -> DataFrame:
    """Name each cluster after the region centroid closest to its mean position.

    Beyond `max_deg` degrees it is an outer zone.  The regions enter as literals, compared
    once per cluster.
    """
    named = cluster_centres(clustered).withColumn(
        "near", nearest([(r.name, *r.centre) for r in rois], F.col("lat"), F.col("lon"))
    )
    outer = F.col("near.distance") > max_deg
    zone = F.when(outer, "Outer zone").otherwise(F.col("near.name"))
    return named.select(
        "cluster",
        F.format_string("%s (Cl. %d)", zone, F.col("cluster")).alias("label"),
        "lat",
        "lon",
        "photos",
    ).orderBy(F.desc("photos"), "cluster")


def label_points(points: DataFrame, labels: DataFrame, *, max_broadcast: int = 10_000) -> DataFrame:
    """Put the cluster's label on each point.  `labels` has one row per cluster.

    The labels are materialised and counted: up to `max_broadcast` of them are broadcast, so
    that the points stay where they are.  Beyond that both sides shuffle, and adaptive
    execution splits the points of a busy cluster.
    """
    named = cut_lineage(labels.select("cluster", "label"))
    if named.count() <= max_broadcast:
        named = F.broadcast(named)
    return points.join(named, "cluster", "left")


def _hull_steps(flat: float = 1e-13):
    """The two Python steps of the hull.  Local functions travel to the executors by
    value, so those need no copy of this package.

    A corner of less than `flat` square degrees is rounding: points in line on a grid of
    micro-degrees, whose smallest corner is 1e-12."""

    def hull(points: np.ndarray) -> np.ndarray:
        """Convex hull of an (n, 2) array, counter-clockwise from the lowest (lon, lat)."""
        ordered = [tuple(p) for p in np.unique(points, axis=0)]
        if len(ordered) < 3:
            return np.array(ordered)

        def chain(way):
            out: list = []
            for p in way:
                while len(out) > 1:
                    (ax, ay), (bx, by) = out[-2], out[-1]
                    if (bx - ax) * (p[1] - ay) - (by - ay) * (p[0] - ax) > flat:
                        break
                    out.pop()
                out.append(p)
            return out[:-1]

        return np.array(chain(ordered) + chain(ordered[::-1]))

    def task_hulls(batches):
        """Hull and row count per cluster of one task's rows, held as vertices only."""
        hulls: dict = {}
        rows: dict = {}
        for pdf in batches:
            for key, group in pdf.groupby("cluster"):
                ends = [group[["lon", "low"]].to_numpy(), group[["lon", "high"]].to_numpy()]
                hulls[key] = hull(np.concatenate([*ends, hulls.get(key, np.empty((0, 2)))]))
                rows[key] = rows.get(key, 0) + group["n"].sum()
        for key, vertices in hulls.items():
            out = pd.DataFrame(vertices, columns=["lon", "lat"])
            out.insert(0, "cluster", key)
            out["n"] = np.where(out.index == 0, rows[key], 0)
            yield out

    def whole_hull(pdf: pd.DataFrame) -> pd.DataFrame:
        vertices = hull(pdf[["lon", "lat"]].to_numpy())
        if pdf["n"].sum() < 4 or len(vertices) < 3:
            vertices = np.empty((0, 2))
        out = pd.DataFrame(vertices, columns=["lon", "lat"])
        out.insert(0, "idx", np.arange(len(out), dtype="int32"))
        out.insert(0, "cluster", pdf["cluster"].iloc[0])
        return out

    return task_hulls, whole_hull


def cluster_hulls(clustered: DataFrame) -> DataFrame:
    """Hull vertices (cluster, idx, lon, lat) of every cluster with an area and 4 or more points.

    All points count, not a sample.  Only the lowest and highest point of each longitude
    can be a vertex, which Spark finds with a mergeable aggregation, spread over all tasks
    even for one large cluster.  Each task then reduces its share to hulls, and a
    cluster's hull is the hull of those, so the last step sees vertices only.
    """
    ends = (
        clustered.dropna(subset=["cluster", "latitude", "longitude"])
        .groupBy("cluster", F.col("longitude").alias("lon"))
        .agg(F.min("latitude").alias("low"), F.max("latitude").alias("high"), F.count("*").alias("n"))
    )
    task_hulls, whole_hull = _hull_steps()
    key = clustered.schema["cluster"].dataType.simpleString()
    return (
        ends.mapInPandas(task_hulls, f"cluster {key}, lon double, lat double, n bigint")
        .groupBy("cluster")
        .applyInPandas(whole_hull, f"cluster {key}, idx int, lon double, lat double")
    )
