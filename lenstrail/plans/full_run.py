"""The whole analysis as one chain of written tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from lenstrail.config import ROIS, Roi
from lenstrail.operators import clean, clusters, enrich, profiles, rules, tags, views
from lenstrail.sources.raw_json import read_photos
from lenstrail.sources.tables import own_session, write_table


def run_all(
    spark: SparkSession,
    raw: str | DataFrame,
    out: str,
    *,
    layout: str = "auto",
    rois: Sequence[Roi] = ROIS,
    k: int = 10,
) -> dict[str, DataFrame]:
    """Write all tables of the analysis under `out` and return frames that read them.

    Each step reads what an earlier one wrote, so a lost executor costs a task, not the
    chain, and every reader prunes the columns it needs.  Raw files are scanned once: the report of
    the cleaning comes from the pass that writes the photos (a frame of raw records is read twice).  Raises on missing input; an
    input with no valid photo stops with an error before anything else is derived.
    """
    done: dict[str, DataFrame] = {}

    def keep(name: str, df: DataFrame, **options) -> DataFrame:
        done[name] = write_table(df, f"{out}/{name}.parquet", **options)
        return done[name]

    photos_path = f"{out}/photos_clean.parquet"
    if isinstance(raw, str):
        cleaning = clean.Cleaning(read_photos(own_session(spark), raw, layout=layout))
        write_table(cleaning.photos, photos_path)
        report = cleaning.report(spark)
    else:
        write_table(clean.clean_photos(raw), photos_path)
        report = clean.clean_report(raw)
    photos = done["photos_clean"] = spark.read.parquet(photos_path)
    if photos.isEmpty():
        raise ValueError("no valid photo in the input")
    keep("clean_report", report)
    photos = keep("photos_enriched", enrich.enrich_roi(photos, rois))
    keep("roi_capture", enrich.roi_capture_stats(photos))
    keep("photos_time", enrich.time_features(photos), partition_by=("year",))
    users = keep("user_profiles", profiles.user_profiles(photos))
    predictions = keep("user_predictions", profiles.user_relevance_model(users))
    keep("model_accuracy", profiles.accuracy(predictions))
    clustered = keep("photo_clusters", clusters.kmeans_clusters(photos, k=k))
    keep("cluster_silhouette", clusters.silhouette(clustered))
    keep("user_transactions", rules.user_transactions(photos))
    keep("roi_rules", rules.association_rules(done["user_transactions"]))
    keep("roi_tags", tags.roi_tags(photos))
    heatmap = keep("view_hourly_heatmap", views.hourly_heatmap(photos, users))
    keep("view_od_matrix", views.od_matrix(photos, users))
    keep("view_hidden_gems", views.hidden_gems_from_heatmap(heatmap))
    return done
