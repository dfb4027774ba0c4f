"""Region labels for points, and time features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.config import ROIS, UNKNOWN_ROI, Roi
from lenstrail.functions.columns import is_known_roi, roi_label
from lenstrail.operators.cells import BUSY, MAX_BROADCAST_CELLS, enrich_boxes
from lenstrail.sources.tables import roi_table

# A CASE chain is evaluated box by box, so it stops paying off with many boxes.
MAX_CASE_ROIS = 64


def enrich_roi(
    df: DataFrame,
    rois: Sequence[Roi] = ROIS,
    *,
    strategy: str = "auto",
    default: str = UNKNOWN_ROI,
    max_broadcast_cells: int = MAX_BROADCAST_CELLS,
    busy: int = BUSY,
) -> DataFrame:
    """Add `roi`: the first box, by position in `rois`, that holds the point.

    `case` is one CASE expression, `grid` joins on cells of several levels (see `cells`), one row
    per point throughout; `auto` takes `case` up to 64 boxes.
    """
    if strategy == "auto":
        strategy = "case" if len(rois) <= MAX_CASE_ROIS else "grid"
    if strategy == "case":
        return df.withColumn("roi", roi_label(rois, default=default))
    if strategy == "grid":
        boxes = roi_table(df.sparkSession, rois)
        return enrich_boxes(df, boxes, default=default, max_broadcast_cells=max_broadcast_cells, busy=busy)
    raise ValueError(f"unknown strategy {strategy!r}")


def roi_capture_stats(df: DataFrame) -> DataFrame:
    """One row: photos, those inside a region, and their share."""
    return df.agg(
        F.count("*").alias("total"), F.count_if(is_known_roi()).alias("mapped")
    ).withColumn("mapped_share", F.coalesce(F.try_divide("mapped", "total"), F.lit(0.0)))


def time_features(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Add hour, month, day_of_week (1 = Sunday), English day_name and four-digit year text."""
    ts = F.col(column)
    return df.withColumns(
        {
            "hour": F.hour(ts),
            "month": F.month(ts),
            "day_of_week": F.dayofweek(ts),
            "day_name": F.date_format(ts, "EEEE"),
            "year": F.date_format(ts, "yyyy"),
        }
    )
