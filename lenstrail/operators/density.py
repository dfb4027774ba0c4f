"""Density map: hexagon bins, region centres, view centre."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lenstrail.config import HEX_ORIGIN
from lenstrail.functions.columns import hex_cell, is_known_roi


def map_points(df: DataFrame) -> DataFrame:
    """Photos that can be drawn: in a known region, with numeric coordinates."""
    return (
        df.filter(is_known_roi())
        .withColumns({c: F.col(c).try_cast("double") for c in ("latitude", "longitude")})
        .dropna(subset=["latitude", "longitude"])
    )


def hexbin_density(
    df: DataFrame, *, radius_m: float = 20, lat0: float = HEX_ORIGIN[0], lon0: float = HEX_ORIGIN[1]
) -> DataFrame:
    """Photos per hexagon of the given radius: (hq, hr, count)."""
    cell = hex_cell(F.col("latitude"), F.col("longitude"), float(radius_m), (lat0, lon0))
    return (
        df.dropna(subset=["latitude", "longitude"])
        .select(cell.alias("cell"))
        .groupBy("cell.hq", "cell.hr")
        .agg(F.count("*").alias("count"))
    )


def roi_centres(df: DataFrame, top: int | None = None) -> DataFrame:
    """Mean position and number of photos per region; with `top`, of the busiest only."""
    centres = df.groupBy("roi").agg(
        F.avg("latitude").alias("lat"), F.avg("longitude").alias("lon"), F.count("*").alias("count")
    )
    return centres if top is None else centres.orderBy(F.desc("count"), "roi").limit(top)


def map_counts(points: DataFrame, drawn: DataFrame) -> DataFrame:
    """One row (matching, drawn): photos under the filters, and those left after sampling."""
    marks = points.select(F.lit(1).alias("matching"), F.lit(0).alias("drawn")).union(
        drawn.select(F.lit(0), F.lit(1))
    )
    return marks.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("matching", "drawn")])


def view_centre(df: DataFrame, default: tuple[float, float] = HEX_ORIGIN) -> DataFrame:
    """One row (lat, lon, count): where to centre the map, `default` if nothing is left to show."""
    return df.agg(
        F.coalesce(F.avg("latitude"), F.lit(default[0])).alias("lat"),
        F.coalesce(F.avg("longitude"), F.lit(default[1])).alias("lon"),
        F.count("*").alias("count"),
    )
