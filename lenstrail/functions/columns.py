"""Column expressions shared by the operators.  All of them stay inside codegen."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lenstrail.config import (
    CITY_BOX,
    DATE_FORMATS,
    HEX_ORIGIN,
    MANY_ROIS,
    METRES_PER_DEG_LAT,
    METRES_PER_DEG_LON,
    RESIDENT_DAYS,
    ROIS,
    SQRT3,
    TOURIST_DAYS,
    UNKNOWN_ROI,
    Box,
    Roi,
)


def parse_timestamp(text: Column, formats: Sequence[str] = DATE_FORMATS) -> Column:
    """First format that parses wins; NULL when none does, with ANSI mode on or off.

    A failed attempt is expensive (it raises inside the parser), so a format that opens
    with a month name is not tried on a digit, nor one that opens with a number on a letter.
    """
    first = F.ascii(text)
    digit = first.between(48, 57)
    letter = first.between(65, 90) | first.between(97, 122)

    def attempt(pattern: str) -> Column:
        parsed = F.try_to_timestamp(text, F.lit(pattern))
        if pattern.startswith("MMM"):
            return F.when(~digit, parsed)
        return F.when(~letter, parsed) if pattern[0] in "yMdHh" else parsed

    return F.coalesce(*[attempt(p) for p in formats])


def in_box(box: Box = CITY_BOX, lat: str = "latitude", lon: str = "longitude") -> Column:
    return F.col(lat).between(box.lat_min, box.lat_max) & F.col(lon).between(box.lon_min, box.lon_max)


def is_known_roi(column: str = "roi") -> Column:
    return F.col(column) != UNKNOWN_ROI


def from_year(first: int, column: str = "timestamp") -> Column:
    """Keep `first` and later years.  A range on the raw column, so it reaches the scan."""
    return F.col(column) >= F.lit(f"{first:04d}-01-01").cast("timestamp")


def roi_label(
    rois: Sequence[Roi] = ROIS,
    lat: str = "latitude",
    lon: str = "longitude",
    default: str = UNKNOWN_ROI,
) -> Column:
    """Name of the first box holding the point; `default` outside all boxes or for NULLs."""
    hits = [F.when(in_box(Box(*roi[1:]), lat, lon), roi.name) for roi in rois]
    return F.coalesce(*hits, F.lit(default))


def planar_distance(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Euclidean distance in degrees (not metres, and not the same in both axes)."""
    return F.sqrt((lat1 - lat2) * (lat1 - lat2) + (lon1 - lon2) * (lon1 - lon2))


def nearest(points: Sequence[tuple], lat: Column, lon: Column) -> Column:
    """Struct (distance, name) of the closest of a few fixed `(name, lat, lon)` points.

    Ties go to the earlier point.  The points are literals, so no join is planned; NULL
    when the position is NULL.
    """
    distances = F.array(*[planar_distance(lat, lon, F.lit(p[1]), F.lit(p[2])) for p in points])
    least = F.array_min(distances)
    names = F.array(*[F.lit(p[0]) for p in points])
    found = F.struct(
        least.alias("distance"),
        F.element_at(names, F.array_position(distances, least).cast("int")).alias("name"),
    )
    return F.when(lat.isNotNull() & lon.isNotNull(), found)


def user_type(days: Column, resident: int = RESIDENT_DAYS, tourist: int = TOURIST_DAYS) -> Column:
    return (
        F.when(days > resident, "Resident").when(days <= tourist, "Tourist").otherwise("Recurring Visitor")
    )


def relevance(days: Column, rois: Column, resident: int = RESIDENT_DAYS, many: int = MANY_ROIS) -> Column:
    return F.when((days > resident) | (rois > many), 1.0).otherwise(0.0)


def localness(resident: Column, total: Column) -> Column:
    return (resident + 1) / (total + 1)


def hex_cell(
    lat: Column,
    lon: Column,
    radius_m: float,
    origin: tuple[float, float] = HEX_ORIGIN,
) -> Column:
    """Struct (hq, hr): axial coordinates of the pointy-top hexagon that holds the point.

    Cube rounding: round q, r and s = -q-r, then rebuild the one that moved most from
    the other two, so that the three still add up to zero.
    """
    x = (lon - F.lit(origin[1])) * METRES_PER_DEG_LON
    y = (lat - F.lit(origin[0])) * METRES_PER_DEG_LAT
    q = (F.lit(SQRT3) / 3 * x - y / 3) / radius_m
    r = (F.lit(2.0) / 3 * y) / radius_m
    s = -q - r
    rq, rr, rs = (F.floor(v + 0.5) for v in (q, r, s))
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    move_q = (dq > dr) & (dq > ds)
    move_r = ~move_q & (dr > ds)
    return F.struct(
        F.when(move_q, -rr - rs).otherwise(rq).cast("bigint").alias("hq"),
        F.when(move_r, -rq - rs).otherwise(rr).cast("bigint").alias("hr"),
    )


def with_share(totals: DataFrame, amount: str, name: str = "share") -> DataFrame:
    """Add each row's part of the sum.  For aggregated frames: the sum runs in one task."""
    return totals.withColumn(name, F.col(amount) / F.sum(amount).over(Window.partitionBy()))
