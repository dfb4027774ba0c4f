"""Labels points with the first of many boxes that holds them, by cells of several levels.

A cell of level n is a square of 360 / 2**n degrees.  A box is filed under the cells it touches at the
level whose cells are just smaller than its longer side: three by three at most, whatever its size.
A point looks up one cell per level in use, so small and large boxes cost the same and no point
is compared with boxes that are far away.  Each level is a join that keeps one row per point.

Where many boxes overlap, most never win: those behind a box that covers the whole cell, or that look the
same from within it.  Cells with many boxes are rid of these, and split while many are left, so
that a point is compared with few boxes however many lie over it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lenstrail.config import UNKNOWN_ROI
from lenstrail.sources.tables import cut_lineage

TURN = 360.0
FINEST = 24  # cells of about two metres
MAX_BROADCAST_CELLS = 200_000
BUSY = 1_000_000
MOST = 16  # boxes of a cell above which it is looked into
ROUNDS = 12
GROWTH = 4  # rows of split cells to those of the first, above which splitting ends
BOUNDS = ("lat_min", "lat_max", "lon_min", "lon_max")


def _size(level: Column) -> Column:
    return F.lit(TURN) / F.pow(F.lit(2.0), level)


def _place(degrees: Column, level: Column) -> Column:
    """Number of the cell along one axis; a monotone function, so bounds and points agree."""
    return F.floor(degrees / _size(level))


CELL = ["level", "y", "x"]


def _filed(boxes: DataFrame) -> DataFrame:
    """One row (level, y, x, priority, roi, bounds) for each box and cell that it is filed under."""
    side = F.greatest(F.col("lat_max") - F.col("lat_min"), F.col("lon_max") - F.col("lon_min"))
    level = F.when(side > 0, F.floor(F.log2(F.lit(TURN) / side)) + 1).otherwise(FINEST)
    filed = boxes.where("lat_min <= lat_max AND lon_min <= lon_max").withColumn(
        "level", F.least(F.greatest(level, F.lit(0)), F.lit(FINEST)).cast("int")
    )

    def along(low: str, high: str) -> Column:
        return F.explode(F.sequence(_place(F.col(low), F.col("level")), _place(F.col(high), F.col("level"))))

    placed = filed.withColumn("y", along("lat_min", "lat_max")).withColumn("x", along("lon_min", "lon_max"))
    return placed.select(*CELL, "priority", "roi", *BOUNDS)


def _listed(filed: DataFrame) -> DataFrame:
    return filed.groupBy(*CELL).agg(F.array_sort(F.collect_list(F.struct("priority", "roi", *BOUNDS))).alias("boxes"))


def box_cells(boxes: DataFrame) -> DataFrame:
    """(level, y, x, boxes): each cell with the boxes filed there, the first in priority first.

    `boxes` has roi, priority and inclusive bounds; boxes that hold no point are left out.
    """
    return _listed(_filed(boxes))


def _seen_from_within() -> dict[str, Column]:
    """Bounds that lie in the cell, NULL for those beyond it.  A point of the cell is not in a cell beyond it."""
    at = {"lat": F.col("y"), "lon": F.col("x")}
    return {f"_{b}": F.when(_place(F.col(b), F.col("level")) == at[b[:3]], F.col(b)) for b in BOUNDS}


def _split(filed: DataFrame) -> DataFrame:
    """Rows of the four cells a level finer that the box touches."""

    def halves(low: str, high: str, at: str) -> Column:
        finer = F.col("level") + 1
        first = F.greatest(_place(F.col(low), finer), 2 * F.col(at))
        return F.explode(F.sequence(first, F.least(_place(F.col(high), finer), 2 * F.col(at) + 1)))

    down = filed.withColumn("_y", halves("lat_min", "lat_max", "y")).withColumn("_x", halves("lon_min", "lon_max", "x"))
    return down.select((F.col("level") + 1).alias("level"), F.col("_y").alias("y"), F.col("_x").alias("x"), "priority", "roi", *BOUNDS)


def _first_boxes(filed: DataFrame) -> DataFrame:
    """`filed` without boxes that no point of their cell gets, crowded cells split where that leaves few boxes.

    Of boxes with the same bounds within a cell only the first counts, and none behind the first that covers
    the cell.  What is left is filed a level finer while it is more than MOST; where boxes differ
    by so little that this only copies them, the rounds end and the cell keeps them all.
    """
    rank = F.struct("priority", "roi")
    done, first = [], 0
    for _ in range(ROUNDS):
        seen = filed.withColumns(_seen_from_within())
        covers = F.coalesce(*[F.col(f"_{b}") for b in BOUNDS]).isNull()
        crowded = cut_lineage(seen.groupBy(*CELL).agg(F.count("*").alias("n"), F.min(F.when(covers, rank)).alias("cover")).where(F.col("n") > MOST))
        if crowded.isEmpty():
            break
        done.append(filed.join(crowded, CELL, "left_anti"))
        useful = seen.join(crowded.select(*CELL, "cover"), CELL).where(F.col("cover").isNull() | (rank <= F.col("cover")))
        same = useful.groupBy(*CELL, *[f"_{b}" for b in BOUNDS]).agg(F.min(F.struct("priority", "roi", *BOUNDS)).alias("box"))
        useful = cut_lineage(same.select(*CELL, "box.*"))
        full = useful.where(F.col("level") < FINEST).groupBy(*CELL).count().where(F.col("count") > MOST).drop("count")
        n = useful.join(full, CELL, "left_semi").count()
        first = first or n
        if not n or n > GROWTH * first:
            filed = useful
            break
        done.append(useful.join(full, CELL, "left_anti"))
        filed = cut_lineage(_split(useful.join(full, CELL, "left_semi")))
    for frame in done:
        filed = filed.union(frame)
    return filed


def _crowded(df: DataFrame, levels: list[int], busy: int) -> DataFrame:
    """(level, y, x, parts) of cells with more than `busy` points, counted in one pass over the points."""
    level = F.explode(F.array(*[F.lit(n) for n in levels])).alias("level")
    at = df.select("latitude", "longitude", level)
    counts = at.groupBy("level", _place(F.col("latitude"), F.col("level")).alias("y"), _place(F.col("longitude"), F.col("level")).alias("x"))
    counted = counts.agg(F.count("*").alias("n")).where(F.col("n") > busy)
    return cut_lineage(counted.select("level", "y", "x", F.ceil(F.col("n") / busy).cast("int").alias("parts")))


def _spread_join(points: DataFrame, cells: DataFrame, crowded: DataFrame, keys: list[str]) -> DataFrame:
    """Left join by a shuffle in which the points of a crowded cell are dealt over several tasks."""
    parts = F.coalesce("parts", F.lit(1))
    copies = cells.join(crowded, keys, "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1))).drop("parts")
    # A point meets all boxes of its cell in whichever part it comes.
    dealt = points.join(crowded, keys, "left").withColumn("part", (F.monotonically_increasing_id() % parts).cast("int")).drop("parts")
    return dealt.join(copies, [*keys, "part"], "left").drop("part")


def enrich_boxes(
    df: DataFrame,
    boxes: DataFrame,
    *,
    default: str = UNKNOWN_ROI,
    max_broadcast_cells: int = MAX_BROADCAST_CELLS,
    busy: int = BUSY,
) -> DataFrame:
    """Add `roi`: of the boxes that hold the point, the one with the least (priority, roi).

    Bounds are inclusive; points without a position get `default`.  Cells hold the boxes that some point of
    theirs may get (see `_first_boxes`), are stored and counted:
    up to the bound they are broadcast and the points stay where they are.  Beyond it
    both sides are shuffled by cell, a level at a time, and cells whose counted points are more than
    `busy` are dealt over several tasks.
    """
    cells = cut_lineage(_listed(_first_boxes(_filed(boxes))))
    levels = {r.level: r["count"] for r in cells.groupBy("level").count().collect()}  # 25 at most
    few = sum(levels.values()) <= max_broadcast_cells
    crowded = None if few else _crowded(df, sorted(levels), busy)
    few_crowded = not few and crowded.count() <= max(max_broadcast_cells, 1)
    out = df.withColumn("_best", F.lit(None).cast("struct<priority: int, roi: string>"))
    lat, lon = F.col("latitude"), F.col("longitude")
    for level in sorted(levels):
        here = cells.where(F.col("level") == level).select(F.col("y").alias("_y"), F.col("x").alias("_x"), "boxes")
        placed = out.withColumns({"_y": _place(lat, F.lit(level)), "_x": _place(lon, F.lit(level))})
        if few:
            found = placed.join(F.broadcast(here), ["_y", "_x"], "left")
        else:
            full = crowded.where(F.col("level") == level).select(F.col("y").alias("_y"), F.col("x").alias("_x"), "parts")
            found = _spread_join(placed, here, F.broadcast(full) if few_crowded else full, ["_y", "_x"])
        holding = F.filter("boxes", lambda b: lat.between(b.lat_min, b.lat_max) & lon.between(b.lon_min, b.lon_max))
        first = F.get(holding, 0)
        best = F.when(first.isNotNull(), F.struct(first.priority.cast("int").alias("priority"), first.roi.alias("roi")))
        out = found.withColumn("_best", F.least(F.col("_best"), best) if len(levels) > 1 else best).drop("boxes", "_y", "_x")
    return out.withColumn("roi", F.coalesce(F.col("_best.roi"), F.lit(default))).select(*df.columns, "roi")
