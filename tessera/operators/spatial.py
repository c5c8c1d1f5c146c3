"""Points, regions and adaptive cells.

``points_in_regions`` joins points with rectangles or polygons over a grid of several
resolutions: a region lies on the grid whose cells are at least as large as it is, so it touches four cells
at most, and a point has one cell on each grid in use.  The join is an equality of cells; the
exact test comes after it.  Neither side is broadcast by force and no pair is formed outside a cell.

``adaptive_cells`` splits the plane into quarters until a cell holds no more than a number of
points: one Morton code per point, counted first, so the levels work on counts of distinct codes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_LEVELS = 64  # cell sizes from 2^-32 to 2^31
_LOWEST = -32


def _cell(x: Column, level: Column) -> Column:
    return F.floor(x / F.pow(F.lit(2.0), level + F.lit(_LOWEST)))


def region_cells(regions: DataFrame, id_col: str) -> DataFrame:
    """``id_col, level, cx, cy``: the cells that each region's box touches, four at most.

    The level is the smallest whose cells are at least as large as the box.
    """
    size = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"), F.pow(F.lit(2.0), F.lit(_LOWEST)))
    level = F.least(F.ceil(F.log2(size)).cast("int") - F.lit(_LOWEST), F.lit(_LEVELS - 1))
    placed = regions.select(id_col, "min_x", "max_x", "min_y", "max_y", level.alias("level"))
    return (placed.withColumn("cx", F.explode(F.sequence(_cell(F.col("min_x"), F.col("level")), _cell(F.col("max_x"), F.col("level")))))
            .withColumn("cy", F.explode(F.sequence(_cell(F.col("min_y"), F.col("level")), _cell(F.col("max_y"), F.col("level")))))
            .select(id_col, "level", "cx", "cy"))


def in_ring(x: Column, y: Column, ring: Column) -> Column:
    """Whether a point is inside a closed ring of ``(x, y)`` structs: an odd number of edges lies to its right."""
    edges = F.zip_with(ring, F.concat(F.slice(ring, 2, F.size(ring) - 1), F.slice(ring, 1, 1)), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def crosses(e: Column) -> Column:
        a, b = e["a"], e["b"]
        above = (a["y"] > y) != (b["y"] > y)
        at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.nullif(b["y"] - a["y"], F.lit(0.0))
        return above & (x < at)

    return F.size(F.filter(edges, crosses)) % 2 == 1


def points_in_regions(points: DataFrame, regions: DataFrame, x: str, y: str, id_col: str = "region", ring_col: str | None = None) -> DataFrame:
    """``points``' columns and ``id_col`` for every region that holds the point.

    Regions have ``min_x, max_x, min_y, max_y`` (ends included) and, with ``ring_col``, a polygon of
    ``(x, y)`` structs inside that box.  A point may lie in many regions or in none; points or boxes with NULL or
    NaN coordinates lie nowhere.  Boxes beyond 2^31 in size touch more cells, none is left out.
    """
    boxes = regions.filter("min_x <= max_x AND min_y <= max_y AND NOT isnan(max_x) AND NOT isnan(max_y)")
    cells = region_cells(boxes, id_col)
    levels = [r.level for r in cells.select("level").distinct().collect()]  # 64 at most
    shape = boxes.select(F.col(id_col).alias("__id"), *(F.col(c).alias(f"__{c}") for c in ("min_x", "max_x", "min_y", "max_y")),
                         *([F.col(ring_col).alias("__ring")] if ring_col else []))
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    dealt = (points.filter(px.isNotNull() & py.isNotNull() & ~F.isnan(px) & ~F.isnan(py))
             .withColumn("__level", F.explode(F.array(*map(F.lit, levels)).cast("array<int>")))
             .withColumn("__cx", _cell(px, F.col("__level"))).withColumn("__cy", _cell(py, F.col("__level"))))
    keys = cells.select(F.col(id_col).alias("__id"), F.col("level").alias("__level"), F.col("cx").alias("__cx"), F.col("cy").alias("__cy"))
    found = dealt.join(keys.join(shape, "__id"), ["__level", "__cx", "__cy"])
    inside = px.between(F.col("__min_x"), F.col("__max_x")) & py.between(F.col("__min_y"), F.col("__max_y"))
    if ring_col:
        inside = inside & in_ring(px, py, F.col("__ring"))
    return found.filter(inside).select(*points.columns, F.col("__id").alias(id_col))


def density_by_region_and_hour(points: DataFrame, regions: DataFrame, x: str, y: str, hour: Column, id_col: str = "region",
                               count_name: str = "n") -> DataFrame:
    """Points per region and hour.  Equal points are counted before the join, so a crowded spot is one row."""
    spots = points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), hour.alias("hour"))
    spots = spots.groupBy("x", "y", "hour").agg(F.count(F.lit(1)).alias("__n"))
    return points_in_regions(spots, regions, "x", "y", id_col).groupBy(id_col, "hour").agg(F.sum("__n").alias(count_name))


def morton_code(ix: Column, iy: Column) -> Column:
    """The bits of two numbers below 2^31 interleaved: ``ix`` on the even places."""
    def spread(v: Column) -> Column:
        for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)):
            v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask))
        return v

    return spread(ix.cast("long")).bitwiseOR(F.shiftleft(spread(iy.cast("long")), 1))


def _every_second_bit(code: Column) -> Column:
    v = code.bitwiseAND(F.lit(0x5555555555555555))
    for shift, mask in ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF), (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF)):
        v = v.bitwiseOR(F.shiftright(v, shift)).bitwiseAND(F.lit(mask))
    return v


def adaptive_cells(points: DataFrame, x: str, y: str, most: int, depth: int = 16, count_name: str = "n") -> DataFrame:
    """``level, cell_x, cell_y, <count>``: quarters of quarters of the points' box until a cell holds ``most`` points or fewer.

    Cells at ``depth`` are kept whatever they hold (equal points cannot be split); empty cells are
    not told.  Level 0 is the whole box, level ``l`` has ``2^l`` cells a side.
    """
    spots = points.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
    spots = spots.filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(x) AND NOT isnan(y)")
    box = spots.agg(F.struct(*(f(c).alias(f"{n}_{c}") for c in "xy" for n, f in (("min", F.min), ("max", F.max))))).scalar()
    side = 1 << depth

    def place(c: str) -> Column:
        low, high = box[f"min_{c}"], box[f"max_{c}"]
        return F.least(F.floor((F.col(c) - low) / F.nullif(high - low, F.lit(0.0)) * F.lit(float(side))), F.lit(side - 1))

    deepest = (spots.groupBy(F.coalesce(place("x"), F.lit(0)).alias("ix"), F.coalesce(place("y"), F.lit(0)).alias("iy"))
               .agg(F.count(F.lit(1)).alias("n")).select(morton_code(F.col("ix"), F.col("iy")).alias("code"), "n"))
    # A code's prefixes are its cells on all levels; sums are formed map-side first.
    cells = (deepest.select(F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("level"), "code", "n")
             .select("level", F.expr(f"shiftright(code, 2 * ({depth} - level))").alias("cell"), "n")
             .groupBy("level", "cell").agg(F.sum("n").alias("n")))
    # Told: cells that are small enough, or cannot be split, below a cell that was not.
    crowded = (cells.filter((F.col("n") > most) & (F.col("level") < depth))
               .select((F.col("level") + 1).alias("level"), F.explode(F.array(*(F.col("cell") * 4 + q for q in range(4)))).alias("cell")))
    small = cells.filter((F.col("n") <= most) | (F.col("level") == depth))
    told = small.join(crowded, ["level", "cell"], "left_semi").unionByName(small.filter("level = 0"))
    return told.select("level", _every_second_bit(F.col("cell")).alias("cell_x"), _every_second_bit(F.shiftright("cell", 1)).alias("cell_y"),
                       F.col("n").alias(count_name))


__all__ = ["region_cells", "in_ring", "points_in_regions", "density_by_region_and_hour", "morton_code", "adaptive_cells"]
