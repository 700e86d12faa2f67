"""Which points lie in which areas, whatever the size of an area and the crowd of points.

An area of few edges is joined as a whole, see ``spatial_join``.  Any other begins as the grid cells of
about its own size that it touches, four at most.  A cell with many points is cut into quarters, and these again: quarters that no
edge of the area touches are inside or dropped, the others keep the edges that
can matter to a point in them.  A point meets one cell of an area at most.  In an inside cell it needs no further test, in a
border cell it is tested against that cell's edges, not against the whole outline.

How many points a cell has is counted cell by cell.  Only counts over the limit are kept, so these
are fewer than the points looked up divided by the limit.  Cells that are still crowded are dealt out over several keys.
Points and areas are each kept in the shared folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.functions.geometry import _let, edges_of, few_edges, point_in_edges
from mapstrata.operators.spatial_join import (
    BOX,
    CELL,
    PIECE_BOX,
    POINTS_PER_KEY,
    STEP,
    _cell,
    _kept,
    _level,
    grid_levels,
    grid_of,
    numbers,
    packed,
    points_in_pieces,
    whole_pieces,
)

#: How often a cell may be cut.
MAX_DEPTH = 8


def _touches(e: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    """Whether an edge may touch a closed box; one that passes very close counts too."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    near = F.greatest(F.abs(dx), F.abs(dy)) * F.greatest(F.abs(x1), F.abs(y1), F.abs(x1 - x0)) * 1e-12
    sides = F.array(*[dx * (y - e["ay"]) - dy * (x - e["ax"]) for x in (x0, x1) for y in (y0, y1)])
    return (
        (F.least(e["ax"], e["bx"]) <= x1)
        & (F.greatest(e["ax"], e["bx"]) >= x0)
        & (F.least(e["ay"], e["by"]) <= y1)
        & (F.greatest(e["ay"], e["by"]) >= y0)
        & _let(sides, lambda s: (F.array_min(s) <= near) & (F.array_max(s) >= -near))
    )


def _judged(cells: DataFrame) -> DataFrame:
    """Cells of which ``_inside`` is not settled become inside, border or nothing."""
    size = F.pow(F.lit(2.0), F.col("_level"))
    x0, y0 = F.col("_cx") * size, F.col("_cy") * size
    x1, y1 = x0 + size, y0 + size

    def verdict(edges: Column) -> Column:
        hit = F.exists(F.flatten(edges), lambda e: _touches(e, x0, y0, x1, y1))
        return F.when(hit, "border").when(
            point_in_edges((x0 + x1) / 2, (y0 + y1) / 2, edges), "inside"
        )

    def useful(e: Column) -> Column:
        return (
            (F.greatest(e["ay"], e["by"]) >= y0)
            & (F.least(e["ay"], e["by"]) <= y1)
            & (F.greatest(e["ax"], e["bx"]) >= x0)
        )

    near = F.filter(
        F.transform(F.col("_edges"), lambda part: F.filter(part, useful)), lambda part: F.size(part) > 0
    )
    none = F.lit(None)
    return (
        cells.withColumn("_is", F.when(F.col("_inside"), "inside").otherwise(verdict(F.col("_edges"))))
        .filter(F.col("_is").isNotNull())
        .withColumn("_inside", F.col("_is") == "inside")
        .withColumn("_edges", F.when(F.col("_inside"), none).otherwise(near))
        .drop("_is")
    )


def _quartered(cells: DataFrame) -> DataFrame:
    """Cells with cuts left become their quarters that the area's box reaches."""
    half = F.pow(F.lit(2.0), F.col("_level") - 1)

    def quarter(dx: int, dy: int) -> Column:
        cx, cy = F.col("_cx") * 2 + dx, F.col("_cy") * 2 + dy
        reached = (
            (cx * half <= F.col("xmax"))
            & ((cx + 1) * half >= F.col("xmin"))
            & (cy * half <= F.col("ymax"))
            & ((cy + 1) * half >= F.col("ymin"))
        )
        made = F.struct(
            (F.col("_level") - 1).alias("l"), cx.alias("x"), cy.alias("y"), (F.col("_cuts") - 1).alias("c")
        )
        return F.when(reached, made)

    same = F.struct(
        F.col("_level").alias("l"), F.col("_cx").alias("x"), F.col("_cy").alias("y"), F.col("_cuts").alias("c")
    )
    quarters = F.array_compact(F.array(*[quarter(dx, dy) for dx in (0, 1) for dy in (0, 1)]))
    return cells.withColumn(
        "_next", F.explode(F.when(F.col("_cuts") > 0, quarters).otherwise(F.array(same)))
    ).withColumns(
        {"_level": F.col("_next.l"), "_cx": F.col("_next.x"), "_cy": F.col("_next.y"), "_cuts": F.col("_next.c")}
    ).drop("_next")


def _looked_up(points: DataFrame, levels: list[int]) -> DataFrame:
    """Each point once in every grid of ``levels``, 61 + MAX_DEPTH at most."""
    level = F.col("_level")
    return (
        points.withColumn("_level", F.explode(F.array(*[F.lit(v) for v in levels])))
        .withColumn("_cx", _cell(F.col("x"), level))
        .withColumn("_cy", _cell(F.col("y"), level))
    )


def _crowded(looked_up: DataFrame, limit: int) -> DataFrame:
    """(cell, _n) of the cells with more than ``limit`` points; these are fewer than rows / limit."""
    return looked_up.groupBy(*CELL).agg(F.count("*").alias("_n")).filter(F.col("_n") > limit)


def _levels(df: DataFrame) -> list[int]:
    return sorted(row["_level"] for row in df.select("_level").distinct().collect())


def cover(areas: DataFrame, points: DataFrame, limit: int = POINTS_PER_KEY, depth: int = MAX_DEPTH) -> DataFrame:
    """Cells of ``areas``: their columns without ``geometry``, the cell, _inside and, at the border, _edges.

    ``points`` (x, y) tell where cells are cut: until a cell has at most ``limit`` points or was cut ``depth`` times.
    """
    level = F.col("_level")
    box = {c: F.col(c) for c in BOX}
    own = (
        areas.filter(F.col("xmin").isNotNull())
        .withColumn("_level", _level(**box))
        .withColumn("_cx", F.explode(F.sequence(_cell(box["xmin"], level), _cell(box["xmax"], level))))
        .withColumn("_cy", F.explode(F.sequence(_cell(box["ymin"], level), _cell(box["ymax"], level))))
        .withColumn("_edges", edges_of(F.col("geometry")["parts"]))
        .drop("geometry")
        .withColumn("_inside", F.lit(False))
    )
    own = _kept(_judged(own), "cells")
    levels = _levels(own)
    cuts = F.ceil(F.log2(F.col("_n") / F.lit(limit)) / 2).cast("int")
    crowds = _crowded(_looked_up(points, levels), limit) if levels else None
    if crowds is None:
        return own
    counted = own.join(crowds, [*CELL], "left")
    # A cell that is empty or not crowded has no count and keeps its size.
    cells = counted.withColumn("_cuts", F.when(F.col("_n").isNull(), 0).otherwise(F.least(cuts, F.lit(depth)))).drop("_n")
    cells = _kept(cells, "cuts")
    deepest = cells.agg(F.max("_cuts")).first()[0] or 0
    for _ in range(deepest):
        cells = _judged(_quartered(cells))
    return cells.drop("_cuts")


def _cell_pieces(cells: DataFrame) -> DataFrame:
    """Cells of a cover as pieces: what lies of the area's box in the cell, without its upper ends."""
    size = F.pow(F.lit(2.0), F.col("_level"))
    x0, y0 = F.col("_cx") * size, F.col("_cy") * size
    ends = {
        "_px0": F.greatest(F.col("xmin"), x0),
        "_py0": F.greatest(F.col("ymin"), y0),
        "_px1": F.least(F.col("xmax"), x0 + size),
        "_py1": F.least(F.col("ymax"), y0 + size),
        "_ex": x0 + size,
        "_ey": y0 + size,
    }
    return cells.withColumns(ends).drop(*CELL)


def points_in_areas_by_cover(
    points: DataFrame, areas: DataFrame, limit: int = POINTS_PER_KEY, depth: int = MAX_DEPTH
) -> DataFrame:
    """Pairs of a point and an area that intersect; points on an outline do.

    ``points`` has ``x`` and ``y``; ``areas`` has the four extent columns and ``geometry`` (a
    polygon kind).  Other columns must not share names.  The result has the
    columns of both but ``geometry``.  Points without a coordinate and areas without an extent are in no pair.
    """
    columns = [c for c in areas.columns if c != "geometry"]
    edges = edges_of(F.col("geometry")["parts"])
    shapes = areas.filter(F.col("xmin").isNotNull()).withColumn("_simple", few_edges(edges))
    shapes = _kept(shapes, "shapes")
    grids = sorted({-(-level // STEP) * STEP for level in grid_levels(shapes)})
    packs = packed(points, grids[-1]) if grids else None
    if packs is None:
        return points.join(areas.drop("geometry"), F.lit(False))
    packs = _kept(packs, "packs")
    simple = whole_pieces(shapes.filter("_simple").drop("_simple")).drop("geometry")
    spots = packs.select(F.inline("_points")).select("x", "y")
    cells = _kept(cover(shapes.filter("NOT _simple").drop("_simple"), spots, limit, depth), "cover")
    pieces = _kept(simple.unionByName(_cell_pieces(cells)), "pieces")
    box = [F.col(n) for n in PIECE_BOX]
    grids = numbers(pieces.select(grid_of(*box).alias("_grid")), "_grid")
    few_only = pieces.filter(~F.col("_inside") & ~few_edges(F.col("_edges"))).isEmpty()
    return points_in_pieces(packs, pieces, columns, grids, few_only, limit)
