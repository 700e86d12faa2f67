"""Which points lie in which areas.

Points are packed first: those of one square of the map, ``PACK`` at most, become one row with
their box.  Squares are as small as the crowd asks for, so a pack is tight where it matters.
Packs and areas go on a grid whose cell is about as large as the box itself, one grid
per ``STEP`` powers of two, so a box touches four cells at most.  A pair of boxes meets on
the coarser grid of the two, in the one cell that holds the lower left corner of their overlap.  The cells turn
the range test into an equi-join that Spark shuffles by cell.

A pack that no edge of an area touches lies inside as a whole or not at all, so its points are not looked at
one by one; points of the other packs are.  Packs of a crowded cell are spread over several shuffle keys.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.geometry import (
    box_touches_edges,
    edge_bounds,
    edges_of,
    few_columns,
    few_edges,
    point_in_bounded_edges,
    point_in_edges,
    with_few_edges,
)
from mapstrata.settings import shared_folder

# Cell sizes run from 2^-30 to 2^30 units, so there are 61 grids at most.
LEVEL_LIMIT = 30
#: Points that a pack has at most, and that one join key should have at most.
PACK = 64
POINTS_PER_KEY = 50_000
#: Packs and areas use every third grid.
STEP = 3
BOX = ("xmin", "ymin", "xmax", "ymax")
CELL = ("_level", "_cx", "_cy")
EDGES_TYPE = "array<array<struct<ax:double,ay:double,bx:double,by:double>>>"
_PACK_BOX = ("_ax0", "_ay0", "_ax1", "_ay1")
PIECE_BOX = ("_px0", "_py0", "_px1", "_py1")
# Squares of the map are numbered along a curve by so many bits a side.
_BITS = 31


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder."""
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _level(xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
    side = F.greatest(xmax - xmin, ymax - ymin)
    level = F.when(side > 0, F.ceil(F.log2(side))).otherwise(-LEVEL_LIMIT)
    return F.greatest(F.least(level, F.lit(LEVEL_LIMIT)), F.lit(-LEVEL_LIMIT)).cast("int")


def _cell(value: Column, level: Column) -> Column:
    return F.floor(value / F.pow(F.lit(2.0), level))


def _shuffled(on_grid: DataFrame) -> DataFrame:
    """Rows on a grid, never to be sent whole to the driver and all tasks.

    Spark takes an array for one element and an explode for one row, so it would broadcast
    a side of many gigabytes whose source file is small.
    """
    return on_grid.hint("merge")


def grid_levels(areas: DataFrame) -> list[int]:
    """The grids in use: at most 61 numbers, by construction."""
    boxes = areas.filter(F.col("xmin").isNotNull())
    levels = boxes.select(_level(*[F.col(c) for c in ("xmin", "ymin", "xmax", "ymax")]).alias("l"))
    return sorted(row["l"] for row in levels.distinct().collect())


def grid_of(*box: Column) -> Column:
    """The grid in use for a box: its own level or one or two above."""
    return (F.ceil(_level(*box) / STEP) * STEP).cast("int")


def numbers(df: DataFrame, column: str) -> list[int]:
    return sorted(row[column] for row in df.select(column).distinct().collect())


def _along_curve(df: DataFrame, low: tuple[float, float], extent: float) -> DataFrame:
    """Add ``_z``: the bits of the place of (x, y) in x and y, in turns."""
    for name, start in zip("xy", low, strict=True):
        place = F.floor((F.col(name) - start) * (((1 << _BITS) - 1) / extent))
        df = df.withColumn(f"_z{name}", F.greatest(F.least(place, F.lit((1 << _BITS) - 1)), F.lit(0)))
    # Step by step, so that no expression holds another one twice.
    for shift, mask in ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                        (2, 0x3333333333333333), (1, 0x5555555555555555)):
        df = df.withColumns(
            {
                f"_z{n}": F.col(f"_z{n}").bitwiseOR(F.shiftleft(f"_z{n}", shift)).bitwiseAND(F.lit(mask))
                for n in "xy"
            }
        )
    return df.withColumn("_z", F.col("_zx").bitwiseOR(F.shiftleft("_zy", 1))).drop("_zx", "_zy")


def pack_starts(z: np.ndarray, size: int, most: int = _BITS) -> np.ndarray:
    """Where packs start in sorted places along the curve.

    A pack is the largest square, of ``most`` bits a side at most, with no more than
    ``size`` of the places; more than that on one spot become several.
    """
    span = int(z[0] ^ z[-1]).bit_length()
    starts, settled = np.zeros(len(z), bool), np.zeros(len(z), bool)
    for bits in range(min((span + 1) // 2, most), -1, -1):
        squares = z >> (2 * bits)
        at = np.flatnonzero(np.concatenate([[True], squares[1:] != squares[:-1]]))
        counts = np.diff(np.append(at, len(z)))
        small = counts <= size
        starts[at] |= small & ~settled[at]
        settled |= np.repeat(small, counts)
        if settled.all():
            return np.flatnonzero(starts)
    place = np.arange(len(z)) - np.repeat(at, counts)
    return np.flatnonzero(starts | (~settled & (place % size == 0)))


def _packing(names: list[str], most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            starts = pack_starts(batch.column("_z").to_numpy(zero_copy_only=False), PACK, most)
            ends = np.append(starts, batch.num_rows)
            fields = [batch.schema.field(n) for n in names]
            rows = pa.StructArray.from_arrays([batch.column(n) for n in names], fields=fields)
            x, y = (batch.column(n).to_numpy(zero_copy_only=False) for n in "xy")
            box = [at.reduceat(v, starts) for at in (np.minimum, np.maximum) for v in (x, y)]
            columns = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows), pa.array(np.diff(ends), pa.int32())]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, box)], ["_points", "_n", *_PACK_BOX])

    return run


def packed(points: DataFrame, coarsest: int = LEVEL_LIMIT) -> DataFrame | None:
    """Points in packs: ``_points``, how many (``_n``), their box and its grid (``_grid``); None without any.

    No pack is from a square larger than a cell of the grid ``coarsest``.  A task has a stretch
    of the curve and packs a batch at a time.
    """
    names = points.columns
    points = points.withColumns({n: F.col(n).cast("double") for n in "xy"})
    limits = [F.col(n).isNotNull() & (F.abs(F.col(n)) < float("inf")) for n in "xy"]
    points = points.filter(limits[0] & limits[1])
    low_x, low_y, high_x, high_y = points.agg(F.min("x"), F.min("y"), F.max("x"), F.max("y")).first()
    if low_x is None:
        return None
    extent = max(high_x - low_x, high_y - low_y) or 1.0
    most = int(np.clip(np.floor(coarsest + _BITS - np.log2(extent)), 0, _BITS))
    placed = _along_curve(points, (low_x, low_y), extent)
    # Rows of one spot may go to several tasks.
    sorted_rows = placed.repartitionByRange("_z", F.xxhash64(*names)).sortWithinPartitions("_z")
    kind = T.StructType([
        T.StructField("_points", T.ArrayType(points.schema, False)), T.StructField("_n", T.IntegerType()),
        *[T.StructField(n, T.DoubleType()) for n in _PACK_BOX],
    ])
    packs = sorted_rows.mapInArrow(_packing(names, most), kind)
    return packs.withColumn("_grid", grid_of(*[F.col(n) for n in _PACK_BOX]))


def whole_pieces(areas: DataFrame, exact: bool = True) -> DataFrame:
    """Areas as pieces, each the whole of its area."""
    there = areas.filter(F.col("xmin").isNotNull())
    ends = {p: F.col(c) for p, c in zip(PIECE_BOX, BOX, strict=True)}
    none = F.lit(None).cast(EDGES_TYPE)
    edges = edges_of(F.col("geometry")["parts"]) if exact else none
    open_ends = {n: F.lit(float("inf")) for n in ("_ex", "_ey")}
    return there.withColumns({**ends, **open_ends, "_inside": F.lit(not exact), "_edges": edges})


def _on_grids(df: DataFrame, box: tuple[str, ...], own: int, other: int, others: Column) -> DataFrame:
    """Rows on their own grid, marked ``own``, and on the grids ``others``, marked ``other``."""
    level = F.col("_level")
    mine = F.struct(F.col("_grid").alias("l"), F.lit(own).alias("t"))
    theirs = F.transform(others, lambda v: F.struct(v.alias("l"), F.lit(other).alias("t")))
    box = [F.col(n) for n in box]
    return (
        df.withColumn("_at", F.explode(F.concat(F.array(mine), theirs)))
        .withColumns({"_level": F.col("_at.l"), "_coarser": F.col("_at.t")})
        .drop("_at")
        .withColumn("_cx", F.explode(F.sequence(_cell(box[0], level), _cell(box[2], level))))
        .withColumn("_cy", F.explode(F.sequence(_cell(box[1], level), _cell(box[3], level))))
    )


def _levels_of(levels: list[int]) -> Column:
    return F.array(*[F.lit(v) for v in levels]).cast("array<int>")


def _salted(packs: DataFrame, pieces: DataFrame, limit: int, salts: int | None) -> tuple[DataFrame, DataFrame]:
    """Packs of crowded cells dealt out over keys, and the cell's pieces repeated for each key.

    A cell is crowded if it has more than ``limit`` points.  Pieces are repeated less often than
    ``PACK`` points come to one of them, so they do not become more than the points.
    """
    keys = [*CELL, "_coarser"]
    crowds = packs.groupBy(*keys).agg(F.sum("_n").alias("_crowd")).filter(F.col("_crowd") > limit)
    crowds = _kept(crowds, "crowds")
    if crowds.isEmpty():
        return packs.withColumn("_salt", F.lit(0)), pieces.withColumn("_salt", F.lit(0))
    met = pieces.select(*keys).join(crowds, keys).groupBy(*keys, "_crowd").agg(F.count("*").alias("_pieces"))
    keyed = F.least(F.ceil(F.col("_crowd") / limit), F.ceil(F.col("_crowd") / (PACK * F.col("_pieces"))))
    if salts is not None:
        keyed = F.least(keyed, F.lit(salts))
    table = _kept(met.select(*keys, keyed.cast("int").alias("_salts")).filter("_salts > 1"), "salts")
    some = F.coalesce(F.col("_salts"), F.lit(1))
    dealt = (
        packs.join(table, keys, "left")
        .withColumn("_salt", F.pmod(F.xxhash64(*_PACK_BOX, F.monotonically_increasing_id()), some).cast("int"))
        .drop("_salts")
    )
    spread = (
        pieces.join(table, keys, "left")
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), some - 1)))
        .drop("_salts")
    )
    return dealt, spread


def points_in_pieces(
    packs: DataFrame,
    pieces: DataFrame,
    columns: list[str],
    grids: list[int],
    few_only: bool,
    limit: int = POINTS_PER_KEY,
    salts: int | None = None,
) -> DataFrame:
    """Pairs of a point and a piece that holds it; the points' columns and ``columns`` of the pieces.

    A piece is what lies of an area in its closed box ``PIECE_BOX``, below ``_ex`` and ``_ey``: all
    of the box if ``_inside``, else what ``_edges`` encloses.  ``packs`` are kept rows of ``packed``, and
    ``grids`` those that pieces use.  With ``few_only``, all pieces that are not inside have a few edges.
    """
    names = [f.name for f in packs.schema["_points"].dataType.elementType.fields]
    pack_box, piece_box = ([F.col(n) for n in box] for box in (_PACK_BOX, PIECE_BOX))
    level, grid = F.col("_level"), F.col("_grid")
    finer = F.filter(_levels_of(grids), lambda v: v > grid)
    coarser = F.filter(_levels_of(numbers(packs, "_grid")), lambda v: v >= grid)
    left = _on_grids(packs, _PACK_BOX, 0, 1, finer).drop("_grid")
    pieces = with_few_edges(pieces.withColumn("_grid", grid_of(*piece_box)), "_edges")
    bounds = edge_bounds()
    pieces = pieces.withColumns(bounds).drop(*few_columns()[1:])
    right = _on_grids(pieces, PIECE_BOX, 1, 0, coarser).drop("_grid")
    left, right = _salted(left, right, limit, salts)
    keys = [*CELL, "_coarser", "_salt"]
    x, y = F.col("x"), F.col("y")
    low = [F.greatest(a, b) for a, b in zip(pack_box[:2], piece_box[:2], strict=True)]
    high = [F.least(a, b) for a, b in zip(pack_box[2:], piece_box[2:], strict=True)]
    met = left.join(_shuffled(right), keys).filter(
        (low[0] <= high[0])
        & (low[1] <= high[1])
        & (F.col("_cx") == _cell(low[0], level))
        & (F.col("_cy") == _cell(low[1], level))
    )
    held = (
        (pack_box[0] >= piece_box[0]) & (pack_box[1] >= piece_box[1])
        & (pack_box[2] <= piece_box[2]) & (pack_box[3] <= piece_box[3])
        & (pack_box[2] < F.col("_ex")) & (pack_box[3] < F.col("_ey"))
    )
    # Of a pack that lies in the box and that no edge touches, one point tells for all.  This is a step of
    # its own: its long conditions and those for each point would not be compiled in one method.
    edges = F.col("_edges")

    def in_shape(x: Column, y: Column, few_only: bool) -> Column:
        few = point_in_bounded_edges(x, y)
        return few if few_only else F.when(F.col("_few"), few).otherwise(point_in_edges(x, y, edges))

    alike = held & (F.col("_inside") | ~F.coalesce(box_touches_edges(*pack_box, edges), F.lit(True)))
    met = met.withColumn("_alike", F.coalesce(alike, F.lit(False)))
    met = met.filter(~F.col("_alike") | F.col("_inside") | in_shape(*pack_box[:2], False))
    kept = [*columns, *PIECE_BOX, "_ex", "_ey", "_alike", "_inside", *bounds, *([] if few_only else ["_few", "_edges"])]
    pairs = met.select(*dict.fromkeys(kept), F.inline("_points"))
    in_piece = (
        (x >= F.col("_px0")) & (x <= F.col("_px1")) & (x < F.col("_ex"))
        & (y >= F.col("_py0")) & (y <= F.col("_py1")) & (y < F.col("_ey"))
        & (F.col("_inside") | in_shape(x, y, few_only))
    )
    # Both are never null; said so, it halves the code of the test.
    pairs = pairs.filter(x.isNotNull() & y.isNotNull() & (F.col("_alike") | in_piece))
    return pairs.select(*names, *columns)


def points_in_areas(
    points: DataFrame,
    areas: DataFrame,
    levels: list[int] | None = None,
    exact: bool = True,
    salts: int = 1,
) -> DataFrame:
    """Pairs of a point and an area that intersect.

    ``points`` has ``x`` and ``y``; ``areas`` has the four extent columns and,
    for the exact test, ``geometry`` (a polygon kind).  Other columns must not
    share names.  With ``exact=False`` the areas' boxes decide.  Packs of a crowded cell
    are spread over ``salts`` shuffle keys at most.  The packs are kept in the shared folder.
    """
    if levels is None:
        levels = grid_levels(areas)
    grids = sorted({-(-level // STEP) * STEP for level in levels})
    packs = packed(points, grids[-1]) if grids else None
    if packs is None:
        return points.join(areas, F.lit(False))
    packs = _kept(packs, "packs")
    limit = POINTS_PER_KEY if salts > 1 else 1 << 62
    pieces = whole_pieces(areas, exact)
    few_only = not exact or pieces.filter(~few_edges(F.col("_edges"))).isEmpty()
    return points_in_pieces(packs, pieces, areas.columns, grids, few_only, limit, salts)


def boxes_overlapping(left: DataFrame, right: DataFrame, levels: list[int]) -> DataFrame:
    """Pairs of rows whose closed boxes overlap.

    ``left`` has ``xmin`` to ``ymax``, ``right`` the same names with the
    prefix ``o_``; ``levels`` are the grids either side uses.  A pair is
    looked up on the coarser grid of the two, and counts in the one cell that
    holds the lower left corner of the overlap.
    """
    names = ("xmin", "ymin", "xmax", "ymax")
    level = F.col("_level")

    def on_grids(df: DataFrame, prefix: str, own: str) -> DataFrame:
        box = [F.col(prefix + n) for n in names]
        return (
            df.filter(box[0].isNotNull())
            .withColumn(own, _level(*box))
            # On its own grid and on every coarser one in use.
            .withColumn(
                "_level",
                F.explode(
                    F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v >= F.col(own))
                ),
            )
            .withColumn("_cx", F.explode(F.sequence(_cell(box[0], level), _cell(box[2], level))))
            .withColumn("_cy", F.explode(F.sequence(_cell(box[1], level), _cell(box[3], level))))
        )

    a, b = on_grids(left, "", "_la"), on_grids(right, "o_", "_lb")
    # One side is on its own grid, so two small boxes never meet on a grid
    # that is only there for a large one.
    keys = ["_level", "_cx", "_cy"]
    met = (
        a.filter(level == F.col("_la"))
        .join(_shuffled(b), keys)
        .unionByName(
            a.filter(level > F.col("_la")).join(_shuffled(b.filter(level == F.col("_lb"))), keys)
        )
    )
    low_x = F.greatest(F.col("xmin"), F.col("o_xmin"))
    low_y = F.greatest(F.col("ymin"), F.col("o_ymin"))
    return met.filter(
        (low_x <= F.least(F.col("xmax"), F.col("o_xmax")))
        & (low_y <= F.least(F.col("ymax"), F.col("o_ymax")))
        & (F.col("_cx") == _cell(low_x, level))
        & (F.col("_cy") == _cell(low_y, level))
    ).drop(*keys, "_la", "_lb")
