"""Validity of geometries.

Checked: finite coordinates; lines with two distinct points; rings closed,
of four points or more and with an area; no two segments of a ring meeting
except neighbours at their shared end; no spike; rings of one polygon not
crossing; holes inside their shell.  Not checked: nested or overlapping
holes, overlapping parts of a multi-polygon.

The pair test is quadratic in an expression, so rings sets of more than
``EXPRESSION_SEGMENTS`` segments go to an Arrow function instead, which runs
the same rule over candidates from a sweep along the longer axis.  Both are
exact; there is no size above which a geometry goes unchecked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from mapstrata.functions.geometry import (
    LINE_KINDS,
    POLYGON_KINDS,
    _let,
    _ring_double_area,
    point_in_parts,
    st_points,
)
from mapstrata.functions.reuse import built_once

EXPRESSION_SEGMENTS = 32
PAIR_BLOCK = 1 << 20


def _cross(o: Column, a: Column, b: Column) -> Column:
    return (a["x"] - o["x"]) * (b["y"] - o["y"]) - (a["y"] - o["y"]) * (b["x"] - o["x"])


def _without_repeats(ring: Column) -> Column:
    """Drop points equal to their predecessor."""
    return F.filter(
        ring,
        lambda p, i: F.when(i == 0, F.lit(True)).otherwise(
            (p["x"] != F.get(ring, i - 1)["x"]) | (p["y"] != F.get(ring, i - 1)["y"])
        ),
    )


def _part_segments(part: Column) -> Column:
    """Segments of all rings of a polygon, numbered through in ``k``."""

    def of_ring(ring: Column, r: Column) -> Column:
        return _let(
            _without_repeats(ring),
            lambda clean: F.when(
                F.size(clean) > 1,
                F.transform(
                    F.sequence(F.lit(0), F.size(clean) - 2),
                    lambda i: F.struct(
                        r.alias("r"),
                        i.alias("i"),
                        (F.size(clean) - 1).alias("n"),
                        F.get(clean, i).alias("a"),
                        F.get(clean, i + 1).alias("b"),
                    ),
                ),
            ).otherwise(
                F.array().cast(
                    "array<struct<r:int,i:int,n:int,a:struct<x:double,y:double>,"
                    "b:struct<x:double,y:double>>>"
                )
            ),
        )

    return F.transform(
        F.flatten(F.transform(part, of_ring)), lambda s, k: s.withField("k", k)
    )


def _segments_clash(s: Column, t: Column) -> Column:
    a, b, c, d = s["a"], s["b"], t["a"], t["b"]
    boxes = (
        (F.greatest(a["x"], b["x"]) >= F.least(c["x"], d["x"]))
        & (F.greatest(c["x"], d["x"]) >= F.least(a["x"], b["x"]))
        & (F.greatest(a["y"], b["y"]) >= F.least(c["y"], d["y"]))
        & (F.greatest(c["y"], d["y"]) >= F.least(a["y"], b["y"]))
    )
    sides_of_s = F.signum(_cross(c, d, a)) * F.signum(_cross(c, d, b))
    sides_of_t = F.signum(_cross(a, b, c)) * F.signum(_cross(a, b, d))

    def spike(before: Column, shared: Column, after: Column) -> Column:
        dot = (shared["x"] - before["x"]) * (after["x"] - shared["x"]) + (
            shared["y"] - before["y"]
        ) * (after["y"] - shared["y"])
        return (_cross(before, shared, after) == 0) & (dot < 0)

    same = s["r"] == t["r"]
    return boxes & (
        F.when(~same, (sides_of_s < 0) & (sides_of_t < 0))
        .when(t["i"] == s["i"] + 1, spike(a, b, d))
        .when((s["i"] == 0) & (t["i"] == s["n"] - 1), spike(c, d, b))
        .otherwise((sides_of_s <= 0) & (sides_of_t <= 0))
    )


def _part_clashes(part: Column) -> Column:
    return _let(
        _part_segments(part),
        lambda segments: F.exists(
            segments,
            lambda s: F.exists(segments, lambda t: (t["k"] > s["k"]) & _segments_clash(s, t)),
        ),
    )


def _holes_inside(part: Column) -> Column:
    shell = F.slice(part, 1, 1)
    return F.when(
        F.size(part) > 1,
        ~F.exists(
            F.flatten(F.slice(part, 2, F.size(part) - 1)),
            lambda p: ~point_in_parts(p["x"], p["y"], F.array(shell)),
        ),
    ).otherwise(F.lit(True))


def _part_is_small(part: Column) -> Column:
    return F.size(F.flatten(part)) - F.size(part) <= EXPRESSION_SEGMENTS


# -- the same rule over arrays, for large parts ----------------------------


def _pairs_clash(seg: dict[str, np.ndarray], p: np.ndarray, q: np.ndarray) -> bool:
    # The lower index is "s", as in the expression.
    s, t = np.minimum(p, q), np.maximum(p, q)
    ax, ay, bx, by = (seg[n][s] for n in ("ax", "ay", "bx", "by"))
    cx, cy, dx, dy = (seg[n][t] for n in ("ax", "ay", "bx", "by"))

    def cross(ox, oy, ux, uy, vx, vy):
        return (ux - ox) * (vy - oy) - (uy - oy) * (vx - ox)

    def spike(px, py, sx, sy, nx, ny):
        dot = (sx - px) * (nx - sx) + (sy - py) * (ny - sy)
        return (cross(px, py, sx, sy, nx, ny) == 0) & (dot < 0)

    boxes = (
        (np.maximum(ax, bx) >= np.minimum(cx, dx))
        & (np.maximum(cx, dx) >= np.minimum(ax, bx))
        & (np.maximum(ay, by) >= np.minimum(cy, dy))
        & (np.maximum(cy, dy) >= np.minimum(ay, by))
    )
    of_s = np.sign(cross(cx, cy, dx, dy, ax, ay)) * np.sign(cross(cx, cy, dx, dy, bx, by))
    of_t = np.sign(cross(ax, ay, bx, by, cx, cy)) * np.sign(cross(ax, ay, bx, by, dx, dy))
    same = seg["r"][s] == seg["r"][t]
    following = same & (seg["i"][t] == seg["i"][s] + 1)
    closing = same & ~following & (seg["i"][s] == 0) & (seg["i"][t] == seg["n"][s] - 1)
    apart = same & ~following & ~closing
    clash = (
        (~same & (of_s < 0) & (of_t < 0))
        | (following & spike(ax, ay, bx, by, dx, dy))
        | (closing & spike(cx, cy, dx, dy, bx, by))
        | (apart & (of_s <= 0) & (of_t <= 0))
    )
    return bool(np.any(boxes & clash))


def _segments_of(rings: list[np.ndarray]) -> dict[str, np.ndarray]:
    columns: dict[str, list[np.ndarray]] = {n: [] for n in ("ax", "ay", "bx", "by", "r", "i", "n")}
    for r, ring in enumerate(rings):
        if len(ring) < 2:
            continue
        moved = np.any(np.diff(ring, axis=0) != 0, axis=1)
        clean = ring[np.concatenate(([True], moved))]
        count = len(clean) - 1
        if count < 1:
            continue
        columns["ax"].append(clean[:-1, 0])
        columns["ay"].append(clean[:-1, 1])
        columns["bx"].append(clean[1:, 0])
        columns["by"].append(clean[1:, 1])
        columns["r"].append(np.full(count, r))
        columns["i"].append(np.arange(count))
        columns["n"].append(np.full(count, count))
    return {n: np.concatenate(v) if v else np.empty(0) for n, v in columns.items()}


def _rings_clash(rings: list[np.ndarray]) -> bool:
    seg = _segments_of(rings)
    total = len(seg["ax"])
    if total < 2:
        return False
    spread_x = np.ptp(np.concatenate((seg["ax"], seg["bx"])))
    spread_y = np.ptp(np.concatenate((seg["ay"], seg["by"])))
    start, end = ("ax", "bx") if spread_x >= spread_y else ("ay", "by")
    low, high = np.minimum(seg[start], seg[end]), np.maximum(seg[start], seg[end])
    order = np.argsort(low, kind="stable")
    reach = np.searchsorted(low[order], high[order], side="right") - np.arange(total) - 1
    ends = np.cumsum(reach)
    first = 0
    while first < total:
        # As many segments as keep the block of candidate pairs small.
        base = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + PAIR_BLOCK, side="right")))
        counts = reach[first:last]
        p = np.repeat(np.arange(first, last), counts)
        q = p + 1 + np.arange(len(p)) - np.repeat(np.cumsum(counts) - counts, counts)
        if _pairs_clash(seg, order[p], order[q]):
            return True
        first = last
    return False


def _inside_or_on(points: np.ndarray, shell: np.ndarray) -> bool:
    a, b = shell[:-1], shell[1:]
    block = max(1, PAIR_BLOCK // max(1, len(a)))
    for start in range(0, len(points), block):
        x = points[start : start + block, 0][:, None]
        y = points[start : start + block, 1][:, None]
        side = (b[:, 0] - a[:, 0]) * (y - a[:, 1]) - (b[:, 1] - a[:, 1]) * (x - a[:, 0])
        on = (
            (side == 0)
            & (x >= np.minimum(a[:, 0], b[:, 0]))
            & (x <= np.maximum(a[:, 0], b[:, 0]))
            & (y >= np.minimum(a[:, 1], b[:, 1]))
            & (y <= np.maximum(a[:, 1], b[:, 1]))
        )
        upward = b[:, 1] > a[:, 1]
        hit = ((a[:, 1] > y) != (b[:, 1] > y)) & np.where(upward, side > 0, side < 0)
        if not np.all(on.any(axis=1) | (hit.sum(axis=1) % 2 == 1)):
            return False
    return True


def _part_rings(part: pa.Scalar) -> list[np.ndarray]:
    rings = part.values
    points = rings.flatten()
    flat = np.column_stack(
        [points.field(n).to_numpy(zero_copy_only=False) for n in ("x", "y")]
    )
    lengths = pc.list_value_length(rings).to_numpy(zero_copy_only=False)
    cuts = np.cumsum(lengths)[:-1]
    return np.split(flat, cuts)


@F.arrow_udf(BooleanType())
def _large_parts_sound(parts: pa.Array) -> pa.Array:
    """True when no part has clashing segments or a stray hole."""
    out = []
    for geometry in parts:
        if not geometry.is_valid:
            out.append(None)
            continue
        sound = True
        for part in geometry:
            rings = _part_rings(part)
            if _rings_clash(rings) or any(
                not _inside_or_on(hole, rings[0]) for hole in rings[1:]
            ):
                sound = False
                break
        out.append(sound)
    return pa.array(out, pa.bool_())


# --------------------------------------------------------------------------


@built_once
def st_is_valid(geom: Column | str) -> Column:
    """NULL for a NULL geometry."""
    geom = F.col(geom) if isinstance(geom, str) else geom
    parts = geom["parts"]
    nan, inf = F.lit(float("nan")), F.lit(float("inf"))

    def finite(v: Column) -> Column:
        return v.isNotNull() & (v != nan) & (F.abs(v) != inf)

    def line_ok(ring: Column) -> Column:
        first = F.get(ring, F.lit(0))
        return F.exists(ring, lambda p: (p["x"] != first["x"]) | (p["y"] != first["y"]))

    def ring_ok(ring: Column) -> Column:
        first, last = F.get(ring, F.lit(0)), F.get(ring, F.size(ring) - 1)
        return (
            (F.size(ring) >= 4)
            & (first["x"] == last["x"])
            & (first["y"] == last["y"])
            & (_ring_double_area(ring) != 0)
        )

    def small_part_ok(part: Column) -> Column:
        return ~_part_is_small(part) | (~_part_clashes(part) & _holes_inside(part))

    large = F.filter(parts, lambda part: ~_part_is_small(part))
    simple = F.forall(F.flatten(parts), ring_ok) & F.forall(parts, small_part_ok)
    coordinates_ok = F.forall(st_points(geom), lambda p: finite(p["x"]) & finite(p["y"]))
    is_polygon = geom["kind"].isin(*POLYGON_KINDS)
    swept = _large_parts_sound(F.when(is_polygon & coordinates_ok & (F.size(large) > 0), large))
    return F.when(
        geom.isNotNull(),
        coordinates_ok
        & F.when(is_polygon, simple & F.coalesce(swept, F.lit(True)))
        .when(geom["kind"].isin(*LINE_KINDS), F.forall(F.flatten(parts), line_ok))
        .otherwise(F.lit(True)),
    )
