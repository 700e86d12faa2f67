"""Plain geometry texts, a batch at a time.

Reading and writing text point by point in higher-order expressions is slow, so
points, lines and polygons in a plain spelling go through Arrow's kernels, whole
batches of numbers at once.  What is not plain is NULL here, and the exact
expressions of ``geometry`` then handle that row; both give the same values.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from mapstrata.sources.wkb import GEOMETRY_ARROW, GEOMETRY_Z_ARROW, POINT_ARROW

#: Fixed-point texts of up to so many decimals are written here.
DECIMALS = 6
#: Numbers below this fit the decimal type of ``geometry`` and, scaled, a long.
LARGEST = 9e11
#: Scaled numbers below this are off by less than MARGIN.
SCALED = float(1 << 43)
MARGIN = 0.01

_NUMBER = r"-?[0-9]{1,15}(?:\.[0-9]{1,20})?"
_POINT = f"{_NUMBER} {_NUMBER}(?: {_NUMBER}){{0,2}}"
_LINE = rf"\({_POINT}(?:, ?{_POINT})*\)"
_LETTER = " ?(?:ZM|Z|M)? ?"
PLAIN = (
    rf"^(?:POINT{_LETTER}\({_POINT}\)|LINESTRING{_LETTER}{_LINE}|POLYGON{_LETTER}\({_LINE}(?:, ?{_LINE})*\))$"
)
HEAD = "^(?P<kind>POINT|LINESTRING|POLYGON) ?(?P<letter>ZM|Z|M)? ?[(]+"


def _nested(offsets: list, values: pa.Array) -> pa.Array:
    for ends in offsets:
        values = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)
    return values


def read_plain(texts: pa.Array, srid: int, z: bool) -> pa.Array:
    """Geometries of the plain texts, NULL for all others."""
    kind = GEOMETRY_Z_ARROW if z else GEOMETRY_ARROW
    plain = pc.fill_null(pc.match_substring_regex(texts, PLAIN), False)
    chosen = plain.to_numpy(zero_copy_only=False)
    if not chosen.any():
        return pa.nulls(len(texts), kind)
    texts = texts if chosen.all() else texts.filter(plain)
    n = len(texts)
    head = pc.extract_regex(texts, HEAD)
    body = pc.replace_substring(pc.replace_substring_regex(texts, HEAD, ""), ", ", ",")
    rings = pc.split_pattern(pc.utf8_rtrim(body, ")"), "),(")
    points = pc.split_pattern(rings.values, ",")
    words = pc.split_pattern(points.values, " ")
    numbers = pc.cast(words.values, pa.float64()).to_numpy()
    ring_ends, point_ends, first = (np.asarray(a.offsets) for a in (rings, points, words))
    width, first = np.diff(first), first[:-1]
    point = pa.StructArray.from_arrays(
        [pa.array(numbers[first]), pa.array(numbers[first + 1])], fields=list(POINT_ARROW)
    )
    rows = np.arange(n + 1)
    columns = [pa.array(np.full(n, srid, np.int32)), head.field("kind"), _nested([point_ends, ring_ends, rows], point)]
    if z:
        flat = np.minimum.reduceat(width, point_ends[ring_ends[:-1]]) < 3
        flat |= pc.equal(head.field("letter"), "M").to_numpy(zero_copy_only=False).astype(bool)
        third = numbers[np.minimum(first + 2, len(numbers) - 1)]
        lists = _nested([point_ends, ring_ends], pa.array(third))
        columns.append(pa.ListArray.from_arrays(pa.array(rows, pa.int32()), lists, mask=pa.array(flat)))
    made = pa.StructArray.from_arrays(columns, fields=list(kind))
    return made if n == len(chosen) else made.take(pa.array(np.cumsum(chosen) - 1, mask=~chosen))


def fixed_texts(values: np.ndarray, decimals: int) -> tuple[pa.Array, np.ndarray]:
    """(fixed-point texts, which of them are certain).

    Whole numbers are exact.  Others are rounded in binary, which is as good as
    the decimal rule (half up) unless the digits cut off are close to a half.
    """
    size = np.abs(values)
    certain = size < LARGEST
    whole = certain & (values == np.floor(values))
    with np.errstate(invalid="ignore", over="ignore"):
        scaled = size * 10.0**decimals
        rest = scaled - np.floor(scaled)
        certain &= whole | ((scaled < SCALED) & (np.abs(rest - 0.5) > MARGIN))
        near = np.where(certain & ~whole, np.floor(scaled + 0.5) * np.sign(values), 0.0).astype(np.int64)
    units = np.where(whole, np.where(whole, values, 0.0).astype(np.int64) * 10**decimals, near)
    words = np.stack([units, units >> 63], axis=1)  # a 128-bit number, low word first
    numbers = pa.Array.from_buffers(
        pa.decimal128(38, decimals), len(units), [None, pa.py_buffer(np.ascontiguousarray(words, "<i8"))]
    )
    return numbers.cast(pa.string()), certain


def _joined(opened: str, body: pa.Array, closed: str) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(opened), body, pa.scalar(closed), pa.scalar(""))


def write_plain(shapes: pa.Array, decimals: int, z: bool, geojson: bool) -> pa.Array:
    """WKT or GeoJSON of points, lines and, without heights, polygons; NULL for all else."""
    none = pa.nulls(len(shapes), pa.string())
    parts = shapes.field("parts")
    rings = parts.values
    points = rings.values
    vertices = points.values
    x, y = (vertices.field(name) for name in ("x", "y"))
    if not len(vertices) or any(a.null_count for a in (rings, points, vertices, x, y)):
        return none
    part_at, ring_at, point_at = (np.asarray(a.offsets) for a in (parts, rings, points))
    kinds = shapes.field("kind")
    point, line, polygon = (
        pc.fill_null(pc.equal(kinds, name), False).to_numpy(zero_copy_only=False)
        for name in ("POINT", "LINESTRING", "POLYGON")
    )
    # One part of one ring or more, none of them without points.
    good = shapes.is_valid().to_numpy(zero_copy_only=False) & (np.diff(part_at) == 1)
    part = np.where(good, part_at[:-1], 0)
    ring = np.minimum(ring_at[part], len(points) - 1)
    n_rings = np.diff(ring_at)[part]
    length = np.diff(point_at)[ring]
    single = (n_rings == 1) & (length > 0)
    good &= (point & single & (length == 1)) | (line & single) | (polygon & (n_rings > 0))

    texts, certain = zip(*(fixed_texts(a.to_numpy(zero_copy_only=False), decimals) for a in (x, y)), strict=True)
    certain, texts = certain[0] & certain[1], list(texts)
    high = np.zeros(len(shapes), bool)
    if z and (heights := shapes.field("heights")).null_count < len(shapes):
        lists = heights.values
        lines = lists.values
        high = heights.is_valid().to_numpy(zero_copy_only=False)
        if not len(lines) or any(a.null_count for a in (lists, lines, lines.values)):
            return none
        h_part, h_ring, h_point = (np.asarray(a.offsets) for a in (heights, lists, lines))
        start = np.minimum(h_part[:-1], len(lists) - 1)
        h_line = np.minimum(h_ring[start], len(lines) - 1)
        same = (np.diff(h_part) == 1) & (np.diff(h_ring)[start] == 1) & (np.diff(h_point)[h_line] == length)
        good &= ~high | (same & ~polygon)
        owners = np.flatnonzero(high & good)
        counts = length[owners]
        step = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        third, sure = fixed_texts(lines.values.to_numpy(zero_copy_only=False), decimals)
        source = np.zeros(len(vertices), np.int64)
        missing = np.ones(len(vertices), bool)
        at = np.repeat(point_at[ring[owners]], counts) + step
        source[at], missing[at] = np.repeat(h_point[h_line[owners]], counts) + step, False
        certain = certain & (missing | sure[source])
        texts.append(third.take(pa.array(source, mask=missing)))
    uncertain = np.concatenate([[0], np.cumsum(~certain)])
    ends = point_at[ring_at[part_at]]
    good &= uncertain[ends[1:]] == uncertain[ends[:-1]]
    if not good.any():
        return none

    opened, closed, sep = ("[", "]", ",") if geojson else ("(", ")", ", ")
    pair = pc.binary_join_element_wise(*texts, "," if geojson else " ", null_handling="skip")
    pair = _joined("[", pair, "]") if geojson else pair
    ring_texts = pc.binary_join(_nested([point_at], pair), sep)
    wrapped = _joined(opened, ring_texts, closed)
    first = pa.array(ring)
    body = (ring_texts if geojson else wrapped).take(first)  # a point in GeoJSON has no further bracket
    body = pc.if_else(pa.array(point), body, wrapped.take(first)) if geojson else body
    if polygon.any():
        whole = _joined(opened, pc.binary_join(_nested([ring_at], wrapped), sep), closed).take(pa.array(part))
        body = pc.if_else(pa.array(polygon), whole, body)
    if geojson:
        names = pc.if_else(pa.array(point), "Point", pc.if_else(pa.array(line), "LineString", "Polygon"))
        made = pc.binary_join_element_wise('{"type":"', names, '","coordinates":', body, "}", "")
    else:
        made = pc.binary_join_element_wise(kinds, pc.if_else(pa.array(high), " Z ", " "), body, "")
    return pc.if_else(pa.array(good), made, pa.scalar(None, pa.string()))
