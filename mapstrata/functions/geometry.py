"""Geometry as a plain nested struct, and the functions over it.

Every function takes and returns a ``Column``.  Coordinates nest as
part > ring or line > point for every kind, so one set of higher-order
expressions serves all of them:

========================  ===========================================
POINT                     one part, one ring, one point
LINESTRING                one part, one ring
POLYGON                   one part, ring 0 is the shell
MULTIPOINT                one part per point
MULTILINESTRING           one part per line
MULTIPOLYGON              one part per polygon
any kind, EMPTY           no parts
========================  ===========================================

A geometry may have heights: a fourth field, ``heights``, nests one number for each point in
the same way, and is NULL for a planar geometry.  Functions that read or write
heights take ``z=True`` and then a struct with that field; all others work on
either struct and look at the plane only.
"""

from __future__ import annotations

import functools
import operator
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions import plain_text
from mapstrata.functions.reuse import built_once

POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RING_TYPE = T.ArrayType(POINT_TYPE)
PARTS_TYPE = T.ArrayType(T.ArrayType(RING_TYPE))
GEOMETRY_TYPE = T.StructType(
    [
        T.StructField("srid", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("parts", PARTS_TYPE),
    ]
)
HEIGHTS_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
GEOMETRY_Z_TYPE = T.StructType([*GEOMETRY_TYPE.fields, T.StructField("heights", HEIGHTS_TYPE)])
BBOX_COLUMNS = ("xmin", "ymin", "xmax", "ymax")

# Kind -> (spelling in type names, nesting depth of the coordinates).
KINDS = {
    "POINT": ("Point", 1),
    "LINESTRING": ("LineString", 1),
    "POLYGON": ("Polygon", 2),
    "MULTIPOINT": ("MultiPoint", 1),
    "MULTILINESTRING": ("MultiLineString", 2),
    "MULTIPOLYGON": ("MultiPolygon", 3),
}
POLYGON_KINDS = ("POLYGON", "MULTIPOLYGON")
LINE_KINDS = ("LINESTRING", "MULTILINESTRING")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def has_heights(data_type: T.DataType) -> bool:
    """Whether a column of this type is a geometry struct with heights."""
    return isinstance(data_type, T.StructType) and "heights" in data_type.names


def make_geometry(
    srid: Column, kind: Column, parts: Column, heights: Column | None = None
) -> Column:
    fields = [
        srid.cast("int").alias("srid"), kind.alias("kind"), parts.cast(PARTS_TYPE).alias("parts")
    ]
    if heights is not None:
        fields.append(heights.cast(HEIGHTS_TYPE).alias("heights"))
    return F.struct(*fields)


def _each_point(parts: Column, point: Callable[[Column], Column]) -> Column:
    return F.transform(
        parts, lambda part: F.transform(part, lambda ring: F.transform(ring, point))
    )


def st_point(x: Column | str, y: Column | str, srid: int = 0) -> Column:
    """A POINT from two columns, NULL when a coordinate is missing."""
    x, y = _col(x).cast("double"), _col(y).cast("double")
    point = F.struct(x.alias("x"), y.alias("y"))
    return F.when(
        x.isNotNull() & y.isNotNull(),
        make_geometry(F.lit(srid), F.lit("POINT"), F.array(F.array(F.array(point)))),
    )


# --------------------------------------------------------------------------
# WKT


# Marks put between parts and between rings of a normalised body; neither may
# occur in one, and a single plain character is split without a regex.
_PART_MARK, _RING_MARK = "@", ";"


def _parse_point(text: Column, z: bool) -> Column:
    """``x y [h [m]]`` as a point; NULL unless there are two to four numbers."""
    return _let(
        F.split(text, " "),
        lambda words: F.when(
            F.size(words).between(2, 4)
            & ~F.exists(F.slice(words, 3, 2), lambda w: w.try_cast("double").isNull()),
            _let(
                F.struct(
                    F.get(words, F.lit(0)).try_cast("double").alias("x"),
                    F.get(words, F.lit(1)).try_cast("double").alias("y"),
                    *([F.get(words, F.lit(2)).try_cast("double").alias("h")] if z else []),
                ),
                lambda p: F.when(p["x"].isNotNull() & p["y"].isNotNull(), p),
            ),
        ),
    )


def _parse_rings(text: Column, z: bool) -> Column:
    return F.transform(
        F.split(text, _RING_MARK), lambda ring: F.transform(F.split(ring, ","), lambda p: _parse_point(p, z))
    )


def _parse_body(kind: Column, body: Column, z: bool) -> Column:
    """Parts of a WKT body that still has its outer parentheses."""

    def inner(depth: int) -> Column:
        opened, closed = "(" * depth, ")" * depth
        # A deeper opening than the kind allows leaves a parenthesis in a
        # number, which then fails to parse.
        return F.when(
            body.startswith(opened) & body.endswith(closed),
            body.substr(F.lit(depth + 1), F.length(body) - 2 * depth),
        )

    def marked(text: Column) -> Column:
        return F.replace(text, F.lit("),("), F.lit(_RING_MARK))

    def bare(text: Column) -> Column:
        """A member of a MULTIPOINT with or without its parentheses."""
        return F.when(
            text.startswith("(") & text.endswith(")"), text.substr(F.lit(2), F.length(text) - 2)
        ).otherwise(text)

    return (
        F.when(kind.isin("POINT", "LINESTRING"), F.array(_parse_rings(inner(1), z)))
        .when(kind == "POLYGON", F.array(_parse_rings(marked(inner(2)), z)))
        .when(
            kind == "MULTIPOINT",
            F.transform(F.split(inner(1), ","), lambda p: F.array(F.array(_parse_point(bare(p), z)))),
        )
        .when(
            kind == "MULTILINESTRING",
            F.transform(F.split(marked(inner(2)), _RING_MARK), lambda t: _parse_rings(t, z)),
        )
        .when(
            kind == "MULTIPOLYGON",
            F.transform(
                F.split(
                    marked(F.replace(inner(3), F.lit(")),(("), F.lit(_PART_MARK))), _PART_MARK
                ),
                lambda t: _parse_rings(t, z),
            ),
        )
    )


@built_once
def st_geom_from_wkt(text: Column | str, srid: Column | int = 0, z: bool = False) -> Column:
    """Parse WKT; anything that is not one of the six kinds becomes NULL.

    M values are accepted and dropped, and so are Z values unless ``z`` asks for
    heights.  A third number without a letter is a height.  Heights are NULL as a
    whole where a point has none.  A text with one bad number is bad as a whole.

    A column given by name is read in batches where its texts are plain; any other
    may depend on a lambda variable, which Python does not see.
    """
    if isinstance(text, str) and isinstance(srid, int):

        @F.arrow_udf(GEOMETRY_Z_TYPE if z else GEOMETRY_TYPE)
        def read(texts: pa.Array) -> pa.Array:
            return plain_text.read_plain(texts, srid, z)

        # Called nondeterministic so that it stays in a step of its own: merged into one that
        # writes text, Spark 4.1 would leave the writing function where it cannot run.
        read = read.asNondeterministic()
        return F.coalesce(read(F.col(text)), st_geom_from_wkt(F.col(text), srid, z))
    text = _col(text)
    srid = srid if isinstance(srid, Column) else F.lit(srid)
    head = r"^\s*(MULTIPOLYGON|MULTILINESTRING|MULTIPOINT|POLYGON|LINESTRING|POINT)\s*(?:ZM|Z|M)?\s*"

    def normalised(upper: Column) -> Column:
        """The text after its kind: no space around punctuation, one between
        numbers."""
        plain = F.regexp_replace(F.regexp_replace(upper, head, ""), r"\s+", " ")
        for mark in "(),":
            plain = F.replace(F.replace(plain, F.lit(mark + " "), F.lit(mark)), F.lit(" " + mark), F.lit(mark))
        return F.rtrim(plain)

    def parsed(kind: Column, body: Column) -> Column:
        high = ",h:double" if z else ""
        empty = F.array().cast(f"array<array<array<struct<x:double,y:double{high}>>>>")
        return F.when(body == "EMPTY", empty).when(
            body.rlike(r"^\([-+0-9.E, ()]*\)$"), _parse_body(kind, body, z)
        )

    def checked(kind: Column, parts: Column, measure: Column) -> Column:
        points = F.flatten(F.flatten(parts))
        whole = ~F.exists(points, lambda p: p.isNull())
        # One point in a POINT, one line per part in the line kinds.
        single = F.when(kind == "POINT", F.size(points) <= 1).otherwise(F.lit(True)) & F.when(
            kind.isin("POINT", *LINE_KINDS), ~F.exists(parts, lambda part: F.size(part) > 1)
        ).otherwise(F.lit(True))
        if z:
            plane = _each_point(parts, lambda p: F.struct(p["x"], p["y"]))
            high = (F.size(points) > 0) & ~F.exists(points, lambda p: p["h"].isNull()) & (measure != "M")
            made = make_geometry(srid, kind, plane, F.when(high, _each_point(parts, lambda p: p["h"])))
        else:
            made = make_geometry(srid, kind, parts)
        return F.when(parts.isNotNull() & whole & single, made)

    def of_kind(kind: Column, upper: Column) -> Column:
        parts = _let(normalised(upper), lambda body: parsed(kind, body))
        letter = F.regexp_extract(upper, r"^\s*[A-Z]+?\s*(ZM|Z|M)?\s*\(", 1) if z else F.lit("")
        return F.when(kind != "", _let(parts, lambda p: checked(kind, p, letter)))

    return _let(
        F.upper(text),
        lambda upper: _let(
            F.regexp_extract(upper, head + r"(?:EMPTY\s*$|\()", 1),
            lambda kind: of_kind(kind, upper),
        ),
    )


def _number_text(value: Column, decimals: int | None) -> Column:
    """Text that reads back as the same number, or with ``decimals`` fixed-point
    text, never in scientific notation unless out of range."""
    if decimals is None:
        return value.cast("string")
    return F.coalesce(
        value.try_cast(T.DecimalType(12 + decimals, decimals)).cast("string"), value.cast("string")
    )


def _joined(items: Column, each: Callable[[Column], Column], opened: str, closed: str, sep: str):
    return F.concat(F.lit(opened), F.array_join(F.transform(items, each), sep), F.lit(closed))


def _coordinates_text(
    geom: Column, point: Callable[[Column], Column], opened: str, closed: str, sep: str, bare: bool
) -> Column:
    """Coordinates in the nesting of the kind.

    ``bare`` drops the bracket pair which WKT does not put around a single
    point but GeoJSON does.
    """
    parts = geom["parts"]

    def line(ring: Column) -> Column:
        return _joined(ring, point, opened, closed, sep)

    def rings(part: Column) -> Column:
        return _joined(part, line, opened, closed, sep)

    def first(array: Column) -> Column:
        return F.get(array, F.lit(0))

    def lone(part: Column) -> Column:
        text = point(first(first(part)))
        return F.concat(F.lit(opened), text, F.lit(closed)) if bare else text

    return (
        F.when(geom["kind"] == "POINT", lone(first(parts)))
        .when(geom["kind"] == "LINESTRING", line(first(first(parts))))
        .when(geom["kind"] == "POLYGON", rings(first(parts)))
        .when(geom["kind"] == "MULTIPOINT", _joined(parts, lone, opened, closed, sep))
        .when(
            geom["kind"] == "MULTILINESTRING",
            _joined(parts, lambda part: line(first(part)), opened, closed, sep),
        )
        .when(geom["kind"] == "MULTIPOLYGON", _joined(parts, rings, opened, closed, sep))
    )


def _with_heights(geom: Column) -> Column:
    """(kind, parts) with the height ``h`` of each point, NULL in a planar geometry."""
    zipped = F.zip_with(
        geom["parts"],
        geom["heights"],
        lambda part, highs: F.zip_with(
            part,
            highs,
            lambda ring, line: F.zip_with(
                ring, line, lambda p, h: F.struct(p["x"].alias("x"), p["y"].alias("y"), h.alias("h"))
            ),
        ),
    )
    none = F.lit(None).cast("double").alias("h")
    plain = _each_point(geom["parts"], lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"), none))
    return F.struct(geom["kind"].alias("kind"), F.coalesce(zipped, plain).alias("parts"))


def _point_text(decimals: int | None, sep: str, z: bool) -> Callable[[Column], Column]:
    names = ("x", "y", "h") if z else ("x", "y")
    # A height that is NULL is left out.
    return lambda p: F.concat_ws(sep, *[_number_text(p[n], decimals) for n in names])


def _in_batches(geom: Column | str, decimals: int | None) -> bool:
    """Whether plain geometries are written in batches: fixed-point texts of a column given by name."""
    return isinstance(geom, str) and decimals is not None and 0 <= decimals <= plain_text.DECIMALS


def _plain_text(geom: str, decimals: int, z: bool, geojson: bool) -> Column:
    @F.arrow_udf("string")
    def write(shapes: pa.Array) -> pa.Array:
        return plain_text.write_plain(shapes, decimals, z, geojson)

    return write(F.col(geom))


@built_once
def st_as_text(geom: Column | str, decimals: int | None = None, z: bool = False) -> Column:
    """Full precision, unless ``decimals`` asks to round; with ``z``, heights too."""
    if _in_batches(geom, decimals):
        return F.coalesce(_plain_text(geom, decimals, z, False), st_as_text(F.col(geom), decimals, z))
    geom = _col(geom)
    body = _coordinates_text(
        _with_heights(geom) if z else geom,
        _point_text(decimals, " ", z),
        "(",
        ")",
        ", ",
        bare=True,
    )
    return F.when(
        geom.isNotNull(),
        F.concat(
            geom["kind"],
            F.when(geom["heights"].isNotNull(), F.lit(" Z")).otherwise(F.lit("")) if z else F.lit(""),
            F.when(F.size(geom["parts"]) == 0, F.lit(" EMPTY")).otherwise(
                F.concat(F.lit(" "), body)
            ),
        ),
    )


def _kind_name(geom: Column) -> Column:
    names = F.create_map(*[F.lit(v) for kind, (name, _) in KINDS.items() for v in (kind, name)])
    return names[geom["kind"]]


@built_once
def st_as_geojson(geom: Column | str, decimals: int | None = None, z: bool = False) -> Column:
    """Full precision, unless ``decimals`` asks to round; with ``z``, heights too."""
    if _in_batches(geom, decimals):
        return F.coalesce(_plain_text(geom, decimals, z, True), st_as_geojson(F.col(geom), decimals, z))
    geom = _col(geom)
    numbers = _point_text(decimals, ",", z)
    body = _coordinates_text(
        _with_heights(geom) if z else geom,
        lambda p: F.concat(F.lit("["), numbers(p), F.lit("]")),
        "[",
        "]",
        ",",
        bare=False,
    )
    return F.when(
        geom.isNotNull(),
        F.concat(
            F.lit('{"type":"'),
            _kind_name(geom),
            F.lit('","coordinates":'),
            F.when(F.size(geom["parts"]) == 0, F.lit("[]")).otherwise(body),
            F.lit("}"),
        ),
    )


# --------------------------------------------------------------------------
# Accessors


@built_once
def st_srid(geom: Column | str) -> Column:
    """SRID, 0 when the geometry carries none; NULL for a NULL geometry."""
    geom = _col(geom)
    return F.when(geom.isNotNull(), F.coalesce(geom["srid"], F.lit(0)))


@built_once
def st_geometry_type(geom: Column | str) -> Column:
    geom = _col(geom)
    return F.when(geom.isNotNull(), F.concat(F.lit("ST_"), _kind_name(geom)))


def st_points(geom: Column | str) -> Column:
    """All points in order, as one array."""
    return F.flatten(F.flatten(_col(geom)["parts"]))


@built_once
def st_npoints(geom: Column | str) -> Column:
    geom = _col(geom)
    return F.when(geom.isNotNull(), F.size(st_points(geom)))


# Heights; these need a struct that has the field.


def st_has_z(geom: Column | str) -> Column:
    geom = _col(geom)
    return F.when(geom.isNotNull(), geom["heights"].isNotNull())


def st_heights(geom: Column | str) -> Column:
    """The heights of all points in order, as one array; NULL in a planar geometry."""
    return F.flatten(F.flatten(_col(geom)["heights"]))


def st_zmin(geom: Column | str) -> Column:
    return F.array_min(st_heights(geom))


def st_zmax(geom: Column | str) -> Column:
    return F.array_max(st_heights(geom))


def st_force_2d(geom: Column | str) -> Column:
    """The planar struct, without heights."""
    geom = _col(geom)
    return F.when(geom.isNotNull(), make_geometry(geom["srid"], geom["kind"], geom["parts"]))


def st_force_3d(geom: Column | str, height: float | None = None) -> Column:
    """A planar struct with heights: one ``height`` everywhere, or NULL."""
    geom = _col(geom)
    heights = _each_point(geom["parts"], lambda p: F.lit(float(height))) if height is not None else F.lit(None)
    return F.when(geom.isNotNull(), make_geometry(geom["srid"], geom["kind"], geom["parts"], heights))


def st_xmin(geom: Column | str) -> Column:
    return F.array_min(st_points(geom)["x"])


def st_xmax(geom: Column | str) -> Column:
    return F.array_max(st_points(geom)["x"])


def st_ymin(geom: Column | str) -> Column:
    return F.array_min(st_points(geom)["y"])


def st_ymax(geom: Column | str) -> Column:
    return F.array_max(st_points(geom)["y"])


def bbox_columns(geom: Column | str) -> dict[str, Column]:
    """The four extent columns which are stored beside a geometry."""
    return {
        "xmin": st_xmin(geom),
        "ymin": st_ymin(geom),
        "xmax": st_xmax(geom),
        "ymax": st_ymax(geom),
    }


def with_bbox(df: DataFrame, geom: str) -> DataFrame:
    """Add the extent columns, flattening each geometry once."""

    def extent(points: Column) -> Column:
        return F.struct(
            F.array_min(points["x"]).alias("xmin"),
            F.array_min(points["y"]).alias("ymin"),
            F.array_max(points["x"]).alias("xmax"),
            F.array_max(points["y"]).alias("ymax"),
        )

    kept = [c for c in df.columns if c not in BBOX_COLUMNS]
    boxed = df.select(*[F.col(f"`{c}`") for c in kept], _let(st_points(geom), extent).alias("_box"))
    return boxed.select(
        *[F.col(f"`{c}`") for c in kept], *[F.col("_box")[n].alias(n) for n in BBOX_COLUMNS]
    )


# --------------------------------------------------------------------------
# Measures, planar and in the units of the coordinates


def _ring_moments(ring: Column) -> Column:
    """Signed double area and first moments, taken about the first vertex."""
    origin = F.get(ring, F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        ax, ay = a["x"] - origin["x"], a["y"] - origin["y"]
        bx, by = b["x"] - origin["x"], b["y"] - origin["y"]
        return _let(
            ax * by - bx * ay,
            lambda cross: F.struct(
                (acc["s"] + cross).alias("s"),
                (acc["mx"] + (ax + bx) * cross).alias("mx"),
                (acc["my"] + (ay + by) * cross).alias("my"),
            ),
        )

    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("s", "mx", "my")])
    return F.when(
        F.size(ring) > 1,
        F.aggregate(F.sequence(F.lit(0), F.size(ring) - 2), zero, step),
    ).otherwise(zero)


def _ring_double_area(ring: Column) -> Column:
    origin = F.get(ring, F.lit(0))

    def step(acc: Column, i: Column) -> Column:
        a, b = F.get(ring, i), F.get(ring, i + 1)
        return (
            acc
            + (a["x"] - origin["x"]) * (b["y"] - origin["y"])
            - (b["x"] - origin["x"]) * (a["y"] - origin["y"])
        )

    return F.when(
        F.size(ring) > 3, F.aggregate(F.sequence(F.lit(0), F.size(ring) - 2), F.lit(0.0), step)
    ).otherwise(F.lit(0.0))


def _sum(items: Column, each: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, item: acc + each(item))


@built_once
def st_area(geom: Column | str) -> Column:
    """Shell minus holes, summed over the parts; 0 for points and lines."""
    geom = _col(geom)

    def part_area(part: Column) -> Column:
        shell = F.abs(_ring_double_area(F.get(part, F.lit(0))))
        holes = _sum(F.slice(part, 2, F.greatest(F.size(part) - 1, F.lit(0))), lambda ring: F.abs(_ring_double_area(ring)))
        return (shell - holes) / 2

    return F.when(
        geom["kind"].isin(*POLYGON_KINDS), _sum(geom["parts"], part_area)
    ).when(geom.isNotNull(), F.lit(0.0))


def _merge_weighted(items: Column, each: Callable[[Column], Column]) -> Column:
    """Sum of ``(w, x, y)`` structs."""
    zero = F.struct(*[F.lit(0.0).alias(n) for n in ("w", "x", "y")])
    return F.aggregate(
        items,
        zero,
        lambda acc, item: _let(
            each(item),
            lambda v: F.struct(
                (acc["w"] + v["w"]).alias("w"),
                (acc["x"] + v["x"]).alias("x"),
                (acc["y"] + v["y"]).alias("y"),
            ),
        ),
    )


def _area_weights(geom: Column, origin: Column) -> Column:
    def ring_weights(ring: Column, sign: Column) -> Column:
        first = F.get(ring, F.lit(0))
        return _let(
            _ring_moments(ring),
            # Orientation does not matter: a shell counts up, a hole down.
            lambda m: _let(
                F.signum(m["s"]) * sign,
                lambda k: F.struct(
                    (k * m["s"]).alias("w"),
                    (k * (m["mx"] / 3 + m["s"] * (first["x"] - origin["x"]))).alias("x"),
                    (k * (m["my"] / 3 + m["s"] * (first["y"] - origin["y"]))).alias("y"),
                ),
            ),
        )

    return _merge_weighted(
        geom["parts"],
        lambda part: _merge_weighted(
            F.transform(part, lambda ring, i: F.struct(ring.alias("r"), i.alias("i"))),
            lambda e: ring_weights(e["r"], F.when(e["i"] == 0, 1.0).otherwise(-1.0)),
        ),
    )


def _length_weights(geom: Column, origin: Column) -> Column:
    def line_weights(ring: Column) -> Column:
        def segment(i: Column) -> Column:
            a, b = F.get(ring, i), F.get(ring, i + 1)
            return _let(
                F.hypot(b["x"] - a["x"], b["y"] - a["y"]),
                lambda w: F.struct(
                    w.alias("w"),
                    (w * ((a["x"] + b["x"]) / 2 - origin["x"])).alias("x"),
                    (w * ((a["y"] + b["y"]) / 2 - origin["y"])).alias("y"),
                ),
            )

        steps = F.when(F.size(ring) > 1, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(
            F.array().cast("array<int>")
        )
        return _merge_weighted(steps, segment)

    return _merge_weighted(F.flatten(geom["parts"]), line_weights)


def _count_weights(geom: Column, origin: Column) -> Column:
    return _merge_weighted(
        st_points(geom),
        lambda p: F.struct(
            F.lit(1.0).alias("w"),
            (p["x"] - origin["x"]).alias("x"),
            (p["y"] - origin["y"]).alias("y"),
        ),
    )


@built_once
def st_centroid(geom: Column | str) -> Column:
    """Weighted by area, else by length, else by count, as the kind allows.

    A polygon without area falls back to its outline and a line without
    length to its points.  An EMPTY geometry has no centroid.
    """
    geom = _col(geom)
    origin = F.get(st_points(geom), F.lit(0))

    def usable(weights: Column) -> Column:
        return F.when(weights["w"] > 0, weights)

    weights = F.coalesce(
        F.when(
            geom["kind"].isin(*POLYGON_KINDS),
            _let(_area_weights(geom, origin), usable),
        ),
        F.when(
            geom["kind"].isin(*POLYGON_KINDS, *LINE_KINDS),
            _let(_length_weights(geom, origin), usable),
        ),
        _let(_count_weights(geom, origin), usable),
    )
    return F.when(
        geom.isNotNull() & (F.size(geom["parts"]) > 0),
        _let(
            weights,
            lambda c: st_point(
                origin["x"] + c["x"] / c["w"], origin["y"] + c["y"] / c["w"]
            ).withField("srid", geom["srid"]),
        ),
    )


# --------------------------------------------------------------------------
# Predicates


def point_in_parts(x: Column, y: Column, parts: Column) -> Column:
    """Even-odd ray casting, points on the outline count as inside."""

    def on_segment(a: Column, b: Column) -> Column:
        cross = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        return (
            (cross == 0)
            & x.between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"]))
            & y.between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))
        )

    def crosses(a: Column, b: Column) -> Column:
        side = (b["x"] - a["x"]) * (y - a["y"]) - (b["y"] - a["y"]) * (x - a["x"])
        upward = b["y"] > a["y"]
        return ((a["y"] > y) != (b["y"] > y)) & ((upward & (side > 0)) | (~upward & (side < 0)))

    def ring_steps(ring: Column) -> Column:
        return F.when(F.size(ring) > 1, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(
            F.array().cast("array<int>")
        )

    def ring_crossings(ring: Column) -> Column:
        return F.aggregate(
            ring_steps(ring),
            F.lit(0),
            lambda acc, i: acc + crosses(F.get(ring, i), F.get(ring, i + 1)).cast("int"),
        )

    def ring_touched(ring: Column) -> Column:
        return F.exists(
            ring_steps(ring), lambda i: on_segment(F.get(ring, i), F.get(ring, i + 1))
        )

    def part_holds(part: Column) -> Column:
        crossings = F.aggregate(part, F.lit(0), lambda acc, ring: acc + ring_crossings(ring))
        return F.exists(part, ring_touched) | (crossings % 2 == 1)

    return F.exists(parts, part_holds)


# Up to so many edges, a shape is tested by plain columns, which Spark compiles.
FEW_EDGES = 8
_ENDS = ("ax", "ay", "bx", "by")


def edges_of(parts: Column) -> Column:
    """Per part, the edges of all its rings."""

    def of_ring(ring: Column) -> Column:
        steps = F.when(F.size(ring) > 1, F.sequence(F.lit(0), F.size(ring) - 2)).otherwise(
            F.array().cast("array<int>")
        )

        def edge(i: Column) -> Column:
            a, b = F.get(ring, i), F.get(ring, i + 1)
            return F.struct(
                a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")
            )

        return F.transform(steps, edge)

    return F.transform(parts, lambda part: F.flatten(F.transform(part, of_ring)))


def _side(e, x: Column, y: Column) -> Column:
    return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])


def _touched(e, x: Column, y: Column) -> Column:
    return (
        (_side(e, x, y) == 0)
        & x.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]))
        & y.between(F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
    )


def _crossed(e, x: Column, y: Column) -> Column:
    upward, side = e["by"] > e["ay"], _side(e, x, y)
    return ((e["ay"] > y) != (e["by"] > y)) & ((upward & (side > 0)) | (~upward & (side < 0)))


def point_in_edges(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd ray casting to the right; points on an edge count as inside.

    Edges that lie above, below or left of the point may be missing.
    """

    def holds(part: Column) -> Column:
        crossings = F.aggregate(part, F.lit(0), lambda n, e: n + _crossed(e, x, y).cast("int"))
        return F.exists(part, lambda e: _touched(e, x, y)) | (crossings % 2 == 1)

    return F.exists(edges, holds)


def few_edges(edges: Column) -> Column:
    """Whether there is a single part with FEW_EDGES at most, all of numbers."""
    part = F.get(edges, F.lit(0))
    numbers = F.flatten(F.transform(part, lambda e: F.array(*[e[n] for n in _ENDS])))
    few = (
        (F.size(edges) == 1)
        & F.size(part).between(1, FEW_EDGES)
        & ~F.exists(numbers, lambda v: v.isNull() | F.isnan(v))
    )
    return F.coalesce(few, F.lit(False))


def with_few_edges(df: DataFrame, edges: str) -> DataFrame:
    """Edges of a single part, FEW_EDGES at most, as plain columns of numbers.

    ``edges`` becomes NULL where the columns tell all; it stays where there are more edges or
    parts, or one without a number.  Columns that are left over repeat the start of the first edge, which lies on
    the outline anyway.
    """
    part = F.get(F.col(edges), F.lit(0))
    first = F.get(part, F.lit(0))
    df = df.withColumn("_few", few_edges(F.col(edges)))
    columns = {}
    for i in range(FEW_EDGES):
        e = F.get(part, F.lit(i))
        for n in _ENDS:
            number = F.coalesce(e[n], first["ax" if n in ("ax", "bx") else "ay"])
            columns[f"_e{i}{n}"] = F.coalesce(F.when(F.col("_few"), number), F.lit(0.0))
    df = df.withColumns(columns)
    return df.withColumn(edges, F.when(~F.col("_few"), F.col(edges)))


def few_columns() -> list[str]:
    return ["_few", *[f"_e{i}{n}" for i in range(FEW_EDGES) for n in _ENDS]]


_BOUNDS = ("ax", "ay", "dx", "dy", "x0", "x1", "y0", "y1")


def edge_bounds() -> dict[str, Column]:
    """What ``point_in_bounded_edges`` needs to know of a row of ``with_few_edges``."""
    found = {}
    for i in range(FEW_EDGES):
        e = {n: F.col(f"_e{i}{n}") for n in _ENDS}
        ends = (F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"]), F.least(e["ay"], e["by"]), F.greatest(e["ay"], e["by"]))
        numbers = (e["ax"], e["ay"], e["bx"] - e["ax"], e["by"] - e["ay"], *ends)
        found |= {f"_b{i}{n}": v for n, v in zip(_BOUNDS, numbers, strict=True)}
    return found


def _bounded(i: int) -> dict[str, Column]:
    return {n: F.col(f"_b{i}{n}") for n in _BOUNDS}


def point_in_bounded_edges(x: Column, y: Column) -> Column:
    """``point_in_edges`` for a row with ``edge_bounds`` whose few edges tell all.

    Short, as Java compiles no method of more than 8,000 bytes.
    """
    touched, odd = [], []
    for i in range(FEW_EDGES):
        e = _bounded(i)
        side = e["dx"] * (y - e["ay"]) - e["dy"] * (x - e["ax"])
        touched.append((y >= e["y0"]) & (y <= e["y1"]) & (x >= e["x0"]) & (x <= e["x1"]) & (side == 0))
        odd.append((y >= e["y0"]) & (y < e["y1"]) & (side * e["dy"] > 0))
    return functools.reduce(operator.ne, odd) | functools.reduce(operator.or_, touched)


def point_in_few_edges(x: Column, y: Column, edges: Column) -> Column:
    """``point_in_edges`` for a row of ``with_few_edges``."""
    plain = [{n: F.col(f"_e{i}{n}") for n in _ENDS} for i in range(FEW_EDGES)]
    touched, odd = _touched(plain[0], x, y), _crossed(plain[0], x, y)
    for e in plain[1:]:
        touched, odd = touched | _touched(e, x, y), odd != _crossed(e, x, y)
    return F.when(F.col("_few"), odd | touched).otherwise(point_in_edges(x, y, edges))


def box_touches_edges(x0: Column, y0: Column, x1: Column, y1: Column, edges: Column) -> Column:
    """Whether an edge of a row with ``edge_bounds`` may touch a closed box; one that passes very close counts too."""

    def touches(e) -> Column:
        # Twice the side on which the middle is, and how far the corners may be from it.
        middle = e["dx"] * (y0 + y1 - 2 * e["ay"]) - e["dy"] * (x0 + x1 - 2 * e["ax"])
        reach = F.abs(e["dx"]) * (y1 - y0) + F.abs(e["dy"]) * (x1 - x0)
        size = F.abs(x0) + F.abs(y0) + F.abs(x1) + F.abs(y1) + F.abs(e["ax"]) + F.abs(e["ay"])
        return (
            (e["x0"] <= x1)
            & (e["x1"] >= x0)
            & (e["y0"] <= y1)
            & (e["y1"] >= y0)
            & (F.abs(middle) <= reach + (F.abs(e["dx"]) + F.abs(e["dy"])) * size * 1e-12)
        )

    def bounds(e: Column) -> dict[str, Column]:
        ends = {f"{n}{k}": of(e["a" + n], e["b" + n]) for n in "xy" for k, of in enumerate((F.least, F.greatest))}
        return {"ax": e["ax"], "ay": e["ay"], "dx": e["bx"] - e["ax"], "dy": e["by"] - e["ay"], **ends}

    few = functools.reduce(operator.or_, [touches(_bounded(i)) for i in range(FEW_EDGES)])
    return F.when(F.col("_few"), few).otherwise(F.exists(F.flatten(edges), lambda e: touches(bounds(e))))


def to_native(wkb: Column | str, srid: int = 4326) -> Column:
    """Spark's own in-memory geometry value from WKB bytes.

    Needs ``spark.sql.geospatial.enabled``; such a column cannot be written
    to Parquet, so tables keep the struct.
    """
    return F.st_setsrid(F.st_geomfromwkb(_col(wkb)), F.lit(srid))
