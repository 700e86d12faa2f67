"""Collections of mixed kinds, nested or not, as a flat array of members.

A collection is a struct of a ``srid`` and ``members``; a member is a geometry of one
of the six kinds.  The tree is kept by two counts: ``opens`` tells how many inner
collections begin right before a member, ``closes`` how many end behind it.  So the
struct needs no recursion, and text is read and written in one pass over the members.
An inner collection without members is a member of kind GEOMETRYCOLLECTION without
parts; an empty collection has no members.

Measures are those of the members of the highest dimension: an area is a sum over the
polygons, a centroid that of the polygons, else of the lines, else of the points.
Heights are dropped.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions import geometry as g
from mapstrata.functions.reuse import built_once

COLLECTION = "GEOMETRYCOLLECTION"
MEMBER_TYPE = T.StructType(
    [
        T.StructField("opens", T.IntegerType()),
        T.StructField("kind", T.StringType()),
        T.StructField("parts", g.PARTS_TYPE),
        T.StructField("closes", T.IntegerType()),
    ]
)
COLLECTION_TYPE = T.StructType(
    [T.StructField("srid", T.IntegerType()), T.StructField("members", T.ArrayType(MEMBER_TYPE))]
)
#: Inner collections that may begin at one member; a deeper text is NULL.
DEPTH = 64


def _member(opens: Column, kind: Column, parts: Column, closes: Column) -> Column:
    return F.struct(
        opens.cast("int").alias("opens"), kind.alias("kind"),
        parts.cast(g.PARTS_TYPE).alias("parts"), closes.cast("int").alias("closes"),
    )


def make_collection(srid: Column, members: Column) -> Column:
    return F.struct(srid.cast("int").alias("srid"), members.alias("members"))


def collect(*geometries: Column | str) -> Column:
    """A collection of geometry columns, with the srid of the first; NULL ones are left out."""
    shapes = [g._col(x) for x in geometries]
    made = [F.when(s.isNotNull(), _member(F.lit(0), s["kind"], s["parts"], F.lit(0))) for s in shapes]
    srid = F.coalesce(*[s["srid"] for s in shapes])
    return make_collection(srid, F.filter(F.array(*made), lambda m: m.isNotNull()))


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


@built_once
def collection_from_wkt(text: Column | str, srid: int = 0) -> Column:
    """Parse the WKT of a collection; NULL for any other text.

    One bad member, or parentheses that do not close, make the whole text bad.
    """
    plain = F.trim(F.regexp_replace(F.upper(g._col(text)), r"\s+", " "))
    for mark in "(),":
        plain = F.replace(F.replace(plain, F.lit(mark + " "), F.lit(mark)), F.lit(" " + mark), F.lit(mark))
    head = rf"^((?:{COLLECTION} ?(?:ZM|Z|M)?\(){{0,{DEPTH}}})"

    def piece(part: Column) -> Column:
        """A member with the openings in front of it and the closings behind."""

        def cut(opening: Column) -> Column:
            rest = part.substr(F.length(opening) + 1, F.length(part))
            return g._let(
                rest,
                lambda rest: g._let(
                    _count(rest, ")") - _count(rest, "("),
                    lambda closes: F.struct(
                        _count(opening, "(").alias("opens"),
                        rest.substr(F.lit(1), F.length(rest) - closes).alias("body"),
                        closes.alias("closes"),
                    ),
                ),
            )

        return g._let(F.regexp_extract(part, head, 1), cut)

    def balanced(pieces: Column) -> Column:
        """Whether the outermost collection ends with the last member and no earlier."""

        def step(depth: Column, p: Column) -> Column:
            inside = depth + p["opens"]
            fits = (depth >= F.when(p["i"] == 0, 0).otherwise(1)) & (inside >= 1) & (p["closes"] >= 0)
            return F.when(fits, inside - p["closes"]).otherwise(F.lit(-1))

        placed = F.transform(pieces, lambda p, i: p.withField("i", i))
        return F.aggregate(placed, F.lit(0), step) == 0

    def parsed(pieces: Column) -> Column:
        last = F.size(pieces) - 1

        def member(p: Column, i: Column) -> Column:
            opens = p["opens"] - (i == 0).cast("int")
            closes = p["closes"] - (i == last).cast("int")
            shape = g.st_geom_from_wkt(p["body"], srid)
            nothing = F.when(
                p["body"].rlike(rf"^{COLLECTION} ?(?:ZM|Z|M)? ?EMPTY$"),
                _member(opens, F.lit(COLLECTION), F.array(), closes),
            )
            found = g._let(shape, lambda s: F.when(s.isNotNull(), _member(opens, s["kind"], s["parts"], closes)))
            return F.coalesce(nothing, found)

        return F.transform(pieces, member)

    def whole(members: Column) -> Column:
        return F.when(~F.exists(members, lambda m: m.isNull()), make_collection(F.lit(srid), members))

    def read(plain: Column) -> Column:
        none = make_collection(F.lit(srid), F.array().cast(T.ArrayType(MEMBER_TYPE)))
        pieces = F.transform(F.split(plain, ",(?=[A-Z])"), piece)
        return F.when(plain.rlike(rf"^{COLLECTION} ?(?:ZM|Z|M)? ?EMPTY$"), none).when(
            plain.startswith(COLLECTION),
            g._let(pieces, lambda p: F.when(balanced(p), g._let(parsed(p), whole))),
        )

    return g._let(plain, read)


def _shape(srid: Column, member: Column) -> Column:
    return g.make_geometry(srid, member["kind"], member["parts"])


def _written(
    collection: Column, each: Callable[[Column], Column], opened: str, closed: str, sep: str
) -> Column:
    def member(m: Column) -> Column:
        return F.concat(F.repeat(F.lit(opened), m["opens"]), each(m), F.repeat(F.lit(closed), m["closes"]))

    return F.array_join(F.transform(collection["members"], member), sep)


@built_once
def collection_as_text(collection: Column | str, decimals: int | None = None) -> Column:
    """WKT in full precision, unless ``decimals`` asks to round."""
    c = g._col(collection)
    body = _written(
        c, lambda m: g.st_as_text(_shape(c["srid"], m), decimals), f"{COLLECTION} (", ")", ", "
    )
    return F.when(F.size(c["members"]) == 0, F.lit(f"{COLLECTION} EMPTY")).when(
        c.isNotNull(), F.concat(F.lit(f"{COLLECTION} ("), body, F.lit(")"))
    )


@built_once
def collection_as_geojson(collection: Column | str, decimals: int | None = None) -> Column:
    c = g._col(collection)
    opened, closed = '{"type":"GeometryCollection","geometries":[', "]}"

    def member(m: Column) -> Column:
        empty = F.when(m["kind"] == COLLECTION, F.lit(opened + closed))
        return empty.otherwise(g.st_as_geojson(_shape(c["srid"], m), decimals))

    body = _written(c, member, opened, closed, ",")
    return F.when(c.isNotNull(), F.concat(F.lit(opened), body, F.lit(closed)))


def collection_members(collection: Column | str) -> Column:
    """The members in order, as an array of geometries; inner collections are dissolved."""
    c = g._col(collection)
    shapes = F.filter(c["members"], lambda m: m["kind"] != COLLECTION)
    return F.transform(shapes, lambda m: _shape(c["srid"], m))


def map_members(collection: Column | str, function: Callable[[Column], Column]) -> Column:
    """The same tree with ``function`` applied to each member, such as ``st_transform``.

    A member that the function makes NULL makes the collection NULL.
    """
    c = g._col(collection)

    def member(m: Column) -> Column:
        made = g._let(
            function(_shape(c["srid"], m)),
            lambda s: F.when(
                s.isNotNull(),
                F.struct(s["srid"].alias("srid"), _member(m["opens"], s["kind"], s["parts"], m["closes"]).alias("m")),
            ),
        )
        same = F.struct(F.lit(None).cast("int").alias("srid"), m.alias("m"))
        return F.when(m["kind"] == COLLECTION, same).otherwise(made)

    def whole(made: Column) -> Column:
        known = F.array_max(F.transform(made, lambda m: m["srid"]))
        return F.when(
            ~F.exists(made, lambda m: m.isNull()),
            make_collection(F.coalesce(known, c["srid"]), F.transform(made, lambda m: m["m"])),
        )

    return g._let(F.transform(c["members"], member), whole)


def _extract(collection: Column, kind: Column) -> Column:
    many = F.concat(F.lit("MULTI"), kind)
    chosen = F.filter(collection["members"], lambda m: (m["kind"] == kind) | (m["kind"] == many))
    parts = F.flatten(F.transform(chosen, lambda m: m["parts"]))
    return F.when(collection.isNotNull() & kind.isNotNull(), g.make_geometry(collection["srid"], many, parts))


@built_once
def collection_extract(collection: Column | str, kind: str) -> Column:
    """All members of a single kind and of its plural, as one geometry of the plural."""
    if kind not in g.KINDS or kind.startswith("MULTI"):
        raise ValueError(f"not a single kind: {kind}")
    return _extract(g._col(collection), F.lit(kind))


@built_once
def collection_dimension(collection: Column | str) -> Column:
    """2 with a polygon, else 1 with a line, else 0; NULL without any point."""
    c = g._col(collection)

    def any_of(kind: str) -> Column:
        return F.exists(c["members"], lambda m: m["kind"].endswith(kind) & (F.size(m["parts"]) > 0))

    return F.when(any_of("POLYGON"), 2).when(any_of("LINESTRING"), 1).when(any_of("POINT"), 0)


@built_once
def collection_npoints(collection: Column | str) -> Column:
    c = g._col(collection)
    return F.when(
        c.isNotNull(),
        F.aggregate(c["members"], F.lit(0), lambda n, m: n + F.size(F.flatten(F.flatten(m["parts"])))),
    )


def collection_area(collection: Column | str) -> Column:
    """Summed over the polygons, also where they overlap."""
    return g._let(collection_extract(collection, "POLYGON"), g.st_area)


@built_once
def collection_centroid(collection: Column | str) -> Column:
    """That of the members of the highest dimension; NULL without any point."""
    c = g._col(collection)
    kinds = F.array(*[F.lit(k) for k in ("POINT", "LINESTRING", "POLYGON")])
    return g._let(_extract(c, F.get(kinds, collection_dimension(c))), g.st_centroid)


def collection_extent(collection: Column | str) -> dict[str, Column]:
    """The four extent columns that are stored beside a geometry."""
    c = g._col(collection)
    points = F.flatten(F.flatten(F.flatten(c["members"]["parts"])))
    return {
        "xmin": F.array_min(points["x"]),
        "ymin": F.array_min(points["y"]),
        "xmax": F.array_max(points["x"]),
        "ymax": F.array_max(points["y"]),
    }
