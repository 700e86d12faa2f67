"""Projected systems to WGS84 (EPSG:4326) in column arithmetic.

Lambert-93 (EPSG:2154), the systems of the overseas departments and all zones of UTM.  The
latter are transverse Mercator projections: four terms of the series in the third
flattening, good to a thousandth of a millimetre within a zone.

Lambert-93:

Inverse Lambert conformal conic with two standard parallels on GRS80.  The
latitude comes from the conformal latitude by the usual four-term series,
good to 1e-10 degree over France, so there is no iteration and the whole
thing stays one flat expression.  RGF93 and WGS84 are taken as equal.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mapstrata.functions.geometry import GEOMETRY_TYPE, GEOMETRY_Z_TYPE, _col, _let
from mapstrata.functions.reuse import built_once

LAMBERT_93 = 2154
WGS_84 = 4326

# Fixed values of the projection.
FALSE_EASTING = 700000.0
POLE_NORTHING = 12655612.049875995
CONE = 0.7256077650532682
RADIUS = 11754255.42609601
CENTRAL_MERIDIAN = 3.0
# Fixed values of the series from conformal to geodetic latitude on GRS80.
SERIES = (
    3.35655148535114268e-3,
    6.57187277529396252e-6,
    1.76456436467816398e-8,
    5.32847854905339864e-11,
)


# Fixed values of the ellipsoid GRS80.  That of WGS84 has a flattening which moves no
# point by more than a tenth of a millimetre.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
# Fixed values of UTM.
UTM_EASTING, UTM_SOUTH, UTM_SCALE = 500000.0, 10000000.0, 0.9996
# Systems on GRS80 by code, their zone of UTM and whether it is a southern one.
OVERSEAS = {
    2972: (22, False),  # Guiana
    2975: (40, True),  # Reunion
    4467: (21, False),  # Saint-Pierre and Miquelon
    4471: (38, True),  # Mayotte
    5490: (20, False),  # Antilles
}
# Code before the first zone, whether southern, and the last zone with a code.
UTM_FAMILIES = ((32600, False, 60), (32700, True, 60))


def utm_zones() -> dict[int, tuple[int, bool]]:
    """Zone and hemisphere of every code with a transverse Mercator projection."""
    found = dict(OVERSEAS)
    for before, south, last in UTM_FAMILIES:
        found.update({before + zone: (zone, south) for zone in range(1, last + 1)})
    return found


def mercator_series(flattening: float) -> tuple[float, list[float], list[float]]:
    """Radius of the rectifying sphere over the semi-major axis, and the coefficients of the series
    from the projection to the conformal sphere and from conformal to geodetic latitude."""
    n = flattening / (2 - flattening)
    radius = (1 + n**2 / 4 + n**4 / 64) / (1 + n)
    plane = [
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
        17 * n**3 / 480 - 37 * n**4 / 840,
        4397 * n**4 / 161280,
    ]
    latitude = [
        2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45,
        7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
        56 * n**3 / 15 - 136 * n**4 / 35,
        4279 * n**4 / 630,
    ]
    return radius, plane, latitude


class UnsupportedProjection(ValueError):
    """The pair of reference systems cannot be converted."""


def _longitude(x: Column, y: Column) -> Column:
    angle = F.atan2(x - FALSE_EASTING, F.lit(POLE_NORTHING) - y)
    return F.degrees(angle / CONE) + CENTRAL_MERIDIAN


def _conformal_sine(x: Column, y: Column) -> Column:
    """Sine of the conformal latitude: the hyperbolic tangent of the
    isometric latitude."""
    dx, dy = x - FALSE_EASTING, F.lit(POLE_NORTHING) - y
    return F.tanh(F.log((dx * dx + dy * dy) / (RADIUS * RADIUS)) * (-0.5 / CONE))


def _latitude(s: Column) -> Column:
    """Latitude from the sine ``s`` of the conformal latitude.

    The series in multiples of the conformal latitude, gathered by powers of
    ``s``: an arc sine and a square root are its only costly steps.
    """
    a, b, c, d = SERIES
    # sin 2k chi = sin 2chi * U(cos 2chi), and cos 2chi = 1 - 2 s^2.
    p0, p1, p2, p3 = a - c, 2 * b - 4 * d, 4 * c, 8 * d
    q0, q1 = p0 + p1 + p2 + p3, -2 * p1 - 4 * p2 - 6 * p3
    q2, q3 = 4 * p2 + 12 * p3, -8 * p3
    square = s * s
    tail = ((square * q3 + q2) * square + q1) * square + q0
    return F.degrees(F.asin(s) + s * F.sqrt(F.lit(1.0) - square) * 2 * tail)


@built_once
def lambert93_to_wgs84(x: Column | str, y: Column | str) -> tuple[Column, Column]:
    """Longitude and latitude in degrees, for scalar columns."""
    x, y = _col(x), _col(y)
    return _longitude(x, y), _latitude(_conformal_sine(x, y))


def _project_point(p: Column) -> Column:
    # Inside a lambda nothing shares subexpressions, so bind explicitly.
    latitude = _let(_conformal_sine(p["x"], p["y"]), _latitude)
    return F.struct(_longitude(p["x"], p["y"]).alias("x"), latitude.alias("y"))


def inverse_mercator(
    x: Column,
    y: Column,
    meridian: Column,
    northing: Column,
    easting: float = UTM_EASTING,
    scale: float = UTM_SCALE,
    axis: float = SEMI_MAJOR,
    flattening: float = FLATTENING,
) -> Column:
    """(x, y) as longitude and latitude in degrees, of a transverse Mercator projection.

    ``northing`` is what the projection adds to distances from the equator.
    """
    radius, plane, series = mercator_series(flattening)
    size = scale * radius * axis

    def on_sphere(p: Column) -> Column:
        u, v = p["u"], p["v"]
        for j, c in enumerate(plane, 1):
            u = u - F.sin(p["u"] * (2 * j)) * F.cosh(p["v"] * (2 * j)) * c
            v = v - F.cos(p["u"] * (2 * j)) * F.sinh(p["v"] * (2 * j)) * c
        return F.struct(u.alias("u"), v.alias("v"))

    def conformal(p: Column) -> Column:
        latitude = F.asin(F.sin(p["u"]) / F.cosh(p["v"]))
        return F.struct(F.atan2(F.sinh(p["v"]), F.cos(p["u"])).alias("l"), latitude.alias("c"))

    def geodetic(p: Column) -> Column:
        latitude = p["c"]
        for j, c in enumerate(series, 1):
            latitude = latitude + F.sin(p["c"] * (2 * j)) * c
        return F.struct((F.degrees(p["l"]) + meridian).alias("x"), F.degrees(latitude).alias("y"))

    start = F.struct(((y - northing) / size).alias("u"), ((x - easting) / size).alias("v"))
    return _let(start, lambda a: _let(on_sphere(a), lambda b: _let(conformal(b), geodetic)))


def _zone(source: Column) -> tuple[Column, Column]:
    """Central meridian and added northing by the code of a system."""
    family = F.floor(source / 100) * 100
    zone, south = F.pmod(source, F.lit(100)), family == 32700
    for code, (number, below) in OVERSEAS.items():
        zone = F.when(source == code, number).otherwise(zone)
        south = F.when(source == code, below).otherwise(south)
    return (zone * 6 - 183).cast("double"), F.when(south, UTM_SOUTH).otherwise(0.0)


def _has_zone(source: Column) -> Column:
    utm = F.lit(False)
    for before, _, last in UTM_FAMILIES:
        utm = utm | source.between(before + 1, before + last)
    return utm | source.isin(*OVERSEAS)


def check_pair(source_srid: int, target_srid: int) -> None:
    """Raise unless the conversion is none, the identity, or from a known system to 4326."""
    if source_srid in (0, target_srid):
        return
    if target_srid != WGS_84 or source_srid not in {LAMBERT_93, *utm_zones()}:
        raise UnsupportedProjection(
            f"cannot convert EPSG:{source_srid} to EPSG:{target_srid}; "
            f"only EPSG:{LAMBERT_93}, zones of UTM and the overseas systems to EPSG:{WGS_84} are supported"
        )


@built_once
def st_transform(
    geom: Column | str, target_srid: int = WGS_84, z: bool = False, zones: bool = True
) -> Column:
    """Reproject by the SRID each geometry carries.

    Unknown (0) and equal SRIDs pass through; any other pair fails the query.
    With ``z``, the struct has heights, which stay as they are: both systems
    measure them from one ellipsoid.  Without ``zones``, transverse Mercator systems
    fail too; the expression is shorter then.
    """
    return _let(_col(geom), lambda value: _transformed(value, target_srid, z, zones))


def _transformed(geom: Column, target_srid: int, z: bool, zones: bool) -> Column:
    source = F.coalesce(geom["srid"], F.lit(0))
    keep = geom.isNull() | source.isin(0, target_srid)
    message = F.concat(
        F.lit("cannot convert EPSG:"), source.cast("string"), F.lit(f" to EPSG:{target_srid}")
    )
    failed = F.raise_error(message).cast(GEOMETRY_Z_TYPE if z else GEOMETRY_TYPE)
    if target_srid != WGS_84:
        return F.when(keep, geom).otherwise(failed)
    projected = F.struct(
        F.lit(WGS_84).alias("srid"),
        geom["kind"].alias("kind"),
        F.transform(
            geom["parts"],
            lambda part: F.transform(part, lambda ring: F.transform(ring, _project_point)),
        ).alias("parts"),
        *([geom["heights"].alias("heights")] if z else []),
    )
    if not zones:
        return F.when(keep, geom).when(source == LAMBERT_93, projected).otherwise(failed)
    zone = F.struct(*[c.alias(n) for c, n in zip(_zone(source), ("meridian", "northing"), strict=True)])

    def from_zone(z_: Column) -> Column:
        def point(p: Column) -> Column:
            return inverse_mercator(p["x"], p["y"], z_["meridian"], z_["northing"])

        return F.transform(
            geom["parts"], lambda part: F.transform(part, lambda ring: F.transform(ring, point))
        )

    zoned = F.struct(
        F.lit(WGS_84).alias("srid"),
        geom["kind"].alias("kind"),
        _let(zone, from_zone).alias("parts"),
        *([geom["heights"].alias("heights")] if z else []),
    )
    return (
        F.when(keep, geom)
        .when(source == LAMBERT_93, projected)
        .when(_has_zone(source), zoned)
        .otherwise(failed)
    )
