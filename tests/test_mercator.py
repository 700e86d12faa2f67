"""Transverse Mercator systems: literals, the exact meridian, conformality, and the systems known."""

import math

import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.functions.projection import (
    FLATTENING,
    OVERSEAS,
    SEMI_MAJOR,
    SERIES,
    UnsupportedProjection,
    check_pair,
    inverse_mercator,
    mercator_series,
    st_transform,
    utm_zones,
)


def inverse(spark, points, meridian=0.0, northing=0.0, **how):
    df = spark.createDataFrame([(float(i), x, y) for i, (x, y) in enumerate(points)], "i double, x double, y double")
    found = df.select("i", inverse_mercator(F.col("x"), F.col("y"), F.lit(meridian), F.lit(northing), **how).alias("p"))
    return [(r.p.x, r.p.y) for r in found.orderBy("i").collect()]


def test_a_published_example(spark):
    """The worked example of the method: Airy's ellipsoid, easting 577274.99 and northing 69740.50."""
    axis, flattening, scale = 6377563.396, 1 / 299.32496, 0.9996012717
    arc = meridian_arc(math.radians(49), axis, flattening) * scale
    (lon, lat), = inverse(
        spark, [(577274.99, 69740.50)], -2.0, -100000.0 - arc, easting=400000.0, scale=scale, axis=axis, flattening=flattening
    )
    assert abs(lon - 0.5) < 2e-7 and abs(lat - 50.5) < 1e-7  # a centimetre, as the example is rounded


def meridian_arc(latitude, axis=SEMI_MAJOR, flattening=FLATTENING, steps=20000):
    """Length of the meridian from the equator, by Simpson's rule."""
    e2 = flattening * (2 - flattening)
    step = latitude / steps
    value = lambda k: axis * (1 - e2) / (1 - e2 * math.sin(k * step) ** 2) ** 1.5
    inner = sum((4 if k % 2 else 2) * value(k) for k in range(1, steps))
    return (value(0) + inner + value(steps)) * step / 3


def test_the_central_meridian_is_exact(spark):
    latitudes = [0.0, 5.0, 14.6, 21.1, 46.8, 60.0, 83.0]
    points = [(500000.0, 0.9996 * meridian_arc(math.radians(v))) for v in latitudes]
    for (lon, lat), expected in zip(inverse(spark, points, 57.0), latitudes, strict=True):
        assert abs(lon - 57) < 1e-12 and abs(lat - expected) * 111e6 < 0.01  # millimetres


def test_the_projection_is_conformal(spark):
    """With the exact meridian that leaves one function only."""
    h, points = 50.0, []
    for x in (200000.0, 420000.0, 833000.0):
        for y in (300000.0, 1600000.0, 5200000.0):
            points += [(x + h, y), (x - h, y), (x, y + h), (x, y - h)]
    found = [(math.radians(a), math.radians(b)) for a, b in inverse(spark, points)]
    e2 = FLATTENING * (2 - FLATTENING)
    for k in range(0, len(found), 4):
        east, west, north, south = found[k : k + 4]
        lat = (north[1] + south[1]) / 2
        w = 1 - e2 * math.sin(lat) ** 2
        across, along = SEMI_MAJOR * math.cos(lat) / math.sqrt(w), SEMI_MAJOR * (1 - e2) / w**1.5
        xe, ye = (east[0] - west[0]) * across, (east[1] - west[1]) * along
        xn, yn = (north[0] - south[0]) * across, (north[1] - south[1]) * along
        assert abs(xe - yn) < 1e-5 and abs(ye + xn) < 1e-5


def test_latitude_series_are_one(spark):
    assert mercator_series(FLATTENING)[2] == pytest.approx(SERIES, rel=1e-4)


def test_transform_by_system(spark):
    rows = [(code, 500000.0, 10000000.0 - 2000000.0 if south else 2000000.0) for code, (_, south) in utm_zones().items()]
    df = spark.createDataFrame(rows, "srid int, x double, y double")
    moved = df.select("srid", st_transform(g.st_point("x", "y").withField("srid", F.col("srid"))).alias("m"))
    found = {r.srid: r.m for r in moved.collect()}
    for code, (zone, south) in utm_zones().items():
        point = found[code].parts[0][0][0]
        assert found[code].srid == 4326 and point.x == pytest.approx(zone * 6 - 183, abs=1e-9)
        assert point.y == pytest.approx(-18.0888 if south else 18.0888, abs=2e-2)


def test_pairs():
    for code in (*OVERSEAS, 32601, 32760, 2154, 4326, 0):
        check_pair(code, 4326)
    for pair in ((32661, 4326), (32700, 4326), (27700, 4326), (2975, 2154)):
        with pytest.raises(UnsupportedProjection):
            check_pair(*pair)
