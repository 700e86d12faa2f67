"""Geometry columns against hand-made values."""

import json
import math
import random

import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.functions.projection import lambert93_to_wgs84, st_transform
from mapstrata.functions.validity import EXPRESSION_SEGMENTS, st_is_valid

HOLED = "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 2 1, 1 1))"
TWO = "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((5 5, 6 5, 6 6, 5 6, 5 5)))"


def evaluate(spark, texts, *columns):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return (
        rows.select("i", g.st_geom_from_wkt("t", 2154).alias("geom"))
        .select("i", *columns)
        .orderBy("i")
        .collect()
    )


def test_wkt_kinds(spark):
    cases = {
        "POINT (1 2)": ("POINT", [[[(1.0, 2.0)]]]),
        "point z(1 2 3)": ("POINT", [[[(1.0, 2.0)]]]),
        "  POINT ZM ( 1   2 3 4 ) ": ("POINT", [[[(1.0, 2.0)]]]),
        "POINT EMPTY": ("POINT", []),
        "LINESTRING (0 0, 1e3 -2.5E-1)": ("LINESTRING", [[[(0.0, 0.0), (1000.0, -0.25)]]]),
        "LINESTRINGZ(0 0 1,1 1 1)": ("LINESTRING", [[[(0.0, 0.0), (1.0, 1.0)]]]),
        "MULTIPOINT (1 2, 3 4)": ("MULTIPOINT", [[[(1.0, 2.0)]], [[(3.0, 4.0)]]]),
        "MULTIPOINT ((1 2), (3 4))": ("MULTIPOINT", [[[(1.0, 2.0)]], [[(3.0, 4.0)]]]),
        "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))": (
            "MULTILINESTRING",
            [[[(0.0, 0.0), (1.0, 1.0)]], [[(2.0, 2.0), (3.0, 3.0)]]],
        ),
        HOLED: (
            "POLYGON",
            [
                [
                    [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)],
                    [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (2.0, 1.0), (1.0, 1.0)],
                ]
            ],
        ),
    }
    rows = evaluate(spark, list(cases), "geom")
    for row, (kind, parts) in zip(rows, cases.values()):
        assert row.geom.srid == 2154 and row.geom.kind == kind
        assert [[[tuple(p) for p in r] for r in part] for part in row.geom.parts] == parts


@pytest.mark.parametrize(
    "text",
    [
        None,
        "",
        "garbage",
        "POINT",
        "POINT (1)",
        "POINT (1 2",
        "POINT (1 2 3 4 5)",
        "POINT (1d 2)",
        "POINT (nan nan)",
        "POINT (1 2, 3 4)",
        "POINT EMPTY EMPTY",
        "LINESTRING ((0 0, 1 1))",
        "LINESTRING (0 0, 1 1), (2 2, 3 3)",
        "POLYGON (0 0, 1 0, 1 1, 0 0)",
        "POLYGON ((0 0, 1 0, 1 x, 0 0))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0))",
        "GEOMETRYCOLLECTION (POINT (1 2))",
        "POINTER (1 2)",
    ],
)
def test_bad_wkt_is_null(spark, text):
    assert evaluate(spark, [text], "geom")[0].geom is None


def test_text_forms(spark):
    texts = ["POINT (1.5 -2)", HOLED, "MULTIPOINT ((1 2), (3 4))", "LINESTRING EMPTY"]
    rows = evaluate(
        spark,
        texts,
        g.st_as_text("geom", 1).alias("wkt"),
        g.st_as_geojson("geom", 1).alias("json"),
        g.st_geometry_type("geom").alias("kind"),
    )
    assert rows[0].wkt == "POINT (1.5 -2.0)"
    assert rows[0].json == '{"type":"Point","coordinates":[1.5,-2.0]}'
    assert rows[1].wkt.startswith("POLYGON ((0.0 0.0, 4.0 0.0") and "), (1.0 1.0" in rows[1].wkt
    assert rows[1].json.startswith('{"type":"Polygon","coordinates":[[[0.0,0.0],[4.0,0.0]')
    assert rows[2].wkt == "MULTIPOINT ((1.0 2.0), (3.0 4.0))"
    assert rows[2].json == '{"type":"MultiPoint","coordinates":[[1.0,2.0],[3.0,4.0]]}'
    assert rows[3].wkt == "LINESTRING EMPTY"
    assert rows[3].json == '{"type":"LineString","coordinates":[]}'
    assert [r.kind for r in rows] == ["ST_Point", "ST_Polygon", "ST_MultiPoint", "ST_LineString"]


def test_text_keeps_every_digit_unless_rounded(spark):
    numbers = [0.1 + 0.2, 1 / 3, 700000.1234567891, -2.5e-13, 12345678.987654321]
    text = "LINESTRING (" + ", ".join(f"{x!r} {-x!r}" for x in numbers) + ")"
    row = evaluate(
        spark, [text], "geom", g.st_as_text("geom").alias("wkt"), g.st_as_geojson("geom").alias("json"),
        g.st_as_text("geom", 2).alias("rounded"),
    )[0]
    pairs = [[x, -x] for x in numbers]
    assert json.loads(row.json)["coordinates"] == pairs
    again = evaluate(spark, [row.wkt], "geom")[0].geom
    assert again == row.geom and [[p.x, p.y] for p in again.parts[0][0]] == pairs
    assert row.rounded.startswith("LINESTRING (0.30 -0.30, 0.33 -0.33, 700000.12 ")


def test_measures(spark):
    texts = [HOLED, TWO, "LINESTRING (0 0, 4 0, 4 2)", "MULTIPOINT ((0 0), (2 4))", "POINT EMPTY"]
    rows = evaluate(
        spark,
        texts,
        g.st_area("geom").alias("area"),
        g.st_npoints("geom").alias("n"),
        g.st_as_text(g.st_centroid("geom"), 4).alias("centroid"),
        *[c.alias(n) for n, c in g.bbox_columns("geom").items()],
    )
    assert [r.area for r in rows] == [15.0, 5.0, 0.0, 0.0, 0.0]
    assert [r.n for r in rows] == [10, 10, 3, 2, 0]
    assert (rows[0].xmin, rows[0].ymin, rows[0].xmax, rows[0].ymax) == (0, 0, 4, 4)
    assert rows[4].xmin is None and rows[4].centroid is None
    assert rows[0].centroid == f"POINT ({(32 - 1.5) / 15:.4f} {(32 - 1.5) / 15:.4f})"
    assert rows[1].centroid == f"POINT ({(4 + 5.5) / 5:.4f} {(4 + 5.5) / 5:.4f})"
    assert rows[2].centroid == f"POINT ({(8 + 8) / 6:.4f} {2 / 6:.4f})"
    assert rows[3].centroid == "POINT (1.0000 2.0000)"


def circle(n, radius=10.0, cx=0.0, cy=0.0):
    points = [
        (cx + radius * math.cos(2 * math.pi * i / n), cy + radius * math.sin(2 * math.pi * i / n))
        for i in range(n)
    ]
    return points + points[:1]


def ring_text(points):
    return "(" + ", ".join(f"{x!r} {y!r}" for x, y in points) + ")"


def test_validity(spark):
    many = 4 * EXPRESSION_SEGMENTS
    round_shell = circle(many)
    crossed = round_shell[:]
    crossed[10], crossed[40] = crossed[40], crossed[10]
    cases = [
        (HOLED, True),
        (TWO, True),
        ("POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))", False),
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 1))", False),
        ("POLYGON ((0 0, 1 1, 0 0))", False),
        ("POLYGON ((0 0, 2 0, 4 0, 0 0))", False),
        ("POLYGON ((0 0, 0 0, 4 0, 4 4, 4 4, 0 4, 0 0))", True),
        ("POLYGON ((0 0, 4 0, 4 4, 4 6, 4 4, 0 4, 0 0))", False),
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (5 5, 5 6, 6 6, 5 5))", False),
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (3 3, 3 5, 5 5, 5 3, 3 3))", False),
        ("LINESTRING (0 0, 1 1)", True),
        ("LINESTRING (1 1, 1 1)", False),
        ("LINESTRING (1 1)", False),
        ("POINT (1 2)", True),
        ("POINT EMPTY", True),
        (None, None),
        (f"POLYGON ({ring_text(round_shell)})", True),
        (f"POLYGON ({ring_text(crossed)})", False),
        (f"POLYGON ({ring_text(round_shell)}, {ring_text(circle(many, 2.0))})", True),
        (f"POLYGON ({ring_text(round_shell)}, {ring_text(circle(many, 2.0, 9.5))})", False),
        (f"POLYGON ({ring_text(round_shell)}, {ring_text(circle(many, 2.0, 30.0))})", False),
        (f"MULTIPOLYGON (({ring_text(round_shell)}), ((20 0, 22 2, 22 0, 20 2, 20 0)))", False),
    ]
    rows = evaluate(spark, [c for c, _ in cases], st_is_valid("geom").alias("ok"))
    assert [r.ok for r in rows] == [expected for _, expected in cases]


def brute_simple(points):
    def orient(o, a, b):
        v = (a[0] - o[0]) * (b[1] - o[1]) - (a[1] - o[1]) * (b[0] - o[0])
        return (v > 0) - (v < 0)

    n = len(points) - 1
    for i in range(n):
        for j in range(i + 2, n):
            if i == 0 and j == n - 1:
                continue
            a, b, c, d = points[i], points[i + 1], points[j], points[j + 1]
            if (
                orient(c, d, a) * orient(c, d, b) <= 0
                and orient(a, b, c) * orient(a, b, d) <= 0
                and max(a[0], b[0]) >= min(c[0], d[0])
                and max(c[0], d[0]) >= min(a[0], b[0])
                and max(a[1], b[1]) >= min(c[1], d[1])
                and max(c[1], d[1]) >= min(a[1], b[1])
            ):
                return False
    return True


def test_validity_of_random_rings_matches_brute_force(spark):
    rng = random.Random(7)
    rings = []
    for n in [5, 8, 12, 40, 90, 300] * 6:
        ring = circle(n, 100.0)
        for _ in range(rng.choice([0, 0, 1])):
            i, j = rng.randrange(1, n - 1), rng.randrange(1, n - 1)
            ring[i], ring[j] = ring[j], ring[i]
        rings.append(ring)
    texts = [f"POLYGON ({ring_text(r)})" for r in rings]
    rows = evaluate(spark, texts, st_is_valid("geom").alias("ok"))
    assert [r.ok for r in rows] == [brute_simple(r) for r in rings]
    assert {r.ok for r in rows} == {True, False}


def forward_lambert(lon, lat):
    e, n = 0.08181919104281579, 0.7256077650532682
    phi, lam = math.radians(lat), math.radians(lon - 3)
    iso = math.atanh(math.sin(phi)) - e * math.atanh(e * math.sin(phi))
    r = 11754255.42609601 * math.exp(-n * iso)
    return 700000 + r * math.sin(n * lam), 12655612.049875995 - r * math.cos(n * lam)


def test_projection_inverts_forward_formula(spark):
    rng = random.Random(3)
    places = [(rng.uniform(-5, 10), rng.uniform(41, 51.5)) for _ in range(200)]
    rows = [(i, *forward_lambert(*p)) for i, p in enumerate(places)]
    df = spark.createDataFrame(rows, "i int, x double, y double")
    lon, lat = lambert93_to_wgs84("x", "y")
    geom = st_transform(g.st_point("x", "y", 2154))
    out = df.select("i", lon.alias("lon"), lat.alias("lat"), geom.alias("geom")).orderBy("i")
    for row, (lon0, lat0) in zip(out.collect(), places):
        assert abs(row.lon - lon0) < 1e-9 and abs(row.lat - lat0) < 1e-9
        point = row.geom.parts[0][0][0]
        assert row.geom.srid == 4326 and (point.x, point.y) == (row.lon, row.lat)


def test_unknown_pair_fails(spark):
    df = spark.range(1).select(g.st_point(F.lit(1.0), F.lit(2.0), 27572).alias("geom"))
    with pytest.raises(Exception, match="EPSG:27572"):
        df.select(st_transform("geom")).collect()


def test_same_and_unknown_srid_pass_through(spark):
    for srid in (0, 4326):
        df = spark.range(1).select(g.st_point(F.lit(1.0), F.lit(2.0), srid).alias("geom"))
        assert df.select(st_transform("geom").alias("geom")).first().geom.srid == srid
