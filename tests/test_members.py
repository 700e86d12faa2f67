"""Collections of mixed kinds: texts, trees, measures of members, projection."""

import json

import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.functions import members as m
from mapstrata.functions.projection import LAMBERT_93, st_transform

SQUARE = "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 2.0, 0.0 2.0, 0.0 0.0))"
HOLED = "MULTIPOLYGON (((10.0 0.0, 14.0 0.0, 14.0 4.0, 10.0 4.0, 10.0 0.0), (11.0 1.0, 12.0 1.0, 12.0 2.0, 11.0 2.0, 11.0 1.0)))"
TREES = [
    ("GEOMETRYCOLLECTION EMPTY", None),
    ("geometrycollection  Z  empty", "GEOMETRYCOLLECTION EMPTY"),
    ("GEOMETRYCOLLECTION (POINT (1.0 2.0))", None),
    ("  GeometryCollection( point(1 2),linestring( 0 0,3 4 ) )  ", "GEOMETRYCOLLECTION (POINT (1.0 2.0), LINESTRING (0.0 0.0, 3.0 4.0))"),
    (f"GEOMETRYCOLLECTION (GEOMETRYCOLLECTION (GEOMETRYCOLLECTION ({SQUARE}), POINT (1.0 1.0)), {HOLED})", None),
    ("GEOMETRYCOLLECTION (GEOMETRYCOLLECTION EMPTY, GEOMETRYCOLLECTION (GEOMETRYCOLLECTION EMPTY), POINT EMPTY)", None),
    ("GEOMETRYCOLLECTION Z (POINT Z (1 2 3), GEOMETRYCOLLECTION Z (POINT ZM (4 5 6 7)))", "GEOMETRYCOLLECTION (POINT (1.0 2.0), GEOMETRYCOLLECTION (POINT (4.0 5.0)))"),
    ("GEOMETRYCOLLECTION (MULTIPOINT ((1.0 2.0), (3.0 4.0)), MULTILINESTRING ((0.0 0.0, 1.0 1.0), (2.0 2.0, 3.0 3.0)))", None),
    ("GEOMETRYCOLLECTION (POINT (1.0E-7 -2.5E10), POINT (1.0E-7 -2.5E10))", None),
    ("GEOMETRYCOLLECTION (" + "GEOMETRYCOLLECTION (" * 40 + "POINT (1.0 2.0)" + ")" * 41, None),
]
BAD = [
    None, "", "POINT (1 2)", "GEOMETRYCOLLECTION", "GEOMETRYCOLLECTION ()", "GEOMETRYCOLLECTION (POINT (1 2)",
    "GEOMETRYCOLLECTION (POINT (1 2)))", "GEOMETRYCOLLECTION (POINT (1 2), POINT (x 2))", "GEOMETRYCOLLECTION (POINT (1 2),)",
    "GEOMETRYCOLLECTION (POINT (1 2)), GEOMETRYCOLLECTION (POINT (1 2))", "GEOMETRYCOLLECTION (POINT (1 2)), POINT (1 2)",
    "GEOMETRYCOLLECTION (CIRCLE (1 2))", "GEOMETRYCOLLECTION (POINT (1 2) POINT (3 4))", "GEOMETRYCOLLECTION POINT (1 2)",
    "GEOMETRYCOLLECTION (" * 70 + "POINT (1 2)" + ")" * 70,
]


def parsed(spark, texts, srid=LAMBERT_93):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, wkt string")
    return rows.select("i", m.collection_from_wkt("wkt", srid).alias("c"))


def test_texts_and_back(spark):
    rows = parsed(spark, [a for a, _ in TREES])
    assert rows.schema["c"].dataType.simpleString() == m.COLLECTION_TYPE.simpleString()
    found = rows.select("i", m.collection_as_text("c").alias("t"), m.collection_as_geojson("c").alias("j")).orderBy("i").collect()
    assert [r.t for r in found] == [b or a for a, b in TREES]
    assert all(json.loads(r.j)["type"] == "GeometryCollection" for r in found)
    tree = json.loads(found[4].j)
    assert [x["type"] for x in tree["geometries"]] == ["GeometryCollection", "MultiPolygon"]
    assert tree["geometries"][0]["geometries"][0]["geometries"][0]["coordinates"][0][2] == [4, 2]
    assert json.loads(found[5].j)["geometries"][1]["geometries"] == [{"type": "GeometryCollection", "geometries": []}]


@pytest.mark.parametrize("part", [0, 1])
def test_bad_texts_are_null(spark, part):
    found = parsed(spark, BAD[part::2]).orderBy("i").collect()
    assert [r.i for r in found if r.c is not None] == []


def test_measures(spark):
    texts = [TREES[4][0], TREES[3][0], TREES[2][0], TREES[0][0], TREES[5][0], None]
    c = parsed(spark, texts)
    found = c.select(
        "i", m.collection_area("c").alias("area"), m.collection_npoints("c").alias("n"),
        m.collection_dimension("c").alias("d"), g.st_as_text(m.collection_centroid("c"), 4).alias("at"),
        F.size(m.collection_members("c")).alias("members"),
        *[v.alias(k) for k, v in m.collection_extent("c").items()],
    ).orderBy("i").collect()
    # 8 of the square about (2, 1); 16 about (12, 2) less 1 about (11.5, 1.5).
    x, y = (8 * 2 + 16 * 12 - 11.5) / 23, (8 * 1 + 16 * 2 - 1.5) / 23
    assert (found[0].area, found[0].n, found[0].d, found[0].members) == (23, 5 + 1 + 10, 2, 3)
    assert found[0]["at"] == f"POINT ({x:.4f} {y:.4f})" and (found[0].xmax, found[0].ymax) == (14, 4)
    assert (found[1].area, found[1].d, found[1]["at"]) == (0, 1, "POINT (1.5000 2.0000)")
    assert (found[2].n, found[2].d, found[2]["at"]) == (1, 0, "POINT (1.0000 2.0000)")
    for row in found[3:5]:
        assert (row.area, row.n, row.d, row["at"], row.xmin) == (0, 0, None, None, None)
    assert (found[5].area, found[5].n, found[5].d) == (None, None, None)


def test_members_are_projected_one_by_one(spark):
    text = "GEOMETRYCOLLECTION (GEOMETRYCOLLECTION EMPTY, GEOMETRYCOLLECTION (POINT (700000 6600000)), LINESTRING (650000 6860000, 700000 6600000))"
    c = parsed(spark, [text]).select("c", m.map_members("c", st_transform).alias("p"))
    row = c.select("p.srid", m.collection_as_text("p", 6).alias("t"), m.collection_members("c").alias("g")).first()
    alone = c.select(F.explode(m.collection_members("c")).alias("g")).select(g.st_as_text(st_transform("g"), 6).alias("t")).collect()
    assert row.srid == 4326
    assert row.t == f"GEOMETRYCOLLECTION (GEOMETRYCOLLECTION EMPTY, GEOMETRYCOLLECTION ({alone[0].t}), {alone[1].t})"


def test_collect_leaves_out_null(spark):
    made = spark.range(1).select(m.collect(g.st_point(F.lit(1), F.lit(2), 2154), g.st_point(F.lit(None), F.lit(2))).alias("c"))
    row = made.select("c.srid", m.collection_as_text("c").alias("t")).first()
    assert (row.srid, row.t) == (2154, "GEOMETRYCOLLECTION (POINT (1.0 2.0))")


def test_many_members_and_a_long_one(spark):
    ring = ", ".join(f"{i}.0 {i % 7}.0" for i in range(20000))
    text = "GEOMETRYCOLLECTION (" + ", ".join(f"POINT ({i}.0 0.0)" for i in range(5000)) + f", LINESTRING ({ring}))"
    row = parsed(spark, [text]).select(m.collection_as_text("c").alias("t"), m.collection_npoints("c").alias("n")).first()
    assert row.t == text and row.n == 25000
