"""Heights of points: texts, containers, tables that were planar, and plane functions beside them."""

import os
import sqlite3
import struct

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.functions.projection import LAMBERT_93, lambert93_to_wgs84, st_transform
from mapstrata.operators import tables
from mapstrata.operators.ingest import at_rest, ingest
from mapstrata.plans import queries
from mapstrata.plans.jobs import read_layer
from mapstrata.sources import register, wkb

TEXTS = [
    ("POINT Z (1 2 3)", "POINT Z (1.0 2.0 3.0)"),
    ("point z(1 2 3)", "POINT Z (1.0 2.0 3.0)"),
    ("POINTZ(1 2 -3.5)", "POINT Z (1.0 2.0 -3.5)"),
    ("POINT (1 2 3)", "POINT Z (1.0 2.0 3.0)"),
    ("POINT M (1 2 3)", "POINT (1.0 2.0)"),
    ("POINT ZM (1 2 3 4)", "POINT Z (1.0 2.0 3.0)"),
    ("POINT (1 2)", "POINT (1.0 2.0)"),
    ("POINT Z EMPTY", "POINT EMPTY"),
    ("LINESTRING Z (0 0 5, 1 1 6)", "LINESTRING Z (0.0 0.0 5.0, 1.0 1.0 6.0)"),
    ("LINESTRING (0 0 5, 1 1)", "LINESTRING (0.0 0.0, 1.0 1.0)"),
    ("MULTIPOINT Z ((0 0 5), (1 1 6))", "MULTIPOINT Z ((0.0 0.0 5.0), (1.0 1.0 6.0))"),
    (
        "MULTILINESTRING Z ((0 0 5, 1 1 6), (2 2 7, 3 3 8))",
        "MULTILINESTRING Z ((0.0 0.0 5.0, 1.0 1.0 6.0), (2.0 2.0 7.0, 3.0 3.0 8.0))",
    ),
    (
        "POLYGON Z ((0 0 1, 4 0 2, 4 4 3, 0 0 1), (1 1 9, 2 1 9, 2 2 9, 1 1 9))",
        "POLYGON Z ((0.0 0.0 1.0, 4.0 0.0 2.0, 4.0 4.0 3.0, 0.0 0.0 1.0), "
        "(1.0 1.0 9.0, 2.0 1.0 9.0, 2.0 2.0 9.0, 1.0 1.0 9.0))",
    ),
    (
        "MULTIPOLYGON Z (((0 0 1, 4 0 2, 4 4 3, 0 0 1)), ((5 5 1, 6 5 1, 6 6 1, 5 5 1)))",
        "MULTIPOLYGON Z (((0.0 0.0 1.0, 4.0 0.0 2.0, 4.0 4.0 3.0, 0.0 0.0 1.0)), "
        "((5.0 5.0 1.0, 6.0 5.0 1.0, 6.0 6.0 1.0, 5.0 5.0 1.0)))",
    ),
    ("LINESTRING Z (0 0 x, 1 1 6)", None),
    ("POINT Z (1 2 3 4 5)", None),
    (None, None),
]


def shapes(spark):
    rows = [(i, text) for i, (text, _) in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "i int, wkt string")
    return df.withColumn("geometry", g.st_geom_from_wkt("wkt", LAMBERT_93, True))


def test_texts(spark):
    found = shapes(spark).select("i", g.st_as_text("geometry", z=True).alias("t")).collect()
    assert {r.i: r.t for r in found} == {i: text for i, (_, text) in enumerate(TEXTS)}


def test_planar_parsing_is_as_before(spark):
    df = shapes(spark).withColumn("plain", g.st_geom_from_wkt("wkt", LAMBERT_93))
    assert df.schema["plain"].dataType.simpleString() == g.GEOMETRY_TYPE.simpleString()
    assert df.schema["geometry"].dataType.names == g.GEOMETRY_Z_TYPE.names
    same = df.filter(~F.col("plain").eqNullSafe(g.st_force_2d("geometry")))
    assert same.count() == 0


def test_geojson_and_accessors(spark):
    found = shapes(spark).select(
        "i",
        g.st_as_geojson("geometry", z=True).alias("json"),
        g.st_has_z("geometry").alias("high"),
        g.st_zmin("geometry").alias("low"),
        g.st_zmax("geometry").alias("top"),
        g.st_area("geometry").alias("area"),
    )
    rows = {TEXTS[r.i][0]: r for r in found.collect()}
    assert rows["POINT Z (1 2 3)"].json == '{"type":"Point","coordinates":[1.0,2.0,3.0]}'
    assert rows["POINT M (1 2 3)"].json == '{"type":"Point","coordinates":[1.0,2.0]}'
    ring = rows["POLYGON Z ((0 0 1, 4 0 2, 4 4 3, 0 0 1), (1 1 9, 2 1 9, 2 2 9, 1 1 9))"]
    assert (ring.high, ring.low, ring.top, ring.area) == (True, 1.0, 9.0, 7.5)
    assert rows["POINT (1 2)"].high is False and rows["POINT (1 2)"].low is None
    assert rows[None].high is None


def test_force_2d_and_3d(spark):
    df = shapes(spark).filter("i = 8").select(g.st_force_2d("geometry").alias("flat"))
    raised = df.select(
        g.st_as_text(g.st_force_3d("flat", 12), z=True).alias("at"),
        g.st_has_z(g.st_force_3d("flat")).alias("none"),
    ).first()
    assert tuple(raised) == ("LINESTRING Z (0.0 0.0 12.0, 1.0 1.0 12.0)", False)


def test_transform_keeps_heights(spark):
    df = spark.createDataFrame([("POINT Z (652000 6862000 35.5)",)], "wkt string")
    moved = st_transform(g.st_geom_from_wkt("wkt", LAMBERT_93, True), z=True)
    lon, lat = lambert93_to_wgs84(F.lit(652000.0), F.lit(6862000.0))
    row = df.select(moved.alias("m"), lon.alias("lon"), lat.alias("lat")).first()
    assert row.m.heights == [[[35.5]]] and row.m.srid == 4326
    assert row.m.parts[0][0][0] == (row.lon, row.lat)


def test_wkb_kinds_and_orders():
    gp = b"GP\x00\x01" + struct.pack("<i", 2154)
    blobs = [
        gp + struct.pack("<BIddd", 1, 1001, 1, 2, 3),
        gp + struct.pack("<BIdddd", 1, 3001, 1, 2, 3, 4),
        gp + struct.pack("<BIddd", 1, 2001, 1, 2, 3),
        gp + struct.pack(">BIddd", 0, 0x80000001, 1, 2, 3),
        gp + struct.pack("<BIdd", 1, 1, 1, 2),
        None,
    ]
    found = wkb.geometry_array(blobs, 2154, z=True).to_pylist()
    assert [f and f["heights"] for f in found] == [[[[3.0]]], [[[3.0]]], None, [[[3.0]]], None, None]
    assert all(f["parts"] == [[[{"x": 1.0, "y": 2.0}]]] for f in found[:5])
    assert "heights" not in wkb.geometry_array(blobs, 2154).to_pylist()[0]
    fast = wkb.geometry_array(blobs[:1] * 3, z=True)
    assert fast.to_pylist() == [found[0]] * 3
    again = wkb.geometry_array(wkb.gpkg_blobs(wkb.geometry_array(blobs, 2154, z=True), 2154), 2154, z=True)
    assert again.to_pylist() == found
    sliced = wkb.geometry_array(blobs, 2154, z=True).slice(2, 3)
    assert wkb.geometry_array(wkb.gpkg_blobs(sliced, 2154), 2154, z=True).to_pylist() == found[2:5]


def test_uneven_heights_are_refused():
    line = [{"srid": 0, "kind": "LINESTRING", "parts": [[[{"x": 0.0, "y": 0.0}] * 2]], "heights": [[[1.0]]]}]
    with pytest.raises(ValueError, match="1 heights for 2 points"):
        wkb.gpkg_blobs(pa.array(line, wkb.GEOMETRY_Z_ARROW), 0)


def test_containers_keep_heights(spark, tmp_path):
    register(spark)
    made = shapes(spark).filter("geometry IS NOT NULL").withColumn("dept", F.lit("D001"))
    path = str(tmp_path / "D001")
    made.write.format("gpkg").mode("append").option("layer", "relief").option("srid", 2154).save(path)
    back = read_layer(spark, path, "relief", altitudes=True).select("i", g.st_as_text("geometry", z=True).alias("t"))
    assert {r.i: r.t for r in back.collect()} == {i: t for i, (_, t) in enumerate(TEXTS) if t}
    flat = read_layer(spark, path, "relief")
    assert flat.schema["geometry"].dataType.names == g.GEOMETRY_TYPE.names and flat.count() == back.count()
    marks = set()
    for file in (tmp_path / "D001").glob("*.gpkg"):
        with sqlite3.connect(file) as db:
            marks |= {row[0] for row in db.execute("SELECT z FROM gpkg_geometry_columns")}
    assert 2 in marks


def test_a_planar_table_takes_heights_in(spark, database):
    name = f"{database}.relief"
    high = ingest(shapes(spark).withColumn("dept", F.lit("D002")).drop("wkt"))
    flat = high.withColumn("geometry", g.st_force_2d("geometry")).withColumn("dept", F.lit("D001"))
    tables.ensure_table(spark, name, at_rest(flat.schema), "batiment")
    tables.append(flat, name)
    assert spark.table(name).schema["geometry"].dataType.names == ["srid", "kind", "parts"]
    tables.append(high, name)
    stored = spark.table(name)
    assert stored.schema["geometry"].dataType.names == g.GEOMETRY_Z_TYPE.names
    heights = stored.filter(g.st_has_z("geometry")).groupBy("dept").count().collect()
    assert [(r.dept, r["count"]) for r in heights] == [("D002", 10)]
    assert stored.filter("dept = 'D001' AND geometry IS NOT NULL AND geometry.heights IS NULL").count() == 14
    # Planar rows go into the table as it is now.
    tables.replace_departments(flat.withColumn("dept", F.lit("D003")), name, ["D003"], rebalance=True)
    assert spark.table(name).filter("dept = 'D003' AND geometry.heights IS NULL").count() == len(TEXTS)
    assert not tables.add_heights(spark, name)


def test_compressed_containers_hold_the_same_rows(spark, tmp_path):
    register(spark)
    shape = g.st_geom_from_wkt(F.concat(F.lit("LINESTRING Z (0 0 5, 3 4 "), F.col("id"), F.lit(")")), 2154, True)
    rows = spark.range(2000).select(F.concat(F.lit("R"), "id").alias("cleabs"), shape.alias("geometry")).coalesce(2)
    read = {}
    for kind in ("false", "true"):
        path = str(tmp_path / kind)
        writer = rows.write.format("gpkg").mode("append").option("layer", "troncon").option("srid", 2154)
        writer.option("compressed", kind).option("maxFileBytes", 1 << 16).save(path)
        back = spark.read.format("gpkg").option("layer", "troncon").option("altitudes", "true").option("featuresPerTask", 300)
        read[kind] = sorted(map(str, back.load(path).collect()))
    assert read["true"] == read["false"] and len(read["true"]) == 2000
    plain, packed = (list((tmp_path / k).iterdir()) for k in ("false", "true"))
    assert len(plain) == len(packed) == 2 and {p.name.split(".", 1)[1] for p in packed} == {"gpkg.zst"}
    assert sum(p.stat().st_size for p in packed) * 2 < sum(p.stat().st_size for p in plain)


def test_containers_of_the_round_trip_are_deleted(spark, tmp_path, monkeypatch):
    """They would lie beside the tables that hold all of their rows."""
    paths = []

    def folder_for(session, purpose):
        paths.append(f"{tmp_path}/{purpose}")
        return paths[-1]

    monkeypatch.setattr(queries, "shared_folder", folder_for)
    for name, kind in (
        ("customer", "0L c_custkey, 3 c_nationkey, 5.5D c_acctbal, 'X' c_mktsegment"),
        ("lineitem", "1L l_orderkey, 2L l_partkey, 3L l_suppkey, 1 l_linenumber, 4D l_quantity, 'R' l_returnflag, timestamp'2020-01-01' l_shipdate"),
    ):
        spark.sql(f"SELECT {kind}").write.parquet(f"{tmp_path}/in/{name}.parquet")
    found = queries.gpkg_roundtrip_z(spark, f"{tmp_path}/in").collect()
    assert sorted((r.layer, r.high, r.n_points) for r in found) == [("point_de_repere", True, 1), ("troncon_de_route", True, 6)]
    containers = [p for p in paths if p.endswith("gpkg-z")]
    assert containers and not any(os.path.exists(p) for p in containers)
