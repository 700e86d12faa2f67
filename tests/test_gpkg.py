"""GeoPackage source and sink, on files made here with sqlite3."""

import sqlite3
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.casts import ingestion_schema
from mapstrata.functions.geometry import st_as_text, st_geom_from_wkt
from mapstrata.plans.jobs import layer_listing, read_layer
from mapstrata.sources import gpkg, register, wkb


def point_blob(x, y, srid=2154, envelope=False):
    head = b"GP\x00" + bytes([3 if envelope else 1]) + struct.pack("<i", srid)
    box = struct.pack("<dddd", x, x, y, y) if envelope else b""
    return head + box + struct.pack("<BIdd", 1, 1, x, y)


def make_container(path, rows, layer="batiment", links=True, extra_column=False):
    """rows: (fid, blob, cleabs, hauteur, construction_legere, date_modification)."""
    db = sqlite3.connect(path)
    db.executescript(
        f"""
        CREATE TABLE gpkg_spatial_ref_sys (srs_name TEXT, srs_id INTEGER PRIMARY KEY,
          organization TEXT, organization_coordsys_id INTEGER, definition TEXT, description TEXT);
        INSERT INTO gpkg_spatial_ref_sys VALUES ('L93', 2154, 'EPSG', 2154, 'undefined', NULL);
        CREATE TABLE gpkg_contents (table_name TEXT, data_type TEXT, srs_id INTEGER);
        CREATE TABLE gpkg_geometry_columns (table_name TEXT, column_name TEXT,
          geometry_type_name TEXT, srs_id INTEGER, z INT, m INT);
        INSERT INTO gpkg_contents VALUES ('{layer}', 'features', 2154), ('empty', 'features', 2154),
          ('batiment_rnb_lien_bdtopo', 'attributes', NULL);
        INSERT INTO gpkg_geometry_columns VALUES ('{layer}', 'geom', 'POINT', 2154, 0, 0),
          ('empty', 'geom', 'POINT', 2154, 0, 0);
        CREATE TABLE {layer} (fid INTEGER PRIMARY KEY, geom BLOB, cleabs TEXT(24), hauteur REAL,
          construction_legere BOOLEAN, date_modification DATETIME, etages MEDIUMINT, apercu BLOB
          {', nouveau INTEGER' if extra_column else ''});
        CREATE TABLE empty (fid INTEGER PRIMARY KEY, geom BLOB, cleabs TEXT);
        CREATE TABLE batiment_rnb_lien_bdtopo (fid INTEGER PRIMARY KEY, cleabs_batiment TEXT);
        INSERT INTO batiment_rnb_lien_bdtopo VALUES (1, 'B1');
        """
    )
    db.executemany(
        f"INSERT INTO {layer} (fid, geom, cleabs, hauteur, construction_legere, date_modification,"
        " etages, apercu) VALUES (?, ?, ?, ?, ?, ?, 2, x'0102')",
        rows,
    )
    db.commit()
    db.close()


@pytest.fixture
def folder(tmp_path):
    rows = [
        (i, point_blob(700000 + i, 6600000 + i), f"B{i:04d}", i / 2, i % 2, "2020-01-01T00:00:00Z")
        for i in range(1, 101)
    ]
    rows[4] = (5, None, "B0005", None, None, "2020-01-01T00:00:60Z")
    rows[5] = (6, point_blob(1, 2, envelope=True), "B0006", "tall", 1, None)
    make_container(tmp_path / "X_D001_2025.gpkg", rows)
    make_container(tmp_path / "X_D002_2025.gpkg", rows[:10], extra_column=True)
    (tmp_path / "notes.txt").write_text("no container")
    return str(tmp_path)


def test_listing(spark, folder):
    rows = layer_listing(spark, folder).orderBy("path", "layer").collect()
    assert len(rows) == 6
    assert [r.layer for r in rows[:3]] == ["batiment", "batiment_rnb_lien_bdtopo", "empty"]
    assert [r.n_features for r in rows[:3]] == [100, 1, 0]
    assert [r.srid for r in rows[:3]] == [2154, 0, 2154] and rows[0].crs == "EPSG:2154"


def test_schema_is_merged_and_typed(folder):
    schema = gpkg.layer_schema(folder, "batiment", {"dept": T.StringType()})
    types = {f.name: f.dataType for f in schema}
    assert schema.names[-2:] == ["geometry", "dept"] and "fid" not in types
    assert types["cleabs"] == T.StringType() and types["hauteur"] == T.DoubleType()
    assert types["construction_legere"] == T.BooleanType()
    assert types["date_modification"] == T.TimestampType()
    assert types["etages"] == T.IntegerType() and types["nouveau"] == T.LongType()
    assert types["apercu"] == T.StringType()
    assert "geometry" not in gpkg.layer_schema(folder, "batiment_rnb_lien_bdtopo").names


def test_scan_by_ranges(spark, folder):
    df = read_layer(spark, folder, "batiment", featuresPerTask=30, batchSize=7)
    assert df.rdd.getNumPartitions() == 4 + 1
    rows = {(r.dept, r.cleabs): r for r in df.collect()}
    assert len(rows) == 110
    first = rows["D001", "B0001"]
    assert first.geometry.kind == "POINT" and first.geometry.srid == 2154
    assert tuple(first.geometry.parts[0][0][0]) == (700001.0, 6600001.0)
    assert first.construction_legere is True and first.layer == "batiment"
    assert first.apercu == "AQI=" and first.nouveau is None and first.etages == 2
    odd = rows["D001", "B0005"]
    assert odd.geometry is None and odd.date_modification == "2020-01-01T00:00:60Z"
    assert rows["D001", "B0006"].hauteur is None
    assert tuple(rows["D002", "B0006"].geometry.parts[0][0][0]) == (1.0, 2.0)


def test_column_subset_and_empty_layer(spark, folder):
    narrow = T.StructType([T.StructField("cleabs", T.StringType())])
    assert read_layer(spark, folder, "batiment", narrow).distinct().count() == 100
    assert read_layer(spark, folder, "empty").count() == 0
    links = read_layer(spark, folder, "batiment_rnb_lien_bdtopo")
    assert links.columns == ["cleabs_batiment", "dept", "layer"] and links.count() == 2
    with pytest.raises(Exception, match="nothing_here"):
        read_layer(spark, folder, "nothing_here").collect()


def test_sparse_ids_give_even_ranges(tmp_path):
    rows = [(i * 10**9, point_blob(i, i), f"B{i}", 1.0, 0, None) for i in range(1, 101)]
    path = str(tmp_path / "D001.gpkg")
    make_container(path, rows)
    parts = gpkg.feature_ranges(gpkg.open_layer(path, "batiment"), 30)
    assert [p.start for p in parts] == [10**9 * k for k in (1, 31, 61, 91)]
    assert [a.stop for a in parts[:-1]] == [b.start for b in parts[1:]]


def test_filters_reach_the_container(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = read_layer(spark, folder, "batiment").filter("cleabs >= 'B0090' AND hauteur > 46")
        assert df.count() == 100 - 92
        assert df.filter("dept = 'D002'").count() == 0
        starts = read_layer(spark, folder, "batiment").filter("cleabs LIKE 'B001%'")
        assert starts.count() == 10 + 1
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


@pytest.mark.parametrize(
    "text",
    [
        "POINT (1 2)",
        "POINT EMPTY",
        "LINESTRING (0 0, 1 1, 2 0)",
        "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 1 2, 2 2, 1 1))",
        "MULTIPOINT ((1 2), (3 4))",
        "MULTILINESTRING ((0 0, 1 1), (2 2, 3 3, 4 4))",
        "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 0)), ((5 5, 6 5, 6 6, 5 5), (5 5, 6 5, 6 6, 5 5)))",
    ],
)
def test_round_trip_of_kinds(spark, tmp_path, text):
    register(spark)
    df = spark.range(3).select(
        F.concat(F.lit("K"), "id").alias("cleabs"),
        st_geom_from_wkt(F.lit(text), 2154).alias("geometry"),
    )
    df = df.withColumn("geometry", F.when(F.col("cleabs") != "K1", F.col("geometry")))
    path = str(tmp_path / "out")
    df.coalesce(2).write.format("gpkg").mode("append").option("layer", "l").option("srid", 2154).save(path)
    back = read_layer(spark, path, "l").select("cleabs", "geometry")
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_writer_types_rollover_and_overwrite(spark, tmp_path):
    register(spark)
    path = str(tmp_path / "out")
    df = spark.range(20000).selectExpr(
        "cast(id as string) as cleabs",
        "cast(id as int) as n",
        "id % 2 = 0 as flag",
        "cast(id as double) as v",
        "date '1612-01-01' as date_creation",
        "timestamp '2020-01-02 03:04:05' as date_modification",
    )
    write = df.repartition(2).write.format("gpkg").option("layer", "t").option("maxFileBytes", 300000)
    write.mode("append").save(path)
    assert len(gpkg.find_containers(path)) > 2
    assert sorted(p.name for p in tmp_path.glob("out/*") if not p.name.endswith(".gpkg")) == []
    back = read_layer(spark, path, "t")
    assert back.count() == 20000
    schema = gpkg.layer_schema(path, "t")
    _, casts = ingestion_schema(schema)
    typed = back.select(*[casts.get(c, lambda x: x)(F.col(c)).alias(c) for c in df.columns])
    assert typed.exceptAll(df).count() == 0 and typed.schema.names == df.schema.names
    df.limit(5).write.format("gpkg").option("layer", "t").mode("overwrite").save(path)
    assert read_layer(spark, path, "t").count() == 5


def test_empty_frame_still_writes_a_container(spark, tmp_path):
    register(spark)
    path = str(tmp_path / "out")
    df = spark.createDataFrame([], "cleabs string")
    df.write.format("gpkg").option("layer", "t").mode("append").save(path)
    assert read_layer(spark, path, "t").count() == 0


def test_header_forms():
    extended = struct.pack("<BI", 1, 1 | 0x80000000) + struct.pack("<ddd", 1, 2, 3)
    assert wkb.decode_wkb(extended)[1][0][0].tolist() == [[1.0, 2.0]]
    iso_z = struct.pack(">BI", 0, 1001) + struct.pack(">ddd", 1, 2, 3)
    assert wkb.decode_wkb(iso_z)[1][0][0].tolist() == [[1.0, 2.0]]
    iso_zm = struct.pack("<BII", 1, 3002, 1) + struct.pack("<dddd", 1, 2, 3, 4)
    assert wkb.decode_wkb(iso_zm)[1][0][0].tolist() == [[1.0, 2.0]]
    assert wkb.decode_wkb(struct.pack("<BII", 1, 7, 0)) is None
    broken = wkb.geometry_array([b"GP\x00\x01\x00\x00\x00\x00\x01\x02", b"xx", None], 2154)
    assert broken.null_count == 3
    nothing = wkb.geometry_array([b"GP\x00\x11" + struct.pack("<i", 0) + struct.pack("<BIdd", 1, 1, float("nan"), float("nan"))], 2154)
    assert nothing.to_pylist() == [{"srid": 2154, "kind": "POINT", "parts": []}]
