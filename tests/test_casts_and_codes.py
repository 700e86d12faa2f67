"""Tolerant casts, malformed stamps, source texts."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions import casts, codes
from mapstrata.operators import ingest
from mapstrata.plans.jobs import parse_departments
from mapstrata.sources import manifest


def test_tolerant_casts(spark):
    raw = [
        "2020-01-01 10:00:00",
        "2020-01-01T10:00:60",
        "1612-01-01",
        "2020/01/01 00:00:00",
        "2020-13-01",
        "",
        None,
        "2020-01-01 00:00:00+00:00",
    ]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, raw string").select(
        "i",
        casts.to_timestamp_or_null("raw").cast("string").alias("ts"),
        casts.to_date_or_null("raw").cast("string").alias("d"),
    )
    rows = df.orderBy("i").collect()
    assert [r.ts for r in rows] == [
        "2020-01-01 10:00:00",
        None,
        "1612-01-01 00:00:00",
        "2020-01-01 00:00:00",
        None,
        None,
        None,
        "2020-01-01 00:00:00",
    ]
    assert [r.d for r in rows] == [
        "2020-01-01",
        "2020-01-01",
        "1612-01-01",
        "2020-01-01",
        None,
        None,
        None,
        "2020-01-01",
    ]


def test_ingestion_schema():
    rest = T.StructType(
        [
            T.StructField("cleabs", T.StringType()),
            T.StructField("d", T.DateType()),
            T.StructField("ts", T.TimestampType()),
            T.StructField("n", T.DoubleType()),
        ]
    )
    in_flight, found = casts.ingestion_schema(rest)
    assert [f.dataType.simpleString() for f in in_flight] == ["string"] * 3 + ["double"]
    assert set(found) == {"d", "ts"}


def test_bad_seconds(spark):
    cases = [
        ("2020-01-01 10:00:60", True),
        ("2020-01-01 10:00:-1Z", True),
        ("2020-01-01 10:00:59.9Z", False),
        ("2020-01-01 10:00:60+00:00", False),
        ("10:00", False),
        (None, False),
        ("a:b:c", False),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, t string")
    rows = df.orderBy("i").select(casts.has_bad_seconds("t").alias("bad")).collect()
    assert [r.bad for r in rows] == [b for _, b in cases]


def test_bad_datetimes_and_losses(spark):
    df = spark.createDataFrame(
        [
            (1, "2020-01-01 10:00:60", "2020-01-01 10:00:61"),
            (2, "2020-01-01 10:00:00", "x"),
            (3, None, None),
        ],
        "i int, date_creation string, DATE_fin string",
    )
    bad = ingest.bad_datetimes(df).collect()
    assert [(r.i, r.bad_columns) for r in bad] == [(1, ["date_creation", "DATE_fin"])]
    assert ingest.bad_datetimes(df.select("i")).count() == 0
    rest = T.StructType(
        [T.StructField("date_creation", T.TimestampType()), T.StructField("DATE_fin", T.DateType())]
    )
    losses = {r["column"]: (r["values"], r["lost"]) for r in ingest.cast_losses(df, rest).collect()}
    assert losses == {"date_creation": (2, 1), "DATE_fin": (2, 1)}


def test_ingest(spark):
    rest = T.StructType(
        [T.StructField("d", T.DateType()), T.StructField("geometry", T.StringType())]
    )
    df = spark.createDataFrame([("2020-01-01", "POINT (700000 6600000)")], "d string, geometry string")
    row = ingest.ingest(df, rest, 2154).first()
    assert str(row.d) == "2020-01-01" and row.geometry.srid == 4326
    assert abs(row.xmin - 3.0) < 1e-12 and abs(row.ymin - 46.5) < 1e-9
    assert ingest.ingest(df, rest, 0).first().geometry.srid == 0
    assert ingest.ingest(df, rest, 4326).first().xmax == 700000
    plain = spark.createDataFrame([(1,)], "a int")
    assert ingest.ingest(plain) is plain
    with pytest.raises(ValueError, match="27572"):
        ingest.ingest(df, rest, 27572)
    tagged = ingest.add_metadata(plain, "D001", "batiment").first()
    assert (tagged.dept, tagged.layer) == ("D001", "batiment")


def test_crs_codes(spark):
    cases = [
        ("EPSG:2154", 2154),
        ('PROJCS["a",AUTHORITY["EPSG","2154"]]', 2154),
        ('PROJCRS["a",ID["EPSG",2154]]', 2154),
        ('GEOGCS["x",AUTHORITY["EPSG","4171"]],AUTHORITY["EPSG","2154"]', 4171),
        ("x EPSG:2154", 0),
        ("", 0),
        (None, 0),
    ]
    df = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(cases)], "i int, t string")
    rows = df.orderBy("i").select(codes.crs_code("t").alias("code")).collect()
    assert [r.code for r in rows] == [code for _, code in cases]


def test_departments(spark):
    assert parse_departments(spark, "001") == ["D001"]
    assert parse_departments(spark, " 001 , 075 ") == ["D001", "D075"]
    for word in ("all", "ALL", " All "):
        codes_found = parse_departments(spark, word)
        assert len(codes_found) == 96 and "D020" not in codes_found
        assert codes_found[0] == "D001" and codes_found[-2:] == ["D02A", "D02B"]


def test_manifest(spark):
    df = spark.createDataFrame(
        [("001", "3-5", "LAMB93", "2025-09-15"), ("D075", "3-4", "LAMB93", "2024-01-01")],
        "dept string, version string, projection string, version_date string",
    )
    rows = manifest.source_manifest(df).orderBy("dept").collect()
    assert rows[0].url.endswith("_LAMB93_D001_2025-09-15.7z") and rows[1].dept == "D075"
    assert rows[0].checksum_url == rows[0].url[:-3] + ".md5"
    inner = spark.range(1).select(codes.checksum_url(F.lit("a.7z/b.7z")).alias("u")).first().u
    assert inner == "a.7z/b.md5"


def test_verification_of_files(spark, tmp_path):
    import hashlib

    (tmp_path / "in").mkdir()
    contents = {"a.gpkg": b"one" * 999999, "b.gpkg": b"two", "c.gpkg": b"", "n.txt": b"no"}
    for name, data in contents.items():
        (tmp_path / "in" / name).write_bytes(data)
    files = manifest.landed_files(spark, str(tmp_path))
    assert files.count() == 2  # Spark lists no empty files
    actual = manifest.file_checksums(files).withColumn(
        "name", F.regexp_extract("path", r"([^/]+)$", 1)
    )
    good = hashlib.md5(contents["a.gpkg"]).hexdigest()
    expected = spark.createDataFrame(
        [("a.gpkg", good), ("b.gpkg", good), ("c.gpkg", good), ("d.gpkg", good)],
        "name string, expected_md5 string",
    )
    checked = manifest.verify(expected, actual, ["name"])
    assert {r.name: r.status for r in checked.collect()} == {
        "a.gpkg": "ok",
        "b.gpkg": "mismatch",
        "c.gpkg": "missing",
        "d.gpkg": "missing",
    }
    with pytest.raises(manifest.ChecksumMismatch):
        manifest.require_intact(checked)
    stale = manifest.to_fetch(expected, actual, ["name"])
    assert sorted(r.name for r in stale.collect()) == ["b.gpkg", "c.gpkg", "d.gpkg"]
    unknown = expected.withColumn("expected_md5", F.lit(None).cast("string"))
    assert manifest.to_fetch(unknown, actual, ["name"]).count() == 2


def test_department_without_container(spark):
    wanted = spark.createDataFrame([("D001",), ("D002",)], "dept string")
    with pytest.raises(FileNotFoundError, match="D002"):
        manifest.require_departments(wanted, wanted.filter("dept = 'D001'"))
