"""Values that a load cannot read: told by the scan, recorded with their rows, counted."""

import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.operators.ingest import LOSSES_COLUMN, loss_rows, with_losses
from mapstrata.plans import jobs
from mapstrata.plans.jobs import read_layer
from mapstrata.settings import LoadSettings
from mapstrata.sources import register

POINT = struct.pack("<BIdd", 1, 1, 652000.0, 6862000.0)
ROWS = [  # cleabs, date_creation, etages, geometry
    ("B1", "2020-01-01 00:00:00", "3", POINT),
    ("B2", "2020-01-01 00:00:60", "3", POINT),
    ("B3", "2020-01-01 00:00:61", "many", POINT[:9]),
    ("B4", None, None, None),
    ("B5", "", "4.5", struct.pack("<BII", 1, 7, 0)),
    (None, "soon", "5", POINT),
]


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    schema = "cleabs string, date_creation string, etages string, geometry binary"
    for dept, rows in {"D001": ROWS, "D002": ROWS[:2], "D003": ROWS[:1]}.items():
        df = spark.createDataFrame([(a, b, c, None if g is None else bytearray(g)) for a, b, c, g in rows], schema)
        writer = df.coalesce(1).write.format("gpkg").mode("append").option("layer", "batiment").option("srid", 2154)
        writer.option("declared", "date_creation=DATETIME,etages=INTEGER").save(str(tmp_path / "in" / dept))
    return str(tmp_path / "in")


def test_the_scan_tells_what_it_lost(spark, folder):
    found = loss_rows(read_layer(spark, folder, "batiment", losses=True, batchSize=2), "dept", "cleabs")
    rows = {tuple(r)[:4] for r in found.collect()}
    assert rows == {
        ("D001", "B3", "etages", "not a bigint"), ("D001", "B3", "geometry", "broken geometry"),
        ("D001", "B5", "geometry", "unsupported kind"),
    }
    assert LOSSES_COLUMN not in read_layer(spark, folder, "batiment").columns
    kept = {r.cleabs: r.etages for r in read_layer(spark, folder, "batiment").filter("dept = 'D001'").collect()}
    assert kept["B1"] == 3 and kept["B3"] is None


def test_casts_add_to_what_the_scan_lost(spark):
    rest = T.StructType([T.StructField("a", T.DateType()), T.StructField("b", T.StringType())])
    df = spark.createDataFrame([("2020-01-01", "x"), ("never", "y"), (None, "z")], "a string, b string")
    found = with_losses(df, rest).orderBy("b").collect()
    assert [r[LOSSES_COLUMN] for r in found] == [None, [("a", "not a date", "never")], None]
    told = df.withColumn(LOSSES_COLUMN, F.array(F.struct(F.lit("b").alias("column"), F.lit("r").alias("reason"), F.lit("w").alias("raw"))))
    assert [len(r[LOSSES_COLUMN]) for r in with_losses(told, rest).orderBy("b").collect()] == [1, 2, 1]
    nothing = T.StructType([T.StructField("b", T.StringType())])
    assert with_losses(df, nothing).filter(F.col(LOSSES_COLUMN).isNotNull()).count() == 0


def test_load_records_losses(spark, folder, database):
    settings = LoadSettings(database, layers=["batiment"])
    for run in (1, 2):
        report = jobs.load(spark, folder, settings)
        assert report.rows() == {"batiment": 9}
        counts = spark.table(f"{database}.load_losses").filter(F.col("run") == report.run).drop("run", "layer")
        assert {tuple(r) for r in counts.collect()} == {
            ("D001", "date_creation", "not a timestamp", 4), ("D001", "etages", "not a bigint", 1),
            ("D001", "geometry", "broken geometry", 1), ("D001", "geometry", "unsupported kind", 1),
            ("D002", "date_creation", "not a timestamp", 1),
        }
        assert spark.table(f"{database}.load_rejects").count() == 8 * run
    stored = spark.table(f"{database}.ign_bdtopo_batiment")
    assert LOSSES_COLUMN not in stored.columns and stored.count() == 9
    raw = spark.table(f"{database}.load_rejects").filter("key IS NULL").select("column", "raw").distinct().collect()
    assert [tuple(r) for r in raw] == [("date_creation", "soon")]


def test_losses_may_be_left_out(spark, folder, database):
    jobs.load(spark, folder, LoadSettings(database, layers=["batiment"], losses=False))
    names = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect()}
    assert names == {"ign_bdtopo_batiment", "load_metrics"}


def test_layers_record_losses_at_the_same_time(spark, tmp_path, database):
    register(spark)
    rows = spark.createDataFrame([(a, b) for a, b, _, _ in ROWS], "cleabs string, date_creation string").coalesce(1)
    layers = [f"couche_{k}" for k in range(6)]
    for layer in layers:
        writer = rows.write.format("gpkg").mode("append").option("layer", layer).option("srid", 0)
        writer.option("declared", "date_creation=DATETIME").save(str(tmp_path / "in" / "D001"))
    jobs.load(spark, str(tmp_path / "in"), LoadSettings(database, concurrent_layers=6))
    counts = spark.table(f"{database}.load_losses").groupBy("layer").agg(F.sum("rows").alias("n")).collect()
    assert {r.layer: r.n for r in counts} == dict.fromkeys(layers, 4)
    assert spark.table(f"{database}.load_rejects").count() == 24
