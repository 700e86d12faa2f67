"""The index of containers: one pass in tasks, and planning that opens none."""

import sqlite3

import pytest
from pyspark.sql import functions as F

from mapstrata.functions.geometry import st_point
from mapstrata.plans import jobs
from mapstrata.settings import LoadSettings
from mapstrata.sources import gpkg, register


@pytest.fixture
def folder(spark, tmp_path):
    register(spark)
    for dept, n in (("D001", 50), ("D002", 5)):
        df = spark.range(n).select(
            F.concat(F.lit(dept), F.col("id").cast("string")).alias("cleabs"),
            F.col("id").alias("n"),
            st_point(F.col("id") + 652000, F.col("id") + 6862000, 2154).alias("geometry"),
        )
        df.coalesce(1).write.format("gpkg").mode("append").option("layer", "batiment").option("srid", 2154).save(
            str(tmp_path / dept)
        )
    return tmp_path


def test_index_rows(spark, folder):
    rows = {gpkg.department_of(r["path"]): r for r in jobs.layer_index(spark, str(folder), 20).collect()}
    assert rows["D001"]["cuts"] == [1, 21, 41] and rows["D001"]["stop"] == 51
    assert rows["D002"]["cuts"] == [1] and rows["D002"]["z"] == 0 and rows["D002"]["key"] == "fid"
    assert [c["name"] for c in rows["D001"]["columns"]] == ["cleabs", "n"]
    layer = gpkg.indexed_layer(rows["D001"])
    assert layer == gpkg.open_layer(rows["D001"]["path"], "batiment")


def test_planning_by_an_index_opens_no_container(spark, folder, monkeypatch):
    rows = jobs.layer_index(spark, str(folder), 20).collect()
    direct = gpkg.GpkgReader(None, {"path": str(folder), "layer": "batiment", "featurespertask": "20"}).partitions()
    monkeypatch.setattr(gpkg, "_connect", lambda path: pytest.fail(f"opened {path}"))
    options = {"path": str(folder), "layer": "batiment", "ranges": gpkg.ranges_option(rows)}
    planned = gpkg.GpkgReader(None, options).partitions()
    ends = lambda parts: sorted((p.path, p.start, p.stop) for p in parts)
    assert ends(planned) == ends(direct) and len(planned) == 4


def test_load_opens_no_container_on_the_driver(spark, folder, database, monkeypatch):
    monkeypatch.setattr(sqlite3, "connect", lambda *a, **k: pytest.fail("opened on the driver"))
    report = jobs.load(spark, str(folder), LoadSettings(database, features_per_task=20))
    assert report.layers["batiment"].rows_by_dept == {"D001": 50, "D002": 5}


def test_sparse_ids_are_cut_in_tasks(spark, folder, database):
    file = next((folder / "D002").glob("*.gpkg"))
    with sqlite3.connect(file) as db:
        db.execute("UPDATE batiment SET fid = fid * 1000000000")
    row = next(r for r in jobs.layer_index(spark, str(folder), 2).collect() if "D002" in r["path"])
    assert row["cuts"] == [10**9, 3 * 10**9, 5 * 10**9] and row["stop"] == 5 * 10**9 + 1
    report = jobs.load(spark, str(folder), LoadSettings(database, departments="002", features_per_task=2))
    assert report.rows() == {"batiment": 5}
