"""Scans pruned by position and department."""

import random
import sqlite3

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.plans.jobs import read_layer
from mapstrata.sources import gpkg, register, wkb

WINDOW = (10.0, 10.0, 30.0, 25.0)


@pytest.fixture(params=[True, False], ids=["index", "no index"])
def folder(spark, tmp_path, request):
    register(spark)
    rng = random.Random(6)
    for dept, shift in (("D001", 0), ("D002", 20), ("D003", 1000)):
        rows = []
        for k in range(400):
            x, y, w = shift + rng.uniform(-20, 60), rng.uniform(-20, 60), rng.choice([0, 1, 30])
            rows.append((f"{dept}-{k}", f"LINESTRING ({x} {y}, {x + w} {y + w})" if k % 9 else "LINESTRING EMPTY" if k % 2 else None))
        df = spark.createDataFrame(rows, "cleabs string, wkt string").coalesce(1)
        writer = df.select("cleabs", g.st_geom_from_wkt("wkt").alias("geometry")).write.format("gpkg").mode("append")
        writer.option("layer", "lignes").option("srid", 0).option("spatialIndex", str(request.param)).save(str(tmp_path / dept))
    return str(tmp_path)


def inside(df):
    x0, y0, x1, y1 = WINDOW
    boxed = g.with_bbox(df, "geometry")
    return boxed.filter(
        (F.col("xmin") <= x1) & (F.col("xmax") >= x0) & (F.col("ymin") <= y1) & (F.col("ymax") >= y0)
    )


def option(window=WINDOW):
    return ",".join(map(str, window))


def test_window(spark, folder):
    whole = sorted(r.cleabs for r in inside(read_layer(spark, folder, "lignes")).collect())
    found = read_layer(spark, folder, "lignes", window=option(), batchSize=50)
    assert sorted(r.cleabs for r in found.select("cleabs").collect()) == whole and len(whole) > 50
    assert sorted(r.cleabs for r in found.collect()) == whole  # with the geometry read too


def test_features_read(spark, folder, monkeypatch):
    """With an index, few more features are read than there are in the window; far containers are none of the plan."""
    schema = read_layer(spark, folder, "lignes").schema
    reader = gpkg.GpkgReader(schema, {"path": folder, "layer": "lignes", "window": option()})
    parts = reader.partitions()
    assert {gpkg.department_of(p.path) for p in parts} == {"D001", "D002"}
    seen, original = [], wkb.geometry_array
    monkeypatch.setattr(wkb, "geometry_array", lambda blobs, *a: seen.append(len(blobs)) or original(blobs, *a))
    rows = sum(batch.num_rows for part in parts for batch in reader.read(part))
    with sqlite3.connect(parts[0].path) as db:
        indexed = db.execute("SELECT count(*) FROM sqlite_master WHERE name = 'rtree_lignes_geom'").fetchone()[0]
    # Geometries are decoded once to test and once to return.
    assert sum(seen) == (2 * rows if indexed else 800 + rows)


def test_empty_windows(spark, folder):
    assert read_layer(spark, folder, "lignes", window="500,500,501,501").count() == 0
    assert read_layer(spark, folder, "lignes", window="5000,500,5010,501").count() == 0
    with pytest.raises(ValueError, match="four numbers"):
        gpkg.window_of({"window": "1,2,3"})


def test_department_filters_choose_containers(spark, folder):
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        scan = read_layer(spark, folder, "lignes")
        assert scan.filter("dept = 'D002'").count() == 400
        assert scan.filter("dept IN ('D001', 'D003') AND cleabs LIKE 'D003%'").count() == 400
        assert scan.filter("dept = 'D099'").count() == 0
        assert scan.filter("dept = 'D001' AND dept = 'D002'").count() == 0
        reader = gpkg.GpkgPushdownReader(scan.schema, {"path": folder, "layer": "lignes"})
        left = list(reader.pushFilters([gpkg.EqualTo(("dept",), "D002"), gpkg.In(("dept",), ("D001", "D002"))]))
        assert left == [] and {gpkg.department_of(p.path) for p in reader.partitions()} == {"D002"}
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_boxes():
    line = {"srid": 0, "kind": "LINESTRING", "parts": [[[{"x": 3.0, "y": 1.0}, {"x": 1.0, "y": 2.0}]]]}
    point = {"srid": 0, "kind": "POINT", "parts": [[[{"x": 5.0, "y": 6.0}]]]}
    empty = {"srid": 0, "kind": "POINT", "parts": []}
    shapes = pa.array([line, None, empty, point, empty], wkb.GEOMETRY_ARROW)
    inf = np.inf
    none = [inf, inf, -inf, -inf]
    assert wkb.boxes(shapes).tolist() == [[1, 1, 3, 2], none, none, [5, 6, 5, 6], none]
    assert wkb.boxes(shapes.slice(3)).tolist() == [[5, 6, 5, 6], none]
    assert wkb.boxes(shapes.slice(1, 2)).tolist() == [none, none]
