"""The spatial join by an adaptive cover against all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.operators import cover_join, spatial_join
from mapstrata.operators.cover_join import cover, point_in_edges, points_in_areas_by_cover

SHAPES = {
    "square": "POLYGON ((0 0, 64 0, 64 64, 0 64, 0 0))",
    "hole": "POLYGON ((-100 -100, 300 -100, 300 300, -100 300, -100 -100), (10 10, 90 10, 90 90, 10 90, 10 10))",
    "two": "MULTIPOLYGON (((0 0, 20 0, 20 20, 0 0)), ((15 5, 60 5, 60 40, 15 5)))",
    "comb": "POLYGON ((0 0, 200 0, 200 150, 180 10, 160 150, 140 10, 120 150, 100 10, 80 150, 0 0))",
    "sliver": "POLYGON ((5 5, 250 6, 250 6.5, 5 5))",
    "point": "POLYGON ((7 7, 7 7, 7 7, 7 7))",
    "tie": "POLYGON ((0 0, 50 50, 50 0, 0 50, 0 0))",
    "empty": "POLYGON EMPTY",
    "nothing": None,
}


@pytest.fixture(scope="module")
def areas(spark):
    df = spark.createDataFrame(list(SHAPES.items()), "name string, wkt string")
    return g.with_bbox(df.select("name", g.st_geom_from_wkt("wkt").alias("geometry")), "geometry")


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    spots = [(float(rng.randint(-110, 310)), float(rng.randint(-110, 310))) for _ in range(1500)]
    spots += [(float(x), float(y)) for x in (0, 16, 32, 64, 90) for y in (0, 10, 32, 40, 64)]
    spots += [(rng.gauss(30, 8), rng.gauss(20, 8)) for _ in range(800)] + [(7.0, 7.0)] * 300
    rows = [(i, x, y) for i, (x, y) in enumerate(spots)] + [(-1, None, 5.0), (-2, 5.0, None)]
    return spark.createDataFrame(rows, "id long, x double, y double").repartition(4)


def all_pairs(points, areas):
    held = g.point_in_parts(F.col("x"), F.col("y"), F.col("geometry")["parts"])
    return sorted(map(tuple, points.crossJoin(areas).filter(held).select("id", "name").collect()))


@pytest.mark.parametrize(("limit", "depth"), [(50_000, 8), (100, 8), (10, 8), (100, 2), (40, 0)])
def test_equals_all_pairs(points, areas, limit, depth):
    found = points_in_areas_by_cover(points, areas, limit, depth)
    assert found.columns == ["id", "x", "y", "name", "xmin", "ymin", "xmax", "ymax"]
    assert sorted((r.id, r.name) for r in found.collect()) == all_pairs(points, areas)


def test_cover_adapts_to_the_crowd(points, areas):
    few = cover(areas, points, 100_000).filter("name = 'hole'")
    many = cover(areas, points, 50).filter("name = 'hole'")
    assert few.count() <= 4 and few.filter("_inside").count() == 0
    assert many.filter("_inside").count() > 10
    edges = F.size(F.flatten("_edges"))
    assert many.filter("NOT _inside").agg(F.max(edges)).first()[0] <= 8
    # Inside cells hold no point that is outside.
    met = points.join(many.filter("_inside"), (F.floor(F.col("x") / F.pow(F.lit(2.0), "_level")) == F.col("_cx"))
                      & (F.floor(F.col("y") / F.pow(F.lit(2.0), "_level")) == F.col("_cy")))
    whole = areas.filter("name = 'hole'").select("geometry")
    outside = met.crossJoin(whole).filter(~g.point_in_parts(F.col("x"), F.col("y"), F.col("geometry")["parts"]))
    assert met.count() > 300 and outside.count() == 0


def test_no_key_is_crowded(spark, points, areas, monkeypatch):
    """A third of the points on one spot: the keys of the join stay within twice the limit or so."""
    seen = []
    original = cover_join._looked_up

    def spying(df, levels):
        seen.append(levels)
        return original(df, levels)

    monkeypatch.setattr(cover_join, "_looked_up", spying)
    spot = spark.range(2000).selectExpr("id + 10000 AS id", "31.5D AS x", "20.25D AS y")
    crowd = points.unionByName(spot)
    found = points_in_areas_by_cover(crowd, areas, 100)
    assert sorted((r.id, r.name) for r in found.collect()) == all_pairs(crowd, areas)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 1 and "_salt" in plan


def test_tables_without_rows(spark, points, areas):
    assert points_in_areas_by_cover(points.limit(0), areas).count() == 0
    assert points_in_areas_by_cover(points, areas.limit(0)).count() == 0
    assert points_in_areas_by_cover(points, areas.filter("name IN ('empty', 'nothing')")).count() == 0


def test_point_in_edges_needs_no_far_edges(spark):
    square = [[(0.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 4.0), (4.0, 4.0, 0.0, 4.0), (0.0, 4.0, 0.0, 0.0)]]
    kind = "array<array<struct<ax:double,ay:double,bx:double,by:double>>>"
    df = spark.createDataFrame([(1.0, 1.0, square), (9.0, 1.0, square), (4.0, 2.0, square)], f"x double, y double, e {kind}")
    near = F.transform("e", lambda p: F.filter(p, lambda e: F.greatest(e["ax"], e["bx"]) >= 1))
    assert [r[0] for r in df.select(point_in_edges(F.col("x"), F.col("y"), F.col("e"))).collect()] == [True, False, True]
    assert df.limit(1).select(point_in_edges(F.col("x"), F.col("y"), near)).first()[0]


def test_only_cells_over_the_limit_are_counted_as_crowded(spark):
    # More cells with a point than a table of 65,536 places would tell apart.
    cells = spark.range(200_000).select(
        F.lit(0).alias("_level"), F.col("id").alias("_cx"), F.lit(0).cast("long").alias("_cy")
    )
    crowd = cells.limit(1).crossJoin(spark.range(3)).drop("id")
    found = cover_join._crowded(cells.unionByName(crowd), 2).collect()
    assert [row["_n"] for row in found] == [4]


def test_no_side_of_the_joins_is_broadcast(spark):
    areas = g.with_bbox(
        spark.range(5).select(
            "id", g.st_geom_from_wkt(F.concat(F.lit("POLYGON ((0 0, 9 0, 9 "), F.col("id") + 1, F.lit(", 0 0))"))).alias("geometry")
        ),
        "geometry",
    )
    points = spark.range(5).select(F.col("id").alias("p"), F.col("id").cast("double").alias("x"), F.lit(0.0).alias("y"))
    found = spatial_join.points_in_areas(points, areas)
    boxes = areas.drop("geometry")
    others = boxes.select(*[F.col(c).alias("o_" + c) for c in boxes.columns])
    for joined in (found, spatial_join.boxes_overlapping(boxes, others, spatial_join.grid_levels(boxes))):
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert found.count() == 25


def test_few_edges_judge_like_the_parts(spark):
    texts = [
        "POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0))",
        "POLYGON ((0 0, 6 0, 6 6, 0 6, 0 0), (2 2, 2 4, 4 4, 4 2, 2 2))",
        "POLYGON ((0 0, 6 6, 6 0, 0 6, 0 0))",
        "POLYGON ((0 0, 1 3, 2 0, 3 3, 4 0, 5 3, 6 0, 6 6, 3 4, 0 6, 0 0))",
        "MULTIPOLYGON (((0 0, 4 0, 4 4, 0 0)), ((2 0, 6 0, 6 6, 2 0)))",
        "POLYGON ((3 3))",
        "POLYGON EMPTY",
    ]
    shapes = spark.createDataFrame(list(enumerate(texts)), "shape int, wkt string")
    shapes = shapes.withColumn("parts", g.st_geom_from_wkt("wkt")["parts"])
    shapes = g.with_few_edges(shapes.withColumn("_edges", g.edges_of(F.col("parts"))), "_edges")
    steps = spark.range(-1, 15).select((F.col("id") / 2).alias("v"))
    points = steps.select(F.col("v").alias("x")).crossJoin(steps.select(F.col("v").alias("y")))
    x, y = F.col("x"), F.col("y")
    judged = shapes.crossJoin(points).select(
        "shape",
        "_few",
        F.coalesce(g.point_in_few_edges(x, y, F.col("_edges")), F.lit(False)).alias("new"),
        F.coalesce(g.point_in_parts(x, y, F.col("parts")), F.lit(False)).alias("old"),
    )
    assert judged.filter("new != old").count() == 0
    assert {r["shape"] for r in judged.filter("_few").select("shape").distinct().collect()} == {0, 1, 2}
    assert judged.filter("old").count() > 100


def test_packs_hold_the_points_of_one_square():
    rng = np.random.default_rng(3)
    z = np.sort(np.concatenate([rng.integers(0, 1 << 40, 500), rng.integers(0, 1 << 10, 300), np.full(200, 77)]))
    starts = spatial_join.pack_starts(z, 16)
    ends = [*starts[1:], len(z)]
    assert starts[0] == 0 and max(b - a for a, b in zip(starts, ends, strict=True)) <= 16
    for a, b in zip(starts, ends, strict=True):
        # The smallest square of a pack holds no point of another one, but for many points on one spot.
        bits = (int(z[a] ^ z[b - 1]).bit_length() + 1) // 2
        inside = np.flatnonzero(z >> (2 * bits) == z[a] >> (2 * bits))
        assert len(set(z[inside])) == 1 or (inside[0], inside[-1] + 1) == (a, b)
    limited = spatial_join.pack_starts(z, 16, 5)
    assert all(len(set(z[a:b] >> 10)) == 1 for a, b in zip(limited, [*limited[1:], len(z)], strict=True))


def test_points_are_tested_in_one_compiled_step(spark, points, areas):
    """A pair that is left takes no step outside of compiled code, and Java compiles methods of at most 8,000 bytes."""
    found = spatial_join.points_in_areas(points, areas.filter("name IN ('square', 'hole', 'tie')"), salts=4)
    pairs = found.select("id", "name")
    with_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        text = pairs._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", with_aqe)
    last = text.split("== Subtree ")[-1]
    assert "Generate inline" in last and "Filter" in last.split("Generate inline")[0]
    assert int(re.search(r"maxMethodCodeSize:(\d+)", last)[1]) < 8000


def test_an_area_of_few_edges_is_not_cut(spark, points, areas, monkeypatch):
    """However crowded it is: its pieces would become as many as the points divided by the limit, for every area."""
    seen = []
    original = cover_join.cover

    def spying(df, *others):
        seen.extend(row["name"] for row in df.select("name").collect())
        return original(df, *others)

    monkeypatch.setattr(cover_join, "cover", spying)
    found = points_in_areas_by_cover(points, areas, 10)
    assert sorted((r.id, r.name) for r in found.collect()) == all_pairs(points, areas)
    assert sorted(seen) == ["comb", "two"]


def test_joins_leave_out_points_without_a_number(spark, areas):
    rows = [(1, float("nan"), 3.0), (2, 3.0, float("inf")), (3, 3.0, 3.0), (4, None, 3.0), (3, 3.0, 3.0)]
    spots = spark.createDataFrame(rows, "id long, x double, y double")
    squares = areas.filter("name IN ('square', 'comb')")
    for found in (spatial_join.points_in_areas(spots, squares), points_in_areas_by_cover(spots, squares)):
        assert sorted((r.id, r.name) for r in found.collect()) == all_pairs(spots.filter("id = 3"), squares)
