"""Texts read and written in batches equal those of the exact expressions."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from mapstrata.functions import geometry as g
from mapstrata.functions import plain_text

NUMBERS = [
    "0", "-0", "7", "-12", "652709.4", "6860123.125", "0.5", "-0.5", "2.5", "1.005", "0.0000005", "-0.0000001",
    "1.0000005", "999999999999", "900000000000.5", "123456789012345", "0.9999995", "1e3", "+1", "nan", "1.", "x",
]


def some_texts(n):
    rng = random.Random(4)

    def line(width):
        points = [" ".join(rng.choice(NUMBERS[:17 if rng.random() < 0.9 else None]) for _ in range(width))]
        points += [" ".join(str(rng.randint(-9, 9)) for _ in range(rng.choice([width, width, 2]))) for _ in range(rng.randint(0, 3))]
        return "(" + rng.choice([", ", ",", " , "]).join(points) + ")"

    made = [None, "", "POINT EMPTY", "LINESTRING EMPTY", "POINT (1 2, 3 4)", "POLYGON (1 2)", "LINESTRING ((1 2))", "POLYGON ((1 2),())"]
    for _ in range(n):
        kind, width = rng.choice(["POINT", "LINESTRING", "POLYGON", "MULTIPOINT", "MULTILINESTRING", "linestring"]), rng.choice([1, 2, 2, 3, 3, 4, 5])
        body = line(width)
        if kind in ("POLYGON", "MULTILINESTRING"):
            body = "(" + body + "".join(rng.choice([", ", ","]) + line(width) for _ in range(rng.randint(0, 2))) + ")"
        made.append(kind + rng.choice(["", " ", " Z ", " M", " ZM ", "Z"]) + body)
    return made


@pytest.mark.parametrize("z", [False, True])
def test_batches_equal_expressions(spark, z):
    df = spark.createDataFrame(list(enumerate(some_texts(1500))), "i int, t string").repartition(3)
    df = df.select("t", g.st_geom_from_wkt("t", 2154, z).alias("a"), g.st_geom_from_wkt(F.col("t"), 2154, z).alias("b"))
    df = df.localCheckpoint()
    assert df.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
    assert df.filter("a is not null").count() > 500 and df.filter("a is null").count() > 100
    for decimals in (0, 1, 6):
        both = df.select(
            "t",
            F.array(g.st_as_text("a", decimals, z), g.st_as_geojson("a", decimals, z)).alias("x"),
            F.array(g.st_as_text(F.col("a"), decimals, z), g.st_as_geojson(F.col("a"), decimals, z)).alias("y"),
        )
        assert both.filter(~F.col("x").eqNullSafe(F.col("y"))).collect() == []


def test_plain_texts_take_no_expression():
    """Lines, points and polygons are done by the batch; the rest is left to the expressions."""
    texts = pa.array(["LINESTRING (1 2, 3.5 4)", "POINT Z (1 2 3)", None, "POLYGON ((0 0, 1 0, 1 1, 0 0), (0 0, 1 0, 0 0))", "MULTIPOINT (1 2)"])
    shapes = plain_text.read_plain(texts, 2154, True)
    assert shapes.is_valid().to_pylist() == [True, True, False, True, False]
    assert plain_text.write_plain(shapes, 1, True, False).to_pylist() == [
        "LINESTRING (1.0 2.0, 3.5 4.0)", "POINT Z (1.0 2.0 3.0)", None,
        "POLYGON ((0.0 0.0, 1.0 0.0, 1.0 1.0, 0.0 0.0), (0.0 0.0, 1.0 0.0, 0.0 0.0))", None,
    ]


def test_a_half_is_left_to_the_expressions():
    texts, certain = plain_text.fixed_texts(np.array([0.25, 0.26, -0.24, 3.0, np.nan, np.inf, 1e15]), 1)
    assert certain.tolist() == [False, True, True, True, False, False, False]
    assert texts.to_pylist()[1:4] == ["0.3", "-0.2", "3.0"]


def test_queries_read_and_write_in_batches(spark, tmp_path):
    from mapstrata.plans.queries import QUERIES

    spark.sql("""SELECT id AS l_orderkey, id % 7 AS l_partkey, id % 5 AS l_suppkey, cast(id % 4 AS int) AS l_linenumber,
        cast(id % 50 AS double) AS l_quantity, element_at(array('A', 'N', 'R'), cast(id % 3 + 1 AS int)) AS l_returnflag,
        timestamp '2020-01-01 00:00:00' AS l_shipdate FROM range(30)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    for name in ("geom_wkt_roundtrip", "geom_wkt_z"):
        found = QUERIES[name](spark, str(tmp_path))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") == 2 and found.count() == 30, name
        assert all(r.wkt for r in found.collect())
