"""Map features derived from the given tables.

The tables hold no geometries, so positions, shapes and texts follow from
their keys and values by plain arithmetic.  Every row of a table becomes a
feature; nothing is left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.functions.geometry import make_geometry, st_point
from mapstrata.functions.projection import LAMBERT_93

# Which layer the features stand for.
POINT_LAYER = "point_de_repere"
LINE_LAYER = "troncon_de_route"
AREA_LAYER = "batiment"
LINK_LAYER = "batiment_rnb_lien_bdtopo"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core rows to work on.

    Only a table of fewer scan tasks than cores is shuffled, such as one that
    lies in a single row group; a large one keeps its scan partitions.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores:
        return df
    return df.repartition(cores)


def _code(number: Column) -> Column:
    return F.concat(F.lit("D"), F.lpad(number.cast("string"), 3, "0"))


def _spread(value: Column, factor: int, modulus: int, start: int) -> Column:
    return (F.lit(start) + (value * F.lit(factor).cast("long")) % modulus).cast("double")


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def points(spark: SparkSession, folder: str) -> DataFrame:
    """One point per customer; those in debt lie on a border and come in two
    departments."""
    c = table(spark, folder, "customer")
    shifts = F.when(F.col("c_acctbal") < 0, F.array(F.lit(0), F.lit(1))).otherwise(
        F.array(F.lit(0))
    )
    return c.withColumn("_shift", F.explode(shifts)).select(
        F.concat(F.lit("FEAT"), F.lpad(F.col("c_custkey").cast("string"), 16, "0")).alias("cleabs"),
        _code(F.col("c_nationkey") + 1 + F.col("_shift")).alias("dept"),
        F.lit(POINT_LAYER).alias("layer"),
        _spread(F.col("c_custkey"), 7919, 1100000, 100000).alias("x"),
        _spread(F.col("c_custkey"), 104729, 1050000, 6050000).alias("y"),
        F.col("c_acctbal").alias("hauteur"),
        (F.col("c_acctbal") < 0).alias("construction_legere"),
        F.col("c_mktsegment").alias("nature"),
    )


def with_point_geometry(df: DataFrame, srid: int = LAMBERT_93) -> DataFrame:
    return df.withColumn("geometry", st_point("x", "y", srid))


def line_attributes(spark: SparkSession, folder: str) -> DataFrame:
    """One road section per order line.  Line numbers repeat within orders,
    so keys do too, in one department or several."""
    return table(spark, folder, "lineitem").select(
        F.concat(
            F.lit("LINE"),
            F.lpad(F.col("l_orderkey").cast("string"), 14, "0"),
            F.lpad(F.col("l_linenumber").cast("string"), 2, "0"),
        ).alias("cleabs"),
        _code(F.col("l_suppkey") % 96 + 1).alias("dept"),
        F.lit(LINE_LAYER).alias("layer"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_quantity").alias("largeur"),
        F.col("l_returnflag").alias("nature"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("date_creation"),
        F.col("l_orderkey").alias("ordre"),
        F.col("l_linenumber").alias("rang"),
    )


def _vertex_count() -> Column:
    return (F.col("largeur") % 6).cast("int") + 2


def _vertex(i: Column) -> Column:
    x0 = F.lit(100000) + (F.col("part") * F.lit(7919).cast("long")) % 1000000
    y0 = F.lit(6100000) + (F.col("supplier") * F.lit(104729).cast("long") + F.col("ordre")) % 900000
    return _point((x0 + i * 10).cast("double"), (y0 + (i % 2) * F.col("rang")).cast("double"))


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Road sections of two to seven vertices."""
    ring = F.transform(F.sequence(F.lit(0), _vertex_count() - 1), _vertex)
    geometry = make_geometry(F.lit(LAMBERT_93), F.lit("LINESTRING"), F.array(F.array(ring)))
    return spread(line_attributes(spark, folder)).withColumn("geometry", geometry)


def lines_as_text(spark: SparkSession, folder: str) -> DataFrame:
    """The same sections as WKT in ``wkt``."""

    def words(i: Column) -> Column:
        p = _vertex(i)
        return F.concat(
            p["x"].cast("long").cast("string"), F.lit(" "), p["y"].cast("long").cast("string")
        )

    steps = F.sequence(F.lit(0), _vertex_count() - 1)
    body = F.array_join(F.transform(steps, words), ", ")
    return spread(line_attributes(spark, folder)).withColumn(
        "wkt", F.concat(F.lit("LINESTRING ("), body, F.lit(")"))
    )


def _height(i: Column) -> Column:
    """Height of the vertex ``i``; sections of return flag N are planar."""
    return (F.col("largeur") * 10 + i * 2.5).cast("double")


def high_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The same sections with a height for each vertex, but for those of flag N."""
    steps = F.sequence(F.lit(0), _vertex_count() - 1)
    ring = F.transform(steps, _vertex)
    heights = F.when(F.col("nature") != "N", F.array(F.array(F.transform(steps, _height))))
    geometry = make_geometry(F.lit(LAMBERT_93), F.lit("LINESTRING"), F.array(F.array(ring)), heights)
    rows = spread(line_attributes(spark, folder)).withColumn("geometry", geometry)
    return rows.drop("part", "supplier", "ordre", "rang")


def high_texts(spark: SparkSession, folder: str) -> DataFrame:
    """WKT of the sections: with heights (R), with measures (N), with both or an unmarked third number (A)."""

    def words(i: Column) -> Column:
        p = _vertex(i)
        plane = F.concat_ws(" ", p["x"].cast("long").cast("string"), p["y"].cast("long").cast("string"))
        high = _height(i).cast("decimal(10,1)").cast("string")
        both = (F.col("nature") == "A") & (F.col("rang") % 2 == 0)
        return F.concat_ws(" ", plane, high, F.when(both, F.lit("7")))

    mark = (
        F.when(F.col("nature") == "R", F.lit(" Z "))
        .when(F.col("nature") == "N", F.lit(" M"))
        .when(F.col("rang") % 2 == 0, F.lit("ZM "))
        .otherwise(F.lit(" "))
    )
    body = F.array_join(F.transform(F.sequence(F.lit(0), _vertex_count() - 1), words), ",")
    return spread(line_attributes(spark, folder)).withColumn(
        "wkt", F.concat(F.lit("LINESTRING"), mark, F.lit("("), body, F.lit(")"))
    )


def areas(spark: SparkSession, folder: str, scale: int = 10) -> DataFrame:
    """One building per part: a rectangle, with a hole when the size is a
    multiple of five, or a bow-tie, which is not valid, for keys which are
    multiples of 97."""
    part = spread(table(spark, folder, "part"))
    key = F.col("p_partkey")
    x0, y0 = _spread(key, 7919, 1000000, 100000), _spread(key, 104729, 900000, 6100000)
    w = (F.col("p_size") * scale).cast("double")
    h = (F.col("p_size") * scale / 2 + 5).cast("double")
    x1, y1 = x0 + w, y0 + h

    def ring(*corners: tuple[Column, Column]) -> Column:
        return F.array(*[_point(x, y) for x, y in corners])

    shell = ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    tie = ring((x0, y0), (x1, y1), (x1, y0), (x0, y1), (x0, y0))
    hole = ring(
        (x0 + 1, y0 + 1), (x0 + 1, y1 - 1), (x1 - 1, y1 - 1), (x1 - 1, y0 + 1), (x0 + 1, y0 + 1)
    )
    rings = (
        F.when(key % 97 == 0, F.array(tie))
        .when(F.col("p_size") % 5 == 0, F.array(shell, hole))
        .otherwise(F.array(shell))
    )
    return part.select(
        F.concat(F.lit("BATI"), F.lpad(key.cast("string"), 16, "0")).alias("cleabs"),
        _code(key % 96 + 1).alias("dept"),
        F.lit(AREA_LAYER).alias("layer"),
        F.col("p_type").alias("nature"),
        F.col("p_retailprice").alias("hauteur"),
        F.col("p_size").alias("nombre_d_etages"),
        make_geometry(F.lit(LAMBERT_93), F.lit("POLYGON"), F.array(rings)).alias("geometry"),
    )


#: Half width, half height and reach of the widest octagon, and what each next one lacks.
OCTAGONS = ((490000, 440000, 800000), (60000, 60000, 110000))
OCTAGON_CENTRE = (600000, 6550000)


def octagons(spark: SparkSession, folder: str) -> DataFrame:
    """An octagon per region around one centre, the first over nearly all of the map."""
    key = F.col("r_regionkey")
    a, b, c = (F.lit(first) - key * less for first, less in zip(*OCTAGONS, strict=True))
    x, y = OCTAGON_CENTRE
    corners = [(a, c - a), (c - b, b), (b - c, b), (-a, c - a), (-a, a - c), (b - c, -b), (c - b, -b), (a, a - c)]
    ring = F.array(
        *[_point((F.lit(x) + u).cast("double"), (F.lit(y) + v).cast("double")) for u, v in [*corners, corners[0]]]
    )
    return table(spark, folder, "region").select(
        F.concat(F.lit("OCTO"), F.lpad(key.cast("string"), 16, "0")).alias("cleabs"),
        make_geometry(F.lit(LAMBERT_93), F.lit("POLYGON"), F.array(F.array(ring))).alias("geometry"),
    )


def links(spark: SparkSession, folder: str) -> DataFrame:
    """One link without geometry per supplier."""
    s = table(spark, folder, "supplier")
    return s.select(
        F.lpad(F.col("s_suppkey").cast("string"), 12, "0").alias("identifiant_rnb"),
        F.concat(F.lit("BATI"), F.lpad(F.col("s_suppkey").cast("string"), 16, "0")).alias(
            "cleabs_batiment"
        ),
    )


def order_positions(spark: SparkSession, folder: str) -> DataFrame:
    """One position per order."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("point_id"),
        _spread(F.col("o_orderkey"), 7919, 1000000, 100000).alias("x"),
        _spread(F.col("o_orderkey"), 104729, 900000, 6100000).alias("y"),
    )


def order_stamps(spark: SparkSession, folder: str) -> DataFrame:
    """A stamp as text per order, spelled by its priority, some malformed."""
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    priority, status = F.col("o_orderpriority"), F.col("o_orderstatus")
    clock = F.concat(
        F.lpad((F.col("o_orderkey") % 24).cast("string"), 2, "0"),
        F.lit(":"),
        F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0"),
        F.lit(":"),
    )
    raw = (
        F.when(priority == "1-URGENT", F.concat(day, F.lit(" "), clock, F.lit("60")))
        .when((priority == "2-HIGH") & (status == "F"), None)
        .when(priority == "2-HIGH", F.concat(day, F.lit(" "), clock, F.lit("07")))
        .when(priority == "3-MEDIUM", F.concat(day, F.lit(" "), clock, F.lit("08+00:00")))
        .when(
            priority == "4-NOT SPECIFIED",
            F.concat(F.replace(day, F.lit("-"), F.lit("/")), F.lit(" "), clock, F.lit("09")),
        )
        .when(status == "P", F.concat(day, F.lit("T"), clock, F.lit("61.5Z")))
        .otherwise(F.concat(F.substring(day, 1, 4), F.lit("-13-01 "), clock, F.lit("10")))
    )
    return table(spark, folder, "orders").select("o_orderkey", raw.alias("raw"))
