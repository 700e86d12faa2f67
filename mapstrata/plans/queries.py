"""The registered queries: every operator over features of the given tables."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata import dictionary
from mapstrata.functions import codes
from mapstrata.functions import geometry as g
from mapstrata.functions import members as collections
from mapstrata.functions.casts import ingestion_schema, to_date_or_null, to_timestamp_or_null
from mapstrata.functions.projection import LAMBERT_93, OVERSEAS, lambert93_to_wgs84, st_transform
from mapstrata.functions.validity import st_is_valid
from mapstrata.operators import commits
from mapstrata.operators import dedup as dedups
from mapstrata.operators import ingest as ingests
from mapstrata.operators import layers as layer_operators
from mapstrata.operators import tables
from mapstrata.operators import validate as checks
from mapstrata.operators.cover_join import points_in_areas_by_cover
from mapstrata.operators.spatial_join import boxes_overlapping, grid_levels, points_in_areas
from mapstrata.plans import features, jobs
from mapstrata.settings import (
    DEDUP_SUFFIX,
    PROJECTION,
    TABLE_PREFIX,
    VERSION,
    VERSION_DATE,
    LoadSettings,
    shared_folder,
)
from mapstrata.sources import gpkg, ledger, manifest, register

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
RANGE_SIZE = 250
STAMP = "yyyy-MM-dd HH:mm:ss"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def new_schema(spark: SparkSession, purpose: str) -> str:
    """A fresh database with its files in the shared folder."""
    name = f"mapstrata_{purpose}_{uuid.uuid4().hex[:8]}"
    tables.create_schema(spark, name, shared_folder(spark, purpose))
    return name


def _text(value: Column) -> Column:
    return F.date_format(value, STAMP)


def _rounded(value: Column, digits: int = 6) -> Column:
    return F.round(value, digits)


# -- sources ---------------------------------------------------------------


def _export(df: DataFrame, path: str, layer: str, srid: int, compressed: bool = False) -> None:
    register(df.sparkSession)
    writer = df.write.format("gpkg").mode("append").option("layer", layer)
    writer.option("srid", srid).option("compressed", str(compressed).lower()).save(path)


@query
def gpkg_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Points to containers and back."""
    path = shared_folder(spark, "gpkg")
    rows = features.with_point_geometry(features.points(spark, folder)).drop("x", "y", "layer")
    _export(rows, path, features.POINT_LAYER, LAMBERT_93)
    back = jobs.read_layer(spark, path, features.POINT_LAYER)
    point = g.st_points("geometry")[0]
    return back.select(
        "cleabs",
        "dept",
        "layer",
        "nature",
        "hauteur",
        "construction_legere",
        point["x"].alias("x"),
        point["y"].alias("y"),
        g.st_srid("geometry").alias("srid"),
    )


def _high_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points of which those in debt have no height."""
    points = features.points(spark, folder)
    plane = g.st_point("x", "y", LAMBERT_93)
    heights = F.when(~F.col("construction_legere"), F.array(F.array(F.array(F.col("hauteur")))))
    return points.withColumn(
        "geometry", g.make_geometry(plane["srid"], plane["kind"], plane["parts"], heights)
    )


@query
def gpkg_roundtrip_z(spark: SparkSession, folder: str) -> DataFrame:
    """Points and road sections with heights: to containers, into tables, back out, with equal
    plane measures; a table that was planar before takes them in."""
    path, schema = shared_folder(spark, "gpkg-z"), new_schema(spark, "heights")
    _export(_high_points(spark, folder).drop("x", "y", "layer"), path, features.POINT_LAYER, LAMBERT_93, True)
    _export(features.high_lines(spark, folder).drop("layer"), path, features.LINE_LAYER, LAMBERT_93, True)
    layers = [features.POINT_LAYER, features.LINE_LAYER]
    flat = LoadSettings(schema, layers=layers, departments="003")
    jobs.load(spark, path, flat)
    jobs.load(spark, path, dataclasses.replace(flat, departments="all", altitudes=True))
    # The tables have all of the rows now.
    commits.delete(spark, {path})
    found = []
    for layer in layers:
        rows = spark.table(tables.full_table_name("", schema, TABLE_PREFIX, layer))
        found.append(rows.select("layer", "dept", "cleabs", "geometry", "ymax"))
    shapes = found[0].unionByName(found[1])
    return shapes.select(
        "layer",
        "dept",
        "cleabs",
        g.st_has_z("geometry").alias("high"),
        _rounded(g.st_zmin("geometry"), 3).alias("zmin"),
        _rounded(g.st_zmax("geometry"), 3).alias("zmax"),
        g.st_npoints("geometry").alias("n_points"),
        g.st_area("geometry").alias("area"),
        _rounded(F.col("ymax")).alias("ymax"),
    )


@query
def geom_wkt_z(spark: SparkSession, folder: str) -> DataFrame:
    """Texts with heights, with measures and with both, read and written as WKT and GeoJSON."""
    lines = features.high_texts(spark, folder)
    parsed = lines.withColumn("geometry", g.st_geom_from_wkt("wkt", LAMBERT_93, True))
    parsed = parsed.withColumn("plane", g.st_force_2d("geometry"))
    return parsed.select(
        "cleabs",
        "dept",
        g.st_as_text("geometry", 3, True).alias("wkt"),
        g.st_as_geojson("geometry", 1, True).alias("geojson"),
        g.st_as_text("plane", 0).alias("flat"),
    )


@query
def geom_collections(spark: SparkSession, folder: str) -> DataFrame:
    """Collections of a point, a line and, but for those in debt, a square, nested and with an empty
    one; texts of furniture do not close."""
    rows = features.spread(features.points(spark, folder))
    x, y = F.col("x").cast("long"), F.col("y").cast("long")
    square = F.format_string(
        ", POLYGON((%1$d %2$d, %3$d %2$d,%3$d %4$d,%1$d %4$d , %1$d %2$d))", x, y, x + 10, y + 6
    )
    text = F.concat(
        F.format_string(
            "GeometryCollection( point (%1$d %2$d),GEOMETRYCOLLECTION(LINESTRING(%1$d %2$d, %3$d %4$d), geometrycollection empty)",
            x, y, x + 3, y + 4,
        ),
        F.when(F.col("construction_legere"), "").otherwise(square),
        F.when(F.col("nature") == "FURNITURE", "").otherwise(")"),
    )
    read = rows.withColumn("wkt", text).withColumn("shapes", collections.collection_from_wkt("wkt", LAMBERT_93))
    centre = g.st_points("centre")[0]
    projected = collections.map_members("shapes", st_transform)
    return (
        read.withColumn("centre", collections.collection_centroid("shapes"))
        .withColumn("first", F.get(collections.collection_members(projected), F.lit(0)))
        .select(
            "cleabs",
            "dept",
            collections.collection_as_text("shapes", 0).alias("wkt"),
            collections.collection_as_geojson("shapes", 0).alias("geojson"),
            F.size(collections.collection_members("shapes")).alias("n_members"),
            collections.collection_npoints("shapes").alias("n_points"),
            collections.collection_dimension("shapes").alias("dimension"),
            collections.collection_area("shapes").alias("area"),
            centre["x"].alias("centre_x"),
            centre["y"].alias("centre_y"),
            _rounded(F.get(g.st_points("first"), F.lit(0))["x"], 7).alias("lon"),
        )
    )


#: A window of the map, in Lambert-93.
WINDOW = (400000, 6300000, 700000, 6650000)


@query
def gpkg_window_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Points and buildings that touch a window, by the spatial index of their containers."""
    path = shared_folder(spark, "window")
    points = features.with_point_geometry(features.points(spark, folder)).drop("x", "y", "layer")
    found = []
    for layer, rows in ((features.POINT_LAYER, points), (features.AREA_LAYER, features.areas(spark, folder).drop("layer"))):
        register(spark)
        writer = rows.write.format("gpkg").mode("append").option("layer", layer).option("srid", LAMBERT_93)
        writer.option("spatialIndex", "true").save(path)
        scan = jobs.read_layer(spark, path, layer, window=",".join(map(str, WINDOW)))
        found.append(g.with_bbox(scan.select("layer", "dept", "cleabs", "geometry"), "geometry").drop("geometry"))
    return found[0].unionByName(found[1])


@query
def layer_listing(spark: SparkSession, folder: str) -> DataFrame:
    """Layers of containers with their feature counts, over all files."""
    path = shared_folder(spark, "listing")
    points = features.with_point_geometry(features.points(spark, folder)).drop("x", "y", "layer")
    _export(points, path, features.POINT_LAYER, LAMBERT_93)
    _export(features.areas(spark, folder).drop("layer"), path, features.AREA_LAYER, LAMBERT_93)
    _export(features.links(spark, folder), path, features.LINK_LAYER, 0)
    listing = jobs.layer_listing(spark, path)
    return listing.groupBy("layer", "kind", "srid", "crs").agg(
        F.sum("n_features").alias("n_features")
    )


@query
def layer_schema(spark: SparkSession, folder: str) -> DataFrame:
    """Derived types of a layer's columns, with the values each column holds."""
    path = shared_folder(spark, "schema")
    rows = features.areas(spark, folder).drop("layer")
    rows = rows.withColumn("date_creation", F.lit("2020-02-03").cast("date"))
    rows = rows.withColumn("date_modification", F.lit("2020-02-03 04:05:06").cast("timestamp"))
    rows = rows.withColumn("construction_legere", F.col("hauteur") < 950)
    _export(rows, path, features.AREA_LAYER, LAMBERT_93)
    extra = {"dept": T.StringType(), "layer": T.StringType()}
    schema = gpkg.layer_schema(path, features.AREA_LAYER, extra)
    scanned = jobs.read_layer(spark, path, features.AREA_LAYER)
    counts = scanned.agg(*[F.count(F.col(f"`{f.name}`")).alias(f.name) for f in schema])
    described = [
        F.struct(
            F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("n_values"),
        )
        for f in schema
    ]
    return counts.select(F.inline(F.array(*described)))


@query
def layer_counts(spark: SparkSession, folder: str) -> DataFrame:
    parts = [features.points, features.line_attributes, features.areas]
    frames = [make(spark, folder).select("layer") for make in parts]
    union = frames[0].unionByName(frames[1]).unionByName(frames[2])
    return union.groupBy("layer").agg(F.count(F.lit(1)).alias("n_features"))


@query
def batch_ranges(spark: SparkSession, folder: str) -> DataFrame:
    """Ranges of each department's road sections."""
    lines = features.line_attributes(spark, folder)
    counts = lines.groupBy("dept").agg(F.count(F.lit(1)).alias("n"))
    return layer_operators.batch_ranges(counts, "n", RANGE_SIZE)


@query
def crs_code(spark: SparkSession, folder: str) -> DataFrame:
    """Codes in reference-system texts of several spellings."""
    number = (F.col("c_nationkey") + 2150).cast("string")
    segment = F.col("c_mktsegment")
    text = (
        F.when(segment == "BUILDING", F.concat(F.lit("EPSG:"), number))
        .when(
            segment == "MACHINERY",
            F.concat(
                F.lit('PROJCS["a",GEOGCS["b",AUTHORITY["EPSG","'), number, F.lit('"]],ID["EPSG",7]]')
            ),
        )
        .when(segment == "AUTOMOBILE", F.concat(F.lit('PROJCRS["a",ID["EPSG", '), number, F.lit("]]")))
        .when(segment == "FURNITURE", F.concat(F.lit("local EPSG:"), number))
    )
    customers = features.table(spark, folder, "customer")
    return customers.select("c_custkey", codes.crs_code(text).alias("code"))


@query
def layer_selection(spark: SparkSession, folder: str) -> DataFrame:
    """Requested layers which are there, in request order, and those which
    are not.  The layers there are those the parts stand for."""
    names = F.array(*[F.lit(name) for name in dictionary.layers()])
    pick = lambda number: F.get(names, (number % 60).cast("int"))
    part = features.table(spark, folder, "part")
    listing = part.select(pick(F.col("p_size")).alias("layer")).distinct()
    key = F.col("s_suppkey")
    requests = features.table(spark, folder, "supplier").select(
        "s_suppkey",
        F.concat(
            pick(key * 7),
            F.lit(" , "),
            pick(key + 3),
            F.lit(",, unknown_"),
            (key % 5).cast("string"),
            F.lit(","),
        ).alias("request"),
    )
    wanted = layer_operators.requested_layers(requests).drop("request")
    known = layer_operators.select_layers(listing, wanted).withColumn("known", F.lit(True))
    unknown = layer_operators.unknown_layers(listing, wanted).withColumn("known", F.lit(False))
    return known.unionByName(unknown)


def _department_requests(spark: SparkSession, folder: str) -> DataFrame:
    nation = F.lpad((F.col("s_nationkey") + 1).cast("string"), 3, "0")
    request = F.when(F.col("s_acctbal") < 0, F.lit(" All ")).otherwise(
        F.concat(F.lit(" "), nation, F.lit(" ,D075, 02A"))
    )
    suppliers = features.table(spark, folder, "supplier")
    return suppliers.select("s_suppkey", request.alias("request"))


@query
def departments(spark: SparkSession, folder: str) -> DataFrame:
    """Codes asked for by each request."""
    asked = manifest.departments_of(_department_requests(spark, folder))
    return asked.select("s_suppkey", "pos", "dept")


@query
def source_manifest(spark: SparkSession, folder: str) -> DataFrame:
    asked = manifest.departments_of(_department_requests(spark, folder))
    wanted = asked.select(
        "s_suppkey",
        "pos",
        F.col("code").alias("dept"),
        F.lit(VERSION).alias("version"),
        F.lit(PROJECTION).alias("projection"),
        F.lit(VERSION_DATE).alias("version_date"),
    )
    return manifest.source_manifest(wanted).select(
        "s_suppkey", "pos", "dept", "name", "url", "checksum_url"
    )


def _landed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Documents as landed files, and what was expected of them: texts of one
    source did not land, those of another have no published checksum, and
    German ones were altered."""
    docs = features.table(spark, folder, "documents")
    actual = docs.filter(F.col("source") != "src3").select(
        "doc_id", F.octet_length("text").cast("long").alias("length"), F.md5("text").alias("md5")
    )
    published = F.concat(
        F.when(F.col("lang") == "de", F.md5(F.reverse("text"))).otherwise(F.md5("text")),
        F.lit("  folder/file.7z"),
    )
    text = F.when(F.col("source") != "src7", published)
    expected = docs.select("doc_id", codes.expected_checksum(text).alias("expected_md5"))
    return expected, actual


@query
def checksum_verify(spark: SparkSession, folder: str) -> DataFrame:
    expected, actual = _landed(spark, folder)
    return manifest.verify(expected, actual, ["doc_id"]).select("doc_id", "md5", "status")


@query
def stale_sources(spark: SparkSession, folder: str) -> DataFrame:
    expected, actual = _landed(spark, folder)
    return manifest.to_fetch(expected, actual, ["doc_id"])


@query
def landed_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Files of the documents of each source are hashed when they land and not again; those of
    one source change and are."""
    path, schema = shared_folder(spark, "landed"), new_schema(spark, "ledger")
    docs = features.table(spark, folder, "documents")
    lines = docs.select("source", "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("line"))

    def land(rows: DataFrame, mode: str) -> None:
        placed = rows.repartition("source").sortWithinPartitions("source", "doc_id").drop("doc_id")
        with tables.dynamic_overwrite(spark):
            placed.write.mode(mode).partitionBy("source").text(path)

    def hashed() -> DataFrame:
        found = ledger.checksums(spark, path, f"{schema}.ledger", "*.txt")
        source = F.regexp_extract("path", "source=([^/]+)/", 1)
        return found.select(source.alias("source"), "length", "md5", F.col("hashed").cast("int").alias("hashed"))

    land(lines, "append")
    for turn in (1, 2, 3):
        if turn == 3:
            land(lines.filter("source = 'src3'").withColumn("line", F.reverse("line")), "overwrite")
        hashed().withColumn("round", F.lit(turn)).write.mode("append").saveAsTable(f"{schema}.rounds")
    return spark.table(f"{schema}.rounds")


# -- tables ----------------------------------------------------------------


def _line_table(spark: SparkSession, folder: str, purpose: str, columns: list[str]) -> tuple[str, DataFrame]:
    """A table with the road sections' attributes, partitioned by department."""
    schema = new_schema(spark, purpose)
    name = tables.full_table_name("", schema, TABLE_PREFIX, features.LINE_LAYER)
    rows = features.line_attributes(spark, folder).select(*columns)
    tables.ensure_table(spark, name, rows.schema, features.LINE_LAYER)
    tables.append(rows.hint("rebalance", F.col("dept")), name)
    return name, rows


@query
def delete_dept(spark: SparkSession, folder: str) -> DataFrame:
    name, _ = _line_table(spark, folder, "delete", ["cleabs", "dept", "largeur"])
    tables.delete_department(spark, name, "D007")
    tables.delete_department(spark, name, "D999")
    tables.delete_department(spark, name + "_absent", "D007")
    return (
        spark.table(name)
        .groupBy("dept")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("largeur").alias("largeur"))
    )


@query
def schema_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Old rows read NULL in a column that came with later rows."""
    name, _ = _line_table(spark, folder, "merge", ["cleabs", "dept", "largeur"])
    more = features.line_attributes(spark, folder).select("nature", "largeur", "dept", "cleabs")
    tables.append(more.hint("rebalance", F.col("dept")), name)
    return (
        spark.table(name)
        .groupBy("dept", "nature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("largeur").alias("largeur"))
    )


@query
def reload_dept(spark: SparkSession, folder: str) -> DataFrame:
    """Departments 3 and 4 are loaded again: one changed, one now empty."""
    name, rows = _line_table(spark, folder, "reload", ["cleabs", "dept", "largeur", "nature"])
    again = rows.filter((F.col("dept") == "D003") & (F.col("nature") == "A")).withColumn(
        "largeur", F.col("largeur") + 100
    )
    tables.replace_departments(again, name, ["D003", "D004"], rebalance=True)
    return (
        spark.table(name)
        .groupBy("dept", "nature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("largeur").alias("largeur"))
    )


@query
def reload_recovered(spark: SparkSession, folder: str) -> DataFrame:
    """Departments 3 and 4 are loaded again by a run that stops right after its commit, and
    department 5 by one that stops before it; then department 6 is loaded."""
    name, rows = _line_table(spark, folder, "recover", ["cleabs", "dept", "largeur", "nature"])
    more = rows.withColumn("largeur", F.col("largeur") + 100)
    staged = commits.stage(more.filter((F.col("dept") == "D003") & (F.col("nature") == "A")), name, True)
    commits.announce(spark, name, staged, ["D004"])
    commits.stage(more.filter("dept = 'D005'"), name, True)
    commits.replace_departments(more.filter("dept = 'D006'"), name, ["D006"], rebalance=True)
    commits.sweep(spark, name, hours=0)
    return (
        spark.table(name)
        .groupBy("dept", "nature")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("largeur").alias("largeur"))
    )


@query
def schema_widen(spark: SparkSession, folder: str) -> DataFrame:
    """An edition gives whole numbers as doubles and texts as dates, for department 3 alone."""
    schema = new_schema(spark, "widen")
    name = tables.full_table_name("", schema, TABLE_PREFIX, features.LINE_LAYER)
    lines = features.line_attributes(spark, folder)
    old = lines.select("cleabs", "dept", F.col("part").cast("int").alias("rang"), F.col("ordre"), "date_creation")
    tables.ensure_table(spark, name, old.schema, features.LINE_LAYER)
    tables.append(old.hint("rebalance", F.col("dept")), name)
    new = old.filter("dept = 'D003'").select(
        "cleabs", "dept", F.col("rang").cast("long"), (F.col("ordre") + 0.5).alias("ordre"),
        F.date_add(to_date_or_null("date_creation"), 1).alias("date_creation"),
    )
    commits.replace_departments(new, name, ["D003"], rebalance=True)
    stored = spark.table(name)
    return stored.groupBy("dept").agg(
        F.sum("rang").alias("rang"),
        F.sum("ordre").alias("ordre"),
        F.date_format(F.max("date_creation"), "yyyy-MM-dd").alias("latest"),
        F.concat_ws(",", *[F.max(F.typeof(c)) for c in ("rang", "ordre", "date_creation")]).alias("types"),
    )


@query
def table_metadata(spark: SparkSession, folder: str) -> DataFrame:
    """Descriptions a twin takes over from its table, with the values of each
    described column."""
    schema = new_schema(spark, "metadata")
    name = tables.full_table_name("", schema, TABLE_PREFIX, features.AREA_LAYER)
    twin = name + DEDUP_SUFFIX
    rows = features.areas(spark, folder).drop("geometry")
    tables.ensure_table(
        spark, name, rows.schema, features.AREA_LAYER, VERSION, VERSION_DATE, lang="fr"
    )
    tables.append(rows.hint("rebalance", F.col("dept")), name)
    dedups.dedup_table(spark, name, twin)
    found = tables.table_metadata(spark, twin)
    columns = [(c, F.lit(text), F.count(F.col(c))) for c, text in found.columns.items()]
    described = [("column", c, text, n) for c, text, n in columns]
    rows_in = F.count(F.lit(1))
    described += [("property", k, F.lit(v), rows_in) for k, v in found.properties.items()]
    described.append(("table", "comment", F.lit(found.comment), rows_in))
    copied = spark.table(twin)
    counted = copied.agg(*[n.alias(f"n{i}") for i, (_, _, _, n) in enumerate(described)])
    structs = [
        F.struct(
            F.lit(of).alias("of"),
            F.lit(item).alias("item"),
            text.alias("text"),
            F.col(f"n{i}").alias("n_values"),
        )
        for i, (of, item, text, _) in enumerate(described)
    ]
    return counted.select(F.inline(F.array(*structs)))


@query
def source_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables with the prefix that are no twins, with their row counts."""
    schema = new_schema(spark, "listing")
    frames = {
        TABLE_PREFIX + features.LINE_LAYER: features.line_attributes(spark, folder),
        TABLE_PREFIX + features.AREA_LAYER: features.areas(spark, folder).drop("geometry"),
        TABLE_PREFIX + features.AREA_LAYER + DEDUP_SUFFIX: features.links(spark, folder),
        "other_" + features.LINK_LAYER: features.links(spark, folder),
    }
    for name, df in frames.items():
        df.write.saveAsTable(f"{schema}.{name}")
    names = tables.list_source_tables(spark, "", schema, TABLE_PREFIX)
    counts = [
        spark.table(f"{schema}.{name}")
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .select(F.lit(name).alias("table_name"), "n_rows")
        for name in names
    ]
    listing = counts[0]
    for other in counts[1:]:
        listing = listing.unionByName(other)
    return listing


@query
def load_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Rows counted by the writes, per layer and department with subtotals."""
    schema = new_schema(spark, "metrics")
    metrics: list[tuple[str, str, int]] = []
    sources = {
        features.LINE_LAYER: features.line_attributes(spark, folder),
        features.POINT_LAYER: features.points(spark, folder),
    }
    wanted = jobs.parse_departments(spark, "all") + ["D020", "D096"]
    for layer, df in sources.items():
        name = tables.full_table_name("", schema, TABLE_PREFIX, layer)
        tables.ensure_table(spark, name, df.schema, layer)
        written = tables.replace_departments(df, name, wanted, rebalance=True)
        metrics += [(layer, dept, n) for dept, n in written.rows_by_dept.items() if n]
    counted = spark.createDataFrame(metrics, "layer string, dept string, rows long")
    return layer_operators.metrics_report(counted)


# -- columns ---------------------------------------------------------------


def _raw_features(spark: SparkSession, folder: str) -> tuple[DataFrame, T.StructType]:
    """Points with WKT and dates as texts, and the schema they shall have."""
    rest = T.StructType(
        [
            T.StructField("cleabs", T.StringType()),
            T.StructField("nature", T.StringType()),
            T.StructField("date_creation", T.TimestampType()),
            T.StructField("geometry", T.StringType()),
        ]
    )
    stamp = (
        F.when(F.col("nature") == "BUILDING", "2021-03-04 05:06:60")
        .when(F.col("nature") == "MACHINERY", "1612-01-01 00:00:00")
        .when(F.col("nature") == "FURNITURE", None)
        .otherwise("2021/03/04 05:06:07")
    )
    wkt = F.concat(
        F.lit("POINT ("),
        F.col("x").cast("long").cast("string"),
        F.lit(" "),
        F.col("y").cast("long").cast("string"),
        F.lit(")"),
    )
    rows = features.points(spark, folder).select(
        "cleabs",
        "nature",
        stamp.alias("date_creation"),
        F.when(F.col("nature") != "HOUSEHOLD", wkt).alias("geometry"),
        "dept",
    )
    return ingests.add_metadata(rows, F.col("dept"), features.POINT_LAYER), rest


def _ingested(typed: DataFrame) -> DataFrame:
    return typed.select(
        "cleabs",
        "dept",
        "layer",
        _text(F.col("date_creation")).alias("date_creation"),
        g.st_srid("geometry").alias("srid"),
        _rounded(F.col("xmin")).alias("lon"),
        _rounded(F.col("ymax")).alias("lat"),
    )


@query
def ingest_features(spark: SparkSession, folder: str) -> DataFrame:
    """WKT and dates in flight become projected geometries and typed columns."""
    tagged, rest = _raw_features(spark, folder)
    return _ingested(ingests.ingest(tagged, rest, LAMBERT_93))


@query
def frames_to_table(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows in two frames, each ingested and appended to one table, read back."""
    tagged, rest = _raw_features(spark, folder)
    table = f"{new_schema(spark, 'frames')}.{features.POINT_LAYER}"
    late = F.col("nature").isin("BUILDING", "MACHINERY")
    for part in (tagged.filter(~late), tagged.filter(late)):
        jobs.write_frame(spark, part, table, rest, LAMBERT_93)
    return _ingested(spark.table(table))


@query
def tolerant_cast(spark: SparkSession, folder: str) -> DataFrame:
    stamps = features.order_stamps(spark, folder)
    return stamps.select(
        "o_orderkey",
        _text(to_timestamp_or_null("raw")).alias("as_timestamp"),
        F.date_format(to_date_or_null("raw"), "yyyy-MM-dd").alias("as_date"),
    )


@query
def cast_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Values the casts of the ingestion schema turn into NULL."""
    stamps = features.order_stamps(spark, folder).select(
        F.col("raw").alias("date_creation"), F.col("raw").alias("date_de_confirmation")
    )
    rest = T.StructType(
        [
            T.StructField("date_creation", T.TimestampType()),
            T.StructField("date_de_confirmation", T.DateType()),
        ]
    )
    in_flight, _ = ingestion_schema(rest)
    return ingests.cast_losses(stamps.select(*in_flight.names), rest)


@query
def bad_datetimes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with impossible seconds in one or both of two date columns."""
    stamps = features.order_stamps(spark, folder).select(
        "o_orderkey",
        F.col("raw").alias("date_creation"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("2020-01-01 00:00:-1"))
        .otherwise(F.col("raw"))
        .alias("date_modification"),
        F.lit("12:00:99").alias("horaire"),
    )
    bad = ingests.bad_datetimes(stamps)
    return bad.select("o_orderkey", F.array_join("bad_columns", ",").alias("bad_columns"))


@query
def geom_wkt_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    lines = features.lines_as_text(spark, folder)
    parsed = lines.withColumn("geometry", g.st_geom_from_wkt("wkt", LAMBERT_93))
    return parsed.select("cleabs", "dept", g.st_as_text("geometry", 6).alias("wkt"))


@query
def geom_srid(spark: SparkSession, folder: str) -> DataFrame:
    """SRID before and after; an unknown one stays as it is."""
    points = features.points(spark, folder)
    known = g.st_point("x", "y", LAMBERT_93)
    geometry = F.when(F.col("construction_legere"), known.withField("srid", F.lit(None).cast("int")))
    geometry = geometry.when(F.col("nature") != "FURNITURE", known)
    points = points.withColumn("geometry", geometry)
    return points.select(
        "cleabs",
        "dept",
        g.st_srid("geometry").alias("srid"),
        g.st_srid(st_transform("geometry")).alias("srid_after"),
    )


def _all_kinds(spark: SparkSession, folder: str) -> DataFrame:
    points = features.with_point_geometry(features.points(spark, folder))
    frames = [points, features.lines(spark, folder), features.areas(spark, folder)]
    parts = [df.select("cleabs", "dept", "geometry") for df in frames]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def geom_type(spark: SparkSession, folder: str) -> DataFrame:
    kinds = _all_kinds(spark, folder).select(g.st_geometry_type("geometry").alias("kind"))
    return kinds.groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


@query
def geom_npoints(spark: SparkSession, folder: str) -> DataFrame:
    shapes = _all_kinds(spark, folder)
    return shapes.select("cleabs", "dept", g.st_npoints("geometry").alias("n_points"))


@query
def geom_bbox(spark: SparkSession, folder: str) -> DataFrame:
    boxed = g.with_bbox(_all_kinds(spark, folder), "geometry")
    return boxed.drop("geometry")


@query
def geom_area(spark: SparkSession, folder: str) -> DataFrame:
    areas = features.areas(spark, folder)
    return areas.select("cleabs", _rounded(g.st_area("geometry")).alias("area"))


@query
def geom_centroid(spark: SparkSession, folder: str) -> DataFrame:
    areas = features.areas(spark, folder).withColumn("_c", g.st_points(g.st_centroid("geometry"))[0])
    return areas.select(
        "cleabs", _rounded(F.col("_c")["x"], 4).alias("cx"), _rounded(F.col("_c")["y"], 4).alias("cy")
    )


@query
def geom_is_valid(spark: SparkSession, folder: str) -> DataFrame:
    areas = features.areas(spark, folder)
    return areas.select("cleabs", st_is_valid("geometry").alias("valid"))


@query
def geom_geojson(spark: SparkSession, folder: str) -> DataFrame:
    points = features.with_point_geometry(features.points(spark, folder))
    areas = features.areas(spark, folder)
    shapes = points.select("cleabs", "dept", "geometry").unionByName(
        areas.select("cleabs", "dept", "geometry")
    )
    return shapes.select("cleabs", "dept", g.st_as_geojson("geometry", 6).alias("geojson"))


@query
def geom_transform(spark: SparkSession, folder: str) -> DataFrame:
    """Points by scalar columns."""
    lon, lat = lambert93_to_wgs84("x", "y")
    points = features.points(spark, folder)
    return points.select(
        "cleabs", "dept", _rounded(lon, 7).alias("lon"), _rounded(lat, 7).alias("lat")
    )


@query
def geom_transform_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All vertices of road sections, reported by their extent."""
    lines = features.lines(spark, folder)
    projected = lines.withColumn("geometry", st_transform("geometry"))
    boxed = g.with_bbox(projected, "geometry")
    return boxed.select(
        "cleabs",
        "dept",
        *[_rounded(F.col(c)).alias(c) for c in ("xmin", "ymin", "xmax", "ymax")],
    )


@query
def geom_transform_utm(spark: SparkSession, folder: str) -> DataFrame:
    """Points in the systems of the overseas departments and in zones of UTM."""
    key = F.col("c_custkey")
    known = F.array(*[F.lit(code) for code in (*OVERSEAS, 32631, 32719)])
    system = F.get(known, (F.col("c_nationkey") % (len(OVERSEAS) + 2)).cast("int"))
    x, y = (F.lit(300000) + key * 7919 % 400000).cast("double"), (F.lit(1000000) + key * 104729 % 8000000).cast("double")
    points = features.table(spark, folder, "customer").select("c_custkey", system.alias("srid"), g.st_point(x, y).alias("p"))
    moved = st_transform(F.col("p").withField("srid", F.col("srid")))
    spot = g.st_points("q")[0]
    return points.withColumn("q", moved).select(
        "c_custkey", "srid", _rounded(spot["x"], 7).alias("lon"), _rounded(spot["y"], 7).alias("lat")
    )


WIDE = 400


def _blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Larger areas than buildings, with their extents."""
    return g.with_bbox(
        features.areas(spark, folder, WIDE).select("cleabs", "geometry"), "geometry"
    )


@query
def geom_intersects(spark: SparkSession, folder: str) -> DataFrame:
    """Which order positions lie in which blocks."""
    points = features.order_positions(spark, folder)
    pairs = points_in_areas(points, _blocks(spark, folder), salts=4)
    return pairs.select("point_id", "cleabs")


#: Positions a join key may have in a table of this size, before its cell is cut.
CROWD = 500


@query
def geom_intersects_cover(spark: SparkSession, folder: str) -> DataFrame:
    """Which order positions lie in which blocks and in which of the octagons, the widest of
    which holds nine in ten of them."""
    points = features.order_positions(spark, folder)
    wide = g.with_bbox(features.octagons(spark, folder), "geometry")
    areas = _blocks(spark, folder).unionByName(wide)
    return points_in_areas_by_cover(points, areas, limit=CROWD).select("point_id", "cleabs")


@query
def box_intersects(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks whose boxes overlap, each pair once."""
    blocks = _blocks(spark, folder).drop("geometry")
    others = blocks.select(*[F.col(c).alias("o_" + c) for c in blocks.columns])
    pairs = boxes_overlapping(blocks, others, grid_levels(blocks))
    return pairs.filter(F.col("cleabs") < F.col("o_cleabs")).select("cleabs", "o_cleabs")


# -- dedup -----------------------------------------------------------------

LINE_COLUMNS = ["cleabs", "dept", "nature", "part", "supplier", "largeur", "date_creation"]


@query
def dedup(spark: SparkSession, folder: str) -> DataFrame:
    return dedups.dedup(features.line_attributes(spark, folder).select(*LINE_COLUMNS))


@query
def dedup_of_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """The same result when only repeated keys go through the window."""
    lines = features.line_attributes(spark, folder).select(*LINE_COLUMNS)
    repeats = dedups.key_counts(lines).filter("n > 1").select("key")
    return dedups.dedup_by_repeats(lines, repeats)


@query
def dedup_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Equal texts, first language first."""
    docs = features.table(spark, folder, "documents").select(
        F.md5("text").alias("cleabs"), F.col("lang").alias("dept"), "source", "doc_id"
    )
    return dedups.dedup(docs)


@query
def dedup_stats(spark: SparkSession, folder: str) -> DataFrame:
    columns = ["layer", "cleabs"]
    union = features.line_attributes(spark, folder).select(*columns)
    union = union.unionByName(features.points(spark, folder).select(*columns))
    return dedups.dedup_stats(union, ["layer"])


# -- checks ----------------------------------------------------------------


def _checked_points(spark: SparkSession, folder: str) -> DataFrame:
    points = features.with_point_geometry(features.points(spark, folder))
    points = points.withColumn(
        "geometry", F.when(F.col("nature") != "FURNITURE", F.col("geometry"))
    )
    return g.with_bbox(points.withColumn("geometry", st_transform("geometry")), "geometry")


def _checked_areas(spark: SparkSession, folder: str) -> DataFrame:
    areas = features.areas(spark, folder)
    return g.with_bbox(areas.withColumn("geometry", st_transform("geometry")), "geometry")


@query
def validate_bounds(spark: SparkSession, folder: str) -> DataFrame:
    points, line_rows = _checked_points(spark, folder), features.lines(spark, folder)
    untransformed = g.with_bbox(line_rows, "geometry")
    results = [
        df.agg(*checks.bounds_figures()).select(
            F.inline(F.array(*checks.bounds_results(F.lit(name))))
        )
        for name, df in {"points": points, "lines": untransformed}.items()
    ]
    return results[0].unionByName(results[1])


@query
def validate_srid(spark: SparkSession, folder: str) -> DataFrame:
    points, line_rows = _checked_points(spark, folder), features.lines(spark, folder)
    mixed = line_rows.select("geometry").unionByName(points.select("geometry"))
    nothing = points.select(F.when(F.col("x") < 0, F.col("geometry")).alias("geometry"))
    frames = {"points": points, "mixed": mixed, "nothing": nothing}
    results = [
        df.agg(*checks.srid_figures()).select(F.inline(F.array(*checks.srid_results(F.lit(name)))))
        for name, df in frames.items()
    ]
    return results[0].unionByName(results[1]).unionByName(results[2])


@query
def validate_geom_functions(spark: SparkSession, folder: str) -> DataFrame:
    frames = {"points": _checked_points(spark, folder), "areas": _checked_areas(spark, folder)}
    results = [
        checks.with_validity(df)
        .agg(*checks.srid_figures(), *checks.function_figures())
        .select(F.inline(F.array(*checks.function_results(F.lit(name)))))
        for name, df in frames.items()
    ]
    return results[0].unionByName(results[1])


@query
def validate_dedup(spark: SparkSession, folder: str) -> DataFrame:
    lines = features.line_attributes(spark, folder).select(*LINE_COLUMNS)
    good = checks.check_twin(lines, dedups.dedup(lines), "lines_dedup")
    bad = checks.check_twin(lines, lines.unionByName(lines), "lines_doubled")
    return good.unionByName(bad)


@query
def validate_report(spark: SparkSession, folder: str) -> DataFrame:
    """All checks on the tables of a schema: two layers and their twins."""
    schema = new_schema(spark, "report")
    frames = {
        features.POINT_LAYER: _checked_points(spark, folder).drop("x", "y"),
        features.AREA_LAYER: _checked_areas(spark, folder),
        features.LINK_LAYER: features.links(spark, folder),
    }
    for layer, df in frames.items():
        name = tables.full_table_name("", schema, TABLE_PREFIX, layer)
        tables.ensure_table(spark, name, df.schema, layer, VERSION, VERSION_DATE)
        by_dept = df.hint("rebalance", F.col("dept")) if "dept" in df.columns else df
        tables.append(by_dept, name)
    jobs.dedup(spark, LoadSettings(schema))
    return jobs.validate(spark, LoadSettings(schema), must_pass=False)


@query
def load_job(spark: SparkSession, folder: str) -> DataFrame:
    """Containers to tables: scan, type, reproject, replace; then the counts
    and extents of what the tables hold."""
    path, schema = shared_folder(spark, "containers"), new_schema(spark, "load")
    points = features.with_point_geometry(features.points(spark, folder)).drop("x", "y", "layer")
    _export(points, path, features.POINT_LAYER, LAMBERT_93)
    _export(features.areas(spark, folder).drop("layer"), path, features.AREA_LAYER, LAMBERT_93)
    wanted = ["nowhere", features.AREA_LAYER, features.POINT_LAYER]
    jobs.load(spark, path, LoadSettings(schema, layers=wanted))
    results = []
    for layer in (features.AREA_LAYER, features.POINT_LAYER):
        name = tables.full_table_name("", schema, TABLE_PREFIX, layer)
        results.append(
            spark.table(name)
            .groupBy("layer", "dept")
            .agg(
                F.count(F.lit(1)).alias("n"),
                _rounded(F.min("xmin")).alias("min_lon"),
                _rounded(F.max("ymax")).alias("max_lat"),
            )
        )
    return results[0].unionByName(results[1])


#: A point, a point cut short and an empty collection as WKB.
SPOT = "01010000000000000000e6234100000000242d5a41"
CUT, COLLECTION = SPOT[:30], "010700000000000000"


@query
def load_losses(spark: SparkSession, folder: str) -> DataFrame:
    """Road sections with impossible seconds, texts for numbers, broken geometries and collections
    are loaded: the values lost, per layer, department, column and reason."""
    path, schema = shared_folder(spark, "losses"), new_schema(spark, "losses")
    rank, stamp = F.col("rang"), F.col("date_creation")
    wkb = F.when(rank == 5, CUT).when(rank == 6, COLLECTION).otherwise(SPOT)
    rows = features.line_attributes(spark, folder).select(
        "cleabs",
        "dept",
        F.when(rank == 3, F.concat(F.substring(stamp, 1, 17), F.lit("60"))).otherwise(stamp).alias("date_creation"),
        F.when(rank == 4, "1612-13-41").alias("date_modification"),
        F.when(rank.isin(2, 3), "many").otherwise(rank.cast("string")).alias("voies"),
        F.when(rank < 7, F.unhex(wkb)).alias("geometry"),
    )
    register(spark)
    writer = rows.write.format("gpkg").mode("append").option("layer", features.LINE_LAYER)
    writer.option("srid", LAMBERT_93).option(
        "declared", "date_creation=DATETIME,date_modification=DATE,voies=INTEGER"
    ).save(path)
    jobs.load(spark, path, LoadSettings(schema, layers=[features.LINE_LAYER]))
    counted = spark.table(f"{schema}.{jobs.LOSSES_TABLE}").drop("run")
    kept = spark.table(f"{schema}.{jobs.REJECTS_TABLE}").groupBy("layer", "dept", "column", "reason").agg(
        F.countDistinct("key").alias("keys"), F.max("raw").alias("raw")
    )
    return counted.join(kept, ["layer", "dept", "column", "reason"])


# -- dictionary ------------------------------------------------------------


def _described_parts(spark: SparkSession, folder: str) -> DataFrame:
    """A layer name per part; some are no layer."""
    names = F.array(*[F.lit(name) for name in dictionary.layers()], F.lit("unknown_layer"))
    layer = F.get(names, (F.col("p_partkey") % 61).cast("int"))
    return features.table(spark, folder, "part").withColumn("layer", layer)


@query
def column_comments(spark: SparkSession, folder: str) -> DataFrame:
    """Texts of columns in a language; German falls back on English."""
    columns = ["cleabs", "hauteur", "nature", "code_insee", "date_d_apparition", "no_such_column"]
    picked = F.get(F.array(*[F.lit(c) for c in columns]), F.col("p_size") % len(columns))
    asked = _described_parts(spark, folder).select("p_partkey", "layer", picked.alias("column"))
    texts = [
        dictionary.describe_columns(asked, lang).withColumn("lang", F.lit(lang))
        for lang in ("en", "fr", "de")
    ]
    return texts[0].unionByName(texts[1]).unionByName(texts[2])


@query
def table_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    date = F.when(F.col("p_size") > 25, VERSION_DATE).otherwise("")
    asked = _described_parts(spark, folder).select("p_partkey", "layer", date.alias("edition"))
    texts = [
        dictionary.describe_tables(asked, F.lit(VERSION), F.col("edition"), lang)
        .withColumn("lang", F.lit(lang))
        .drop("edition")
        for lang in ("en", "fr")
    ]
    return texts[0].unionByName(texts[1])
