"""Checks of loaded tables as a DataFrame of results.

Each table is read once: every figure the checks need is one aggregation.
Where a sampled row would do for a spot check, the rule here counts
violations over all rows instead.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.dictionary import layer_titles
from mapstrata.functions.geometry import (
    GEOMETRY_TYPE,
    GEOMETRY_Z_TYPE,
    st_area,
    st_as_geojson,
    st_centroid,
    st_geometry_type,
    st_npoints,
    st_srid,
)
from mapstrata.functions.validity import st_is_valid
from mapstrata.operators.tables import quoted, tables_with_prefix
from mapstrata.settings import DEDUP_SUFFIX, FEATURE_KEY, TABLE_PREFIX, TARGET_SRID

RESULT = "check string, table string, ok boolean, detail string"
GEOMETRY_COLUMN = "geometry"
CONCURRENT_CHECKS = 6
# The open interval each coordinate has to lie in.
LON_BOUNDS = (-6.0, 11.0)
LAT_BOUNDS = (40.0, 53.0)
# Layers of links, which have no geometry.
LAYERS_WITHOUT_GEOMETRY = ("lien_adresse_vers_bdtopo", "batiment_rnb_lien_bdtopo")


class ValidationFailed(RuntimeError):
    """At least one check failed."""


# -- aggregates ------------------------------------------------------------


def row_figures() -> list[Column]:
    return [F.count(F.lit(1)).alias("rows")]


def srid_figures(srid: int = TARGET_SRID) -> list[Column]:
    code = st_srid(GEOMETRY_COLUMN)
    return [
        F.count(F.col(GEOMETRY_COLUMN)).alias("geometries"),
        F.count_if(code != srid).alias("wrong_srid"),
        F.min(code).alias("min_srid"),
        F.max(code).alias("max_srid"),
    ]


def bounds_figures() -> list[Column]:
    """Extents over rows with a geometry, from the stored extent columns."""
    there = F.col(GEOMETRY_COLUMN).isNotNull()
    return [
        F.min(F.when(there, F.col("xmin"))).alias("min_lon"),
        F.max(F.when(there, F.col("xmax"))).alias("max_lon"),
        F.min(F.when(there, F.col("ymin"))).alias("min_lat"),
        F.max(F.when(there, F.col("ymax"))).alias("max_lat"),
    ]


def function_figures() -> list[Column]:
    """Rows with a geometry on which a geometry function gives no good value."""
    geom = F.col(GEOMETRY_COLUMN)
    there = geom.isNotNull()
    return [
        F.count_if(there & st_geometry_type(geom).isNull()).alias("no_type"),
        F.count_if(there & (F.coalesce(st_npoints(geom), F.lit(0)) <= 0)).alias("no_points"),
        F.count_if(there & st_area(geom).isNull()).alias("no_area"),
        F.count_if(there & st_centroid(geom).isNull()).alias("no_centroid"),
        F.count_if(there & st_as_geojson(geom).isNull()).alias("no_geojson"),
        F.count_if(there & ~F.coalesce(F.col("_valid"), F.lit(False))).alias("not_valid"),
    ]


def with_validity(df: DataFrame) -> DataFrame:
    """Add ``_valid``, computed below the aggregation that counts it."""
    return df.withColumn("_valid", st_is_valid(GEOMETRY_COLUMN))


# -- results out of figures ------------------------------------------------


def _result(check: str, ok: Column, detail: Column, table: Column) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        table.alias("table"),
        F.coalesce(ok, F.lit(False)).alias("ok"),
        F.coalesce(detail, F.lit("")).alias("detail"),
    )


def _interval(low: str, high: str) -> Column:
    return F.concat(
        F.lit("["),
        F.round(low, 4).cast("decimal(12,4)").cast("string"),
        F.lit(", "),
        F.round(high, 4).cast("decimal(12,4)").cast("string"),
        F.lit("]"),
    )


def within_bounds(low: str, high: str, bounds: tuple[float, float]) -> Column:
    return (F.col(low) > bounds[0]) & (F.col(high) < bounds[1])


def row_results(table: Column) -> list[Column]:
    rows = F.concat(F.col("rows").cast("string"), F.lit(" rows"))
    return [_result("row_count", F.col("rows") > 0, rows, table)]


def srid_results(table: Column) -> list[Column]:
    detail = (
        F.when(F.col("geometries") == 0, "no geometry")
        .when(
            F.col("min_srid") == F.col("max_srid"), F.concat(F.lit("srid="), F.col("max_srid"))
        )
        .otherwise(F.concat(F.col("wrong_srid").cast("string"), F.lit(" rows of another srid")))
    )
    ok = (F.col("geometries") > 0) & (F.col("wrong_srid") == 0)
    return [_result("srid", ok, detail, table)]


def bounds_results(table: Column) -> list[Column]:
    detail = F.when(F.col("min_lon").isNull(), "no geometry").otherwise(
        F.concat(
            F.lit("lon="),
            _interval("min_lon", "max_lon"),
            F.lit(", lat="),
            _interval("min_lat", "max_lat"),
        )
    )
    return [
        _result("lon_range", within_bounds("min_lon", "max_lon", LON_BOUNDS), detail, table),
        _result("lat_range", within_bounds("min_lat", "max_lat", LAT_BOUNDS), detail, table),
    ]


def function_results(table: Column) -> list[Column]:
    # Check name -> the figure which has to be zero.
    checks = {
        "st_geometrytype": "no_type",
        "st_npoints": "no_points",
        "st_area": "no_area",
        "st_centroid": "no_centroid",
        "st_isvalid": "not_valid",
        "st_asgeojson": "no_geojson",
    }
    return [
        _result(
            name,
            (F.col("geometries") > 0) & (F.col(figure) == 0),
            F.when(F.col("geometries") == 0, "no geometry").otherwise(
                F.concat(F.col(figure).cast("string"), F.lit(" rows fail"))
            ),
            table,
        )
        for name, figure in checks.items()
    ]


def has_geometry_column(schema: T.StructType) -> bool:
    return GEOMETRY_COLUMN in schema.names


def type_result(schema: T.StructType, table: Column) -> Column:
    """The geometry column is there and is the geometry struct."""
    if not has_geometry_column(schema):
        return _result("geometry_type", F.lit(False), F.lit("not found"), table)
    kind = schema[GEOMETRY_COLUMN].dataType
    is_geometry = kind.simpleString() in (GEOMETRY_TYPE.simpleString(), GEOMETRY_Z_TYPE.simpleString())
    detail = "type=geometry" if is_geometry else f"type={kind.simpleString()}"
    return _result("geometry_type", F.lit(is_geometry), F.lit(detail), table)


def check_frame(df: DataFrame, name: str, spatial: bool = True) -> DataFrame:
    """All checks of one table, from one aggregation over it.

    ``spatial=False`` is for a layer known to have no geometry.
    """
    table = F.lit(name)
    figures, results = row_figures(), row_results(table)
    if spatial:
        results.append(type_result(df.schema, table))
        if has_geometry_column(df.schema) and isinstance(
            df.schema[GEOMETRY_COLUMN].dataType, T.StructType
        ):
            df = with_validity(df)
            figures += srid_figures() + bounds_figures() + function_figures()
            results += srid_results(table) + bounds_results(table) + function_results(table)
    return df.agg(*figures).select(F.inline(F.array(*results)))


def check_twin(base: DataFrame, twin: DataFrame, name: str, key: str = FEATURE_KEY) -> DataFrame:
    """The twin is not larger than its base, and repeats no key."""
    zero = F.lit(0).cast("long")
    held = twin.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    counted = base.agg(F.count(F.lit(1)).alias("before")).select("before", zero.alias("n"))
    both = counted.unionByName(held.select(zero.alias("before"), "n")).agg(
        F.sum("before").alias("before"),
        F.sum("n").alias("after"),
        F.count_if(F.col("n") > 1).alias("repeats"),
    )
    sizes = F.concat(
        F.col("before").cast("string"), F.lit(" -> "), F.col("after").cast("string")
    )
    repeats = F.concat(F.col("repeats").cast("string"), F.lit(" keys repeat"))
    return both.select(
        F.inline(
            F.array(
                _result("dedup_size", F.col("after") <= F.col("before"), sizes, F.lit(name)),
                _result("dedup_keys", F.col("repeats") == 0, repeats, F.lit(name)),
            )
        )
    )


# -- the whole suite -------------------------------------------------------


@dataclass(frozen=True)
class Suite:
    """The tables of one schema that share a prefix."""

    schema: str
    catalog: str = ""
    table_prefix: str = TABLE_PREFIX
    suffix: str = DEDUP_SUFFIX
    key: str = FEATURE_KEY

    def full_name(self, table: str) -> str:
        return ".".join(part for part in (self.catalog, self.schema, table) if part)


def is_spatial(table: str, prefix: str, suffix: str = DEDUP_SUFFIX) -> bool:
    """False only for layers the dictionary knows to be links."""
    layer = table.removeprefix(prefix).removesuffix(suffix)
    return not (layer in layer_titles() and layer in LAYERS_WITHOUT_GEOMETRY)


def validate_tables(
    spark: SparkSession, suite: Suite, concurrent: int = CONCURRENT_CHECKS
) -> DataFrame:
    """Results of every check on every table with the prefix.

    Each table, and each pair of a table and its twin, is a small job of its own;
    ``concurrent`` run at a time, and only their few results come to the driver.

    Without any table there is one failed result and nothing else.
    """
    names = tables_with_prefix(spark, suite.catalog, suite.schema, suite.table_prefix)
    if not names:
        detail = f"no table starts with {suite.table_prefix} in {suite.schema}"
        return spark.createDataFrame([("tables", suite.schema, False, detail)], RESULT)
    frames = {name: spark.table(quoted(suite.full_name(name))) for name in names}
    results = [
        check_frame(df, name, is_spatial(name, suite.table_prefix, suite.suffix))
        for name, df in frames.items()
    ]
    for name, df in frames.items():
        base = name.removesuffix(suite.suffix)
        if base != name and base in frames and suite.key in df.columns:
            results.append(check_twin(frames[base], df, name, suite.key))
    with ThreadPoolExecutor(concurrent) as pool:
        found = [pool.submit(inheritable_thread_target(spark)(df.collect)) for df in results]
        rows = [tuple(row) for job in found for row in job.result()]
    return spark.createDataFrame(rows, RESULT)


def require_passed(report: DataFrame) -> None:
    """Raise with the failed checks, if there are any.

    The report has a handful of rows per table.
    """
    failed = report.filter(~F.col("ok")).orderBy("table", "check").collect()
    if failed:
        lines = [f"{r['check']} {r['table']}: {r['detail']}" for r in failed]
        raise ValidationFailed(f"{len(failed)} check(s) failed:\n" + "\n".join(lines))
