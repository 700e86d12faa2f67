"""Catalog tables of layers: create, replace a department, evolve, describe.

Tables are Parquet, partitioned by ``dept``, so a reload rewrites whole
partitions: one dynamic-overwrite commit instead of a delete and an append.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.dictionary import column_descriptions, extent_descriptions, table_description
from mapstrata.functions.geometry import (
    GEOMETRY_TYPE,
    GEOMETRY_Z_TYPE,
    has_heights,
    st_force_2d,
    st_force_3d,
)
from mapstrata.settings import DEDUP_SUFFIX, TARGET_SRID, VERSION

logger = logging.getLogger(__name__)

PARTITION_COLUMN = "dept"
# The properties a table carries.
CRS_PROPERTY = "crs"
VERSION_PROPERTY = "bdtopo_version"
EDITION_PROPERTY = "bdtopo_version_date"
OVERWRITE_MODE = "spark.sql.sources.partitionOverwriteMode"
ENGINE_PROPERTY_PREFIXES = ("delta.", "option.")
#: Prefix of the properties that hold commits which are not carried out in full.
PENDING = "mapstrata.pending."


def quoted(name: str) -> str:
    """A dotted name with every part in back-quotes."""
    return ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in name.split("."))


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def full_table_name(catalog: str, schema: str, table_prefix: str, layer: str) -> str:
    """``catalog.schema.prefix+layer``; without the catalog when it is empty."""
    return ".".join(part for part in (catalog, schema, table_prefix + layer) if part)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION {literal(location)}" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {quoted(name)}{where}")


def table_exists(spark: SparkSession, table: str) -> bool:
    return spark.catalog.tableExists(quoted(table))


def ensure_table(
    spark: SparkSession,
    table: str,
    schema: T.StructType,
    layer: str,
    version: str = VERSION,
    version_date: str = "",
    srid: int = TARGET_SRID,
    lang: str = "en",
) -> None:
    """Create the table with its comments and properties unless it exists.

    A text ``geometry`` field becomes the planar geometry struct.  Columns without
    an entry in the dictionary get no comment, only a warning in the log.
    """
    texts = {**extent_descriptions(lang), **column_descriptions(layer, lang)}
    lines, plain = [], []
    for f in schema.fields:
        planar = f.name == "geometry" and not has_heights(f.dataType)
        kind = GEOMETRY_TYPE if planar else f.dataType
        line = f"{quoted(f.name)} {kind.simpleString()}"
        if f.name in texts:
            line += f" COMMENT {literal(texts[f.name])}"
        else:
            plain.append(f.name)
        lines.append(line)
    if plain:
        logger.warning("no description for columns %s of layer %s", ", ".join(plain), layer)
    properties = {CRS_PROPERTY: f"EPSG:{srid}"}
    if version:
        properties[VERSION_PROPERTY] = version
    if version_date:
        properties[EDITION_PROPERTY] = version_date
    pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in properties.items())
    parts = f"PARTITIONED BY ({PARTITION_COLUMN}) " if PARTITION_COLUMN in schema.names else ""
    comment = literal(table_description(layer, version, version_date, lang))
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {quoted(table)} ({', '.join(lines)}) USING parquet "
        f"{parts}COMMENT {comment} TBLPROPERTIES ({pairs})"
    )


# --------------------------------------------------------------------------
# Rows


def delete_department(spark: SparkSession, table: str, dept: str) -> None:
    """Drop a department's rows; nothing happens when table or rows are absent."""
    if table_exists(spark, table):
        spark.sql(
            f"ALTER TABLE {quoted(table)} DROP IF EXISTS "
            f"PARTITION ({PARTITION_COLUMN} = {literal(dept)})"
        )


def held_departments(spark: SparkSession, table: str) -> set[str]:
    """Departments a table has partitions for, from the catalog."""
    rows = spark.sql(f"SHOW PARTITIONS {quoted(table)}").collect()
    return {row["partition"].split("=", 1)[1] for row in rows}


def set_data_schema(spark: SparkSession, table: str, schema: T.StructType) -> None:
    """Give a catalog table other types for its columns.

    Files stay as they are, so these must read as the new types: a struct may
    gain fields, which are NULL in older files.  No SQL statement does this for
    tables of the session catalog.
    """
    partitions = {r["col_name"] for r in _partition_columns(spark, table)}
    data = T.StructType([f for f in schema.fields if f.name not in partitions])
    catalog = spark._jsparkSession.sessionState().catalog()
    kind = spark._jvm.org.apache.spark.sql.types.DataType.fromJson(data.json())
    catalog.alterTableDataSchema(catalog_name(spark, table), kind)
    spark.catalog.refreshTable(quoted(table))


def catalog_name(spark: SparkSession, table: str):
    """The table's name as the session catalog takes it."""
    parts = [p.strip("`") for p in table.split(".")][-2:]
    java = spark._jvm
    schema = java.scala.Option.apply(parts[0] if len(parts) > 1 else None)
    return java.org.apache.spark.sql.catalyst.TableIdentifier(parts[-1], schema)


def _partition_columns(spark: SparkSession, table: str) -> list:
    rows = spark.sql(f"DESCRIBE TABLE {quoted(table)}").collect()
    marks = [i for i, r in enumerate(rows) if r["col_name"] == "# col_name"]
    return rows[marks[0] + 1 :] if marks else []


def add_heights(spark: SparkSession, table: str, column: str = "geometry") -> bool:
    """Let the geometries of a stored planar table have heights.

    Rows that are there read as planar; no file is rewritten.  Tells if the table changed.
    """
    schema = spark.table(quoted(table)).schema
    if column not in schema.names or has_heights(schema[column].dataType):
        return False
    fields = [
        T.StructField(f.name, GEOMETRY_Z_TYPE if f.name == column else f.dataType, f.nullable, f.metadata)
        for f in schema.fields
    ]
    set_data_schema(spark, table, T.StructType(fields))
    return True


def create_like(spark: SparkSession, source: str, table: str) -> None:
    """Create a table with the columns and descriptions of another one, without its rows."""
    schema = spark.table(quoted(source)).schema
    texts = table_metadata(spark, source).columns
    comments = {name: f" COMMENT {literal(text)}" for name, text in texts.items()}
    lines = ", ".join(
        f"{quoted(f.name)} {f.dataType.simpleString()}{comments.get(f.name, '')}" for f in schema.fields
    )
    parts = f" PARTITIONED BY ({PARTITION_COLUMN})" if PARTITION_COLUMN in schema.names else ""
    spark.sql(f"CREATE TABLE {quoted(table)} ({lines}) USING parquet{parts}")
    apply_table_metadata(spark, table, table_metadata(spark, source))


def add_missing_columns(df: DataFrame, table: str) -> list[str]:
    """Add the columns of ``df`` which the table lacks; returns their names.

    Geometries with heights change the type of a planar table's geometry.
    """
    spark = df.sparkSession
    for f in df.schema.fields:
        if has_heights(f.dataType):
            add_heights(spark, table, f.name)
    known = {name.lower() for name in spark.table(quoted(table)).columns}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(f"{quoted(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {quoted(table)} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def in_table_order(
    df: DataFrame,
    table: str,
    more: Iterable[str] = (),
    changes: Mapping[str, T.DataType] | None = None,
) -> DataFrame:
    """The table's columns in its order, NULL for those ``df`` lacks; then ``more``.

    ``changes`` are types to use instead of the table's.
    """
    have = {name.lower(): name for name in df.columns}
    columns: list[Column] = []
    for f in df.sparkSession.table(quoted(table)).schema.fields:
        source = have.get(f.name.lower())
        value = F.col(f"`{source}`") if source else F.lit(None)
        if source and has_heights(f.dataType) != has_heights(df.schema[source].dataType):
            value = st_force_3d(value) if has_heights(f.dataType) else st_force_2d(value)
        kind = (changes or {}).get(f.name, f.dataType)
        columns.append(value.cast(kind).alias(f.name))
    return df.select(*columns, *more)


def append(df: DataFrame, table: str) -> None:
    """Append rows in one write, adding new columns to the table first.

    A missing table is created, partitioned when the rows carry ``dept``.
    """
    spark = df.sparkSession
    if not table_exists(spark, table):
        writer = df.write.format("parquet")
        if PARTITION_COLUMN in df.columns:
            writer = writer.partitionBy(PARTITION_COLUMN)
        writer.saveAsTable(quoted(table))
        return
    add_missing_columns(df, table)
    in_table_order(df, table).write.insertInto(quoted(table))


_overwrites: dict[str, tuple[int, str]] = {}  # per session: open writes, mode before them
_overwrites_lock = threading.Lock()


@contextmanager
def dynamic_overwrite(spark: SparkSession) -> Iterator[None]:
    """Overwrites replace only the partitions they write.

    A write to a catalog table takes this from the setting of its session only,
    so it is set there as long as any such write of that session runs and put
    back after the last.  It is read back, as any other mode would replace the
    whole table.
    """
    session = spark._jsparkSession.sessionUUID()
    with _overwrites_lock:
        running, before = _overwrites.get(session, (0, spark.conf.get(OVERWRITE_MODE)))
        _overwrites[session] = running + 1, before
        spark.conf.set(OVERWRITE_MODE, "dynamic")
    try:
        if spark.conf.get(OVERWRITE_MODE).lower() != "dynamic":
            raise RuntimeError("the session does not overwrite partitions one by one")
        yield
    finally:
        with _overwrites_lock:
            running, before = _overwrites.pop(session)
            if running > 1:
                _overwrites[session] = running - 1, before
            else:
                spark.conf.set(OVERWRITE_MODE, before)


@dataclass
class Replaced:
    """What one replacement wrote."""

    rows: int
    rows_by_dept: dict[str, int] = field(default_factory=dict)


def replace_departments(
    df: DataFrame, table: str, departments: Iterable[str], rebalance: bool = False
) -> Replaced:
    """Replace all rows of the named departments by ``df`` in one commit; see ``commits``."""
    from mapstrata.operators import commits  # which builds on this module

    return commits.replace_departments(df, table, departments, rebalance)


# --------------------------------------------------------------------------
# Descriptions


@dataclass
class TableMetadata:
    properties: dict[str, str] = field(default_factory=dict)
    comment: str = ""
    columns: dict[str, str] = field(default_factory=dict)


def keep_property(key: Column) -> Column:
    """Not a setting of the storage engine, nor a commit under way."""
    kept = F.lit(True)
    for prefix in (*ENGINE_PROPERTY_PREFIXES, PENDING):
        kept = kept & ~key.startswith(prefix)
    return kept


def table_metadata(spark: SparkSession, table: str) -> TableMetadata:
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").filter(keep_property(F.col("key")))
    properties = {row["key"]: row["value"] for row in rows.collect()}
    properties.pop("comment", None)
    entry = spark.catalog.getTable(quoted(table))
    columns = {
        f.name: f.metadata["comment"]
        for f in spark.table(quoted(table)).schema.fields
        if f.metadata.get("comment")
    }
    return TableMetadata(properties, entry.description or "", columns)


def apply_table_metadata(spark: SparkSession, table: str, metadata: TableMetadata) -> None:
    """Set properties, comment and column comments; empty parts are skipped."""
    name = quoted(table)
    if metadata.properties:
        pairs = ", ".join(f"{literal(k)} = {literal(v)}" for k, v in metadata.properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")
    if metadata.comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {literal(metadata.comment)}")
    present = _column_comments(spark, table)
    for column, comment in metadata.columns.items():
        if present.get(column, comment) != comment:
            spark.sql(
                f"ALTER TABLE {name} ALTER COLUMN {quoted(column)} COMMENT {literal(comment)}"
            )


def _column_comments(spark: SparkSession, table: str) -> Mapping[str, str]:
    """Comment of every column, empty where it has none."""
    fields = spark.table(quoted(table)).schema.fields
    return {f.name: f.metadata.get("comment", "") for f in fields}


def is_source_table(name: Column, prefix: str, suffix: str) -> Column:
    return name.startswith(prefix) & ~name.endswith(suffix)


def tables_with_prefix(
    spark: SparkSession, catalog: str, schema: str, prefix: str
) -> list[str]:
    """Names in the schema which start with the prefix, sorted."""
    where = quoted(".".join(part for part in (catalog, schema) if part))
    listing = spark.sql(f"SHOW TABLES IN {where}").filter(
        F.col("tableName").startswith(prefix) & ~F.col("isTemporary")
    )
    return sorted(row["tableName"] for row in listing.collect())


def list_source_tables(
    spark: SparkSession, catalog: str, schema: str, prefix: str, suffix: str = DEDUP_SUFFIX
) -> list[str]:
    """Tables with the prefix which are no dedup twins, sorted."""
    where = quoted(".".join(part for part in (catalog, schema) if part))
    listing = spark.sql(f"SHOW TABLES IN {where}").filter(
        is_source_table(F.col("tableName"), prefix, suffix) & ~F.col("isTemporary")
    )
    return sorted(row["tableName"] for row in listing.collect())
