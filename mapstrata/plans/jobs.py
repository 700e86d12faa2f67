"""The three jobs: load layers, deduplicate tables, validate tables."""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field

import pandas as pd
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.casts import ingestion_schema
from mapstrata.functions.geometry import GEOMETRY_TYPE, GEOMETRY_Z_TYPE
from mapstrata.functions.projection import utm_zones
from mapstrata.functions.codes import department_code, requested_departments
from mapstrata.operators import dedup as dedup_operators
from mapstrata.operators import commits, tables
from mapstrata.operators.ingest import (
    LOSSES_COLUMN,
    LOSSES_TYPE,
    at_rest,
    bad_datetimes,
    date_like_columns,
    ingest,
    loss_rows,
    with_losses,
)
from mapstrata.operators.validate import Suite, require_passed, validate_tables
from mapstrata.settings import FEATURE_KEY, TARGET_SRID, LoadSettings
from mapstrata.sources import gpkg, register

logger = logging.getLogger(__name__)

METRICS_TABLE = "load_metrics"
LOSSES_TABLE = "load_losses"
REJECTS_TABLE = "load_rejects"
LOSSES_SCHEMA = "run string, layer string, dept string, column string, reason string, rows long"
REJECTS_SCHEMA = "run string, layer string, dept string, key string, column string, reason string, raw string"
METRICS_SCHEMA = (
    "run string, layer string, dept string, rows long, version string, version_date string"
)


_losses_turn = threading.Lock()


@dataclass
class LoadReport:
    run: str
    layers: dict[str, tables.Replaced] = field(default_factory=dict)
    unknown_layers: list[str] = field(default_factory=list)

    def rows(self) -> dict[str, int]:
        """Rows written per layer."""
        return {layer: replaced.rows for layer, replaced in self.layers.items()}


def parse_departments(spark: SparkSession, request: str) -> list[str]:
    """The department codes of a request with their ``D``, 96 at most."""
    codes = F.transform(requested_departments(F.lit(request)), department_code)
    return list(dict.fromkeys(spark.range(1).select(codes.alias("d")).first()["d"]))


def layer_listing(spark: SparkSession, path: str) -> DataFrame:
    """``(path, layer, kind, srid, crs, n_features)`` of all containers."""
    register(spark)
    return spark.read.format("gpkg").option("listing", "true").load(path)


def read_layer(
    spark: SparkSession, path: str, layer: str, schema: T.StructType | None = None, **options: object
) -> DataFrame:
    """One layer of all containers below ``path``, dates as text.

    A ``schema`` with fewer columns keeps the others from being read.
    """
    register(spark)
    reader = spark.read.format("gpkg").option("layer", layer)
    if spark.conf.get("spark.sql.python.filterPushdown.enabled", "false") == "true":
        reader = reader.option("pushdown", "true")
    for name, value in options.items():
        reader = reader.option(name, str(value))
    return (reader.schema(schema) if schema else reader).load(path)


def layer_index(spark: SparkSession, path: str, features_per_task: int) -> DataFrame:
    """The listing with all that planning needs: columns, keys, extents, and cuts of the ids.

    Each container is opened once, in a task.
    """
    register(spark)
    reader = spark.read.format("gpkg").option("listing", "true").option("index", "true")
    return reader.option("featuresPerTask", str(features_per_task)).load(path)


@dataclass
class Holders:
    """Who has a layer: departments by their container's path, and whether a
    container of no department tells it row by row in a ``dept`` column; and the
    rows of the index on their containers."""

    departments: set[str] = field(default_factory=set)
    by_row: bool = False
    index: list = field(default_factory=list)


def layer_holders(
    spark: SparkSession,
    path: str,
    wanted: set[str],
    required: bool,
    features_per_task: int = gpkg.FEATURES_PER_TASK,
) -> dict[str, Holders]:
    """The holders of each layer among the ``wanted`` departments, by one pass over the containers.

    With ``required``, each of these must have a container.  The driver gets one row
    per container and layer.
    """
    listed = layer_index(spark, path, features_per_task).collect()
    present = {gpkg.department_of(p) for p in gpkg.find_containers(path)}
    holders: dict[str, Holders] = {}
    unknown = set()
    for row in listed:
        dept = gpkg.department_of(row["path"])
        if dept is None:
            if "dept" not in {c["name"].lower() for c in row["columns"]}:
                unknown.add(row["path"])
                continue
            holder = holders.setdefault(row["layer"], Holders())
            holder.by_row = True
        elif dept in wanted:
            holder = holders.setdefault(row["layer"], Holders())
            holder.departments.add(dept)
        else:
            continue
        holder.index.append(row)
    if unknown:
        raise ValueError(f"no department in the path of {', '.join(sorted(unknown))}")
    missing = sorted(wanted - present)
    if required and missing and not any(h.by_row for h in holders.values()):
        raise LookupError(f"no container for {', '.join(missing)} at {path}")
    return holders


def load_layer(
    spark: SparkSession,
    path: str,
    layer: str,
    settings: LoadSettings,
    holders: Holders,
    wanted: set[str],
    run: str = "",
) -> tables.Replaced:
    """Replace the departments' rows of one layer in its table.

    Only departments whose container has the layer are replaced; containers of
    others are not opened and their rows stay.  A layer that is there without
    features empties its department.  All containers are scanned by one job: a task holds a range of one
    department's features, so rows go to the table without a shuffle.
    """
    name = tables.full_table_name(settings.catalog, settings.schema, settings.table_prefix, layer)
    extra = {"dept": T.StringType(), "layer": T.StringType()}
    departments = sorted(holders.departments)
    found = [gpkg.indexed_layer(row) for row in holders.index]
    schema = gpkg.with_extra(gpkg.merged_schema(found), extra)
    unknown_system = [c.path for c in found if c.geometry and c.srid == 0]
    if unknown_system:
        raise ValueError(f"layer {layer} has no EPSG code in {unknown_system[0]}")
    tables.ensure_table(
        spark,
        name,
        at_rest(schema, settings.altitudes),
        layer,
        settings.version,
        settings.version_date,
        settings.target_srid,
        settings.lang,
    )
    shape = GEOMETRY_Z_TYPE if settings.altitudes else GEOMETRY_TYPE
    rows = read_layer(
        spark,
        path,
        layer,
        gpkg.scanned(schema, shape, settings.losses),
        ranges=gpkg.ranges_option(holders.index),
        batchSize=settings.batch_size,
    )
    if holders.by_row:
        rows = rows.filter(F.col("dept").isin(sorted(wanted)))
    # Geometries carry their own reference system out of the scan.
    zones = any(container.srid in utm_zones() for container in found)
    if not settings.losses:
        typed = ingest(rows, schema, 0, settings.target_srid, zones=zones)
        return tables.replace_departments(typed, name, departments)
    typed = ingest(with_losses(rows, schema), schema, 0, settings.target_srid, zones=zones)

    def keep_losses(staged: commits.Staged) -> None:
        key = FEATURE_KEY if FEATURE_KEY in schema.names else None
        record_losses(spark, settings, run, layer, staged, key)

    return commits.replace_departments(
        typed, name, departments, notes=(LOSSES_COLUMN,), on_staged=keep_losses
    )


def record_losses(
    spark: SparkSession, settings: LoadSettings, run: str, layer: str, staged: commits.Staged, key: str | None
) -> None:
    """Keep the values a load could not read, and how many there are by department, column and reason.

    They come from a narrow column of the files the load has just written, so the
    containers are read once.  A row stays in its table, with NULL for such a value.
    """
    columns = [f"{key} string"] if key else []
    notes = commits.staged_notes(spark, staged, ", ".join([*columns, "dept string", f"{LOSSES_COLUMN} {LOSSES_TYPE}"]))
    found = loss_rows(notes, (F.col(key) if key else F.lit(None).cast("string")).alias("key"), "dept")
    rejects, losses = (
        tables.full_table_name(settings.catalog, settings.schema, "", n) for n in (REJECTS_TABLE, LOSSES_TABLE)
    )
    told = {"run": F.lit(run), "layer": F.lit(layer)}
    found = found.withColumns(told).select("run", "layer", "dept", "key", "column", "reason", "raw")
    counts = found.groupBy("run", "layer", "dept", "column", "reason").agg(F.count("*").alias("rows"))
    # Appends to one table share a temporary folder, so layers take turns.
    with _losses_turn:
        found.write.insertInto(tables.quoted(rejects))
        counts.coalesce(1).write.insertInto(tables.quoted(losses))


def record_metrics(spark: SparkSession, settings: LoadSettings, report: LoadReport) -> None:
    """Append a run's row counts per layer and department in one write."""
    rows = [
        (report.run, layer, dept, count, settings.version, settings.version_date)
        for layer, replaced in report.layers.items()
        for dept, count in replaced.rows_by_dept.items()
    ]
    name = tables.full_table_name(settings.catalog, settings.schema, "", METRICS_TABLE)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {tables.quoted(name)} ({METRICS_SCHEMA}) USING parquet")
    if rows:
        metrics = spark.createDataFrame(rows, METRICS_SCHEMA).coalesce(1)
        metrics.write.insertInto(tables.quoted(name))


def load(spark: SparkSession, path: str, settings: LoadSettings) -> LoadReport:
    """Load layers of the containers below ``path`` into their tables.

    ``all`` stands for those of the 96 departments that have a container.  Before anything
    is written, a container whose path names no department and whose layers have no
    ``dept`` column, and a requested department without a container are errors.  Rows of a department go only if
    its container has the layer.
    """
    request = settings.departments
    codes = set(parse_departments(spark, request))
    holders = layer_holders(spark, path, codes, request.strip().lower() != "all", settings.features_per_task)
    schema = ".".join(p for p in (settings.catalog, settings.schema) if p)
    tables.create_schema(spark, schema)
    for name, columns in ((REJECTS_TABLE, REJECTS_SCHEMA), (LOSSES_TABLE, LOSSES_SCHEMA)):
        table = tables.quoted(tables.full_table_name(settings.catalog, settings.schema, "", name))
        if settings.losses:
            spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")
    available = sorted(holders)
    wanted = settings.layers or available
    report = LoadReport(uuid.uuid4().hex[:12])
    report.unknown_layers = [name for name in wanted if name not in available]
    if report.unknown_layers:
        logger.warning("unknown layers: %s", ", ".join(report.unknown_layers))
    chosen = [name for name in dict.fromkeys(wanted) if name in available]

    def one(layer: str) -> tables.Replaced:
        return load_layer(spark, path, layer, settings, holders[layer], codes, report.run)

    # Layers are few and independent; several at a time keep executors busy
    # while a layer finishes its last tasks.
    with ThreadPoolExecutor(settings.concurrent_layers) as pool:
        jobs = {layer: pool.submit(inheritable_thread_target(spark)(one), layer) for layer in chosen}
        wait(jobs.values())
    failed = {layer: job.exception() for layer, job in jobs.items() if job.exception()}
    report.layers = {layer: job.result() for layer, job in jobs.items() if layer not in failed}
    # What the other layers wrote is on record before the first failure is told.
    record_metrics(spark, settings, report)
    for error in failed.values():
        raise error
    return report


def write_frame(
    spark: SparkSession,
    frame: DataFrame | pd.DataFrame,
    table: str,
    schema: T.StructType | None = None,
    source_srid: int = 0,
    target_srid: int = TARGET_SRID,
) -> None:
    """Ingest any frame, a local pandas one included, and append it to a table."""
    if isinstance(frame, pd.DataFrame):
        in_flight = ingestion_schema(schema)[0] if schema is not None else None
        frame = spark.createDataFrame(frame, schema=in_flight)
    tables.append(ingest(frame, schema, source_srid, target_srid), table)


def export_bad_datetimes(spark: SparkSession, path: str, layer: str, target: str) -> None:
    """Copy the rows of a layer with impossible seconds to containers of their
    own, for a closer look.  Date columns are those declared as such and text
    columns named like one."""
    rows = read_layer(spark, path, layer)
    _, casts = ingestion_schema(gpkg.layer_schema(path, layer))
    columns = list(dict.fromkeys([*casts, *date_like_columns(rows.schema)]))
    srid = gpkg.open_layers(path, layer)[0].srid
    bad = bad_datetimes(rows, columns).drop("bad_columns")
    writer = bad.write.format("gpkg").mode("append").option("layer", layer)
    writer.option("srid", srid).save(target)


def dedup(spark: SparkSession, settings: LoadSettings, **options: str):
    """Deduplicate every table of the schema; an error when there is none."""
    stats = dedup_operators.dedup_tables(
        spark, settings.schema, settings.catalog, settings.table_prefix, **options
    )
    if not stats:
        raise LookupError(f"no table starts with {settings.table_prefix} in {settings.schema}")
    return stats


def validate(spark: SparkSession, settings: LoadSettings, must_pass: bool = True) -> DataFrame:
    """The validation report; raises on a failed check unless told not to."""
    suite = Suite(settings.schema, settings.catalog, settings.table_prefix)
    report = validate_tables(spark, suite)
    if must_pass:
        require_passed(report)
    return report
