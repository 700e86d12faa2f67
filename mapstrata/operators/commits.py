"""Replacing departments of a table, or all of it, in one commit.

New rows are written to a folder of their own below the table, where no reader
looks.  One property of the table then tells what takes whose place: that single catalog
change is the commit.  What follows from it, pointing partitions at
the new folders and dropping the emptied ones, can be done again any number of
times, by this run or, if it is killed, by the next one that writes to the table.
A department thus has its old rows or its new ones at any moment, never none.
Folders of a run that was killed before its commit are swept away later.

A table without departments is pointed at its new folder, which is one change anyway.
"""

from __future__ import annotations

import json
import logging
import time
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.functions.casts import to_date_or_null, to_timestamp_or_null
from mapstrata.functions.geometry import has_heights
from mapstrata.operators.tables import (
    PARTITION_COLUMN,
    PENDING,
    Replaced,
    add_missing_columns,
    catalog_name,
    held_departments,
    in_table_order,
    literal,
    quoted,
    set_data_schema,
)

logger = logging.getLogger(__name__)

RUN = "run-"
#: Fixed value: what stands for a department that is NULL in folder names and listings.
NO_DEPARTMENT = "__HIVE_DEFAULT_PARTITION__"


@dataclass
class Staged:
    """Rows written beside a table: their folder, and how many each department has."""

    run: str
    folder: str
    rows: int = 0
    rows_by_dept: dict[str, int] = field(default_factory=dict)


def table_location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted(table)}").filter("col_name = 'Location'")
    return rows.collect()[-1]["data_type"].rstrip("/")


def _root(spark: SparkSession, table: str) -> str:
    """The table's folder; a table without departments lies in one of its runs."""
    parent, _, name = (location := table_location(spark, table)).rpartition("/")
    return parent if name.startswith(RUN) else location


def is_partitioned(spark: SparkSession, table: str) -> bool:
    return PARTITION_COLUMN in spark.table(quoted(table)).columns


#: Types of numbers from narrow to wide, and those that read files of a narrower one as they are.
NUMBERS = (T.IntegerType(), T.LongType(), T.DoubleType())
READS = {(T.IntegerType(), T.LongType()), (T.IntegerType(), T.DoubleType())}
DATES = (T.DateType(), T.TimestampType())


def wider(held: T.DataType, given: T.DataType) -> T.DataType:
    """The type of a column that a table holds as one type and a new edition gives as another.

    Numbers take the wider type, a date next to a stamp becomes a stamp, texts next to dates become
    dates as far as they can be read, and all else becomes text.
    """
    if held == given or has_heights(held) or has_heights(given):
        return held
    for family in (NUMBERS, DATES):
        if held in family and given in family:
            return max(held, given, key=family.index)
    pair = {held, given} - {T.StringType()}
    if len(pair) == 1 and pair <= set(DATES):
        return pair.pop()
    atomic = isinstance(held, T.AtomicType) and isinstance(given, T.AtomicType)
    return T.StringType() if atomic else held


def widenings(spark: SparkSession, schema: T.StructType, table: str) -> dict[str, T.DataType]:
    """The columns of a table that take another type with rows of ``schema``."""
    given = {f.name.lower(): f.dataType for f in schema.fields}
    found = {}
    for f in spark.table(quoted(table)).schema.fields:
        kind = wider(f.dataType, given.get(f.name.lower(), f.dataType))
        if f.name != PARTITION_COLUMN and kind != f.dataType:
            found[f.name] = kind
    return found


def _as(value: Column, held: T.DataType, kind: T.DataType) -> Column:
    if held == T.StringType() and kind in DATES:
        return (to_date_or_null if kind == T.DateType() else to_timestamp_or_null)(value)
    return value.cast(kind)


def _recast(df: DataFrame, changes: dict[str, T.DataType]) -> DataFrame:
    kinds = {name.lower(): kind for name, kind in changes.items()}
    columns = []
    for f in df.schema.fields:
        kind = kinds.get(f.name.lower(), f.dataType)
        value = F.col(f"`{f.name}`")
        columns.append((value if kind == f.dataType else _as(value, f.dataType, kind)).alias(f.name))
    return df.select(*columns)


def _rewritten(spark: SparkSession, table: str, changes: dict[str, T.DataType], departments: list[str]) -> DataFrame | None:
    """Rows of the departments that stay, in their new types; None if their files read as these."""
    held = spark.table(quoted(table))
    if all((held.schema[name].dataType, kind) in READS for name, kind in changes.items()):
        return None
    stays = F.col(PARTITION_COLUMN).isNull() | ~F.col(PARTITION_COLUMN).isin(departments)
    return _recast(held.filter(stays), changes)


def stage(
    df: DataFrame,
    table: str,
    rebalance: bool = False,
    notes: tuple[str, ...] = (),
    changes: dict[str, T.DataType] | None = None,
) -> Staged:
    """Write rows beside the table, in its columns, adding those it lacks.

    ``changes`` are columns that have another type in the files than the table has now.

    ``notes`` are columns for the files only: the table does not know them and its readers skip
    them, but ``staged_notes`` reads them from the same files.
    """
    spark = df.sparkSession
    add_missing_columns(df.drop(*notes), table)
    rows = in_table_order(df, table, notes, changes)
    run = uuid.uuid4().hex[:12]
    staged = Staged(run, f"{_root(spark, table)}/{RUN}{run}")
    dept = F.col(PARTITION_COLUMN)
    if not is_partitioned(spark, table):
        rows.write.parquet(staged.folder)
        staged.rows = spark.read.schema(rows.schema).parquet(staged.folder).count()
        return staged
    if rebalance:
        rows = rows.hint("rebalance", dept)
    seen = Observation()
    # One entry per department: as many as the table gets partitions.
    observed = rows.observe(seen, F.collect_set(F.coalesce(dept, F.lit(NO_DEPARTMENT))).alias("departments"))
    observed.write.partitionBy(PARTITION_COLUMN).parquet(staged.folder)
    written = sorted(seen.get["departments"])
    if written:
        # Counts come from the footers of the files.
        counts = spark.read.schema(rows.schema).parquet(staged.folder).groupBy(dept).agg(F.count("*").alias("n"))
        staged.rows_by_dept = {r[PARTITION_COLUMN] or NO_DEPARTMENT: r["n"] for r in counts.collect()}
    staged.rows = sum(staged.rows_by_dept.values())
    return staged


def staged_notes(spark: SparkSession, staged: Staged, schema: str) -> DataFrame:
    """Staged rows in the columns of ``schema`` alone, notes among them."""
    return spark.read.schema(schema).parquet(staged.folder)


def announce(
    spark: SparkSession,
    table: str,
    staged: Staged,
    emptied: list[str],
    changes: dict[str, T.DataType] | None = None,
) -> None:
    """The commit: from here on the staged rows are the table's."""
    if not is_partitioned(spark, table):
        spark.sql(f"ALTER TABLE {quoted(table)} SET LOCATION {literal(staged.folder)}")
        return
    entry = {
        "at": time.time(), "folder": staged.folder, "put": sorted(staged.rows_by_dept), "drop": sorted(emptied)
    }
    if changes:
        entry["types"] = {name: kind.simpleString() for name, kind in changes.items()}
    text = literal(json.dumps(entry))
    spark.sql(f"ALTER TABLE {quoted(table)} SET TBLPROPERTIES ({literal(PENDING + staged.run)} = {text})")


def pending(spark: SparkSession, table: str) -> dict[str, dict]:
    """Commits that are not carried out in full, oldest first."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {quoted(table)}").filter(F.col("key").startswith(PENDING)).collect()
    found = {r["key"].removeprefix(PENDING): json.loads(r["value"]) for r in rows}
    return dict(sorted(found.items(), key=lambda item: item[1]["at"]))


def _partition(dept: str) -> str:
    return f"PARTITION ({PARTITION_COLUMN} = {'NULL' if dept == NO_DEPARTMENT else literal(dept)})"


def carry_out(spark: SparkSession, table: str, run: str, entry: dict) -> None:
    """Point partitions at a commit's folders, drop the emptied ones, forget the commit."""
    name = quoted(table)
    if entry.get("types"):
        kinds = {n: T._parse_datatype_string(k) for n, k in entry["types"].items()}
        fields = spark.table(name).schema.fields
        fields = [T.StructField(f.name, kinds.get(f.name, f.dataType), f.nullable, f.metadata) for f in fields]
        set_data_schema(spark, table, T.StructType(fields))
    held = held_departments(spark, table)
    places = {dept: f"{entry['folder']}/{PARTITION_COLUMN}={dept}" for dept in entry["put"]}
    for dept in entry["put"]:
        if dept in held:
            spark.sql(f"ALTER TABLE {name} {_partition(dept)} SET LOCATION {literal(places[dept])}")
    new = " ".join(f"{_partition(d)} LOCATION {literal(p)}" for d, p in places.items() if d not in held)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {new}")
    gone = ", ".join(_partition(dept) for dept in entry["drop"] if dept in held)
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {gone}")
    spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({literal(PENDING + run)})")
    spark.catalog.refreshTable(name)


def recover(spark: SparkSession, table: str) -> list[str]:
    """Carry out what this run or an interrupted one has committed; the runs that are finished by it."""
    found = pending(spark, table)
    for run, entry in found.items():
        logger.info("table %s: carrying out the commit of run %s", table, run)
        carry_out(spark, table, run, entry)
    return list(found)


def _places(spark: SparkSession, table: str) -> set[str]:
    """The folders that the table's rows lie in."""
    if not is_partitioned(spark, table):
        return {table_location(spark, table)}
    catalog = spark._jsparkSession.sessionState().catalog()
    listed = catalog.listPartitions(catalog_name(spark, table), spark._jvm.scala.Option.empty())
    return {listed.apply(i).location().toString().rstrip("/") for i in range(listed.size())}


def _plain(path: str) -> str:
    return path.removeprefix("file:").replace("//", "/") if path.startswith(("file:", "/")) else path


def delete(spark: SparkSession, folders: set[str]) -> None:
    """Delete folders or files with all that is in them."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def publish(
    spark: SparkSession,
    table: str,
    staged: Staged,
    emptied: list[str] = (),
    changes: dict[str, T.DataType] | None = None,
) -> None:
    """Commit staged rows and carry the commit out; then delete the files they replaced."""
    before = _places(spark, table)
    announce(spark, table, staged, list(emptied), changes)
    recover(spark, table)
    spark.catalog.refreshTable(quoted(table))
    after, root = {_plain(p) for p in _places(spark, table)}, _plain(_root(spark, table))
    left = {p for p in before if _plain(p) not in after}
    # A table without departments has its first files in the folder that holds its runs.
    old = {p for p in left if _plain(p) != root}
    delete(spark, old if len(old) == len(left) else old | _files(spark, table))


def _files(spark: SparkSession, table: str) -> set[str]:
    """Files that lie in the table's folder itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark, table))
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return {str(s.getPath().toString()) for s in listed if s.isFile()}


def sweep(spark: SparkSession, table: str, hours: float = 24) -> list[str]:
    """Delete folders of runs that never came to their commit, or whose rows were replaced.

    Younger ones than ``hours`` may belong to a run that is still writing and stay.
    """
    recover(spark, table)
    path = spark._jvm.org.apache.hadoop.fs.Path(_root(spark, table))
    listed = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    used = {_plain(p) for p in _places(spark, table)}
    limit = (time.time() - hours * 3600) * 1000
    left = []
    for status in listed:
        folder = status.getPath().toString()
        mine = status.isDirectory() and status.getPath().getName().startswith(RUN)
        in_use = any(u == _plain(folder) or u.startswith(_plain(folder) + "/") for u in used)
        if mine and not in_use and status.getModificationTime() <= limit:
            left.append(folder)
    delete(spark, set(left))
    return left


def replace_departments(
    df: DataFrame, table: str, departments, rebalance: bool = False, notes: tuple[str, ...] = (), on_staged=None
) -> Replaced:
    """Replace all rows of the named departments by ``df`` in one commit, and count them.

    Departments that turn out to have no rows are dropped by the same commit.
    ``df`` must not read ``table``, and its rows should be of the named departments only.

    ``rebalance`` shuffles by department first, splitting large departments
    and merging small ones; a scan whose tasks each hold one department does
    not need it.  ``notes`` are columns for ``on_staged``, which is called with the
    staged rows before their commit.

    A column that comes with a wider type than the table has (see ``wider``) changes the
    table's: the same commit switches to it, together with the departments that stay, rewritten
    where their files do not read as the new type.  In the moment between that
    and the first of its partitions a reader may fail, and reads all again.
    """
    spark = df.sparkSession
    recover(spark, table)
    departments = list(dict.fromkeys(departments))
    changes = widenings(spark, df.schema, table)
    if changes:
        df = _recast(df, changes)
        old = _rewritten(spark, table, changes, departments)
        if old is not None:
            df, rebalance = df.unionByName(old, allowMissingColumns=True), True
    staged = stage(df, table, rebalance, notes, changes)
    if on_staged is not None and staged.rows:
        on_staged(staged)
    held = held_departments(spark, table)
    emptied = [d for d in departments if d in held and d not in staged.rows_by_dept]
    publish(spark, table, staged, emptied, changes)
    mine = set(departments) if changes else {*departments, *staged.rows_by_dept}
    counts = dict.fromkeys(departments, 0) | {d: n for d, n in staged.rows_by_dept.items() if d in mine}
    return Replaced(sum(counts.values()), counts)


def replace_all(df: DataFrame, table: str, rebalance: bool = False) -> int:
    """Replace all rows of a table by ``df`` in one commit; the number of rows."""
    spark = df.sparkSession
    partitioned = is_partitioned(spark, table)
    if partitioned:
        recover(spark, table)
    staged = stage(df, table, rebalance)
    emptied = sorted(held_departments(spark, table) - set(staged.rows_by_dept)) if partitioned else []
    publish(spark, table, staged, emptied)
    return staged.rows
