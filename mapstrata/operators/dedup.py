"""One row per feature key across overlapping departments."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mapstrata.operators import commits
from mapstrata.operators.tables import (
    PARTITION_COLUMN,
    apply_table_metadata,
    create_like,
    list_source_tables,
    quoted,
    table_exists,
    table_metadata,
)
from mapstrata.settings import DEDUP_SUFFIX, FEATURE_KEY, TABLE_PREFIX, shared_folder

logger = logging.getLogger(__name__)

NULL_KEY_POLICIES = ("collapse", "keep")
# Repeated keys are sent to every executor while their measured size, with
# this overhead for each, stays within the limit.
BROADCAST_BYTES = 64 << 20
KEY_OVERHEAD = 48
CONCURRENT_TABLES = 4


def _orderable(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.MapType, T.VariantType)):
        return False
    if isinstance(data_type, T.ArrayType):
        return _orderable(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return all(_orderable(f.dataType) for f in data_type.fields)
    return True


def keep_order(df: DataFrame, key: str) -> list[Column]:
    """Department first, then every other column, so that the choice among
    equal departments does not depend on where rows happen to lie."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in (key, PARTITION_COLUMN) and _orderable(f.dataType)
    ]
    names = [PARTITION_COLUMN] * (PARTITION_COLUMN in df.columns) + rest
    return [F.col(f"`{n}`").asc_nulls_first() for n in names]


def dedup(df: DataFrame, key: str = FEATURE_KEY, null_key: str = "collapse") -> DataFrame:
    """Keep the first row of each key by department.

    Rows without a key count as one group unless ``null_key="keep"``.  Spark
    prunes to one row per key before the shuffle as well as after it, so a
    key with very many rows costs one row per map task.
    """
    if null_key not in NULL_KEY_POLICIES:
        raise ValueError(f"null_key must be one of {NULL_KEY_POLICIES}")
    keyed = df if null_key == "collapse" else df.filter(F.col(f"`{key}`").isNotNull())
    window = Window.partitionBy(F.col(f"`{key}`")).orderBy(*keep_order(df, key))
    first = keyed.withColumn("rn", F.row_number().over(window)).filter("rn = 1").drop("rn")
    if null_key == "keep":
        return first.unionByName(df.filter(F.col(f"`{key}`").isNull()))
    return first


@dataclass
class DedupStats:
    before: int
    after: int
    repeated_keys: int = 0
    repeated_bytes: int = 0
    without_key: int = 0

    @property
    def removed(self) -> int:
        return self.before - self.after


def key_counts(df: DataFrame, key: str = FEATURE_KEY) -> DataFrame:
    """``(key, n)``: reads the key column only and counts before shuffling."""
    return df.groupBy(F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))


def stats_columns() -> list[Column]:
    """Aggregates over ``key_counts`` for the collapse policy."""
    repeated = (F.col("n") > 1) & F.col("key").isNotNull()
    size = F.octet_length(F.col("key").cast("string")) + KEY_OVERHEAD
    return [
        F.coalesce(F.sum("n"), F.lit(0)).alias("before"),
        F.count(F.lit(1)).alias("after"),
        F.count_if(repeated).alias("repeated_keys"),
        F.coalesce(F.sum(F.when(repeated, size.cast("long"))), F.lit(0)).alias("repeated_bytes"),
        F.coalesce(F.sum(F.when(F.col("key").isNull(), F.col("n"))), F.lit(0)).alias("without_key"),
    ]


def dedup_by_repeats(
    df: DataFrame,
    repeats: DataFrame,
    key: str = FEATURE_KEY,
    broadcast: bool = False,
    null_key: str = "collapse",
) -> DataFrame:
    """``dedup`` when most keys occur once.

    ``repeats`` holds the non-null keys with several rows, in a column named
    ``key``.  Only their rows go through the window; all others pass straight
    from the scan to the writer, so wide geometry rows are not shuffled, at
    the price of a second scan.
    ``broadcast`` says that the caller has checked the size of ``repeats``.
    """
    if broadcast:
        repeats = F.broadcast(repeats)
    column = F.col(f"`{key}`")
    marked = df.join(
        repeats.select(F.col("key").alias("_key"), F.lit(True).alias("_repeated")),
        column == F.col("_key"),
        "left",
    ).drop("_key")
    several = F.col("_repeated").isNotNull()
    if null_key == "collapse":
        several = several | column.isNull()
    once = marked.filter(~several).drop("_repeated")
    first = dedup(marked.filter(several).drop("_repeated"), key)
    if PARTITION_COLUMN in df.columns:
        # The rows that were shuffled by key would go to every department's
        # folder from every task.
        first = first.hint("rebalance", F.col(PARTITION_COLUMN))
    return once.unionByName(first)


def dedup_table(
    spark: SparkSession, src: str, dst: str, key: str = FEATURE_KEY, null_key: str = "collapse"
) -> DedupStats:
    """Write the deduplicated twin of a table with the table's descriptions.

    The twin has its descriptions before it has rows, and gets its rows in one commit, so it
    is as it was or as it should be if this is interrupted.  A column that the
    table has no more stays in the twin, without values.

    A pass over the key column gives the counts and keeps the repeated keys in
    the shared folder; when these are few, as with features on borders, the
    next pass writes without shuffling the table.
    """
    source = spark.table(quoted(src))
    seen, folder = Observation(), shared_folder(spark, "repeats")
    counts = key_counts(source, key).observe(seen, *stats_columns())
    repeated = counts.filter((F.col("n") > 1) & F.col("key").isNotNull()).select("key")
    repeated.write.parquet(folder)
    stats = DedupStats(**seen.get)
    if null_key == "keep" and stats.without_key:
        stats.after += stats.without_key - 1
    if stats.repeated_bytes <= BROADCAST_BYTES:
        repeats = spark.read.schema(repeated.schema).parquet(folder)
        result = dedup_by_repeats(source, repeats, key, True, null_key)
    else:
        result = dedup(source, key, null_key)
        if PARTITION_COLUMN in source.columns:
            result = result.hint("rebalance", F.col(PARTITION_COLUMN))
    if table_exists(spark, dst):
        apply_table_metadata(spark, dst, table_metadata(spark, src))
    else:
        create_like(spark, src, dst)
    commits.replace_all(result, dst)
    return stats


def dedup_tables(
    spark: SparkSession,
    schema: str,
    catalog: str = "",
    table_prefix: str = TABLE_PREFIX,
    key: str = FEATURE_KEY,
    suffix: str = DEDUP_SUFFIX,
    null_key: str = "collapse",
    concurrent: int = CONCURRENT_TABLES,
) -> dict[str, DedupStats]:
    """Twins of all tables with the prefix, ``concurrent`` at a time.

    A table without the key column is reported in the log and left out.
    """
    sources = {}
    for name in list_source_tables(spark, catalog, schema, table_prefix, suffix):
        src = ".".join(part for part in (catalog, schema, name) if part)
        if key not in spark.table(quoted(src)).columns:
            logger.warning("table %s has no column %s and is not deduplicated", src, key)
            continue
        sources[name] = src

    def one(src: str) -> DedupStats:
        return dedup_table(spark, src, src + suffix, key, null_key)

    # Tables are independent; several at a time keep executors busy while one plans or finishes.
    with ThreadPoolExecutor(concurrent) as pool:
        jobs = {name: pool.submit(inheritable_thread_target(spark)(one), src) for name, src in sources.items()}
        return {name: job.result() for name, job in jobs.items()}


def dedup_stats(df: DataFrame, by: list[str], key: str = FEATURE_KEY) -> DataFrame:
    """``before``, ``after`` and ``removed`` per group of ``by`` columns."""
    counts = df.groupBy(*by, F.col(f"`{key}`").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.groupBy(*by)
        .agg(F.sum("n").alias("before"), F.count(F.lit(1)).alias("after"))
        .withColumn("removed", F.col("before") - F.col("after"))
    )
