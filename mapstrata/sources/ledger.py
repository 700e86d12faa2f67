"""Checksums of landed files, kept so that a file is hashed once.

The ledger is a table of (path, length, modified, md5, run).  A file is known if its path, length
and time of change are; only the others are hashed, by the tasks, and
entered.  Entries of files that changed or went stay until the ledger is compacted.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.operators import commits
from mapstrata.operators.tables import quoted
from mapstrata.sources.manifest import file_checksums

SCHEMA = "path string, length long, modified timestamp, md5 string, run string"
KEY = ("path", "length", "modified")


def landed(spark: SparkSession, path: str, pattern: str = "*.gpkg") -> DataFrame:
    """``(path, length, modified)`` of files below ``path`` with the ending; reads no content.

    Empty files are left out: they count as missing.
    """
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length", F.col("modificationTime").alias("modified"))
    )


def entries(spark: SparkSession, ledger: str) -> DataFrame:
    """The ledger's rows, each once; an absent ledger is created."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {quoted(ledger)} ({SCHEMA}) USING parquet")
    spark.catalog.refreshTable(quoted(ledger))
    first = spark.table(quoted(ledger)).groupBy(*KEY).agg(F.min(F.struct("run", "md5")).alias("e"))
    return first.select(*KEY, "e.md5", "e.run")


def unknown(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files that the ledger has not as they are."""
    return files.join(ledger, list(KEY), "left_anti")


def checksums(spark: SparkSession, path: str, ledger: str, pattern: str = "*.gpkg") -> DataFrame:
    """``(path, length, modified, md5, hashed)`` of the files below ``path``.

    ``hashed`` marks those that were not in the ledger; this run has entered them, with its name.
    A file that two runs meet at the same time is entered twice, which does no harm.
    """
    run = uuid.uuid4().hex[:12]
    files = landed(spark, path, pattern)
    fresh = unknown(files, entries(spark, ledger))
    hashed = file_checksums(fresh).join(fresh.select("path", "modified"), "path")
    hashed.select(*KEY, "md5", F.lit(run).alias("run")).write.insertInto(quoted(ledger))
    return (
        files.join(entries(spark, ledger), list(KEY))
        .select(*KEY, "md5", (F.col("run") == run).alias("hashed"))
    )


def compact(spark: SparkSession, path: str, ledger: str, pattern: str = "*.gpkg") -> int:
    """Keep the entries of the files that are there, each once, in one commit; their number."""
    kept = entries(spark, ledger).join(landed(spark, path, pattern), list(KEY), "left_semi")
    return commits.replace_all(kept, ledger)
