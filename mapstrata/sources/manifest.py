"""Which archives there should be, which landed whole, which to fetch."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.functions.codes import (
    archive_name,
    archive_url,
    checksum_url,
    department_code,
    requested_departments,
)
from mapstrata.sources.gpkg import local_path

CHUNK_BYTES = 1 << 20
# What a verification can say.
OK, MISMATCH, NO_CHECKSUM, MISSING = "ok", "mismatch", "no_checksum", "missing"


class ChecksumMismatch(RuntimeError):
    """A landed file differs from its published checksum."""


def source_manifest(departments: DataFrame) -> DataFrame:
    """Add archive name, address and checksum address to ``(dept, version,
    projection, version_date)`` rows."""
    return (
        departments.withColumn("dept", department_code("dept"))
        .withColumn("name", archive_name("version", "projection", "dept", "version_date"))
        .withColumn("url", archive_url("name"))
        .withColumn("checksum_url", checksum_url("url"))
    )


def departments_of(requests: DataFrame, column: str = "request") -> DataFrame:
    """One row per department code asked for, in request order per row."""
    return requests.select(
        "*", F.posexplode(requested_departments(column)).alias("pos", "code")
    ).withColumn("dept", department_code("code"))


def landed_files(spark: SparkSession, path: str, pattern: str = "*.gpkg") -> DataFrame:
    """``(path, length)`` of files below ``path`` with the ending; reads no content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "length")
    )


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        digests = []
        for path in batch.column("path").to_pylist():
            digest = hashlib.md5()
            with open(local_path(path), "rb") as file:
                while chunk := file.read(CHUNK_BYTES):
                    digest.update(chunk)
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("path"), batch.column("length"), pa.array(digests, pa.string())],
            names=["path", "length", "md5"],
        )


def file_checksums(files: DataFrame) -> DataFrame:
    """``(path, length, md5)``: files are read in chunks in the tasks, so one
    may be larger than a binary value can hold."""
    spread = files.select("path", "length").repartition("path")
    return spread.mapInArrow(_hash_chunks, "path string, length long, md5 string")


def verify(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """``expected`` with a ``status`` column.

    ``expected`` has the key columns and ``expected_md5`` (NULL when none is
    published), ``actual`` the key columns, ``length`` and ``md5``.  An empty
    file counts as missing.
    """
    joined = expected.join(actual.filter(F.col("length") > 0), on, "left")
    status = (
        F.when(F.col("md5").isNull(), MISSING)
        .when(F.col("expected_md5").isNull(), NO_CHECKSUM)
        .when(F.col("md5") == F.col("expected_md5"), OK)
        .otherwise(MISMATCH)
    )
    return joined.withColumn("status", status)


def to_fetch(expected: DataFrame, actual: DataFrame, on: list[str]) -> DataFrame:
    """Sources which are absent, empty, or differ from their checksum.

    One join: a source is good if one of the files that landed under its key is.
    """
    landed = actual.filter(F.col("length") > 0).groupBy(*on).agg(F.collect_set("md5").alias("_md5s"))
    wrong = F.col("expected_md5").isNotNull() & ~F.array_contains("_md5s", F.col("expected_md5"))
    absent = F.coalesce(F.size("_md5s"), F.lit(-1)) < 1
    return expected.join(landed, on, "left").filter(absent | wrong).select(*expected.columns)


def require_intact(verified: DataFrame) -> None:
    """Raise when a landed file differs from its checksum."""
    bad = verified.filter(F.col("status") == MISMATCH)
    found = bad.agg(F.count(F.lit(1)).alias("n"), F.first(F.struct("*")).alias("example")).first()
    if found["n"]:
        raise ChecksumMismatch(f"{found['n']} file(s) differ, such as {found['example'].asDict()}")


def require_departments(wanted: DataFrame, containers: DataFrame) -> None:
    """Raise when a department has no container file (both have ``dept``)."""
    missing = wanted.select("dept").distinct().join(containers, "dept", "left_anti")
    names = sorted(row["dept"] for row in missing.collect())
    if names:
        raise FileNotFoundError(f"no .gpkg file for {', '.join(names)}")
