"""Choosing layers and cutting them into ranges, as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapstrata.settings import BATCH_SIZE


def requested_layers(requests: DataFrame, column: str = "request") -> DataFrame:
    """``pos`` and ``layer`` of each name in a comma-separated request; blanks
    are skipped."""
    names = F.filter(
        F.transform(F.split(F.col(column), ","), lambda name: F.trim(name)), lambda n: n != ""
    )
    return requests.select("*", F.posexplode(names).alias("pos", "layer"))


def select_layers(listing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Listing rows of the wanted layers with their place in the request."""
    return listing.join(wanted, "layer")


def unknown_layers(listing: DataFrame, wanted: DataFrame) -> DataFrame:
    """Wanted layers no container has."""
    return wanted.join(listing, "layer", "left_anti")


def batch_ranges(counts: DataFrame, count: str | Column, size: int = BATCH_SIZE) -> DataFrame:
    """One row per range: ``idx`` from 0, ``offset`` and ``size``.

    The last range of a layer is short; an empty layer has none.
    """
    total = F.col(count) if isinstance(count, str) else count
    last = F.ceil(total / size).cast("long") - 1
    ranges = counts.filter(total > 0).withColumn("idx", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return ranges.withColumn("offset", F.col("idx") * size).withColumn(
        "size", F.least(F.lit(size).cast("long"), total - F.col("offset"))
    )


def spread_ranges(ranges: DataFrame, partitions: int) -> DataFrame:
    """Each range in a partition of its own, given as many partitions."""
    return ranges.repartitionByRange(partitions, *[c for c in ranges.columns])


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Rows per layer and department with subtotals (NULL means all)."""
    return metrics.rollup("layer", "dept").agg(F.sum("rows").alias("rows"))
