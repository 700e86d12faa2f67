"""What the corpus operators share: tables, lineage cuts, linked components."""

from __future__ import annotations

import gc
import tempfile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of texts and of shingles end at these characters.
BLANKS = "[ \\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(batches, rows: int = 500):
    """Arrow batches in parts of few rows, so that a task holds few texts in several forms.

    What Arrow has freed goes back to the system after each batch, as the workers
    of a task share its executor's memory.
    """
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
        del batch
        pa.default_memory_pool().release_unused()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one where ``df`` has that column already."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def cut(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written once to the session's checkpoint folder.

    Later jobs read those files, so neither a lost executor nor a second use
    computes the rows again.  The folder is ``spark.checkpoint.dir``; only a
    local session without that setting gets a temporary one.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        base = spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
            base = tempfile.mkdtemp(prefix="mapstrata-")
        context.setCheckpointDir(base)
    return df.checkpoint(eager=True)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps.

    Spark deletes them once the driver has collected the plans that made them;
    a driver with little to do may not come to that for half an hour.
    """
    gc.collect()
    spark._jvm.System.gc()


#: Bits of a set of ids that is sent to all tasks: a megabyte, whatever the number of ids.
SET_BITS = 1 << 23


def split_by_ids(rows: DataFrame, column: str, ids: DataFrame, bits: int = SET_BITS):
    """(``rows`` whose ``column`` may be among ``ids``, the other rows), before any shuffle.

    ``ids`` has one column.  Its hashes are marked in a bitmap of fixed size, so
    rows that a join with ``ids`` would drop are mostly left out before the join
    moves them.  A full bitmap leaves out less and changes no result.
    """
    spark = rows.sparkSession
    width = 1 << 15
    place = F.pmod(F.xxhash64(ids.columns[0]), F.lit(bits)) + 1  # bitmaps count from 1
    marks = ids.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")
    )
    table = np.zeros((-(-bits // width), width // 8), np.uint8)
    for b, data in marks.collect():  # ``bits`` in all
        table[b - 1] = np.frombuffer(data, np.uint8)
    sent = spark.sparkContext.broadcast(table.ravel())

    def keep(wanted):
        def run(batches):
            for batch in small(batches):
                place = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
                found = (sent.value[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                yield batch.select(list(range(batch.num_columns - 1))).filter(pa.array(found == wanted))

        return run

    place = F.pmod(F.xxhash64(F.col(column).cast(ids.dtypes[0][1])), F.lit(bits))
    placed = rows.withColumn(fresh(rows, "_place"), place)
    return placed.mapInArrow(keep(True), rows.schema), placed.mapInArrow(keep(False), rows.schema)


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; the component is its
    smallest node.

    Alternates large-star and small-star steps until no link changes.  A step
    is one aggregation and one join, so a node with very many links is
    combined before the shuffle and its join side can be split.  Each round
    ends in a checkpoint; rounds grow with the logarithm of the longest path.
    """
    spark = links.sparkSession
    edges = cut(
        links.select(
            F.greatest(left, right).alias("v"), F.least(left, right).alias("u")
        ).filter("u < v").distinct()
    )
    while True:
        both = edges.unionByName(edges.select(F.col("u").alias("v"), F.col("v").alias("u")))
        low = both.groupBy("v").agg(F.min("u").alias("m")).withColumn("m", F.least("m", "v"))
        # Large star: every larger neighbour of v is linked to the least node near v.
        large = (
            both.filter("u > v").join(low, "v").select(F.col("u").alias("v"), F.col("m").alias("u"))
            .filter("u < v").distinct()
        )
        # Small star: the smaller neighbours of v and v itself go to the least of them.
        low = large.groupBy("v").agg(F.min("u").alias("m"))
        joined = large.join(low, "v")
        small = (
            joined.select(F.col("u").alias("v"), F.col("m").alias("u"))
            .unionByName(low.select("v", F.col("m").alias("u")))
            .filter("u < v").distinct()
        )
        after = cut(small)
        same = after.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        before = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = after
        release(spark)
        if tuple(same) == tuple(before):
            break
    found = edges.groupBy("v").agg(F.min("u").alias("component")).withColumnRenamed("v", "node")
    roots = edges.select(F.col("u").alias("node")).distinct()
    return found.unionByName(
        roots.join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    )
