"""Quality by importance resampling.

Two bags of hashed n-grams are generative models: one of target texts, those
labelled as good, one of the raw corpus.  A text's log-weight is the log ratio
of its probabilities under both; documents are resampled without replacement by
the Gumbel top-k trick: each gets its log-weight plus a Gumbel number drawn from
its id, and the k largest stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, small
from .toxicity import training_rows

BUCKETS = 1 << 16
SAMPLE = 50_000
SMOOTHING = 0.5
TOKENS = "\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]+"


def grams(text: Column) -> Column:
    """Hash buckets of the tokens of a text and of their pairs.

    Tokens are runs of letters, of digits, or of other signs, as they are written.
    """
    tokens = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKENS), F.lit(0))
    hashed = F.transform(tokens, lambda t: F.xxhash64(t))
    ones = F.transform(hashed, lambda h: F.pmod(h, F.lit(BUCKETS)).cast("int"))
    return F.struct(ones.alias("ones"), hashed.alias("hashed"))


def buckets(ones: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Buckets of the single tokens, then of neighbouring pairs."""
    wide = hashed.astype(np.uint64)
    pairs = (wide[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ wide[1:] * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(40)
    return np.concatenate([ones, (pairs % np.uint64(BUCKETS)).astype(ones.dtype)])


def _read(column):
    for x in column:
        yield buckets(*(np.asarray(x[name].values) for name in ("ones", "hashed")))


def fit(
    docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="quality",
    sample: int = SAMPLE,
) -> np.ndarray:
    """The log ratio of target and raw probability of each bucket.

    Raw counts cover all texts.  The target is made of at most ``sample`` labelled
    rows of label 1 outside the held-out third of the ids.  Without such rows
    every ratio is zero.
    """
    good = training_rows(labels, id_col, label_col, sample).filter("_label = 1")
    marked = docs.select(F.col(id_col).alias("_id"), grams(F.col(text_col)).alias("_g")).join(
        F.broadcast(good), "_id", "left"
    )

    def count(batches):
        held = np.zeros((2, BUCKETS), np.int64)  # the raw corpus, the target
        for batch in small(batches):
            target = batch.column(0).is_valid().to_pylist()
            for good_, found in zip(target, _read(batch.column(1))):
                n = np.bincount(found, minlength=BUCKETS)
                held[0] += n
                if good_:
                    held[1] += n
        at = np.flatnonzero(held[0])
        columns = [pa.array(at.astype(np.int32)), *(pa.array(x[at]) for x in held)]
        yield pa.RecordBatch.from_arrays(columns, names=["bucket", "raw", "target"])

    counted = (
        marked.select("_label", "_g").mapInArrow(count, "bucket int, raw long, target long")
        .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
        .toPandas()  # a row per bucket at most
    )
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = counted["bucket"].to_numpy(np.int64)
    raw[at], target[at] = counted["raw"], counted["target"]
    if not target.sum():
        return np.zeros(BUCKETS)
    # Both models lean on the raw corpus where they have seen little.
    share = (raw + SMOOTHING) / (raw + SMOOTHING).sum()
    strength = SMOOTHING * BUCKETS
    return np.log((target + strength * share) / (target.sum() + strength)) - np.log(share)


def weigh(docs: DataFrame, ratios: np.ndarray, id_col="doc_id", text_col="text") -> DataFrame:
    """(id, log_weight, gumbel) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(ratios)

    def run(batches):
        for batch in small(batches):
            made = [float(sent.value[x].sum()) for x in _read(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.float64())], names=["id", "log_weight"])

    kind = docs.schema[id_col].dataType.simpleString()
    weighed = docs.select(id_col, grams(F.col(text_col)).alias("_g")).mapInArrow(run, f"id {kind}, log_weight double")
    uniform = (F.shiftrightunsigned(F.xxhash64(F.lit("gumbel"), "id"), 12) + 0.5) / F.lit(float(1 << 52))
    return weighed.withColumn("gumbel", -F.log(-F.log(uniform)))


def top_k(rows: DataFrame, key: str, k: int, steps: int = 1 << 12) -> DataFrame:
    """Adds ``selected``: whether a row is among the ``k`` with the largest ``key``.

    The k-th largest key is found by counting rows in ever narrower ranges, which
    needs no global order; what is left are rows with one key, of which those with
    the smallest ids stay.  Rows that share key and id are selected together.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    if low is None or k <= 0:
        return rows.withColumn("selected", F.lit(False))
    above = 0
    while low < high:
        width = (high - low) / steps
        if not low < low + width < high:
            break
        at = F.least(F.floor((F.col(key) - low) / width), F.lit(steps - 1)).cast("int")
        inside = rows.filter((F.col(key) >= low) & (F.col(key) <= high))
        counts = {r[0]: (r[1], r[2], r[3]) for r in inside.groupBy(at.alias("at")).agg(F.count("*"), F.min(key), F.max(key)).collect()}
        for b in sorted(counts, reverse=True):
            if above + counts[b][0] >= k:
                low, high = counts[b][1:]
                break
            above += counts[b][0]
        else:
            return rows.withColumn("selected", F.lit(True))
    tied = rows.filter((F.col(key) >= low) & (F.col(key) <= high))
    # Of doubles next to each other, so no more than ``steps`` or so.
    keys = rows.filter((F.col(key) >= low) & (F.col(key) <= high)).groupBy(key).agg(F.count("*"))
    for edge, n in sorted(map(tuple, keys.collect()), reverse=True):
        if above + n >= k:
            break
        above += n
    over, at = F.col(key) > F.lit(edge), F.col(key) == F.lit(edge)
    if above + n <= k:
        return rows.withColumn("selected", over | at)
    last = _id_at(rows.filter(at), k - above)
    before = F.col("id").isNull() if last is None else F.col("id").isNull() | (F.col("id") <= F.lit(last))
    return rows.withColumn("selected", over | (at & before))


def _id_at(rows: DataFrame, place: int):
    """The id at this place, counted from 1, of the rows in the order of ids, rows without one in front.

    The driver sees a count for each partition of the order and the one id.
    """
    order = F.asc_nulls_first("id")
    counts = rows.groupBy("id").agg(F.count("*").alias("n"))
    ordered = cut(counts.orderBy(order).withColumn("part", F.spark_partition_id()))
    for part, n in sorted(map(tuple, ordered.groupBy("part").agg(F.sum("n")).collect())):
        if n >= place:
            break
        place -= n
    reached = F.sum("n").over(Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, 0))
    return (
        ordered.filter(F.col("part") == part).withColumn("reached", reached)
        .filter(F.col("reached") >= place).agg(F.min_by("id", "reached")).first()[0]
    )


def resample(
    docs: DataFrame, labels: DataFrame, keep: float | None = None, id_col="doc_id", text_col="text",
    label_col="quality", sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, log_weight, key, selected.

    ``keep`` is the share of rows that the sampling keeps, by default that of good
    ones among the labelled rows that the model is learnt from.  The Gumbel numbers come
    from the ids, so a run can be repeated; repeated rows get equal keys.  Null and
    empty texts have weight 0; a row without id is weighed like any other.  Other
    columns are not read; an empty table gives an empty result.
    """
    if keep is None:
        seen = training_rows(labels, id_col, label_col, sample)
        keep = seen.agg(F.avg((F.col("_label") == 1).cast("int"))).first()[0]
        keep = 1.0 if keep is None else keep
    ratios = fit(docs, labels, id_col, text_col, label_col, sample)
    rows = cut(weigh(docs, ratios, id_col, text_col).withColumn("key", F.col("log_weight") + F.col("gumbel")))
    chosen = top_k(rows, "key", round(rows.count() * keep))
    return chosen.select(F.col("id").alias(id_col), "log_weight", "key", "selected")
