"""Exact dedup by skew-safe combining, in DataFrame operations only.

Copies are merged three times: within the task that read them, within a salted
digest group, and over the salts of a digest.  Whatever share of the rows one
text has, a group of the first shuffle holds one row per task and salt, and a
group of the second one row per salt.  Full texts are compared at every stage,
since the text is part of every grouping key next to its digest; two texts
that share a digest stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, fresh

SALTS = 16


def normalised(text: Column) -> Column:
    """Runs of blanks become one space; null counts as the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), BLANKS, " ")


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def exact_groups(docs: DataFrame, id_col="doc_id", text_col="text", salts=SALTS, digest=sha256):
    """One row per row of ``docs``: ``id_col``, keep_id, group_size, kept, digest.

    ``digest`` maps the normalised text to a short key; any function gives right
    results, a good one keeps groups apart.

    Null text counts as empty, and empty texts are equal to each other.  A row
    without id never wins against one with an id; where no row of a group has
    one, keep_id is null and all are marked as kept.  Rows that repeat an id and
    its text are marked alike.  Other columns are not read.  An empty table
    gives an empty result.
    """
    rows = docs.select(
        F.col(id_col).alias("id"), normalised(F.col(text_col)).alias("text")
    ).withColumn("digest", digest(F.col("text")))
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(salts))).groupBy(
        "digest", "salt", "text"
    ).agg(F.min("id").alias("low"), F.count("*").alias("n"))
    texts = salted.groupBy("digest", "text").agg(
        F.min("low").alias("keep_id"), F.sum("n").alias("group_size")
    )
    per_digest = texts.groupBy("digest").agg(
        F.count("*").alias("texts"),
        F.min("keep_id").alias("keep_id"),
        F.sum("group_size").alias("group_size"),
    )
    winners = cut(per_digest)
    result = rows.select("id", "digest").join(winners.filter("texts = 1"), "digest")
    clashes = winners.filter("texts > 1").select("digest")
    if not clashes.isEmpty():
        apart = rows.join(clashes, "digest", "left_semi")
        kept = apart.groupBy("digest", "text").agg(
            F.min("id").alias("keep_id"), F.count("*").alias("group_size")
        )
        shared = apart.join(kept, ["digest", "text"]).withColumn("texts", F.lit(2).cast("long"))
        result = result.unionByName(shared.select(*result.columns))
    return result.select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        "digest",
    )


def exact_dedup(docs: DataFrame, id_col="doc_id", text_col="text", salts=SALTS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Per text the row with the smallest id stays, and exactly one row where that
    row is repeated or no row has an id.
    """
    groups = exact_groups(docs, id_col, text_col, salts)
    digest, keep, mark, copies = (fresh(docs, n) for n in ("_digest", "_keep_id", "_keep_digest", "_copies"))
    marks = (
        groups.filter("kept")
        .groupBy(F.col(id_col).alias(keep), F.col("digest").alias(mark))
        .agg(F.count("*").alias(copies))
    )
    match = F.col(id_col).eqNullSafe(F.col(keep)) & (F.col(digest) == F.col(mark))
    rows = docs.withColumn(digest, sha256(normalised(F.col(text_col)))).join(marks, match)
    once = rows.filter(F.col(copies) == 1).select(*docs.columns)
    again = rows.filter(F.col(copies) > 1)
    if again.isEmpty():
        return once
    return once.unionByName(again.dropDuplicates([keep, mark]).select(*docs.columns))
