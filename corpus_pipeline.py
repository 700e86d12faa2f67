"""From raw documents to token ids: five stages over the ``documents`` table.

A stage is (name, function); the function takes (spark, docs, sf_dir), works on
all rows of ``docs`` and returns a DataFrame, which is written as Parquet and
read again as the next stage's ``docs``.  All but the last return the columns of
``docs``.  Rows with nulls, repeated rows and extra columns are handled as the
operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mapstrata.llm import bpe, decontam, exact_dedup, simhash, toxicity
from mapstrata.llm.common import table
from mapstrata.llm.queries import vocabulary
from mapstrata.settings import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score rejects go."""
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the smallest doc_id stays."""
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near-duplicates in five-word shingles, the row with the smallest doc_id stays."""
    return simhash.near_dedup(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids (little-endian unsigned 32 bit) and the digest of the decoded bytes."""
    path, pattern = vocabulary()
    return bpe.encode(docs, path, pattern, decoded=True).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("byte_bpe", encode),
]

#: No SQL for toxicity, fingerprints, edit distance and BPE; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the session's shared folder."""
    docs = table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "corpus")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
