"""Corpus pipeline: five training-data operators in a row, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir); what it returns is written as Parquet and
read again as the next one's ``docs``.  All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlake
from ledgerlake.llm import decontamination, exact_dedup, ngram_join, piece_bpe, toxicity
from ledgerlake.llm.tables import written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents at or over the toxicity threshold go; the model is fitted on labelled rows of ``docs``.

    Null and empty texts score like a text without hits; repeated rows are scored each; an empty table gives no rows.
    """
    ledgerlake.ship(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays; null counts as empty, null ids rank lowest; rows that repeat id and text share their fate."""
    ledgerlake.ship(spark)
    return exact_dedup.without_copies(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the row with the smallest id stays; null and empty texts stay; repeated rows share their fate."""
    ledgerlake.ship(spark)
    return ngram_join.one_of_each_group(spark, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts and items match nothing; repeated rows are judged each."""
    ledgerlake.ship(spark)
    return decontamination.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids and of the decoded text of every document left; a null text is an empty one."""
    ledgerlake.ship(spark)
    found = piece_bpe.encode(docs, digests=True)
    return found.select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("piece_bpe", encode),
]

#: Trained classifiers and a tokenizer have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
