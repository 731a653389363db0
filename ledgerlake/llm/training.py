"""Bounded labelled samples for the classifiers, and folds that never leak."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labelled rows that a model is fitted on, at most (about: rows are taken by hash).  A documented bound; scoring covers all rows.
TRAIN_ROWS = 12_000


def remainder(modulus: int) -> Column:
    """crc32 of the id as text, modulo: the fold of a row; rows without an id are in fold 0."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus, F.lit(0)).cast("int")


def sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, held_out: int, rows: int = TRAIN_ROWS) -> DataFrame:
    """(doc_id, y, text) of labelled rows outside the held-out fold, about ``rows`` of them by hash of the id."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    known = known.where(remainder(modulus) != held_out)
    share = min(1.0, rows / max(1, known.count()))
    picked = known.where(F.pmod(F.xxhash64("doc_id", F.lit(label)), F.lit(1 << 30)) < int(share * (1 << 30)))
    # about ``rows`` pairs of numbers, whatever the input: a proven bound
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(picked), "doc_id")
