"""Reports: measures against thresholds, profile documents, snapshot audits, name similarity."""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import jaccard


def recommendation(measures: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Do all measures reach the thresholds set before, and which lack."""
    both = thresholds.join(measures, "measure", "left")
    short = F.col("share").isNull() | (F.col("share") < F.col("least"))
    return both.agg(F.every(~short).alias("recommended"), F.array_join(F.sort_array(F.collect_list(F.when(short, F.col("measure")))), ",").alias("missing"))


def verdicts(df: DataFrame, key: str) -> DataFrame:
    """Documented over probable over none, for each key."""
    has = lambda s: F.max(F.when(F.col("state") == s, 1).otherwise(0)) == 1
    return df.groupBy(key).agg(F.when(has("documented"), "documented").when(has("probable"), "probable").otherwise("none").alias("verdict"))


def heuristic_check(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """Of documented pairs, how many the heuristic found, and how many it ranked best."""
    best = candidates.groupBy("tender").agg(F.max_by("contract", F.struct("score", "contract")).alias("best"))
    found = candidates.select("tender", "contract", F.lit(True).alias("found")).distinct()
    rows = truth.join(found, ["tender", "contract"], "left").join(best, "tender", "left")
    return rows.agg(F.count("*").alias("n"), F.sum(F.col("found").isNotNull().cast("long")).alias("found"), F.sum(F.coalesce(F.col("best") == F.col("contract"), F.lit(False)).cast("long")).alias("ranked_best"), F.sum(F.col("best").isNotNull().cast("long")).alias("something"))


def removed_keys(before: DataFrame, after: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a later snapshot of an append-only table lacks; there must be none."""
    return before.select(*keys).distinct().join(after.select(*keys).distinct(), keys, "left_anti")


def profile_documents(summaries: DataFrame, subject: str, left_out: Column) -> DataFrame:
    """One JSON document for each subject: its summaries in a fixed order, and what is left out and why."""
    item = F.struct("type", "vat", "n", "total", "share")
    docs = summaries.groupBy(subject).agg(F.sort_array(F.collect_list(F.when(left_out.isNull(), item))).alias("summaries"), F.sort_array(F.collect_list(F.when(left_out.isNotNull(), F.struct("type", "vat", left_out.alias("reason"))))).alias("left_out"))
    return docs.select(subject, F.to_json(F.struct("summaries", "left_out")).alias("document"), F.size("summaries").cast("long").alias("n_summaries"), F.size("left_out").cast("long").alias("n_left_out"))


def _ratio(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for a, b in pairs:
        yield pd.Series([0.0 if x is None or y is None else SequenceMatcher(None, x, y).ratio() for x, y in zip(a, b)])


def name_similarity(a: Column, b: Column) -> Column:
    """The larger of sequence ratio and word Jaccard of two normalised names; only for pairs that blocking has found."""
    ratio = F.pandas_udf(_ratio, "double")(F.when(a != b, a), b)  # equal names need none
    return F.when((a == "") | (b == "") | a.isNull() | b.isNull(), 0.0).when(a == b, 1.0).otherwise(F.greatest(ratio, jaccard(F.array_distinct(F.split(a, " ")), F.array_distinct(F.split(b, " ")))))
