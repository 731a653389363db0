"""Matching tenders to contracts: documented links, then scored candidates found by blocking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import long_words

#: Weights, threshold and cap of the score.
WEIGHTS = {"ids": 0.40, "date": 0.25, "amount": 0.25, "subject": 0.10}
THRESHOLD, CAP = 0.70, 0.999


def score(date: Column, amount: Column, subject: Column) -> Column:
    """The weighted score, capped and rounded to three places."""
    return F.round(F.least(WEIGHTS["ids"] + WEIGHTS["date"] * date + WEIGHTS["amount"] * amount + WEIGHTS["subject"] * subject, F.lit(CAP)), 3)


def documented(tenders: DataFrame, contracts: DataFrame, token: str) -> DataFrame:
    """Tenders whose number stands in a contract's text, by an equi-join on extracted numbers."""
    found = contracts.select("contract", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(token), F.lit(1)))).alias("number"))
    return tenders.join(found, "number").select("tender", "contract", F.lit(1.0).alias("score"), F.lit("documented").alias("state"))


def candidates(tenders: DataFrame, contracts: DataFrame, block: list[str], window_days: int, tasks: int | None = None) -> DataFrame:
    """Pairs that agree on all block keys and lie within a window of days; never a cross join.

    Contracts stand in one slot of two windows and a day, tenders in the one or two that their days touch.
    ``tasks``: deal both sides to so many, or as the session says.
    """
    slot = lambda c, by=0: F.floor((F.datediff(c, F.lit("1970-01-01")) + by) / (2 * window_days + 1))
    left = tenders.withColumn("__slot", F.explode(F.array_distinct(F.array(slot("tender_day", -window_days), slot("tender_day", window_days)))))
    right = contracts.withColumn("__slot", slot("contract_day"))
    if tasks:
        left, right = [df.repartition(tasks, *block, "__slot") for df in (left, right)]
    return left.join(right, [*block, "__slot"]).where(F.abs(F.datediff("tender_day", "contract_day")) <= window_days).drop("__slot")


def best_per(df: DataFrame, group: str, score_column: str, tie: str) -> DataFrame:
    """The candidate with the largest score, ties to the larger id."""
    rest = [c for c in df.columns if c != group]
    return df.groupBy(group).agg(F.max_by(F.struct(*rest), F.struct(score_column, tie)).alias("__x")).select(group, "__x.*")


def word_pairs(a: DataFrame, b: DataFrame, least_common: int, rare: int | None = None) -> DataFrame:
    """(id_a, id_b, common) of texts that share long words; with ``rare``, only words in so few texts of ``b`` count."""
    wa = a.select("id_a", F.explode(long_words(F.col("text_a"))).alias("word"))
    wb = b.select("id_b", F.explode(long_words(F.col("text_b"))).alias("word"))
    if rare is not None:
        few = wb.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") <= rare).select("word")
        wb = wb.join(few, "word", "left_semi")
    return wa.join(wb, "word").groupBy("id_a", "id_b").agg(F.count("*").alias("common")).where(F.col("common") >= least_common)
