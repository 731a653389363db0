"""Texts are folded and compared at a cost of their characters, few of them in Python."""

import time

from pyspark.sql import functions as F

from ledgerlake.functions import texts
from ledgerlake.operators.reports import name_similarity


def test_rare_letters_cost_little(spark):
    rows = spark.range(0, 400, 1, 4).select(F.concat(F.repeat(F.lit("Příliš žluťoučký kůň "), 1000), F.lit("ﬁrma™ "), F.col("id")).alias("t"))
    began = time.perf_counter()
    got = {r.n for r in rows.select(F.array_join(texts.long_words(F.col("t")), ",").alias("n")).collect()}
    assert got == {"prilis,zlutoucky,firmatm"} and time.perf_counter() - began < 20


def test_composed_without_python(spark):
    rows = spark.createDataFrame([("ČÉ ΟΔΟΣ",), ("",), (None,)], "t string").select(texts.composed_lower(F.col("t")).alias("x"))
    assert [r.x for r in rows.collect()] == ["čé οδος", "", None]
    assert "Python" not in rows._jdf.queryExecution().executedPlan().toString()


def test_equal_names_are_not_compared_by_python(spark):
    names = spark.createDataFrame([("a b", "a b"), ("", "x"), (None, "x"), ("abcd", "abce")], "a string, b string")
    rows = names.select(name_similarity(F.col("a"), F.col("b")).alias("x"))
    assert [r.x for r in rows.collect()] == [1.0, 0.0, 0.0, 0.75]
    assert "CASE WHEN" in next(x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in x or "NOT (a" in x)
