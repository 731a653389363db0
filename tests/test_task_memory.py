"""What a task holds doesn't grow with the tables."""

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import indicators, matching
from ledgerlake.plans import base, catalog

from .conftest import SF


@pytest.fixture
def few_rows(monkeypatch):
    monkeypatch.setattr(base, "TASK_ROWS", 500)


def test_flows_are_dealt_by_their_number(spark, few_rows):
    n = -(-base.table(spark, SF, "lineitem").count() // 500)
    assert n > spark.sparkContext.defaultParallelism
    assert base.flows(spark, SF).rdd.getNumPartitions() == n


@pytest.mark.parametrize("name", ["A03_single_recipient", "A05_repeated_recipient", "A09_payer_coverage", "A24_heuristic_check", "J14_probable_match"])
def test_dealt_flows_have_the_same_rows(spark, monkeypatch, name):
    want = sorted(catalog.QUERIES[name](spark, SF).collect())
    monkeypatch.setattr(base, "TASK_ROWS", 500)
    assert sorted(catalog.QUERIES[name](spark, SF).collect()) == want


def test_single_recipients_are_not_gathered(spark):
    rows = [("p", "c", f, r) for f, r in [(1, 1), (1, 1), (2, 1), (2, 2), (3, None), (4, None), (4, 5), (5, 6)]]
    flows = spark.createDataFrame(rows, "payer string, o_orderpriority string, flow long, recipient long")
    out = indicators.single_recipient_share(flows)
    assert [tuple(r) for r in out.collect()] == [("p", "c", 5, 3, 0.6)]
    assert "distinct" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_tenders_stand_in_two_slots(spark):
    day = F.date_add(F.lit("1969-12-01").cast("date"), F.col("id").cast("int"))
    tenders = spark.range(400).select(F.col("id").alias("tender"), F.lit(1).alias("payer"), day.alias("tender_day"))
    contracts = spark.range(0, 400, 7).select(F.col("id").alias("contract"), F.lit(1).alias("payer"), day.alias("contract_day"))
    pairs = matching.candidates(tenders, contracts, ["payer"], 30)
    got = [(r.tender, r.contract) for r in pairs.collect()]
    assert sorted(got) == [(a, b) for a in range(400) for b in range(0, 400, 7) if abs(a - b) <= 30]
    dealt = matching.candidates(tenders, contracts, ["payer"], 30, 7)
    assert sorted((r.tender, r.contract) for r in dealt.collect()) == sorted(got) and dealt.rdd.getNumPartitions() == 7


@pytest.mark.parametrize("name", ["B01_upsert", "B03_end", "B03_end_log", "B04_correct", "B06_no_longer_derived"])
def test_versions_are_not_broadcast(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
