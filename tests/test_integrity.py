"""Integrity rules, run states, logged ends and samples with reject reasons on small inputs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlake.operators import integrity, versions
from ledgerlake.operators.indicators import single_bid_share
from ledgerlake.operators.statistics import accepted_sample
from ledgerlake.sources import landing

AT = dt.datetime(2026, 1, 1)
OPEN = dt.datetime(9999, 12, 31)
D = dt.date


def test_null_rules_pass_and_an_empty_table_fails_nothing(spark):
    amounts = "period_from date, period_to date, currency string, conversion string, value_czk double, rate double, rate_day date, type string, as_of date"
    rows = [
        (D(2026, 1, 1), None, "CZK", "neni_treba", None, None, None, "cena", None),
        (D(2026, 1, 1), D(2026, 1, 1), "EUR", "kurz_cnb", 1.0, 1.0, D(2026, 1, 1), "vratka", None),
        (None, None, "EUR", None, None, None, None, "cena", None),
        (None, None, "EUR", "kurz_cnb", 1.0, None, None, None, None),
        (None, None, "CZK", "kurz_cnb", 1.0, 1.0, D(2026, 1, 1), "cena", None),
    ]
    got = {r.rule: (r.failed, r.n) for r in integrity.report(spark.createDataFrame(rows, amounts), integrity.amount_rules()).collect()}
    assert got == {"period_order": (1, 5), "conversion_consistent": (2, 5), "foreign_says_conversion": (1, 5), "subsidy_says_as_of": (1, 5)}
    empty = integrity.report(spark.createDataFrame([], amounts), integrity.amount_rules()).collect()
    assert len(empty) == 4 and all((r.failed, r.n) == (0, 0) for r in empty)


def test_overlaps_count_current_rows_of_a_known_key(spark):
    schema = "key string, valid_from date, valid_to date, recorded_from timestamp, recorded_to timestamp"
    rows = [("a", D(2026, 1, 1), D(2026, 3, 1), AT, OPEN), ("a", D(2026, 2, 1), D(2026, 2, 9), AT, OPEN), ("a", D(2026, 2, 20), D(2026, 4, 1), AT, OPEN), ("a", D(2026, 4, 1), D(2026, 5, 1), AT, OPEN), ("b", D(2026, 1, 1), D(2026, 3, 1), AT, AT), ("b", D(2026, 1, 1), D(2026, 3, 1), AT, OPEN)] + [(None, D(2026, 1, 1), D(2026, 3, 1), AT, OPEN)] * 2
    assert [tuple(r) for r in integrity.overlap_report(spark.createDataFrame(rows, schema), "o", ["key"]).collect()] == [("o", 2, 8)]
    assert [tuple(r) for r in integrity.overlap_report(spark.createDataFrame([], schema), "o", ["key"]).collect()] == [("o", 0, 0)]


def test_run_states(spark):
    starts = spark.createDataFrame([(k,) for k in range(5)], "run_id int")
    ends = spark.createDataFrame([(0, True, []), (1, True, ["x"]), (2, False, ["gone"]), (3, None, None)], "run_id int, reachable boolean, errors array<string>")
    got = {r.run_id: (r.status, r.n_errors) for r in landing.run_overview(starts, landing.run_ends(ends)).collect()}
    assert got == {0: ("uspech", 0), 1: ("chyba", 1), 2: ("preskoceno", 1), 3: ("preskoceno", 0), 4: ("nedokonceno", 0)}


def test_ends_are_logged_once_and_need_a_reason(spark):
    schema = "key string, v int, valid_from date, valid_to date, recorded_from timestamp, recorded_to timestamp"
    rows = [("a", 1, D(2026, 1, 1), D(2026, 2, 1), AT, OPEN), ("a", 2, D(2026, 2, 1), D(9999, 12, 31), AT, OPEN), ("b", 1, D(2026, 1, 1), D(9999, 12, 31), AT, OPEN), ("c", 1, D(2026, 1, 1), D(9999, 12, 31), AT, AT)]
    df, now = spark.createDataFrame(rows, schema), F.lit("2026-05-01").cast("timestamp")
    end = lambda *e: versions.end_with_log(df, spark.createDataFrame(list(e), "key string, reason string, replaced_by array<string>"), now, ["key"], F.lit(3))
    after, log = end(("a", "merged", ["b"]), ("c", "gone", None), ("x", "gone", None))
    assert [(r.key, r.n_closed, r.reason, r.replaced_by, r.run) for r in log.collect()] == [("a", 2, "merged", ["b"], 3)]
    assert {(r.key, r.v) for r in after.where(versions.is_current()).collect()} == {("b", 1)} and after.count() == 4
    again, nothing = versions.end_with_log(after, spark.createDataFrame([("a", "merged", None)], "key string, reason string, replaced_by array<string>"), now, ["key"], F.lit(4))
    assert nothing.count() == 0 and sorted(map(tuple, again.collect())) == sorted(map(tuple, after.collect()))
    for bad in ([("a", "", None)], [("a", None, None)], [("b", "x", None), ("b", "y", None)]):
        for out in end(*bad):
            with pytest.raises(Exception, match="needs a reason|ended twice"):
                out.collect()


def test_a_sample_counts_what_was_drawn_before_it_was_full(spark):
    rows = [(1, None), (2, "old"), (3, None), (4, "odd"), (5, "old"), (6, None), (7, "old")]
    frame = spark.createDataFrame(rows, "k int, why string")
    for n, want, counts in ((2, [1, 3], {None: 2, "old": 1}), (3, [1, 3, 6], {None: 3, "old": 2, "odd": 1}), (9, [1, 3, 6], {None: 3, "old": 3, "odd": 1})):
        good, drawn = accepted_sample(frame, ["k"], F.col("why"), n)
        assert sorted(r.k for r in good.collect()) == want and {r.reason: r.n for r in drawn.collect()} == counts
    good, drawn = accepted_sample(frame.limit(0), ["k"], F.col("why"), 2)
    assert good.count() == 0 and drawn.count() == 0


def test_single_bids_count_known_numbers_of_results(spark):
    schema = "buyer string, cpv string, kind string, day date, bids array<string>"
    rows = [("a", "30100000", "result", D(2026, 1, 5), ["1", "2", "n/a", None, "1"]), ("a", "30900000", "result", None, ["1"]), ("a", "", "result", D(2026, 1, 6), ["3"]), ("a", None, "result", D(2026, 1, 7), None), (None, "30", "result", D(2026, 1, 8), ["1"]), ("b", "30", "result", D(2026, 1, 9), ["x"]), ("b", "30", "planning", D(2026, 2, 1), ["1"])]
    got = sorted(tuple(r) for r in single_bid_share(spark.createDataFrame(rows, schema)).collect())
    assert got == [("a", "CPV 30", 4, 3, 0.75, D(2026, 1, 5), D(2026, 2, 2)), ("a", "CPV ??", 1, 0, 0.0, D(2026, 1, 5), D(2026, 2, 2))]
    assert single_bid_share(spark.createDataFrame([], schema)).collect() == []
