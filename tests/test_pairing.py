"""Pairing of result notices with the register, and quality flags of records, on small inputs."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions.values import amount_variant
from ledgerlake.operators import pairing, record_flags

D = dt.date
NOTICES = "tender string, number string, published date, buyers array<string>"
PARTS = "tender string, part int, signed date, value decimal(18,2), currency string, suppliers array<string>, links array<string>"
REGISTER = "version string, valid boolean, signed date, net decimal(18,2), gross decimal(18,2), parties array<string>, numbers array<string>"


@pytest.fixture(scope="module")
def case(spark):
    notices = [("t1", "Z1", D(2026, 3, 1), ["b1", "b2", "b1"]), ("t2", "Z2", D(2026, 3, 1), ["b1"]), ("t3", None, None, ["b1"]), ("t4", "Z4", D(2026, 3, 1), None), ("t5", "Z5", D(2026, 3, 1), ["b9"])]
    parts = [
        ("t1", 1, D(2026, 2, 1), Decimal(1000), None, ["s1", "s2", None], ["v1", "v1", "lost"]),
        ("t2", 1, None, Decimal(1000), "CZK", ["s1"], []),
        ("t3", 1, None, Decimal(1000), None, ["s1"], None),
        ("t4", 1, D(2026, 2, 1), None, None, None, None),
        ("t5", 1, D(2026, 2, 1), Decimal(1000), "EUR", ["s1"], []),
    ]
    register = [
        ("v1", False, D(2026, 3, 4), Decimal(1000), None, ["b1", "s1"], ["Z1", "Z1"]),  # a day after the window of t1
        ("v2", True, D(2026, 3, 2), None, Decimal(1210), ["s2", None, "b2", "b1", "s1", "b1"], []),  # within both, by several pairs of ids
        ("v3", True, D(2025, 9, 2), Decimal(1000), None, ["b1", "s1"], ["Z2"]),  # first day of the window before t2
        ("v4", True, D(2025, 9, 1), Decimal(1000), None, ["b1", "s1"], ["Z2"]),
        ("v5", True, None, Decimal(1000), None, ["b1", "s1"], ["Z5"]),  # another buyer than t5's
        ("v6", None, D(2026, 2, 1), None, None, None, None),
        ("v7", True, D(2026, 2, 1), Decimal(1000), None, ["b9", "s1"], []),  # t5 is in euros
    ]
    return spark.createDataFrame(notices, NOTICES), spark.createDataFrame(parts, PARTS), spark.createDataFrame(register, REGISTER)


def test_windows(case):
    got = sorted(tuple(r) for r in pairing.in_window(*case).collect())
    assert got == [("t1", 1, "v2"), ("t2", 1, "v1"), ("t2", 1, "v2"), ("t2", 1, "v3"), ("t5", 1, "v7")]


def test_windows_equal_all_pairs(spark):
    notices = spark.range(60).select(F.concat(F.lit("t"), "id").alias("tender"), F.lit("Z").alias("number"), F.date_add(F.lit("2026-01-01").cast("date"), (F.col("id") * 37 % 400).cast("int")).alias("published"), F.array(F.concat(F.lit("b"), F.col("id") % 3)).alias("buyers"))
    parts = notices.select("tender", F.lit(1).alias("part"), F.when(F.crc32("tender") % 2 == 0, F.date_add("published", -9)).alias("signed"), F.lit(1).alias("value"), F.lit("CZK").alias("currency"), F.array(F.lit("s0"), F.lit("s1")).alias("suppliers"), F.array(F.lit("x")).alias("links"))
    register = spark.range(200).select(F.col("id").alias("version"), F.lit(True).alias("valid"), F.date_add(F.lit("2025-06-01").cast("date"), (F.col("id") * 53 % 700).cast("int")).alias("signed"), F.lit(1).alias("net"), F.lit(1).alias("gross"), F.array(F.concat(F.lit("b"), F.col("id") % 3), F.concat(F.lit("s"), F.col("id") % 4)).alias("parties"), F.array().cast("array<string>").alias("numbers"))
    day = lambda d, k: d + dt.timedelta(days=k)
    want = set()
    published = {r.tender: r for r in notices.collect()}
    for p in parts.collect():
        lo, hi = (day(p.signed, -30), day(p.signed, 30)) if p.signed else (day(published[p.tender].published, -180), day(published[p.tender].published, 7))
        want |= {(p.tender, 1, r.version) for r in register.collect() if lo <= r.signed <= hi and set(published[p.tender].buyers) & set(r.parties) and set(p.suppliers) & set(r.parties)}
    got = [tuple(r) for r in pairing.in_window(notices, parts, register).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_few_slots_and_pairs_of_ids(case):
    window = dt.timedelta(days=pairing.AROUND_NOTICE[1] - pairing.AROUND_NOTICE[0]).days + 1
    assert 2 * pairing.AROUND_SIGNING + 1 <= pairing.SLOT and window <= 2 * pairing.SLOT  # 2 and 3 slots at most
    notices, parts, register = case
    # an id that is buyer and supplier meets itself; ids meet in either order
    own = register.sparkSession.createDataFrame([("x", True, D(2026, 2, 1), None, None, ["s1", "b1"], []), ("y", True, D(2026, 2, 1), None, None, ["b1"], [])], REGISTER)
    same = parts.where("tender = 't2'").withColumn("suppliers", F.array(F.lit("b1"), F.lit("s1")))
    got = sorted(tuple(r) for r in pairing.in_window(notices, same, own).collect())
    assert got == [("t2", 1, "x"), ("t2", 1, "y")]


def test_documented_links(case):
    got = sorted((tuple(r) for r in pairing.documented(*case).collect()), key=repr)
    assert got == [
        ("t1", 1, "lost", pairing.BY_LINK, False, None, False, None, None),
        ("t1", 1, "v1", pairing.BY_LINK, True, False, True, 31, None),
        ("t1", None, "v1", pairing.BY_NUMBER, True, False, True, 31, 1),
        ("t2", None, "v3", pairing.BY_NUMBER, True, True, True, None, 2),
        ("t2", None, "v4", pairing.BY_NUMBER, True, True, True, None, 2),
    ]


def test_scores_verdicts_and_measures(case):
    candidates = pairing.scored(pairing.in_window(*case), *case)
    got = {(r.tender, r.version): (r.date_score, r.amount_score, r.compared, r.score) for r in candidates.collect()}
    assert got == {("t1", "v2"): (0.033, 1.0, "s_dph/1.21", 0.71), ("t2", "v1"): (0.5, 1.0, "bez_dph", 0.85), ("t2", "v2"): (0.5, 1.0, "s_dph/1.21", 0.85), ("t2", "v3"): (0.5, 1.0, "bez_dph", 0.85), ("t5", "v7"): (1.0, 0.0, None, 0.7)}
    assert [(r.tender, r.version) for r in pairing.best_of_parts(candidates).orderBy("tender").collect()] == [("t1", "v2"), ("t2", "v1"), ("t5", "v7")]
    rows = pairing.verdicts(case[0], pairing.documented(*case), candidates)
    assert [tuple(r) for r in rows.orderBy("tender").collect()] == [
        ("t1", "dolozene", "dolozene_odkaz_bt151", False, False, True, ["dolozeny_zaznam_zneplatnen"]),
        ("t2", "dolozene", "dolozene_jen_ev_cislo", True, False, True, None),
        ("t3", "nesparovano", "nesparovano", None, None, None, None),
        ("t4", "nesparovano", "nesparovano", None, None, None, None),
        ("t5", "jen_heuristicky", "heuristicky_bez_castky", None, None, None, None),
    ]
    m = {r.measure: (r.k, r.n) for r in pairing.measures(rows).collect()}
    assert m["sparovano_celkem"] == (3, 5) and m["heuristika_nasla_dolozenou"] == (1, 2) and m["dolozeny_zaznam_zneplatnen"] == (1, 2) and m["heuristicky_s_castkou"] == (0, 5)


def test_empty_tables_pair_nothing(case):
    none = [t.limit(0) for t in case]
    assert pairing.scored(pairing.in_window(*none), *none).count() == 0
    rows = pairing.verdicts(none[0], pairing.documented(*none), pairing.scored(pairing.in_window(*none), *none))
    assert rows.count() == 0
    assert pairing.verdicts(case[0], pairing.documented(*none), pairing.scored(pairing.in_window(*none), *none)).where("category = 'nesparovano'").count() == 5


@pytest.mark.parametrize("price,net,gross,want", [(100, 100, 121, (1.0, "bez_dph")), (100, None, 112, (1.0, "s_dph/1.12")), (100, 0, 0, (0.0, None)), (100, 111, None, (0.0, None)), (0, 0, 0, (0.0, None)), (None, 1, 1, (0.0, None))])
def test_amount_variant(spark, price, net, gross, want):
    df = spark.createDataFrame([tuple(v if v is None else float(v) for v in (price, net, gross))], "p double, n double, g double")
    x = df.select(amount_variant(F.col("p"), F.col("n"), F.col("g")).alias("x")).first().x
    assert (x.score, x.compared) == (pytest.approx(want[0]), want[1])


def test_record_flags(spark):
    contracts = spark.createDataFrame(
        [("a", "00255513", ["00255513", None], Decimal(5), None, None, None), ("b", "00255514", None, None, None, None, "důvod"), ("c", None, [""], None, None, None, ""), ("d", "00255513", ["00255513"], None, None, Decimal(1), None)],
        "k string, subject string, parties array<string>, net decimal(18,2), gross decimal(18,2), foreign decimal(18,2), no_price_reason string",
    )
    fields = "k string, position int, name string, declared_hash string, hash string, http_status int, size long, readable boolean, text string, boxes int, blocks int, url string"
    price = "Kupní cena činí 1 000 Kč."
    rows = [
        ("a", 2, "b.pdf", None, "h", 200, 1, True, price, 0, 0, "u2"), ("a", 1, "a.pdf", "h", "h", 200, 1, True, "text", 1, None, None), ("a", 3, "anonym.pdf", "h", None, None, None, None, None, None, None, None),
        ("b", 1, None, "h", "x", 200, 1, True, price, 9, 9, "u"), ("b", 2, "z.pdf", None, "h", 200, record_flags.MOST_BYTES + 1, True, price, 9, 9, "u"), ("b", 3, "z.pdf", None, None, 500, None, None, None, None, None, None),
        ("c", 1, "z.pdf", None, "h", 200, 1, True, price + " [začerněno]", None, 2, "u"), ("c", 2, "z.pdf", None, "h", 200, 1, None, price, None, 2, "w"), ("stranger", 1, "z.pdf", None, "h", 200, 1, True, price, 0, 0, "u"),
    ]
    got = {r.k: r for r in record_flags.record_flags(contracts, spark.createDataFrame(rows, fields), "k").collect()}
    assert sorted(got) == ["a", "b", "c", "d"]
    a, b, c, d = (got[k] for k in "abcd")
    assert a.states == ["zpracovano", "zpracovano", "nestazeno (bez odkazu)"] and a.original == "u2" and a.redacted_by == [record_flags.BY_NAME, record_flags.BY_BOXES]
    assert (a.m1, a.m2, a.m3, a.n_parties, a.parties_without_id, a.price_in_text) == (True, False, True, 2, 1, True)
    assert b.states == ["hash_nesouhlasi", "prilis_velka", "nestazeno (500)"] and (b.readable, b.original, b.redacted_by, b.subject_id, b.reason_given, b.m2) == (False, None, [], False, True, False)
    assert c.redacted_by == [record_flags.BY_MARKS, record_flags.BY_BLOCKS] and (c.m1, c.m2, c.reason_given, c.parties_without_id) == (False, True, False, 1)
    assert (d.states, d.m1, d.m2, d.m3, d.readable, d.price_in_text) == ([], True, False, False, False, False)
    measured = record_flags.flag_measures(record_flags.record_flags(contracts, spark.createDataFrame(rows, fields), "k"))
    m = {r.measure: (r.k, r.n) for r in measured.collect()}
    assert m["m2_mezi_bez_castky"] == (1, 2) and m["m3_mezi_citelnymi"] == (2, 2) and m["m1_ico_obe_strany_a_castka"] == (2, 4)


def test_a_best_below_the_threshold_is_not_sought(spark):
    """Only candidates at the threshold meet, and of them what verdicts read."""
    notices = spark.createDataFrame([("t1",), ("t2",)], "tender string")
    links = spark.createDataFrame([], "tender string, part int, version string, method string, exists boolean, valid boolean, buyer_agrees boolean, days int, with_number long")
    candidates = spark.createDataFrame([("t1", 1, "v1", 0.1, 0.0, None, 0.7), ("t1", 1, "v2", 0.1, 0.5, "x", 0.9), ("t2", 1, "v3", 0.1, 0.5, "x", 0.69)], "tender string, part int, version string, date_score double, amount_score double, compared string, score double")
    rows = pairing.verdicts(notices, links, candidates)
    assert {r.tender: r.detail for r in rows.collect()} == {"t1": pairing.DETAILS["amount"], "t2": pairing.NONE}
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "compared, " not in plan.split("min_by", 1)[1].split("\n")[0]
