"""Small inputs with values worked out by hand."""

import datetime
import re
import unicodedata
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerlake.functions import calendar as cal
from ledgerlake.functions import contract_text as ct
from ledgerlake.functions import durations
from ledgerlake.functions import identifiers as ids
from ledgerlake.functions import redaction, texts, values
from ledgerlake.operators import indicators, matching, statistics, versions
from ledgerlake.plans import catalog
from ledgerlake.sources import files, landing
from ledgerlake.streaming.landing import land_stream

D = datetime.date


def one(spark, column, **row):
    return spark.createDataFrame([tuple(row.values())], list(row)).select(column.alias("x")).first().x


@pytest.mark.parametrize("raw,want", [("00255513", "00255513"), ("255513", "00255513"), ("CZ00255513", "00255513"), ("002 55 513", "00255513"), ("255513.0", "00255513"), ("123456789", None), ("0", None), ("Praha 5, 10", None), ("", None)])
def test_company_ids(spark, raw, want):
    assert one(spark, ids.company_id(F.col("r")), r=raw) == want


def test_check_digits_and_reasons(spark):
    rows = spark.createDataFrame([("00255513",), ("00255514",), ("text",), ("",), (None,)], "r string")
    assert [x.reason for x in rows.select(ids.classify_id(F.col("r")).alias("x")).select("x.*").collect()] == [None, "bad_check_digit", "bad_format", "missing", "missing"]


def test_entity_key_equals_uuid5(spark):
    want = str(uuid.uuid5(uuid.UUID("6f1c2a52-1b8e-4f43-9d36-0d8e52b8a6a1"), "subject:00255513"))
    assert one(spark, ids.entity_key("subject", F.col("k")), k="00255513") == want


@pytest.mark.parametrize("text,want", [("20 068 576 Kč", "20068576"), ("1.234,5", "1234.5"), ("1,234.56", "1.23456"), ("12,5", "12.5"), ("12 345,60 CZK", "12345.6"), ("EUR 12", None), ("abc", None), ("", None)])
def test_locale_decimal(spark, text, want):
    assert one(spark, values.locale_decimal(F.col("t")), t=text) == (Decimal(want) if want else None)


def test_working_days(spark):
    df = spark.createDataFrame([(D(2026, 4, 2), D(2026, 4, 7)), (D(2026, 9, 21), D(2026, 9, 28))], "a date, b date")
    got = {r.a: r.n for r in cal.working_days(df, cal.calendar(spark, "2026-01-01", "2026-12-31"), "a", "b", "n").collect()}
    assert got == {D(2026, 4, 2): 1, D(2026, 9, 21): 4}


def test_wilson_ends(spark):
    x = one(spark, values.wilson(F.col("k"), F.col("n")), k=264, n=300)
    assert (round(x.share, 3), round(x.low, 3), round(x.high, 3)) == (0.88, 0.838, 0.912)
    assert one(spark, values.wilson(F.col("k"), F.col("n")), k=0, n=5).low == 0
    assert one(spark, values.wilson(F.col("k"), F.col("n")), k=5, n=5).high == 1


def test_names_and_words(spark):
    assert one(spark, texts.company_name(F.col("t")), t="ŽLUŤOUČKÝ kůň, spol. s r.o.") == "zlutoucky kun"
    assert one(spark, texts.company_name(F.col("t")), t="s.r.o.") == ""
    assert sorted(one(spark, texts.long_words(F.col("t")), t="Oprava školy a školy v obci")) == ["obci", "oprava", "skoly"]
    for name in ("Firma GmbH", "FIRMA, příspěvková organizace", "Firma Sp. z o.o.", "Firma s.r.o., v.v.i.", "Firma SE"):
        assert one(spark, texts.company_name(F.col("t")), t=name) == "firma"
    assert one(spark, texts.company_name(F.col("t")), t="Obec p.o.") == "obec"
    assert one(spark, texts.fold(F.col("t")), t="Ålesund São Forlì ﬁ Ⅳ ½ 𝐀") == "alesund sao forli fi iv 1⁄2 a"
    for text, want in [("firma rizikového\n  dodavatele", ["risky"]), ("nerizikový dodavatel", []), ("propojena  se", ["linked"]), ("propojeni\u0301 se", []), ("podezr\u030cely", ["suspicious"]), ("", [])]:
        assert one(spark, texts.evaluative(F.col("t")), t=text) == want
    assert one(spark, texts.evaluative(F.col("t")), t="Podezřelý a napojený na úřad, propojení s") == ["suspicious", "tied"]


def test_typed_sum_refuses_mixed_kinds(spark):
    df = spark.createDataFrame([("A", "x", 1), ("A", "x", None), ("B", "x", 2)], "type string, vat string, amount int")
    assert {(r.type, r.total, r.n) for r in statistics.typed_sum(df, ["type", "vat"], "amount").collect()} == {("A", 1.0, 1), ("B", 2.0, 1)}
    with pytest.raises(Exception, match="different kinds"):
        statistics.strict_sum(df, ["type", "vat"], "amount").collect()
    assert statistics.strict_sum(df.limit(0), ["type", "vat"], "amount").first().total is None


def test_split_under_limit_and_structure_change(spark):
    rows = [("a", "b", D(2026, 1, 1), 1_900_000), ("a", "b", D(2026, 3, 1), 1_500_000), ("a", "b", D(2026, 12, 1), 1_900_000), ("a", "c", D(2026, 1, 1), 2_500_000)]
    f = spark.createDataFrame(rows, "payer string, recipient string, day date, amount int")
    got = indicators.split_under_limit(f, 3_000_000).collect()
    assert [(r.payer, r.recipient, r.n, r.total) for r in got if r.recipient == "b"] == [("a", "b", 2, 3_400_000.0)]
    c = spark.createDataFrame([("s", D(2026, 5, 1))], "id string, day date")
    h = spark.createDataFrame([("s", D(2026, 3, 1), "seat"), ("s", D(2025, 1, 1), "board")], "id string, change_day date, kind string")
    assert [(r.kinds, r.n) for r in indicators.changes_nearby(c, h, "id", 90).collect()] == [("seat", 1)]


def _versions(spark, rows):
    return spark.createDataFrame(rows, "k string, v int, valid_from date, valid_to date, recorded_from timestamp, recorded_to timestamp")


def test_upsert_keeps_history_and_splits_the_middle(spark):
    t = lambda s: F.lit(s).cast("timestamp")
    far, never = D(9999, 12, 31), datetime.datetime(9999, 12, 31)
    start = _versions(spark, [("limit", 50000, D(2016, 7, 1), far, datetime.datetime(2020, 1, 1), never)])
    batch = spark.createDataFrame([("limit", 60000, D(2027, 1, 1), far)], "k string, v int, valid_from date, valid_to date")
    new = versions.upsert(start, batch, t("2021-01-01"), ["k"])
    assert new.count() == 3 and new.where(versions.is_current()).count() == 2
    assert versions.upsert(new, batch, t("2022-01-01"), ["k"]).exceptAll(new).count() == 0
    middle = spark.createDataFrame([("limit", 1, D(2018, 1, 1), D(2019, 1, 1))], "k string, v int, valid_from date, valid_to date")
    cut = versions.upsert(start, middle, t("2021-01-01"), ["k"]).where(versions.is_current()).orderBy("valid_from")
    assert [(r.v, r.valid_from) for r in cut.collect()] == [(50000, D(2016, 7, 1)), (1, D(2018, 1, 1)), (50000, D(2019, 1, 1))]
    assert versions.overlapping(cut, ["k"]).count() == 0
    with pytest.raises(Exception, match="twice"):
        versions.upsert(start, batch.union(batch), t("2021-01-01"), ["k"]).collect()
    ended = versions.end_entities(new, spark.createDataFrame([("limit",)], "k string"), t("2023-01-01"), ["k"])
    assert ended.where(versions.is_current()).count() == 0 and ended.count() == 3


def test_rates(spark):
    text = ["Datum|1 EUR|100 JPY", "02.01.2026|24,170|13,226", "Datum|1 EUR|1 USD", "05.01.2026|24,200|20,100"]
    lines = spark.createDataFrame([(2026, k, x) for k, x in enumerate(text)], "year int, line_no int, line string")
    rates = files.yearly_rates(lines)
    assert {(r.currency, r.rate_day, round(r.rate, 5)) for r in rates.collect()} == {("EUR", D(2026, 1, 2), 24.17), ("JPY", D(2026, 1, 2), 0.13226), ("EUR", D(2026, 1, 5), 24.2), ("USD", D(2026, 1, 5), 20.1)}
    f = spark.createDataFrame([(1, "EUR", D(2026, 1, 4)), (2, "JPY", D(2026, 1, 12)), (3, "JPY", D(2026, 1, 13)), (4, None, D(2026, 1, 4))], "id int, currency string, day date")
    got = {r.id: r.rate and round(r.rate, 5) for r in landing.rate_as_of(f, rates, "currency", "day").collect()}
    assert got == {1: 24.17, 2: 0.13226, 3: None, 4: None}


def test_contract_dump(spark, tmp_path):
    xml = """<dump xmlns="x"><zaznam><identifikator><idSmlouvy>1</idSmlouvy><idVerze>2</idVerze></identifikator><odkaz>u</odkaz><casZverejneni>2026-01-02T03:04:05</casZverejneni>
    <smlouva><subjekt><nazev>A</nazev><ico>00255513</ico></subjekt><smluvniStrana><nazev>B</nazev><ico>45023522</ico></smluvniStrana><smluvniStrana><nazev>C</nazev></smluvniStrana><predmet>p</predmet><datumUzavreni>2026-01-01</datumUzavreni><hodnotaBezDph>100.5</hodnotaBezDph></smlouva><platnyZaznam>1</platnyZaznam></zaznam></dump>"""
    (tmp_path / "d.xml").write_text(xml)
    r = files.contract_dump(spark, str(tmp_path / "d.xml")).collect()
    assert len(r) == 1 and (r[0].contract_id, r[0].version_id, r[0].net, r[0].signed, r[0].valid) == ("1", "2", Decimal("100.50"), D(2026, 1, 1), True)
    assert [p.ico for p in r[0].parties] == ["45023522", None]


def test_json_trees(spark):
    df = spark.createDataFrame([(1, '{"a":{"k":"x","b":[{"k":["y","z"]},{"c":{"k":"w"}}]}}'), (2, "no json"), (3, None)], "id int, payload string")
    got = [(r.id, r.value) for r in files.values_of_key(df, "id", "payload", "k").orderBy("id", "place").collect()]
    assert got[0][0] == 1 and sorted(v for _, v in got) == ["w", "x", "y", "z"]
    out = df.union(spark.createDataFrame([(4, '{"owner":{"name":"n"},"dodavatele":[{"ico":"","nazev":"Jan"},{"ico":"1","nazev":"Firma"}]}')], "id int, payload string")).select("id", redaction.redact_source(F.col("payload"), "notices").alias("x")).select("id", "x.*").where("id = 4").first()
    assert out.payload == '{"dodavatele":[{"ico":""},{"ico":"1","nazev":"Firma"}]}' and out.redacted == ["dodavatele[0].nazev", "owner"]


def test_contract_texts(spark):
    text = "Cena plnění činí 1 234 567,50 Kč bez DPH. Smluvní pokuta 500 Kč. Smlouva na dobu 24 měsíců od 5. března 2026, podepsáno 1.2.2026. IČO 00255513 a 255 51 3."
    found = ct.amounts(F.col("t"))
    assert [str(s.value) for s in one(spark, found, t=text)] == ["1234567.50", "500.00"]
    assert [str(s.value) for s in one(spark, ct.prices(found), t=text)] == ["1234567.50"]
    assert one(spark, ct.dates(F.col("t")), t=text) == [D(2026, 2, 1), D(2026, 3, 5)]
    assert one(spark, ct.company_ids(F.col("t")), t=text) == ["00255513"]
    assert one(spark, ct.duration_days(F.col("t")), t=text) == 720
    assert one(spark, ct.amount_check(found, F.lit(1234567.5), F.lit(None).cast("double")), t=text) == "match"
    assert one(spark, ct.without_vat_variants(F.col("v")), v=[100.0, 121.0, 300.0]) == [100.0, 300.0]


def test_amounts_in_hard_places(spark):
    """Spaces that don't break, both currencies around, words that hold digits, contexts, many amounts, nulls and empty texts."""
    shown = lambda t: [(str(s.value), s.currency) for s in one(spark, ct.amounts(F.col("t")), t=t, k=1)]
    assert shown("Celkem 1\u00a0234,5 Kč, EUR 12 a Kč 500 Kč; 7,-") == [("1234.50", "CZK"), ("12.00", "EUR"), ("500.00", "CZK"), ("7.00", "CZK")]
    assert shown("m3 EUR, x5 Kč, 0 Kč, 1.000,-- CZK, 5 Kčs, 2,-- USD") == [("1000.00", "CZK"), ("2.00", "USD")]
    assert shown("1Kč " * 300) == [("1.00", "CZK")] * 300
    assert shown("") == []
    assert spark.sql("SELECT CAST(NULL AS STRING) AS t").select(ct.amounts(F.col("t")).alias("x")).first().x == []
    found = one(spark, ct.amounts(F.col("t")), t="cena " + "x" * 150 + " 600 Kč. Jistota je cena 700 Kč / ks ročně", k=1)
    assert [s.before[:4] for s in found] == ["cena", "cena"] or found[0].before.startswith("cena")
    got = one(spark, ct.prices(F.array(*[F.col("t")])), t=found[0], k=1)
    assert [float(s.value) for s in got] == [600]
    assert [float(s.value) for s in one(spark, ct.prices(F.array(F.col("t"))), t=found[1], k=1)] == []


def test_durations_and_annual_values(spark):
    t = "Záruka na dobu 10 let. Služby po dobu 2 let; dodávky od 1.1.2020 do 31. 12. 2021, licence na dobu jednoho roku."
    d = one(spark, durations.duration(F.col("t")), t=t, k=1)
    assert (d.indefinite, d.days, d.continuous) == (None, 730, True)
    d = one(spark, durations.duration(F.col("t")), t="Smlouva se souhlasem na dobu neurčitou. Dohoda na dobu určitou. Plnění na dobu 99 let", k=1)
    assert (d.indefinite, d.days, d.continuous) == (False, None, False)
    rows = durations.annual_values(spark.createDataFrame([(1, ""), (2, None)], "k int, t string"), "k", "t").collect()
    assert [(r.repeated, r.verdict, r.annual) for r in rows] == [(False, None, None)] * 2


def test_matching_blocks_and_scores(spark):
    t = spark.createDataFrame([(1, "b", D(2026, 1, 10)), (2, "b", D(2026, 6, 1))], "tender int, buyer string, tender_day date")
    c = spark.createDataFrame([(7, "b", D(2026, 1, 30)), (8, "x", D(2026, 1, 10))], "contract int, buyer string, contract_day date")
    assert [(r.tender, r.contract) for r in matching.candidates(t, c, ["buyer"], 30).collect()] == [(1, 7)]
    full = one(spark, matching.score(F.lit(1.0), F.lit(1.0), F.lit(1.0)), x=1)
    assert full == 0.999


def test_stream_lands_each_key_once(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "id long, ts timestamp, text string"
    rows = lambda xs: spark.createDataFrame([(i, datetime.datetime(2026, 1, 1), t) for i, t in xs], schema)
    rows([(1, "a"), (1, "a"), (2, "b")]).write.parquet(source)
    stream = lambda: land_stream(spark, spark.readStream.schema(schema).parquet(source), target, check, ["id"])
    stream().awaitTermination(120)
    rows([(2, "b"), (3, "c")]).write.mode("append").parquet(source)
    stream().awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3]


def test_stream_lands_records_that_come_late(spark, tmp_path):
    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "id long, ts timestamp, text string"
    rows = lambda xs: spark.createDataFrame([(i, datetime.datetime(2026, 3, 10) - datetime.timedelta(days), "a") for i, days in xs], schema)
    stream = lambda: land_stream(spark, spark.readStream.schema(schema).parquet(source), target, check, ["id"])
    rows([(1, 0), (2, 1)]).write.parquet(source)
    stream().awaitTermination(120)
    rows([(1, 60), (3, 60), (3, 60), (4, 0)]).write.mode("append").parquet(source)
    stream().awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(target).collect()) == [1, 2, 3, 4]


def test_all_documents_and_words_are_compared(spark):
    sf = "/root/testdata/sf0.001"

    def long(text):
        bare = "".join(c for c in unicodedata.normalize("NFKD", text or "") if not unicodedata.combining(c))
        return set(re.findall("[a-z0-9]{4,}", bare.lower()))

    items = {r.item_id: long(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: long(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r.id_a, r.id_b): r.common for r in catalog.QUERIES["J17_all_common_words"](spark, sf).collect()}
    assert got == {(a, b): len(x & y) for a, x in items.items() for b, y in docs.items() if len(x & y) >= 2}
    got = {r.doc_id: r.n for r in catalog.QUERIES["H02_all_long_words"](spark, sf).collect()}
    assert got == {k: len(x) for k, x in docs.items()}


def test_percentiles_with_ties_nulls_and_single_rows(spark):
    rows = [("a", 1.0)] * 5 + [("a", 20000.25), ("a", -3.5), ("b", 7.25), ("c", None), (None, 2.0), (None, 4.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: (r.n, r.p) for r in statistics.percentiles(df, "g", "v", [0.0, 0.5, 0.9, 1.0]).collect()}
    assert got["a"] == (7, [-3.5, 1.0, pytest.approx(1 + 0.4 * 19999.25), 20000.25])
    assert got["b"] == (1, [7.25] * 4) and got[None] == (2, [2.0, 3.0, pytest.approx(3.8), 4.0]) and "c" not in got


def test_recipients_by_id_else_by_a_unique_name(spark):
    from ledgerlake.operators import entities as en

    register = spark.createDataFrame([("45023522", "Stavby Novák, a.s.", False), ("25400339", "Jan Malý", True), ("00255513", "Obec Lhota", False), ("00064581", "OBEC LHOTA", False), ("27502988", "Vodárna severních Čech s.r.o.", None)], "ico string, name string, person boolean")
    rows = [
        (1, "45023522", "stavby novak", False), (2, "45023522", "Pekárna", False), (3, "45023522", None, None), (4, "45023522", "x", True), (5, "25400339", "x", True), (6, "11111111", "x", False), (7, "00006947", "x", False),
        (8, "", "Vodarna severnich Cech, spol. s r.o.", None), (9, None, "Obec Lhota", False), (10, None, "Jan", True), (11, None, "Obec", False), (12, None, None, False), (13, None, "s.r.o.", False),
    ]
    got = {r.id: (r.category, r.register_ico) for r in en.match(spark.createDataFrame(rows, "id int, ico string, name string, person boolean"), register).collect()}
    assert got == {
        1: (en.SAME_NAME, "45023522"), 2: (en.OTHER_NAME, "45023522"), 3: (en.SAME_NAME, "45023522"), 4: (en.OTHER_NAME, "45023522"), 5: (en.SAME_NAME, "25400339"), 6: (en.BAD_ID, None), 7: (en.NO_SUCH_ID, None),
        8: (en.UNIQUE, "27502988"), 9: (en.SEVERAL, None), 10: (en.PERSON, None), 11: (en.NOT_FOUND, None), 12: (en.NOT_FOUND, None), 13: (en.NOT_FOUND, None),
    }
    empty = spark.createDataFrame([], "id int, ico string, name string, person boolean")
    assert en.match(empty, register).collect() == []


def test_cross_check_of_texts(spark):
    from ledgerlake.functions import crosscheck as cc
    from ledgerlake.functions.amounts import value_in_text

    for text, value, want in [
        ("Tabulka: 99 000,00 celkem", 99000, True), ("155.000, - za dílo", 155000, True), ("Cena 70 325.00 Kč", 70325, True), ("1 122 106,70", 1122107, True), ("122 106,70", 1122107, False),
        ("5 99 000", 99000, True), ("1.99 000", 99000, False), ("99 0001", 99000, False), ("999", 999, False), (None, 5000, False), ("x 5000", None, False), ("5 000,10 a 5 000,90", 5001, True), ("5 000,10", 5002, False),
    ]:
        assert one(spark, value_in_text(F.lit(text).cast("string"), F.lit(value).cast("decimal(18,2)")), t="") is want, (text, value)
    found = one(spark, ct.amounts(F.col("t")), t="Kupní cena 500 Kč200,- x a 300 Kč, 400,-")
    assert [int(a.value) for a in found] == [500, 300, 400]  # a number glued to what stands before is none
    got = one(spark, cc.days(F.col("t")), t="V Praze dne 3. 9. 2026, ode dne 4.9.2026, Digitálně podepsal Jan Datum: 2026.09.24 10:23, 31. 2. 2026, 5. ÚNORA 2026 a 6. zari 1989")
    assert sorted((str(x.day), x.signed) for x in got) == [("2026-02-05", False), ("2026-09-03", True), ("2026-09-04", False), ("2026-09-24", True)]
    assert one(spark, cc.days(F.lit(None).cast("string")), t="") in (None, [])
    for text, want in [("IČO 002 55 513", True), ("ič0100255513", True), ("IČ: 255513", True), ("IČ: 25551", False), ("100255513", False)]:
        assert one(spark, cc.holds_id(F.col("t"), F.lit("00255513")), t=text) is want, text
    assert one(spark, cc.other_ids(F.col("t"), F.array(F.lit("00255513"), F.lit(None))), t="IČO: 00255513, IČ 450 23 522, IČO 45023522, IČ 12345678") == ["45023522"]
    values = F.array(*[F.lit(x).cast("decimal(18,2)") for x in (1, 10, 100, 100)])
    assert sorted(map(int, spark.range(1).select(cc.sums(values)).first()[0])) == [11, 101, 110, 111]


def test_values_of_a_key_forty_levels_down(spark):
    deep = '{"x":' * 40 + '{"k":[1,[2,{"k":null}]]}' + "}" * 40
    df = spark.createDataFrame([(1, deep), (2, '{"k":{"k":"a","l":"b"}}'), (3, "[]"), (4, "no"), (5, None)], "id int, payload string")
    got = [(r.id, r.value) for r in files.values_of_key(df, "id", "payload", "k").orderBy("id", "place").collect()]
    assert got == [(1, "1"), (1, "2"), (1, None), (2, "a")]


def test_a_batch_reads_its_own_days_only(spark, tmp_path):
    from ledgerlake.streaming.landing import landed_beside

    source, target, check = (str(tmp_path / x) for x in ("in", "out", "check"))
    schema = "id long, day date"
    rows = lambda xs: spark.createDataFrame([(i, None if d is None else D(2026, 1, d)) for i, d in xs], schema)
    stream = lambda: land_stream(spark, spark.readStream.schema(schema).parquet(source), target, check, ["id"], "day")
    rows([(i, i % 28 + 1) for i in range(280)] + [(900, None)]).coalesce(1).write.parquet(source)
    stream().awaitTermination(120)
    late = rows([(5, 6), (5, 6), (901, 6), (900, None), (902, None)])
    files_read = landed_beside(late, target, "day").select(F.input_file_name().alias("f")).distinct().count()
    everything = spark.read.parquet(target).select(F.input_file_name().alias("f")).distinct().count()
    assert everything >= 29 and files_read <= 2 * everything / 29 + 1
    late.write.mode("append").parquet(source)
    stream().awaitTermination(120)
    stream().awaitTermination(120)
    got = sorted((r.id, r.day) for r in spark.read.parquet(target).where("id >= 900 or id = 5").collect() if r.day) + sorted(r.id for r in spark.read.parquet(target).where("day is null").collect())
    assert got == [(5, D(2026, 1, 6)), (901, D(2026, 1, 6)), 900, 902]


def test_work_goes_on_where_it_stopped(spark, tmp_path):
    from ledgerlake.streaming.landing import work_off, work_states

    log = str(tmp_path / "log")
    items = spark.createDataFrame([(str(i),) for i in range(40)], "item string")
    tried = []

    def do(part):
        tried.append(sorted(r.item for r in part.collect()))
        if len(tried) == 4:
            raise RuntimeError("stopped")
        return part.select("item", F.timestamp_seconds(F.unix_timestamp() - 1000).alias("at"), (F.col("item") % 10 != 3).alias("ok"))

    with pytest.raises(RuntimeError):
        work_off(items, log, do)
    done = {i for part in tried[:3] for i in part}
    tried.clear()
    tried.append([])
    work_off(items, log, lambda part: do(part) if len(tried) != 3 else (tried.append(sorted(r.item for r in part.collect())) or part.select("item", F.timestamp_seconds(F.unix_timestamp() - 1000).alias("at"), (F.col("item") % 10 != 3).alias("ok"))))
    again = {i for part in tried for i in part}
    assert again == {str(i) for i in range(40)} - {i for i in done if int(i) % 10 != 3}  # failures whose wait is over are tried again
    states = {r.item: r.state for r in work_states(items, spark.read.parquet(log)).collect()}
    assert {s for i, s in states.items() if int(i) % 10 == 3} == {"failed"} and {s for i, s in states.items() if int(i) % 10 != 3} == {"done"}
