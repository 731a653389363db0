"""Queries of projections, predicates and scalar functions (P and H rows)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import identifiers as ids
from ..functions import texts, values
from .base import FLOWS, flows, query, table

_RAW = """raw AS (SELECT c_custkey, CASE c_custkey % 7
  WHEN 0 THEN lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0') WHEN 1 THEN 'CZ' || CAST(c_custkey * 104729 % 100000000 AS VARCHAR)
  WHEN 2 THEN CAST(c_custkey * 31 AS VARCHAR) || '.0' WHEN 3 THEN ' ' || substr(lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0'), 1, 3) || ' ' || substr(lpad(CAST(c_custkey * 7919 % 100000000 AS VARCHAR), 8, '0'), 4)
  WHEN 4 THEN c_name WHEN 5 THEN NULL ELSE '0' END AS raw FROM customer)"""
_ICO = """trimmed AS (SELECT c_custkey, raw, trim(raw) AS t0 FROM raw),
nodot AS (SELECT *, CASE WHEN regexp_full_match(t0, '[0-9]+\\.0+') THEN split_part(t0, '.', 1) ELSE t0 END AS t1 FROM trimmed),
bare AS (SELECT *, CASE WHEN upper(t1) LIKE 'CZ%' THEN substr(t1, 3) ELSE t1 END AS t2 FROM nodot),
dig AS (SELECT *, regexp_replace(t2, '[^0-9]', '', 'g') AS d FROM bare),
ico AS (SELECT *, CASE WHEN length(d) BETWEEN 1 AND 8 AND NOT regexp_full_match(d, '0*') AND length(d) >= length(replace(t2, ' ', '')) - 2 THEN lpad(d, 8, '0') END AS ico FROM dig),
chk AS (SELECT *, ico IS NOT NULL AND (11 - (CAST(substr(ico,1,1) AS INT)*8 + CAST(substr(ico,2,1) AS INT)*7 + CAST(substr(ico,3,1) AS INT)*6 + CAST(substr(ico,4,1) AS INT)*5 + CAST(substr(ico,5,1) AS INT)*4 + CAST(substr(ico,6,1) AS INT)*3 + CAST(substr(ico,7,1) AS INT)*2) % 11) % 10 = CAST(substr(ico,8,1) AS INT) AS valid FROM ico)"""


def _raw_ids(spark, sf_dir):
    k = F.col("c_custkey")
    padded = F.lpad((k * 7919 % 100000000).cast("string"), 8, "0")
    kinds = [padded, F.concat(F.lit("CZ"), (k * 104729 % 100000000).cast("string")), F.concat((k * 31).cast("string"), F.lit(".0")), F.concat(F.lit(" "), F.substring(padded, 1, 3), F.lit(" "), F.substring(padded, 4, 5)), F.col("c_name"), F.lit(None).cast("string"), F.lit("0")]
    raw = F.when(k % 7 == 0, kinds[0])
    for n, kind in enumerate(kinds[1:], 1):
        raw = raw.when(k % 7 == n, kind)
    return table(spark, sf_dir, "customer").select("c_custkey", raw.alias("raw"))


@query("P01_company_id", f"WITH {_RAW}, {_ICO} SELECT c_custkey, ico FROM chk")
def company_id(spark, sf_dir):
    return _raw_ids(spark, sf_dir).select("c_custkey", ids.company_id(F.col("raw")).alias("ico"))


@query("P02_check_digit", f"WITH {_RAW}, {_ICO} SELECT c_custkey, valid FROM chk")
def check_digit(spark, sf_dir):
    return _raw_ids(spark, sf_dir).select("c_custkey", ids.check_digit_ok(ids.company_id(F.col("raw"))).alias("valid"))


@query("P03_classify_id", f"""WITH {_RAW}, {_ICO}, cls AS (SELECT c_custkey, ico, CASE WHEN raw IS NULL OR trim(raw) = '' THEN 'missing' WHEN ico IS NULL THEN 'bad_format' WHEN NOT valid THEN 'bad_check_digit' END AS reason FROM chk)
SELECT c_custkey, CASE WHEN reason IS NULL THEN ico END AS ico, reason FROM cls""")
def classify_id(spark, sf_dir):
    return _raw_ids(spark, sf_dir).select("c_custkey", ids.classify_id(F.col("raw")).alias("x")).select("c_custkey", "x.*")


@query("A15_id_quality", f"""WITH {_RAW}, {_ICO} SELECT c_mktsegment AS source, count(DISTINCT ico) AS ids, count(DISTINCT CASE WHEN NOT valid THEN ico END) AS invalid,
  count(DISTINCT CASE WHEN valid AND s.id IS NULL THEN ico END) AS not_found, sum(CASE WHEN ico IS NULL THEN 1 ELSE 0 END)::BIGINT AS missing
FROM chk JOIN customer USING (c_custkey) LEFT JOIN (SELECT lpad(CAST(s_suppkey * 7919 % 100000000 AS VARCHAR), 8, '0') AS id FROM supplier) s ON s.id = ico GROUP BY 1""")
def id_quality(spark, sf_dir):
    seen = _raw_ids(spark, sf_dir).join(table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("source")), "c_custkey")
    known = table(spark, sf_dir, "supplier").select(F.lpad((F.col("s_suppkey") * 7919 % 100000000).cast("string"), 8, "0").alias("ico"), F.lit(True).alias("known"))
    seen = seen.withColumn("ico", ids.company_id(F.col("raw"))).withColumn("valid", ids.check_digit_ok(F.col("ico"))).join(known, "ico", "left")
    d = lambda c: F.count_distinct(F.when(c, F.col("ico")))
    return seen.groupBy("source").agg(F.count_distinct("ico").alias("ids"), d(~F.col("valid")).alias("invalid"), d(F.col("valid") & F.col("known").isNull()).alias("not_found"), F.sum(F.col("ico").isNull().cast("long")).alias("missing"))


@query("P04_safe_date", """SELECT event_id, CASE WHEN TRY_CAST(left(t, 10) AS DATE) BETWEEN DATE '1990-01-01' AND DATE '2100-01-01' THEN TRY_CAST(left(t, 10) AS DATE) END AS day
FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN strftime(ts, '%Y-%m-%d') || 'T00:00' WHEN 1 THEN '2030-13-45' WHEN 2 THEN '1889-01-01' ELSE event_type END AS t FROM events)""")
def safe_date(spark, sf_dir):
    k = F.col("event_id") % 4
    text = F.when(k == 0, F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("T00:00"))).when(k == 1, "2030-13-45").when(k == 2, "1889-01-01").otherwise(F.col("event_type"))
    return table(spark, sf_dir, "events").select("event_id", values.safe_date(text).alias("day"))


@query("P06_locale_decimal", """SELECT l_orderkey, l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS value FROM lineitem""")
def locale_decimal(spark, sf_dir):
    """Amounts written as ``1.234,50 Kč`` read back equal the amounts."""
    v = F.col("l_extendedprice").cast("decimal(18,2)")
    written = F.concat(F.translate(F.format_number(v, 2), ",.", ".,"), F.lit(" Kč"))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", values.locale_decimal(written).cast("double").alias("value"))


@query("P08_typed_amount", f"""WITH {FLOWS}, rules(type, amount_type, vat_regime) AS (VALUES ('A', 'smluvni', 'bez_dph'), ('R', 'dotace_priznana', 'mimo_dph'))
SELECT flow, line, amount_type, vat_regime, CAST(amount AS DOUBLE) AS amount, CASE WHEN amount_type IS NULL THEN 'no_rule' END AS exception FROM flows LEFT JOIN rules USING (type)""")
def typed_amount(spark, sf_dir):
    rules = spark.createDataFrame([("A", "smluvni", "bez_dph"), ("R", "dotace_priznana", "mimo_dph")], "type string, amount_type string, vat_regime string")
    out = flows(spark, sf_dir).join(F.broadcast(rules), "type", "left")
    return out.select("flow", "line", "amount_type", "vat_regime", F.col("amount").cast("double").alias("amount"), F.when(F.col("amount_type").isNull(), "no_rule").alias("exception"))


@query("P18_size_band", """SELECT o_custkey, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total, CASE WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) < 1000000 THEN 'under_1m' WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) < 10000000 THEN '1m_10m' WHEN sum(CAST(o_totalprice AS DECIMAL(18,2))) < 100000000 THEN '10m_100m' ELSE 'over_100m' END AS band FROM orders GROUP BY 1""")
def size_band(spark, sf_dir):
    out = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("v"))
    return out.select("o_custkey", F.col("v").cast("double").alias("total"), values.size_band(F.col("v")).alias("band"))


@query("P13_natural_person", """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE (100 + c_custkey % 20 BETWEEN 100 AND 108) END AS person FROM customer""")
def natural_person(spark, sf_dir):
    """Legal forms of natural persons."""
    form = F.when(F.col("c_custkey") % 5 != 0, (100 + F.col("c_custkey") % 20).cast("string"))
    persons = [*map(str, range(100, 109)), "424", "425", "998"]
    return table(spark, sf_dir, "customer").select("c_custkey", F.when(form.isNotNull(), form.isin(persons)).alias("person"))


@query("P14_subsidy", f"""WITH {FLOWS} SELECT flow, line, COALESCE(CASE type WHEN 'A' THEN 'smluvni' WHEN 'R' THEN 'dotace_priznana' END IN ('dotace_priznana', 'dotace_cerpana', 'vratka'), false) AS subsidy FROM flows""")
def subsidy(spark, sf_dir):
    kind = F.when(F.col("type") == "A", "smluvni").when(F.col("type") == "R", "dotace_priznana")
    return flows(spark, sf_dir).select("flow", "line", F.coalesce(kind.isin("dotace_priznana", "dotace_cerpana", "vratka"), F.lit(False)).alias("subsidy"))


#: Sentences that some of the documents get, so that every pattern and its exceptions occur.
SENTENCES = [" Podezřelý nákup", " bez podezreni", " rizikový\n dodavatel", " nerizikový dodavatel", " firmy propojené  se starostou", " propojení s obcí", " napojený na úřad", " napojení na kanalizaci", " propojeni s firmou", ""]
_WORD = r"[\p{L}\p{M}\p{N}_]"
_START = rf"(?:^|[^\p{{L}}\p{{M}}\p{{N}}_])"


def _tied_sql(stem: str, then: str) -> str:
    """RE2 has no look-ahead: the ending is read and compared."""
    return rf"len(list_filter(regexp_extract_all(low, '{_START}{stem}({_WORD}*)\s+{then}(?:[^\p{{L}}\p{{M}}\p{{N}}_]|$)', 1), lambda x: NOT starts_with(x, 'í'))) > 0"


EVALUATIVE_SQL = {
    "suspicious": rf"regexp_matches(low, '{_START}podez[řr]')",
    "risky": rf"regexp_matches(low, '{_START}rizikov{_WORD}*\s+dodavatel')",
    "linked": _tied_sql("propojen", "se?"),
    "tied": _tied_sql("napojen", "na"),
}
SENTENCED_SQL = "SELECT doc_id, nfc_normalize(lower(text || CASE doc_id % 10 " + " ".join(f"WHEN {k} THEN '{x}'" for k, x in enumerate(SENTENCES)) + " END)) AS low FROM documents"


def sentenced(docs):
    """The documents, each with one of ``SENTENCES`` at its end."""
    return docs.withColumn("text", F.concat("text", F.element_at(F.array(*[F.lit(x) for x in SENTENCES]), (F.col("doc_id") % 10 + 1).cast("int"))))


@query("P15_evaluative_words", f"WITH d AS ({SENTENCED_SQL}) SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in EVALUATIVE_SQL.items()) + ") AS found FROM d")
def evaluative_words(spark, sf_dir):
    return sentenced(table(spark, sf_dir, "documents")).select("doc_id", F.array_join(texts.evaluative(F.col("text")), ",").alias("found"))


@query("P25_missing_reason", """SELECT event_id, nullif(concat_ws('; ', CASE WHEN user_id % 3 = 0 THEN 'payer missing' END, CASE WHEN value IS NULL OR value < 10 THEN 'amount missing' END), '') AS reason FROM events""")
def missing_reason(spark, sf_dir):
    reason = F.concat_ws("; ", F.when(F.col("user_id") % 3 == 0, "payer missing"), F.when(F.col("value").isNull() | (F.col("value") < 10), "amount missing"))
    return table(spark, sf_dir, "events").select("event_id", F.nullif(reason, F.lit("")).alias("reason"))


@query("H01_entity_key")
def entity_key(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", ids.entity_key("subject", F.lpad(F.col("s_suppkey").cast("string"), 8, "0")).alias("entity_id"))


FOLDED_WORDS_SQL = "list_distinct(regexp_extract_all(lower(strip_accents(text)), '[a-z0-9]{4,}'))"


@query("H02_long_words", f"SELECT doc_id, len({FOLDED_WORDS_SQL}) AS n FROM documents")
def long_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(texts.long_words(F.col("text"))).cast("long").alias("n"))


@query("H02_all_long_words")
def all_long_words(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.size(texts.long_words(F.col("text"))).cast("long").alias("n"))


#: Endings as people write the legal forms; what is left of a name is the same for all.
DRESSED = [", s.r.o.", " a.s.", ", spol. s r.o.", " GmbH", ", p.o.", ", příspěvková organizace", " s.r.o., v.v.i.", " Sp. z o.o.", " SE", " Ltd."]


@query("H03_company_name", """SELECT s_suppkey, lower(regexp_replace(s_name, '[^A-Za-z0-9]+', ' ', 'g')) AS name FROM supplier""")
def company_name(spark, sf_dir):
    ending = F.element_at(F.array(*[F.lit(x) for x in DRESSED]), (F.col("s_suppkey") % len(DRESSED) + 1).cast("int"))
    return table(spark, sf_dir, "supplier").select("s_suppkey", texts.company_name(F.concat("s_name", ending)).alias("name"))


@query("H02_any_letters", """WITH n AS (SELECT o_orderkey, o_orderkey % 7 AS k FROM orders) SELECT o_orderkey, CASE k WHEN 0 THEN 'alesund,forli' WHEN 1 THEN 'podebradska,sprava' WHEN 2 THEN 'fiscal,office' WHEN 3 THEN 'istanbul,gokceada' WHEN 4 THEN 'full,width' WHEN 5 THEN '' ELSE 'viet,uong' END AS words FROM n""")
def any_letters(spark, sf_dir):
    """Letters of any alphabet: rings and tildes, combining marks, ligatures, dotted capitals, full width, none at all."""
    kinds = ["Ålesund São Forlì", "Pode\u030cbradska\u0301 spra\u0301va", "\ufb01scal o\ufb03ce", "İstanbul Gökçeada", "\uff26\uff35\uff2c\uff2c \uff57\uff49\uff44\uff54\uff48", "日本語 ελλ", "Viêt ưỡng uơng"]
    text = F.element_at(F.array(*[F.lit(x) for x in kinds]), (F.col("o_orderkey") % 7 + 1).cast("int"))
    return table(spark, sf_dir, "orders").select("o_orderkey", F.array_join(texts.long_words(text), ",").alias("words"))


@query("H05_subject_agreement", """WITH w AS (SELECT p_partkey, p_brand, list_distinct(regexp_extract_all(lower(p_name), '[a-z0-9]{4,}')) AS a, list_distinct(regexp_extract_all(lower(p_type), '[a-z0-9]{4,}')) AS b FROM part)
SELECT p_partkey, CASE WHEN len(a) = 0 OR len(b) = 0 THEN 0.0 ELSE round(least(1.0, len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))) / 0.5), 6) END AS score FROM w""")
def subject_agreement(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", F.round(texts.subject_agreement(F.col("p_name"), F.col("p_type")), 6).alias("score"))


@query("H12_working_days", """
WITH years AS (SELECT y FROM range(1990, 2031) t(y)),
p AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
q AS (SELECT *, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h FROM p),
r AS (SELECT *, (32 + 2*(b%4) + 2*(c//4) - h - c%4) % 7 AS l FROM q),
s AS (SELECT *, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS z FROM r),
e AS (SELECT y, make_date(y, z//31, z%31 + 1) AS easter FROM s),
d AS (SELECT CAST(x AS DATE) AS day FROM range(DATE '1990-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(x)),
w AS (SELECT day, CASE WHEN isodow(day) < 6 AND strftime(day, '%m-%d') NOT IN ('01-01','05-01','05-08','07-05','07-06','09-28','10-28','11-17','12-24','12-25','12-26') AND day NOT IN (SELECT easter - 2 FROM e) AND day NOT IN (SELECT easter + 1 FROM e) THEN 1 ELSE 0 END AS k FROM d),
n AS (SELECT day, sum(k) OVER (ORDER BY day) AS n FROM w)
SELECT o_orderkey, CAST(greatest(b.n - a.n, 0) AS BIGINT) AS days FROM orders JOIN n a ON a.day = CAST(o_orderdate AS DATE) JOIN n b ON b.day = CAST(o_orderdate AS DATE) + CAST(o_orderkey % 60 AS INTEGER)""")
def working_days(spark, sf_dir):
    start = F.to_date("o_orderdate")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 60).cast("int")).alias("end"))
    return cal.working_days(orders, cal.calendar(spark, "1990-01-01", "2030-12-31"), "start", "end", "days").select("o_orderkey", F.col("days").cast("long").alias("days"))


@query("H13_month_back", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH AS DATE) AS day FROM orders")
def month_back(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", cal.month_back(F.to_date("o_orderdate")).alias("day"))


@query("H14_days_of_period", """WITH p AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) + 1 AS z FROM events GROUP BY 1)
SELECT user_id, CAST(unnest(range(a, z, INTERVAL 1 DAY)) AS DATE) AS day FROM p""")
def days_of_period(spark, sf_dir):
    p = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("z"))
    return p.select("user_id", F.explode(F.sequence("a", "z")).alias("day"))


@query("H16_percent_text", """SELECT o_orderpriority, replace(printf('%.1f', round(100.0 * sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) / count(*), 6)), '.', ',') || ' %' AS share FROM orders GROUP BY 1""")
def percent_text(spark, sf_dir):
    out = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.avg((F.col("o_orderstatus") == "F").cast("double")).alias("s"))
    return out.select("o_orderpriority", values.czech_percent(F.col("s")).alias("share"))


@query("H18_array_ops", f"""WITH {FLOWS} SELECT flow, count(DISTINCT recipient) AS n, bool_or(recipient = 1) AS has_one, min(recipient) AS first FROM flows GROUP BY flow""")
def array_ops(spark, sf_dir):
    out = flows(spark, sf_dir).groupBy("flow").agg(F.sort_array(F.collect_set("recipient")).alias("r"))
    return out.select("flow", F.size("r").cast("long").alias("n"), F.array_contains("r", 1).alias("has_one"), F.col("r")[0].alias("first"))


@query("H20_date_agreement", f"""WITH {FLOWS} SELECT flow, line, round(greatest(0.0, 1 - abs(order_day - day) / 30.0), 6) AS score FROM flows""")
def date_agreement(spark, sf_dir):
    return flows(spark, sf_dir).select("flow", "line", F.round(values.date_agreement(F.col("order_day"), F.col("day")), 6).alias("score"))


@query("H21_amount_agreement", """SELECT l_orderkey, l_linenumber, round(CASE WHEN l_extendedprice > 0 THEN greatest(0.0, 1 - abs(l_extendedprice * (1 - l_discount) - l_extendedprice) / l_extendedprice / 0.1,
  1 - abs(l_extendedprice * (1 + l_tax) / 1.21 - l_extendedprice) / l_extendedprice / 0.1, 1 - abs(l_extendedprice * (1 + l_tax) / 1.12 - l_extendedprice) / l_extendedprice / 0.1) ELSE 0.0 END, 6) AS score FROM lineitem""")
def amount_agreement(spark, sf_dir):
    price = F.col("l_extendedprice")
    score = values.amount_agreement(price, price * (1 - F.col("l_discount")), price * (1 + F.col("l_tax")))
    return table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.round(score, 6).alias("score"))
