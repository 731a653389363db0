"""Queries of notices, deadlines, conversions and publication marks; their inputs are derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import notices, values
from ..sources import landing
from .base import FLOWS, flows, query, table


def _one_of(*texts: str):
    return F.array(*[F.lit(x) for x in texts])


@query("P05_safe_decimal", "SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) END AS value FROM orders")
def safe_decimal(spark, sf_dir):
    v = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    text = F.when(F.col("o_orderkey") % 4 == 0, F.concat(v, F.lit(" Kč"))).when(F.col("o_orderkey") % 4 == 1, F.concat(v, F.lit("00"))).otherwise(v)
    return table(spark, sf_dir, "orders").select("o_orderkey", values.safe_decimal(text).cast("double").alias("value"))


@query("P20_amount_kind", """SELECT event_id, CASE WHEN user_id % 5 = 0 OR event_type = 'view' AND user_id % 2 = 0 THEN 'INCOMPLETE' WHEN user_id % 5 = 1 THEN 'CURRENCY' ELSE '' END AS faults FROM events""")
def amount_kind(spark, sf_dir):
    currency = F.when(F.col("user_id") % 5 == 1, "Kč").when(F.col("user_id") % 5 != 0, "CZK").otherwise("")
    vat = F.when(~((F.col("event_type") == "view") & (F.col("user_id") % 2 == 0)), "bez_dph")
    faults = notices.amount_kind_faults(F.col("event_type"), currency, vat, F.lit("celkem"))
    return table(spark, sf_dir, "events").select("event_id", F.array_join(faults, ",").alias("faults"))


@query("P09_without_samples", "SELECT o_custkey, max(CAST(o_orderdate AS DATE)) AS newest, count(*) AS n FROM orders WHERE o_orderkey % 10 <> 3 AND o_orderstatus <> 'P' GROUP BY 1")
def without_samples(spark, sf_dir):
    """Records of development samples and annulled notices left out."""
    rows = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("day"), (F.col("o_orderkey") % 10 == 3).alias("dev_sample"), (F.col("o_orderstatus") == "P").alias("annulled"))
    return landing.published(rows).groupBy("o_custkey").agg(F.max("day").alias("newest"), F.count("*").alias("n"))


@query("P27_file_day", """SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_orderdate AS DATE) END AS file_day FROM orders""")
def file_day(spark, sf_dir):
    """The file's date in the note of the run that landed a record."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("run-"), "o_orderkey").alias("run"), F.to_date("o_orderdate").cast("string").alias("day"))
    runs = orders.select("run", F.when(F.col("o_orderkey") % 3 == 0, "{}").otherwise(F.concat(F.lit('{"rows": 5, "datum_souboru": "'), "day", F.lit('"}'))).alias("note"))
    day = F.regexp_extract("note", r'"datum_souboru":\s*"(\d{4}-\d{2}-\d{2})"', 1).try_cast("date")
    return orders.join(runs, "run", "left").select("o_orderkey", day.alias("file_day"))


#: Minimum deadlines of open procedures with their units.
_DEADLINES = [("lhuta_nabidky_nadlimitni_otevrene", 30, "dny"), ("lhuta_nabidky_podlimitni_otevrene_stavby", 20, "pracovni_dny"), ("lhuta_nabidky_podlimitni_otevrene_dodavky_sluzby", 15, "pracovni_dny")]
_PROCEDURES = """d(code, value, unit) AS (VALUES """ + ", ".join(str(x) for x in _DEADLINES) + """),
p AS (SELECT o_orderkey AS tender, o_custkey AS buyer, CAST(o_orderdate AS DATE) AS opened, CAST(o_orderkey % 60 AS INTEGER) AS span, CASE WHEN o_orderstatus = 'P' THEN 'restricted' ELSE 'open' END AS procedure,
  o_totalprice > 150000 AS above, o_orderkey % 3 = 0 AS works, o_orderpriority = '5-LOW' AS early, o_orderpriority = '1-URGENT' AS urgent FROM orders),
c AS (SELECT *, CASE WHEN above THEN 'lhuta_nabidky_nadlimitni_otevrene' WHEN works THEN 'lhuta_nabidky_podlimitni_otevrene_stavby' ELSE 'lhuta_nabidky_podlimitni_otevrene_dodavky_sluzby' END AS code FROM p WHERE procedure = 'open'),
m AS (SELECT c.*, unit, CASE WHEN NOT above AND early THEN value - 5 WHEN above AND NOT works AND (early OR urgent) THEN least(value, 15) ELSE value END AS minimum,
  CASE WHEN NOT above AND early THEN 'zkraceni_54_4' WHEN above AND NOT works AND (early OR urgent) THEN 'zkraceni_57_2' END AS shortening FROM c JOIN d USING (code))"""


def _procedures(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    opened = F.to_date("o_orderdate")
    p = orders.select(
        F.col("o_orderkey").alias("tender"), F.col("o_custkey").alias("buyer"), opened.alias("opened"), F.date_add(opened, (F.col("o_orderkey") % 60).cast("int")).alias("deadline"),
        F.when(F.col("o_orderstatus") == "P", "restricted").otherwise("open").alias("procedure"), (F.col("o_totalprice") > 150000).alias("above"), (F.col("o_orderkey") % 3 == 0).alias("works"),
        (F.col("o_orderpriority") == "5-LOW").alias("early"), (F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
    )
    p = p.withColumn("code", notices.limit_code(F.col("above"), F.col("works")))
    limits = spark.createDataFrame(_DEADLINES, "code string, value int, unit string")
    least = notices.minimum_deadline(*[F.col(c) for c in ("procedure", "above", "works", "early", "urgent", "value", "unit")])
    return p.join(F.broadcast(limits), "code").withColumn("least", least).where("least is not null").withColumns({"shortening": F.col("least.shortening"), "minimum": F.col("least.minimum")})


@query("P19_minimum_deadline", f"WITH {_PROCEDURES} SELECT tender, code, shortening, minimum, unit FROM m")
def minimum_deadline(spark, sf_dir):
    return _procedures(spark, sf_dir).select("tender", "code", "shortening", "minimum", "unit")


_WORKING_SQL = """years AS (SELECT y FROM range(1990, 2031) t(y)),
e1 AS (SELECT y, y % 19 AS a, y // 100 AS b, y % 100 AS c FROM years),
e2 AS (SELECT *, (19*a + b - b//4 - (b - (b+8)//25 + 1)//3 + 15) % 30 AS h FROM e1),
e3 AS (SELECT *, (32 + 2*(b%4) + 2*(c//4) - h - c%4) % 7 AS l FROM e2),
e4 AS (SELECT *, h + l - 7*((a + 11*h + 22*l)//451) + 114 AS z FROM e3),
easter AS (SELECT y, make_date(y, z//31, z%31 + 1) AS easter FROM e4),
days AS (SELECT CAST(x AS DATE) AS day FROM range(DATE '1990-01-01', DATE '2031-01-01', INTERVAL 1 DAY) t(x)),
w AS (SELECT day, CASE WHEN isodow(day) < 6 AND strftime(day, '%m-%d') NOT IN ('01-01','05-01','05-08','07-05','07-06','09-28','10-28','11-17','12-24','12-25','12-26') AND day NOT IN (SELECT easter - 2 FROM easter) AND day NOT IN (SELECT easter + 1 FROM easter) THEN 1 ELSE 0 END AS k FROM days),
n AS (SELECT day, sum(k) OVER (ORDER BY day) AS n FROM w)"""


@query("A04_under_minimum", f"""WITH {_PROCEDURES}, {_WORKING_SQL},
s AS (SELECT buyer, code, CASE WHEN unit = 'pracovni_dny' THEN b.n - a.n ELSE span END < minimum AS short FROM m JOIN n a ON a.day = opened JOIN n b ON b.day = opened + span)
SELECT buyer, code, count(*) AS cases, round(avg(short::INT), 4) AS share FROM s GROUP BY ALL""")
def under_minimum(spark, sf_dir):
    """Share of open procedures whose deadline, in days or working days, is under the legal minimum."""
    p = cal.working_days(_procedures(spark, sf_dir), cal.calendar(spark, "1990-01-01", "2030-12-31"), "opened", "deadline", "worked")
    length = F.when(F.col("unit") == "pracovni_dny", F.col("worked")).otherwise(F.datediff("deadline", "opened"))
    return p.groupBy("buyer", "code").agg(F.count("*").alias("cases"), F.round(F.avg((length < F.col("minimum")).cast("int")), 4).alias("share"))


@query("J12_documented_by_url", """WITH t AS (SELECT o_orderkey AS tender, CASE o_orderkey % 4 WHEN 0 THEN 'https://smlouvy.gov.cz/smlouva/' || (o_orderkey + 1) WHEN 1 THEN 'https://smlouvy.gov.cz/SMLOUVA/9' WHEN 2 THEN 'see smlouva/' || (o_orderkey + 2) || ' and smlouva/' || o_orderkey || ' smlouva/' || o_orderkey ELSE NULL END AS urls FROM orders),
u AS (SELECT tender, unnest(list_distinct(regexp_extract_all(urls, 'smlouva/([0-9]+)', 1)))::BIGINT AS contract FROM t)
SELECT tender, contract FROM u JOIN orders ON o_orderkey = contract""")
def documented_by_url(spark, sf_dir):
    """Notices that cite the id of a contract in a link."""
    k = F.col("o_orderkey")
    urls = F.when(k % 4 == 0, F.concat(F.lit("https://smlouvy.gov.cz/smlouva/"), k + 1)).when(k % 4 == 1, "https://smlouvy.gov.cz/SMLOUVA/9").when(k % 4 == 2, F.concat(F.lit("see smlouva/"), k + 2, F.lit(" and smlouva/"), k, F.lit(" smlouva/"), k))
    orders = table(spark, sf_dir, "orders")
    cited = orders.select(k.alias("tender"), F.explode(F.array_distinct(F.regexp_extract_all(urls, F.lit(r"smlouva/(\d+)"), F.lit(1)))).alias("cited"))
    cited = cited.select("tender", F.col("cited").try_cast("long").alias("contract"))
    return cited.join(orders.select(k.alias("contract")), "contract").select("tender", "contract")


@query("J23_summary_with_lots", f"""WITH {FLOWS}, l AS (SELECT flow AS tender, count(*) AS lots, list(line ORDER BY line) AS numbers, sum(amount) AS price FROM flows WHERE amount > 20000 GROUP BY 1)
SELECT o_orderkey AS tender, o_orderstatus AS state, coalesce(lots, 0) AS lots, coalesce(array_to_string(numbers, ','), '') AS numbers, CAST(price AS DOUBLE) AS price FROM orders LEFT JOIN l ON tender = o_orderkey""")
def summary_with_lots(spark, sf_dir):
    """Summaries with the lots of their details, by the number of the tender; summaries without details stay."""
    lots = flows(spark, sf_dir).where("amount > 20000").groupBy(F.col("flow").alias("tender")).agg(F.count("*").alias("lots"), F.sort_array(F.collect_list("line")).alias("numbers"), F.sum("amount").alias("price"))
    summary = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("tender"), F.col("o_orderstatus").alias("state"))
    out = summary.join(lots, "tender", "left")
    return out.select("tender", "state", F.coalesce("lots", F.lit(0)).alias("lots"), F.coalesce(F.array_join(F.col("numbers").cast("array<string>"), ","), F.lit("")).alias("numbers"), F.col("price").cast("double").alias("price"))


@query("H07_json_path", "SELECT event_id, user_id, event_type AS kind, CASE WHEN user_id % 2 = 0 THEN CAST(value AS DOUBLE) END AS amount FROM events")
def json_path(spark, sf_dir):
    """Values read by path from notices written as JSON."""
    events = table(spark, sf_dir, "events")
    body = F.to_json(F.struct("event_id", F.struct(F.col("user_id").alias("kdo"), F.struct(F.col("event_type").alias("druh"), F.when(F.col("user_id") % 2 == 0, F.col("value")).alias("castka")).alias("vysledek")).alias("data")))
    tree = F.try_parse_json(body)
    read = lambda path, kind: F.try_variant_get(tree, path, kind)
    return events.select(read("$.event_id", "long").alias("event_id"), read("$.data.kdo", "long").alias("user_id"), read("$.data.vysledek.druh", "string").alias("kind"), read("$.data.vysledek.castka", "double").alias("amount"))


@query("H14_months_of_period", """WITH p AS (SELECT user_id, date_trunc('month', min(ts)) AS a, max(CAST(ts AS DATE)) + 1 AS z FROM events GROUP BY 1)
SELECT user_id, strftime(unnest(range(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 MONTH)), '%Y-%m') AS month FROM p""")
def months_of_period(spark, sf_dir):
    """Months that a half-open period touches."""
    p = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("last"))
    first = p.select("user_id", F.explode(F.sequence(F.trunc("a", "month"), F.col("last"), F.expr("interval 1 month"))).alias("first"))
    return first.select("user_id", F.date_format("first", "yyyy-MM").alias("month"))


@query("H16_texts", """SELECT o_orderkey, strftime(CAST(o_orderdate AS DATE), '%-d. %-m. %Y') AS day, replace(replace(replace(format('{:,.2f}', CAST(o_totalprice AS DOUBLE)), ',', ' '), '.', ','), '~', '') AS amount FROM orders""")
def czech_texts(spark, sf_dir):
    """Dates and amounts as Czech texts."""
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format("o_orderdate", "d. M. yyyy").alias("day"), F.translate(F.format_number("o_totalprice", 2), ",.", " ,").alias("amount"))


@query("H23_conversion", """WITH r AS (SELECT user_id % 7 AS currency, CAST(ts AS DATE) AS rate_day, CAST(max(value) AS DECIMAL(18,2)) AS rate FROM events WHERE event_type = 'view' AND user_id % 7 <> 3 GROUP BY ALL),
p AS (SELECT event_id, user_id % 7 AS currency, CAST(ts AS DATE) AS day, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE event_type = 'purchase'),
j AS (SELECT event_id, p.currency, value, CASE WHEN day - rate_day <= 10 THEN rate END AS rate FROM p ASOF LEFT JOIN r ON p.currency = r.currency AND p.day >= r.rate_day)
SELECT event_id, CASE WHEN currency = 0 THEN 'neni_treba' WHEN rate IS NULL THEN 'kurz_nedostupny' ELSE 'kurz_cnb' END AS flag, CASE WHEN currency <> 0 THEN CAST(round_even(value * rate, 2) AS DOUBLE) END AS value_czk FROM j""")
def conversion(spark, sf_dir):
    """Amounts of other currencies at the latest rate of at most ten days before; currency 0 is the home one, 3 has no rates."""
    events = table(spark, sf_dir, "events").withColumn("currency", F.col("user_id") % 7).withColumn("day", F.to_date("ts")).withColumn("value", F.col("value").cast("decimal(18,2)"))
    rates = events.where("event_type = 'view' and currency <> 3").groupBy("currency", F.col("day").alias("rate_day")).agg(F.max("value").alias("rate"))
    paid = landing.rate_as_of(events.where("event_type = 'purchase'").select("event_id", "currency", "day", "value"), rates, "currency", "day")
    got = notices.converted(F.col("value"), F.when(F.col("currency") == 0, "CZK").otherwise("EUR"), F.col("rate"))
    return paid.select("event_id", got["flag"].alias("flag"), got["value_czk"].cast("double").alias("value_czk"))


@query("A26_without_vat_variants", f"""WITH {FLOWS}, b AS (SELECT flow, list_distinct(list(CAST(amount AS DOUBLE))) AS base FROM flows GROUP BY 1)
SELECT flow, len(list_filter(base, lambda w: len(list_filter(base, lambda v: v <> w AND (abs(w - v * 1.21) <= 1 OR abs(w - v * 0.21) <= 1 OR abs(w - v * 1.12) <= 1 OR abs(w - v * 0.12) <= 1))) = 0)) AS n FROM b""")
def vat_variants(spark, sf_dir):
    """Net amounts of a flow, each given bare and, for the first, also with VAT and as VAT."""
    net = flows(spark, sf_dir).groupBy("flow").agg(F.collect_list(F.col("amount").cast("double")).alias("net"))
    return net.select("flow", F.size(notices.net_amounts(F.col("net"))).cast("long").alias("n"))


_MARKS = [" jméno: anonymizováno", " údaje podléhající znečitelnění", " [skryto]", "\n osobní  údaj \nkonec", " XXXXXX", " ■■■", "******", " xxxx", " redigováno dnes", ""]


@query("X07_redaction_marks", """SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 1 WHEN 2 THEN 1 WHEN 3 THEN 1 WHEN 4 THEN 1 WHEN 5 THEN 1 WHEN 6 THEN 1 ELSE 0 END AS marks, source ILIKE '%anonym%' AS by_name FROM documents""")
def redaction_marks(spark, sf_dir):
    """Marks after the last line of each text, one kind or look-alike a document."""
    docs = table(spark, sf_dir, "documents")
    end = F.element_at(_one_of(*_MARKS), (F.col("doc_id") % 10 + 1).cast("int"))
    every = lambda text: F.size(notices.redaction_marks(text, 1_000_000))
    added = every(F.concat("text", F.lit("\n."), end)) - every(F.col("text"))
    return docs.select("doc_id", added.alias("marks"), notices.redacted_name(F.col("source")).alias("by_name"))


@query("G08_unapproved_threshold", f"""WITH {FLOWS}, s AS (SELECT recipient, type, sum(amount) AS volume FROM flows GROUP BY ALL)
SELECT recipient, type FROM s WHERE (volume > 1000000 OR recipient % 7 = 0) AND type <> 'A'""")
def unapproved_threshold(spark, sf_dir):
    """Results marked against a threshold whose values not every version of its method approves."""
    s = flows(spark, sf_dir).groupBy("recipient", "type").agg(F.sum("amount").alias("volume"))
    versions = spark.createDataFrame([("A", "prahy-1", True), ("A", "prahy-2", True), ("N", "prahy-1", True), ("N", "prahy-2", False)], "type string, method string, approved boolean")
    approved = versions.where("method like 'prahy-%'").groupBy("type").agg(F.every("approved").alias("approved"))
    s = s.join(F.broadcast(approved), "type", "left")
    bad = notices.unapproved_threshold(F.col("volume") > 1000000, F.lit(None).cast("double"), F.when(F.col("recipient") % 7 == 0, "p90"), F.col("approved"))
    return s.where(bad).select("recipient", "type")


@query("O04_first_of_each", """SELECT conv_id, array_to_string(list_transform(list_sort(list_transform(map_entries(map_from_entries(list_reverse(l))), lambda e: {'p': e.value, 'r': e.key})), lambda e: e.r), ',') AS roles
FROM (SELECT conv_id, list((role, turn) ORDER BY turn) AS l FROM (SELECT conv_id, role, min(turn) AS turn FROM conversations GROUP BY ALL) GROUP BY 1)""")
def first_of_each(spark, sf_dir):
    """Roles of a conversation, each once, in the order of their first turn."""
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role"))).alias("t"))
    return turns.select("conv_id", F.array_join(F.array_distinct(F.transform("t", lambda x: x["role"])), ",").alias("roles"))
