"""Queries of contract texts, exceptions, attachments and legal limits; their inputs are derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import contract_text as ct
from ..functions import durations, texts
from ..operators import contracts
from .base import query, table

#: Eight kinds of contract text; {} is the price.
_TEXTS = [
    "Kupní cena činí {} Kč bez DPH. Smluvní pokuta činí 700 Kč za den.",
    "Měsíční nájemné {} Kč, splatné předem.",
    "Roční paušál: EUR {}; kauce 1 000,- Kč.",
    "Odměna 350,- za kus, celkem nad 150 000 Kč.",
    "Bez úplaty.",
    "m3 EUR a Kč/m2 {} CZK čtvrtletně za honorář",
    "Celkem\n{} korun",
    "Práce 12 USD/hod, dle odd. 3.4",
]
_P = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)"


def _by_kind(*results: str) -> str:
    """SQL that picks one of eight results by order key; {} is the price."""
    parts = " ".join(f"WHEN {k} THEN " + ("'" + r.replace("{}", f"' || {_P} || '") + "'") for k, r in enumerate(results))
    return f"CASE o_orderkey % 8 {parts} END"


def _found(spark, sf_dir):
    price = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", " ,")
    kinds = F.array(*[F.lit(x) for x in _TEXTS])
    text = F.replace(F.element_at(kinds, (F.col("o_orderkey") % 8 + 1).cast("int")), F.lit("{}"), price)
    return table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("decimal(18,2)").alias("price"), ct.amounts(text).alias("found"))


def _shown(found):
    return F.array_join(F.transform(found, lambda s: F.concat_ws(" ", s["value"].cast("string"), s["currency"])), ",")


@query("X01_amounts", "SELECT o_orderkey, " + _by_kind("{} CZK,700.00 CZK", "{} CZK", "{} EUR,1000.00 CZK", "350.00 CZK,150000.00 CZK", "", "{} CZK", "{} CZK", "12.00 USD") + " AS found FROM orders")
def find_amounts(spark, sf_dir):
    return _found(spark, sf_dir).select("o_orderkey", _shown("found").alias("found"))


@query("X02_prices", "SELECT o_orderkey, " + _by_kind("{} CZK", "{} CZK", "{} EUR", "", "", "{} CZK", "{} CZK", "") + " AS prices FROM orders")
def prices(spark, sf_dir):
    return _found(spark, sf_dir).select("o_orderkey", _shown(ct.prices(F.col("found"))).alias("prices"))


@query("X03_known_value", "SELECT o_orderkey, o_orderkey % 8 IN (0, 1, 2, 5, 6) OR o_orderkey % 8 = 3 AND abs(CAST(o_totalprice AS DECIMAL(18,2)) - 150000) <= 1 AS known FROM orders")
def known_value(spark, sf_dir):
    """The order's price stands in its text, within 1."""
    return _found(spark, sf_dir).select("o_orderkey", ct.holds_value(F.col("found"), F.col("price")).alias("known"))


@query(
    "X09_periodic_amounts",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 8 = 2 THEN CASE WHEN o_totalprice >= 500 THEN " + _P + " || ' EUR,' ELSE '' END || '1000.00 CZK' ELSE '' END AS yearly, "
    "CASE WHEN o_orderkey % 8 = 1 AND o_totalprice >= 500 THEN " + _P + " || ' CZK' ELSE '' END AS monthly, CASE WHEN o_orderkey % 8 = 5 AND o_totalprice >= 500 THEN " + _P + " || ' CZK' ELSE '' END AS quarterly FROM orders",
)
def periodic_amounts(spark, sf_dir):
    got = _found(spark, sf_dir).select("o_orderkey", ct.periodic(F.col("found")).alias("p"))
    return got.select("o_orderkey", *[_shown(F.col(f"p.{n}")).alias(n) for n in ("yearly", "monthly", "quarterly")])


#: Eight kinds of contract text for durations; {} is the price.
_TERMS = [
    "Smlouva o nájmu se uzavírá na dobu neurčitou. Nájemné 1 500 Kč měsíčně.",
    "Služby budou poskytovány po dobu 12 měsíců od podpisu smlouvy. Cena {} Kč bez DPH.",
    "Smlouva o podpoře na dobu tří let. Celková cena činí {} Kč za celou dobu trvání.",
    "Dohoda o dodávkách od 1. 1. 2024 do 31. 12. 2026. Cena {} Kč.",
    "Kupní cena {} Kč.",
    "Záruka na dobu 24 měsíců. Pravidelný servis za 500 Kč / hod.",
    "Předplatné služby na období 6 měsíců, roční poplatek {} Kč a měsíční poplatek 1 000 000 000 Kč.",
    "Pronájem na dobu neurčitou se souhlasem vlastníka. Bez úplaty.",
]


def _terms(spark, sf_dir):
    price = F.translate(F.format_number(F.col("o_totalprice").cast("decimal(18,2)"), 2), ",.", " ,")
    text = F.replace(F.element_at(F.array(*[F.lit(x) for x in _TERMS]), (F.col("o_orderkey") % 8 + 1).cast("int")), F.lit("{}"), price)
    return table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))


@query("X08_durations", "SELECT o_orderkey, CASE WHEN o_orderkey % 8 IN (0, 7) THEN TRUE END AS indefinite, CASE o_orderkey % 8 WHEN 1 THEN 360 WHEN 2 THEN 1095 WHEN 3 THEN 1095 WHEN 6 THEN 180 END AS days, o_orderkey % 8 IN (1, 6) AS continuous FROM orders")
def term_durations(spark, sf_dir):
    return _terms(spark, sf_dir).select("o_orderkey", durations.duration(F.col("text")).alias("d")).select("o_orderkey", "d.*")


@query("X10_annual_value", """WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS k, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS p FROM orders)
SELECT o_orderkey, k <> 4 AS repeated, CASE WHEN k IN (0, 2) THEN 'yes' WHEN k = 1 THEN CASE WHEN p >= 500 THEN 'yes' ELSE 'no' END WHEN k IN (3, 6) THEN 'unclear' WHEN k <> 4 THEN 'no' END AS verdict,
CASE k WHEN 0 THEN 'periodic' WHEN 1 THEN CASE WHEN p >= 500 THEN 'within_a_year' ELSE 'no_price' END WHEN 2 THEN 'total_for_term' WHEN 3 THEN 'years_without_link' WHEN 5 THEN 'unit_prices_only' WHEN 6 THEN 'several_periodic' WHEN 7 THEN 'indefinite_without_period' END AS reason,
CASE WHEN k = 0 THEN 18000.0 WHEN k = 1 AND p >= 500 THEN p WHEN k = 2 THEN round(p / 3, 2) END AS annual FROM o""")
def annual_value(spark, sf_dir):
    return durations.annual_values(_terms(spark, sf_dir), "o_orderkey", "text")


@query("X13_accepted_exceptions", "SELECT o_orderpriority, o_orderkey % 4 IN (0, 1) AS accepted, count(*) AS n FROM orders GROUP BY ALL")
def accepted_exceptions(spark, sf_dir):
    """Exceptions whose proposed verdict is accepted as a category, and those left for a person."""
    verdict = F.element_at(F.array(*[F.lit(x) for x in ("NELZE OVĚŘIT – text není čitelný", "NEJASNÉ: více částek", "NESHODA částky", "JINÉ IČO, NEJASNÉ")]), (F.col("o_orderkey") % 4 + 1).cast("int"))
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", contracts.accepted_as_category(verdict).alias("accepted"))
    return rows.groupBy("o_orderpriority", "accepted").agg(F.count("*").alias("n"))


@query("X14_attachments", "SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN TRUE WHEN 1 THEN FALSE END AS agrees, doc_id % 3 <> 1 AS used, CASE WHEN doc_id % 3 <> 1 THEN sha256(text) END AS stored FROM documents")
def attachments(spark, sf_dir):
    """Texts as attachments, every third with another declared hash and every third with none."""
    docs = table(spark, sf_dir, "documents").select("doc_id", F.encode("text", "utf-8").alias("content"))
    declared = F.when(F.col("doc_id") % 3 == 0, F.upper(F.sha2("content", 256))).when(F.col("doc_id") % 3 == 1, F.sha2(F.concat("content", F.lit(b"x")), 256))
    checked = contracts.with_integrity(docs.withColumn("declared", declared))
    return checked.select("doc_id", "agrees", "used", F.when(F.col("used"), F.col("stored")).alias("stored"))


@query("X15_born_by_transformation", """SELECT c_custkey, bool_or(o_orderkey % 11 IN (0, 1)) AS born FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1""")
def born_by_transformation(spark, sf_dir):
    """Notes of a register on each company; null without a record."""
    note = F.when(F.col("o_orderkey") % 11 == 0, "Společnost vznikla FÚZÍ splynutím").when(F.col("o_orderkey") % 11 == 1, "změnou právní formy").otherwise("změna sídla")
    notes = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), note.alias("note"))
    return contracts.born_by_transformation(table(spark, sf_dir, "customer").select("c_custkey"), notes, "c_custkey")


@query("S16_limits", """WITH y AS (SELECT o_orderpriority AS code, year(o_orderdate) AS y, max(CAST(o_totalprice AS DECIMAL(18,2))) AS value FROM orders GROUP BY ALL)
SELECT code, make_date(y, 1, 1) AS valid_from, CASE WHEN y % 2 = 0 THEN make_date(y, 12, 31) END AS valid_to, CAST(value AS DOUBLE) AS value, CASE WHEN y % 2 = 0 THEN 'bez_dph' END AS vat FROM y""")
def limits(spark, sf_dir):
    """Limits of a methodology document: the largest order of each priority and year, valid in that year or from it on."""
    year = F.year("o_orderdate").alias("y")
    y = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("kod"), year).agg(F.max(F.col("o_totalprice").cast("decimal(18,2)")).alias("hodnota"))
    even = F.col("y") % 2 == 0
    limit = F.struct("kod", F.col("hodnota").cast("string").alias("hodnota"), F.lit("Kč").alias("jednotka"), F.lit("limit").alias("popis"), F.concat("y", F.lit("-01-01")).alias("platnost_od"), F.when(even, F.concat("y", F.lit("-12-31"))).alias("platnost_do"), F.when(even, "bez_dph").alias("dph_rezim"))
    document = y.select(F.to_json(F.struct(F.struct(F.array(limit).alias("limity")).alias("parametry"))).alias("document"))
    return contracts.limits(document).select("code", "valid_from", "valid_to", F.col("value").cast("double").alias("value"), "vat")


@query("S16_ended_limits", "SELECT DISTINCT o_orderpriority || ':' || o_orderstatus AS code, o_orderpriority AS replaced_by FROM orders WHERE o_orderstatus <> 'O'")
def ended_limits(spark, sf_dir):
    """Open limits under an earlier key, each with the one that replaces it."""
    orders = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderstatus") == "O", F.col("o_orderpriority")).otherwise(F.concat_ws(":", "o_orderpriority", "o_orderstatus"))
    stored = orders.select(key.alias("entity"), F.col("o_orderpriority").alias("code")).distinct()
    new = orders.select(F.col("o_orderpriority").alias("code")).distinct()
    return contracts.superseded(stored, new).select(F.col("entity").alias("code"), F.col("code").alias("replaced_by"))


@query("H06_composed_lower", r"SELECT doc_id, md5(lower(nfc_normalize(text || 'A' || chr(769) || ' Č'))) AS digest FROM documents")
def composed_lower(spark, sf_dir):
    text = F.concat("text", F.lit("Á Č"))
    return table(spark, sf_dir, "documents").select("doc_id", F.md5(texts.composed_lower(text)).alias("digest"))
