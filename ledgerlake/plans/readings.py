"""Queries of single bids by CPV division (A03), amounts in trees (P07) and yearly rate files."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.indicators import single_bid_share
from ..sources import files
from .base import LINES, numbered_lines, query, table

_BIDS = f"""WITH {LINES}, o AS (SELECT o_orderkey AS k, o_custkey AS c, CAST(o_orderdate AS DATE) AS day FROM orders),
x AS (SELECT c AS buyer, 'CPV ' || CASE WHEN k % 17 = 0 THEN '??' ELSE (k % 4 + 30)::VARCHAR END AS peer_group, l_suppkey % 3 + 1 AS bids FROM lines JOIN o ON l_orderkey = k WHERE k % 5 <> 0 AND c % 13 <> 0 AND n % 4 <> 0)
SELECT buyer, peer_group, count(*) AS cases, count(*) FILTER (WHERE bids = 1) AS single, round_even(count(*) FILTER (WHERE bids = 1) / count(*), 4) AS share, (SELECT min(day) FROM o) AS period_from, (SELECT max(day) + 1 FROM o) AS period_to FROM x GROUP BY 1, 2"""


@query("A03_single_bids", _BIDS)
def single_bids(spark, sf_dir):
    """Orders as notices, lines as their parts: some are no results, name no buyer or code, or don't know their bids."""
    k, n = F.col("o_orderkey"), F.col("n")
    bids = numbered_lines(spark, sf_dir).groupBy("l_orderkey").agg(F.collect_list(F.when(n % 4 == 0, "n/a").otherwise((F.col("l_suppkey") % 3 + 1).cast("string"))).alias("bids"))
    rows = table(spark, sf_dir, "orders").join(bids, k == F.col("l_orderkey"), "left")
    return single_bid_share(rows.select(F.when(F.col("o_custkey") % 13 != 0, F.col("o_custkey")).alias("buyer"), F.when(k % 17 != 0, F.concat((k % 4 + 30).cast("string"), F.lit("100000"))).alias("cpv"), F.when(k % 5 == 0, "planning").otherwise("result").alias("kind"), F.to_date("o_orderdate").alias("day"), "bids"))


@query("P07_amounts_in_trees", f"""WITH {LINES} SELECT l_orderkey, n, CASE WHEN l_orderkey % 4 = 3 THEN NULL ELSE CAST(l_extendedprice AS DECIMAL(18,2))::DOUBLE END AS value, CASE WHEN l_orderkey % 4 = 1 THEN 'EUR' END AS currency FROM lines""")
def amounts_in_trees(spark, sf_dir):
    """A scalar, an object with a currency, an object without one, and no number at all."""
    k, price = F.col("l_orderkey"), F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    inner = F.when(k % 4 == 0, F.concat(F.lit('"'), price, F.lit('"'))).when(k % 4 == 1, F.concat(F.lit('{"_value": '), price, F.lit(', "_currencyID": "EUR"}'))).when(k % 4 == 2, F.concat(F.lit('{"_value": "'), price, F.lit('"}'))).otherwise('{"_value": "on request", "_currencyID": "EUR"}')
    found = files.amount_of(F.parse_json(inner))
    return numbered_lines(spark, sf_dir).select("l_orderkey", "n", found.alias("x")).select("l_orderkey", "n", F.col("x.value").cast("double").alias("value"), F.col("x.currency").alias("currency"))


@query("S14_rate_files", """WITH o AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS rate_day FROM orders)
SELECT 'EUR' AS currency, rate_day, 20 + (k % 100) / 10.0::DOUBLE AS rate FROM o WHERE k % 11 <> 0 UNION ALL SELECT CASE WHEN k < 1000 THEN 'HUF' ELSE 'USD' END, rate_day, CASE WHEN k < 1000 THEN (k % 7 + 0.5::DOUBLE) / 100 ELSE k % 7 + 0.5::DOUBLE END FROM o""")
def rate_files(spark, sf_dir):
    """A file a year with an order a line; the header comes again before the thousandth key, with other columns in another order."""
    k = F.col("o_orderkey")
    day = F.to_date("o_orderdate")
    euro = F.when(k % 11 == 0, "").otherwise(F.concat((F.lit(20) + F.floor(k % 100 / 10)).cast("string"), F.lit(","), (k % 10).cast("string")))
    other = F.concat((k % 7).cast("string"), F.lit(",5"))
    line = F.concat_ws("|", F.date_format(day, "dd.MM.yyyy"), F.when(k < 1000, euro).otherwise(other), F.when(k < 1000, other).otherwise(euro))
    orders = table(spark, sf_dir, "orders")
    rows = orders.select(F.year(day).alias("year"), (k * 2 + 2).alias("line_no"), line.alias("line"))
    heads = F.array(F.struct(F.lit(0).cast("long").alias("line_no"), F.lit("Datum|1 EUR|100 HUF").alias("line")), F.struct(F.lit(2001).cast("long").alias("line_no"), F.lit("datum|1 USD|1 EUR").alias("line")))
    return files.yearly_rates(rows.unionByName(orders.select(F.year(day).alias("year")).distinct().select("year", F.explode(heads).alias("h")).select("year", "h.*")))
