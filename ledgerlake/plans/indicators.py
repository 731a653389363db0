"""Queries of the indicators (A02-A07, W02, J15) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators as ind
from .base import FLOWS, flows, query, table

_BAND = "CASE WHEN total < 1000000 THEN 'under_1m' WHEN total < 10000000 THEN '1m_10m' WHEN total < 100000000 THEN '10m_100m' ELSE 'over_100m' END"


@query("A02_concentration", f"""
WITH {FLOWS}, recent AS (SELECT * FROM flows WHERE day >= (SELECT CAST(date_trunc('month', max(day)) - INTERVAL 36 MONTH AS DATE) FROM flows)),
pairs AS (SELECT payer, recipient, sum(amount) AS volume, count(*) AS lines FROM recent GROUP BY ALL),
payers AS (SELECT payer, sum(volume) AS total, max(volume) AS largest, CAST(sum(lines) AS BIGINT) AS cases, count(*) AS recipients FROM pairs GROUP BY payer)
SELECT payer, cases, recipients, CAST(total AS DOUBLE) AS total, round(CAST(largest AS DOUBLE) / CAST(total AS DOUBLE), 4) AS share, {_BAND} AS band
FROM payers WHERE total > 0 AND cases >= 5""")
def concentration(spark, sf_dir):
    return ind.concentration(flows(spark, sf_dir))


@query("A03_single_recipient", f"""
WITH {FLOWS}, by_flow AS (SELECT payer, o_orderpriority, flow, count(DISTINCT recipient) AS n FROM flows GROUP BY ALL)
SELECT payer, o_orderpriority, count(*) AS cases, CAST(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) AS BIGINT) AS single,
       round(sum(CASE WHEN n = 1 THEN 1 ELSE 0 END) / count(*), 4) AS share
FROM by_flow GROUP BY payer, o_orderpriority HAVING count(*) >= 5""")
def single_recipient(spark, sf_dir):
    return ind.single_recipient_share(flows(spark, sf_dir))


@query("A05_repeated_recipient", f"""
WITH {FLOWS} SELECT recipient, count(DISTINCT flow) AS cases, min(day) AS first_day, max(day) AS last_day,
  CAST(sum(CASE WHEN type = 'R' THEN amount END) AS DOUBLE) AS granted
FROM flows GROUP BY recipient HAVING count(DISTINCT flow) >= 2""")
def repeated_recipient(spark, sf_dir):
    return ind.repeated_recipient(flows(spark, sf_dir))


@query("A06_new_subject", """
WITH firsts AS (SELECT user_id, min(CASE WHEN event_type = 'signup' THEN CAST(ts AS DATE) END) AS born,
  min(CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END) AS day FROM events GROUP BY user_id)
SELECT user_id, born, day, CAST(day - born AS INTEGER) AS age, (day - born) < 10 AS young FROM firsts WHERE day - born >= 0""")
def new_subject(spark, sf_dir):
    return ind.new_subject(table(spark, sf_dir, "events"))


@query("A07_watched_share", f"""
WITH {FLOWS}, w AS (SELECT DISTINCT s_suppkey FROM supplier WHERE s_acctbal < 0)
SELECT payer, count(*) AS cases, CAST(sum(amount) AS DOUBLE) AS total,
  round(CAST(sum(CASE WHEN s_suppkey IS NOT NULL THEN amount ELSE 0 END) AS DOUBLE) / CAST(sum(amount) AS DOUBLE), 4) AS share
FROM flows LEFT JOIN w ON recipient = s_suppkey GROUP BY payer HAVING sum(amount) <> 0""")
def watched_share(spark, sf_dir):
    watched = table(spark, sf_dir, "supplier").where("s_acctbal < 0").select(F.col("s_suppkey").alias("recipient")).distinct()
    return ind.watched_share(flows(spark, sf_dir), watched)


@query("W02_split_under_limit", f"""
WITH {FLOWS}, small AS (SELECT payer, type AS recipient, day, amount FROM flows WHERE amount < 90000),
runs AS (SELECT payer, recipient, day,
  count(*) OVER w AS n, sum(amount) OVER w AS total FROM small
  WINDOW w AS (PARTITION BY payer, recipient ORDER BY day RANGE BETWEEN CURRENT ROW AND INTERVAL 90 DAY FOLLOWING)),
hits AS (SELECT *, row_number() OVER (PARTITION BY payer, recipient ORDER BY day) AS k FROM runs WHERE n >= 2 AND total >= 90000)
SELECT payer, recipient, day, n, CAST(total AS DOUBLE) AS total FROM hits WHERE k = 1""")
def split_under_limit(spark, sf_dir):
    pairs = flows(spark, sf_dir).select("payer", F.col("type").alias("recipient"), "day", "amount")
    return ind.split_under_limit(pairs, 90_000)


@query("J15_changes_nearby", """
WITH c AS (SELECT DISTINCT user_id, CAST(ts AS DATE) AS day FROM events WHERE event_type = 'purchase'),
h AS (SELECT user_id, CAST(ts AS DATE) AS change_day, event_type AS kind FROM events WHERE event_type IN ('error', 'signup'))
SELECT c.user_id, c.day, string_agg(DISTINCT kind, ',' ORDER BY kind) AS kinds, count(*) AS n
FROM c JOIN h ON c.user_id = h.user_id AND abs(h.change_day - c.day) <= 5 GROUP BY c.user_id, c.day""")
def changes_nearby(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    contracts = events.where("event_type = 'purchase'").select("user_id", "day").distinct()
    changes = events.where("event_type in ('error', 'signup')").select("user_id", F.col("day").alias("change_day"), F.col("event_type").alias("kind"))
    return ind.changes_nearby(contracts, changes, "user_id", 5)
