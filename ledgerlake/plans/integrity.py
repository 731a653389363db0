"""Queries of integrity rules (P21), run states (S17), logged ends (B03) and samples with reject reasons."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import integrity, versions
from ..operators.statistics import accepted_sample
from ..sources import landing
from .base import query, table
from .jobs import _VERSIONS, _prices
from .normalisation import _checked

_RULES_SQL = f"""WITH {_VERSIONS}, current AS (SELECT *, max(valid_to) OVER (PARTITION BY p_partkey % 50 ORDER BY valid_from, valid_to ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b FROM v WHERE recorded_to = TIMESTAMP '9999-12-31'),
o AS (SELECT o_orderkey AS k FROM orders), l AS (SELECT l_orderkey AS k, l_discount AS d FROM lineitem)
SELECT 'valid_order' AS rule, 0 AS failed, count(*) AS n FROM v UNION ALL SELECT 'recorded_order', 0, count(*) FROM v
UNION ALL SELECT 'entity_overlap', 0, count(*) FROM v UNION ALL SELECT 'company_overlap', (SELECT count(*) FROM current WHERE b > valid_from), count(*) FROM v
UNION ALL SELECT 'company_id_check_digit', count(*) FILTER (WHERE c_custkey % 5 = 0), count(*) FROM customer
UNION ALL SELECT 'both_sides_or_reason', count(*) FILTER (WHERE k % 7 = 0 AND k % 3 <> 0), count(*) FROM o
UNION ALL SELECT 'score_one_if_documented', count(*) FILTER (WHERE (k % 4 = 0) <> (k % 8 = 0)), count(*) FROM o
UNION ALL SELECT 'period_order', count(*) FILTER (WHERE d = 0), count(*) FROM l
UNION ALL SELECT 'conversion_consistent', count(*) FILTER (WHERE k % 6 IN (1, 3)), count(*) FROM l UNION ALL SELECT 'foreign_says_conversion', count(*) FILTER (WHERE k % 6 = 5), count(*) FROM l
UNION ALL SELECT 'subsidy_says_as_of', count(*) FILTER (WHERE k % 3 = 0 AND k % 2 = 0), count(*) FROM l
UNION ALL SELECT 'mirror_is_development_sample', count(*) FILTER (WHERE k % 5 = 0 AND k % 2 = 0), count(*) FROM o
UNION ALL SELECT 'base_and_group', count(*) FILTER (WHERE c_custkey % 9 = 0 OR c_custkey % 4 = 0), count(*) FROM customer"""


@query("P21_integrity_rules", _RULES_SQL)
def integrity_rules(spark, sf_dir):
    """All rules of the data model; the columns break each of them (but the order of times) on known rows."""
    k, c = F.col("k"), F.col("c_custkey")
    v = _prices(spark, sf_dir)[1].withColumn("ico", F.col("p_partkey") % 50)
    customers = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_discount").alias("d"), F.to_date("l_shipdate").alias("day"))
    # conversions by k % 6: home, home but converted, rate, rate without its day, none to be had, unsaid
    kind = k % 6
    amounts = lines.select(
        "k", F.col("day").alias("period_from"), F.when(F.col("d") == 0, F.col("day")).when(k % 2 == 0, F.date_add("day", 30)).alias("period_to"),
        F.when(kind < 2, "CZK").otherwise("EUR").alias("currency"), F.when(kind == 0, "neni_treba").when(kind < 4, "kurz_cnb").when(kind == 4, "kurz_nedostupny").alias("conversion"),
        F.when(kind.isin(1, 2, 3), 1.0).alias("value_czk"), F.when(kind.isin(1, 2, 3), 25.0).alias("rate"), F.when(kind.isin(1, 2), F.col("day")).alias("rate_day"),
        F.when(k % 3 == 0, "dotace_cerpana").otherwise("cena").alias("type"), F.when(k % 2 == 1, F.col("day")).alias("as_of"),
    )
    parts = [
        integrity.report(v, integrity.version_rules()),
        integrity.overlap_report(v, "entity_overlap", ["p_partkey"]),
        integrity.overlap_report(v, "company_overlap", ["ico"]),
        integrity.report(customers.select(F.when(c % 5 == 0, F.lpad((c % 10).cast("string"), 8, "9")).when(c % 5 != 1, _checked(c)).alias("ico")), integrity.subject_rules()),
        integrity.report(orders.select(F.when(k % 7 != 0, k).alias("payer"), k.alias("recipient"), F.when(k % 3 == 0, "x").alias("unnamed_reason")), integrity.flow_rules()),
        integrity.report(orders.select(F.when(k % 4 == 0, "dolozena").otherwise("pravdepodobna").alias("state"), F.when(k % 8 == 0, 1.0).otherwise(0.9).alias("score")), integrity.link_rules()),
        integrity.report(amounts, integrity.amount_rules()),
        integrity.report(orders.select(F.when(k % 5 == 0, "hlidac_statu_rs").otherwise("rs").alias("source"), (k % 2 == 1).alias("development_sample")), integrity.record_rules()),
        integrity.report(customers.select(F.when(c % 9 != 0, c).alias("base"), F.when(c % 4 == 0, F.when(c % 8 == 0, "")).otherwise("g").alias("peer_group")), integrity.result_rules()),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("S17_run_states", """SELECT o_orderkey AS run_id, CAST(o_orderdate AS DATE) AS started, CASE WHEN o_orderkey % 7 = 0 THEN 'nedokonceno' WHEN o_orderkey % 5 = 0 THEN 'preskoceno' WHEN o_orderkey % 3 = 0 THEN 'chyba' ELSE 'uspech' END AS status,
CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 3 = 0 THEN 2 ELSE 0 END END AS n_errors FROM orders""")
def run_states(spark, sf_dir):
    """Orders as runs: some without an end, some whose source was out of reach, some with errors."""
    k = F.col("run_id")
    starts = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("run_id"), F.to_date("o_orderdate").alias("started"))
    errors = F.when(k % 5 == 0, F.array(F.lit("unreachable"))).when(k % 3 == 0, F.array(F.lit("a"), F.lit("b")))
    ends = landing.run_ends(starts.where(k % 7 != 0).select("run_id", (k % 5 != 0).alias("reachable"), errors.alias("errors")))
    return landing.run_overview(starts, ends).select("run_id", "started", "status", "n_errors")


@query("B03_end_log", f"WITH {_VERSIONS} SELECT p_partkey, count(*) AS n_closed, 'merged' AS reason, CASE WHEN p_partkey % 2 = 0 THEN (p_partkey + 1)::VARCHAR ELSE '' END AS replaced_by, 7 AS run FROM v WHERE p_partkey % 3 = 0 AND recorded_to = TIMESTAMP '9999-12-31' GROUP BY 1")
def end_log(spark, sf_dir):
    """Ends of every third part, half of them replaced by another; and of parts that don't exist, which leave no trace."""
    k = F.col("p_partkey")
    ended = table(spark, sf_dir, "part").where(k % 3 == 0).select("p_partkey", F.lit("merged").alias("reason"), F.when(k % 2 == 0, F.array(k + 1)).alias("replaced_by"))
    gone = ended.withColumn("p_partkey", -k - 1)
    log = versions.end_with_log(_prices(spark, sf_dir)[1], ended.unionByName(gone), F.lit("2002-01-01").cast("timestamp"), ["p_partkey"], F.lit(7))[1]
    return log.select("p_partkey", "n_closed", "reason", F.array_join(F.col("replaced_by").cast("array<string>"), ",").alias("replaced_by"), "run")


@query("O11_sample_with_reasons", """WITH d AS (SELECT o_orderkey, md5(o_orderkey::VARCHAR) AS h, CASE WHEN o_orderstatus = 'P' THEN 'open' WHEN o_totalprice < 20000 THEN 'small' END AS reason FROM orders),
c AS (SELECT *, sum(CASE WHEN reason IS NULL THEN 1 ELSE 0 END) OVER (ORDER BY h) AS good FROM d)
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS n FROM c WHERE good < 60 OR good = 60 AND reason IS NULL GROUP BY 1""")
def sample_with_reasons(spark, sf_dir):
    """What was drawn until 60 orders were accepted, in the order of a hash of their key."""
    reject = F.when(F.col("o_orderstatus") == "P", "open").when(F.col("o_totalprice") < 20000, "small")
    drawn = accepted_sample(table(spark, sf_dir, "orders"), [F.md5(F.col("o_orderkey").cast("string").cast("binary")).alias("h"), "o_orderkey"], reject, 60)[1]
    return drawn.select(F.coalesce("reason", F.lit("accepted")).alias("reason"), "n")
