"""Queries of aggregations, windows, sorts and samples (A, W, O rows)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.values import wilson
from ..operators import statistics as st
from .base import FLOWS, flows, query, table


@query("A01_typed_sum", f"""WITH {FLOWS} SELECT type, vat, CAST(sum(amount) AS DOUBLE) AS total, count(*) AS n FROM flows GROUP BY type, vat""")
def typed_sum(spark, sf_dir):
    return st.typed_sum(flows(spark, sf_dir), ["type", "vat"], "amount")


@query("A09_payer_coverage", f"""WITH {FLOWS} SELECT payer, o_orderpriority, type, min(day) AS first_day, max(day) AS last_day, count(DISTINCT flow) AS n_flows FROM flows GROUP BY ALL""")
def payer_coverage(spark, sf_dir):
    return flows(spark, sf_dir).groupBy("payer", "o_orderpriority", "type").agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count_distinct("flow").alias("n_flows"))


@query("A10_subject_summary", f"""WITH {FLOWS}, s AS (SELECT recipient, type, vat, count(DISTINCT flow) AS n_flows, count(*) AS n, sum(amount) AS total,
  sum(CASE WHEN l_discount > 0.05 THEN amount ELSE 0 END) AS heuristic, min(day) AS as_of FROM flows GROUP BY recipient, type, vat)
SELECT recipient, type, vat, n_flows, n, CAST(total AS DOUBLE) AS total, round(CAST(heuristic AS DOUBLE) / CAST(total AS DOUBLE), 4) AS share, as_of,
  CASE WHEN CAST(heuristic AS DOUBLE) / CAST(total AS DOUBLE) > 0.05 THEN CAST(total - heuristic AS DOUBLE) END AS low, CASE WHEN CAST(heuristic AS DOUBLE) / CAST(total AS DOUBLE) > 0.05 THEN CAST(total AS DOUBLE) END AS high FROM s""")
def subject_summary(spark, sf_dir):
    return st.subject_summary(flows(spark, sf_dir).withColumn("probable", F.col("l_discount") > 0.05))


@query("A11_merge_flows", f"""WITH {FLOWS} SELECT flow, min(day) AS first_day, (min({{'l': line, 'r': recipient}}) FILTER (recipient % 3 <> 0)).r AS recipient, count(DISTINCT recipient) > 1 AS several FROM flows GROUP BY flow""")
def merge_flows(spark, sf_dir):
    known = F.when(F.col("recipient") % 3 != 0, F.struct("line", "recipient"))
    return flows(spark, sf_dir).groupBy("flow").agg(F.min("day").alias("first_day"), F.min(known)["recipient"].alias("recipient"), (F.count_distinct("recipient") > 1).alias("several"))


@query("A12_lots_per_tender", f"""WITH {FLOWS} SELECT flow, string_agg(DISTINCT CAST(line AS VARCHAR), ',' ORDER BY CAST(line AS VARCHAR)) AS lots FROM flows GROUP BY flow HAVING count(DISTINCT line) > 1""")
def lots_per_tender(spark, sf_dir):
    lots = F.sort_array(F.collect_set(F.col("line").cast("string")))
    return flows(spark, sf_dir).groupBy("flow").agg(lots.alias("l")).where(F.size("l") > 1).select("flow", F.array_join("l", ",").alias("lots"))


@query("A13_earliest_signing", f"WITH {FLOWS} SELECT flow, min(day) AS day FROM flows GROUP BY flow")
def earliest_signing(spark, sf_dir):
    return flows(spark, sf_dir).groupBy("flow").agg(F.min("day").alias("day"))


@query("A16_field_completeness", """WITH f AS (SELECT lang, source IS NOT NULL AS source, n_chars > 500 AS long_text, text LIKE '%@%' AS email FROM documents),
a AS (SELECT lang AS frame, * EXCLUDE lang FROM f UNION ALL SELECT 'all', * EXCLUDE lang FROM f),
g AS (SELECT frame, count(*) AS n, sum(source::INT)::BIGINT AS source, sum(long_text::INT)::BIGINT AS long_text, sum(email::INT)::BIGINT AS email FROM a GROUP BY frame)
SELECT frame, n, field, filled FROM g UNPIVOT (filled FOR field IN (source, long_text, email))""")
def field_completeness(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("lang", F.col("source").isNotNull().alias("source"), (F.col("n_chars") > 500).alias("long_text"), F.col("text").contains("@").alias("email"))
    return st.completeness(docs, "lang", ["source", "long_text", "email"])


@query("A17_wilson", """WITH g AS (SELECT event_type, sum(CASE WHEN value > 50 THEN 1 ELSE 0 END)::DOUBLE AS k, count(*)::DOUBLE AS m FROM events GROUP BY 1), z AS (SELECT *, 1.959963984540054 AS z, k / m AS p FROM g)
SELECT event_type, round(p, 6) AS share, round(CASE WHEN k = 0 THEN 0 ELSE greatest(0, ((p + z*z/(2*m)) - z*sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m)) END, 6) AS low,
round(CASE WHEN k = m THEN 1 ELSE least(1, ((p + z*z/(2*m)) + z*sqrt(p*(1-p)/m + z*z/(4*m*m))) / (1 + z*z/m)) END, 6) AS high FROM z""")
def wilson_interval(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum(F.when(F.col("value") > 50, 1).otherwise(0)).alias("k"), F.count("*").alias("m"))
    x = wilson(F.col("k"), F.col("m"))
    return g.select("event_type", x.alias("x")).select("event_type", *[F.round(f"x.{c}", 6).alias(c) for c in ("share", "low", "high")])


@query("A18_percentile", """SELECT o_orderpriority, round(quantile_cont(o_totalprice, 0.9), 4) AS p90 FROM orders GROUP BY 1""")
def percentile(spark, sf_dir):
    p = st.percentiles(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice", [0.9])
    return p.select("o_orderpriority", F.round(F.col("p")[0], 4).alias("p90"))


@query("A19_distribution", """WITH x AS (SELECT o_orderpriority AS grp, o_totalprice AS v FROM orders UNION ALL SELECT 'all', o_totalprice FROM orders)
SELECT grp, count(*) AS n, round(quantile_cont(v, 0.5), 4) AS p50, round(quantile_cont(v, 0.75), 4) AS p75, round(quantile_cont(v, 0.9), 4) AS p90, round(quantile_cont(v, 0.95), 4) AS p95 FROM x GROUP BY grp""")
def distribution(spark, sf_dir):
    return st.distribution(table(spark, sf_dir, "orders"), "o_orderpriority", "o_totalprice")


@query("A20_thresholds", """WITH g AS (SELECT o_custkey % 50 AS grp, count(*) AS n, quantile_cont(o_totalprice, 0.9) AS p FROM orders GROUP BY 1), a AS (SELECT quantile_cont(o_totalprice, 0.9) AS p FROM orders)
SELECT grp, n, round(CASE WHEN n >= 30 THEN g.p ELSE a.p END, 4) AS threshold, n >= 30 AS own FROM g, a""")
def thresholds(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumn("grp", F.col("o_custkey") % 50)
    return st.thresholds(orders, "grp", "o_totalprice")


@query("A21_frame_composition", """SELECT lang || '/' || CASE WHEN text LIKE '%@%' THEN 'contact' ELSE 'none' END AS kind, count(*) AS n FROM documents GROUP BY 1""")
def frame_composition(spark, sf_dir):
    kind = F.concat_ws("/", "lang", F.when(F.col("text").contains("@"), "contact").otherwise("none"))
    return table(spark, sf_dir, "documents").groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


@query("A22_last_before_export", f"""WITH {FLOWS} SELECT recipient, max(CASE WHEN day <= DATE '2000-01-01' THEN day END) AS last_day, sum(CASE WHEN day > DATE '2000-01-01' THEN 1 ELSE 0 END)::BIGINT AS later FROM flows GROUP BY recipient""")
def last_before_export(spark, sf_dir):
    export = F.lit("2000-01-01").cast("date")
    return flows(spark, sf_dir).groupBy("recipient").agg(F.max(F.when(F.col("day") <= export, F.col("day"))).alias("last_day"), F.sum((F.col("day") > export).cast("long")).alias("later"))


@query("A27_latest_scalar", "SELECT max(CAST(l_shipdate AS DATE)) AS last_day, CAST(date_trunc('month', max(l_shipdate)) AS DATE) AS month FROM lineitem")
def latest_scalar(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").agg(F.max(F.to_date("l_shipdate")).alias("last_day"), F.trunc(F.max("l_shipdate"), "month").alias("month"))


@query("A28_string_agg", "SELECT n_regionkey, string_agg(n_name, ',' ORDER BY n_name) AS names FROM nation GROUP BY 1")
def string_agg(spark, sf_dir):
    return table(spark, sf_dir, "nation").groupBy("n_regionkey").agg(F.array_join(F.sort_array(F.collect_list("n_name")), ",").alias("names"))


@query("A29_period", "SELECT event_type, min(CAST(ts AS DATE)) AS start, max(CAST(ts AS DATE)) + 1 AS stop FROM events GROUP BY 1")
def period(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy("event_type").agg(F.min(F.to_date("ts")).alias("start"), F.date_add(F.max(F.to_date("ts")), 1).alias("stop"))


@query("W01_latest_version", "SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) WHERE k = 1")
def latest_version(spark, sf_dir):
    """The newest row of a user: an aggregation, so that a busy user needs no sort of all its rows."""
    newest = F.max_by(F.struct("event_id", "event_type"), F.struct("ts", "event_id"))
    return table(spark, sf_dir, "events").groupBy("user_id").agg(newest.alias("x")).select("user_id", "x.*")


@query("W03_best_candidate", f"""WITH {FLOWS} SELECT flow, line, score FROM (SELECT flow, line, greatest(0.0, 1 - abs(order_day - day) / 3000.0) AS score, row_number() OVER (PARTITION BY flow ORDER BY greatest(0.0, 1 - abs(order_day - day) / 3000.0) DESC, line) AS k FROM flows) WHERE k = 1""")
def best_candidate(spark, sf_dir):
    score = F.greatest(F.lit(0.0), 1 - F.abs(F.datediff("order_day", "day")) / 3000.0)
    best = F.max_by(F.struct("line", "score"), F.struct("score", -F.col("line")))
    return flows(spark, sf_dir).withColumn("score", score).groupBy("flow").agg(best.alias("x")).select("flow", "x.*")


@query("W04_first_n", "SELECT o_orderpriority, o_orderkey, k FROM (SELECT o_orderpriority, o_orderkey, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders) WHERE k <= 5")
def first_n(spark, sf_dir):
    return st.first_rows(table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey"), ["o_orderpriority"], ["o_orderkey"], 5)


@query("W05_sequential_ids", "SELECT printf('V%03d', row_number() OVER (ORDER BY n_regionkey, n_name)) AS id, n_name FROM nation")
def sequential_ids(spark, sf_dir):
    """Numbers over a dimension table, whose size doesn't grow with the facts."""
    return table(spark, sf_dir, "nation").select(F.format_string("V%03d", F.row_number().over(W.orderBy("n_regionkey", "n_name"))).alias("id"), "n_name")


@query("W06_overlaps", f"""WITH {FLOWS}, v AS (SELECT flow, line, day AS valid_from, day + 30 AS valid_to FROM flows), o AS (SELECT *, max(valid_to) OVER (PARTITION BY flow ORDER BY valid_from, line ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v)
SELECT flow, line, valid_from FROM o WHERE before > valid_from""")
def overlaps(spark, sf_dir):
    v = flows(spark, sf_dir).select("flow", "line", F.col("day").alias("valid_from"), F.date_add("day", 30).alias("valid_to"))
    before = F.max("valid_to").over(W.partitionBy("flow").orderBy("valid_from", "line").rowsBetween(W.unboundedPreceding, -1))
    return v.withColumn("before", before).where("before > valid_from").select("flow", "line", "valid_from")


@query("W07_header_carried", "SELECT conv_id, turn, max(CASE WHEN role = 'user' THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS header FROM conversations")
def header_carried(spark, sf_dir):
    over = W.partitionBy("conv_id").orderBy("turn").rowsBetween(W.unboundedPreceding, 0)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.last(F.when(F.col("role") == "user", F.col("turn")), ignorenulls=True).over(over).alias("header"))


@query("O01_sort", "SELECT s_nationkey, s_suppkey, s_acctbal FROM supplier ORDER BY s_nationkey, s_acctbal DESC, s_suppkey")
def sort(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_acctbal").orderBy("s_nationkey", F.desc("s_acctbal"), "s_suppkey")


@query("O02_top3", "SELECT l_orderkey, list_aggregate(list_slice(list_reverse_sort(list(CAST(l_extendedprice AS DECIMAL(18,2)))), 1, 3), 'sum')::DOUBLE AS top3 FROM lineitem GROUP BY 1")
def top3(spark, sf_dir):
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    top = F.slice(F.sort_array(F.collect_list(price), asc=False), 1, 3)
    return table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.aggregate(top, F.lit(0).cast("decimal(38,2)"), lambda a, x: (a + x).cast("decimal(38,2)")).cast("double").alias("top3"))


@query("O03_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25")
def limit(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(25)


@query("O04_ordered_distinct", "SELECT conv_id, role, min(turn) AS first_turn FROM conversations GROUP BY 1, 2")
def ordered_distinct(spark, sf_dir):
    return table(spark, sf_dir, "conversations").groupBy("conv_id", "role").agg(F.min("turn").alias("first_turn"))


@query("O05_union", "SELECT 'customer' AS kind, c_custkey AS key, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_name FROM supplier")
def union(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    return c.unionByName(table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_suppkey").alias("key"), F.col("s_name").alias("name")))


@query("O06_difference", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def difference(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("c_custkey"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(done, "c_custkey", "left_anti")


@query("O07_intersection", f"""WITH {FLOWS}, a AS (SELECT recipient, payer FROM flows WHERE type = 'A'), r AS (SELECT recipient, payer FROM flows WHERE type = 'R') SELECT recipient, count(DISTINCT a.payer) AS n FROM a JOIN r USING (recipient, payer) GROUP BY recipient""")
def intersection(spark, sf_dir):
    f = flows(spark, sf_dir).select("recipient", "payer", "type")
    both = f.where("type = 'A'").select("recipient", "payer").intersect(f.where("type = 'R'").select("recipient", "payer"))
    return both.groupBy("recipient").agg(F.count("*").alias("n"))


@query("O08_duplicate_keys", "SELECT o_custkey, CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return table(spark, sf_dir, "orders").groupBy("o_custkey", F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n")).where("n > 1")


@query("O09_hash_sample", "SELECT o_orderkey FROM orders ORDER BY sha256('seed:p1:' || CAST(o_orderkey AS VARCHAR)), o_orderkey LIMIT 60")
def hash_sample(spark, sf_dir):
    return st.hash_sample(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey", "p1", 60)


@query("O10_one_per_group", "SELECT grp, min(o_orderkey) AS o_orderkey FROM (SELECT o_orderkey // 4 AS grp, o_orderkey FROM orders WHERE o_orderstatus = 'F') GROUP BY grp ORDER BY sha256('seed:p1:' || CAST(grp AS VARCHAR)), grp LIMIT 60")
def one_per_group(spark, sf_dir):
    one = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.floor(F.col("o_orderkey") / 4).alias("grp")).agg(F.min("o_orderkey").alias("o_orderkey"))
    return st.hash_sample(one, "grp", "p1", 60)


@query("O11_reject_reasons", "SELECT CASE WHEN o_orderstatus = 'P' THEN 'open' WHEN o_totalprice < 20000 THEN 'small' ELSE 'accepted' END AS reason, count(*) AS n FROM orders GROUP BY 1")
def reject_reasons(spark, sf_dir):
    reason = F.when(F.col("o_orderstatus") == "P", "open").when(F.col("o_totalprice") < 20000, "small").otherwise("accepted")
    return table(spark, sf_dir, "orders").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))
