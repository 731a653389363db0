"""Queries of reports, gates on provenance, samples for control and dimension loads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.texts import company_name
from ..operators import gate, reports, statistics
from .base import FLOWS, flows, query, table
from .scalars import EVALUATIVE_SQL, SENTENCED_SQL, sentenced


@query("A14_run_report", f"""WITH {FLOWS} SELECT 'records' AS metric, o_orderpriority AS part, count(*) AS n FROM flows GROUP BY 2
UNION ALL SELECT 'flows', type, count(DISTINCT flow) FROM flows GROUP BY 2 UNION ALL SELECT 'both_sides', type, count(DISTINCT flow) FROM flows WHERE payer IS NOT NULL AND recipient IS NOT NULL GROUP BY 2
UNION ALL SELECT 'payers', vat, count(DISTINCT payer) FROM flows GROUP BY 2""")
def run_report(spark, sf_dir):
    f = flows(spark, sf_dir)
    part = lambda metric, by, n, df=f: df.groupBy(F.col(by).alias("part")).agg(n.alias("n")).select(F.lit(metric).alias("metric"), "part", "n")
    both = f.where("payer is not null and recipient is not null")
    return part("records", "o_orderpriority", F.count("*")).unionByName(part("flows", "type", F.count_distinct("flow"))).unionByName(part("both_sides", "type", F.count_distinct("flow"), both)).unionByName(part("payers", "vat", F.count_distinct("payer")))


@query("A23_measures", """SELECT l_returnflag AS measure, count(*) AS n, sum(CASE WHEN l_discount > 0.02 THEN 1 ELSE 0 END)::BIGINT AS yes, round(sum(CASE WHEN l_discount > 0.02 THEN 1 ELSE 0 END) / count(*), 4) AS share FROM lineitem GROUP BY 1""")
def measures(spark, sf_dir):
    out = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("measure")).agg(F.count("*").alias("n"), F.sum((F.col("l_discount") > 0.02).cast("long")).alias("yes"))
    return out.withColumn("share", F.round(F.col("yes") / F.col("n"), 4))


@query("A25_recommendation", """WITH m AS (SELECT l_returnflag AS measure, avg(CASE WHEN l_discount > 0.02 THEN 1.0 ELSE 0.0 END) AS share FROM lineitem GROUP BY 1), t(measure, least) AS (VALUES ('A', 0.5), ('R', 0.95), ('X', 0.8)),
b AS (SELECT measure, share IS NULL OR share < least AS short FROM t LEFT JOIN m USING (measure)) SELECT bool_and(NOT short) AS recommended, string_agg(CASE WHEN short THEN measure END, ',' ORDER BY measure) AS missing FROM b""")
def recommendation(spark, sf_dir):
    m = table(spark, sf_dir, "lineitem").groupBy(F.col("l_returnflag").alias("measure")).agg(F.avg((F.col("l_discount") > 0.02).cast("double")).alias("share"))
    return reports.recommendation(m, spark.createDataFrame([("A", 0.5), ("R", 0.95), ("X", 0.8)], "measure string, least double"))


@query("A24_heuristic_check", f"""WITH {FLOWS}, truth AS (SELECT DISTINCT flow AS tender, recipient AS contract FROM flows WHERE type = 'R'), cand AS (SELECT flow AS tender, recipient AS contract, max(amount) AS score FROM flows WHERE l_discount > 0.03 GROUP BY ALL),
best AS (SELECT tender, arg_max(contract, (score, contract)) AS best FROM cand GROUP BY 1)
SELECT count(*) AS n, sum(CASE WHEN c.contract IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS found, sum(CASE WHEN best = t.contract THEN 1 ELSE 0 END)::BIGINT AS ranked_best, sum(CASE WHEN best IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS something
FROM truth t LEFT JOIN cand c ON c.tender = t.tender AND c.contract = t.contract LEFT JOIN best b ON b.tender = t.tender""")
def heuristic_check(spark, sf_dir):
    f = flows(spark, sf_dir).withColumnRenamed("flow", "tender").withColumnRenamed("recipient", "contract")
    truth = f.where("type = 'R'").select("tender", "contract").distinct()
    found = f.where("l_discount > 0.03").groupBy("tender", "contract").agg(F.max("amount").alias("score"))
    return reports.heuristic_check(truth, found)


@query("A30_verdicts", f"""WITH {FLOWS} SELECT flow, CASE WHEN bool_or(type = 'A') THEN 'documented' WHEN bool_or(l_discount > 0.05) THEN 'probable' ELSE 'none' END AS verdict FROM flows GROUP BY flow""")
def verdicts(spark, sf_dir):
    state = F.when(F.col("type") == "A", "documented").when(F.col("l_discount") > 0.05, "probable")
    return reports.verdicts(flows(spark, sf_dir).withColumn("state", state), "flow")


@query("G05_provenance_gate", f"""WITH {FLOWS}, c AS (SELECT flow, line, unnest([CASE WHEN type = 'R' AND flow % 3 = 0 THEN 'SUBSIDY_WITHOUT_DATE' END, CASE WHEN o_orderpriority = '5-LOW' THEN 'DEV_SAMPLE' END, CASE WHEN l_discount > 0.08 THEN 'MATCHING_UNVERIFIED' END]) AS code FROM flows) SELECT * FROM c WHERE code IS NOT NULL""")
def provenance_gate(spark, sf_dir):
    """Subsidies need a date as of which they hold, no development samples, nothing on unverified matching."""
    rows = flows(spark, sf_dir).select("flow", "line", "type", "o_orderpriority", "l_discount", F.when(F.col("flow") % 3 != 0, F.col("day")).alias("as_of"))
    rules = {"SUBSIDY_WITHOUT_DATE": (F.col("type") == "R") & F.col("as_of").isNull(), "DEV_SAMPLE": F.col("o_orderpriority") == "5-LOW", "MATCHING_UNVERIFIED": F.col("l_discount") > 0.08}
    return gate.violations(rows, rules, ["flow", "line"])


@query("G10_text_gate", f"WITH d AS ({SENTENCED_SQL}) SELECT doc_id, 'EVALUATIVE_WORDS' AS code FROM d WHERE " + " OR ".join(EVALUATIVE_SQL.values()))
def text_gate(spark, sf_dir):
    return gate.violations(sentenced(table(spark, sf_dir, "documents")), gate.text_rules("text"), ["doc_id"])


@query("G13_profile", f"""WITH {FLOWS}, s AS (SELECT recipient, type, vat, sum(CASE WHEN l_discount > 0.05 THEN amount ELSE 0 END)::DOUBLE / sum(amount)::DOUBLE AS share FROM flows GROUP BY ALL)
SELECT recipient, sum(CASE WHEN round(share, 4) <= 0.6 THEN 1 ELSE 0 END)::BIGINT AS n_summaries, sum(CASE WHEN round(share, 4) > 0.6 THEN 1 ELSE 0 END)::BIGINT AS n_left_out FROM s GROUP BY 1""")
def profile(spark, sf_dir):
    s = statistics.subject_summary(flows(spark, sf_dir).withColumn("probable", F.col("l_discount") > 0.05))
    return reports.profile_documents(s, "recipient", F.when(F.col("share") > 0.6, "mostly probable")).select("recipient", "n_summaries", "n_left_out")


@query("H04_name_similarity")
def name_similarity(spark, sf_dir):
    """Customer and supplier names of one nation that share the number in them."""
    number = lambda c: F.regexp_extract(c, r"([0-9]+)$", 1).cast("long")
    c = table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation"), "c_name", number("c_name").alias("k"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), "s_name", number("s_name").alias("k"))
    pairs = c.join(s, ["nation", "k"])
    return pairs.select("c_name", "s_name", F.round(reports.name_similarity(company_name(F.col("c_name")), company_name(F.col("s_name"))), 6).alias("score"))


@query("J10_methodology_on_day", """WITH m(code, version, a, z) AS (VALUES ('R', 'v1', DATE '1995-01-01', DATE '1998-06-01'), ('R', 'v2', DATE '1998-06-01', DATE '9999-12-31'), ('A', 'v1', DATE '1995-01-01', DATE '9999-12-31'))
SELECT l_returnflag AS code, version, count(*) AS n FROM lineitem JOIN m ON code = l_returnflag AND CAST(l_shipdate AS DATE) >= a AND CAST(l_shipdate AS DATE) < z GROUP BY 1, 2""")
def methodology_on_day(spark, sf_dir):
    m = spark.createDataFrame([("R", "v1", "1995-01-01", "1998-06-01"), ("R", "v2", "1998-06-01", "9999-12-31"), ("A", "v1", "1995-01-01", "9999-12-31")], "code string, version string, a string, z string")
    m = m.select("code", "version", F.to_date("a").alias("a"), F.to_date("z").alias("z"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("code"), F.to_date("l_shipdate").alias("day"))
    # a methodology register is a short list: a proven bound
    return lines.join(F.broadcast(m), "code").where("day >= a and day < z").groupBy("code", "version").agg(F.count("*").alias("n"))


@query("J12_link_in_page", r"""WITH p AS (SELECT page_id, unnest(list_distinct(regexp_extract_all(html, 'href="/([^"#]+)"', 1))) AS word FROM pages), d AS (SELECT split_part(text, ' ', 1) AS word, count(*) AS n FROM documents GROUP BY 1)
SELECT page_id, count(*) AS links, sum(n)::BIGINT AS cited FROM p JOIN d USING (word) GROUP BY 1""")
def link_in_page(spark, sf_dir):
    """Documents that a page cites: a link's path is a document's first word."""
    found = table(spark, sf_dir, "pages").select("page_id", F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit(r'href="/([^"#]+)"'), F.lit(1)))).alias("word"))
    docs = table(spark, sf_dir, "documents").groupBy(F.split_part("text", F.lit(" "), F.lit(1)).alias("word")).agg(F.count("*").alias("n"))
    return found.join(docs, "word").groupBy("page_id").agg(F.count("*").alias("links"), F.sum("n").alias("cited"))


@query("P22_append_only", "SELECT event_type, user_id, CAST(ts AS DATE) AS day FROM events WHERE event_id % 3 = 0 EXCEPT SELECT event_type, user_id, CAST(ts AS DATE) FROM events WHERE event_id % 3 <> 0")
def append_only(spark, sf_dir):
    events = table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return reports.removed_keys(events.where("event_id % 3 = 0"), events.where("event_id % 3 <> 0"), ["event_type", "user_id", "day"])


@query("P24_flow_keys", f"""WITH {FLOWS}, t AS (SELECT flow, count(DISTINCT line) AS n FROM flows GROUP BY 1) SELECT DISTINCT CASE WHEN n > 1 THEN 'vvz:' || flow || ':' || line ELSE 'vvz:' || flow END AS flow_key FROM flows JOIN t USING (flow)""")
def flow_keys(spark, sf_dir):
    t = flows(spark, sf_dir).groupBy("flow").agg(F.collect_set("line").alias("lots"))
    lot = F.explode(F.when(F.size("lots") > 1, F.col("lots").cast("array<string>")).otherwise(F.array(F.lit(None).cast("string"))))
    return t.select("flow", lot.alias("lot")).select(F.concat_ws(":", F.lit("vvz"), "flow", "lot").alias("flow_key"))


@query("P23_contract_flags", """SELECT c_custkey, c_acctbal > 0 AS has_amount, c_name IS NOT NULL AND c_mktsegment IS NOT NULL AS complete FROM customer""")
def contract_flags(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") > 0).alias("has_amount"), (F.col("c_name").isNotNull() & F.col("c_mktsegment").isNotNull()).alias("complete"))


@query("S19_control_set", """SELECT grp, key, NULL::VARCHAR AS confirmed FROM (SELECT 'order' AS grp, o_orderkey AS key, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS k FROM orders UNION ALL
SELECT 'customer', c_custkey, row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) FROM customer) WHERE k <= 5""")
def control_set(spark, sf_dir):
    o = statistics.first_rows(table(spark, sf_dir, "orders").select("o_orderpriority", F.col("o_orderkey").alias("key")), ["o_orderpriority"], ["key"], 5).select(F.lit("order").alias("grp"), "key")
    c = statistics.first_rows(table(spark, sf_dir, "customer").select("c_mktsegment", F.col("c_custkey").alias("key")), ["c_mktsegment"], ["key"], 5).select(F.lit("customer").alias("grp"), "key")
    return o.unionByName(c).withColumn("confirmed", F.lit(None).cast("string"))


@query("S21_recent_recipients", f"""WITH {FLOWS}, last AS (SELECT max(day) AS d FROM flows), r AS (SELECT recipient, max(day) AS last_day FROM flows GROUP BY 1) SELECT recipient, last_day, s_name AS name FROM r JOIN supplier ON s_suppkey = recipient, last WHERE last_day > d - 365""")
def recent_recipients(spark, sf_dir):
    f = flows(spark, sf_dir)
    # one row: a proven bound
    last = F.broadcast(f.agg(F.max("day").alias("d")))
    r = f.groupBy("recipient").agg(F.max("day").alias("last_day")).join(last).where(F.col("last_day") > F.date_sub("d", 365))
    return r.join(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("recipient"), F.col("s_name").alias("name")), "recipient").select("recipient", "last_day", "name")


@query("S25_register", "SELECT source, min(doc_id) AS first_doc FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id < 10) GROUP BY 1")
def register(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    new = docs.groupBy("source").agg(F.min("doc_id").alias("first_doc"))
    return new.join(docs.where("doc_id < 10").select("source").distinct(), "source", "left_anti")
