"""Queries of normalisation runs (B02, B06, B08, B09, J19): grants, decisions and operations made from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import normalise as run
from ..sources import adapters
from ..sources.staging import staged_tables
from .base import LINES, numbered_lines, query, table

_LANDED = ["raw_id", "source", "record", "url", "at", "run", "dev_sample", "payload"]


def _landed(df, source, record, payload, raw_id):
    return df.select(raw_id.cast("long").alias("raw_id"), F.lit(source).alias("source"), record.alias("record"), F.lit("u").alias("url"), F.lit("2026-01-01").cast("timestamp").alias("at"), F.lit(1).cast("long").alias("run"), F.lit(False).alias("dev_sample"), payload.alias("payload"))


def _checked(number):
    """A company id with its check digit: seven digits and (11 - weighted sum mod 11) mod 10."""
    seven = F.lpad(number.cast("string"), 7, "0")
    total = sum((F.substring(seven, k + 1, 1).cast("int") * (8 - k) for k in range(7)), F.lit(0))
    return F.concat(seven, ((F.lit(11) - total % 11) % 10).cast("string"))


_ICO_SQL = "lpad({0}::VARCHAR, 7, '0') || ((11 - (" + " + ".join(f"substr(lpad({{0}}::VARCHAR, 7, '0'), {k + 1}, 1)::INTEGER * {8 - k}" for k in range(7)) + ") % 11) % 10)::VARCHAR"


def _s(*parts):
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def _register(spark, sf_dir):
    """Grants of orders, their recipients the customers (some unlisted or without id), their decisions the lines."""
    lines = numbered_lines(spark, sf_dir)
    orders, customers = (table(spark, sf_dir, t) for t in ("orders", "customer"))
    c, o = F.col("c_custkey"), F.col("o_orderkey")
    ico = F.when(c % 11 == 0, _s("firm ", c)).when(c % 7 != 0, _checked(c))
    people = _landed(customers.where(c % 13 != 0), "red", _s("r/prijemce/", c), F.to_json(F.struct(ico.alias("ico"))), c)
    grant = F.to_json(F.struct(_s("r/dotace/", o).alias("iriDotace"), _s("r/prijemce/", F.col("o_custkey")).alias("iriPrijemce"), F.when(o % 17 != 0, F.to_date("o_orderdate").cast("string")).alias("podpisDatum"), _s("Grant ", o).alias("nazev"), F.lit("1999-01-01T00:00").alias("datumExportu")))
    given = _landed(orders, "red", _s("r/dotace/", o), grant, o + 1_000_000_000)
    decision = F.to_json(F.struct(_s("r/dotace/", F.when(F.col("n") == 7, F.lit(-1)).otherwise(F.col("l_orderkey"))).alias("iriDotace"), F.when(F.col("n") % 5 == 4, "n/a").otherwise(F.col("l_extendedprice").cast("decimal(18,2)").cast("string")).alias("castkaRozhodnuta"), F.lit("1999-01-01").alias("datumExportu")))
    decided = _landed(lines, "red", _s("r/rozhodnuti/", F.col("l_orderkey"), "-", F.col("n")), decision, F.col("l_orderkey") * 100 + F.col("n") + 2_000_000_000)
    return people.unionByName(given).unionByName(decided)


_REGISTER = f"""{LINES},
p AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'firm ' || c_custkey WHEN c_custkey % 7 <> 0 THEN {_ICO_SQL.format('c_custkey')} END AS ico FROM customer WHERE c_custkey % 13 <> 0),
g AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS signed, ico, p.c_custkey IS NOT NULL AS listed, o_custkey FROM orders LEFT JOIN p ON o_custkey = c_custkey WHERE o_orderkey % 17 <> 0),
d AS (SELECT k, signed, n, CASE WHEN n % 5 <> 4 THEN CAST(l_extendedprice AS DECIMAL(18,2)) END AS v FROM lines JOIN g ON k = l_orderkey WHERE n <> 7)"""


@query("J19_grants", f"""WITH {_REGISTER}
SELECT 'r/dotace/' || k AS record, 'red:r/dotace/' || k AS flow, signed, ico AS recipient, NULL::DOUBLE AS amount, CASE WHEN NOT listed THEN 'unlisted' ELSE 'grant' END AS kind FROM g
UNION ALL SELECT 'r/rozhodnuti/' || k || '-' || n, 'red:r/dotace/' || k, signed, NULL, v::DOUBLE, 'decision' FROM d
UNION ALL SELECT 'r/prijemce/' || o_custkey, 'red:r/dotace/' || k, signed, ico, NULL, 'recipient' FROM g WHERE listed""")
def grants(spark, sf_dir):
    """Grant to recipient, decision to grant, recipient to all its grants; dangling references on each side."""
    rows = adapters.grants(_register(spark, sf_dir))
    one = rows.select("record", F.col("flows")[0].alias("f"), F.get(F.col("amounts"), F.lit(0))["value"].cast("double").alias("amount"))
    kind = F.when(F.col("f.recipient_reason").isNotNull(), "unlisted").when(F.col("record").contains("/dotace/"), "grant").when(F.col("record").contains("/rozhodnuti/"), "decision").otherwise("recipient")
    return one.select("record", F.col("f.key").alias("flow"), F.col("f.valid_from").alias("signed"), F.col("f.recipient").alias("recipient"), "amount", kind.alias("kind"))


def _run(spark, sf_dir, records, before=None, number=1, written=False):
    anchor = table(spark, sf_dir, "customer").where("c_custkey % 5 <> 0").select(_checked(F.col("c_custkey")).alias("ico"))
    rates = spark.createDataFrame([], "currency string, rate_day date, rate double")
    return run.normalise(spark, records, anchor, rates, before, F.lit(f"2026-02-{number:02d}").cast("timestamp"), number, written=written)


_KNOWN = "c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 AND c_custkey % 5 <> 0"


@query("B08_flows", f"""WITH {_REGISTER}, x AS (SELECT k, signed, CASE WHEN {_KNOWN.replace('c_custkey', 'o_custkey')} THEN ico END AS recipient, CASE WHEN NOT listed THEN 'příjemce není v raw (tabulka příjemců)' WHEN ico IS NULL OR o_custkey % 11 = 0 THEN 'zdroj IČO neuvádí' ELSE 'IČO nenalezeno v kotvě' END AS why FROM g)
SELECT 'red:r/dotace/' || k AS flow, signed AS valid_from, recipient, 'plátce: poskytovatel je v IS ReD položka číselníku bez IČO' || CASE WHEN recipient IS NULL THEN '; příjemce: ' || why ELSE '' END AS reason, 'Grant ' || k AS subject,
  (SELECT count(*) FROM d WHERE d.k = x.k) + 1 + CASE WHEN why LIKE 'příjemce není%' THEN 0 ELSE 1 END AS links FROM x""")
def normalised_flows(spark, sf_dir):
    """The whole run over the grant register: flows with their recipients as subjects, and their links."""
    out = _run(spark, sf_dir, adapters.grants(_register(spark, sf_dir)))
    subjects = run.current(out, "subject").select(F.col("id").alias("recipient"), "ico")
    links = run.current(out, "link").groupBy(F.col("flow").alias("id")).agg(F.count("*").alias("links"))
    flows = run.current(out, "flow").join(subjects, "recipient", "left").join(links, "id", "left")
    return flows.select(F.col("natural").alias("flow"), "valid_from", F.col("ico").alias("recipient"), "reason", "subject", "links")


@query("B08_exceptions", f"""WITH {_REGISTER}, i AS (SELECT 1000000000 + k AS raw_id, 'prijemce.ico' AS field, ico, o_custkey AS c FROM g WHERE ico IS NOT NULL UNION SELECT o_custkey, 'ico', ico, o_custkey FROM g WHERE ico IS NOT NULL)
SELECT raw_id, field, ico AS value, CASE WHEN c % 11 = 0 THEN 'ico_neplatny_format' ELSE 'ico_nenalezeno_v_kotve' END AS kind FROM i WHERE c % 11 = 0 OR c % 5 = 0""")
def normalised_exceptions(spark, sf_dir):
    out = _run(spark, sf_dir, adapters.grants(_register(spark, sf_dir)))
    return out["exception"].select("raw_id", "field", "value", "kind")


@query("B08_second_run", f"""WITH {_REGISTER}, n AS (SELECT count(*) AS flows, count(*) FILTER (k % 3 = 0 AND k % 2 = 1) AS gone FROM g)
SELECT 'again' AS step, 0::BIGINT AS flows_ended, 0::BIGINT AS links_ended, flows AS flows_now, flows AS flow_versions FROM n UNION ALL SELECT 'moved', gone, gone, flows, flows + gone FROM n""")
def second_run(spark, sf_dir):
    """The same records again write nothing; grants that come under another key end the flows that nothing else gives."""
    landed = _register(spark, sf_dir).where("record not like '%/rozhodnuti/%' and record not like '%/prijemce/%'")
    first = staged_tables(_run(spark, sf_dir, adapters.grants(landed)))
    again = staged_tables(_run(spark, sf_dir, adapters.grants(landed), first, 2))
    number = F.regexp_extract("record", r"([0-9]+)$", 1).cast("long")
    moved = landed.withColumn("payload", F.when((number % 3 == 0) & (number % 2 == 1), F.replace("payload", F.lit('"iriDotace":"r/'), F.lit('"iriDotace":"s/'))).otherwise(F.col("payload")))
    last = _run(spark, sf_dir, adapters.grants(moved), again, 3)

    def counts(step, tables):
        ended = tables["ended"].groupBy().agg(*[F.count(F.when(F.col("table") == t, 1)).alias(f"{t}s_ended") for t in ("flow", "link")])
        versions = tables["flow"].groupBy().agg(F.count(F.when(F.col("recorded_to") >= "9999-01-01", 1)).alias("flows_now"), F.count("*").alias("flow_versions"))
        return ended.join(versions).select(F.lit(step).alias("step"), "flows_ended", "links_ended", "flows_now", "flow_versions")  # one row each

    return counts("again", again).unionByName(counts("moved", last))


@query("B06_last_link", f"""WITH {_REGISTER} SELECT 'red:r/dotace/' || g.k AS flow, count(d.n) AS decisions, NOT (g.k % 3 = 0 AND count(d.n) = 0) AS stays FROM g LEFT JOIN d ON g.k = d.k AND g.k % 2 = 0 GROUP BY g.k""")
def last_link(spark, sf_dir):
    """Every third grant names another flow in its newest version: the old one stays while a decision links to it."""
    landed = _register(spark, sf_dir).where("record not like '%/prijemce/%' and record not rlike '[13579]-[0-9]+$'")  # odd grants have no decisions
    first = staged_tables(_run(spark, sf_dir, adapters.grants(landed)))
    number = F.regexp_extract("record", r"([0-9]+)$", 1).cast("long")
    is_grant = F.col("record").contains("/dotace/")
    moved = landed.withColumn("payload", F.when(is_grant & (number % 3 == 0), F.replace("payload", F.lit('"iriDotace":"r/'), F.lit('"iriDotace":"s/'))).otherwise(F.col("payload")))
    last = _run(spark, sf_dir, adapters.grants(moved), first, 2)
    old = first["flow"].select(F.col("natural").alias("flow"), "id")
    decisions = first["link"].where("natural like '%/rozhodnuti/%'").groupBy(F.col("flow").alias("id")).agg(F.count("*").alias("decisions"))
    now = run.current(last, "flow").select("id", F.lit(True).alias("now"))
    return old.join(decisions, "id", "left").join(now, "id", "left").select("flow", F.coalesce("decisions", F.lit(0)).alias("decisions"), F.col("now").isNotNull().alias("stays"))


def _operations(spark, sf_dir):
    """Operations of lines: projects are orders, tenders in them the odd lines."""
    lines = numbered_lines(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    n, k = F.col("n"), F.col("l_orderkey")
    odd = n % 2 == 1
    fields = {
        "Registrační číslo projektu": _s("P", k), "Název projektu": _s("Project ", k), "IČ příjemce": _checked(F.col("o_custkey")),
        adapters.EU_ACT: F.when(k % 4 != 0, F.to_date("o_orderdate").cast("string")), adapters.EU_AMOUNTS[0][0]: F.col("o_totalprice").cast("decimal(18,2)").cast("string"),
        "Název veřejné zakázky": F.when(odd, _s("Tender ", n)), "IČ dodavatele veřejné zakázky": F.when(odd & (n % 3 != 0), _checked(F.col("l_suppkey"))),
        adapters.EU_SIGNED: F.when(n == 5, "0001-01-01").when(odd, F.to_date("l_shipdate").cast("string")), "Měna": F.when(n != 3, "CZK"), adapters.EU_PRICE: F.when(odd, F.col("l_extendedprice").cast("decimal(18,2)").cast("string")),
    }
    payload = F.to_json(F.struct(*[v.alias(name) for name, v in fields.items()]))
    return _landed(lines, "dotaceeu_2127", _s("P", k, "#", n), payload, k * 100 + n)


@query("B09_operations", f"""WITH {LINES}, l AS (SELECT l_orderkey AS k, n, {_ICO_SQL.format('o_custkey')} AS payer, {_ICO_SQL.format('l_suppkey')} AS supplier, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderdate AS DATE) END AS act, CAST(l_shipdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(18,2)) AS total, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lines JOIN orders ON l_orderkey = o_orderkey)
SELECT 'P' || k || '#' || n AS record, 'dotaceeu_2127:P' || k || CASE WHEN n % 2 = 1 THEN ' dotaceeu_2127:P' || k || '#' || n ELSE '' END AS flows, (total + CASE WHEN n % 2 = 1 THEN price ELSE 0 END)::DOUBLE AS total,
  CASE WHEN act IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN n % 2 = 1 AND n <> 5 THEN 1 ELSE 0 END AS events, coalesce(act, DATE '1999-01-01') AS valid_from, CASE WHEN n % 2 = 1 THEN CASE WHEN n = 5 THEN coalesce(act, DATE '1999-01-01') ELSE day END END AS tender_from,
  payer || CASE WHEN n % 2 = 1 AND n % 3 <> 0 THEN ' ' || supplier ELSE '' END AS ids, CASE WHEN n = 5 THEN 'datum_neplatne' ELSE '' END AS issues FROM l""")
def operations(spark, sf_dir):
    runs = spark.createDataFrame([(1, '{"datum_souboru": "1999-01-01"}')], "run long, note string")
    rows = adapters.operations(_operations(spark, sf_dir), runs)
    names = lambda c, f: F.array_join(F.transform(c, lambda x: x[f]), " ")
    total = F.aggregate("amounts", F.lit(0).cast("decimal(18,2)"), lambda a, x: (a + x["value"]).cast("decimal(18,2)"))
    return rows.select("record", names("flows", "key").alias("flows"), total.cast("double").alias("total"), F.size("events").alias("events"), "valid_from", F.get("flows", F.lit(1))["valid_from"].alias("tender_from"), names("ids", "value").alias("ids"), names("issues", "kind").alias("issues"))


@query("B02_keyed_batch", f"""WITH {LINES}, l AS (SELECT l_orderkey AS k, n, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM lines JOIN orders ON l_orderkey = o_orderkey)
SELECT 'dotaceeu_2127:P' || k || ':{adapters.EU_AMOUNTS[0][0]}' AS natural, 'dotace_priznana' AS type, max(total)::DOUBLE AS value, count(DISTINCT k) AS versions FROM l GROUP BY k
UNION ALL SELECT 'dotaceeu_2127:P' || k || '#' || n || ':{adapters.EU_PRICE}', 'smluvni', price::DOUBLE, 1 FROM l WHERE n % 2 = 1 AND n <> 3""")
def keyed_batch(spark, sf_dir):
    """An amount that several rows of a project repeat is one entity, by its natural key."""
    runs = spark.createDataFrame([(1, '{"datum_souboru": "1999-01-01"}')], "run long, note string")
    out = _run(spark, sf_dir, adapters.operations(_operations(spark, sf_dir), runs))
    return out["amount"].groupBy("natural", "type").agg(F.max("value").cast("double").alias("value"), F.count("*").alias("versions"))
