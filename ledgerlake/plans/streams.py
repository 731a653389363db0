"""Queries of streams and work lists (R01, R02) and of trees of any depth."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..sources import files
from ..sources.staging import shared_folder
from ..streaming import landing
from .base import query, table


@query("R01_stream_landing", "SELECT CAST(ts AS DATE)::VARCHAR AS day, event_type, count(DISTINCT event_id) AS n FROM events GROUP BY ALL")
def stream_landing(spark, sf_dir):
    """All events, and every third once more, landed by two runs of one stream: each id once."""
    base = f"{shared_folder(spark)}/landing-{uuid.uuid4().hex}"
    events = table(spark, sf_dir, "events").select("event_id", "event_type", F.to_date("ts").alias("day"))
    events.where("event_id % 2 = 0").write.parquet(f"{base}/in")
    stream = lambda: landing.land_stream(spark, spark.readStream.schema(events.schema).parquet(f"{base}/in"), f"{base}/out", f"{base}/check", ["event_id"], "day").awaitTermination()
    stream()
    events.where("event_id % 2 = 1 or event_id % 3 = 0").write.mode("append").parquet(f"{base}/in")
    stream()
    landed = spark.read.schema(events.schema).parquet(f"{base}/out")
    return landed.groupBy(F.col("day").cast("string").alias("day"), "event_type").agg(F.count("*").alias("n"))


@query("R02_work_list", """WITH a AS (SELECT user_id % 997 AS item, count(*) AS attempts, max(CASE WHEN event_type = 'purchase' THEN ts END) AS done_at, max(ts) AS last_at FROM events WHERE event_id % 5 = 0 GROUP BY 1), i AS (SELECT DISTINCT o_custkey % 1200 AS item FROM orders)
SELECT item::VARCHAR AS item, coalesce(attempts, 0) AS attempts, CASE WHEN done_at IS NOT NULL THEN 'done' WHEN attempts IS NULL THEN 'open' WHEN attempts > 3 THEN 'given_up' ELSE 'failed' END AS state,
  CASE WHEN done_at IS NULL AND attempts <= 3 THEN epoch(date_trunc('second', last_at))::BIGINT + CASE attempts WHEN 1 THEN 30 WHEN 2 THEN 60 ELSE 120 END END AS next_at FROM i LEFT JOIN a USING (item)""")
def work_list(spark, sf_dir):
    items = table(spark, sf_dir, "orders").select((F.col("o_custkey") % 1200).cast("string").alias("item")).distinct()
    tried = table(spark, sf_dir, "events").where("event_id % 5 = 0").select((F.col("user_id") % 997).cast("string").alias("item"), F.col("ts").alias("at"), (F.col("event_type") == "purchase").alias("ok"))
    return landing.work_states(items, tried).select("item", "attempts", "state", F.unix_timestamp("next_at").alias("next_at"))


@query("S08_values_of_key", """WITH n AS (SELECT c_custkey, c_custkey % 40 AS depth FROM customer) SELECT c_custkey, 'v' || depth AS value, 1 + depth AS at_level FROM n UNION ALL SELECT c_custkey, unnest(['a', 'b']), 2 FROM n""")
def values_of_key(spark, sf_dir):
    """A value up to 39 objects deep, and a list of two under the same key: none is lost, whatever the depth."""
    depth = (F.col("c_custkey") % 40).cast("int")
    deep = F.concat(F.repeat(F.lit('{"x":'), depth), F.lit('{"k":"v'), depth.cast("string"), F.lit('"}'), F.repeat(F.lit("}"), depth))
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.concat(F.lit('{"deep":'), deep, F.lit(',"k":["a","b"],"n":{"other":1}}')).alias("payload"))
    found = files.values_of_key(rows, "c_custkey", "payload", "k")
    level = F.when(F.col("value").isin("a", "b"), 2).otherwise(F.size(F.split("place", "/")) - 2)
    return found.select(F.col("id").alias("c_custkey"), "value", level.cast("long").alias("at_level"))
