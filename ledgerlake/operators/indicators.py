"""Indicators over flows; each is one or two grouped aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.values import size_band


def concentration(flows: DataFrame, months: int = 36, min_cases: int = 5) -> DataFrame:
    """Share of the largest recipient in a payer's volume over the months up to the last day; payers with few flows left out."""
    last = flows.agg(F.add_months(F.trunc(F.max("day"), "month"), -months).alias("start"))
    recent = flows.join(F.broadcast(last), F.col("day") >= F.col("start"))
    by_pair = recent.groupBy("payer", "recipient").agg(F.sum("amount").alias("volume"), F.count("*").alias("lines"))
    out = by_pair.groupBy("payer").agg(F.sum("volume").alias("total"), F.max("volume").alias("largest"), F.sum("lines").alias("cases"), F.count("*").alias("recipients"))
    return out.where((F.col("total") > 0) & (F.col("cases") >= min_cases)).select("payer", "cases", "recipients", F.col("total").cast("double").alias("total"), F.round(F.col("largest").cast("double") / F.col("total").cast("double"), 4).alias("share"), size_band(F.col("total")).alias("band"))


def single_recipient_share(flows: DataFrame, min_cases: int = 5) -> DataFrame:
    """Of a payer's flows in a class, the share with one recipient only."""
    by_flow = flows.groupBy("payer", "o_orderpriority", "flow").agg((F.min("recipient") == F.max("recipient")).alias("one"))
    out = by_flow.groupBy("payer", "o_orderpriority").agg(F.count("*").alias("cases"), F.count_if("one").alias("single"))
    return out.where(F.col("cases") >= min_cases).withColumn("share", F.round(F.col("single") / F.col("cases"), 4))


def single_bid_share(results: DataFrame) -> DataFrame:
    """Per buyer and CPV division (two digits, ``??`` without a code) the parts of result notices with a single bid.

    Read: buyer, cpv, kind, day, bids (array of counts as text, one a part); only
    counts that are known numbers count.  Notices that are no results or name no
    buyer are left out; groups without a known count give no row.  The period is
    that of all notices read, results or not, its end the day after the last one.
    """
    division = F.coalesce(F.nullif(F.left("cpv", F.lit(2)), F.lit("")), F.lit("??"))
    period = results.agg(F.min("day").alias("period_from"), F.date_add(F.max("day"), 1).alias("period_to"))
    bids = results.where("kind = 'result' and buyer is not null").select("buyer", F.concat(F.lit("CPV "), division).alias("peer_group"), F.explode("bids").alias("bid")).withColumn("n", F.col("bid").try_cast("int")).where("n is not null")
    out = bids.groupBy("buyer", "peer_group").agg(F.count("*").alias("cases"), F.count_if(F.col("n") == 1).alias("single"))
    # one row: a proven bound
    return out.withColumn("share", F.bround(F.col("single") / F.col("cases"), 4)).crossJoin(F.broadcast(period))


def repeated_recipient(flows: DataFrame, min_cases: int = 2) -> DataFrame:
    """A recipient's distinct flows, first and last day, and the sum over granted amounts alone."""
    granted = F.when(F.col("type") == "R", F.col("amount"))
    out = flows.groupBy("recipient").agg(F.count_distinct("flow").alias("cases"), F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.sum(granted).cast("double").alias("granted"))
    return out.where(F.col("cases") >= min_cases)


def new_subject(events: DataFrame, young_days: int = 10) -> DataFrame:
    """Age of a user at the first purchase since the first sign-up; negative ages and users without one left out."""
    first = lambda kind: F.min(F.when(F.col("event_type") == kind, F.to_date("ts")))
    out = events.groupBy("user_id").agg(first("signup").alias("born"), first("purchase").alias("day"))
    out = out.withColumn("age", F.datediff("day", "born")).where("age >= 0")
    return out.withColumn("young", F.col("age") < young_days)


def watched_share(flows: DataFrame, watched: DataFrame) -> DataFrame:
    """Share of a payer's volume at watched recipients."""
    tagged = flows.join(watched.select("recipient", F.lit(True).alias("hit")), "recipient", "left")
    out = tagged.groupBy("payer").agg(F.count("*").alias("cases"), F.sum("amount").alias("total"), F.sum(F.when(F.col("hit"), F.col("amount")).otherwise(0)).alias("inside"))
    return out.where("total <> 0").select("payer", "cases", F.col("total").cast("double").alias("total"), F.round(F.col("inside").cast("double") / F.col("total").cast("double"), 4).alias("share"))


def split_under_limit(flows: DataFrame, limit: int, days: int = 90) -> DataFrame:
    """Per payer and recipient, the first day from which the next ``days`` days hold two or more small flows that reach the limit together."""
    small = flows.where(F.col("amount") < limit)
    ahead = W.partitionBy("payer", "recipient").orderBy(F.datediff("day", F.lit("1970-01-01"))).rangeBetween(0, days)
    hit = small.select("payer", "recipient", "day", F.count("*").over(ahead).alias("n"), F.sum("amount").over(ahead).alias("total")).where((F.col("n") >= 2) & (F.col("total") >= limit))
    return hit.groupBy("payer", "recipient").agg(F.min_by(F.struct("day", "n", F.col("total").cast("double").alias("total")), "day").alias("x")).select("payer", "recipient", "x.*")


def changes_nearby(contracts: DataFrame, changes: DataFrame, key: str, days: int) -> DataFrame:
    """Contracts with changes of the same subject within ``days`` days, and the kinds of those.

    Both sides are dealt by day windows of ``days``, so that a busy subject's rows spread over many keys.
    """
    slot = lambda c, by=0: F.floor(F.datediff(c, F.lit("1970-01-01")) / days) + by
    left = contracts.withColumn("slot", F.explode(F.array(*[slot("day", k) for k in (-1, 0, 1)])))
    right = changes.withColumn("slot", slot("change_day"))
    near = left.join(right, [key, "slot"]).where(F.abs(F.datediff("change_day", "day")) <= days)
    return near.groupBy(*contracts.columns).agg(F.array_join(F.sort_array(F.collect_set("kind")), ",").alias("kinds"), F.count("*").alias("n"))
