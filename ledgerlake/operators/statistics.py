"""Sums, distributions, completeness and samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def typed_sum(df: DataFrame, kind: list[str], amount: str) -> DataFrame:
    """Sums that never mix kinds; null amounts are skipped, a null part of a kind is an error."""
    whole = F.array(*[F.col(c).isNull() for c in kind])
    checked = df.withColumn(kind[0], F.when(F.array_contains(whole, True), F.raise_error(F.lit("a part of an amount's kind is null"))).otherwise(F.col(kind[0])))
    return checked.groupBy(*kind).agg(F.sum(amount).cast("double").alias("total"), F.count(amount).alias("n"))


def strict_sum(df: DataFrame, kind: list[str], amount: str) -> DataFrame:
    """A01, strict: one sum over all rows; more than one kind is an error, no row gives null."""
    kinds = F.count_distinct(F.struct(*kind))
    return df.agg(F.when(kinds > 1, F.raise_error(F.lit("amounts of different kinds"))).otherwise(F.sum(amount)).alias("total"))


def subject_summary(flows: DataFrame, threshold: float = 0.05) -> DataFrame:
    """A10: totals of every subject and kind at once, the share that rests on probable links, and a range above the threshold."""
    part = F.sum(F.when(F.col("probable"), F.col("amount")).otherwise(F.lit(0)))
    out = flows.groupBy("recipient", "type", "vat").agg(F.count_distinct("flow").alias("n_flows"), F.count("*").alias("n"), F.sum("amount").alias("t"), part.alias("h"), F.min("day").alias("as_of"))
    share = F.try_divide(F.col("h").cast("double"), F.col("t").cast("double"))
    return out.select("recipient", "type", "vat", "n_flows", "n", F.col("t").cast("double").alias("total"), F.round(share, 4).alias("share"), "as_of", F.when(share > threshold, (F.col("t") - F.col("h")).cast("double")).alias("low"), F.when(share > threshold, F.col("t").cast("double")).alias("high"))


def completeness(df: DataFrame, frame: str, fields: list[str]) -> DataFrame:
    """How many rows of each frame, and of all, have a field."""
    sums = [F.sum(F.col(c).cast("long")).alias(c) for c in fields]
    g = df.rollup(frame).agg(F.count("*").alias("n"), *sums, F.grouping(frame).alias("__all"))
    g = g.select(F.when(F.col("__all") == 1, "all").otherwise(F.col(frame)).alias("frame"), "n", *fields)
    return g.unpivot(["frame", "n"], fields, "field", "filled")


#: Hundredths that one coarse bucket of values spans: so many different values meet in one window at most.
BUCKET = 1 << 20


def percentiles(df: DataFrame, group: str, value: str, shares: list[float]) -> DataFrame:
    """(group, n, p): exact percentiles of amounts of two decimal places, with linear interpolation.

    A histogram of coarse buckets tells which bucket holds the two values about each
    rank; only the values of those buckets are counted one by one.  No group's values
    meet in one buffer: a window sees counts, of coarse buckets or of one bucket's values.
    """
    # in a struct, a null group joins itself
    rows = df.select(F.struct(F.col(group).alias("of")).alias("g"), F.round(F.col(value) * 100).cast("long").alias("v")).where("v is not null")
    rows = rows.withColumn("b", F.floor(F.col("v") / BUCKET))
    before = lambda keys, by: F.sum("c").over(W.partitionBy(*keys).orderBy(by)) - F.col("c")
    coarse = rows.groupBy("g", "b").agg(F.count("*").alias("c")).withColumn("low", before(["g"], "b")).withColumn("n", F.sum("c").over(W.partitionBy("g")))
    at = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.lit(q).alias("q")) for k, q in enumerate(shares)]))
    wanted = coarse.select("g", "b", "c", "low", "n", at.alias("x")).withColumn("rank", (F.col("n") - 1) * F.col("x.q"))
    place = F.explode(F.array(F.struct(F.lit(0).alias("up"), F.floor("rank").alias("at")), F.struct(F.lit(1).alias("up"), F.ceil("rank").alias("at"))))
    wanted = wanted.withColumn("place", place).where("place.at >= low and place.at < low + c")
    wanted = wanted.select("g", "b", "n", "rank", F.col("x.k").alias("k"), F.col("place.up").alias("up"), (F.col("place.at") - F.col("low")).alias("inside"))
    fine = rows.join(wanted.select("g", "b").distinct(), ["g", "b"], "left_semi").groupBy("g", "b", "v").agg(F.count("*").alias("c")).withColumn("low", before(["g", "b"], "v"))
    met = wanted.join(fine, ["g", "b"]).where("inside >= low and inside < low + c")
    side = lambda up: F.max(F.when(F.col("up") == up, F.col("v"))) / 100.0
    each = met.groupBy("g", "n", "k").agg(side(0).alias("a"), side(1).alias("z"), F.max(F.col("rank") - F.floor("rank")).alias("part"))
    each = each.select("g", "n", "k", (F.col("a") + (F.col("z") - F.col("a")) * F.col("part")).alias("p"))
    return each.groupBy("g", "n").agg(F.array_sort(F.collect_list(F.struct("k", "p"))).alias("p")).select(F.col("g.of").alias(group), "n", F.transform("p", lambda x: x["p"]).alias("p"))


def _with_all(df: DataFrame, group: str, value: str) -> DataFrame:
    """Each row for its group and, with a null group, for all."""
    return df.select(F.explode(F.array(F.struct(F.col(group).alias("g"), F.lit(False).alias("every")), F.struct(F.lit(None).alias("g"), F.lit(True).alias("every")))).alias("grp"), F.col(value).alias("value"))


def distribution(df: DataFrame, group: str, value: str) -> DataFrame:
    """Exact percentiles by group and of all rows."""
    g = percentiles(_with_all(df, group, value), "grp", "value", [0.5, 0.75, 0.9, 0.95])
    return g.select(F.when(F.col("grp.every"), "all").otherwise(F.col("grp.g")).alias("grp"), "n", *[F.round(F.col("p")[k], 4).alias(name) for k, name in enumerate(("p50", "p75", "p90", "p95"))])


def thresholds(df: DataFrame, group: str, value: str, q: float = 0.9, least: int = 30) -> DataFrame:
    """A group's own percentile from ``least`` rows on, else that of all rows."""
    g = percentiles(_with_all(df, group, value), "grp", "value", [q])
    every = g.where("grp.every").select(F.col("p")[0].alias("p_all"))
    own = F.col("n") >= least
    # one row: a proven bound
    return g.where("not grp.every").join(F.broadcast(every)).select(F.col("grp.g").alias("grp"), "n", F.round(F.when(own, F.col("p")[0]).otherwise(F.col("p_all")), 4).alias("threshold"), own.alias("own"))


def first_rows(df: DataFrame, group: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each group; Spark keeps n a group in each task before it shuffles."""
    return df.withColumn("k", F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col("k") <= n)


def hash_sample(df: DataFrame, key: str, purpose: str, n: int, seed: str = "seed") -> DataFrame:
    """A reproducible sample; a larger n keeps the smaller sample as its first rows."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.lit(seed), F.lit(purpose), F.col(key).cast("string")), 256), key).limit(n)


def accepted_sample(frame: DataFrame, order: list[str | Column], reject: Column, n: int) -> tuple[DataFrame, DataFrame]:
    """The first ``n`` rows of the order that no reason rejects, and (reason, n) of what was drawn until then, null for accepted ones.

    The order must be total.  The place of the last accepted row is found by a
    top-n, so the frame is never sorted as a whole; with fewer than ``n`` good
    rows everything is drawn.
    """
    place = F.struct(*order)
    rows = frame.withColumns({"__place": place, "reason": reject})
    good = rows.where("reason is null").orderBy("__place").limit(n)
    last = good.agg(F.when(F.count("*") == n, F.max("__place")).alias("__last"))
    drawn = rows.crossJoin(F.broadcast(last)).where(F.col("__last").isNull() | (F.col("__place") <= F.col("__last")))
    return good.drop("__place", "reason"), drawn.groupBy("reason").agg(F.count("*").alias("n"))
