"""Bitemporal versions as set-based jobs: rows are never changed in place, each job gives a new snapshot.

A version has an entity, attributes, ``[valid_from, valid_to)`` dates and
``[recorded_from, recorded_to)`` times; open ends are the constants below.

Versions are met by merge joins, which can spill. Any side may be as large as the versions, and Spark
takes a side's size from its compressed files: it would broadcast tables that are many times
larger in memory, and every task would hold them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

OPEN_DATE = "9999-12-31"
OPEN_TIME = "9999-12-31 00:00:00"
TIMES = ["valid_from", "valid_to", "recorded_from", "recorded_to"]


def is_current() -> Column:
    """P17."""
    return F.col("recorded_to") == F.lit(OPEN_TIME).cast("timestamp")


def as_of(versions: DataFrame, valid: Column, known: Column) -> DataFrame:
    """What was valid on a day as known at a time."""
    return versions.where((F.col("valid_from") <= valid) & (valid < F.col("valid_to")) & (F.col("recorded_from") <= known) & (known < F.col("recorded_to")))


def upsert(versions: DataFrame, batch: DataFrame, now: Column, keys: list[str], unique: bool = False) -> DataFrame:
    """New versions of entities, each entity once a batch (O08); ``unique`` says that it was made so.

    A version equal to a current one with the same interval changes nothing.
    Else every current version that overlaps ends now, its parts left and right
    of the new interval come back, and the new version starts now (J01).
    """
    attributes = [c for c in versions.columns if c not in (*keys, *TIMES)]
    if unique:
        once = batch.select(*keys, *attributes, "valid_from", "valid_to")
    else:
        once = batch.groupBy(*keys).agg(F.count("*").alias("__n"), F.first(F.struct(*attributes, "valid_from", "valid_to")).alias("__v"))
        once = once.select(*keys, F.when(F.col("__n") > 1, F.raise_error(F.lit("an entity comes twice in one batch"))).otherwise(F.col("__v")).alias("__v")).select(*keys, "__v.*")
    whole = [*attributes, "valid_from", "valid_to"]
    current, history = versions.where(is_current()), versions.where(~is_current())
    same = [F.col(f"n.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*keys, *whole]]
    condition = same[0]
    for x in same[1:]:
        condition = condition & x
    new = once.alias("n").join(current.alias("c").hint("merge"), condition, "left_anti")
    marks = new.select(*keys, F.col("valid_from").alias("__from"), F.col("valid_to").alias("__to"))
    met = current.join(marks.hint("merge"), keys, "left")
    hit = (F.col("valid_from") < F.col("__to")) & (F.col("__from") < F.col("valid_to"))
    met = met.withColumn("__hit", F.coalesce(hit, F.lit(False)))
    open_end = F.lit(OPEN_TIME).cast("timestamp")
    piece = lambda kind: F.struct(*[F.col(c) for c in attributes], *kind)
    stay = piece([F.col("valid_from"), F.col("valid_to"), F.col("recorded_from"), F.when(F.col("__hit"), now).otherwise(F.col("recorded_to")).alias("recorded_to")])
    left = F.when(F.col("__hit") & (F.col("valid_from") < F.col("__from")), piece([F.col("valid_from"), F.col("__from").alias("valid_to"), now.alias("recorded_from"), open_end.alias("recorded_to")]))
    right = F.when(F.col("__hit") & (F.col("valid_to") > F.col("__to")), piece([F.col("__to").alias("valid_from"), F.col("valid_to"), now.alias("recorded_from"), open_end.alias("recorded_to")]))
    kept = met.select(*keys, F.explode(F.array_compact(F.array(stay, left, right))).alias("__p")).select(*keys, "__p.*")
    fresh = new.select(*keys, *whole, now.alias("recorded_from"), open_end.alias("recorded_to"))
    return history.unionByName(kept).unionByName(fresh)


def end_entities(versions: DataFrame, ended: DataFrame, now: Column, keys: list[str], unique: bool = False) -> DataFrame:
    """Current versions of the given entities end now; ``unique`` says that each is given once."""
    marks = ended.select(*keys, F.lit(True).alias("__end"))
    marked = versions.join((marks if unique else marks.distinct()).hint("merge"), keys, "left")
    stop = F.coalesce(F.col("__end"), F.lit(False)) & is_current()
    return marked.withColumn("recorded_to", F.when(stop, now).otherwise(F.col("recorded_to"))).drop("__end")


def end_with_log(versions: DataFrame, ended: DataFrame, now: Column, keys: list[str], run: Column) -> tuple[DataFrame, DataFrame]:
    """The versions after the ends, and the log of ends: (keys, n_closed, reason, replaced_by, run, ended_at).

    ``ended`` has the keys, ``reason`` and ``replaced_by`` (array, null for none).
    Only entities that have a current version are logged; an end without a reason
    or an entity that comes twice is an error.
    """
    once = ended.groupBy(*keys).agg(F.count("*").alias("__n"), F.first("reason").alias("reason"), F.first("replaced_by").alias("replaced_by"))
    fault = F.when(F.col("__n") > 1, F.raise_error(F.lit("an entity is ended twice in one batch"))).when(F.coalesce("reason", F.lit("")) == "", F.raise_error(F.lit("an end needs a reason")))
    once = once.select(*keys, F.coalesce(fault.cast("string"), "reason").alias("reason"), F.coalesce("replaced_by", F.array().cast(ended.schema["replaced_by"].dataType)).alias("replaced_by"))
    closed = versions.where(is_current()).groupBy(*keys).agg(F.count("*").alias("n_closed"))
    return end_entities(versions, once.where("reason is not null"), now, keys), once.join(closed.hint("merge"), keys).select(*keys, "n_closed", "reason", "replaced_by", run.alias("run"), now.alias("ended_at"))


def correct(versions: DataFrame, given: DataFrame, now: Column, keys: list[str]) -> DataFrame:
    """The current state of the given entities becomes exactly the given versions; entities in that state already stay."""
    body = [c for c in versions.columns if c not in (*keys, "recorded_from", "recorded_to")]
    state = lambda df, name: df.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct(*body))).alias(name))
    wanted = state(given, "w")
    differ = wanted.join(state(versions.where(is_current()), "h").hint("merge"), keys, "left").where(~F.col("w").eqNullSafe(F.col("h"))).select(*keys)
    fresh = given.join(differ.hint("merge"), keys, "left_semi").select(*keys, *body, now.alias("recorded_from"), F.lit(OPEN_TIME).cast("timestamp").alias("recorded_to"))
    return end_entities(versions, differ, now, keys).unionByName(fresh)


def no_longer_derived(versions: DataFrame, derived: DataFrame, keys: list[str]) -> DataFrame:
    """Entities with a current version that the newest derivation lacks."""
    return versions.where(is_current()).select(*keys).distinct().join(derived.select(*keys).distinct().hint("merge"), keys, "left_anti")


def overlapping(versions: DataFrame, keys: list[str]) -> DataFrame:
    """Current versions that start before an earlier one of their entity ends."""
    before = F.max("valid_to").over(W.partitionBy(*keys).orderBy("valid_from", "valid_to").rowsBetween(W.unboundedPreceding, -1))
    return versions.where(is_current()).withColumn("__b", before).where("__b > valid_from").drop("__b")


def latest_corrected(records: DataFrame, corrections: DataFrame, key: str, column: str) -> DataFrame:
    """A log read through its newest corrections."""
    newest = corrections.groupBy(key).agg(F.max_by("value", "at").alias("__value"))
    return records.join(newest, key, "left").withColumn(column, F.coalesce("__value", column)).drop("__value")
