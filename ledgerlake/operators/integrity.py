"""The integrity rules of the data model as pass or fail reports; a rule that is null for a row passes, as a CHECK does."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import check_digit_ok
from .versions import overlapping

#: Kinds of subsidies, the mirror source, states and flags that rules name.
SUBSIDIES = ["dotace_priznana", "dotace_cerpana", "vratka"]
MIRROR, PROVEN, HOME, NOT_NEEDED, CONVERTED = "hlidac_statu_rs", "dolozena", "CZK", "neni_treba", "kurz_cnb"


def version_rules() -> dict[str, Column]:
    return {"valid_order": F.col("valid_from") < F.col("valid_to"), "recorded_order": F.col("recorded_from") < F.col("recorded_to")}


def subject_rules() -> dict[str, Column]:
    return {"company_id_check_digit": F.col("ico").isNull() | check_digit_ok(F.col("ico"))}


def flow_rules() -> dict[str, Column]:
    return {"both_sides_or_reason": (F.col("payer").isNotNull() & F.col("recipient").isNotNull()) | F.col("unnamed_reason").isNotNull()}


def link_rules() -> dict[str, Column]:
    """Score 1 is for documented links, and documented links have it."""
    return {"score_one_if_documented": (F.col("state") == PROVEN) == (F.col("score") == 1)}


def amount_rules() -> dict[str, Column]:
    whole = F.col("value_czk").isNotNull() & F.col("rate").isNotNull() & F.col("rate_day").isNotNull()
    return {
        "period_order": F.col("period_from") < F.col("period_to"),
        "conversion_consistent": ((F.col("currency") == HOME) == (F.col("conversion") == NOT_NEEDED)) & ((F.col("conversion") == CONVERTED) == whole),
        "foreign_says_conversion": (F.col("currency") == HOME) | F.col("conversion").isNotNull(),
        "subsidy_says_as_of": ~F.col("type").isin(*SUBSIDIES) | F.col("as_of").isNotNull(),
    }


def record_rules() -> dict[str, Column]:
    return {"mirror_is_development_sample": (F.col("source") != MIRROR) | F.col("development_sample")}


def result_rules() -> dict[str, Column]:
    return {"base_and_group": F.col("base").isNotNull() & F.col("peer_group").isNotNull() & (F.col("peer_group") != "")}


def report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failed, n) of all rules in one aggregation."""
    one = df.agg(F.count("*").alias("n"), *[F.count_if(~F.coalesce(r, F.lit(True))).alias(k) for k, r in rules.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("failed"), "n") for k in rules])).alias("x")).select("x.*")


def overlap_report(versions: DataFrame, rule: str, keys: list[str]) -> DataFrame:
    """The rule that current versions of one key don't overlap in valid time; rows without a key pass."""
    known = versions.where(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    return versions.agg(F.count("*").alias("n")).crossJoin(overlapping(known, keys).agg(F.count("*").alias("failed"))).select(F.lit(rule).alias("rule"), "failed", "n")
