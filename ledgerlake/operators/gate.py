"""Publication gate: every rule gives a violation code; a row is publishable without any."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.texts import evaluative

#: Methodology states that block publishing.
BLOCKING_STATES = ["ceka_na_zdroj", "neuplna_metodika", "nahrazena"]


def codes(rules: dict[str, Column]) -> Column:
    """The codes of the rules that a row breaks, in the order given."""
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(code)) for code, broken in rules.items()]))


def indicator_rules(min_cases: str = "min_cases") -> dict[str, Column]:
    """Period, cases, methodology and base must be there, cases reach the minimum, the methodology may publish."""
    return {
        "INDICATOR_NO_PERIOD": F.col("period_from").isNull() | F.col("period_to").isNull(),
        "INDICATOR_NO_CASES": F.col("cases").isNull(),
        "INDICATOR_NO_METHODOLOGY": F.col("methodology").isNull(),
        "INDICATOR_NO_BASE": F.col("base").isNull(),
        "INDICATOR_UNDER_MINIMUM": F.col("cases") < F.col(min_cases),
        "INDICATOR_METHODOLOGY_STATE": F.col("state").isin(BLOCKING_STATES),
    }


def amount_rules() -> dict[str, Column]:
    """All four parts of an amount's kind."""
    blank = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    return {"AMOUNT_WITHOUT_TYPE": blank("type") | blank("currency") | blank("vat") | blank("period")}


def summary_rules(threshold: float = 0.05) -> dict[str, Column]:
    """One kind, a share from 0 to 1, and a range above the threshold."""
    return {
        "SUMMARY_OF_SEVERAL_KINDS": F.col("kinds") > 1,
        "SUMMARY_WITHOUT_SHARE": F.col("share").isNull() | ~F.col("share").between(0, 1),
        "SUMMARY_WITHOUT_RANGE": (F.col("share") > threshold) & (F.col("low").isNull() | F.col("high").isNull()),
    }


def profile_rules() -> dict[str, Column]:
    """A profile only of what is known not to be a natural person."""
    return {"PROFILE_OF_PERSON": ~F.col("person").eqNullSafe(F.lit(False))}


def text_rules(column: str) -> dict[str, Column]:
    """No evaluative words."""
    return {"EVALUATIVE_WORDS": F.size(evaluative(F.col(column))) > 0}


#: Kinds of outputs that carry a date as of which they hold.
DATED = ("indikator", "souhrn", "castka")
UNKNOWN_OUTPUT = "NEZNAMY_VYSTUP"


def dispatched(kind: Column, rules: dict[str, dict[str, Column]], of_all: dict[str, Column], of_dated: dict[str, Column]) -> Column:
    """Codes that an output breaks by its kind: its own rules, those of dated kinds, those of all; an unknown kind breaks one."""
    found = F.array(F.lit(UNKNOWN_OUTPUT))
    for name, own in rules.items():
        all_of = F.concat(codes(own), codes(of_all), codes(of_dated if name in DATED else {}).cast("array<string>"))
        found = F.when(kind == name, all_of).otherwise(found)
    return found


def violations(df: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """One row for each broken rule."""
    return df.select(*keys, F.explode(codes(rules)).alias("code"))


def publishable(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """The rows that break none."""
    return df.where(F.size(codes(rules)) == 0)
