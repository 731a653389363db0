"""Notices, deadlines, currencies and publication marks, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import once

#: VAT rates whose amounts are variants of a net amount.
VARIANT_RATES = [0.21, 0.12]
#: What a text shows in place of a redacted datum, and file names that tell of it.
PLACEHOLDER = r"(?:anonymizov[áa]no|znečitelněno|začerněno|redigov[áa]no|skryto|osobní\s+údaj)"
REDACTION_MARKS = (
    r"(?<![A-Za-z])[Xx]{5,}(?![A-Za-z])|[█■▇▆▅▀▄]{2,}|\*{5,}"
    rf"|[\[(]\s*{PLACEHOLDER}\s*[\])]|:[ \t]*{PLACEHOLDER}[ \t]*(?:$|[,;])|^[ \t]*{PLACEHOLDER}[ \t]*$"
)
REDACTED_NAME = r"anonym|redig|zne[cč]itel|za[cč]ern|scrub"


def redaction_marks(text: Column, most: int = 3) -> Column:
    """The first marks in a text that stand for redacted data; a mark word counts only in brackets, after a colon or alone on a line."""
    return F.slice(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"(?imuU)({REDACTION_MARKS})"), F.lit(1)), 1, most)


def redacted_name(name: Column) -> Column:
    """A file name tells of redaction."""
    return F.coalesce(name.rlike(f"(?iu){REDACTED_NAME}"), F.lit(False))


def net_amounts(amounts: Column) -> Column:
    """A set of amounts without those that are, within 1, another one with VAT or the VAT of another one."""
    derived = lambda w, v: F.exists(F.array(*[F.lit(r) for r in VARIANT_RATES]), lambda r: (F.abs(w - v * (1 + r)) <= 1) | (F.abs(w - v * r) <= 1))
    return once(F.array_distinct(amounts), lambda distinct: F.filter(distinct, lambda w: ~F.exists(distinct, lambda v: (v != w) & derived(w, v))))


def converted(value: Column, currency: Column, rate: Column) -> Column:
    """struct(value_czk, flag): home amounts need no conversion, others take the rate of the day if there is one."""
    home = currency == "CZK"
    flag = F.when(home, "neni_treba").when(rate.isNull(), "kurz_nedostupny").otherwise("kurz_cnb")
    return F.struct(F.when(~home, F.bround(value * rate, 2)).alias("value_czk"), flag.alias("flag"))


def amount_kind_faults(kind: Column, currency: Column, vat: Column, period: Column) -> Column:
    """P20: array of what an amount lacks: any of its four parts, or a currency of three upper-case letters."""
    missing = kind.isNull() | vat.isNull() | period.isNull() | (F.coalesce(currency, F.lit("")) == "")
    return F.array_compact(F.array(F.when(missing, "INCOMPLETE"), F.when(~missing & ~currency.rlike("^[A-Z]{3}$"), "CURRENCY")))


def minimum_deadline(procedure: Column, above: Column, works: Column, early: Column, urgent: Column, limit: Column, unit: Column) -> Column:
    """struct(shortening, minimum, unit) of open procedures from the limit of the day; null for others.

    Fixed values: below the threshold an early notice takes five working days off; above it early
    notice or urgency of supplies and services leaves fifteen days.
    """
    cut_below = ~above & early
    cut_above = above & ~works & (early | urgent)
    short = F.when(cut_below, "zkraceni_54_4").when(cut_above, "zkraceni_57_2")
    least = F.when(cut_below, limit - 5).when(cut_above, F.least(limit, F.lit(15))).otherwise(limit)
    return F.when((procedure == "open") & limit.isNotNull(), F.struct(short.alias("shortening"), least.alias("minimum"), unit.alias("unit")))


def limit_code(above: Column, works: Column) -> Column:
    """The code of the limit of open procedures by regime and nature."""
    return F.when(above, "lhuta_nabidky_nadlimitni_otevrene").when(works, "lhuta_nabidky_podlimitni_otevrene_stavby").otherwise("lhuta_nabidky_podlimitni_otevrene_dodavky_sluzby")


def unapproved_threshold(above: Column, threshold: Column, mark: Column, approved: Column) -> Column:
    """A result carries a threshold or its mark though not all versions of the method approve the values."""
    marked = F.coalesce(above, F.lit(False)) | threshold.isNotNull() | (F.coalesce(mark, F.lit("")) != "")
    return marked & ~F.coalesce(approved, F.lit(False))
