"""Company ids, stable keys and their checks, as Columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import once

#: Fixed value: the namespace of entity keys.
NAMESPACE = "6f1c2a521b8e4f439d360d8e52b8a6a1"


def company_id(raw: Column) -> Column:
    """Eight digits from an id as sources write it; null for text, zero or more than eight digits."""
    text = F.regexp_replace(F.regexp_replace(F.trim(raw), r"^([0-9]+)\.0+$", "$1"), "^[Cc][Zz]", "")
    digits = F.regexp_replace(text, r"[^0-9]", "")
    mostly = F.length(digits) >= F.length(F.replace(text, F.lit(" "), F.lit(""))) - 2
    ok = (F.length(digits) > 0) & (F.length(digits) <= 8) & ~digits.rlike("^0*$") & mostly
    return F.when(ok, F.lpad(digits, 8, "0"))


def check_digit_ok(ico: Column) -> Column:
    """The eighth digit is (11 - weighted sum mod 11) mod 10, weights 8 to 2; false for null or other shapes."""
    total = sum((F.substring(ico, k + 1, 1).cast("int") * (8 - k) for k in range(7)), F.lit(0))
    return F.coalesce(ico.rlike("^[0-9]{8}$") & ((F.lit(11) - total % 11) % 10 == F.substring(ico, 8, 1).cast("int")), F.lit(False))


def id_fault(raw: Column, ico: Column) -> Column:
    """Why an id isn't valid, given its normal form; null for a valid one."""
    return F.when(raw.isNull() | (F.trim(raw) == ""), "missing").when(ico.isNull(), "bad_format").when(~check_digit_ok(ico), "bad_check_digit")


def classify_id(raw: Column) -> Column:
    """struct(ico, reason); reason is null for a valid id."""
    result = lambda ico: once(id_fault(raw, ico), lambda reason: F.struct(F.when(reason.isNull(), ico).alias("ico"), reason.alias("reason")))
    return once(company_id(raw), result)


def entity_key(table: str, natural: Column) -> Column:
    """Version-5 UUID of ``table:natural`` in the fixed namespace; null without a natural key."""
    name = F.concat(F.lit(f"{table}:"), natural).cast("binary")
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE)), name))
    variant = F.substring(F.lit("89ab"), (F.conv(F.substring(h, 17, 1), 16, 10).cast("int") % 4 + 1).cast("int"), F.lit(1))
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
    return F.when(natural.isNotNull(), uuid)
