"""Safe dates, decimals and roundings, as Columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row: inside a lambda an expression is computed again for each element, a variable isn't."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def safe_date(text: Column) -> Column:
    """The first ten characters as a date from 1990-01-01 to 2100-01-01, else null."""
    day = F.substring(text, 1, 10).try_cast("date")
    return F.when(day.between(F.lit("1990-01-01").cast("date"), F.lit("2100-01-01").cast("date")), day)


def safe_decimal(text: Column) -> Column:
    """Two decimal places, halves to even; null where it isn't a number."""
    return F.bround(text.try_cast("decimal(38,6)"), 2).cast("decimal(18,2)")


def locale_decimal(text: Column) -> Column:
    """A number as Czech sources write it: spaces and ``Kč`` or ``CZK`` dropped, a comma is the decimal sign and points before it group; else null."""
    bare = F.regexp_replace(text, "Kč|CZK|[ \u00a0]", "")
    point = F.when(bare.contains(","), F.replace(F.when(bare.contains("."), F.replace(bare, F.lit("."), F.lit(""))).otherwise(bare), F.lit(","), F.lit("."))).otherwise(bare)
    return point.try_cast("decimal(38,6)")


def size_band(volume: Column) -> Column:
    """Half-open bands of a volume. Limits 1, 10 and 100 million."""
    return F.when(volume < 1_000_000, "under_1m").when(volume < 10_000_000, "1m_10m").when(volume < 100_000_000, "10m_100m").otherwise("over_100m")


def czech_percent(share: Column) -> Column:
    """``12,3 %``."""
    return F.concat(F.translate(F.format_number(share * 100, 1), ",.", " ,"), F.lit(" %"))


def wilson(successes: Column, n: Column, z: float = 1.959963984540054) -> Column:
    """struct(share, low, high), the Wilson interval; exact 0 and 1 at the ends."""
    k, m = successes.cast("double"), n.cast("double")
    p = k / m
    centre = (p + z * z / (2 * m)) / (1 + z * z / m)
    half = z * F.sqrt(p * (1 - p) / m + z * z / (4 * m * m)) / (1 + z * z / m)
    low = F.when(k == 0, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), centre - half))
    high = F.when(k == m, F.lit(1.0)).otherwise(F.least(F.lit(1.0), centre + half))
    return F.when(m > 0, F.struct(p.alias("share"), low.alias("low"), high.alias("high")))


def date_agreement(a: Column, b: Column, days: int = 30) -> Column:
    """1 on the same day, falling to 0 at ``days``; 0 where a date lacks."""
    return F.coalesce(F.greatest(F.lit(0.0), 1 - F.abs(F.datediff(a, b)) / days), F.lit(0.0))


def amount_agreement(price: Column, net: Column, gross: Column, tolerance: float = 0.10, rates: tuple = (0.21, 0.12)) -> Column:
    """The best of the net value and the gross value without VAT, 1 falling to 0 at the tolerance."""
    variants = [net, *[gross / (1 + r) for r in rates]]
    scores = [F.when(v != 0, F.greatest(F.lit(0.0), 1 - F.abs(v - price) / price / tolerance)) for v in variants]
    return F.when(price > 0, F.coalesce(F.greatest(*scores), F.lit(0.0))).otherwise(F.lit(0.0))


def amount_variant(price: Column, net: Column, gross: Column, tolerance: float = 0.10, rates: tuple = (0.21, 0.12)) -> Column:
    """H21, second form: struct(score, compared): the best agreement and which amount gave it, the first named of equals; null where none agrees."""
    one = lambda v, how: F.struct(F.when(v != 0, F.greatest(F.lit(0.0), 1 - F.abs(v - price) / price / tolerance)).cast("double").alias("score"), F.lit(how).alias("compared"))
    price, net, gross = price.cast("double"), net.cast("double"), gross.cast("double")
    variants = F.array(one(net, "bez_dph"), *[one(gross / (1 + r), f"s_dph/{1 + r:.2f}") for r in rates])
    none = F.struct(F.lit(0.0).alias("score"), F.lit(None).cast("string").alias("compared"))
    return F.when(price > 0, F.aggregate(variants, none, lambda best, v: F.when(v["score"] > best["score"], v).otherwise(best))).otherwise(none)
