"""Durations and annual values of contract texts (X08, X10), as Columns over whole texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .amounts import LEAST_PERIODIC, amounts, around, periodic, prices, sentence_before
from .notices import net_amounts
from .values import once

# How terms are written, sentences on performance and on other terms, repeated and continuous performance.
_CONTRACT = r"(?:smlouv\w*|nájem\w*|nájm\w*|pacht\w*|dohod\w*|uzavír\w*|uzavřen\w*|objednáv\w*)"
INDEFINITE = _CONTRACT + r"[^.;]{0,100}?na\s+dobu\s+neurčit"
DEFINITE = _CONTRACT + r"[^.;]{0,100}?na\s+dobu\s+určit"
_WORDS = {"jednoho": 1, "dvou": 2, "tří": 3, "čtyř": 4, "pěti": 5, "šesti": 6, "sedmi": 7, "osmi": 8, "devíti": 9, "deseti": 10}
FOR_TERM = r"(?:po\s+dobu|na\s+dobu|na\s+období)\s+(?:\d{1,3}|jednoho|dvou|tří|čtyř|pěti|šesti|sedmi|osmi|devíti|deseti)\s+(?:let|roků|roky|rok|měsíců|měsíce|měsíc)"
FROM_TO = r"od\s+\d{1,2}\.\s?\d{1,2}\.\s?\d{4}\s+do\s+\d{1,2}\.\s?\d{1,2}\.\s?\d{4}"
PERFORMANCE = r"smlouv|nájem|nájm|pacht|služb|plnění|dodáv|servis|podpor|licenc|provoz|údržb|dohod|spolupráce"
OTHER_TERM = r"záru|udržitel|archiv|uchov|mlčenliv|promlč|zveřejn|souhlas|pojištěn|garanc|reklamac|lhůt"
CONTINUOUS = r"služb|servis|údržb|provoz|podpor|nájem|nájm|pronáj|pacht|licenc|poskytován|předplat"
REPEATED = r"nájemn|nájm|podnájm|pacht|předplatn|paušál|pravideln\w+\s+(?:servis|údržb|dodáv)|opakovan\w+\s+plnění"
UNIT_PRICE = r"(?:Kč|CZK)\s*(?:bez\s+DPH\s*)?/\s*(?:hod|h\b|ks|km|m2|m²|m3|t\b|kg|den|osob)"
TOTAL_FOR_TERM = r"(?:celkov\w+\s+cen\w+|cena\s+celkem|celková\s+hodnota)[^.]{0,80}(?:za\s+celou\s+dobu|za\s+dobu\s+trvání)"
MOST_DAYS = 50 * 365
TIMES = {"yearly": 1, "monthly": 12, "quarterly": 4}
_I = "(?iuU)"


def _days(match: Column) -> Column:
    """Days of a term in words, or between two dates of 1990 to 2100."""
    word = F.lower(F.regexp_extract(match, rf"{_I}\s(\S+)\s+\S+$", 1))
    count = F.coalesce(word.try_cast("int"), *[F.when(word == w, n) for w, n in _WORDS.items()])
    term = count * F.when(match.rlike(_I + r"\s(?:let|ro)\S*$"), 365).otherwise(30)

    def day(k: int) -> Column:
        d = F.try_to_timestamp(F.regexp_replace(F.regexp_extract(match, r"(?iU)^od\s+(.*\d)\s+do\s+(.*)$", k), r"\s", ""), F.lit("d.M.yyyy")).cast("date")
        return F.when(F.year(d).between(1990, 2100), d)

    return F.when(match.rlike(_I + r"^od\s"), F.datediff(day(2), day(1))).otherwise(term)


def duration(text: Column) -> Column:
    """struct(indefinite, days, continuous) from sentences on performance.

    ``indefinite``: true or false where the contract is said to be for an indefinite or a definite term; ``days``: the
    longest term, 50 years at most, or null; ``continuous``: its sentence speaks of services, rent and the like.
    """
    def term(s: Column) -> Column:
        sentence = F.concat(sentence_before(s["before"]), s["match"], F.regexp_extract(s["after"], r"^([^.;]*)", 1))
        serves = sentence.rlike(_I + PERFORMANCE) & ~sentence.rlike(_I + OTHER_TERM)
        return F.struct(F.when(serves, _days(s["match"])).alias("days"), s["match"].rlike(_I + r"^od\s").alias("dated"), sentence.rlike(_I + CONTINUOUS).alias("continuous"))

    said = F.regexp_extract_all(text, F.lit(f"{_I}({INDEFINITE})"), F.lit(1))
    indefinite = F.when(F.exists(said, lambda m: ~F.lower(m).contains("souhlas")), True).when(text.rlike(_I + DEFINITE), False)

    def told(terms: Column, longest: Column) -> Column:
        # of equally long ones a term in words comes before one of dates
        worded = F.filter(terms, lambda t: (t["days"] == longest) & ~t["dated"])
        dated = F.filter(terms, lambda t: (t["days"] == longest) & t["dated"])
        first = F.get(F.concat(worded, dated), F.lit(0))
        return F.struct(indefinite.alias("indefinite"), longest.alias("days"), F.coalesce(first["continuous"], F.lit(False)).alias("continuous"))

    terms = F.filter(F.transform(around(text, [FOR_TERM, FROM_TO], 300, 300), term), lambda t: t["days"].between(1, MOST_DAYS))
    return once(terms, lambda t: once(F.array_max(F.transform(t, lambda x: x["days"])), lambda longest: told(t, longest)))


def annual_values(contracts: DataFrame, key: str, text: str, least_days: int = 366) -> DataFrame:
    """Key, repeated, verdict, reason and annual: whether a contract's value in a year can be told from its text; a null text is an empty one.

    Each step is a projection of its own, so that what several columns need is found once a row.
    """
    doubles = lambda xs, k=1: F.transform(xs, lambda s: (s["value"] * k).cast("double"))
    said = F.coalesce(F.col(text), F.lit(""))
    rows = contracts.select(key, said.alias("said")).select(key, "said", duration(F.col("said")).alias("term"), amounts(F.col("said")).alias("found"))
    large = F.filter(prices(F.col("found")), lambda s: s["value"] >= LEAST_PERIODIC)
    rows = rows.select(key, "said", "term", periodic(F.col("found")).alias("each"), F.array_distinct(doubles(large)).alias("large"))
    every = F.concat(*[doubles(F.col(f"each.{n}"), k) for n, k in TIMES.items()])
    rows = rows.select(key, "said", "term", F.array_distinct(every).alias("every"), "large")
    rows = rows.select(key, "said", "term", net_amounts(F.col("every")).alias("annual"), F.array_max(net_amounts(F.col("large"))).alias("price"))
    text_, annual, price, days = F.col("said"), F.col("annual"), F.col("price"), F.col("term.days")
    endless, years = F.coalesce("term.indefinite", F.lit(False)), F.coalesce(days >= least_days, F.lit(False))
    steady = F.coalesce(days >= 180, F.lit(False)) & F.col("term.continuous")
    repeated = endless | years | steady | (F.size(annual) > 0) | text_.rlike(_I + REPEATED)
    result = lambda verdict, reason, value=None: F.struct(F.lit(verdict).cast("string").alias("verdict"), F.lit(reason).cast("string").alias("reason"), (F.lit(None) if value is None else value).cast("double").alias("annual"))
    told = (
        F.when(~repeated, result(None, None))
        .when(F.size(annual) == 1, result("yes", "periodic", F.get(annual, F.lit(0))))
        .when(F.size(annual) > 1, result("unclear", "several_periodic"))
        .when(endless, result("no", "indefinite_without_period"))
        .when((days <= 370) & price.isNotNull(), result("yes", "within_a_year", price))
        .when(years & price.isNotNull() & text_.rlike(_I + TOTAL_FOR_TERM), result("yes", "total_for_term", F.round(price / (days / 365), 2)))
        .when(price.isNull() & text_.rlike(_I + UNIT_PRICE), result("no", "unit_prices_only"))
        .when(price.isNull(), result("no", "no_price"))
        .when(years, result("unclear", "years_without_link"))
        .otherwise(result("unclear", "no_period_or_length"))
    )
    return rows.select(key, repeated.alias("repeated"), told.alias("told")).select(key, "repeated", "told.*")
