"""Text normalisation and similarity, as Columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

#: All characters that Unicode takes apart into one without a mark, those into several with a Latin letter or digit, and all marks.
_PARTS = {c: "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x)) for c in map(chr, range(0x80, 0x1F200)) if not 0xD800 <= ord(c) < 0xE000 and not unicodedata.combining(c)}
_ONE = {c: d for c, d in _PARTS.items() if d != c and len(d) == 1}
_SEVERAL = {c: d for c, d in _PARTS.items() if len(d) > 1 and any(x.isascii() and x.isalnum() for x in d)}
_MARKS = "".join(c for c in map(chr, range(0x80, 0x1F200)) if not 0xD800 <= ord(c) < 0xE000 and unicodedata.combining(c))


def _ranges(chars) -> str:
    """Characters in the brackets of a pattern: runs of neighbours as ranges, so that few tests decide."""
    runs: list[list[str]] = []
    for c in sorted(chars):
        if runs and ord(c) == ord(runs[-1][1]) + 1:
            runs[-1][1] = c
        else:
            runs.append([c, c])
    return "".join(f"{a}-{z}" for a, z in runs)


#: One of ``_SEVERAL``; what isn't beyond the Latin-1 controls fails at the first test.
_RARE = f"[\u0080-\U0010ffff&&[{_ranges(_SEVERAL)}]]"

#: Legal forms that end a company name.
LEGAL_FORMS = [
    "spol s r o", "s r o", "sro", "a s", "as", "v o s", "k s", "z s", "o p s", "z u", "se", "s p",
    "druzstvo", "p o", "o s", "v v i", "statni podnik", "prispevkova organizace", "zapsany spolek",
    "zapsany ustav", "obecne prospesna spolecnost", "spolecnost s rucenim omezenym", "akciova spolecnost",
    "z s p o", "gmbh", "ltd", "llc", "inc", "b v", "kft", "sp z o o",
]

#: Evaluative patterns that a published text must not hold.
EVALUATIVE = {
    "suspicious": r"\bpodez[řr]",
    "risky": r"\brizikov\w*\s+dodavatel",
    "linked": r"\bpropojen(?!í)\w*\s+se?\b",
    "tied": r"\bnapojen(?!í)\w*\s+na\b",
}


def fold(text: Column) -> Column:
    """Lower case without marks, whatever the letters: composed, decomposed, and compatibility forms such as ligatures."""
    parts = F.create_map(*[F.lit(x) for pair in _SEVERAL.items() for x in pair])
    pieces = F.regexp_extract_all(text, F.lit(r"[\x00-\x7f]+|[^\x00-\x7f]"), F.lit(0))
    rare = F.array_join(F.transform(pieces, lambda c: F.when(c.rlike(_RARE), parts[c]).otherwise(c)), "")
    plain = F.when(text.rlike(_RARE), rare).otherwise(text)
    marked = F.translate(plain, "".join(_ONE) + _MARKS, "".join(_ONE.values()))
    return F.lower(F.when(text.rlike(r"[^\x00-\x7f]"), marked).otherwise(text))


def long_words(text: Column) -> Column:
    """Distinct folded words of four letters or digits and more."""
    return F.array_distinct(F.regexp_extract_all(fold(F.coalesce(text, F.lit(""))), F.lit(r"([a-z0-9]{4,})"), F.lit(1)))


def company_name(name: Column) -> Column:
    """Folded, marks to spaces, legal forms at the end stripped again and again."""
    t = F.trim(F.regexp_replace(fold(name), r"[^a-z0-9]+", " "))
    forms = "|".join(sorted(LEGAL_FORMS, key=len, reverse=True))
    return F.coalesce(F.trim(F.regexp_replace(t, rf"(?:(?:^| )(?:{forms}))+$", "")), F.lit(""))


def jaccard(a: Column, b: Column) -> Column:
    """Share of common elements of two arrays taken as sets; 0 if one is empty."""
    both = F.size(F.array_union(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / both).otherwise(F.lit(0.0))


def subject_agreement(a: Column, b: Column, full: float = 0.5) -> Column:
    """Jaccard of long words, 1 from ``full`` on."""
    return F.least(F.lit(1.0), jaccard(long_words(a), long_words(b)) / full)


def evaluative(text: Column) -> Column:
    """Names of the patterns that a text holds."""
    # of the letters that decide, those written with a combining mark are composed
    low = F.replace(F.replace(F.lower(F.coalesce(text, F.lit(""))), F.lit("r\u030c"), F.lit("ř")), F.lit("i\u0301"), F.lit("í"))
    return F.array_compact(F.array(*[F.when(low.rlike(f"(?U){p}"), F.lit(name)) for name, p in EVALUATIVE.items()]))


def composed_lower(text: Column) -> Column:
    """Lower case in composed form (NFC), marks kept, by the library that Spark brings for collations."""
    composed = F.java_method(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), F.coalesce(text, F.lit("")), F.lit(False))
    return F.lower(F.when(text.isNotNull(), composed))
