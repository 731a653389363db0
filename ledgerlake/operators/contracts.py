"""Contracts: exception categories, attachment integrity, origin of companies, and legal limits as versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Starts of verdicts that are accepted as categories, and words of transformations in register notes.
ACCEPTED = ["NELZE OVĚŘIT", "NEJASNÉ"]
TRANSFORMATION = r"přeměn|fúz|rozdělen|odštěpen|nástupnick|zanikající|sloučen|splynut|změn\w* právní form"

_LIMITS = "struct<parametry: struct<limity: array<struct<kod: string, popis: string, hodnota: decimal(18,2), jednotka: string, pravni_zaklad: string, dph_rezim: string, platnost_od: date, platnost_do: date>>>>"


def accepted_as_category(verdict: Column) -> Column:
    """The proposed verdict is one that needs no person; false for a null one."""
    starts = [verdict.startswith(x) for x in ACCEPTED]
    return F.coalesce(starts[0] | starts[1], F.lit(False))


def with_integrity(attachments: DataFrame) -> DataFrame:
    """Stored (hash of content), agrees (null where no hash is declared) and used (not where they differ or content lacks)."""
    stored = F.sha2("content", 256)
    agrees = stored == F.lower("declared")
    return attachments.withColumns({"stored": stored, "agrees": agrees, "used": F.col("content").isNotNull() & F.coalesce(agrees, F.lit(True))})


def born_by_transformation(companies: DataFrame, notes: DataFrame, key: str) -> DataFrame:
    """Whether a note of each company names a transformation; null where it has no note."""
    said = notes.groupBy(key).agg(F.bool_or(F.col("note").rlike(rf"(?iuU){TRANSFORMATION}")).alias("born"))
    return companies.join(said, key, "left").select(key, "born")


def limits(documents: DataFrame) -> DataFrame:
    """The limits of methodology documents, a row for each validity: code, valid_from, valid_to (null: open), value, unit, vat."""
    each = documents.select(F.explode(F.from_json("document", _LIMITS)["parametry"]["limity"]).alias("l")).select("l.*")
    return each.selectExpr("kod AS code", "popis AS text", "hodnota AS value", "jednotka AS unit", "pravni_zaklad AS basis", "dph_rezim AS vat", "platnost_od AS valid_from", "platnost_do AS valid_to")


def superseded(stored: DataFrame, new: DataFrame) -> DataFrame:
    """Open limits (entity, code) whose entity is no code of the new document: they end, replaced by the entity of their code."""
    return stored.join(new.select(F.col("code").alias("entity")).distinct(), "entity", "left_anti")
