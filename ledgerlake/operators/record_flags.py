"""What a register record and its attachments tell about the record's quality, and the shares measured on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.amounts import amounts, prices
from ..functions.identifiers import check_digit_ok
from ..functions.notices import redacted_name, redaction_marks
from .pairing import shares

#: Largest attachment read; states of attachments; what shows that a record is redacted.
MOST_BYTES = 60 * 1024 * 1024
NOT_FETCHED, WRONG_HASH, TOO_LARGE, DONE = "nestazeno", "hash_nesouhlasi", "prilis_velka", "zpracovano"
BY_NAME, BY_MARKS, BY_BOXES, BY_BLOCKS = "název souboru", "textové značky", "černé obdélníky v PDF", "černé bloky ve skenu"


def contract_flags() -> dict[str, Column]:
    """Columns over (subject, parties, net, gross, foreign, no_price_reason): which sides have a valid id, and is there any amount."""
    valid = F.exists("parties", lambda p: check_digit_ok(p))
    return {
        "subject_id": F.coalesce(check_digit_ok(F.col("subject")), F.lit(False)),
        "party_id": F.coalesce(valid, F.lit(False)),
        "n_parties": F.coalesce(F.size("parties"), F.lit(0)),
        "parties_without_id": F.coalesce(F.size(F.filter("parties", lambda p: F.coalesce(p, F.lit("")) == "")), F.lit(0)),
        "has_amount": F.coalesce("net", "gross", "foreign").isNotNull(),
        "reason_given": F.coalesce("no_price_reason", F.lit("")) != "",
    }


def attachment_states(attachments: DataFrame) -> DataFrame:
    """Attachments with ``state`` and ``redacted_by``.

    Read: name, declared_hash, hash, http_status, size, readable, text, boxes,
    blocks.  A file that wasn't fetched has a null hash; one that differs from the
    declared hash isn't the original, so neither it nor one too large is read: of
    these only the name counts.
    """
    fetched = F.col("hash").isNotNull()
    why = F.concat(F.lit(f"{NOT_FETCHED} ("), F.coalesce(F.col("http_status").cast("string"), F.lit("bez odkazu")), F.lit(")"))
    state = F.when(~fetched, why).when(F.col("declared_hash") != F.col("hash"), WRONG_HASH).when(F.col("size") > MOST_BYTES, TOO_LARGE).otherwise(DONE)
    rows = attachments.withColumn("state", state)
    read = F.col("state") == DONE
    legible = read & F.coalesce("readable", F.lit(False))
    how = F.array_compact(
        F.array(
            F.when(redacted_name(F.col("name")), BY_NAME),
            F.when(legible & (F.size(redaction_marks(F.col("text"), 1)) > 0), BY_MARKS),
            F.when(read & (F.col("boxes") > 0), BY_BOXES),
            F.when(read & (F.col("blocks") > 0), BY_BLOCKS),
        )
    )
    return rows.withColumns({"legible": legible, "redacted_by": how})


def record_flags(contracts: DataFrame, attachments: DataFrame, key: str) -> DataFrame:
    """One row a contract, also without attachments.

    Attachments are ordered by ``position``; the text is that of the legible ones
    with a form feed between them, ``original`` the address of the first of them
    that has one.  Ids are valid by check digit; ``m1``: both sides have one and an
    amount is declared; ``m2``: the price stands in the text alone; ``m3``: redacted.
    """
    of = attachment_states(attachments).select(key, F.struct("position", "state", "legible", F.when(F.col("legible"), F.col("text")).alias("text"), "redacted_by", "url").alias("a"))
    files = of.groupBy(key).agg(F.sort_array(F.collect_list("a")).alias("files"))
    rows = contracts.withColumns(contract_flags()).join(files, key, "left")
    legible = F.filter("files", lambda a: a["legible"])
    rows = rows.withColumns(
        {
            "states": F.coalesce(F.transform("files", lambda a: a["state"]), F.array().cast("array<string>")),
            "redacted_by": F.coalesce(F.array_sort(F.array_distinct(F.flatten(F.transform("files", lambda a: a["redacted_by"])))), F.array().cast("array<string>")),
            "readable": F.coalesce(F.size(legible) > 0, F.lit(False)),
            "original": F.get(F.filter(F.transform(legible, lambda a: a["url"]), lambda u: u.isNotNull()), F.lit(0)),
            "text": F.coalesce(F.array_join(F.transform(legible, lambda a: F.coalesce(a["text"], F.lit(""))), "\n\f"), F.lit("")),
        }
    )
    rows = rows.withColumn("price_in_text", F.size(prices(amounts(F.col("text")))) > 0)
    return rows.withColumns(
        {
            "m1": F.col("subject_id") & F.col("party_id") & F.col("has_amount"),
            "m2": ~F.col("has_amount") & F.col("price_in_text"),
            "m3": F.size("redacted_by") > 0,
        }
    ).drop("files", "text")


def flag_measures(rows: DataFrame) -> DataFrame:
    """A23 of records: (measure, k, n, share, low, high), the last two measures among records without amount and with legible text."""
    everyone = F.lit(True)
    one = lambda name, c, of=everyone: F.struct(F.lit(name).alias("measure"), of.alias("counts"), (F.col(c) & of).alias("yes"))
    plain = {"m1_ico_obe_strany_a_castka": "m1", "m2_castka_jen_v_priloze": "m2", "m3_znecitelneno": "m3", "ico_subjektu": "subject_id", "ico_protistrany": "party_id", "castka_v_metadatech": "has_amount", "duvod_neuvedeni_ceny": "reason_given", "text_citelny": "readable"}
    return shares(rows, [one(n, c) for n, c in plain.items()] + [one("m2_mezi_bez_castky", "m2", ~F.col("has_amount")), one("m3_mezi_citelnymi", "m3", F.col("readable"))])
