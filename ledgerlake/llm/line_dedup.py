"""Operator 8: line dedup by an exact set-similarity join.

A line goes if a line before it, by (doc_id, line number), matches it: Jaccard of
their token sets >= 3/4, whether or not that line stays itself.  The tokens of a
line are its five-word shingles (a shorter line is one token), as near-duplicate
operators on word shingles take them; words as tokens would put every frequent word
of a language in one list.  Lines with equal token sets are one class first; of a
class all but the first line go, and the first goes if an earlier class matches.
That takes one match, not all: each list of the prefix filter (tokens by rarity)
tries its first member and the one nearest to the origin, and what is still
unmatched proposes earlier members under length and positional filters and parity
maps (see ``ngram_join``) until one is verified or none is left.

Lines end at ``\\n`` and count from 0; lines without words never match.  Null texts
have no lines.  Rows without an id come last; repeated rows are one document and
share its fate; lines at the same number of rows that share an id, or have none,
are at one place and not before one another.  Empty tables give no rows; extra
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ngram_join import NO_ID, SIZE_OK, near_sets, nearest_origin, proposals, until_whole, verified
from .tables import discard, fresh, row_key, with_row_key, written


def matched_classes(spark: SparkSession, near: DataFrame, postings: DataFrame, first: DataFrame) -> DataFrame:
    """(ck) of classes that match one whose first line, ``first`` (ck, doc, line), is earlier."""
    placed = written(spark, postings.join(first, "ck"), "placed")
    place = F.struct("doc", "line")
    hubs = placed.groupBy("token").agg(F.min(F.struct(place.alias("at"), "ck", "n", "m")).alias("oldest"), F.min(F.struct(nearest_origin().alias("rank"), place.alias("at"), "ck", "n", "m")).alias("middle"), F.count("*").alias("size"))
    hubs = hubs.where("size > 1").select("token", F.explode(F.array(F.struct("oldest.at", "oldest.ck", "oldest.n", "oldest.m"), F.struct("middle.at", "middle.ck", "middle.n", "middle.m"))).alias("hub"))
    star = placed.join(hubs, "token").where(f"struct(doc, line) > hub.at and {SIZE_OK}").select(F.col("ck").alias("a"), F.col("hub.ck").alias("b")).distinct()
    none = F.lit(0).cast("long")
    found = [written(spark, verified(near, star.withColumns({"x": F.col("a"), "y": none}), 1).select(F.col("x").alias("ck")), "matched")]
    discard(spark, placed)

    def step(limit: int) -> DataFrame:
        done = found[-1].withColumn("label", F.lit(-1).cast("long"))
        tags = first.join(done, "ck", "left").select("ck", F.coalesce("label", F.col("ck").bitwiseAND(2**63 - 1)).alias("label"), "doc", "line")
        return proposals(spark, postings, near, tags, limit, earlier=True)

    def apply(pairs: DataFrame) -> None:
        found.append(written(spark, found[-1].union(verified(near, pairs, 1).select(F.col("x").alias("ck"))).distinct(), "matched"))

    until_whole(step, apply, spark)
    discard(spark, *found[:-1])
    return found[-1]


def removed_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row -> (rk, doc_id, n_lines, removed): the numbers of the lines that go, ascending."""
    keyed = with_row_key(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    profile, members, near, postings = near_sets(spark, keyed, by_line=True, count=1)
    discard(spark, profile)
    first = members.groupBy("ck").agg(F.min(F.struct("doc_id", "line_no")).alias("place"))
    first = written(spark, first.select("ck", F.col("place.doc_id").alias("doc"), F.col("place.line_no").alias("line")), "first")
    matched = matched_classes(spark, near, postings, first)
    discard(spark, near, postings)
    fate = first.join(matched.withColumn("gone", F.lit(True)), "ck", "left")
    later = members.join(fate, "ck").where("gone or struct(doc_id, line_no) > struct(doc, line)")
    gone = later.groupBy("rk").agg(F.sort_array(F.collect_set(F.col("line_no").cast("int"))).alias("removed"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n"))).cast("long")
    out = keyed.select("rk", "doc_id", n_lines.alias("n_lines")).join(gone, "rk", "left")
    return out.select("rk", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_lines", F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))


def without_later_lines(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with later matching lines cut from their texts; all columns kept."""
    key, cut = fresh(docs, "row_key"), fresh(docs, "removed_lines")
    gone = removed_lines(spark, docs).where("size(removed) > 0").select(F.col("rk").alias(key), F.col("removed").alias(cut)).distinct()
    keyed = docs.withColumn(key, row_key(docs)).join(gone, key, "left")
    kept = F.expr(f"array_join(filter(split(text, '\\n'), (x, i) -> not array_contains(`{cut}`, i)), '\\n')")
    text = F.when(F.col(cut).isNull(), F.col("text")).otherwise(kept)
    return keyed.select(*[text.alias(c) if c.lower() == "text" else F.col(f"`{c}`") for c in docs.columns])


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = removed_lines(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_lines"))
