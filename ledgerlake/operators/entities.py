"""Recipients matched to a register of companies: by id with a name check, else by a unique name."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import check_digit_ok
from ..functions.texts import company_name
from ..sources.staging import staged
from .reports import name_similarity

#: Categories of a recipient; the least similarity of names.
BAD_ID, NO_SUCH_ID, SAME_NAME, OTHER_NAME = "ico_neplatne", "ico_neexistuje_v_ares", "ico_ares_shoda_nazvu", "ico_ares_jiny_nazev"
PERSON, UNIQUE, SEVERAL, NOT_FOUND = "fo_bez_ico", "nazev_ares_jednoznacne", "nazev_ares_nejednoznacne", "bez_ico_nenalezeno"
THRESHOLD = 0.85


def _prefixes(names: DataFrame, ranks: DataFrame, threshold: float) -> DataFrame:
    """(key, word): of each name the rarest words of which one is common to any two names that share ``threshold`` of their words."""
    words = names.select("key", F.explode(F.array_distinct(F.split("name", " "))).alias("word")).where("word <> ''")
    ranked = words.join(ranks, "word").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("n", "word"))).alias("w"))
    n = F.size("w")
    return ranked.select("key", F.explode(F.slice("w", 1, n - F.ceil(n * threshold - 1e-9).cast("int") + 1)).alias("x")).select("key", "x.word")


def match(recipients: DataFrame, register: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(id, category, similarity, register_ico) of each recipient (id, ico, name, person) in a register (ico, name, person).

    A recipient with an id is judged by it alone: a valid id of the register agrees if the names do, or if one
    side has no name to compare.  One without id that isn't a person is looked up by its name: candidates share
    one of the rarest words of both names, and a single one that is similar enough is a match.  Frequent words
    are no keys, so the candidates grow with the hits and not with recipients times companies.
    """
    known = register.select("ico", F.col("name").alias("r_name"), F.col("person").alias("r_person"), F.lit(True).alias("there"))
    has_id = F.coalesce("ico", F.lit("")) != ""
    person, no_name = F.coalesce("person", F.lit(False)), F.coalesce("name", F.lit("")) == ""
    by_id = recipients.where(has_id).withColumn("valid", check_digit_ok(F.col("ico"))).join(known, "ico", "left")
    valid = F.col("valid")
    compared = valid & F.col("there").isNotNull() & ~person & ~no_name
    # names that aren't compared aren't brought into form
    by_id = by_id.withColumns({n: F.when(compared, company_name(F.coalesce(c, F.lit("")))) for n, c in (("a", "name"), ("b", "r_name"))})
    by_id = by_id.withColumn("score", F.when(compared, name_similarity(F.col("a"), F.col("b"))))
    trusted = F.coalesce("r_person", F.lit(False)) | no_name
    category = F.when(~valid, BAD_ID).when(F.col("there").isNull(), NO_SUCH_ID).when(person | no_name, F.when(trusted, SAME_NAME).otherwise(OTHER_NAME)).when(F.col("score") >= threshold, SAME_NAME).otherwise(OTHER_NAME)
    first = by_id.select("id", category.alias("category"), F.round("score", 3).alias("similarity"), F.when(F.col("there") & valid, F.col("ico")).alias("register_ico"))

    rest = recipients.where(~has_id)
    looked = staged(rest.where(~person).select(F.col("id").alias("key"), company_name(F.coalesce("name", F.lit(""))).alias("name")))
    names = staged(register.select(F.col("ico").alias("key"), company_name(F.coalesce("name", F.lit(""))).alias("name")))
    ranks = names.select(F.explode(F.array_distinct(F.split("name", " "))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    mine, theirs = _prefixes(looked, ranks, threshold), _prefixes(names, ranks, threshold)
    pairs = mine.join(theirs.withColumnRenamed("key", "r_key"), "word").select("key", "r_key").distinct()
    pairs = pairs.join(looked, "key").join(names.select(F.col("key").alias("r_key"), F.col("name").alias("r_name")), "r_key")
    hits = pairs.withColumn("score", name_similarity(F.col("name"), F.col("r_name"))).where(F.col("score") >= threshold)
    hits = hits.groupBy("key").agg(F.count("*").alias("hits"), F.max("score").alias("score"), F.max("r_key").alias("r_key"))
    second = rest.join(hits, rest["id"] == hits["key"], "left").select(
        "id",
        F.when(person, PERSON).when(F.col("hits") == 1, UNIQUE).when(F.col("hits") > 1, SEVERAL).otherwise(NOT_FOUND).alias("category"),
        F.when(F.col("hits") == 1, F.round("score", 3)).alias("similarity"),
        F.when(F.col("hits") == 1, F.col("r_key")).alias("register_ico"),
    )
    return first.unionByName(second)
