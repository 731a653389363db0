"""Readers of the source files: XML dumps, JSON pages, CSV registers, rates, methodologies."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

_SUBJECT = "STRUCT<nazev: STRING, ico: STRING, adresa: STRING>"
#: One record of the contract register.
CONTRACT = f"""identifikator STRUCT<idSmlouvy: STRING, idVerze: STRING>, odkaz STRING, casZverejneni STRING,
smlouva STRUCT<subjekt: {_SUBJECT}, smluvniStrana: ARRAY<{_SUBJECT}>, predmet: STRING, datumUzavreni: STRING, cisloSmlouvy: STRING,
  hodnotaBezDph: STRING, hodnotaVcetneDph: STRING, ciziMena: STRUCT<hodnota: STRING, mena: STRING>>,
prilohy STRUCT<priloha: ARRAY<STRUCT<nazevSouboru: STRING, hash: STRING, odkaz: STRING>>>, platnyZaznam STRING"""


def contract_dump(spark: SparkSession, path: str) -> DataFrame:
    """One row for each ``<zaznam>`` of a dump, with nested parties and attachments."""
    raw = spark.read.format("xml").option("rowTag", "zaznam").schema(CONTRACT).load(path)
    number = lambda c: F.col(c).try_cast("decimal(18,2)")
    return raw.select(
        F.col("identifikator.idSmlouvy").alias("contract_id"),
        F.col("identifikator.idVerze").alias("version_id"),
        F.col("odkaz").alias("url"),
        F.col("casZverejneni").try_cast("timestamp").alias("published"),
        F.col("smlouva.subjekt").alias("publisher"),
        F.coalesce("smlouva.smluvniStrana", F.array().cast(f"array<{_SUBJECT}>")).alias("parties"),
        F.col("smlouva.predmet").alias("subject"),
        F.col("smlouva.datumUzavreni").try_cast("date").alias("signed"),
        F.col("smlouva.cisloSmlouvy").alias("number"),
        number("smlouva.hodnotaBezDph").alias("net"),
        number("smlouva.hodnotaVcetneDph").alias("gross"),
        F.col("prilohy.priloha").alias("attachments"),
        (F.col("platnyZaznam") == "1").alias("valid"),
    )


def xml_records(spark: SparkSession, path: str, row_tag: str) -> DataFrame:
    """Elements of any XML file as rows; repeated children become arrays, attributes ``_name``."""
    return spark.read.format("xml").option("rowTag", row_tag).load(path)


def notice_pages(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Notices of paged JSON arrays as (id, payload), and the count for comparison with the source's own."""
    pages = spark.read.text(path, wholetext=True)
    items = pages.select(F.explode(F.from_json("value", "array<string>")).alias("payload"))
    rows = items.select(F.get_json_object("payload", "$.id").alias("id"), "payload")
    return rows, rows.agg(F.count("*").alias("landed"))


def values_of_key(df: DataFrame, id_column: str, json: str, key: str) -> DataFrame:
    """(id, place, value) of every scalar under a key anywhere in a JSON tree, lists flattened, in the order of ``place``.

    One recursive query opens all trees a level at a time, of any depth; every level reads what the one above
    found and opens nothing again.  A list's members keep the key of the list; texts that aren't JSON give nothing.
    Spark stops recursive queries at a million rows by default; that limit is lifted in the session.
    """
    df.sparkSession.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    rows = df.select(F.col(id_column).alias("id"), F.try_parse_json(json).alias("node")).where("node is not null")
    found = df.sparkSession.sql(
        """
        WITH RECURSIVE tree(id, place, key, node, inner) MAX RECURSION LEVEL 10000 AS (
          SELECT id, '', CAST(NULL AS STRING), node, schema_of_variant(node) LIKE 'ARRAY%' OR schema_of_variant(node) LIKE 'OBJECT%' FROM {rows}
          UNION ALL
          SELECT t.id, concat(t.place, '/', lpad(cast(e.pos AS string), 6, '0')), coalesce(e.key, t.key), e.value,
                 schema_of_variant(e.value) LIKE 'ARRAY%' OR schema_of_variant(e.value) LIKE 'OBJECT%'
          FROM tree t, LATERAL variant_explode(t.node) e WHERE t.inner
        )
        SELECT id, place, key, try_variant_get(node, '$', 'string') AS value FROM tree WHERE NOT inner
        """,
        rows=rows,
    )
    return found.where(F.col("key") == key).drop("key")


def grants(spark: SparkSession, grant: str, recipient: str, decision: str, first: str, stop: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Grants signed in a window, then their recipients, then their decisions, from CSV (gzip too)."""
    read = lambda p: spark.read.option("header", True).csv(p)
    g = read(grant)
    signed = F.substring("podpisDatum", 1, 10).try_cast("date")
    g = g.where((signed >= F.lit(first).cast("date")) & (signed < F.lit(stop).cast("date")) & (signed <= F.coalesce(F.substring("datumExportu", 1, 10).try_cast("date"), signed)))
    return g, read(recipient).join(g, "iriPrijemce", "left_semi"), read(decision).join(g, "iriDotace", "left_semi")


def operations(lines: DataFrame, header: str) -> DataFrame:
    """Rows of a sheet landed as (line_no, cells): those after the header row, without the English echo; id ``project#line``."""
    start = lines.where(F.array_contains("cells", header)).agg(F.min("line_no").alias("__start"))
    # one row: a proven bound
    rows = lines.join(F.broadcast(start)).where("line_no > __start")
    echo = (F.col("line_no") == F.col("__start") + 1) & ~F.array_join("cells", "").rlike("[0-9]")
    return rows.where(~echo & (F.trim(F.col("cells")[0]) != "")).select(F.concat(F.trim(F.col("cells")[0]), F.lit("#"), F.col("line_no").cast("string")).alias("id"), "line_no", "cells")


def file_kinds(spark: SparkSession, path: str) -> DataFrame:
    """(path, kind, delimiter) by the first bytes of each file, so that groups of files go to their readers."""
    files = spark.read.format("binaryFile").load(path).select("path", F.substring("content", 1, 4096).alias("head"))
    magic = F.hex(F.substring("head", 1, 4))
    text = F.ltrim(F.decode("head", "utf-8"))
    line = F.split_part(text, F.lit("\n"), F.lit(1))
    count = lambda d: F.length(line) - F.length(F.replace(line, F.lit(d), F.lit("")))
    kind = F.when(magic.startswith("504B0304"), "zip").when(magic.startswith("1F8B"), "gzip").when(text.startswith("{") | text.startswith("["), "json").when(text.startswith("<"), "xml").otherwise("csv")
    best = F.array_max(F.array(*[F.struct(count(d).alias("n"), F.lit(d).alias("d")) for d in (",", ";", "\t", "|")]))["d"]
    return files.select("path", kind.alias("kind"), F.when(kind == "csv", best).alias("delimiter"))


def yearly_rates(lines: DataFrame) -> DataFrame:
    """(currency, rate_day, rate) of a yearly rate file given as (year, line_no, line).

    The header may come again with other columns; each line is read under the last
    one above it.  A header cell is ``quantity code``; rates are for one unit.
    """
    cells = F.split("line", r"\|")
    head = F.when(F.lower("line").startswith("datum"), F.slice(cells, 2, 1000))
    over = W.partitionBy("year").orderBy("line_no").rowsBetween(W.unboundedPreceding, 0)
    rows = lines.select("year", F.last(head, ignorenulls=True).over(over).alias("head"), cells.alias("cells"), "line").where(~F.lower("line").startswith("datum"))
    pair = rows.select(F.try_to_timestamp(F.col("cells")[0], F.lit("dd.MM.yyyy")).cast("date").alias("rate_day"), F.explode(F.arrays_zip(F.col("head").alias("head"), F.slice("cells", 2, 1000).alias("value"))).alias("x"))
    quantity = F.split_part("x.head", F.lit(" "), F.lit(1)).try_cast("int")
    rate = F.translate("x.value", ",", ".").try_cast("double") / quantity
    return pair.select(F.split_part("x.head", F.lit(" "), F.lit(2)).alias("currency"), "rate_day", rate.alias("rate")).where("rate_day is not null and rate is not null")


def methodologies(spark: SparkSession, path: str) -> DataFrame:
    """One row for each methodology document: code, version, parameters as JSON."""
    text = spark.read.text(path, wholetext=True)
    tree = F.try_parse_json("value")
    get = lambda k, kind="string": F.try_variant_get(tree, f"$.{k}", kind)
    return text.select(get("kod").alias("code"), get("verze").alias("version"), F.to_json(get("parametry", "variant")).alias("parameters"), F.sha2("value", 256).alias("sha256"))


def newest_file(links: DataFrame, group: str, text: str) -> DataFrame:
    """Of each group the link with the latest date in its text."""
    day = F.try_to_timestamp(F.regexp_extract(text, r"(\d{1,2}\.\s?\d{1,2}\.\s?\d{4})", 1), F.lit("d.M.yyyy")).cast("date")
    return links.withColumn("__day", day).groupBy(group).agg(F.max_by("link", "__day").alias("link"), F.max("__day").alias("day"))


def amount_of(node: Column) -> Column:
    """struct(value, currency) of a scalar or of ``{_value, _currencyID}`` in a variant; null where not a number."""
    value = F.coalesce(F.try_variant_get(node, "$._value", "string"), F.try_variant_get(node, "$", "string")).try_cast("decimal(18,2)")
    return F.when(value.isNotNull(), F.struct(value.alias("value"), F.try_variant_get(node, "$._currencyID", "string").alias("currency")))
