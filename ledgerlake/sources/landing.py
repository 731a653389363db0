"""Landing of records: canonical hashes, insert-if-new, provenance and redaction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_hash(json: Column) -> Column:
    """SHA-256 of a JSON text with sorted keys and no spaces; of the text itself where it isn't JSON."""
    canonical = F.to_json(F.try_parse_json(json))
    return F.sha2(F.coalesce(canonical, json), 256)


def text_hash(text: Column) -> Column:
    """SHA-256 of a plain text as it stands, also where it could be read as JSON."""
    return F.sha2(text, 256)


def new_records(incoming: DataFrame, landed: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key is neither landed nor repeated in the batch."""
    return incoming.dropDuplicates(key).join(landed.select(*key), key, "left_anti")


def record_id(candidates: list[Column], fallback: Column) -> Column:
    """The first filled candidate, else the content hash."""
    return F.coalesce(*[F.nullif(F.trim(c), F.lit("")) for c in candidates], F.concat(F.lit("sha256:"), fallback))


def last_good(log: DataFrame, key: str) -> DataFrame:
    """The newest successful download of each address."""
    good = log.where("status = 200")
    return good.groupBy(key).agg(F.max_by(F.struct("at", "sha256"), F.struct("at", "sha256")).alias("x")).select(key, "x.*")


def runs(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Runs with their ends; a start without an end is unfinished."""
    return starts.join(ends, "run_id", "left").withColumn("status", F.coalesce("status", F.lit("unfinished")))


def links(pages: DataFrame) -> DataFrame:
    """(page_id, link): absolute links of a page, each once, fragments cut."""
    href = F.explode(F.regexp_extract_all("html", F.lit(r"""(?i)href\s*=\s*["']([^"'#]+)"""), F.lit(1))).alias("href")
    found = pages.select("page_id", "url", href)
    host = F.regexp_extract("url", r"^(https?://[^/]+)", 1)
    base = F.regexp_replace("url", r"[^/]*$", "")
    link = F.when(F.col("href").rlike("(?i)^[a-z][a-z0-9+.-]*:"), F.col("href")).when(F.col("href").startswith("/"), F.concat(host, "href")).otherwise(F.concat(base, "href"))
    return found.select("page_id", link.alias("link")).distinct()


def redacted(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Columns become null where their rule holds; ``redacted`` lists their names."""
    hit = {c: F.coalesce(rule, F.lit(False)) & F.col(c).isNotNull() for c, rule in rules.items()}
    names = F.array_compact(F.array(*[F.when(h, F.lit(c)) for c, h in hit.items()]))
    return df.select(*[F.when(~hit[c], F.col(c)).alias(c) if c in hit else F.col(c) for c in df.columns], names.alias("redacted"))


def rate_as_of(flows: DataFrame, rates: DataFrame, key: str, day: str, stale_days: int = 10) -> DataFrame:
    """The newest rate on or before a day, not older than ``stale_days``.

    A rate is repeated for the days it may serve, at most ``stale_days`` + 1, and
    the join is on equal days: its size is bounded and no sort of a whole key is needed.
    """
    ahead = rates.withColumn("__age", F.explode(F.sequence(F.lit(0), F.lit(stale_days)))).withColumn("__day", F.date_add("rate_day", F.col("__age")))
    serving = ahead.groupBy(key, "__day").agg(F.max_by(F.struct("rate", "rate_day"), "rate_day").alias("__r"))
    out = flows.join(serving.withColumnRenamed("__day", day), [key, day], "left")
    return out.select(*flows.columns, F.col("__r.rate").alias("rate"), F.col("__r.rate_day").alias("rate_day"))


def published(records: DataFrame, with_samples: bool = False) -> DataFrame:
    """Records without development samples (unless asked for) and without annulled notices."""
    kept = records.where(~F.coalesce("annulled", F.lit(False)))
    return kept if with_samples else kept.where(~F.coalesce("dev_sample", F.lit(False)))


#: States of a run.
SUCCESS, FAILED, SKIPPED, UNFINISHED = "uspech", "chyba", "preskoceno", "nedokonceno"


def run_ends(outcomes: DataFrame) -> DataFrame:
    """Outcomes (run_id, reachable, errors) with ``status``: skipped where the source can't be reached, failed with any error."""
    errors = F.coalesce(F.size("errors"), F.lit(0))
    return outcomes.withColumn("status", F.when(~F.coalesce("reachable", F.lit(False)), SKIPPED).when(errors > 0, FAILED).otherwise(SUCCESS))


def run_overview(starts: DataFrame, ends: DataFrame) -> DataFrame:
    """Every run with its end, ``status`` and ``n_errors``; a start without an end is unfinished."""
    rows = starts.join(ends, "run_id", "left")
    return rows.withColumns({"status": F.coalesce("status", F.lit(UNFINISHED)), "n_errors": F.coalesce(F.size("errors"), F.lit(0))})
