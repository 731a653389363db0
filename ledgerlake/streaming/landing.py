"""Landing as a stream (R01) and work lists that go on where a run stopped."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.landing import new_records

#: Seconds to wait after the first, second ... failure in a row; after as many an item is given up.
WAITS = (30, 60, 120)


def exists(spark: SparkSession, folder: str) -> bool:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def landed_beside(batch: DataFrame, target: str, day: str) -> DataFrame:
    """What is landed on the days of a batch: only those folders of the target are read."""
    days = [r[0] for r in batch.select(day).distinct().collect()]  # as many as days in one batch
    landed = batch.sparkSession.read.parquet(target)
    known = [d for d in days if d is not None]
    there = F.col(day).isin(known) if known else F.lit(False)
    return landed.where(there | F.col(day).isNull() if None in days else there)


def land_stream(spark: SparkSession, incoming: DataFrame, target: str, checkpoint: str, key: list[str], day: str | None = None) -> StreamingQuery:
    """Append records of a file stream to Parquet at ``target``, each key once.

    A batch drops its own repeats, and the anti-join with what is landed keeps keys unique across
    batches and after one that is tried again.  There is no watermark: records land however late
    they come.  With ``day``, a date column that the key determines (such as the day of publication
    of a record whose content is in the key), the target has a folder a day and a batch reads the
    folders of its own days only, so its cost follows the batch and not the target.
    """

    def land(batch: DataFrame, _: int) -> None:
        session = batch.sparkSession
        if not exists(session, target):
            new = batch.dropDuplicates(key)
        else:
            new = new_records(batch, landed_beside(batch, target, day) if day else session.read.parquet(target), key)
        out = new.write.mode("append")
        (out.partitionBy(day) if day else out).parquet(target)

    return incoming.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def work_states(items: DataFrame, attempts: DataFrame, waits: tuple[int, ...] = WAITS) -> DataFrame:
    """Of each item its state, attempts, failures in a row since the last success, and when to try next.

    ``attempts`` has (item, at, ok).  An item is ``done`` after a success, ``given_up`` after more failures in
    a row than there are waits, ``failed`` while it waits for another attempt, ``open`` before the first.
    """
    tried = attempts.groupBy("item").agg(F.count("*").alias("attempts"), F.max(F.when(F.col("ok"), F.col("at"))).alias("done_at"), F.max("at").alias("last_at"))
    rows = items.join(tried, "item", "left").withColumn("attempts", F.coalesce("attempts", F.lit(0)))
    wait = F.try_element_at(F.array(*[F.lit(w) for w in waits]), F.col("attempts").cast("int"))
    state = F.when(F.col("done_at").isNotNull(), "done").when(F.col("attempts") == 0, "open").when(F.col("attempts") > len(waits), "given_up").otherwise("failed")
    rows = rows.withColumn("state", state)
    return rows.withColumn("next_at", F.when(F.col("state") == "failed", F.timestamp_seconds(F.unix_timestamp("last_at") + wait)))


def work_off(items: DataFrame, log: str, do: Callable[[DataFrame], DataFrame], slices: int = 8, waits: tuple[int, ...] = WAITS) -> None:
    """Try all open items and the failed ones whose wait is over, slice by slice, and log each slice's attempts at ``log``.

    ``do`` gives (item, at, ok, ...) for a DataFrame of items.  What a stopped run has logged is not tried again.
    """
    spark = items.sparkSession
    for k in range(slices):
        seen = spark.read.parquet(log) if exists(spark, log) else spark.createDataFrame([], "item string, at timestamp, ok boolean")
        part = items.where(F.pmod(F.xxhash64("item"), F.lit(slices)) == k)
        ready = work_states(part, seen.select("item", "at", "ok"), waits).where((F.col("state") == "open") | ((F.col("state") == "failed") & (F.col("next_at") <= F.current_timestamp())))
        do(ready.select(items.columns)).write.mode("append").parquet(log)
