"""Writers that leave one result however often they are tried: several tables at once (B11), CSV of fixed columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _path(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(tables: dict[str, DataFrame], folder: str, run: str) -> None:
    """Write all tables of a run, then make them the current ones with one rename.

    Tables go to the run's own folder; a run that failed in between and is tried again writes
    them anew there.  Readers see the tables of the run before until the pointer has moved, and
    never tables of two runs.
    """
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/runs/{run}/{name}")
    spark.createDataFrame([(run,)], "run string").coalesce(1).write.mode("overwrite").json(f"{folder}/pointers/{run}")
    pointer, fs = _path(spark, f"{folder}/pointers/{run}")
    current, _ = _path(spark, f"{folder}/current")
    old, _ = _path(spark, f"{folder}/superseded")
    fs.delete(old, True)
    if fs.exists(current):
        fs.rename(current, old)
    fs.rename(pointer, current)


def published(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the current run; of the one before where a writer was lost between its two renames."""
    current, fs = _path(spark, f"{folder}/current")
    run = spark.read.schema("run string").json(f"{folder}/{'current' if fs.exists(current) else 'superseded'}").first()["run"]
    return spark.read.parquet(f"{folder}/runs/{run}/{name}")


def csv_extract(df: DataFrame, columns: list[str], folder: str) -> None:
    """CSV with a header and the given columns in their order; null and lacking columns are empty, further columns are left out."""
    have = set(df.columns)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in have else F.lit("").alias(c) for c in columns]
    df.select(*text).write.mode("overwrite").option("header", True).option("emptyValue", "").option("escape", '"').csv(folder)
