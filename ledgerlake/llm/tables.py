"""Scratch tables in the folder that driver and executors share, and small Spark helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: By application: the fresh folders of local sessions that name none.
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``.

    Where that is unset: a fresh folder in a session of one process, as in tests; an error on a
    cluster, whose executors would each write to a disk of their own.
    """
    here = spark.conf.get("spark.checkpoint.dir", None)
    if not here:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = "file://" + tempfile.mkdtemp(prefix="spark-scratch-")
        here = _own[app]
    return here.rstrip("/")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage and survives lost executors."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch_path = path
    return back


def discard(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete tables of ``written`` that nothing reads any more."""
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def with_row_key(docs: DataFrame) -> DataFrame:
    """doc_id, text and a 64-bit key of both, so that repeated or null ids stay apart where their texts differ."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).withColumn("rk", F.xxhash64("doc_id", "text"))


def row_key(docs: DataFrame):
    """The key that ``with_row_key`` gives a row of ``docs``."""
    return F.xxhash64(docs["doc_id"].cast("long"), docs["text"].cast("string"))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def bucket_count(spark: SparkSession, total: int, each: int = 16 << 20) -> int:
    """Hash buckets such that one holds what about ``each`` of ``total`` bytes give: memory of a bucket doesn't grow with the input."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // each), 1)
