"""Registry of queries, and the driver tables seen as payers, recipients and flows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query under ``name`` with the SQL that gives the same rows."""

    def register(f):
        if name in QUERIES:
            raise ValueError(f"a query of the name {name} is there already")
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that a task of a join gets, about.
TASK_ROWS = 1 << 19


def tasks_for(df: DataFrame) -> int | None:
    """The tasks that the rows of a table ask for, so that a task's memory doesn't grow with it; none where the cores are enough.

    The count reads footers alone.
    """
    tasks = -(-df.count() // TASK_ROWS)
    return tasks if tasks > df.sparkSession.sparkContext.defaultParallelism else None


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each order line: flow, payer, recipient, signing day, exact amount and its kind; dealt by flow."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("order_day"), "o_orderpriority", "o_orderstatus")
    lines = table(spark, sf_dir, "lineitem")
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    if tasks := tasks_for(lines):
        lines, orders = lines.repartition(tasks, "l_orderkey"), orders.repartition(tasks, "o_orderkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_orderkey").alias("flow"),
        F.col("l_linenumber").alias("line"),
        F.col("o_custkey").alias("payer"),
        F.col("l_suppkey").alias("recipient"),
        F.to_date("l_shipdate").alias("day"),
        "order_day",
        amount.alias("amount"),
        F.col("l_returnflag").alias("type"),
        F.col("l_linestatus").alias("vat"),
        "l_discount",
        "o_orderpriority",
        "o_orderstatus",
    )


#: The same in SQL.
FLOWS = """flows AS (
  SELECT o_orderkey AS flow, l_linenumber AS line, o_custkey AS payer, l_suppkey AS recipient,
         CAST(l_shipdate AS DATE) AS day, CAST(o_orderdate AS DATE) AS order_day,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, l_returnflag AS type, l_linestatus AS vat,
         l_discount, o_orderpriority, o_orderstatus
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


#: What tells the lines of an order apart: line numbers come more than once.
_LINE_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_shipdate"]


def numbered_lines(spark: SparkSession, sf_dir: str, task_lines: int | None = None) -> DataFrame:
    """Order lines with ``n``, their place in the order.

    ``task_lines``: for work that takes long for its rows, so many lines a task, and fewer while each core has less than four tasks;
    Spark would put them together by their bytes.
    """
    lines = table(spark, sf_dir, "lineitem")
    if task_lines:
        rows = lines.count()
        tasks = max(-(-rows // task_lines), min(4 * spark.sparkContext.defaultParallelism, -(-rows // (task_lines >> 3))), 1)
        lines = lines.repartition(tasks, "l_orderkey")
    return lines.withColumn("n", F.row_number().over(W.partitionBy("l_orderkey").orderBy(*_LINE_ORDER)))


#: The same in SQL.
LINES = f"lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(_LINE_ORDER)})::INTEGER AS n FROM lineitem)"
