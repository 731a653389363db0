"""Operator 11: what each filter of a row of filters removes, alone and in every order.

One scan marks which filters a document fails.  Everything else follows from the
counts of each part's 2 x 2 x 2 x 2 x 2 combinations: they become a tensor with one
axis a filter (0 passes, 1 fails), and a step of an order is a contraction that takes
"pass" along the axes of the filters before it, "fail" along its own and both along
the rest.  ``einsum`` does all steps of all orders of many parts at once, in integers.

The filters (a null text is an empty one; words are runs of other than white space):
A under 50 words; B fewer than 65 % of the words distinct; C over 5 % capital ASCII
letters; D any of ``#$%&*|``; E the text of a smaller id, wherever it stands.

A null id compares with nothing: its row passes E and makes no other fail.  Rows that
repeat an id and its text fail E together or not at all.  Of repeated labels the largest counts, missing
or null ones are 0.  A null source is the part ``''``.  No documents, no rows.  Only the
named columns are read, so further ones don't matter.

Scale: a document becomes one row of its id, part, a digest of its text and five bits;
copies are folded within (text, part) before texts meet across parts, so a group of
copies of any size costs one row a mapper and part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import written

#: Failure conditions of a whole text, in the order of their axes; the last axis is E.
TEXT_FILTERS = "ABCD"
FILTERS = TEXT_FILTERS + "E"
_SPACE = " \t\n\x0b\x0c\r"
#: Parts whose steps are worked out at a time: bounds the memory of a task.
PARTS = 256


def failures(text: Column) -> dict[str, Column]:
    """The conditions A to D as columns of a text that isn't null."""
    inner = F.btrim(text, F.lit(_SPACE))
    words = F.split(inner, "[\\x20\\x09-\\x0D]+")
    n = F.when(inner == "", 0).otherwise(F.size(words))
    distinct = F.when(inner == "", 0).otherwise(F.size(F.array_distinct(words)))
    return {
        "A": n < 50,
        "B": 100 * distinct.cast("long") < 65 * n.cast("long"),
        "C": 100 * F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long") > 5 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def _cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(same, part, bits) with counts of all rows, of rows without id, and of those of its smallest id."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    fails = failures(text)
    bits = sum((F.when(fails[k], 1 << i).otherwise(0) for i, k in enumerate(TEXT_FILTERS)), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(text, 256)).alias("same"),
        bits.alias("bits"),
    )
    rows = rows.groupBy("doc_id", "part", "same", "bits").agg(F.count("*").alias("n"))
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"), F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic")
    )
    rows = rows.join(known, "doc_id", "left").select("doc_id", "part", "same", "bits", "n", *[(F.col("n") * F.coalesce(c, F.lit(0))).alias(c) for c in ("good", "toxic")])
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n", "good", "toxic")))
    return rows.groupBy("same", "part", "bits").agg(
        F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic"),
        F.coalesce(F.sum(F.when(F.col("doc_id").isNull(), F.col("n"))), F.lit(0)).alias("no_id"),
        first.alias("first"),
    )


def contingency(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, bits, n, good, toxic): documents by the filters that they fail, as a bit set over ``FILTERS``."""
    cells = written(spark, _cells(docs, labels), "filter-cells")
    heads = cells.groupBy("same").agg(F.min("first.doc_id").alias("head"))
    cells = cells.join(heads, "same").withColumn("leads", F.col("first.doc_id") == F.col("head"))
    none = F.lit(0).cast("long")

    def stays(of: str, without_id: Column) -> Column:
        return without_id + F.when(F.col("leads"), F.col(f"first.{of}")).otherwise(none)

    held = F.struct(F.col("bits").alias("bits"), stays("n", F.col("no_id")).alias("n"), stays("good", none).alias("good"), stays("toxic", none).alias("toxic"))
    gone = F.struct((F.col("bits") + (1 << len(TEXT_FILTERS))).alias("bits"), *[(F.col(c) - stays(c, F.col("no_id") if c == "n" else none)).alias(c) for c in ("n", "good", "toxic")])
    both = cells.select("part", F.explode(F.array(held, gone)).alias("c")).select("part", "c.*").where("n > 0")
    return both.groupBy("part", "bits").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def selectors(k: int) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """All orders of ``k`` filters, and for each step the filter and what it takes along each axis: (steps, k, [pass, fail])."""
    orders = ["".join(p) for p in permutations(FILTERS[:k])]
    here = np.array([[FILTERS.index(c) for c in o] for o in orders])
    place = np.argsort(here, axis=1)[:, None, :]  # of each filter in an order
    step = np.arange(k)[None, :, None]
    before, own = place < step, place == step
    removed = np.stack([~own, ~before], axis=-1).astype(np.int64)
    kept = np.stack([np.ones_like(own), ~(before | own)], axis=-1).astype(np.int64)
    return orders, here.reshape(-1), removed.reshape(-1, k, 2), kept.reshape(-1, k, 2)


def contract(tensor: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Counts (parts, measures, 2, ..., 2) summed over what each step takes along each axis -> (parts, measures, steps)."""
    k = chosen.shape[1]
    axes = "abcdefgh"[:k]
    takes = [chosen[:, i] for i in range(k)]
    return np.einsum(f"pm{axes},{','.join('r' + a for a in axes)}->pmr", tensor, *takes, optimize=True)


def audit_tensor(tensor: np.ndarray) -> dict[str, np.ndarray]:
    """All counts of every step of every order, for many parts: each (parts, orders * filters)."""
    k = tensor.ndim - 2
    _, here, removed, kept = selectors(k)
    gone = contract(tensor, removed)
    alone = np.stack([1 - np.eye(k, dtype=np.int64), np.eye(k, dtype=np.int64)], axis=-1)  # fails its own, passes all others
    fails = np.stack([1 - np.eye(k, dtype=np.int64), np.ones((k, k), np.int64)], axis=-1)  # fails its own, any of the others
    own, every = contract(tensor[:, :1], alone)[:, 0], contract(tensor[:, :1], fails)[:, 0]
    total = np.zeros_like(every)
    np.add.at(total, (slice(None), here), gone[:, 0])
    return {
        "kept": contract(tensor[:, :1], kept)[:, 0],
        "removed": gone[:, 0],
        "redundant": every[:, here] - gone[:, 0],
        "unique_fails": own[:, here],
        "good_lost": gone[:, 1],
        "toxic_lost": gone[:, 2],
        "shapley": total[:, here],
    }


def _audit(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        orders = selectors(k)[0]
        for batch in batches:
            for i in range(0, batch.num_rows, PARTS):
                part = batch.slice(i, PARTS)
                lists, n = part.column("cells"), part.num_rows
                cells = lists.flatten()
                row = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
                flat = np.zeros((n, 3, 1 << k), np.int64)
                for m, c in enumerate(("n", "good", "toxic")):
                    flat[row, m, cells.field("bits").to_numpy()] = cells.field(c).to_numpy()
                # bit i of a cell is filter i: the first filter is the last axis of a reshape
                tensor = flat.reshape(n, 3, *[2] * k).transpose(0, 1, *range(k + 1, 1, -1))
                found = audit_tensor(tensor)
                steps = len(orders) * k
                columns = [part.column("part").take(pa.array(np.repeat(np.arange(n), steps))), pa.array(np.tile(np.repeat(orders, k), n)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n * len(orders)))]
                yield pa.RecordBatch.from_arrays(columns + [pa.array(v.reshape(-1)) for v in found.values()], names=["part", "filter_order", "step", *found])

    return run


def audit(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the filters and step, with its counts."""
    cells = contingency(spark, docs, labels).groupBy("part").agg(F.collect_list(F.struct("bits", "n", "good", "toxic")).alias("cells"))  # 32 at most
    counts = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return cells.mapInArrow(_audit(len(FILTERS)), f"part string, filter_order string, step int, {counts}")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


OP11_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
f AS (SELECT doc_id, part,
    CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
    || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
    || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
    || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
    || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails
  FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, fails),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS k),
o AS (SELECT a.k || b.k || c.k || d.k || e.k AS filter_order FROM x a, x b, x c, x d, x e WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
s AS (SELECT filter_order, step, filter_order[step] AS k, filter_order[1:step - 1] AS before FROM o, (SELECT unnest([1, 2, 3, 4, 5])::INTEGER AS step)),
r AS (SELECT part, filter_order, step, k, n, good, toxic, fails, contains(fails, k) AS here,
    before <> '' AND regexp_matches(fails, '[' || CASE WHEN before = '' THEN '-' ELSE before END || ']') AS earlier FROM c, s),
g AS (SELECT part, filter_order, step, k,
    coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (here AND NOT earlier), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (here AND earlier), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (fails = k), 0)::BIGINT AS unique_fails,
    coalesce(sum(good) FILTER (here AND NOT earlier), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (here AND NOT earlier), 0)::BIGINT AS toxic_lost
  FROM r GROUP BY part, filter_order, step, k)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, k))::BIGINT AS shapley FROM g
"""
