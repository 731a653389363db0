"""Operator 12: documents drawn by importance weights towards a target distribution.

Features are runs of words, hashed into buckets.  Two counts of buckets, of all
documents and of all target texts, give every bucket a gain; a document's weight is
the mean gain of its features, one array lookup a feature.  A Gumbel number made from
the id turns the highest scores into a draw without replacement that repeats exactly.

The cutoff comes from a quantile sketch: two quantiles on each side of the share
bracket it, exact counts outside the bracket prove that it lies inside (or the next,
wider quantiles are taken, to the smallest and largest score at last), and the bracket
alone is sorted to locate it.  Drawn rows get their ranks from a sort by ranges, whose
partitions are numbered from their sizes: no rows pass through one task.

Words are runs of ASCII letters and digits and of all characters beyond ASCII, A-Z
lower-cased.  A null text has no words; a document without features weighs 0; a null id
is hashed as empty and comes last among ties; rows that repeat an id are drawn each.
Empty tables count as no features.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import written
from .textblocks import LOWER, NOT_ALNUM, Block, blocks, run_hashes, word_bounds, word_hashes

BUCKETS = 10_000
#: Longest run of words that is a feature.
ORDER = 1
SEED = 2024
MIN_WORDS = 20
#: Share drawn, in percent.
PERCENT = 10
#: A rank of the sketch is wrong by at most one in so many.
ACCURACY = 2_000


def feature_buckets(b: Block, order: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of all features of a block, their document numbers, and the words of each document."""
    data = LOWER[b.data]
    starts, ends, doc = word_bounds(data, b.offsets, NOT_ALNUM)
    words, raw = word_hashes(data, starts, ends), data.tobytes()
    found, docs = [], []
    for k in range(1, order + 1):
        runs = words if k == 1 else run_hashes(words, k)
        at = np.flatnonzero(doc[: len(runs)] == doc[k - 1 :]) if len(runs) else np.zeros(0, np.int64)
        _, first, number = np.unique(runs[at], return_index=True, return_inverse=True)
        a, z = starts, ends
        own = [zlib.crc32(b" ".join([raw[a[j] : z[j]] for j in range(i, i + k)])) % buckets for i in at[first].tolist()]
        found.append(np.array(own, np.int64)[number] if len(own) else np.zeros(0, np.int64))
        docs.append(doc[at])
    return np.concatenate(found), np.concatenate(docs), np.bincount(doc, minlength=b.n)


def bucket_counts(texts: DataFrame, order: int = ORDER, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket: as many numbers as buckets, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in blocks(batches):
            total += np.bincount(feature_buckets(b, order, buckets)[0], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["bucket", "n"])

    counts = np.zeros(buckets, np.int64)
    rows = texts.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():
        counts[bucket] = n
    return counts


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the smoothed ratio of shares) of each bucket."""
    k, s_all, t_all = len(source), float(source.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + k) / ((s + 1.0) * (t_all + k)))) for s, t in zip(source.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: int | None, seed: int) -> int:
    """The number added to a weight: the same for the same id and seed."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gain: np.ndarray, order: int = ORDER, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            found, doc, n_words = feature_buckets(b, order, len(gain))
            n = np.bincount(doc, minlength=b.n)
            total = np.zeros(b.n, np.int64)
            np.add.at(total, doc, gain[found])
            weight = total // np.maximum(n, 1)
            ids = b.column("doc_id")
            score = weight + np.array([gumbel(i, seed) for i in ids.to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (n_words, n, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, "doc_id long, n_words long, n_features long, weight long, score long")


def bracket(rows: DataFrame, score: str, n: int, k: int, accuracy: int = ACCURACY) -> tuple[int, int, int]:
    """(low, high, above): the k-th highest of n scores lies in low..high, and ``above`` rows are over high.

    Sketched quantiles ever farther from the share sought; the exact counts outside decide.
    """
    share = 1 - k / n
    widths = [2.0**i / accuracy for i in range(1, accuracy.bit_length())]
    lows = [max(0.0, share - w) for w in widths] + [0.0]
    highs = [min(1.0, share + w) for w in widths] + [1.0]
    marks, least, most = rows.agg(F.percentile_approx(score, lows + highs, F.lit(accuracy)), F.min(score), F.max(score)).first()
    low, high = [*marks[: len(lows) - 1], least], [*marks[len(lows) : -1], most]
    i = j = 0
    while True:
        above, below = rows.agg(F.count(F.when(F.col(score) > high[j], 1)), F.count(F.when(F.col(score) < low[i], 1))).first()
        over, under = above >= k, n - below < k
        if not over and not under:
            return low[i], high[j], above
        i, j = i + under, j + over


def numbered(spark: SparkSession, rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``place`` 1, 2, 3 ... in the given order, which must leave no ties; a written table.

    Sorted by ranges; a row's place is its place in its partition after the sizes of those before.
    """
    kept = written(spark, rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("at", 33)  # the id counts rows within a partition from its number in the upper bits
    sizes = kept.groupBy(part.alias("part")).agg(F.count("*").alias("size")).orderBy("part").collect()  # as many as partitions
    before, ends = 0, []
    for p, size in sizes:
        ends.append((p, before))
        before += size
    starts = spark.createDataFrame(ends, "part int, before long")
    placed = kept.withColumn("part", part.cast("int")).join(F.broadcast(starts), "part")
    out = placed.withColumn("place", F.col("before") + F.col("at") - F.shiftleft(F.col("part").cast("long"), 33) + 1).drop("part", "before", "at")
    out.scratch_path = kept.scratch_path
    return out


def draw(spark: SparkSession, docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, order: int = ORDER, buckets: int = BUCKETS, seed: int = SEED, accuracy: int = ACCURACY) -> DataFrame:
    """Every row's doc_id, n_features, weight, score and rank (null where it isn't drawn)."""
    gain = gains(bucket_counts(docs, order, buckets), bucket_counts(target, order, buckets))
    scored = written(spark, weighed(docs, gain, order, seed).withColumn("row", F.monotonically_increasing_id()), "weighed")
    none = F.lit(None).cast("long")
    fits = F.col("n_words") >= min_words
    n = scored.where(fits).count()
    k = n * percent // 100
    out = ["doc_id", "n_features", "weight", "score"]
    if not k:
        return scored.select(*out, none.alias("rank"))
    low, high, above = bracket(scored.where(fits), "score", n, k, accuracy)
    keys = F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features"), F.col("row")
    top = numbered(spark, scored.where(fits & (F.col("score") > high)), *keys)
    middle = numbered(spark, scored.where(fits & F.col("score").between(low, high)), *keys)
    place = F.col("place") + above
    rest = scored.where(~fits | (F.col("score") < low)).select(*out, none.alias("rank"))
    return top.select(*out, F.col("place").alias("rank")).unionByName(middle.select(*out, F.when(place <= k, place).alias("rank"))).unionByName(rest)


def op12_target_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return draw(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


#: DuckDB has no crc32: its table and the fold over the bytes of each distinct word stand in SQL.
OP12_SQL = r"""
WITH steps AS (SELECT i, list_reduce(list_prepend(i, [1, 2, 3, 4, 5, 6, 7, 8]), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)),
crc AS (SELECT list(c ORDER BY i) AS t FROM steps),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
b AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
dw AS (SELECT doc_id, unnest(words) AS w FROM d),
bw AS (SELECT unnest(words) AS w FROM b),
v AS (SELECT w, hex(w) AS h FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
k AS (SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(h), 2), lambda i: (16 * (strpos('0123456789ABCDEF', h[i]) - 1) + strpos('0123456789ABCDEF', h[i + 1]) - 1)::BIGINT)),
    lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1]))) % 10000 AS bucket FROM v, crc),
s AS (SELECT bucket, count(*) AS s FROM dw JOIN k USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bw JOIN k USING (w) GROUP BY bucket),
g AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM dw) + 10000)::DOUBLE / ((s + 1)::DOUBLE * ((SELECT count(*) FROM bw) + 10000)::DOUBLE)))::BIGINT AS gain FROM s LEFT JOIN t USING (bucket)),
m AS (SELECT doc_id, count(*) AS n, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM dw JOIN k USING (w) JOIN g USING (bucket) GROUP BY doc_id),
h AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_prepend(0::BIGINT, list_transform(range(1, 9), lambda i: (strpos('0123456789abcdef', sha256('2024:' || doc_id)[i]) - 1)::BIGINT)), lambda a, x: a * 16 + x) AS h FROM documents LEFT JOIN m USING (doc_id)),
z AS (SELECT doc_id, n_features, weight, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM h),
r AS (SELECT *, CASE WHEN n_features >= 20 THEN row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) END AS place, count(*) FILTER (n_features >= 20) OVER () AS n FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank FROM r
"""
