"""Operator 6: substring dedup by seed and extend.

A window of 35 words is repeated if its word sequence starts anywhere else too;
every word that a repeated window covers goes.

*Seeds.*  Each window picks the smallest 8-word hash inside it (winnowing), so
equal windows pick equal seeds at the same place; about 7 % of positions are
seeds.  Seeds meet by hash.  *Extension.*  Around a seed met elsewhere, the
windows that picked it, up to 27 words to either side, meet by the hash of all 35
words: the equal ones are the match extended both ways as far as it holds, and
consecutive ones join to maximal repeats.  No pairs of documents are formed, so a
passage in a third of all documents costs one entry a document group.

Documents are dealt once by a key of id and text, and all three steps read that
same exchange.  A group's words are numbered in key order, so a place is four
bytes.  What is met twice in one group is known there and sent on once.

Null texts have no words; identical rows repeat each other; rows with null or
equal ids are judged as rows; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bucket_count, text_bytes, with_row_key
from .textblocks import U64, WHITESPACE, blocks, run_hashes, split_points, word_bounds, word_hashes

WINDOW = 35
SEED = 8
_PLACE = U64((1 << 24) - 1)
NOWHERE = np.uint32(2**32 - 1)

BLOB = pa.schema([("bucket", pa.int32()), ("grp", pa.int32()), ("keys", pa.binary()), ("places", pa.binary())])
BLOB_SQL = "bucket int, grp int, keys binary, places binary"


def _sorted(table: pa.Table) -> pa.RecordBatch:
    """The group's documents in an order that rows alone decide."""
    return table.sort_by([("rk", "ascending"), ("text", "ascending")]).combine_chunks().to_batches()[0] if len(table) else None


def _windows(b) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: word hashes, seed hashes, and for each start of a window whether it is one and where its seed is."""
    starts, ends, doc = word_bounds(b.data, b.offsets, WHITESPACE)
    words = word_hashes(b.data, starts, ends)
    seeds = run_hashes(words, SEED)
    n = len(words) - WINDOW + 1
    if n <= 0:
        return words, seeds, np.zeros(0, bool), np.zeros(0, np.int64)
    low = (seeds & ~_PLACE) | (np.arange(len(seeds)).astype(U64) & _PLACE)
    span = WINDOW - SEED + 1
    size = 1
    while 2 * size <= span:
        low = np.minimum(low[:-size], low[size:])
        size *= 2
    if span > size:
        low = np.minimum(low[: len(low) - (span - size)], low[span - size :])
    here = np.arange(n)
    at = here + (((low[:n] & _PLACE).astype(np.int64) - here) & int(_PLACE))
    return words, seeds, doc[:n] == doc[WINDOW - 1 :], at


def _blobs(keys: np.ndarray, places: np.ndarray, group: int, buckets: int) -> pa.Table:
    """Entries of one group by hash bucket, and the places known to be repeated already (bucket < 0: straight back)."""
    order = np.argsort(keys)
    keys, places = keys[order], places[order]
    cuts = split_points(keys)
    many = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    known = places[many]
    first = np.zeros(len(keys), bool)
    first[cuts[:-1]] = True
    places = np.where(many, NOWHERE, places)[first]
    keys = keys[first]
    bucket = ((keys >> U64(32)) % U64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, places = bucket[order], keys[order], places[order]
    at = split_points(bucket)
    rows = [(int(bucket[a]), group, keys[a:z].tobytes(), places[a:z].tobytes()) for a, z in zip(at[:-1], at[1:])]
    if len(known):
        rows.append((-1 - group, group, None, known.tobytes()))
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOB)], schema=BLOB) if rows else BLOB.empty_table()


def _repeated(table: pa.Table) -> pa.Table:
    """Of one bucket: the places whose key came more than once."""
    keys, places, groups, rows = [], [], [], []
    for grp, k, p in zip(*(table.column(c).to_pylist() for c in ("grp", "keys", "places"))):
        if k is None:
            rows.append((0, grp, None, p))
            continue
        keys.append(np.frombuffer(k, U64))
        places.append(np.frombuffer(p, np.uint32))
        groups.append(grp)
    if keys:
        row = np.repeat(np.arange(len(keys)), [len(x) for x in keys])
        key, place = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(key)
        cuts = split_points(key[order])
        many = np.zeros(len(key), bool)
        many[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
        many &= place != NOWHERE
        row, place = row[many], place[many]
        at = split_points(row)
        rows += [(0, groups[row[a]], None, place[a:z].tobytes()) for a, z in zip(at[:-1], at[1:])]
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOB)], schema=BLOB) if rows else BLOB.empty_table()


def _places(answers: pa.Table) -> np.ndarray:
    got = [np.frombuffer(x, np.uint32) for x in answers.column("places").to_pylist()]
    return np.concatenate(got).astype(np.int64) if got else np.zeros(0, np.int64)


def _seed_step(buckets: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        keys, places, base = [], [], 0
        for b in blocks([_sorted(table)]):
            words, seeds, valid, at = _windows(b)
            picked = np.unique(at[valid])
            keys.append(seeds[picked])
            places.append((picked + base).astype(np.uint32))
            base += len(words)
        return _blobs(np.concatenate(keys), np.concatenate(places), table.column("grp")[0].as_py(), buckets)

    return run


def _extend_step(buckets: int) -> Callable:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not len(table) or not len(answers):
            return BLOB.empty_table()
        hits = np.sort(_places(answers))
        keys, places, base = [], [], 0
        for b in blocks([_sorted(table)]):
            words, seeds, valid, at = _windows(b)
            met = np.zeros(len(words), bool)
            met[hits[np.searchsorted(hits, base) : np.searchsorted(hits, base + len(words))] - base] = True
            starts = np.flatnonzero(valid & met[at]) if len(at) else np.zeros(0, np.int64)
            keys.append(run_hashes(words, WINDOW)[starts])
            places.append((starts + base).astype(np.uint32))
            base += len(words)
        return _blobs(np.concatenate(keys), np.concatenate(places), table.column("grp")[0].as_py(), buckets)

    return run


def _cut_step(texts: bool) -> Callable:
    def run(table: pa.Table, answers: pa.Table) -> pa.Table:
        kind = pa.string()
        if not len(table):
            return pa.table([pa.array([], t) for t in (pa.int64(), pa.int64(), pa.int64(), kind)], names=["doc_id", "n_words", "n_removed", "kept"])
        hits = np.unique(_places(answers))
        outs, base = [], 0
        for b in blocks([_sorted(table)]):
            starts, ends, doc = word_bounds(b.data, b.offsets, WHITESPACE)
            own = hits[np.searchsorted(hits, base) : np.searchsorted(hits, base + len(starts))] - base
            step = np.zeros(len(starts) + 1, np.int64)
            step[own] += 1
            step[np.minimum(own + WINDOW, len(starts))] -= 1
            gone = np.cumsum(step[:-1]) > 0
            n_words = np.bincount(doc, minlength=b.n)
            n_gone = np.bincount(doc[gone], minlength=b.n)
            first = np.cumsum(n_words) - n_words
            raw, kept = b.data.tobytes(), []
            for i in range(b.n):
                own_words = raw[b.offsets[i] : b.offsets[i + 1]].split()
                if n_gone[i]:
                    own_words = [w for w, g in zip(own_words, gone[first[i] : first[i] + n_words[i]].tolist()) if not g]
                joined = b" ".join(own_words)
                kept.append(joined.decode() if texts else hashlib.sha256(joined).hexdigest())
            outs.append(pa.table([b.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(kept, kind)], names=["doc_id", "n_words", "n_removed", "kept"]))
            base += len(starts)
        return pa.concat_tables(outs)

    return run


def cut_repeats(spark: SparkSession, docs: DataFrame, texts: bool = True) -> DataFrame:
    """Every row -> (doc_id, n_words, n_removed, kept): kept words joined by spaces, or their SHA-256."""
    keyed = with_row_key(docs)
    n = bucket_count(spark, text_bytes(keyed))
    dealt = keyed.select(F.pmod(F.xxhash64("rk"), F.lit(n)).cast("int").alias("grp"), "rk", "doc_id", "text")
    by_group = dealt.groupBy("grp")
    seeds = by_group.applyInArrow(_seed_step(n), BLOB_SQL).groupBy("bucket").applyInArrow(_repeated, BLOB_SQL)
    windows = by_group.cogroup(seeds.groupBy("grp")).applyInArrow(_extend_step(n), BLOB_SQL).groupBy("bucket").applyInArrow(_repeated, BLOB_SQL)
    return by_group.cogroup(windows.groupBy("grp")).applyInArrow(_cut_step(texts), "doc_id long, n_words long, n_removed long, kept string")


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return cut_repeats(spark, docs, texts=False).withColumnRenamed("kept", "kept_sha256")


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT rid, p, md5(array_to_string(w[p : p + 34], ' ')) AS k FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
again AS (SELECT k FROM win GROUP BY k HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(p, p + 35)) AS p FROM win SEMI JOIN again USING (k)),
words AS (SELECT rid, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS word FROM d WHERE len(w) > 0),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY p) AS text FROM words ANTI JOIN gone USING (rid, p) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN (SELECT rid, count(*) AS n FROM gone GROUP BY rid) g USING (rid) LEFT JOIN kept USING (rid)
"""
