"""Operator 3: exact dedup with Patricia-trie owners.

Mappers fold the copies they see into one row (full bytes, member ids), so a
group of copies sends a bucket at most one text a mapper flush.  Rows go to
partitions by (length, content hash) and arrive sorted by both; each partition
inserts the full byte strings into a compressed radix trie whose terminals hold
the owner.  Texts count as equal only if they end in one terminal: hashes route,
bytes decide.  When a trie's bytes pass ``SPILL_BYTES`` the subtrees of lengths
already passed, which can take no more keys, are written out and freed.

Null counts as empty text.  The row with the largest (or smallest) id stays; null
ids rank lowest, and rows with the same id share its fate.  Empty tables give no
rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import bucket_count, fresh, text_bytes, written
from .textblocks import release

FOLD_BYTES = 8 << 20
SPILL_BYTES = 16 << 20
#: Bytes of an Arrow batch that become Python objects at a time, about.
SLICE_BYTES = 1 << 20

FOLDED = pa.schema([("length", pa.int64()), ("hash", pa.int64()), ("text", pa.large_binary()), ("members", pa.list_(pa.int64()))])
#: kind 0: members of a terminal; kind 1: the terminal itself.
TRIE = pa.schema([("kind", pa.int32()), ("length", pa.int64()), ("hash", pa.int64()), ("terminal", pa.int32()), ("members", pa.list_(pa.int64())), ("owner", pa.int64()), ("size", pa.int64()), ("sha", pa.string())])
TRIE_SQL = "kind int, length long, hash long, terminal int, members array<long>, owner long, size long, sha string"


class Node:
    """A compressed edge: ``key`` is its bytes, ``below`` its children by first byte."""

    __slots__ = ("key", "below", "terminal")

    def __init__(self, key: bytes, terminal=None):
        self.key, self.below, self.terminal = key, {}, terminal


def _agree(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving, so that long equal runs compare at memory speed."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class PatriciaTrie:
    """Byte strings with one terminal record each."""

    def __init__(self):
        self.root = Node(b"")
        self.bytes = 0

    def at(self, text: bytes, make) -> object:
        """The terminal record of ``text``, made by ``make()`` on its first insertion."""
        node, rest = self.root, text
        while True:
            if not rest:
                if node.terminal is None:
                    node.terminal = make()
                return node.terminal
            child = node.below.get(rest[0])
            if child is None:
                leaf = Node(rest, make())
                node.below[rest[0]] = leaf
                self.bytes += len(rest) + 200
                return leaf.terminal
            k = _agree(child.key, rest)
            if k < len(child.key):
                middle = Node(child.key[:k])
                child.key = child.key[k:]
                middle.below[child.key[0]] = child
                node.below[rest[0]] = middle
                child = middle
            node, rest = child, rest[k:]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut to about ``SLICE_BYTES`` of text; a longer text is a slice of its own."""
    for batch in batches:
        upto = np.cumsum(batch.column("length").to_numpy())
        i = 0
        while i < batch.num_rows:
            j = max(i + 1, int(np.searchsorted(upto, (upto[i - 1] if i else 0) + SLICE_BYTES, "right")))
            yield batch.slice(i, j - i)
            i = j


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, list] = {}
    size = 0

    def out() -> pa.RecordBatch:
        rows = [(v[0], v[1], k, v[2]) for k, v in held.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), FOLDED)], schema=FOLDED)

    for batch in _slices(batches):
        for i, text, length, h in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "length", "hash"))):
            if (row := held.get(text)) is None:
                held[text] = [length, h, [i]]
                size += length + 100
            else:
                row[2].append(i)
                size += 8
            if size >= FOLD_BYTES:
                yield out()
                held, size = {}, 0
    if held:
        yield out()
    del held
    release()


def _own(largest: bool):
    """Rows sorted by (length, hash) -> members with their terminal, and terminals when their subtree is complete."""
    better = (lambda a, b: a > b) if largest else (lambda a, b: a < b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tries: dict[int, PatriciaTrie] = {}  # one subtree for each length
        rows: list[tuple] = []
        order: dict[int, dict[int, int]] = {}
        records: dict[int, list] = {}
        held = 0

        def spill(lengths) -> None:
            for n in list(lengths):
                for h, t, owner, size, sha in records.pop(n, ()):
                    rows.append((1, n, h, t, None, owner, size, sha))
                tries.pop(n, None)
                order.pop(n, None)

        def out() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), TRIE)], schema=TRIE)
            rows.clear()
            return made

        for batch in _slices(batches):
            for n, h, text, members in zip(*(batch.column(c).to_pylist() for c in FOLDED.names)):
                if n not in tries:
                    if held > SPILL_BYTES:
                        spill(tries)
                        held = 0
                    tries[n] = PatriciaTrie()

                def make(n=n, h=h, text=text):
                    seen = order.setdefault(n, {})
                    seen[h] = seen.get(h, -1) + 1
                    record = [h, seen[h], None, 0, hashlib.sha256(text).hexdigest()]
                    records.setdefault(n, []).append(record)
                    return record

                before = tries[n].bytes
                record = tries[n].at(text, make)
                held += tries[n].bytes - before
                for i in members:
                    if i is not None and (record[2] is None or better(i, record[2])):
                        record[2] = i
                record[3] += len(members)
                rows.append((0, n, h, record[1], members, None, None, None))
                if len(rows) >= 20_000:
                    yield out()
        spill(tries)
        if rows:
            yield out()
        release()

    return run


def owners(spark: SparkSession, docs: DataFrame, largest: bool = True) -> DataFrame:
    """Every row -> (doc_id, keep_id, group_size, kept, text_sha256)."""
    text = F.encode(F.coalesce(F.col("text").cast("string"), F.lit("")), "utf-8")
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    buckets = bucket_count(spark, text_bytes(keyed))
    keyed = keyed.select("doc_id", "text", F.octet_length("text").cast("long").alias("length"), F.xxhash64("text").alias("hash"))
    folded = keyed.mapInArrow(_fold, "length long, hash long, text binary, members array<long>")
    dealt = folded.repartition(buckets, "length", "hash").sortWithinPartitions("length", "hash")
    trie = written(spark, dealt.mapInArrow(_own(largest), TRIE_SQL), "trie")
    key = ["length", "hash", "terminal"]
    terminals = trie.where("kind = 1").select(*key, "owner", "size", "sha")
    rows = trie.where("kind = 0").select(*key, "members").join(terminals, key)
    rows = rows.select(F.explode("members").alias("doc_id"), "owner", "size", "sha")
    kept = F.col("doc_id").eqNullSafe(F.col("owner"))
    return rows.select("doc_id", F.col("owner").alias("keep_id"), F.col("size").alias("group_size"), kept.alias("kept"), F.col("sha").alias("text_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return owners(spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), largest=True)


def without_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that own their text; all columns kept.

    Rows without an id stay only as sole owners of theirs; rows that repeat both id and
    text share their fate; an empty table gives no rows.
    """
    gone, sha = fresh(docs, "gone_id"), fresh(docs, "gone_sha")
    key = lambda c: F.coalesce(c, F.lit(-(2**63)))
    dropped = owners(spark, docs).where("not kept").select(key(F.col("doc_id")).alias(gone), F.col("text_sha256").alias(sha)).distinct()
    tagged = docs.withColumn(gone, key(F.col("doc_id").cast("long"))).withColumn(sha, F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256))
    return tagged.join(dropped, [gone, sha], "left_anti").drop(gone, sha)


OP3_SQL = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
