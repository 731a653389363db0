"""Operator 9: benchmark decontamination with a BM25 index of the test items.

Word counts, document frequencies and the mean length are taken over all items in
Spark, so an item's BM25 impacts don't depend on how the items are dealt.  The
index is sparse: item blocks of postings with the largest impact of each term in
each block.  Every training passage, a window of two cells, is a query: block
upper bounds (summed per cell) skip the item blocks that can't reach any threshold
of theirs, the rest is scored exactly, and every item at ``RETRIEVE`` of its own
score or more is retrieved.  A cell has the item's word count rounded up to a
power of two, 32 at least.  A retrieved pair counts if the passage holds enough of
the word trigrams of both parts of the item: its question (all but the end) and
its answer (the last line if there are several, else the last quarter).

Items come in shards by that power of two, of about ``SHARD_ITEMS`` items and
``SHARD_WORDS`` words at most; ``SCAN_SHARDS`` shards meet all documents in one
scan.  Words are lower-case letters and digits, so case and punctuation don't
matter.  An item is a distinct pair of item_id and text; an id with several texts
is an item each.  Null and empty texts or items and items without an id match
nothing; an item of fewer than three words is one run of its own; repeated
documents are reported each; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import discard, written
from .textblocks import LOWER, NOT_ALNUM, U64, Block, blocks, run_hashes, split_points, word_bounds, word_hashes

K1, B = 1.2, 0.75
RETRIEVE = 0.6
QUESTION, ANSWER = 0.6, 0.5
ITEM_BLOCK = 4  # few, so that the largest impacts of a block bound the score of an item sharply
LEAST_CLASS = 5  # cells of 32 words
SHARD_ITEMS, SHARD_WORDS, SCAN_SHARDS = 512, 1 << 19, 8

ITEM = "item_id long, n_words long, class int, words array<long>, question array<long>, answer array<long>"


class ItemIndex:
    """Sparse inverted index of one shard of items, with block maxima.

    ``items`` has item_id, class, terms and impacts, question and answer of each.
    """

    def __init__(self, items: list[dict]):
        self.ids = np.array([x["item_id"] for x in items], np.int64)
        self.stride = 1 << items[0]["class"]
        sizes = [len(x["terms"]) for x in items]
        terms = np.concatenate([np.array(x["terms"], np.int64).view(U64) for x in items])
        impact = np.concatenate([np.array(x["impacts"], np.float64) for x in items])
        item = np.repeat(np.arange(len(items)), sizes)
        self.vocab, term = np.unique(terms, return_inverse=True)
        self.blocks = -(-len(items) // ITEM_BLOCK)
        self.block_max = np.zeros((len(self.vocab), self.blocks), np.float32)
        np.maximum.at(self.block_max, (term, item // ITEM_BLOCK), impact)
        cuts = np.searchsorted(item // ITEM_BLOCK, np.arange(self.blocks + 1))
        #: postings of each block: term, item within the block, impact
        self.postings = [(term[i:j], item[i:j] % ITEM_BLOCK, impact[i:j]) for i, j in zip(cuts[:-1], cuts[1:])]
        self.threshold = np.full(self.blocks * ITEM_BLOCK, np.inf)
        self.threshold[: len(items)] = RETRIEVE * np.bincount(item, impact, len(items))
        self.threshold = self.threshold.reshape(self.blocks, ITEM_BLOCK)
        self.least = self.threshold.min(1)
        self.parts = [tuple(np.array(x[part], np.int64).view(U64) for part in ("question", "answer")) for x in items]


def _hashes(text: str) -> np.ndarray:
    data = LOWER[np.frombuffer(text.encode(), np.uint8)]
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), NOT_ALNUM)
    return word_hashes(data, starts, ends)


def _parts(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All words of an item, and the trigrams of question and answer."""
    words = _hashes(text)
    lines = [x for x in text.split("\n") if x.strip()]
    tail = len(_hashes(lines[-1])) if len(lines) > 1 else 0
    if not 3 <= tail < len(words) - 2:
        tail = max(3, len(words) // 4)
    cut = max(len(words) - tail, min(3, len(words)))
    return words, grams(words[:cut]), grams(words[cut:] if len(words) - cut >= 3 else words[-3:])


def grams(words: np.ndarray) -> np.ndarray:
    return np.unique(run_hashes(words, min(3, max(1, len(words)))))


@dataclass
class Words:
    """Word hashes of a block of documents, where each document's begin, and how many it has."""

    words: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    count: np.ndarray

    @classmethod
    def of(cls, b: Block) -> Words:
        data = LOWER[b.data]
        starts, ends, doc = word_bounds(data, b.offsets, NOT_ALNUM)
        count = np.bincount(doc, minlength=b.n)
        return cls(word_hashes(data, starts, ends), doc, np.cumsum(count) - count, count)


def search(index: ItemIndex, w: Words) -> list[tuple[int, int, float, float, float]]:
    """(document number, item id, score share, question share, answer share) of a block, best window of each pair."""
    if not len(w.words):
        return []
    at = np.searchsorted(index.vocab, w.words)
    at[at == len(index.vocab)] = 0
    hit = np.flatnonzero(index.vocab[at] == w.words)
    if not len(hit):
        return []
    cells = -(-w.count // index.stride)
    base = np.cumsum(cells) - cells
    cell = base[w.doc[hit]] + (hit - w.first[w.doc[hit]]) // index.stride
    key = np.unique(cell * len(index.vocab) + at[hit])
    cell, term = key // len(index.vocab), key % len(index.vocab)
    cuts = split_points(cell)
    bound = np.zeros((cells.sum() + 1, index.blocks), np.float32)
    bound[cell[cuts[:-1]]] = np.add.reduceat(index.block_max[term], cuts[:-1], axis=0)
    doc_of = np.repeat(np.arange(len(cells)), cells)
    follows = np.append(doc_of[1:] == doc_of[:-1], False)
    both = bound[:-1] + bound[1:] * follows[:, None]
    window, block = np.nonzero(both >= index.least[None] - 1e-3)
    edges = np.searchsorted(cell, np.arange(cells.sum() + 1))
    present = np.zeros(len(index.vocab), bool)
    found: dict[tuple[int, int], tuple] = {}
    for v, k in zip(window.tolist(), block.tolist()):
        own = term[edges[v] : edges[v + 1 + follows[v]]]
        present[own] = True
        terms, items, impact = index.postings[k]
        held = present[terms]
        present[own] = False
        score = np.bincount(items[held], impact[held], ITEM_BLOCK)
        for j in np.flatnonzero(score >= index.threshold[k] - 1e-9):
            item = k * ITEM_BLOCK + j
            d = doc_of[v]
            low = w.first[d] + (v - base[d]) * index.stride
            # trigrams may begin in the window's last words: read two words on
            span = w.words[low : min(low + 2 * index.stride + 2, w.first[d] + w.count[d])]
            question, answer = (self_share(part, span) for part in index.parts[item])
            if question >= QUESTION and answer >= ANSWER:
                row = (float(score[j] / index.threshold[k, j] * RETRIEVE), question, answer)
                pair = (int(d), int(item))
                if pair not in found or row > found[pair]:
                    found[pair] = row
    return [(d, int(index.ids[item]), *row) for (d, item), row in sorted(found.items())]


def self_share(part: np.ndarray, span: np.ndarray) -> float:
    """Share of an item part's grams that a span of words holds."""
    if not len(part):
        return 0.0
    held = np.concatenate([run_hashes(span, k) for k in (1, 2, 3)]) if len(part) == 1 else run_hashes(span, 3)
    return float(np.isin(part, held).mean())


def _prepare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words and parts of items, those without words left out."""
    for batch in batches:
        rows = []
        for i, text in zip(batch.column("item_id").to_pylist(), batch.column("text").to_pylist()):
            words, question, answer = _parts(text)
            if n := len(words):
                rows.append((i, n, max(LEAST_CLASS, (n - 1).bit_length()), *(x.view(np.int64) for x in (words, question, answer))))
        columns = list(zip(*rows)) or [[]] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), *[pa.list_(pa.int64())] * 3]
        yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names=["item_id", "n_words", "class", "words", "question", "answer"])


def impacts(benchmark: DataFrame) -> DataFrame:
    """Items (item_id, n_words, class, question, answer, terms, impacts) with BM25 impacts from the counts of all items."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null and text is not null")
    items = items.distinct().mapInArrow(_prepare, ITEM).withColumn("ik", F.xxhash64("item_id", "words", "answer"))
    counts = items.select("ik", "n_words", F.explode("words").alias("term")).groupBy("ik", "n_words", "term").agg(F.count("*").alias("tf"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    total = items.agg(F.count("*").alias("n"), F.avg("n_words").alias("mean"))  # one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    impact = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("n_words") / F.col("mean")))
    pairs = counts.join(df, "term").crossJoin(F.broadcast(total)).select("ik", F.struct("term", impact.alias("impact")).alias("p"))
    own = pairs.groupBy("ik").agg(F.array_sort(F.collect_list("p")).alias("p"))  # as many as an item has words
    return items.join(own, "ik").select("item_id", "n_words", "class", "question", "answer", F.col("p.term").alias("terms"), F.col("p.impact").alias("impacts"))


def shards(benchmark: DataFrame) -> list[ItemIndex]:
    """Indexes of all items; each is collected alone and its size is bounded, however many items there are."""
    spark = benchmark.sparkSession
    items = written(spark, impacts(benchmark), "items")
    found = []
    for r in items.groupBy("class").agg(F.count("*").alias("n"), F.sum("n_words").alias("words")).orderBy("class").collect():  # a row for each power of two
        count = max(1, -(-2 * r.n // SHARD_ITEMS) if r.n > SHARD_ITEMS else 1, -(-2 * r.words // SHARD_WORDS) if r.words > SHARD_WORDS else 1)
        own = items.where(F.col("class") == r["class"])
        for k in range(count):
            rows = own.where(F.pmod(F.xxhash64("item_id"), F.lit(count)) == k).orderBy("item_id", "terms", "answer").toArrow().to_pylist()
            if rows:
                found.append(ItemIndex(rows))
    discard(spark, items)
    return found


def scans(benchmark: DataFrame) -> list[list[ItemIndex]]:
    """The indexes, by the scan that they take part in; one scan at least."""
    found = shards(benchmark)
    return [found[i : i + SCAN_SHARDS] for i in range(0, max(1, len(found)), SCAN_SHARDS)]


def _hits(indexes: list[ItemIndex]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            words = Words.of(b)
            if rows := [row for index in indexes for row in search(index, words)]:
                d, i, s, q, a = zip(*rows)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").take(pa.array(d)), pa.array(i, pa.int64()), pa.array(s), pa.array(q), pa.array(a)], names=["doc_id", "item_id", "bm25_share", "question_overlap", "answer_overlap"])

    return run


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Pairs (doc_id, item_id, bm25_share, question_overlap, answer_overlap) of documents that hold an item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sql = "doc_id long, item_id long, bm25_share double, question_overlap double, answer_overlap double"
    return reduce(DataFrame.union, [rows.mapInArrow(_hits(indexes), sql) for indexes in scans(benchmark)])


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns kept."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def clean(indexes: list[ItemIndex]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in blocks(batches):
                words = Words.of(b)
                good = np.ones(b.n, bool)
                for index in indexes:
                    good[[r[0] for r in search(index, words)]] = False
                yield b.batch.slice(b.first, b.n).filter(pa.array(good))

        return run

    return reduce(lambda df, indexes: df.mapInArrow(clean(indexes), fields), scans(benchmark), docs)


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
