"""Operator 13: documents packed into sequences by order-preserving dynamic programming.

The documents of a task, in their order, are one run of ids.  It is cut into windows of
at most ``width`` ids; a cut stands after a document, or after a sentence for a penalty.
A window is padded to ``width`` unless its length is a power of two, so the least cost up
to a cut j is

    penalty(j) + min over cuts i with j - i <= width of (cost(i) + padding(j - i))

Padding of ``width - j + i`` makes the first minimum a sliding one over cost(i) + i, kept
in a monotone queue; the windows of a power of two are looked up one by one, 13 a cut.
Where no cut stands within ``width`` ids, one is made every ``width`` ids.  The last
window of a task may also be split into powers of two, each cut at the price of a split.

Memory: ids wait until about ``RUN`` of them are there; their windows up to the cheapest
of the last cuts are handed out and the rest waits for more.  A task holds its longest
document.  One scan, nothing is shuffled; the sequences of a task depend on its rows and
their order alone, so a repeated task gives the same.

Ids equal those of the tokenizers library: texts are encoded by chunks between ASCII white
space, which no token crosses, each distinct chunk once (chunks are told apart by 64-bit
hashes).  A null or empty text is its end
id alone.  Null and repeated ids are packed as rows of their own; other columns don't
matter; an empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textblocks import U64, WHITESPACE, Block, blocks, word_bounds, word_hashes

WIDTH = 4096
#: Costs in ids of padding: of a cut within a document after a sentence, and anywhere else.
TRUNCATION, SPLIT = 16, 48
END = 2
#: Ids that are cut at a time, about, and chunks of text that a worker remembers.
RUN, REMEMBERED = 1 << 20, 1 << 20
#: What a token that ends a sentence holds: a mark, then closing quotes or brackets.
SENTENCE_END = r"[.!?]+[\"')\]]*"


class Encoder:
    """Texts to ids as the library gives them, each distinct chunk encoded once.

    A chunk of printable ASCII is taken apart into words here, as the model's file says, and each
    distinct word is looked up once; any other chunk goes through the whole tokenizer.
    """

    #: How the tokenizer takes a lower-cased text apart, for printable ASCII without white space.
    WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
    PLAIN = re.compile(rb"[!-~]+")

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(model)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.special = re.compile(b"|".join([re.escape(t.encode()) for t in self.tokenizer.get_vocab() if t not in vocabulary] or [b"(?!)"]))
        self.words: dict[str, bytes] = {}
        self.forget()
        suffix = "</w>"
        ends = [i for t, i in vocabulary.items() if re.fullmatch(SENTENCE_END, t.removesuffix(suffix))]
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        self.ends[ends] = True

    def forget(self) -> None:
        self.known, self.number = np.zeros(0, U64), np.zeros(0, np.int64)  # hashes of chunks, ascending, and their numbers
        self.flat, self.stops = array("I"), array("q", [0])

    def _learn(self, chunks: list[bytes]) -> None:
        fits, special = self.PLAIN.fullmatch, self.special.search
        plain = [fits(c) is not None and not special(c) for c in chunks]
        other = iter(self.tokenizer.encode_batch_fast([c.decode("utf-8", "replace") for c, p in zip(chunks, plain) if not p], add_special_tokens=False))
        flat, words, found, tokenize = self.flat, self.words, self.WORD.findall, self.tokenizer.model.tokenize
        if len(words) > REMEMBERED:
            words.clear()
        for chunk, is_plain in zip(chunks, plain):
            if is_plain:
                for w in found(chunk.decode().lower()):
                    ids = words.get(w)
                    if ids is None:
                        ids = words[w] = array("I", [t.id for t in tokenize(w)]).tobytes()
                    flat.frombytes(ids)
            else:
                flat.extend(next(other).ids)
            self.stops.append(len(flat))

    def encode(self, b: Block) -> list[np.ndarray]:
        """The ids of each text of a block."""
        if len(self.known) > REMEMBERED:
            self.forget()
        starts, ends, doc = word_bounds(b.data, b.offsets, WHITESPACE)
        hashes, first, chunk = np.unique(word_hashes(b.data, starts, ends), return_index=True, return_inverse=True)
        spot = np.searchsorted(self.known, hashes)
        new = np.ones(len(hashes), bool)
        inside = spot < len(self.known)
        new[inside] = self.known[spot[inside]] != hashes[inside]
        if new.any():
            raw, at = b.data.tobytes(), first[new]
            self._learn([raw[a:z] for a, z in zip(starts[at].tolist(), ends[at].tolist())])
            self.number = np.insert(self.number, spot[new], len(self.known) + np.arange(len(at)))
            self.known = np.insert(self.known, spot[new], hashes[new])
            spot += np.cumsum(new) - new
        at = self.number[spot][chunk]
        stops = np.frombuffer(self.stops, np.int64)
        size = stops[at + 1] - stops[at]
        running = np.concatenate([[0], np.cumsum(size)])
        ids = np.zeros(0, np.uint32)
        if running[-1]:
            ids = np.frombuffer(self.flat, np.uint32)[np.arange(running[-1]) + np.repeat(stops[at] - running[:-1], size)]
        cuts = running[np.searchsorted(doc, np.arange(b.n + 1))].tolist()
        return [ids[a:z] for a, z in zip(cuts, cuts[1:])]


_encoders: dict[int, Encoder] = {}


def encoder(model: str) -> Encoder:
    """The worker's encoder of a model file's content."""
    key = hash(model)
    if key not in _encoders:
        _encoders[key] = Encoder(model)
    return _encoders[key]


def cuts_of(ids: np.ndarray, bounds: np.ndarray, ends: np.ndarray, width: int, truncation: int, split: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a run may be cut, ascending from 0 to its end, and the penalty of each.

    ``bounds``: ends of the documents in the run.
    """
    inside = np.flatnonzero(ends[ids]) + 1
    inside = inside[~np.isin(inside, bounds) & ~np.isin(inside + 1, bounds)]  # the end id goes with its text
    at = np.concatenate([[0], inside, bounds, [len(ids)]])
    penalty = np.concatenate([[0], np.full(len(inside), truncation), np.zeros(len(bounds), np.int64), [0]])
    at, first = np.unique(at, return_index=True)
    penalty = penalty[first]
    gaps = np.flatnonzero(np.diff(at) > width)
    forced = [np.arange(at[g] + width, at[g + 1], width) for g in gaps.tolist()]
    if forced:
        forced = np.concatenate(forced)
        order = np.argsort(np.concatenate([at, forced]), kind="stable")
        at, penalty = np.concatenate([at, forced])[order], np.concatenate([penalty, np.full(len(forced), split)])[order]
    return at, penalty


def padding(length: int, width: int) -> int:
    return 0 if length & (length - 1) == 0 else width - length


def least_costs(at: np.ndarray, penalty: np.ndarray, width: int) -> tuple[list[int], list[int]]:
    """Least cost of windows up to each cut, and the cut before its last window."""
    n = len(at)
    place = np.full(int(at[-1]) + 1, -1, np.int64)
    place[at] = np.arange(n)
    to, back = [], []
    for p in [1 << b for b in range(width.bit_length()) if 1 << b <= width]:
        j = np.flatnonzero(at >= p)
        i = place[at[j] - p]
        to.append(j[i >= 0])
        back.append(i[i >= 0])
    to, back = np.concatenate(to), np.concatenate(back)
    order = np.argsort(to, kind="stable")
    back, first = back[order].tolist(), np.searchsorted(to[order], np.arange(n + 1)).tolist()
    spot, price = at.tolist(), penalty.tolist()
    cost, came = [0] * n, [0] * n
    queue: deque[tuple[int, int]] = deque([(0, 0)])  # (cost + place, cut), both ascending
    for j in range(1, n):
        here = spot[j]
        while spot[queue[0][1]] < here - width:
            queue.popleft()
        least, best = queue[0]
        least += width - here
        for i in back[first[j] : first[j + 1]]:
            if cost[i] < least:
                least, best = cost[i], i
        cost[j], came[j] = least + price[j], best
        key = cost[j] + here
        while queue and queue[-1][0] >= key:
            queue.pop()
        queue.append((key, j))
    return cost, came


def windows(at: np.ndarray, penalty: np.ndarray, width: int, last: bool, split: int) -> np.ndarray:
    """Starts of the windows of least cost, and the end of the last one: the run's end if it is the ``last``."""
    cost, came = least_costs(at, penalty, width)
    spot, n = at.tolist(), len(at) - 1
    end, tail = n, []
    near = int(np.searchsorted(at, at[-1] - width))
    if last:
        def price(i: int) -> int:
            return min(padding(spot[n] - spot[i], width), split * ((spot[n] - spot[i]).bit_count() - 1))

        came[n] = min(range(near, n), key=lambda i: cost[i] + price(i))
        size, start = spot[n] - spot[came[n]], spot[came[n]]
        if split * (size.bit_count() - 1) < padding(size, width):
            tail = [start + sum(1 << b for b in range(k, size.bit_length()) if size >> b & 1) for k in range(size.bit_length() - 1, -1, -1) if size >> k & 1][:-1]
    else:
        end = min(range(max(near, 1), n + 1), key=lambda i: (cost[i], -i))
    path = [end]
    while path[-1]:
        path.append(came[path[-1]])
    return np.array(sorted({*(spot[i] for i in path), *tail}), np.int64)


class Run:
    """Ids that wait, by document, and the sequences handed out so far."""

    def __init__(self, ends: np.ndarray, first: int, width: int, truncation: int, split: int, with_ids: bool):
        self.ends, self.next, self.width, self.truncation, self.split, self.with_ids = ends, first, width, truncation, split, with_ids
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple[int | None, int, int]] = []  # id, ids before the part, ids of the whole document
        self.size = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.parts.append(ids)
        self.docs.append((doc_id, 0, len(ids)))
        self.size += len(ids)

    def hand_out(self, last: bool) -> pa.RecordBatch:
        ids = np.concatenate(self.parts)
        bounds = np.cumsum([len(p) for p in self.parts])
        at, penalty = cuts_of(ids, bounds, self.ends, self.width, self.truncation, self.split)
        edges = windows(at, penalty, self.width, last, self.split)
        end = int(edges[-1])
        starts = np.unique(np.concatenate([edges[:-1], bounds[:-1][bounds[:-1] < end]]))
        stops = np.append(starts[1:], end)
        doc = np.searchsorted(bounds, starts, "right")
        window = np.searchsorted(edges, starts, "right") - 1
        begins = np.concatenate([[0], bounds[:-1]])
        before = np.array([d[1] for d in self.docs], np.int64)
        raw = ids[:end].astype("<u4").tobytes()
        columns = {
            "doc_id": pa.array([self.docs[i][0] for i in doc.tolist()], pa.int64()),
            "start": starts - begins[doc] + before[doc],
            "length": stops - starts,
            "ids_crc32": np.array([zlib.crc32(raw[4 * a : 4 * z]) for a, z in zip(starts.tolist(), stops.tolist())], np.int64),
            "doc_tokens": np.array([d[2] for d in self.docs], np.int64)[doc],
            "sequence_id": self.next + window,
            "offset": starts - edges[window],
        }
        if self.with_ids:
            columns["ids"] = pa.ListArray.from_arrays(pa.array(np.append(starts, end).astype(np.int32)), pa.array(ids[:end].astype(np.int32)))
        self.next += len(edges) - 1
        k = int(np.searchsorted(bounds, end, "right"))
        cut = end - int(begins[k]) if k < len(bounds) else 0
        self.parts, self.docs = self.parts[k:], self.docs[k:]
        if cut:
            self.parts[0] = self.parts[0][cut:].copy()
            self.docs[0] = (self.docs[0][0], self.docs[0][1] + cut, self.docs[0][2])
        self.size = len(ids) - end
        return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, pa.int64()) for c in columns.values()], names=list(columns))


def _pack(model: str, width: int, truncation: int, split: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to_ids = encoder(model)
        end = np.array([END], np.uint32)
        wait = Run(to_ids.ends, TaskContext.get().partitionId() << 40, width, truncation, split, with_ids)
        for b in blocks(batches):
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), to_ids.encode(b)):
                wait.add(doc_id, np.concatenate([ids, end]))
                if wait.size >= RUN:
                    yield wait.hand_out(last=False)
        if wait.size:
            yield wait.hand_out(last=True)

    return run


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def pack(docs: DataFrame, model: str | None = None, width: int = WIDTH, truncation: int = TRUNCATION, split: int = SPLIT, with_ids: bool = False) -> DataFrame:
    """One row per piece of a document: where it stands in the document and in which sequence; with ``with_ids`` also its ids.

    The model file is read once by the driver and sent with the tasks: its size is the vocabulary's.
    """
    with open(model or default_model(), encoding="utf-8") as f:
        content = f.read()
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long" + (", ids array<int>" if with_ids else "")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_pack(content, width, truncation, split, with_ids), schema)


def sequences(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """sequence_id, its ids, pieces, cut documents and padding."""
    whole = (F.col("start") == 0) & (F.col("length") == F.col("doc_tokens"))
    found = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"), F.count("*").alias("pieces"), F.count(F.when(~whole, 1)).alias("cut_pieces"))
    return found.withColumn("padding", F.when(F.bit_count("tokens") == 1, 0).otherwise(width - F.col("tokens")))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
