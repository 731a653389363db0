"""Vectorised word blocks: Arrow text batches as flat numpy arrays of word hashes.

A *block* is a run of whole documents of about ``max_bytes`` of UTF-8.  Words are
found on bytes, which is exact for UTF-8 because every delimiter is ASCII.
Hashes are 64 bits; equality of hashes is taken for equality of words.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: Fixed odd multipliers of the positions of a shingle.
POSITION = np.array([(0xD1342543DE82EF95 * (2 * k + 1) ^ 0x5851F42D4C957F2D) & (2**64 - 1) | 1 for k in range(64)], U64)

#: Bytes of text that are hashed at a time: bounds the tables of powers that a Python worker keeps.
PIECE = 1 << 20

_tables: dict[str, np.ndarray] = {}

WHITESPACE = np.zeros(256, bool)
WHITESPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Bytes outside ASCII letters and digits end a licence word.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[48:58] = NOT_ALNUM[97:123] = NOT_ALNUM[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 output bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_tables.get("p", ())) < n:
        size = max(n, PIECE + 64)
        for key, base in (("p", _BASE), ("i", _BASE_INV)):
            t = np.full(size, base, U64)
            t[0] = 1
            _tables[key] = np.cumprod(t)
    return _tables["p"], _tables["i"]


def release() -> None:
    """Give free memory back at the end of a task: workers are kept for the next ones."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another libc
        ctypes.CDLL("libc.so.6").malloc_trim(0)


@dataclass
class Block:
    """Whole documents: their rows in the batch, bytes and byte offsets."""

    batch: pa.RecordBatch
    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def n(self) -> int:
        return len(self.offsets) - 1

    def column(self, name: str) -> pa.Array:
        return self.batch.column(name).slice(self.first, self.n)

    def longs(self, name: str) -> np.ndarray:
        return pc.fill_null(self.column(name), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = 1 << 20) -> Iterator[Block]:
    """Cut batches into blocks; null texts become empty ones."""
    for batch in batches:
        col = pc.fill_null(batch.column(text), "").cast(pa.large_string())
        off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        raw = col.buffers()[2]
        data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
        i, n = 0, len(col)
        while i < n:
            j = max(i + 1, int(np.searchsorted(off, off[i] + max_bytes, "right")) - 1)
            yield Block(batch, i, data[off[i] : off[j]], off[i : j + 1] - off[i])
            i = j
    release()


@dataclass
class Lines:
    """The lines of a block, as units of their own: byte offsets, and document and line number of each."""

    data: np.ndarray
    offsets: np.ndarray
    doc: np.ndarray
    line_no: np.ndarray

    @property
    def n(self) -> int:
        return len(self.doc)

    def only(self, chosen: np.ndarray) -> Lines:
        """The chosen lines and their bytes alone."""
        size = np.diff(self.offsets)
        offsets = np.concatenate([[0], np.cumsum(size[chosen])])
        return Lines(self.data[np.repeat(chosen, size)], offsets, self.doc[chosen], self.line_no[chosen])


def lines_of(b: Block) -> Lines:
    """Lines end at ``\\n``, which stays at their end; a text of k line ends has k + 1 lines."""
    ends = np.flatnonzero(b.data == 10) + 1
    doc = np.concatenate([np.arange(b.n), np.searchsorted(b.offsets, ends - 1, "right") - 1])
    start = np.concatenate([b.offsets[:-1], ends])
    order = np.lexsort((np.arange(len(doc)), start, doc))  # an empty line comes after what ends where it starts
    doc, start = doc[order], start[order]
    first = np.searchsorted(doc, np.arange(b.n))
    return Lines(b.data, np.append(start, len(b.data)), doc, np.arange(len(doc)) - first[doc])


def word_bounds(data: np.ndarray, offsets: np.ndarray, delimiter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of all words of a block."""
    word = ~delimiter[data]
    before = np.zeros(len(data), bool)
    before[1:] = word[:-1]
    edges = offsets[(offsets < len(data))]
    before[edges] = False
    after = np.zeros(len(data), bool)
    after[:-1] = word[1:]
    after[edges[edges > 0] - 1] = False
    starts = np.flatnonzero(word & ~before)
    ends = np.flatnonzero(word & ~after) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the words between ascending starts and ends, wherever they stand."""
    if len(data) > PIECE and len(starts) > 1:
        out, i = [], 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + PIECE, "right")))
            out.append(word_hashes(data[starts[i] : ends[j - 1]], starts[i:j] - starts[i], ends[i:j] - starts[i]))
            i = j
        return np.concatenate(out)
    p, inv = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, U64)
    np.cumsum((data.astype(U64) + U64(1)) * p[: len(data)], out=total[1:])
    h = (total[ends] - total[starts]) * inv[starts]
    return mix(h ^ ((ends - starts).astype(U64) * U64(0xA24BAED4963EE407)))


def hash_word(word: str | bytes) -> int:
    """The hash that ``word_hashes`` gives one word."""
    b = np.frombuffer(word.encode() if isinstance(word, str) else word, np.uint8)
    return int(word_hashes(b, np.array([0]), np.array([len(b)]))[0])


def run_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` consecutive words, whatever the document."""
    n = len(words) - width + 1
    if n <= 0:
        return np.zeros(0, U64)
    if width > 8:  # a sum with a power of the base for each position, from running totals
        p, inv = _powers(len(words) + 1)
        total = np.zeros(len(words) + 1, U64)
        np.cumsum(words * p[: len(words)], out=total[1:])
        return mix((total[width:] - total[:-width]) * inv[:n] + U64(width))
    h = np.zeros(n, U64)
    for k in range(width):
        h += words[k : k + n] * POSITION[k]
    return mix(h + U64(width))


def shingle_sets(block: Block | Lines, width: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each document of a block (A-Z lower-cased).

    Returns hashes sorted within each document, their document numbers, and the
    set size of each document.  A document of fewer than ``width`` words has its
    whole sequence as one shingle; one without words has none.
    """
    data = LOWER[block.data]
    starts, ends, doc = word_bounds(data, block.offsets, WHITESPACE)
    words = word_hashes(data, starts, ends)
    n_words = np.bincount(doc, minlength=block.n)
    h = run_hashes(words, width)
    at = np.flatnonzero(doc[: len(h)] == doc[width - 1 :][: len(h)]) if len(h) else np.zeros(0, np.int64)
    hs, ds = [h[at]], [doc[at]]
    first = np.cumsum(n_words) - n_words
    for k in range(1, width):
        short = np.flatnonzero(n_words == k)
        if len(short):
            v = np.zeros(len(short), U64)
            for j in range(k):
                v += words[first[short] + j] * POSITION[j]
            hs.append(mix(v + U64(k)))
            ds.append(short)
    hashes, docs = np.concatenate(hs), np.concatenate(ds)
    if len(ds) > 1:  # the short documents back to their places
        order = np.argsort(docs, kind="stable")
        hashes, docs = hashes[order], docs[order]
    cuts = split_points(docs)
    for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
        hashes[a:z].sort()
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (docs[1:] != docs[:-1])
    hashes, docs = hashes[keep], docs[keep]
    return hashes, docs, np.bincount(docs, minlength=block.n)


def sort_order(keys: np.ndarray) -> np.ndarray:
    """Order of 32- or 64-bit keys by their upper bits: equal keys meet but for rare ties of those bits.

    Sorting keys that carry their places is twice as fast as sorting places.
    """
    bits = max(1, int(len(keys) - 1).bit_length())
    mask = U64((1 << bits) - 1)
    wide = keys.astype(U64) << U64(32) if keys.dtype.itemsize == 4 else keys
    return (np.sort((wide & ~mask) | np.arange(len(keys), dtype=U64)) & mask).astype(np.int64)


def split_points(sorted_keys: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal keys, and the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1, [len(sorted_keys)]])
