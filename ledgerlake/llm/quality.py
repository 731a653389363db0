"""Operator 5: text quality by a generalised additive model with pairwise interactions.

Features are cheap shape measures of the whole text.  Each is cut into bins; a
shallow tree a turn, cyclically over the features, adds small steps to one lookup
table per feature; the strongest pairs then get two-way tables the same way.
Scoring adds looked-up values.  Labels are read only outside the held-out fold,
from a sample of about ``TRAIN_ROWS`` rows; language, source, id and labels are
no inputs.

Null and empty texts score by their zero features; with no labels or labels of
one kind all scores are the share of good labels (1/2 without any); repeated rows
score alike; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textblocks import WHITESPACE, Block, blocks, run_hashes, word_bounds, word_hashes
from .training import remainder, sample

THRESHOLD = 0.3
FOLDS, HELD_OUT = 5, 0
BINS, PAIR_BINS, PAIRS = 32, 8, 6
ROUNDS, PAIR_ROUNDS, RATE = 150, 60, 0.1

_byte = np.arange(256)
#: Classes of bytes whose shares are features.
CLASSES = {
    "upper": (_byte >= 65) & (_byte <= 90),
    "digit": (_byte >= 48) & (_byte <= 57),
    "symbol": np.isin(_byte, [ord(c) for c in "#$%&*@^_~<>{}[]\\/=+"]),
    "bar": _byte == ord("|"),
    "bang": _byte == ord("!"),
    "stop": np.isin(_byte, [ord(c) for c in ".,;:?"]),
    "newline": _byte == 10,
    "wide": _byte >= 128,
}
FEATURES = ["words", "word_length", *CLASSES, "distinct", "adjacent", "top", "phrases", "triple", "symbol_words", "longest"]


def features(b: Block) -> np.ndarray:
    """One row of FEATURES for each document of a block."""
    starts, ends, doc = word_bounds(b.data, b.offsets, WHITESPACE)
    words = word_hashes(b.data, starts, ends)
    size = np.diff(b.offsets)
    n = np.bincount(doc, minlength=b.n)
    some = np.maximum(n, 1)
    count = lambda mask: np.add.reduceat(np.append(mask, False).astype(np.int32), b.offsets[:-1]) * (size > 0)
    per_word = lambda mask: np.bincount(doc[mask], minlength=b.n) / some
    columns = [np.log1p(n), np.bincount(doc, ends - starts, b.n) / some]
    columns += [count(table[b.data]) / np.maximum(size, 1) for table in CLASSES.values()]
    # words by document and hash: how many differ, and the share of the commonest
    order = np.lexsort((words, doc))
    w, d = words[order], doc[order]
    new = np.ones(len(w), bool)
    new[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
    columns.append(np.bincount(d[new], minlength=b.n) / some)
    same = (words[1:] == words[:-1]) & (doc[1:] == doc[:-1]) if len(words) else np.zeros(0, bool)
    columns.append(np.bincount(doc[1:][same], minlength=b.n) / some if len(words) else np.zeros(b.n))
    top = np.zeros(b.n)
    at = np.flatnonzero(new)
    if len(at):
        np.maximum.at(top, d[at], np.diff(np.append(at, len(w))))
    columns.append(top / some)
    # distinct runs of three words
    runs = run_hashes(words, 3)
    inside = np.flatnonzero(doc[: len(runs)] == doc[2:][: len(runs)]) if len(runs) else np.zeros(0, np.int64)
    pair = np.unique(np.stack([doc[inside].astype(np.uint64), runs[inside]], 1), axis=0)[:, 0].astype(np.int64) if len(inside) else inside
    columns.append(np.where(n >= 3, np.bincount(pair, minlength=b.n) / np.maximum(n - 2, 1), 1.0))
    sym = (CLASSES["symbol"] | CLASSES["bang"])[b.data]
    triple = np.zeros(len(b.data), bool)
    if len(sym) > 2:
        triple[2:] = sym[2:] & (b.data[2:] == b.data[1:-1]) & (b.data[2:] == b.data[:-2])
    columns.append(count(triple) / some)
    columns.append(per_word(sym[ends - 1]) if len(ends) else np.zeros(b.n))
    longest = np.zeros(b.n)
    if len(doc):
        np.maximum.at(longest, doc, (ends - starts).astype(float))
    columns.append(np.log1p(longest))
    return np.stack(columns, 1)


def _steps(gradient: np.ndarray, hessian: np.ndarray, leaves: int = 3) -> np.ndarray:
    """A shallow tree over ordered bins: greedy cuts by gain, then a Newton step for each leaf."""
    cuts = [0, len(gradient)]
    value = lambda g, h: g * g / (h + 1.0)
    for _ in range(leaves - 1):
        best = (1e-6, None)
        for a, z in zip(cuts[:-1], cuts[1:]):
            if z - a < 2:
                continue
            g, h = np.cumsum(gradient[a:z]), np.cumsum(hessian[a:z])
            gain = value(g[:-1], h[:-1]) + value(g[-1] - g[:-1], h[-1] - h[:-1]) - value(g[-1], h[-1])
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], a + k + 1)
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(gradient))
    for a, z in zip(cuts[:-1], cuts[1:]):
        out[a:z] = gradient[a:z].sum() / (hessian[a:z].sum() + 1.0)
    return out


def _quadrants(gradient: np.ndarray, hessian: np.ndarray) -> np.ndarray:
    """The same over two ordered sets of bins: one cut of each, four leaves."""
    g, h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (gradient, hessian))
    i, j = np.meshgrid(np.arange(1, gradient.shape[0]), np.arange(1, gradient.shape[1]), indexing="ij")
    total = np.zeros(i.shape)
    for a, z, c, e in ((0, i, 0, j), (0, i, j, -1), (i, -1, 0, j), (i, -1, j, -1)):
        gg, hh = (x[z, e] - x[a, e] - x[z, c] + x[a, c] for x in (g, h))
        total += gg * gg / (hh + 1.0)
    r, c = np.unravel_index(total.argmax(), total.shape)
    out = np.zeros(gradient.shape)
    for rows in (slice(0, r + 1), slice(r + 1, None)):
        for cols in (slice(0, c + 1), slice(c + 1, None)):
            out[rows, cols] = gradient[rows, cols].sum() / (hessian[rows, cols].sum() + 1.0)
    return out


@dataclass
class QualityModel:
    intercept: float
    edges: list = field(default_factory=list)
    tables: list = field(default_factory=list)
    pairs: list = field(default_factory=list)  # (feature, feature, table)

    def bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x[:, k], "right") for k, e in enumerate(self.edges)], 1) if self.edges else np.zeros((len(x), 0), int)

    def score(self, x: np.ndarray) -> np.ndarray:
        b = self.bins(x)
        z = np.full(len(x), self.intercept)
        for k, t in enumerate(self.tables):
            z += t[b[:, k]]
        for i, j, t in self.pairs:
            z += t[b[:, i] * PAIR_BINS // BINS, b[:, j] * PAIR_BINS // BINS]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_model(x: np.ndarray, y: np.ndarray) -> QualityModel:
    share = y.mean() if len(y) else 0.5
    if not len(y) or share in (0, 1):
        return QualityModel(float(np.log((share + 1e-6) / (1 - share + 1e-6))))
    model = QualityModel(float(np.log(share / (1 - share))))
    for k in range(x.shape[1]):
        model.edges.append(np.unique(np.quantile(x[:, k], np.arange(1, BINS) / BINS)))
    b = model.bins(x)
    model.tables = [np.zeros(BINS) for _ in model.edges]
    z = np.full(len(y), model.intercept)

    def slopes():
        p = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
        return y - p, p * (1 - p)

    for _ in range(ROUNDS):
        for k, table in enumerate(model.tables):
            g, h = slopes()
            step = RATE * _steps(np.bincount(b[:, k], g, BINS), np.bincount(b[:, k], h, BINS))
            table += step
            z += step[b[:, k]]
    small = b * PAIR_BINS // BINS
    g, h = slopes()

    def grid(i, j, v):
        return np.bincount(small[:, i] * PAIR_BINS + small[:, j], v, PAIR_BINS * PAIR_BINS).reshape(PAIR_BINS, PAIR_BINS)

    gains = sorted((-(grid(i, j, g) ** 2 / (grid(i, j, h) + 1)).sum(), i, j) for i in range(x.shape[1]) for j in range(i))
    model.pairs = [(i, j, np.zeros((PAIR_BINS, PAIR_BINS))) for _, i, j in gains[:PAIRS]]
    for _ in range(PAIR_ROUNDS):
        for i, j, table in model.pairs:
            g, h = slopes()
            step = RATE * _quadrants(grid(i, j, g), grid(i, j, h))
            table += step
            z += step[small[:, i], small[:, j]]
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in blocks(batches):
        yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(list(features(b)), pa.list_(pa.float64()))], names=["y", "x"])


def fit(docs: DataFrame, labels: DataFrame) -> QualityModel:
    got = sample(docs, labels, "quality", FOLDS, HELD_OUT).mapInArrow(_features, "y int, x array<double>").toPandas()
    x = np.stack([np.array(r) for r in got["x"]]) if len(got) else np.zeros((0, len(FEATURES)))
    order = np.lexsort((*x.T, got["y"].to_numpy(float))) if len(x) else slice(None)
    return fit_model(x[order], got["y"].to_numpy(float)[order])


def _score(model: QualityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(features(b)))], names=["doc_id", "score"])

    return run


def score(docs: DataFrame, model: QualityModel) -> DataFrame:
    """Every row -> (doc_id, held_out, score, predicted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(model), "doc_id long, score double")
    return rows.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
