"""Operator 2: toxicity by weak supervision.

*Voters.*  A fixed insult lexicon; lexicons of words and of word beginnings that
the training labels associate with toxicity; patterns (density of hits, hits
close together, hardly any hit).  Each votes toxic, clean or abstains.

*Label model.*  A generative model of the votes with a hidden true label: given
it, every voter depends on one other voter too (a tree of the strongest
conditional correlations), fitted by expectation maximisation on counts of vote
patterns.  It estimates accuracies and correlations without the labels.

*Classifier.*  Logistic regression on hit counts, trained on the label model's
posteriors.  Scores come from it alone; language, source, id and labels are no
inputs.

Labels are read only outside the held-out fold.  The lexicons, the label model
and the classifier are fitted on a sample of about ``TRAIN_ROWS`` rows; every row
is scored on its whole text.  Null and empty texts score like a text without
hits; without labels the fixed lexicon alone votes; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import written
from .textblocks import LOWER, U64, Block, blocks, hash_word, mix, shingle_sets, word_bounds, word_hashes
from .training import remainder, sample

THRESHOLD = 0.7
FOLDS, HELD_OUT = 3, 1
#: Entries of the learned lexicons, at most, and what an entry must have seen besides a likelihood beyond chance.
LEXICON, MIN_TOXIC, MIN_SHARE = 4096, 4, 0.75
#: Rows without hits and rows full of them that always join the sample.
ANCHORS = 30
#: Bytes of the word beginnings that lexicons are learned of; words must be longer by two.
BEGINNINGS = (4, 5, 6)

#: Common insults.
INSULTS = """idiot idiots moron morons stupid loser losers trash scum clown pathetic worthless disgusting dumb jerk imbecile
dummkopf trottel abschaum versager wertlos ekelhaft idiote imbécile ordure crétin débile imbécil estúpido basura payaso inútil""".split()

_NOT_LETTER = np.ones(256, bool)
_NOT_LETTER[97:123] = _NOT_LETTER[128:] = False
_SALT = {0: U64(0), **{k: U64(0x9E3779B97F4A7C15 * k & (2**64 - 1)) for k in BEGINNINGS}}
FEATURES = ["words", "fixed", "learned", *[f"begin{k}" for k in BEGINNINGS], "hits", "close"]


def keys_of(b: Block) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document of each word, and its keys: the word, and its beginnings (0 where too short)."""
    data = LOWER[b.data]
    starts, ends, doc = word_bounds(data, b.offsets, _NOT_LETTER)
    keys = [word_hashes(data, starts, ends)]
    for k in BEGINNINGS:
        h = mix(word_hashes(data, starts, np.minimum(starts + k, ends)) ^ _SALT[k])
        keys.append(np.where(ends - starts >= k + 2, h, U64(0)))
    return doc, keys


def _associate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents of every key, summed over what a task sees."""
    held: list[tuple[np.ndarray, np.ndarray]] = []

    def out():
        key, toxic = (np.concatenate(c) for c in zip(*held))
        u, at = np.unique(key, return_inverse=True)
        return pa.RecordBatch.from_pydict({"key": u.astype(np.int64), "n": np.bincount(at).astype(np.int64), "toxic": np.bincount(at, toxic).astype(np.int64)})

    size = 0
    for b in blocks(batches):
        y = b.longs("y")
        doc, keys = keys_of(b)
        for k in keys:
            own = _once(doc, k, k > 0)
            held.append((k[own], y[doc[own]]))
            size += len(own)
        if size > 500_000:
            yield out()
            held, size = [], 0
    if held:
        yield out()


def _once(doc: np.ndarray, key: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the chosen words, one for each document and key."""
    at = np.flatnonzero(chosen)
    _, first = np.unique(mix(key[at] ^ mix(doc[at].astype(U64))), return_index=True)
    return at[first]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Three minimum shingle hashes of each text: near copies agree in one of them nearly always."""
    for b in blocks(batches):
        h, d, n = shingle_sets(b)
        at = (np.cumsum(n) - n)[n > 0]
        sigs = []
        for k in range(3):
            low = np.zeros(b.n, np.int64)
            if len(at):
                low[n > 0] = np.minimum.reduceat(mix(h ^ U64(0x9E3779B97F4A7C15 * (k + 1) & (2**64 - 1))), at).astype(np.int64)
            sigs.append(pa.array(low))
        own = b.batch.slice(b.first, b.n)
        yield pa.RecordBatch.from_arrays([own.column("doc_id"), own.column("y"), own.column("text"), *sigs], names=["doc_id", "y", "text", "s0", "s1", "s2"])


def _distinct(doc: np.ndarray, key: np.ndarray, hit: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc[_once(doc, key, hit)], minlength=n)


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(sorted_keys):
        return np.zeros(len(keys), bool)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return (sorted_keys[at] == keys) & (keys != 0)


def features(b: Block, fixed: np.ndarray, learned: np.ndarray) -> np.ndarray:
    """One row of FEATURES for each document: how many different words each lexicon hits."""
    doc, keys = keys_of(b)
    hits = [_found(fixed, keys[0])] + [_found(learned, k) for k in keys]
    n_words = np.bincount(doc, minlength=b.n)
    columns = [n_words, *[_distinct(doc, keys[0], h, b.n) for h in hits]]
    any_hit = np.logical_or.reduce(hits)
    columns.append(np.bincount(doc[any_hit], minlength=b.n))
    at = np.flatnonzero(any_hit)
    close = (np.diff(at) <= 40) & (doc[at[1:]] == doc[at[:-1]]) & (keys[0][at[1:]] != keys[0][at[:-1]]) if len(at) > 1 else np.zeros(0, bool)
    columns.append(np.bincount(doc[at[1:]][close], minlength=b.n) if len(at) > 1 else np.zeros(b.n, int))
    return np.stack(columns, 1).astype(np.float64)


def votes(x: np.ndarray, learned: bool = True) -> np.ndarray:
    """1 toxic, 0 clean, 2 abstain, for each voter; without learned lexicons their voters abstain."""
    f = dict(zip(FEATURES, x.T))
    by_count = lambda c: np.where(c >= 2, 1, np.where(c == 0, 0, 2))
    # beginnings are taken of longer words only: short entries count through the word lexicon
    begin = [np.maximum(f[f"begin{k}"], f["learned"]) for k in BEGINNINGS]
    density = f["hits"] / np.maximum(f["words"], 1)
    v = np.stack(
        [
            np.where(f["fixed"] >= 2, 1, 2),
            by_count(f["learned"]),
            *[by_count(c) for c in begin],
            np.where((density >= 0.008) & (f["hits"] >= 2), 1, np.where(density < 0.002, 0, 2)),
            np.where(f["close"] >= 1, 1, 2),
            np.where(f["hits"] <= 1, 0, 1),
        ],
        1,
    ).astype(int)
    if not learned:
        v[:, 1 : 2 + len(BEGINNINGS)] = 2
    return v


@dataclass
class LabelModel:
    """P(label) and P(vote | label, parent's vote) along a tree of voters."""

    prior: np.ndarray
    parent: list[int]
    table: np.ndarray  # voter, label, parent's vote, vote
    accuracy: np.ndarray
    correlation: np.ndarray

    def posterior(self, v: np.ndarray) -> np.ndarray:
        logs = np.log(self.prior)[None].repeat(len(v), 0)
        for j, p in enumerate(self.parent):
            above = v[:, p] if p >= 0 else np.zeros(len(v), int)
            logs += np.log(self.table[j][:, above, v[:, j]]).T
        logs -= logs.max(1, keepdims=True)
        e = np.exp(logs)
        return e[:, 1] / e.sum(1)


def fit_label_model(v: np.ndarray, rounds: int = 40) -> LabelModel:
    """Expectation maximisation over vote patterns; the tree is re-chosen from the current posteriors."""
    patterns, weight = np.unique(v, axis=0, return_counts=True)
    m = v.shape[1]
    toxic, clean = (patterns == 1).sum(1), (patterns == 0).sum(1)
    q = np.where(toxic > clean, 0.9, np.where(toxic == clean, 0.5, 0.05))

    def joint(j: int, p: int, w: np.ndarray) -> np.ndarray:
        t = np.zeros((3, 3))
        np.add.at(t, (patterns[:, p], patterns[:, j]), w)
        return t

    model = None
    for turn in range(rounds):
        w = np.stack([weight * (1 - q), weight * q])
        prior = (w.sum(1) + 1) / (w.sum() + 2)
        if turn % 10 == 0:
            # conditional mutual information of each pair, and its strongest tree from voter 0
            info = np.zeros((m, m))
            for a in range(m):
                for b in range(a):
                    for y in range(2):
                        t = joint(a, b, w[y]) + 0.1
                        t /= t.sum()
                        info[a, b] += prior[y] * (t * np.log(t / t.sum(1, keepdims=True) / t.sum(0, keepdims=True))).sum()
            info += info.T
            parent, inside = [-1] * m, {0}
            while len(inside) < m:
                a, b = max(((a, b) for a in inside for b in range(m) if b not in inside), key=lambda ab: info[ab])
                parent[b] = a
                inside.add(b)
        table = np.zeros((m, 2, 3, 3))
        for j, p in enumerate(parent):
            for y in range(2):
                t = joint(j, p, w[y]) if p >= 0 else np.tile(np.bincount(patterns[:, j], w[y], 3), (3, 1))
                own = np.bincount(patterns[:, j], w[y], 3) + 0.5
                t = t + 2 * own / own.sum()
                table[j, y] = t / t.sum(1, keepdims=True)
        right = np.array([[w[y][patterns[:, j] == y].sum() / max(1e-9, w[y][patterns[:, j] < 2].sum()) for y in range(2)] for j in range(m)])
        model = LabelModel(prior, parent, table, right, info)
        q = model.posterior(patterns)
    return model


def design(x: np.ndarray) -> np.ndarray:
    """Inputs of the linear classifier: stepped counts and densities of hits."""
    f = dict(zip(FEATURES, x.T))
    columns = []
    for name in FEATURES[1:]:
        columns += [(f[name] >= k).astype(float) for k in (1, 2, 3, 4, 6)]
    density = f["hits"] / np.maximum(f["words"], 1)
    columns += [(density >= d).astype(float) for d in (0.002, 0.005, 0.01, 0.02)]
    return np.stack(columns, 1)


def fit_logistic(x: np.ndarray, q: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Newton's method on soft labels; the last weight is the intercept."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    penalty = np.eye(len(w)) * ridge
    penalty[-1, -1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (q - p) - penalty @ w
        h = (a * (p * (1 - p) + 1e-6)[:, None]).T @ a + penalty
        step = np.linalg.solve(h, g)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class ToxicityModel:
    fixed: np.ndarray
    learned: np.ndarray
    label_model: LabelModel
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        z = np.hstack([design(x), np.ones((len(x), 1))]) @ self.weights
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _features(fixed: np.ndarray, learned: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            x = features(b, fixed, learned)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(list(x), pa.list_(pa.float64()))], names=["doc_id", "x"])

    return run


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    rows = sample(docs, labels, "toxic", FOLDS, HELD_OUT).mapInArrow(_signatures, "doc_id long, y int, text string, s0 long, s1 long, s2 long")
    # one of each group of near copies, that of the least id: else all words of a toxic text with copies look toxic
    for k in range(3):
        rest = [c for c in rows.columns if c not in (f"s{k}", "y", "doc_id")]
        rows = rows.groupBy(f"s{k}", "y").agg(F.min(F.struct("doc_id", *rest)).alias("row")).select(f"s{k}", "y", "row.*")
    rows = written(docs.sparkSession, rows.select("doc_id", "y", "text"), "sample")
    fixed = np.array(sorted(hash_word(w) for w in INSULTS), U64)
    counts = rows.mapInArrow(_associate, "key long, n long, toxic long").groupBy("key").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    counts = written(docs.sparkSession, counts.where(f"n >= {MIN_TOXIC}"), "keys")
    base = max(1e-3, rows.agg(F.avg("y")).first()[0] or 0.1)
    beyond = F.col("toxic") * F.log(F.col("toxic") / F.col("n") / base) >= float(np.log(max(2, counts.count())))
    strong = counts.where(beyond & (F.col("toxic") >= MIN_TOXIC) & (F.col("toxic") >= MIN_SHARE * F.col("n")))
    learned = np.sort(strong.orderBy(F.desc("toxic"), "key").limit(LEXICON).select("key").toPandas()["key"].to_numpy(np.int64).astype(U64))
    got = rows.select("doc_id", "text").mapInArrow(_features(fixed, learned), "doc_id long, x array<double>").toPandas()
    got = got.assign(by=[tuple(x) for x in got["x"]]).sort_values(["doc_id", "by"])["x"]  # the same sums however rows come
    x = np.stack([np.array(r) for r in got]) if len(got) else np.zeros((1, len(FEATURES)))
    # texts without and with hits are always there, so that neither class is empty
    full = [50.0 if name == "words" else 0.0 if name.startswith(("learned", "begin")) and not len(learned) else 4.0 for name in FEATURES]
    x = np.vstack([x, np.zeros((ANCHORS, len(FEATURES))), np.tile(full, (ANCHORS, 1))])
    v = votes(x, len(learned) > 0)
    model = fit_label_model(v)
    return ToxicityModel(fixed, learned, model, fit_logistic(design(x), model.posterior(v)))


def _score(model: ToxicityModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            s = model.score(features(b, model.fixed, model.learned))
            own = [b.column(c) for c in b.batch.schema.names if c != "text"]
            names = [c for c in b.batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*own, pa.array(s)], names=[*names, "score"])

    return run


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """Every row -> (doc_id, held_out, score, predicted)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_score(model), "doc_id long, score double")
    return rows.select("doc_id", (remainder(FOLDS) == HELD_OUT).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under the threshold; all columns kept."""
    model = fit(docs, labels)
    schema = docs.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            good = model.score(features(b, model.fixed, model.learned)) < THRESHOLD
            yield b.batch.slice(b.first, b.n).filter(pa.array(good))

    return docs.mapInArrow(run, fields)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
