"""Operator 10: licence scan with a positional index of rare words.

*Base.*  Places where the words of a fixed phrase stand consecutively.

*Method.*  Licence templates are indexed by word with positions.  A template
stands at an offset of a file if at least ``AGREE_SHARE`` of its different words (and ``AGREE``
of them, if it has as many) stand at their place there, give or take ``SLACK`` words, and one of its
mandatory key phrases stands within.  A word's rarity is its inverse document
frequency over all documents scanned.  Only the rarest words are looked up: of D words of which
``need`` must agree, any D - need + 2 hold two that do, so the postings of the D - need + 2
rarest are intersected by relative position, and where two agree all words are
compared, and last the key phrases.  Rarity thus decides what is compared, never what is found.
The score is the largest share of a template's words found at their place.

Words are letters, digits and bytes beyond ASCII, A-Z lower-cased.  Null texts
have no words; the score is 0 without places and labels, at least 1/2 with a base
place; repeated rows are scanned each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textblocks import LOWER, NOT_ALNUM, U64, Block, blocks, hash_word, word_bounds, word_hashes

AGREE, AGREE_SHARE, SLACK = 3, 0.5, 2
#: Looked-up words that agree on an offset before all words are compared, and offsets compared at once.
MEET, AT_ONCE = 2, 1 << 15
BASE_SCORE = 0.5

#: Base phrases and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Openings of public licences and notices, with the phrases one of which must stand in a file.
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction", ["permission is hereby granted free of charge"]),
    ("mit", "released under the mit license", ["the mit license"]),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at", ["apache license version 2"]),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version", ["gnu general public license"]),
    ("gpl", "this work is licensed under the gnu general public license version 3", ["gnu general public license"]),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation", ["lesser general public license"]),
    ("agpl", "you should have received a copy of the gnu affero general public license along with this program", ["affero general public license"]),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ["redistribution and use in source and binary forms"]),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ["for any purpose with or without fee"]),
    ("unlicense", "this is free and unencumbered software released into the public domain", ["released into the public domain"]),
    ("cc-by-nc", "licensed under cc by nc 4 0", ["cc by nc"]),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", ["attribution noncommercial"]),
    ("cc-by-sa", "licensed under cc by sa 4 0", ["cc by sa"]),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", ["creative commons attribution 4"]),
    ("proprietary", "all rights reserved", ["all rights reserved"]),
]


def _hashes(text: str) -> np.ndarray:
    return np.array([hash_word(w) for w in text.split()], U64)


class LicenseIndex:
    """Template words with their postings (template, position); rarity is set from the corpus."""

    def __init__(self):
        self.words = [_hashes(t) for _, t, _ in TEMPLATES]
        self.labels = [label for label, _, _ in TEMPLATES]
        self.keys = [[_hashes(k) for k in keys] for _, _, keys in TEMPLATES]
        self.base = [(_hashes(p), label) for p, label in BASE.items()]
        self.vocab = np.unique(np.concatenate(self.words))
        #: of each template its different words (numbers in the vocabulary), and of each of its places the number among these
        self.own, self.nth = zip(*[np.unique(np.searchsorted(self.vocab, w), return_inverse=True) for w in self.words])
        self.need = [min(len(o), max(AGREE, int(np.ceil(AGREE_SHARE * len(o))))) for o in self.own]
        self.idf = np.ones(len(self.vocab))

    def with_rarity(self, df: dict[int, int], n: int) -> LicenseIndex:
        self.idf = np.array([np.log((n + 1) / (df.get(int(np.int64(h)), 0) + 1)) for h in self.vocab.view(np.int64)])
        return self

    def looked_up(self, t: int) -> np.ndarray:
        """The rarest words of a template, as places among its different words: so many that ``MEET`` of them agree wherever it stands."""
        k = len(self.own[t]) - self.need[t] + min(MEET, self.need[t])
        return np.argsort(-self.idf[self.own[t]], kind="stable")[:k]


def _words(b: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = LOWER[b.data]
    starts, ends, doc = word_bounds(data, b.offsets, NOT_ALNUM)
    words = word_hashes(data, starts, ends)
    n = np.bincount(doc, minlength=b.n)
    return words, doc, n


def _places(words: np.ndarray, doc: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of all places of a phrase."""
    k = len(phrase)
    if len(words) < k:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(words[: len(words) - k + 1] == phrase[0])
    for j in range(1, k):
        at = at[words[at + j] == phrase[j]]
    return at[doc[at] == doc[at + k - 1]]


def _standing(words: np.ndarray, doc: np.ndarray, f: np.ndarray, place: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which wanted words stand at which places of files ``f``; places outside a file hold nothing."""
    inside = np.clip(place, 0, max(0, len(words) - 1))
    return (words[inside] == wanted) & (doc[inside] == f) & (inside == place)


def candidates(index: LicenseIndex, t: int, doc: np.ndarray, hits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(file, offset) where ``MEET`` looked-up words of a template agree; offsets are word numbers of the block, before a file's first word too."""
    reach = len(index.words[t]) + SLACK
    span = len(doc) + 2 * reach
    keys = []
    for k in index.looked_up(t):
        spots = hits[index.own[t][k]]
        of = np.concatenate([doc[spots] * span + spots - q + reach for q in np.flatnonzero(index.nth[t] == k)])
        # a word that fits an offset twice gives no more evidence
        keys.append(np.unique((of[:, None] + np.arange(-SLACK, SLACK + 1)).ravel()))
    key, seen = np.unique(np.concatenate(keys), return_counts=True)
    key = key[seen >= min(MEET, index.need[t])]
    return key // span, key % span - reach


def matches(index: LicenseIndex, t: int, words: np.ndarray, doc: np.ndarray, hits: list[np.ndarray]) -> dict[int, float]:
    """Files that hold template t -> the largest share of its words at their place."""
    files, offsets = candidates(index, t, doc, hits)
    best: dict[int, float] = {}
    size = len(index.words[t])
    for i in range(0, len(files), AT_ONCE):
        f, o = files[i : i + AT_ONCE], offsets[i : i + AT_ONCE]
        found = np.zeros((len(f), size), bool)
        for q, h in enumerate(index.words[t]):
            for s in range(-SLACK, SLACK + 1):
                found[:, q] |= _standing(words, doc, f, o + q + s, h)
        different = np.zeros((len(f), len(index.own[t])), bool)
        for q, k in enumerate(index.nth[t]):
            different[:, k] |= found[:, q]
        good = different.sum(1) >= index.need[t]
        f, o, share = f[good], o[good], found[good].mean(1)
        phrase = np.zeros(len(f), bool)
        for key in index.keys[t]:
            for start in range(-SLACK, size - len(key) + SLACK + 1):
                phrase |= np.logical_and.reduce([_standing(words, doc, f, o + start + j, h) for j, h in enumerate(key)])
        for n, x in zip(f[phrase].tolist(), share[phrase].tolist()):
            best[n] = max(best.get(n, 0.0), x)
    return best


def _frequencies(index: LicenseIndex):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(index.vocab) + 1, np.int64)
        for b in blocks(batches):
            words, doc, _ = _words(b)
            at = np.searchsorted(index.vocab, words)
            at[at == len(index.vocab)] = 0
            hit = index.vocab[at] == words
            pair = np.unique(doc[hit] * len(index.vocab) + at[hit])
            count[:-1] += np.bincount(pair % len(index.vocab), minlength=len(index.vocab))
            count[-1] += b.n
        yield pa.RecordBatch.from_pydict({"word": np.append(index.vocab.view(np.int64), 0), "last": np.append(np.zeros(len(index.vocab), bool), True), "n": count})

    return run


def scan_block(index: LicenseIndex, b: Block) -> dict[str, list]:
    words, doc, n = _words(b)
    first = np.cumsum(n) - n
    labels: list[set] = [set() for _ in range(b.n)]
    base_labels: list[set] = [set() for _ in range(b.n)]
    n_base = np.zeros(b.n, np.int64)
    low, high = np.full(b.n, -1), np.full(b.n, -1)
    score = np.zeros(b.n)
    for phrase, label in index.base:
        for p in _places(words, doc, phrase):
            d = doc[p]
            at = p - first[d]
            n_base[d] += 1
            low[d] = at if low[d] < 0 else min(low[d], at)
            high[d] = max(high[d], at)
            base_labels[d].add(label)
            score[d] = max(score[d], BASE_SCORE)
    at = np.searchsorted(index.vocab, words)
    at[at == len(index.vocab)] = 0
    hit = np.flatnonzero(index.vocab[at] == words)
    order = np.argsort(at[hit], kind="stable")
    cuts = np.searchsorted(at[hit][order], np.arange(len(index.vocab) + 1))
    hits = [hit[order[i:j]] for i, j in zip(cuts[:-1], cuts[1:])]
    for t in range(len(index.words)):
        for f, share in matches(index, t, words, doc, hits).items():
            labels[f].add(index.labels[t])
            score[f] = max(score[f], share)
    none = lambda x: [None if v < 0 else int(v) for v in x]
    return {
        "n_words": n.tolist(),
        "n_base": n_base.tolist(),
        "first_word": none(low),
        "last_word": none(high),
        "base_labels": [",".join(sorted(x)) for x in base_labels],
        "labels": [",".join(sorted(x | y)) for x, y in zip(base_labels, labels)],
        "score": score.tolist(),
    }


SCAN_SQL = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def _scan(index: LicenseIndex):
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            got = scan_block(index, b)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(v, k) for v, k in zip(got.values(), kinds)]], names=["doc_id", *got])

    return run


def scan(docs: DataFrame) -> DataFrame:
    """Every row -> (doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    index = LicenseIndex()
    # one row a template word: a proven bound
    counts = rows.mapInArrow(_frequencies(index), "word long, last boolean, n long").groupBy("word", "last").agg(F.sum("n").alias("n")).collect()
    df = {r.word: r.n for r in counts if not r.last}
    n = sum(r.n for r in counts if r.last)
    return rows.mapInArrow(_scan(index.with_rarity(df, n)), SCAN_SQL)


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))
