import math
import random
import re

import numpy as np

from ledgerlake.llm import licenses
from ledgerlake.llm.licenses import BASE, TEMPLATES, scan


def words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base(text):
    w = words(text)
    places = sorted((i, label) for p, label in BASE.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split())
    return len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_base_columns_match_brute_force_and_templates_are_found(spark, docs_of):
    rng = random.Random(9)
    vocab = ["the", "mit", "license", "apache", "general", "public", "gnu", "of", "é", "x1", "version"] + [f"w{k}" for k in range(80)]
    rows = [(i, rng.choice([" ", "-", "\n"]).join(rng.choice(vocab).upper() if rng.random() < 0.3 else rng.choice(vocab) for _ in range(rng.randrange(0, 80)))) for i in range(200)]
    rows += [(1000 + k, f"Some words. {t.capitalize()}, and more words here.") for k, (_, t, _) in enumerate(TEMPLATES)]
    rows += [(2000, None), (2001, ""), (2002, "MIT\x00License mit—license"), (None, "Apache License"), (2003, "mit license " * 4000), (2003, "nothing here at all")]
    got = scan(docs_of(rows)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=str) == sorted(((i, *base(t)) for i, t in rows), key=str)
    by = {r.doc_id: r for r in got}
    for k, (label, _, _) in enumerate(TEMPLATES):
        assert label in by[1000 + k].labels.split(","), (label, by[1000 + k])
        assert by[1000 + k].score >= 0.9
    assert all(set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1 for r in got)
    assert by[2001].labels == "" and by[2001].score == 0


def test_empty_table_and_words_alone(spark, docs_of):
    assert scan(docs_of([])).collect() == []
    got = scan(docs_of([(1, "general of the public license was granted to any copy of this software"), (2, "a b c")])).collect()
    assert all(r.labels == "" and r.score == 0 for r in got)


def test_every_licence_of_a_file_with_several_and_of_a_long_one(spark, docs_of):
    several = "Licensed under the Apache License, Version 2.0. The docs are licensed under CC BY-NC 4.0; the logo is released under the MIT license. All rights reserved."
    every = " and then ".join(t for _, t, _ in TEMPLATES)
    scattered = sorted({w for _, t, _ in TEMPLATES for w in t.split()})
    long = " filler ".join(scattered * 20)
    rows = [(1, several), (2, every), *[(10 + k, f"{long} filler {t} filler {long}") for k, (_, t, _) in enumerate(TEMPLATES)]]
    rows += [(100 + i, "nothing but apache cc nc 2 4 0 released by") for i in range(5)] + [(200 + i, "all rights are reserved here and the rights of all") for i in range(50)]
    by = {r.doc_id: set(r.labels.split(",")) for r in scan(docs_of(rows)).collect()}
    assert by[1] == {"apache", "cc-by-nc", "mit", "proprietary"}
    assert by[2] == {label for label, _, _ in TEMPLATES}
    for k, (label, _, _) in enumerate(TEMPLATES):
        assert label in by[10 + k], label
    assert by[100] == by[200] == {""}


def exhaustive(text):
    """Labels and score with every template tried at every offset, as the docstring states them."""
    w, labels, score = words(text), set(), 0.0
    for label, template, keys in TEMPLATES:
        t = template.split()
        need = min(len(set(t)), max(licenses.AGREE, math.ceil(licenses.AGREE_SHARE * len(set(t)))))
        near = lambda at: w[max(0, at - licenses.SLACK) : max(0, at + licenses.SLACK + 1)]
        for o in range(-len(t) - licenses.SLACK, len(w) + licenses.SLACK):
            found = [x in near(o + q) for q, x in enumerate(t)]
            if len({x for x, y in zip(t, found) if y}) < need:
                continue
            starts = range(max(0, o - licenses.SLACK), o + len(t) + licenses.SLACK)
            if any(w[p : p + len(k.split())] == k.split() and p + len(k.split()) <= o + len(t) + licenses.SLACK for k in keys for p in starts):
                labels.add(label)
                score = max(score, sum(found) / len(t))
    base_labels = set(filter(None, base(text)[4].split(",")))
    return ",".join(sorted(labels | base_labels)), max(score, 0.5 if base_labels else 0.0)


def mixed(rng):
    """Fragments of templates with words lost, added or moved, key phrases alone, and shuffled licence words."""
    parts = []
    for _ in range(rng.randrange(1, 5)):
        _, template, keys = rng.choice(TEMPLATES)
        t = template.split()
        kind = rng.randrange(5)
        if kind == 0:
            parts += t
        elif kind == 1:
            a = rng.randrange(len(t))
            parts += t[a : a + rng.randrange(1, len(t) + 1)]
        elif kind == 2:
            parts += [x for x in t if rng.random() < 0.7]
        elif kind == 3:
            parts += rng.choice(keys).split()
        else:
            parts += rng.sample(t, len(t)) + rng.choice(keys).split()
        parts += [f"w{rng.randrange(9)}" for _ in range(rng.randrange(4))]
    return " ".join(parts)


def test_labels_and_score_match_an_exhaustive_search(spark, docs_of):
    rng = random.Random(21)
    rows = [(i, mixed(rng)) for i in range(400)] + [(1000, None), (1001, "reserved"), (1002, "all rights reserved " * 50), (1003, "mit license the released under")]
    got = {r.doc_id: (r.labels, r.score) for r in scan(docs_of(rows)).collect()}
    for i, text in rows:
        labels, score = exhaustive(text)
        assert got[i][0] == labels and abs(got[i][1] - score) < 1e-9, (text, got[i], labels, score)


def test_rarity_decides_what_is_compared_not_what_is_found():
    rng = random.Random(22)
    hash_of = lambda text: licenses._hashes(" ".join(words(text)))
    index = licenses.LicenseIndex()
    for _ in range(20):
        texts = [mixed(rng) for _ in range(10)]
        own = [hash_of(x) for x in texts]
        flat, doc = np.concatenate(own), np.repeat(np.arange(10), [len(x) for x in own])
        hits = [np.flatnonzero(flat == h) for h in index.vocab]
        results = []
        for _ in range(3):
            index.idf = np.array([rng.random() for _ in index.vocab])
            results.append([licenses.matches(index, t, flat, doc, hits) for t in range(len(TEMPLATES))])
        assert results[0] == results[1] == results[2]


def test_a_bare_key_phrase_among_shuffled_words_gives_no_label(spark, docs_of):
    gpl = next(t for label, t, _ in TEMPLATES if label == "lgpl").split()
    rng = random.Random(23)
    rows = [(i, " ".join([*rng.sample(gpl, len(gpl)), "x y z lesser general public license x y z", *rng.sample(gpl, len(gpl))])) for i in range(20)]
    assert {r.labels for r in scan(docs_of(rows)).collect()} == {"gpl"}  # its base phrase; no template stands there
    bsd = "foo redistribution and use in source and binary forms bar"
    assert [r.labels for r in scan(docs_of([(1, bsd)])).collect()] == [exhaustive(bsd)[0]]
