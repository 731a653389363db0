import math
import random
import re
from collections import Counter

import pytest

from ledgerlake.llm import decontamination
from ledgerlake.llm.decontamination import ANSWER, QUESTION, contaminated, without_contaminated


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def test_planted_items_are_found_and_others_left(spark, docs_of):
    rng = random.Random(6)
    vocab = ["the", "of", "and", "in"] * 40 + [f"word{k}" for k in range(600)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(say(rng.randrange(15, 60)))) for k in range(700)]
    items += [(700, None), (701, ""), (702, "what is it\nthe answer is fortytwo indeed")]
    rows, planted = [], set()
    for i in range(150):
        text = say(rng.randrange(0, 300))
        if i % 5 == 0:
            k = rng.randrange(700)
            copy = items[k][1].split()
            if i % 10 == 0:
                copy[len(copy) // 3] = "changed"
            text[len(text) // 2 : len(text) // 2] = [w.upper() + "," for w in copy]
            planted.add((i, k))
        rows.append((i, " ".join(text)))
    rows += [(900, None), (901, ""), (902, "x what is it the answer is fortytwo indeed y"), (902, "x what is it the answer is fortytwo indeed y"), (903, "what is it"), (None, items[3][1]), (904, " ".join(say(20_000)) + " " + items[5][1])]
    planted |= {(902, 702), (None, 3), (904, 5)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = docs_of(rows)
    got = contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id) for r in got} == planted
    assert sum(r.doc_id == 902 for r in got) == 2
    assert all(r.question_overlap >= QUESTION and r.answer_overlap >= ANSWER for r in got)
    kept = without_contaminated(df, bench)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i not in {d for d, _ in planted}}


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert contaminated(docs_of([(1, "a b c")]), bench).collect() == []
    assert contaminated(docs_of([]), spark.createDataFrame([(1, "a b c")], "item_id long, text string")).collect() == []


def test_whole_copies_in_the_smallest_tables(spark):
    sf = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in contaminated(docs, bench).collect()}
    texts = [(r.doc_id, " " + " ".join(words(r.text)) + " ") for r in docs.collect()]
    want = {(d, r.item_id) for r in bench.collect() for d, t in texts if f" {' '.join(words(r.text))} " in t}
    assert want and want <= got and len(got - want) <= len(want) // 10 + 1


def trigrams(w):
    k = min(3, max(1, len(w)))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def exhaustive(docs, items):
    """Every item against every window, by the formula, without an index."""
    items = [(i, t) for i, t in dict.fromkeys(items) if i is not None and words(t)]
    bags = [Counter(words(t)) for _, t in items]
    df = Counter(w for b in bags for w in b)
    n, mean = len(items), sum(sum(b.values()) for b in bags) / max(1, len(items))
    out = {}
    for (i, text), bag in zip(items, bags):
        size = sum(bag.values())
        impact = {w: math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size / mean)) for w, tf in bag.items()}
        w = words(text)
        lines = [x for x in text.split("\n") if x.strip()]
        end = len(words(lines[-1])) if len(lines) > 1 else 0
        if not 3 <= end < len(w) - 2:
            end = max(3, len(w) // 4)
        cut = max(len(w) - end, min(3, len(w)))
        parts = trigrams(w[:cut]), trigrams(w[cut:] if len(w) - cut >= 3 else w[-3:])
        stride = 32
        while stride < size:
            stride *= 2
        for d, t in docs:
            held = words(t)
            for low in range(0, len(held), stride):
                share = sum(impact.get(x, 0) for x in set(held[low : low + 2 * stride])) / sum(impact.values())
                if share < 0.6 - 1e-9:
                    continue
                span = held[low : low + 2 * stride + 2]
                grams = {tuple(span[a : a + k]) for k in (1, 2, 3) for a in range(len(span) - k + 1)}
                q, a = (len(p & grams) / len(p) for p in parts)
                if q >= QUESTION and a >= ANSWER:
                    out[d, i, text] = max(out.get((d, i, text), (0, 0, 0)), (share, q, a))
    return sorted((d, i, *(round(x, 6) for x in row)) for (d, i, _), row in out.items())


@pytest.mark.parametrize("shard_items", [512, 8])
def test_equals_exhaustive_search_however_items_are_dealt(spark, docs_of, monkeypatch, shard_items):
    """Edited items near the thresholds, items of many lengths, repeated items, an id with two texts, ties."""
    monkeypatch.setattr(decontamination, "SHARD_ITEMS", shard_items)
    rng = random.Random(17)
    vocab = ["the", "of", "and"] * 20 + [f"v{k}" for k in range(200)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    items = [(k, " ".join(say(rng.choice([1, 2, 3, 5, 9, 20, 32, 33, 60, 150])))) for k in range(90)]
    items += [(90, " ".join(say(12)) + "\n" + " ".join(say(4))), (91, "  \n "), (92, None), (None, items[4][1]), items[7], (7, " ".join(say(25))), (93, items[8][1])]
    docs = []
    for d in range(120):
        copy = rng.choice([t for i, t in items if t and t.strip() and i is not None]).split()
        for _ in range(rng.randrange(0, 1 + len(copy) // 3)):
            copy[rng.randrange(len(copy))] = rng.choice(vocab)
        docs.append((d, " ".join(say(rng.randrange(0, 120)) + copy + say(rng.randrange(0, 60)))))
    want = exhaustive(docs, items)
    got = contaminated(docs_of(docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len(want) > 60
    assert sorted((r.doc_id, r.item_id, *(round(x, 6) for x in r[2:])) for r in got) == want
