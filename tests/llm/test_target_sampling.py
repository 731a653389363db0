import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import target_sampling as T


def features(text, order):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [zlib.crc32(" ".join(words[i : i + k]).encode()) for k in range(1, order + 1) for i in range(len(words) - k + 1)]


def brute(rows, target, percent, min_words, order, buckets):
    s, t = Counter(), Counter()
    for _, x in rows:
        s.update(f % buckets for f in features(x, order)[1])
    for x in target:
        t.update(f % buckets for f in features(x, order)[1])
    S, T_ = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T_ + buckets)))) for b in range(buckets)}
    out = []
    for i, x in rows:
        n_words, f = features(x, order)
        weight = sum(gain[y % buckets] for y in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((n_words, i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((x for x in out if x[0] >= min_words), key=lambda x: (-x[4], x[1] is None, x[1] or 0, x[2]))
    drawn = fit[: len(fit) * percent // 100]
    ranked = [(*x[1:], k) for k, x in enumerate(drawn, 1)]
    return Counter(ranked + [(*x[1:], None) for x in fit[len(drawn) :]] + [(*x[1:], None) for x in out if x[0] < min_words])


@pytest.mark.parametrize("order,percent,accuracy", [(1, 10, 2000), (2, 37, 2000), (1, 50, 4), (1, 0, 2000), (1, 100, 2000)])
def test_draw_equals_brute_force(spark, docs_of, order, percent, accuracy):
    rng = random.Random(order * 100 + percent)
    words = [f"w{i}" for i in range(30)] + ["Été", "X-ray", "a_b", "3.14", "日本"]
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([0, 3, 19, 20, 25, 60])))) for i in range(300)]
    rows += [(i, None) for i in (300, 301)] + [(302, ""), (303, "long " * 5000), (None, "w1 " * 30), (None, "w1 " * 30), (7, rows[7][1]), (8, "w2 " * 25), (8, "w2 " * 25)]
    target = ["w1 w2 w3 w1", None, "", "日本 Été " * 10]
    bench = spark.createDataFrame([(str(i), t) for i, t in enumerate(target)], "item_id string, text string")
    got = T.draw(spark, docs_of(rows).repartition(4), bench, percent=percent, order=order, buckets=97, accuracy=accuracy)
    assert Counter(tuple(r[c] for c in ("doc_id", "n_features", "weight", "score", "rank")) for r in got.collect()) == brute(rows, target, percent, 20, order, 97)


def test_empty_tables(spark, docs_of):
    empty = spark.createDataFrame([], "item_id string, text string")
    assert T.draw(spark, docs_of([]), empty).collect() == []
    assert [r.weight for r in T.draw(spark, docs_of([(1, None)]), empty).collect()] == [0]


def test_a_bracket_that_misses_is_widened(spark):
    """With a coarse sketch of many equal scores the exact counts decide, up to the smallest and largest score."""
    rows = spark.range(10_000).select(F.when(F.col("id") < 9_000, 5).when(F.col("id") < 9_990, 7).otherwise(F.col("id")).alias("score")).repartition(7)
    for k in (1, 5, 10, 11, 900, 1_000, 1_001, 9_999, 10_000):
        for accuracy in (2, 50, 2000):
            low, high, above = T.bracket(rows, "score", 10_000, k, accuracy)
            assert above == rows.where(F.col("score") > high).count() < k <= rows.where(F.col("score") >= low).count()


def test_places_are_those_of_a_sort_even_of_one_hot_score(spark):
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("score"), "id").repartition(6)
    got = T.numbered(spark, rows, F.col("score").desc(), F.col("id").asc()).collect()
    assert [(r.score, r.id) for r in sorted(got, key=lambda r: r.place)] == sorted(((r.score, r.id) for r in rows.collect()), key=lambda x: (-x[0], x[1]))
    assert sorted(r.place for r in got) == list(range(1, 5_001))
