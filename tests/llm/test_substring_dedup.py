import random
from collections import Counter

from ledgerlake.llm.substring_dedup import WINDOW, cut_repeats


def brute(rows):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    seen = Counter(tuple(w[k : k + WINDOW]) for _, w in docs for k in range(len(w) - WINDOW + 1))
    out = []
    for i, w in docs:
        gone = set()
        for k in range(len(w) - WINDOW + 1):
            if seen[tuple(w[k : k + WINDOW])] > 1:
                gone.update(range(k, k + WINDOW))
        out.append((i, len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode()))
    return sorted(out, key=str)


def test_cut_matches_brute_force(spark, docs_of):
    rng = random.Random(4)
    vocab = ["a", "b", "cé", "D", "e,"] + [f"w{k}" for k in range(400)]
    words = lambda n, m=405: [rng.choice(vocab[:m]) for _ in range(n)]
    passages = [words(n) for n in (34, 35, 36, 50, 80)]
    rows = []
    for i in range(120):
        text = words(rng.randrange(0, 60))
        for _ in range(rng.randrange(3)):
            text += rng.choice(passages) + words(rng.randrange(0, 30))
        rows.append((i, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [(200, " ".join(["x"] * 100)), (201, " ".join(["y"] * 35)), (202, " ".join(["y", "z"] * 20)), (203, None), (204, ""), (205, " ".join(words(3000, 3)))]
    copy = " ".join(words(90))
    rows += [(206, copy), (206, copy), (None, copy.upper()), (None, " ".join(words(40))), (207, copy + " " + copy)]
    rng.shuffle(rows)
    got = sorted((tuple(r) for r in cut_repeats(spark, docs_of(rows).repartition(7)).collect()), key=str)
    assert got == brute(rows)


def test_empty_table(spark, docs_of):
    assert cut_repeats(spark, docs_of([])).collect() == []
