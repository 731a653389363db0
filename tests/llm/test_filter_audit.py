import random
import re
from collections import Counter
from itertools import permutations

import numpy as np

from ledgerlake.llm.filter_audit import audit, audit_tensor


def fails(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    out = "A" if len(words) < 50 else ""
    out += "B" if 100 * len(set(words)) < 65 * len(words) else ""
    out += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
    return out + ("D" if re.search("[#$%&*|]", text) else "")


def brute(rows, labels):
    """Each order applied to the documents of each part, one filter after the other."""
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, t in labels if i is not None and t == 1}
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    docs = [(p or "", i, fails(t or "") + ("E" if i is not None and i > first[t or ""] else "")) for i, t, p in rows]
    out, total = {}, Counter()
    for part in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == part]
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, k in enumerate(order, 1):
                gone = [d for d in left if k in d[2]]
                left = [d for d in left if k not in d[2]]
                out[part, order, step] = (
                    len(left), len(gone), sum(k in d[2] for d in own) - len(gone), sum(d[2] == k for d in own), sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone)
                )
                total[part, k] += len(gone)
    return {(p, o, s): (*v, total[p, o[s - 1]]) for (p, o, s), v in out.items()}


def check(spark, rows, labels):
    docs = spark.createDataFrame([(i, t, "en", s, 0, "x", 3) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars int, part string, bits int").repartition(5)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in audit(spark, docs, known).collect()}
    assert got == brute(rows, labels)


def test_every_step_of_every_order_equals_filtering_one_by_one(spark):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(200)]

    def text():
        n = rng.choice([0, 3, 49, 50, 51, 80])
        words = [rng.choice(vocabulary[: rng.choice([5, 40, 200])]) for _ in range(n)]
        if words and rng.random() < 0.4:
            words[0] = rng.choice(["SHOUT" * 6, "a#b", "100%", "É", "x|y"])
        return rng.choice([" ", "\n", "\t  "]).join(words)

    texts = [text() for _ in range(40)] + [None, "", "x " * 3000, "é b"]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", None, ""])) for i in range(400)]
    rows += [(None, texts[3], "a"), (None, texts[3], "c"), (5, "same", "a"), (5, "same", "b"), (5, "same", "b"), (9, "same", "b"), (1, "same", "c")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 400, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1), (9999, 1, 1)]
    check(spark, rows, labels)


def test_one_hot_text_and_no_labels(spark):
    check(spark, [(i, "copy " * 60, "hot" if i % 3 else "b") for i in range(300)], [])


def test_empty_table(spark):
    check(spark, [], [])


def test_fewer_filters():
    tensor = np.array([[[[5, 1], [2, 4]], [[0, 0], [0, 1]], [[0, 0], [0, 0]]]])  # passes both, fails B; fails A, fails both
    got = audit_tensor(tensor)  # orders AB, BA
    assert got["kept"].tolist() == [[6, 5, 7, 5]]
    assert got["removed"].tolist() == [[6, 1, 5, 2]]
    assert got["redundant"].tolist() == [[0, 4, 0, 4]]
    assert got["unique_fails"].tolist() == [[2, 1, 1, 2]]
    assert got["good_lost"].tolist() == [[1, 0, 1, 0]]
    assert got["shapley"].tolist() == [[8, 6, 6, 8]]
