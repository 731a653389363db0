import hashlib
import random

from ledgerlake.llm.exact_dedup import PatriciaTrie, owners, without_copies


def brute(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        g = groups[t or ""]
        keep = max((x for x in g if x is not None), default=None)
        out.append((i, keep, len(g), i == keep, hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def test_owners_match_brute_force(spark, docs_of):
    rng = random.Random(1)
    texts = ["", None, "a", "b", "ab", "ab ", "aé", "long " * 3000, "long " * 2999 + "lonG ", "x"]
    rows = [(i, rng.choice(texts)) for i in range(300)] + [(None, "only null"), (None, "a"), (7, "a"), (7, "a")]
    df = docs_of(rows).repartition(6)
    assert sorted(map(tuple, owners(spark, df).collect()), key=str) == brute(rows)
    kept = without_copies(spark, df)
    assert kept.columns == df.columns
    assert {r.text or "" for r in kept.collect()} == {t or "" for _, t in rows}


def test_empty_table(spark, docs_of):
    assert owners(spark, docs_of([])).collect() == []


def test_trie_keeps_one_terminal_for_each_string():
    rng = random.Random(2)
    trie, seen = PatriciaTrie(), {}
    for _ in range(3000):
        s = bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9)))
        seen.setdefault(s, trie.at(s, lambda: [len(seen)]))
        assert trie.at(s, lambda: 1 / 0) is seen[s]
    assert len({id(x) for x in seen.values()}) == len(seen)
