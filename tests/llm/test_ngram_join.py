import random

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import ngram_join
from ledgerlake.llm.ngram_join import BLOB, _alive, _answer, _map_differences, _send, _send_sets, _sets, jaccard_components, one_of_each_group, parity_map

WS = b" \t\n\x0b\x0c\r"


def shingles(text):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low.get(find(k))) for k, (i, _) in enumerate(rows)), key=str)


def result(spark, df):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_components(spark, df).collect()), key=str)


def near(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
    return " ".join(words)


def test_brute_force_with_near_copies_shared_lines_and_edges(spark, docs_of):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(300)]
    base = [[rng.choice(vocab) for _ in range(rng.randrange(30, 120))] for _ in range(12)]
    line = [rng.choice(vocab) for _ in range(20)]
    rows = []
    for i in range(150):
        b = rng.choice(base)
        kind = rng.random()
        text = near(rng, b, rng.randrange(0, 5)) if kind < 0.6 else " ".join(line + [rng.choice(vocab) for _ in range(40)])
        rows.append((i * 7, text))
    rows += [(5000, None), (5001, ""), (5002, " \n\t"), (5003, "One two"), (5004, "one  TWO"), (5005, "one two three"), (None, "one two"), (5006, rows[0][1].upper()), (5003, "One two"), (5003, "other words are here now for sure")]
    rng.shuffle(rows)
    assert result(spark, docs_of(rows).repartition(5)) == brute(rows)


def test_near_groups_in_chunks_with_few_proposals(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "PROPOSE", 1)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    rng = random.Random(9)
    base = [[f"b{k}w{i}" for i in range(70)] for k in range(2)]
    # two groups whose members differ at every rate from nearly equal to unlinked, and a walk away from the first
    rows = [(i, near(rng, base[i % 2], rng.randrange(0, 9))) for i in range(90)]
    walk = list(base[0])
    for i in range(40):
        walk[(7 * i) % 70] = f"y{i}"
        rows.append((200 + i, " ".join(walk)))
    assert result(spark, docs_of(rows).repartition(3)) == brute(rows)


def test_parity_maps_never_differ_in_more_places_than_the_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (3, 20, 120, 130, 3000)]
    sets += [np.unique(np.concatenate([s[: len(s) * 9 // 10], sets[0]])) for s in sets]
    maps = [np.frombuffer(parity_map(s), np.uint64) for s in sets]
    words = np.array([len(m) for m in maps])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    got = _map_differences(np.concatenate(maps), np.cumsum(words) - words, words, i, j)
    assert all(g <= len(np.setxor1d(sets[a], sets[b])) for g, a, b in zip(got, i, j) if max(words[a], words[b]) <= 2 * min(words[a], words[b]))
    assert all(g == 0 for g, a, b in zip(got, i, j) if a == b)


def test_empty_table_and_one_of_each_group(spark, docs_of):
    assert result(spark, docs_of([])) == []
    rows = [(3, "a b c d e f"), (1, "A b c d e f"), (2, "q r s t u v"), (9, None), (8, "")]
    kept = one_of_each_group(spark, docs_of(rows))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 8, 9]
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars", "rk"]


def grouped(table, key):
    return [table.filter(pa.compute.equal(table.column(key), k)) for k in table.column(key).unique()]


@pytest.mark.parametrize("senders", ["lines", "classes"])
def test_more_short_lines_than_sixteen_bits_count(senders):
    rng = random.Random(5)
    shared = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 11))) for _ in range(60_000)]

    def batches(own, first):
        lines = [x for pair in zip(own, shared) for x in pair] + shared[len(own) :]
        for i in range(0, len(lines), 10_000):
            part = lines[i : i + 10_000]
            ids = np.arange(first + i, first + i + len(part))
            yield pa.RecordBatch.from_pydict({"rk": ids, "doc_id": ids, "text": part})

    sent, n = [], {}
    for task in range(2):
        own = [f"own{task}x{k}" for k in range(15_000)]
        at = task * 100_000
        sets = pa.Table.from_batches(list(_sets()(batches(own, at))))
        n |= dict(zip(sets.column("rk").to_pylist(), sets.column("n").to_pylist()))
        if senders == "lines":
            sent += _send(7)(batches(own, at))
        else:
            sent += _send_sets(7)(sets.drop("ck").rename_columns({"rk": "ck"}).to_batches(10_000))
    answers = pa.concat_tables([_answer(x) for x in grouped(pa.Table.from_batches(sent, BLOB), "bucket")])
    got = pa.concat_tables([_alive(x) for x in grouped(answers, "cid")]).to_pylist()
    single = lambda rk: rk % 100_000 < 30_000 and rk % 2 == 0
    assert len(got) == len(n) == 150_000
    assert all((r["n"], r["m"], r["alive"]) == (n[r["rk"]], 0 if single(r["rk"]) else n[r["rk"]], not single(r["rk"])) for r in got)
