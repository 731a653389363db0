import random

from ledgerlake.llm import ngram_join
from ledgerlake.llm.line_dedup import removed_lines, without_later_lines
from tests.llm.test_ngram_join import shingles


def brute(rows):
    lines = [(10**9 if i is None else i, k, shingles(x)) for i, t in sorted(set(rows), key=str) if t is not None for k, x in enumerate(t.split("\n"))]
    gone = {}
    for i, n, s in lines:
        if s and any((j, k) < (i, n) and t and 100 * len(s & t) >= 75 * len(s | t) for j, k, t in lines):
            gone.setdefault(i, []).append(n)
    return sorted(((i, len(t.split("\n")) if t is not None else 0, sorted(gone.get(10**9 if i is None else i, []))) for i, t in rows), key=str)


def test_a_line_that_only_later_lines_match_stays(spark, docs_of):
    words = [f"w{i}" for i in range(60)]
    near = lambda at: " ".join("changed" if i == at else w for i, w in enumerate(words))
    a, b, c = " ".join(words), near(20), near(40)
    got = {r.doc_id: r.removed for r in removed_lines(spark, docs_of([(1, b), (2, c), (3, a)])).collect()}
    assert 100 * len(shingles(b) & shingles(c)) < 75 * len(shingles(b) | shingles(c))
    assert got == {1: [], 2: [], 3: [0]}


def test_many_near_lines_are_held_back_and_come_again(spark, docs_of, monkeypatch):
    monkeypatch.setattr(ngram_join, "PROPOSE", 1)
    monkeypatch.setattr(ngram_join, "CHUNK", 8)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(40)]
    rows = []
    for i in range(60):
        words = list(base)
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(40)] = f"x{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    got = sorted(((r.doc_id, r.n_lines, r.removed) for r in removed_lines(spark, docs_of(rows)).collect()), key=str)
    assert got == brute(rows)


def test_removed_lines_match_brute_force(spark, docs_of):
    rng = random.Random(11)
    say = lambda n: [f"w{rng.randrange(200)}" for _ in range(n)]
    base = [say(rng.randrange(1, 40)) for _ in range(12)]
    rows = []
    for i in range(50):
        lines = []
        for _ in range(rng.randrange(0, 6)):
            words = list(rng.choice(base)) if rng.random() < 0.7 else say(20)
            if len(words) > 25 and rng.random() < 0.5:
                words[-1] = "changed"
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    rows += [(90, None), (91, ""), (92, "\n\n"), (93, " ".join(base[0])), (93, " ".join(base[0])), (None, " ".join(base[1]) + "\nunique line here now"), (94, "x y\nX  y\n x Y")]
    df = docs_of(rows)
    got = sorted(((r.doc_id, r.n_lines, r.removed) for r in removed_lines(spark, df).collect()), key=str)
    assert got == brute(rows)
    cut = without_later_lines(spark, df)
    assert cut.columns == df.columns
    by = {r.doc_id: r.text for r in cut.collect()}
    assert by[94] == "x y" and by[90] is None


def test_empty_table(spark, docs_of):
    assert removed_lines(spark, docs_of([])).collect() == []
