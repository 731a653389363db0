import random
import zlib

import numpy as np
import pytest
from pyspark.sql import Row

from ledgerlake.llm import packing as P


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.default_model())


def texts():
    rng = random.Random(8)
    fixed = [None, "", " ", "\n\t ", "Hello, World! It's 3.14", "don't'll 're x", "naïve CAFÉ Straße ΑΣ Σ", "日本語。テキスト！", "a b c\x1cd\x85e", "<|endoftext|> a<|startoftext|>b", "é é ﬁ", "\x00\x7f ~", "😀😀 x", "no end " * 3000, "One. " * 4000, "x" * 9000]
    alphabet = "aabcdeehinorst   .,!?'\"-19éßİ\n"
    return fixed + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(400))) for _ in range(120)]


def check(pieces, want, width):
    """Every id in exactly one piece, sequences gapless and within the width."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for i, ids in want.items():
        at = 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.length > 0
            part = ids[at : at + p.length]
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            assert "ids" not in p or p.ids == part
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= width


@pytest.mark.parametrize("width", [4096, 64, 7])
def test_pieces_hold_every_id_of_the_library_once(spark, docs_of, library, width):
    rows = list(enumerate(texts()))
    want = {i: library.encode(t or "", add_special_tokens=False).ids + [2] for i, t in rows}
    check(P.pack(docs_of(rows).repartition(3), width=width, with_ids=True).collect(), want, width)


def test_documents_of_the_smallest_tables(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: library.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    pieces = P.pack(docs)
    check(pieces.collect(), want, P.WIDTH)
    total = P.sequences(pieces).agg({"padding": "sum", "tokens": "sum"}).first()
    assert total["sum(tokens)"] == sum(map(len, want.values()))
    assert total["sum(padding)"] < 0.01 * total["sum(tokens)"]


def brute(at, penalty, width, last, split):
    """Least cost over all cuts before, tried one by one."""
    cost = [0.0] + [None] * (len(at) - 1)
    for j in range(1, len(at)):
        fits = [(cost[i], at[j] - at[i]) for i in range(j) if at[j] - at[i] <= width]
        final = last and j == len(at) - 1
        cost[j] = penalty[j] + min(c + min(P.padding(n, width), split * (n.bit_count() - 1) if final else 1 << 60) for c, n in fits)
    return cost


def paid(edges, at, penalty, width, split):
    price = dict(zip(at, penalty))
    return sum(P.padding(int(n), width) for n in np.diff(edges)) + sum(price.get(int(e), split) for e in edges[1:])


@pytest.mark.parametrize("seed", range(30))
def test_windows_cost_least(seed):
    rng = random.Random(seed)
    width, split = rng.choice([16, 32, 64]), rng.choice([1, 5, 40])
    at = [0]
    for _ in range(rng.randrange(1, 60)):
        at.append(at[-1] + rng.randrange(1, width))
    penalty = [0] + [rng.choice([0, 0, 3, 9]) for _ in at[1:-1]] + [0]
    a, p = np.array(at), np.array(penalty)
    assert P.least_costs(a, p, width)[0] == brute(at, penalty, width, False, split)
    edges = P.windows(a, p, width, True, split)
    assert edges[0] == 0 and edges[-1] == at[-1] and max(np.diff(edges)) <= width
    assert paid(edges, at, penalty, width, split) == brute(at, penalty, width, True, split)[-1]
    edges = P.windows(a, p, width, False, split)
    assert set(edges.tolist()) <= set(at) and at[-1] - edges[-1] <= width


def test_a_run_without_places_to_cut_is_cut_every_width():
    ids = np.full(1000, 7, np.uint32)
    at, penalty = P.cuts_of(ids, np.array([300, 1000]), np.zeros(10, bool), 256, 16, 48)
    assert at.tolist() == [0, 256, 300, 556, 812, 1000] and penalty.tolist() == [0, 48, 0, 48, 48, 0]


def test_long_runs_are_handed_out_in_parts():
    wait = P.Run(np.zeros(100, bool), 5 << 40, 64, 16, 48, True)
    rng = np.random.default_rng(1)
    want, got = {}, []
    for i in range(200):
        ids = rng.integers(3, 90, rng.integers(1, 500)).astype(np.uint32)
        want[i] = ids.tolist()
        wait.add(i, ids)
        if wait.size > 1000:
            got.append(wait.hand_out(False))
            assert wait.size <= 64
    got.append(wait.hand_out(True))
    rows = [Row(**r) for b in got for r in b.to_pylist()]
    check(rows, want, 64)


def test_empty_table_and_repeated_rows(spark, docs_of):
    assert P.pack(docs_of([])).collect() == []
    got = P.pack(docs_of([(None, None), (1, "a b"), (1, "a b")]).coalesce(1)).collect()
    # seven ids as 1 + (3 + 1) + 2: the last window of six is split into powers of two
    assert [(r.doc_id, r.start, r.length, r.doc_tokens) for r in got] == [(None, 0, 1, 1), (1, 0, 3, 3), (1, 0, 1, 3), (1, 1, 2, 3)]
    assert [r.sequence_id for r in got] == [0, 1, 1, 2] and [r.offset for r in got] == [0, 0, 3, 0]
