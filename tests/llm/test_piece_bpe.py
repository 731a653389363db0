import hashlib
import random

import pytest

from ledgerlake.llm import piece_bpe


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_bpe.default_model())


def texts():
    rng = random.Random(5)
    fixed = [None, "", " ", "  ", "   a", "a", "a  b   c", "hello world", "\n\n", "a\nb \n c", "\t tab", "▁under ▁▁ x", "naïve café ßtraße", "日本語のテキスト", "𝔘𝔫𝔦 😀😀", "aaaaaaa", " " * 37 + "x" + " " * 5, "bcbcbcbc ababab", "0123456789 3.14", "é ​ \x00 z", "ation" * 400, "x" * 5000]
    alphabet = "aabbccdeeefghiilmnoorsttu   \n.,éèßñ▁1"
    fixed += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 200))) for _ in range(300)]
    fixed += ["".join(chr(rng.choice([rng.randrange(32, 0x250), rng.randrange(0x3040, 0x30FF), rng.randrange(0x1F600, 0x1F640), 32])) for _ in range(60)) for _ in range(100)]
    fixed += [" " * rng.randrange(20) + "the" + " " * rng.randrange(40) + "\n" * rng.randrange(3) for _ in range(50)]
    return fixed


def test_ids_and_decoded_text_equal_the_library(spark, docs_of, library):
    rows = list(enumerate(texts()))
    df = docs_of(rows).repartition(3)
    got = {r.doc_id: (r.n_tokens, r.ids, r.decoded) for r in piece_bpe.encode(df).collect()}
    for i, t in rows:
        want = library.encode(t or "")
        assert got[i] == (len(want), want, library.decode(want)), repr(t)
    sums = {r.doc_id: r for r in piece_bpe.encode(df, digests=True).collect()}
    for i, t in rows:
        want = library.encode(t or "")
        assert sums[i].ids == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert sums[i].decoded == hashlib.sha256(library.decode(want).encode()).hexdigest()


def test_documents_of_the_smallest_tables(spark, library):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = {r.doc_id: library.encode(r.text or "") for r in df.collect()}
    assert {r.doc_id: r.ids for r in piece_bpe.encode(df).collect()} == want


def test_decode_ids_and_empty_table(spark, docs_of, library):
    v = piece_bpe.read_vocabulary(piece_bpe.default_model())
    for t in texts():
        ids = library.encode(t or "")
        assert piece_bpe.decode_ids(v, ids) == library.decode(ids)
    assert piece_bpe.encode(docs_of([])).collect() == []
