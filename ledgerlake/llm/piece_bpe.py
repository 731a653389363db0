"""Operator 4: SentencePiece BPE encoding and decoding in vectorised merge rounds.

Texts become flat arrays of symbols.  Each block's distinct words are encoded
once: every round takes the best-ranked pair of each word (segmented minimum),
merges its occurrences from the left at once, compacts the arrays and looks up
only the pairs that changed, until no pair of any word is in the vocabulary.
Merging all occurrences at once equals merging one by one unless a merge makes a
pair that ranks as well or better; a word where it does merges its leftmost pair
only in that round.

Words are runs of spaces and what follows them: no piece holds a space after
another character, so none crosses that edge (checked when the model is read).
Characters without a piece fall back to bytes.  Ids and decoded text equal those
of the sentencepiece library, without begin or end ids.  Null or empty texts have
no ids and decode to the empty text; ids, repeated rows and extra columns don't
matter; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .textblocks import U64, Block, blocks, split_points, word_hashes

SPACE = "▁"
NONE = np.int32(2**31 - 1)
NORMAL, UNKNOWN, BYTE = 1, 2, 6


@dataclass
class Vocabulary:
    """What encoding and decoding look up; its size is the model's."""

    chars: np.ndarray  # code points that are pieces, sorted
    char_ids: np.ndarray
    pairs: np.ndarray  # left id * n + right id, sorted
    ranks: np.ndarray
    merged: np.ndarray
    surface: list[bytes]  # the bytes that an id decodes to
    byte_ids: np.ndarray
    lone: np.ndarray  # ASCII bytes that no longer piece holds

    @property
    def n(self) -> int:
        return len(self.surface)


def read_vocabulary(path: str) -> Vocabulary:
    """Read a BPE model with byte fallback, identity normaliser and dummy prefix."""
    from sentencepiece import sentencepiece_model_pb2 as proto

    model = proto.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    spec = model.normalizer_spec
    pieces = [(p.piece, p.score, p.type) for p in model.pieces]
    if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback or spec.precompiled_charsmap or not spec.add_dummy_prefix or spec.remove_extra_whitespaces:
        raise ValueError("a BPE model with byte fallback and identity normaliser is needed")
    ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == NORMAL}
    if any(SPACE in p.lstrip(SPACE) for p in ids):
        raise ValueError("a piece holds a space after another character")
    # equal scores share a rank: the leftmost pair then goes first
    order = {s: r for r, s in enumerate(sorted({s for _, s, kind in pieces if kind == NORMAL}, reverse=True))}
    rows = [(ids[p[:k]] * len(pieces) + ids[p[k:]], order[pieces[i][1]], i) for p, i in ids.items() for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids]
    pairs, ranks, merged = (np.array(x) for x in zip(*sorted(rows)))
    singles = sorted((ord(p), i) for p, i in ids.items() if len(p) == 1)
    byte_ids = np.zeros(256, np.int32)
    surface = []
    for i, (p, _, kind) in enumerate(pieces):
        if kind == BYTE:
            byte_ids[int(p[3:5], 16)] = i
            surface.append(bytes([int(p[3:5], 16)]))
        else:
            surface.append(p.replace(SPACE, " ").encode() if kind == NORMAL else b" \xe2\x81\x87 " if kind == UNKNOWN else b"")
    used = {c for p in ids if len(p) > 1 for c in p}
    lone = np.zeros(256, bool)
    for c in range(128):
        lone[c] = chr(c) not in used and c != 0x20
    return Vocabulary(np.array([c for c, _ in singles]), np.array([i for _, i in singles], np.int32), pairs, ranks.astype(np.int32), merged.astype(np.int32), surface, byte_ids, lone)


def _ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rank and merged id of each pair; NONE where the vocabulary lacks it or a side has no piece."""
    key = left.astype(np.int64) * v.n + right
    at = np.searchsorted(v.pairs, key)
    at[at == len(v.pairs)] = 0
    ok = (v.pairs[at] == key) & (left >= 0) & (right >= 0)
    return np.where(ok, v.ranks[at], NONE), v.merged[at]


def merge_rounds(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols (ids, or -1 - code point) with their word numbers, ascending -> final symbols, words, in order."""
    done_s, done_w, done_o = [], [], []
    at = np.arange(len(sym))
    rank = np.full(len(sym), NONE)
    made = np.zeros(len(sym), np.int32)
    inside = np.flatnonzero(word[:-1] == word[1:]) if len(sym) else np.zeros(0, np.int64)
    rank[inside], made[inside] = _ranks(v, sym[inside], sym[inside + 1])
    while len(sym):
        cuts = split_points(word)
        sizes = np.diff(cuts)
        best = np.minimum.reduceat(rank, cuts[:-1])
        over = np.repeat(best == NONE, sizes)
        if over.any():
            done_s.append(sym[over])
            done_w.append(word[over])
            done_o.append(at[over])
            sym, word, at, rank, made = (x[~over] for x in (sym, word, at, rank, made))
            best, sizes = best[best != NONE], sizes[best != NONE]
            if not len(sym):
                break
        segment = np.repeat(np.arange(len(sizes)), sizes)
        low = best[segment]
        chosen = rank == low
        # of a run of overlapping pairs, every second one from its left end
        spot = np.arange(len(sym))
        starts = chosen & ~np.concatenate([[False], chosen[:-1]])
        since = spot - np.maximum.accumulate(np.where(starts, spot, 0))
        chosen &= since % 2 == 0
        while True:
            keep = ~np.concatenate([[False], chosen[:-1]])
            s, w, o, r, m, lows, merged = np.where(chosen, made, sym)[keep], word[keep], at[keep], rank[keep], made[keep], low[keep], chosen[keep]
            changed = merged.copy()
            changed[:-1] |= merged[1:]
            spots = np.flatnonzero(changed)
            r[spots] = NONE
            spots = spots[spots < len(s) - 1]
            spots = spots[w[spots] == w[spots + 1]]
            r[spots], m[spots] = _ranks(v, s[spots], s[spots + 1])
            early = segment[keep][spots[r[spots] <= lows[spots]]]
            # one by one, a merged pair also meets its right neighbour before that one merges
            met = np.flatnonzero(chosen[:-2] & chosen[2:])
            met = met[word[met] == word[met + 2]]
            early = np.concatenate([early, segment[met[_ranks(v, made[met], sym[met + 2])[0] <= low[met]]]])
            if len(early):
                several = np.bincount(segment[chosen], minlength=len(sizes)) > 1
                again = np.zeros(len(sizes), bool)
                again[early] = True
                again &= several
                if again.any():
                    first = np.zeros(len(sym), bool)
                    spots = np.flatnonzero(chosen)
                    first[spots[split_points(segment[spots])[:-1]]] = True
                    chosen &= first | ~again[segment]
                    continue
            break
        sym, word, at, rank, made = s, w, o, r, m
    if not done_s:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    s, w, o = (np.concatenate(x) for x in (done_s, done_w, done_o))
    order = np.argsort(o)
    return s[order], w[order], o[order]


def _bytes_of(v: Vocabulary, sym: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols without a piece become the ids of their UTF-8 bytes."""
    bad = np.flatnonzero(sym < 0)
    if not len(bad):
        return sym, word
    raw = (-1 - sym[bad]).astype("<u4").tobytes().decode("utf-32-le").encode()
    data = np.frombuffer(raw, np.uint8)
    lengths = np.diff(np.concatenate([np.flatnonzero((data & 0xC0) != 0x80), [len(data)]]))
    n = np.ones(len(sym), np.int64)
    n[bad] = lengths
    out = np.repeat(sym, n)
    out[out < 0] = v.byte_ids[data]
    return out, np.repeat(word, n)


def _prefixed(b: Block) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets with one space before each text that isn't empty, literal space symbols as spaces."""
    data, offsets = b.data, b.offsets
    raw = data.tobytes()
    if SPACE.encode() in raw:
        texts = [raw[a:z].replace(SPACE.encode(), b" ") for a, z in zip(offsets[:-1], offsets[1:])]
        data = np.frombuffer(b"".join(texts), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in texts])])
    sizes = np.diff(offsets)
    extra = (sizes > 0).astype(np.int64)
    moved = np.concatenate([[0], np.cumsum(sizes + extra)])
    out = np.full(moved[-1], 0x20, np.uint8)
    out[np.arange(len(data)) + np.repeat(np.cumsum(extra), sizes)] = data
    return out, moved


def encode_block(v: Vocabulary, b: Block):
    """ids of the block's distinct words, their offsets, and each document's words as numbers of those."""
    data, offsets = _prefixed(b)
    none = np.zeros(0, np.int64)
    if not len(data):
        return none, np.zeros(1, np.int64), none, np.zeros(b.n + 1, np.int64)
    space, lone = data == 0x20, v.lone[data]
    start = np.zeros(len(data), bool)
    start[1:] = (space[1:] & ~space[:-1]) | lone[1:] | lone[:-1]
    start[offsets[:-1][np.diff(offsets) > 0]] = True
    starts = np.flatnonzero(start)
    ends = np.concatenate([starts[1:], [len(data)]])
    _, first, number = np.unique(word_hashes(data, starts, ends), return_index=True, return_inverse=True)
    sizes = (ends - starts)[first]
    place = np.cumsum(sizes) - sizes
    flat = data[np.arange(sizes.sum()) + np.repeat(starts[first] - place, sizes)]
    word = np.repeat(np.arange(len(first)), sizes)[(flat & 0xC0) != 0x80]
    code = np.frombuffer(flat.tobytes().decode("utf-8").encode("utf-32-le"), "<u4").astype(np.int64)
    code[code == 0x20] = ord(SPACE)
    at = np.searchsorted(v.chars, code)
    at[at == len(v.chars)] = 0
    sym = np.where(v.chars[at] == code, v.char_ids[at], -1 - code)
    sym, word, _ = merge_rounds(v, sym, word)
    ids, word = _bytes_of(v, sym, word)
    count = np.bincount(word, minlength=len(first))
    doc_at = np.searchsorted(starts, offsets)
    return ids, np.concatenate([[0], np.cumsum(count)]), number, doc_at


def decode_ids(v: Vocabulary, ids) -> str:
    """The text of a list of ids: pieces joined, the space that encoding put first taken away."""
    raw = b"".join([v.surface[i] for i in ids])
    first = v.surface[ids[0]][:1] == b" " if len(ids) and ids[0] not in v.byte_ids else False
    return raw[first:].decode("utf-8", "replace")


def _encode(v: Vocabulary, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches, max_bytes=2 << 20):
            ids, at, number, doc_at = encode_block(v, b)
            counts = np.diff(at)
            running = np.concatenate([[0], np.cumsum(counts[number])])
            n_tokens = running[doc_at[1:]] - running[doc_at[:-1]]
            plain = ids.tolist()
            cuts = at.tolist()
            if digests:
                names = [",".join(map(str, plain[a:z])) for a, z in zip(cuts, cuts[1:])]
            surface = v.surface
            texts = [b"".join([surface[i] for i in plain[a:z]]) for a, z in zip(cuts, cuts[1:])]
            words = number.tolist()
            out_ids, out_text = [], []
            for a, z in zip(doc_at[:-1].tolist(), doc_at[1:].tolist()):
                own = words[a:z]
                decoded = b"".join([texts[w] for w in own])[1:]
                if digests:
                    out_ids.append(hashlib.sha256(",".join([names[w] for w in own]).encode()).hexdigest())
                    out_text.append(hashlib.sha256(decoded).hexdigest())
                else:
                    out_ids.append([i for w in own for i in plain[cuts[w] : cuts[w + 1]]])
                    out_text.append(decoded.decode())
            kind = pa.string() if digests else pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n_tokens, pa.int64()), pa.array(out_ids, kind), pa.array(out_text, pa.string())], names=["doc_id", "n_tokens", "ids", "decoded"])

    return run


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode(docs: DataFrame, model: str | None = None, digests: bool = False) -> DataFrame:
    """Every row -> (doc_id, n_tokens, ids, decoded); with ``digests``, ids and text as SHA-256 in hex.

    The model file is read once by the driver and sent with the tasks: its size is the vocabulary's.
    """
    v = read_vocabulary(model or default_model())
    kind = "string" if digests else "array<int>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(_encode(v, digests), f"doc_id long, n_tokens long, ids {kind}, decoded string")


def op4_piece_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode(docs, digests=True).select("doc_id", "n_tokens", F.col("ids").alias("ids_sha256"), F.col("decoded").alias("decoded_sha256"))
