"""Operator 1: n-gram Jaccard join under several global token orders.

Documents are sets of five-word shingles; two link at Jaccard >= 3/4.  Plan:

1. *Alive documents.*  A document can only link if at least 3/4 of its shingles
   occur in another document.  Blocks of documents send 6 bytes a shingle to hash
   buckets; a bucket answers with counts of shared shingles per document.
   Shingles met twice in one block are known as shared there and sent on once,
   so a shingle in a third of all documents costs a bucket one entry a block.
2. *Classes.*  Alive documents with equal sets form one class; only one
   representative goes on, and step 1 is repeated among representatives: copies no
   longer count as partners, and m, the shared shingles of a set, bounds every
   overlap that it can have.
3. *Several global orders.*  Order k puts shingles by (frequency if among the
   ``HOT_TOKENS`` most frequent, else 0; hash under seed k).  Any total order is
   valid, so the bound on that table costs no result.  The prefix of a set of n
   shingles holds its n - ceil(3n/4) + 1 first; linked sets share a prefix
   shingle under *each* order.
4. *Stars.*  Each posting list of order 0 pairs its members with one hub, the set
   with the largest share of shared shingles, which in a group of near copies lies
   nearest to their common origin.  The components of the verified links join most
   of a group at the cost of one pair a posting.
5. *Proposals.*  In lists that still hold several components, members meet in
   blocks of at most two ``CHUNK``s, dealt by (list, chunk, chunk), so that no list
   is one task.  A member proposes members of other components if m, the positions
   and parity maps (which never differ in more places than the sets) leave room
   for the overlap: the nearest ``PROPOSE`` of each block.  What comes out is linear
   in the members, not in the pairs.  If a block had more, the components found
   are applied and the step is repeated with four times the number, until no
   block holds anything back: no link between components is lost.
6. *Verification.*  Pairs stay if their prefixes under every further order meet;
   then the full sets are intersected.  Components by label propagation.

Sixty-four-bit hashes stand for shingles.  Null or empty texts have no shingles
and stay alone.  Rows with a null id never name a component; repeated rows are
members like any others.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .tables import bucket_count, discard, fresh, row_key, text_bytes, with_row_key, written
from .textblocks import U64, Block, Lines, blocks, lines_of, mix, shingle_sets, sort_order, split_points

NO_ID = 2**63 - 1
HOT_TOKENS = 32_768
#: Counts from which a shingle can be among them: keeps what a task sends for the ranking small.
HOT_FROM = 8
ORDERS = 3
#: Shingles a mapper holds before it sends them to buckets.
SEND_AT = 1 << 19
#: Units of one send: their numbers, and the one past the last, go as 16 bits.
SEND_UNITS = (1 << 16) - 1
#: Members of a list that meet in one block, about: longer lists are cut in chunks, all pairs of which meet.
CHUNK = 2048
#: Partners that a member proposes in a block at first.
PROPOSE = 64
#: Least and most bits of a parity map, else about four a shingle: bit b is the parity of the number of shingles with hash b.
BITS = (64, 8192)

BLOB = pa.schema([("bucket", pa.int32()), ("cid", pa.int64()), ("tokens", pa.binary()), ("docs", pa.binary()), ("rk", pa.binary()), ("did", pa.binary()), ("n", pa.binary())])
BLOB_SQL = "bucket int, cid long, tokens binary, docs binary, rk binary, did binary, n binary"
SET_SQL = "rk long, doc_id long, line_no long, n int, ck long, tokens binary"
PROFILE_SQL = "rk long, did long, n int, m int, alive boolean"
_SEEDS = [U64(0x9E3779B97F4A7C15 * (2 * k + 1) & (2**64 - 1)) for k in range(8)]


def required(n: int | np.ndarray, m: int | np.ndarray):
    """Least intersection of sets of n and m shingles at Jaccard 3/4: 100 i >= 75 (n + m - i)."""
    return -(-3 * (n + m) // 7)


def prefix_length(n: int | np.ndarray):
    """Length of the prefix of a set of n >= 1 shingles."""
    return n - -(-3 * n // 4) + 1


def slices(batch: pa.RecordBatch, rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A batch of token sets, a few at a time: long sets don't all become numpy arrays at once."""
    for i in range(0, batch.num_rows, rows):
        yield batch.slice(i, rows)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Binary column of 64-bit tokens -> all of them in a row, and how many each cell has."""
    column = column.cast(pa.large_binary())
    if not len(column) or column.buffers()[2] is None:
        return np.zeros(0, U64), np.zeros(len(column), np.int64)
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]].view(U64), np.diff(at) // 8


def _sends(parts: Iterator[tuple], buckets: int) -> Iterator[pa.RecordBatch]:
    """Sends of whole parts (hashes, document numbers ascending, set sizes, row keys, ids), of ``SEND_UNITS`` documents at most."""
    held: list[tuple] = []
    size = units = 0
    for h, d, n, rk, did in parts:
        for i in range(0, len(n), SEND_UNITS):
            own = slice(i, i + SEND_UNITS)
            a, z = np.searchsorted(d, [i, i + SEND_UNITS])
            if held and units + len(n[own]) > SEND_UNITS:
                yield _blobs(held, buckets)
                held, size, units = [], 0, 0
            held.append((h[a:z], d[a:z] - i, n[own], rk[own], did[own]))
            size += z - a
            units += len(n[own])
            if size >= SEND_AT:
                yield _blobs(held, buckets)
                held, size, units = [], 0, 0
    if held:
        yield _blobs(held, buckets)


def _units(b: Block, by_line: bool) -> tuple[Block | Lines, np.ndarray, np.ndarray]:
    """The units of a block with their two keys: documents by (rk, doc_id), or lines by (rk, line number)."""
    if not by_line:
        return b, b.longs("rk"), b.longs("doc_id")
    lines = lines_of(b)
    return lines, b.longs("rk")[lines.doc], lines.line_no


def _send(buckets: int, by_line: bool = False):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for b in blocks(batches):
            units, rk, did = _units(b, by_line)
            yield *shingle_sets(units), rk, did

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sends(parts(batches), buckets)

    return run


def _send_sets(buckets: int):
    """The same from classes: their keys stand for the documents."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch):
                h, n = flat(part.column("tokens"))
                ck = part.column("ck").to_numpy()
                yield h, np.repeat(np.arange(len(n)), n), n, ck, ck

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _sends(parts(batches), buckets)

    return run


def _blobs(held: list[tuple], buckets: int) -> pa.RecordBatch:
    """One row for each bucket that gets shingles, and one that carries the documents themselves."""
    base = np.cumsum([0] + [len(x[2]) for x in held])
    h = np.concatenate([x[0] for x in held])
    d = np.concatenate([x[1] + o for x, o in zip(held, base)]).astype(np.uint32)
    n, rk, did = (np.concatenate([x[k] for x in held]) for k in (2, 3, 4))
    order = sort_order(h)
    cuts = split_points(h[order])
    many = np.zeros(len(h), bool)
    many[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    known = np.bincount(d[many], minlength=len(n)).astype(np.int32)
    # one entry, marked by a document number past the last, for what is shared here already
    first = np.zeros(len(h), bool)
    first[order[cuts[:-1]]] = True
    d = np.where(many, np.uint32(len(n)), d)[first]
    h = h[first]
    bucket = ((h >> U64(34)) % U64(buckets)).astype(np.uint16 if buckets < 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")  # documents stay ascending
    bucket, h, d = bucket[order], h[order].astype(np.uint32), d[order]
    at = split_points(bucket)
    # blocks of the same units in the same order have the same number, all others different ones
    cid = int(mix(mix(rk.astype(U64) ^ mix(did.astype(U64) + _SEEDS[1])) + np.arange(len(rk)).astype(U64)).sum().astype(np.int64))
    rows = [(int(bucket[a]), cid, h[a:z].tobytes(), d[a:z].astype(np.uint16).tobytes(), None, None, None) for a, z in zip(at[:-1], at[1:])]
    rows.append((buckets + cid % buckets, cid, None, known.tobytes(), rk.tobytes(), did.tobytes(), n.astype(np.int32).tobytes()))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), BLOB)], schema=BLOB)


def _answer(table: pa.Table) -> pa.Table:
    """Of one bucket: which documents of each block hold shingles that other blocks sent too."""
    own = table.filter(pa.compute.is_valid(table.column("rk")))
    rest = table.filter(pa.compute.is_null(table.column("rk")))
    if not len(rest):
        return own
    toks = [np.frombuffer(x, np.uint32) for x in rest.column("tokens").to_pylist()]
    docs = np.concatenate([np.frombuffer(x, np.uint16) for x in rest.column("docs").to_pylist()])
    tok = np.concatenate(toks)
    row = np.repeat(np.arange(len(toks)), [len(x) for x in toks])
    order = sort_order(tok)
    cuts = split_points(tok[order])
    many = np.zeros(len(tok), bool)
    many[order] = np.repeat(np.diff(cuts) > 1, np.diff(cuts))
    row, docs = row[many], docs[many]
    cids = rest.column("cid").to_numpy()
    at = split_points(row)
    out = [(int(cids[row[a]]), docs[a:z].tobytes()) for a, z in zip(at[:-1], at[1:])]
    none = pa.nulls(len(out), pa.binary())
    back = pa.table([pa.array([0] * len(out), pa.int32()), pa.array([x[0] for x in out], pa.int64()), none, pa.array([x[1] for x in out], pa.binary()), none, none, none], schema=BLOB)
    return pa.concat_tables([back, own.cast(BLOB)])


def _alive(table: pa.Table) -> pa.Table:
    """Of one block: the keys and n of its units, m shared shingles of each, and whether these are 3/4."""
    outs = []
    own = [x for x in table.to_pylist() if x["rk"] is not None]
    for x in own[:1]:
        n, rk, did = np.frombuffer(x["n"], np.int32), np.frombuffer(x["rk"], np.int64), np.frombuffer(x["did"], np.int64)
        shared = np.frombuffer(x["docs"], np.int32).astype(np.int64)
        # blocks of the same units share their number, and their shingles are all met elsewhere
        hits = [np.frombuffer(y, np.uint16) for y, r in zip(table.column("docs").to_pylist(), table.column("rk").to_pylist()) if r is None]
        if hits:
            got = np.concatenate(hits)
            shared += np.bincount(got[got < len(n)], minlength=len(n))
        if len(own) > 1:
            shared = n.astype(np.int64)
        alive = (n > 0) & (shared >= -(-3 * n // 4))
        outs += [pa.table({"rk": rk, "did": did, "n": n, "m": shared.astype(np.int32), "alive": alive})] * len(own)
    return pa.concat_tables(outs) if outs else pa.table({"rk": pa.array([], pa.int64()), "did": pa.array([], pa.int64()), "n": pa.array([], pa.int32()), "m": pa.array([], pa.int32()), "alive": pa.array([], pa.bool_())})


def _sets(by_line: bool = False):
    """The token sets of documents, or of those lines of theirs that the column ``lines`` names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in blocks(batches):
            units, rk, line_no = _units(b, by_line)
            doc_id = b.longs("doc_id")
            if by_line:
                first = np.searchsorted(units.doc, np.arange(b.n))
                named = np.zeros(units.n, bool)
                for i, x in enumerate(b.column("lines").to_pylist()):
                    named[first[i] + np.array(x, np.int64)] = True
                units, rk, line_no = units.only(named), rk[named], line_no[named]
                doc_id = doc_id[units.doc]
            else:
                line_no = np.zeros(b.n, np.int64)
            h, d, n = shingle_sets(units)
            at = np.concatenate([[0], np.cumsum(n)])
            some = np.flatnonzero(n > 0)
            if not len(some):
                continue
            full = at[some]
            total, odd = np.add.reduceat(mix(h + U64(0xD6E8FEB86659FD93)), full), np.bitwise_xor.reduceat(h, full)
            ck = mix(total ^ mix(odd) ^ n[some].astype(U64)).astype(np.int64)
            tokens = pa.array([h[at[i] : at[i + 1]].tobytes() for i in some], pa.binary())
            yield pa.RecordBatch.from_arrays([rk[some], doc_id[some], line_no[some], n[some].astype(np.int32), ck, tokens], names=["rk", "doc_id", "line_no", "n", "ck", "tokens"])

    return run


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles that occur twice or more in a batch, with counts: enough to rank the frequent ones."""
    held, size = [], 0

    def out(held):
        u, c = np.unique(np.concatenate(held), return_counts=True)
        return pa.RecordBatch.from_pydict({"token": u[c > 1].astype(np.int64), "c": c[c > 1].astype(np.int64)})

    for batch in batches:
        for part in slices(batch):
            held.append(flat(part.column("tokens"))[0])
            size += len(held[-1])
            if size > 1_000_000:
                yield out(held)
                held, size = [], 0
    if held:
        yield out(held)


class Orders:
    """The global orders: frequent shingles last, each group by a seeded hash."""

    def __init__(self, hot: np.ndarray, rank: np.ndarray):
        order = np.argsort(hot)
        self.hot, self.rank = hot[order], rank[order]

    def prefix(self, tokens: np.ndarray, k: int) -> np.ndarray:
        """The prefix of one set under order k, in that order."""
        p = prefix_length(len(tokens))
        key = mix(tokens ^ _SEEDS[k])
        if len(self.hot):
            at = np.minimum(np.searchsorted(self.hot, tokens), len(self.hot) - 1)
            heat = np.where(self.hot[at] == tokens, self.rank[at], 0)
        else:
            heat = np.zeros(len(tokens), np.int64)
        return tokens[np.lexsort((key, heat))[:p]]


def parity_map(tokens: np.ndarray) -> bytes:
    """Bits of a set; maps of half the width are the two halves of this one, combined by exclusive or."""
    width = min(max(BITS[0], 1 << (4 * len(tokens) - 1).bit_length()), BITS[1])
    spots = (mix(tokens ^ _SEEDS[7]) % U64(width)).astype(np.int64)
    return np.packbits((np.bincount(spots, minlength=width) & 1).astype(np.uint8), bitorder="little").tobytes()


def _near(orders: Orders, count: int):
    """Classes with what pairs are judged by: their prefixes under the further orders, each ascending, and parity maps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                sets = [np.frombuffer(x, U64) for x in part.column("tokens").to_pylist()]
                further = [b"".join(np.sort(orders.prefix(x, k)).tobytes() for k in range(1, count)) for x in sets]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(further, pa.binary()), pa.array([parity_map(x) for x in sets], pa.binary())], names=[*part.schema.names, "further", "bits"])

    return run


def _postings(orders: Orders):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                got = [orders.prefix(np.frombuffer(x, U64), 0) for x in part.column("tokens").to_pylist()]
                p = np.array([len(x) for x in got])
                spread = {c: np.repeat(part.column(c).to_numpy(), p) for c in ("ck", "n", "m")}
                yield pa.RecordBatch.from_pydict({"token": np.concatenate(got).astype(np.int64), **spread, "pos": (np.arange(p.sum()) - np.repeat(np.cumsum(p) - p, p)).astype(np.int32)})

    return run


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Common entries of two ascending sets."""
    if len(x) > len(y):
        x, y = y, x
    return int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x)) if len(x) else 0


def _verify(further: int):
    """(x, y) of the pairs that link: prefix filter under the further orders, then the intersection itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                (sa, na), (sb, nb), (fa, ka), (fb, kb) = (flat(part.column(c)) for c in ("sa", "sb", "fa", "fb"))
                need = required(na, nb)
                at = [np.concatenate([[0], np.cumsum(v)]) for v in (na, nb, ka, kb)]
                keep = np.zeros(part.num_rows, bool)
                for i in range(part.num_rows):
                    f, g = fa[at[2][i] : at[2][i + 1]], fb[at[3][i] : at[3][i + 1]]
                    p, q = len(f) // max(1, further), len(g) // max(1, further)
                    if all(_common(f[k * p : k * p + p], g[k * q : k * q + q]) for k in range(further)):
                        keep[i] = _common(sa[at[0][i] : at[0][i + 1]], sb[at[1][i] : at[1][i + 1]]) >= need[i]
                yield part.select(["x", "y"]).filter(pa.array(keep))

    return run


def verified(near: DataFrame, pairs: DataFrame, orders: int = ORDERS) -> DataFrame:
    """(a, b, x, y), classes and what to return -> the distinct (x, y) of pairs that link."""
    own = [near.select(F.col("ck").alias(s), F.col("tokens").alias(f"s{s}"), F.col("further").alias(f"f{s}")) for s in "ab"]
    return pairs.join(own[0], "a").join(own[1], "b").select("x", "y", "sa", "sb", "fa", "fb").mapInArrow(_verify(orders - 1), "x long, y long").distinct()


def _map_differences(flat_bits: np.ndarray, start: np.ndarray, words: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Bits in which the parity maps of rows i and j differ, each pair at the lesser of its two widths."""
    out = np.zeros(len(i), np.int64)
    width = np.minimum(words[i], words[j])
    for w in np.unique(width).tolist():
        of = np.flatnonzero(width == w)
        for a in range(0, len(of), 4096):
            part = of[a : a + 4096]
            x = None
            for rows in (i[part], j[part]):
                for half in range(int((words[rows] // w).max())):
                    here = half < words[rows] // w
                    got = flat_bits[np.where(here, start[rows] + half * w, 0)[:, None] + np.arange(w)] * here[:, None].astype(U64)
                    x = got if x is None else x ^ got
            out[part] = np.bitwise_count(x).sum(1)
    return out


def _propose(limit: int, earlier: bool):
    """Of one bucket of blocks: the nearest ``limit`` partners of each member in each block, and whether it had more."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("token", "ascending"), ("block", "ascending"), ("ck", "ascending")]).combine_chunks()
        token, block, side, ck, n, m, pos, label, doc, line = (table.column(c).to_numpy() for c in ("token", "block", "side", "ck", "n", "m", "pos", "label", "doc", "line"))
        n, m, pos = n.astype(np.int64), m.astype(np.int64), pos.astype(np.int64)
        bits, words = flat(table.column("bits").combine_chunks() if table.num_rows else pa.array([], pa.binary()))
        start = np.cumsum(words) - words
        group = np.cumsum(np.append(True, (token[1:] != token[:-1]) | (block[1:] != block[:-1]))[: len(token)])
        found, size, cut = [], 0, False

        def nearest() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
            nonlocal cut
            p, o, d = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (list(zip(*found)) or [(), (), ()]))
            order = np.lexsort((ck[o], d, p))
            p, o, d = p[order], o[order], d[order]
            cuts = split_points(p)
            place = np.arange(len(p)) - np.repeat(cuts[:-1], np.diff(cuts))
            cut |= bool((place >= limit).any())
            return p[place < limit], o[place < limit], d[place < limit]

        i, step = np.arange(len(ck)), 0
        while len(i):
            step += 1
            i = i[i + step < len(ck)]
            i = i[group[i] == group[i + step]]
            j = i + step
            total = 3 * (n[i] + n[j])
            ok = (label[i] != label[j]) & ((side[i] != side[j]) | (side[i] < 0))
            ok &= (7 * np.minimum(m[i], m[j]) >= total) & (7 * (np.minimum(n[i] - pos[i], n[j] - pos[j]) + np.minimum(pos[i], pos[j])) >= total)
            if not ok.any():
                continue
            p, o = i[ok], j[ok]
            differ = _map_differences(bits, start, words, p, o)
            ok = 7 * differ <= n[p] + n[o]
            p, o, differ = p[ok], o[ok], differ[ok]
            later = (doc[p] > doc[o]) | (doc[p] == doc[o]) & (line[p] > line[o])
            both = ((p, o, later), (o, p, ~later))
            for x, y, is_later in both:
                mine = is_later & (label[x] >= 0) if earlier else np.ones(len(x), bool)
                found.append((x[mine], y[mine], differ[mine]))
                size += int(mine.sum())
            if size > 1_000_000:
                found = [nearest()]
                size = len(found[0][0])
        p, o, _ = nearest()
        a, b = ck[p], ck[o]
        if not earlier:
            p, o = np.where(a < b, p, o), np.where(a < b, o, p)
            a, b = ck[p], ck[o]
        _, first = np.unique(np.stack([a, b]), axis=1, return_index=True) if len(a) else (0, np.zeros(0, np.int64))
        x, y = (a, np.zeros(len(a), np.int64)) if earlier else (label[p], label[o])
        return pa.table({"a": a[first], "b": b[first], "x": x[first], "y": y[first], "cut": np.full(len(first), cut)})

    return run


def proposals(spark: SparkSession, postings: DataFrame, near: DataFrame, tags: DataFrame, limit: int, earlier: bool) -> DataFrame:
    """Pairs (a, b, x, y, cut) of members of one list with different labels that may link.

    ``tags``: (ck, label, doc, line) of every class.  In a list, members of the label
    that most have needn't meet one another: the others, in chunks, meet one another
    and all chunks of those.  ``earlier``: only members with a label from 0 up
    propose, and only partners with a smaller (doc, line).
    """
    tagged = written(spark, postings.select("token", "ck", "pos").join(tags, "ck"), "tagged")
    place = F.struct("doc", "line")
    lists = tagged.groupBy("token", "label").agg(F.count("*").alias("c"), F.min(place).alias("low"), F.max(place).alias("high"))
    lists = lists.groupBy("token").agg(F.sum("c").alias("size"), F.max("c").alias("most"), F.max_by("label", F.struct("c", "label")).alias("top"), F.min("low").alias("low"), F.max(F.when(F.col("label") >= 0, F.col("high"))).alias("high"))
    lists = lists.where("most < size" + (" and high > low" if earlier else ""))
    others, whole = F.col("size") - F.col("most"), F.col("size") <= CHUNK
    lists = lists.select("token", "top", whole.alias("whole"), F.ceil(others / CHUNK).cast("int").alias("k"), F.ceil(F.col("most") / CHUNK).cast("int").alias("many"), "most", others.alias("others"))
    lists = lists.withColumn("rows", F.expr("if(whole, most + others, others * (k + many) + most * k)"))
    lists = written(spark, lists, "lists")
    buckets = bucket_count(spark, lists.agg(F.sum("rows")).first()[0] or 0, 20_000)
    rows = tagged.join(lists, "token").join(near.select("ck", "n", "m", "bits"), "ck")
    # block numbers: 0 for a whole list, else those of two chunks of the others, or of one of them and one of the most
    chunk = F.pmod(F.xxhash64("ck", "token"), F.when(F.col("label") == F.col("top"), F.col("many")).otherwise(F.col("k"))).cast("int")
    rows = rows.withColumn("c", chunk).withColumn("is_top", F.col("label") == F.col("top"))
    among = F.expr("transform(sequence(0, k - 1), j -> struct(cast(1 + least(c, j) as long) * 2147483648 + greatest(c, j) as block, if(j = c, -1, c) as side))")
    across = F.expr("transform(sequence(0, many - 1), j -> struct(-(cast(1 + c as long) * 2147483648 + j) as block, 0 as side))")
    as_top = F.expr("transform(sequence(0, k - 1), j -> struct(-(cast(1 + j as long) * 2147483648 + c) as block, 1 as side))")
    spots = F.when(F.col("whole"), F.expr("array(struct(0L as block, -1 as side))")).when(F.col("is_top"), as_top).otherwise(F.concat(among, across))
    rows = rows.select("token", "ck", "n", "m", "pos", "label", "doc", "line", "bits", F.explode(spots).alias("spot"))
    rows = rows.select("token", F.col("spot.block").alias("block"), F.col("spot.side").alias("side"), "ck", "n", "m", "pos", "label", "doc", "line", "bits")
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("token", "block"), F.lit(buckets)))
    found = rows.groupBy("bucket").applyInArrow(_propose(limit, earlier), "a long, b long, x long, y long, cut boolean")
    found = written(spark, found, "proposed")
    discard(spark, tagged, lists)
    return found


def near_sets(spark: SparkSession, keyed: DataFrame, by_line: bool = False, count: int = ORDERS) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(rk, doc_id, text), rk deciding doc_id and text -> profile, members, near classes, and their postings.

    profile: (rk, did, n, m, alive) of every unit, did being the line number or doc_id;
    members: (rk, doc_id, line_no, ck) of alive units; near: (ck, n, m, tokens, further,
    bits) of classes that may link; postings of their prefixes under order 0.  ``count``:
    the orders under which prefixes are kept.
    """
    buckets = bucket_count(spark, text_bytes(keyed))
    blobs = keyed.mapInArrow(_send(buckets, by_line), BLOB_SQL)
    answers = written(spark, blobs.groupBy("bucket").applyInArrow(_answer, BLOB_SQL).drop("bucket", "tokens"), "answers")
    profile = answers.groupBy("cid").applyInArrow(_alive, PROFILE_SQL)
    profile = written(spark, profile.where("alive") if by_line else profile, "profile")
    discard(spark, answers)
    alive = profile.where("alive")
    if by_line:
        alive = alive.groupBy("rk").agg(F.collect_set("did").alias("lines"))
        chosen = keyed.join(alive, "rk").select("rk", "doc_id", "text", "lines")
    else:
        chosen = keyed.join(alive.select("rk").distinct(), "rk", "left_semi").select("rk", "doc_id", "text")
    sets = written(spark, chosen.mapInArrow(_sets(by_line), SET_SQL), "sets")
    members = written(spark, sets.select("rk", "doc_id", "line_no", "ck").distinct(), "members")
    classes = written(spark, sets.groupBy("ck").agg(F.first("tokens").alias("tokens")), "classes")
    discard(spark, sets)
    answers = classes.mapInArrow(_send_sets(buckets), BLOB_SQL).groupBy("bucket").applyInArrow(_answer, BLOB_SQL).drop("bucket", "tokens")
    answers = written(spark, answers, "answers")
    partners = answers.groupBy("cid").applyInArrow(_alive, PROFILE_SQL).where("alive").select(F.col("rk").alias("ck"), "n", "m").distinct()
    near = written(spark, classes.join(partners, "ck").select("ck", "n", "m", "tokens"), "near")
    discard(spark, answers, classes)
    hot = near.select("tokens").mapInArrow(_counts, "token long, c long").groupBy("token").agg(F.sum("c").alias("c")).where(F.col("c") >= HOT_FROM).orderBy(F.desc("c"), "token").limit(HOT_TOKENS).toPandas()
    orders = Orders(hot["token"].to_numpy(np.int64).astype(U64), hot["c"].to_numpy(np.int64))
    postings = written(spark, near.mapInArrow(_postings(orders), "token long, ck long, n int, m int, pos int"), "postings")
    judged = written(spark, near.mapInArrow(_near(orders, count), "ck long, n int, m int, tokens binary, further binary, bits binary"), "judged")
    discard(spark, near)
    return profile, members, judged, postings


SIZE_OK = "7 * least(m, hub.m) >= 3 * (n + hub.n)"


def nearest_origin() -> F.Column:
    """Rank of a list's members whose least is the hub: the largest share of shared shingles."""
    return F.struct((-F.col("m") / F.col("n")).alias("first"), F.xxhash64("ck").alias("then"), "ck", "n", "m")


def until_whole(step: Callable[[int], DataFrame], apply: Callable[[DataFrame], None], spark: SparkSession) -> None:
    """Proposals with a growing limit, until no block holds any back."""
    limit = PROPOSE
    while True:
        found = step(limit)
        apply(found.select("a", "b", "x", "y").distinct())
        held_back = found.where("cut").limit(1).count()
        discard(spark, found)
        if not held_back:
            return
        limit *= 4


def connected(spark: SparkSession, near: DataFrame, postings: DataFrame) -> DataFrame:
    """(ck, label) of the near classes that link with another, classes of one label being one component."""
    hubs = postings.groupBy("token").agg(F.min(nearest_origin()).alias("hub"), F.count("*").alias("size")).where("size > 1").select("token", "hub")
    star = postings.join(hubs, "token").where(f"ck <> hub.ck and {SIZE_OK}").select(F.col("ck").alias("a"), F.col("hub.ck").alias("b")).distinct()
    label = components(spark, verified(near, star.withColumns({"x": F.col("a"), "y": F.col("b")})).toDF("a", "b")).withColumnRenamed("node", "ck")
    holder = [written(spark, label, "stars")]

    def step(limit: int) -> DataFrame:
        tags = near.select("ck").join(holder[-1], "ck", "left").select("ck", F.coalesce("label", "ck").alias("label"), F.lit(0).cast("long").alias("doc"), F.lit(0).cast("long").alias("line"))
        return proposals(spark, postings, near, tags, limit, earlier=False)

    def apply(pairs: DataFrame) -> None:
        whole = components(spark, verified(near, pairs).toDF("a", "b")).withColumnRenamed("node", "star").withColumnRenamed("label", "whole")
        tags = near.select("ck").join(holder[-1], "ck", "left").select("ck", F.coalesce("label", "ck").alias("star"))
        holder.append(written(spark, tags.join(whole, "star", "left").select("ck", F.coalesce("whole", "star").alias("label")), "stars"))

    until_whole(step, apply, spark)
    discard(spark, *holder[:-1])
    return holder[-1]


def jaccard_components(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` -> (rk, doc_id, n_shingles, component_id); see the module's text for the cases."""
    keyed = with_row_key(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NO_ID)))
    profile, members, near, postings = near_sets(spark, keyed)
    label = connected(spark, near, postings)
    discard(spark, near, postings)
    # the smallest id of each class first: a class may hold a third of all rows
    lowest = members.groupBy("ck").agg(F.min("doc_id").alias("low")).join(label, "ck", "left").withColumn("label", F.coalesce("label", "ck"))
    lowest = lowest.select("ck", "label", "low")
    whole = lowest.groupBy("label").agg(F.min("low").alias("least"))
    lowest = written(spark, lowest.join(whole, "label").select("ck", "least"), "lowest")
    groups = members.join(lowest, "ck").select("rk", "least")
    found = F.coalesce("least", "doc_id")
    rows = profile.select("rk", F.col("did").alias("doc_id"), F.col("n").cast("long").alias("n_shingles")).join(groups, "rk", "left")
    return rows.select("rk", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")).alias("doc_id"), "n_shingles", F.when(found != NO_ID, found).alias("component_id"))


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(spark, docs).select("doc_id", "n_shingles", "component_id")


def one_of_each_group(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose component is their own id (one of each group stays); all columns kept.

    Rows without an id go if a row with one is in their group; null and empty texts stay;
    repeated rows share their fate; an empty table gives no rows.
    """
    found = jaccard_components(spark, docs)
    # rows alone in their component stay whatever their id; in a group the smallest id stays
    key = fresh(docs, "row_key")
    drop = found.where("component_id is null and doc_id is not null or component_id <> doc_id or doc_id is null and component_id is not null").select(F.col("rk").alias(key)).distinct()
    return docs.withColumn(key, row_key(docs)).join(drop, key, "left_anti").drop(key)


OP1_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT rid, array_to_string(w[p : least(p + 4, len(w))], ' ') AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(2, len(w) - 3))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT rid, count(*) AS n FROM s GROUP BY rid),
i AS (SELECT x.rid AS a, y.rid AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.rid <> y.rid GROUP BY 1, 2),
links AS (SELECT a, b FROM i JOIN n p ON p.rid = a JOIN n q ON q.rid = b WHERE 100 * i >= 75 * (p.n + q.n - i)),
reach(a, b) AS (SELECT rid, rid FROM d UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
low AS (SELECT a AS rid, min(doc_id) AS component_id FROM reach JOIN d ON d.rid = b GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, low.component_id
FROM d LEFT JOIN n USING (rid) JOIN low USING (rid)
"""
