"""Operator 7: personal data by a semi-Markov conditional random field.

*Base.*  Four kinds by fixed patterns and checks: e-mail, address, card, phone.

*Method.*  Around words that could be data (a digit or ``@``) a text has regions
of words, however many follow one another.  Candidate segments are runs of whole
words, of each kind up to ``SPAN_WORDS``; words end at spaces, quotes, colons and
``=``.  Features describe the whole span (digits, parts, checks, shape, length,
kinds of characters, what the words before it announce).  A semi-Markov CRF scores every segmentation of a region; a Viterbi
search over bounded segments chooses boundaries and kinds together.  It is
trained by likelihood (forward and backward sums over segmentations) on regions
of a bounded sample (of a region its first ``TRAIN_WORDS`` words, up to
``TRAIN_LENGTH`` characters; the search has no such bounds), whose silver labels are the base patterns and long
hexadecimal strings after a cue (kind ``secret``), and on a fixed number of generated
texts whose labels no pattern gives: secrets, phones and account numbers in other
formats, and digests, ids and numbers that are none.  Its spans are added where
they touch no base span; base spans always stay.

All places are code points of the whole text.  Null texts have no spans; repeated
rows are searched each; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import generated_spans
from .textblocks import blocks

KINDS = ["email", "ip", "card", "phone", "secret", "iban"]
#: Words of a span at most, by kind (an account number of 34 characters in groups of four has nine).
SPAN_WORDS = {"email": 1, "ip": 1, "card": 5, "phone": 5, "secret": 1, "iban": 9}
MAX_WORDS = max(SPAN_WORDS.values())
#: Regions the model is fitted on, and documents they come from, at most (about).
TRAIN_REGIONS, TRAIN_DOCS = 400, 3000
#: Words and characters of a region that the model is fitted on.
TRAIN_WORDS, TRAIN_LENGTH = 16, 2000
EPOCHS, RATE, RIDGE = 6, 0.2, 1e-4

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_PARTS = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\s=:\"'<>]+")
_MAYBE = re.compile(r"[0-9@]")
_HEX = re.compile(r"[0-9a-f]{24,}")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}")
_IBAN_START = re.compile(r"[A-Z]{2}[0-9]{2}")
_BEFORE = re.compile(r"[^\W\d_]+")
#: Words that announce a kind of value, and how far before a span they are looked for.
_CUES = {
    **dict.fromkeys("token key apikey secret password passwd pwd auth bearer credential credentials passphrase kennwort passwort contraseña".split(), "secret"),
    **dict.fromkeys("commit sha md digest hash checksum revision rev blob tree object etag uuid build checkout".split(), "hash"),
    **dict.fromkeys("tel phone call mobile fax telefon telefono teléfono téléphone whatsapp ring handy".split(), "phone"),
    **dict.fromkeys("iban account konto bank cuenta compte transfer".split(), "account"),
}
CUE_REACH = 40
_EDGE = ".,;:!?\"'()[]#$%&*|"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Spans of the four kinds; within a kind leftmost and not overlapping, failed matches consumed."""
    out = []
    end, k = 0, text.find("@")
    while k >= 0:
        a = k
        while a > end and text[a - 1] in _LOCAL:
            a -= 1
        m = _DOMAIN.match(text, k + 1) if a < k else None
        if m:
            out.append(("email", a, m.end()))
            end = m.end()
        k = text.find("@", max(k + 1, end))
    for m in _PARTS.finditer(text):
        if m.group().count(".") >= 3:
            # a run of parts is matched four at a time, from its left
            at, parts = m.start(), m.group().split(".")
            for i in range(0, len(parts) - 3, 4):
                four = parts[i : i + 4]
                size = sum(map(len, four)) + 3
                if all(len(p.lstrip("0")) <= 3 and int(p[-4:] or 0) <= 255 for p in four):
                    out.append(("ip", at, at + size))
                at += size + 1
    for m in _CARD.finditer(text):
        d = _digits(m.group())
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_digits(m.group())) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def regions(text: str) -> list[list[tuple[int, int]]]:
    """Words around those with a digit or ``@``: a word before, a word after, close ones joined; places without edge marks."""
    out: list[list[tuple[int, int]]] = []
    last = None
    previous: tuple[int, int] | None = None
    after = 0
    for m in _WORD.finditer(text):
        a, z = m.span()
        while a < z and text[a] in _EDGE:
            a += 1
        while z > a and text[z - 1] in _EDGE:
            z -= 1
        here = (a, z) if a < z else m.span()
        if _MAYBE.search(m.group()):
            if last is None:
                last = [previous] if previous else []
                out.append(last)
            last.append(here)
            after = 1
        elif after:
            last.append(here)
            after -= 1
        else:
            last = None
        previous = here
    return out


def cues(text: str, a: int) -> tuple[str, str]:
    """What the word before place ``a`` announces, and the nearest announcement among the three words before."""
    last = [_CUES.get(w, "") for w in _BEFORE.findall(text[max(0, a - CUE_REACH) : a].lower())[-3:]][::-1]
    return (last[0] if last else ""), next(filter(None, last), "")


def account_ok(s: str) -> bool:
    """An account number of international form whose remainder modulo 97 is 1."""
    code = s.replace(" ", "")
    return bool(_IBAN.fullmatch(code)) and int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def span_features(text: str, words: list[tuple[int, int]], i: int, j: int) -> list[str]:
    """Features of the segment of words i..j-1 as a whole."""
    a, z = words[i][0], words[j - 1][1]
    s = text[a:z]
    d = _digits(s)
    letters = sum(c.isalpha() for c in s)
    parts = s.split(".")
    near, far = cues(text, a)
    upper, lower = any(c.isupper() for c in s), any(c.islower() for c in s)
    mix = f"{'U' * upper}{'l' * lower}{'9' * bool(d)}{'p' * any(not c.isalnum() for c in s)}"
    is_hex = bool(_HEX.fullmatch(s.lower()))
    size = min(len(d), 20)
    return [
        f"words={j - i}",
        f"digits={size}",
        f"share={10 * len(d) // max(1, len(s))}",
        f"letters={min(letters, 3)}",
        f"at={s.count('@') == 1 and '.' in s.split('@')[-1]}",
        f"parts={len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) < 4 and int(p) < 256 for p in parts)}",
        f"luhn={13 <= len(d) <= 19 and letters == 0 and luhn(d)}",
        f"plus={s[0] == '+'}",
        f"phone={s[0] == '+' and 9 <= len(d) <= 15 and letters == 0}",
        f"hex={is_hex}",
        f"iban={account_ok(s)}",
        f"known={s.startswith(('AKIA', 'ghp_', 'sk-', 'xox')) and len(s) >= 16}",
        f"mix={mix}",
        f"size={min(len(s) // 4, 10)}",
        f"near={near}",
        f"far={far}",
        f"near,mix={near},{mix}",
        f"far,hex={far},{is_hex}",
        f"far,mix={far},{mix}",
        f"far,digits={far},{size if letters == 0 else -1}",
        f"shape={re.sub('[0-9]+', '9', re.sub('[^0-9@.+()-]+', 'x', s))[:12]}",
    ]


class SemiCrf:
    """Weights of (feature, kind); kind None is a plain word outside any span, always one word long."""

    def __init__(self):
        self.w: dict[tuple[str, str], float] = defaultdict(float)

    def ending(self, text: str, words: list[tuple[int, int]], j: int) -> list[tuple]:
        """Segments that end before word j: (start, kind, features), the longest first."""
        out: list[list[tuple]] = []
        for i in range(j - 1, max(-1, j - 1 - MAX_WORDS), -1):
            if i < j - 1 and words[i + 1][0] - words[i][1] > 2:
                break
            own = [None] if i == j - 1 else []
            if _MAYBE.search(text, words[i][0], words[j - 1][1]):
                own += [k for k in KINDS if j - i <= SPAN_WORDS[k] and (k != "iban" or _IBAN_START.match(text, words[i][0]))]
            f = span_features(text, words, i, j) if own else []
            out.append([(i, kind, f) for kind in own])
        return [x for own in reversed(out) for x in own]

    def segments(self, text: str, words: list[tuple[int, int]]) -> list[list[tuple]]:
        """All segments of a region, by end."""
        return [self.ending(text, words, j) if j else [] for j in range(len(words) + 1)]

    def value(self, kind, f) -> float:
        w = self.w
        return sum(w.get((x, kind), 0.0) for x in f)

    def best(self, text: str, words: list[tuple[int, int]]) -> list[tuple[str, int, int]]:
        """The best segmentation's spans in code points; only its back pointers are kept, however long the region."""
        score, back = [0.0] + [-1e30] * len(words), [None] * (len(words) + 1)
        for j in range(1, len(words) + 1):
            for i, kind, f in self.ending(text, words, j):
                v = score[i] + self.value(kind, f)
                if v > score[j]:
                    score[j], back[j] = v, (i, kind)
        out, j = [], len(words)
        while j > 0:
            i, kind = back[j]
            if kind:
                out.append((kind, words[i][0], words[j - 1][1]))
            j = i
        return out[::-1]

    def fit(self, data: list[tuple[str, list, list]]) -> SemiCrf:
        """Likelihood ascent, one region after another, in the order given."""
        prepared = [(self.segments(t, w), {(i, j): k for k, i, j in gold}, len(w)) for t, w, gold in data]
        for epoch in range(EPOCHS):
            rate = RATE / (1 + epoch)
            for table, gold, n in prepared:
                flat = [[(i, kind, f, self.value(kind, f)) for i, kind, f in table[j]] for j in range(n + 1)]
                ahead = np.full(n + 1, -np.inf)
                ahead[0] = 0
                for j in range(1, n + 1):
                    ahead[j] = np.logaddexp.reduce([ahead[i] + v for i, _, _, v in flat[j]])
                behind = np.full(n + 1, -np.inf)
                behind[n] = 0
                for j in range(n, 0, -1):
                    for i, _, _, v in flat[j]:
                        behind[i] = np.logaddexp(behind[i], behind[j] + v)
                inside = {k for i, j in gold for k in range(i, j)}
                for j in range(1, n + 1):
                    for i, kind, f, v in flat[j]:
                        p = np.exp(ahead[i] + v + behind[j] - ahead[n])
                        true = gold.get((i, j)) == kind if (i, j) in gold else kind is None and i not in inside
                        g = rate * (float(true) - p)
                        if abs(g) > 1e-4:
                            for x in f:
                                self.w[x, kind] += g - rate * RIDGE * self.w[x, kind]
        return self


def silver(text: str) -> list[tuple[str, int, int]]:
    """Labels of the training regions: base spans, and long hexadecimal strings after a cue."""
    spans = base_spans(text)
    for m in _HEX.finditer(text):
        before = text[max(0, m.start() - 16) : m.start()].lower()
        if any(c in before for c in ("token", "key", "secret", "password")) and not any(a < m.end() and m.start() < z for _, a, z in spans):
            spans.append(("secret", m.start(), m.end()))
    return spans


def training_regions(text: str, labels: list[tuple[str, int, int]] | None = None) -> list[tuple[str, list, list]]:
    """(text, words, (kind, first, end)) of the regions of a text, with silver labels where none are given."""
    spans = {(a, z): k for k, a, z in (silver(text) if labels is None else labels)}
    out = []
    for words in regions(text):
        gold = []
        for i in range(len(words)):
            for j in range(i + 1, min(len(words), i + MAX_WORDS) + 1):
                if kind := spans.get((words[i][0], words[j - 1][1])):
                    gold.append((kind, i, j))
        words = words[:TRAIN_WORDS]
        lo, hi = max(0, words[0][0] - CUE_REACH), words[-1][1]
        out.append((text[lo:hi], [(a - lo, z - lo) for a, z in words], [g for g in gold if g[2] <= len(words)]))
    return out


def _sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [r for t in batch.column("text").to_pylist() for r in training_regions(t or "") if len(r[0]) <= TRAIN_LENGTH]
        yield pa.RecordBatch.from_pydict({"text": pa.array([r[0] for r in got], pa.string()), "words": pa.array([[x for w in r[1] for x in w] for r in got], pa.list_(pa.int32())), "kinds": pa.array([[k for k, _, _ in r[2]] for r in got], pa.list_(pa.string())), "ends": pa.array([[x for _, i, j in r[2] for x in (i, j)] for r in got], pa.list_(pa.int32()))})


def fit(docs: DataFrame) -> SemiCrf:
    """The model, from about ``TRAIN_REGIONS`` regions of about ``TRAIN_DOCS`` documents, chosen by hash."""
    texts = docs.select(F.col("text").cast("string").alias("text")).where("text is not null")
    n = max(1, texts.count())
    few = texts.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < int(min(1.0, TRAIN_DOCS / n) * (1 << 30))).dropDuplicates(["text"])
    found = few.mapInArrow(_sampled, "text string, words array<int>, kinds array<string>, ends array<int>")
    # half of them hold a span, so that each kind is seen
    rows = found.withColumn("full", F.size("kinds") > 0).orderBy(F.desc("full"), F.xxhash64("text")).limit(TRAIN_REGIONS * 3 // 4).collect()
    rows += found.where("size(kinds) = 0").orderBy(F.xxhash64("text")).limit(TRAIN_REGIONS // 4).collect()
    pairs = lambda x: list(zip(x[::2], x[1::2]))
    data = [(r.text, pairs(r.words), [(k, i, j) for k, (i, j) in zip(r.kinds, pairs(r.ends))]) for r in rows]
    data += [r for text, labels in generated_spans.examples() for r in training_regions(text, labels)]
    order = sorted(range(len(data)), key=lambda k: hashlib.sha256(data[k][0].encode()).digest())
    return SemiCrf().fit([data[k] for k in order])


def find(text: str, model: SemiCrf) -> tuple[list, list]:
    """Base spans, and all spans, both by kind as listed and then by start."""
    if not _MAYBE.search(text):
        return [], []
    rank = {k: n for n, k in enumerate(KINDS)}
    order = lambda s: (rank[s[0]], s[1], s[2])
    base = sorted(base_spans(text), key=order)
    taken = sorted((a, z) for _, a, z in base)
    added = []
    for words in regions(text):
        for kind, a, z in model.best(text, words):
            added.append((kind, a, z))
    added.sort(key=lambda s: s[1])
    out, k, reach = list(base), 0, 0
    for kind, a, z in added:
        while k < len(taken) and taken[k][0] <= a:
            reach = max(reach, taken[k][1])
            k += 1
        if reach <= a and not (k < len(taken) and taken[k][0] < z):
            out.append((kind, a, z))
    return base, sorted(set(out), key=order)


def _search(model: SemiCrf):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maybe = np.zeros(256, bool)
        maybe[48:58] = maybe[64] = True
        name = lambda spans: ",".join(f"{k}:{a}:{z}" for k, a, z in spans)
        empty = hashlib.sha256(b"").hexdigest()
        for b in blocks(batches):
            running = np.concatenate([[0], np.cumsum(maybe[b.data])])
            some = running[b.offsets[1:]] > running[b.offsets[:-1]]
            texts = b.column("text")
            counts = np.zeros((4, b.n), np.int64)
            sums, spans = [empty] * b.n, [""] * b.n
            for i in np.flatnonzero(some).tolist():
                base, found = find(texts[i].as_py(), model)
                for k, _, _ in base:
                    counts[KINDS.index(k), i] += 1
                sums[i] = hashlib.sha256(name(base).encode()).hexdigest()
                spans[i] = name(found)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c) for c in counts], pa.array(sums), pa.array(spans)], names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    return run


def search(docs: DataFrame, model: SemiCrf) -> DataFrame:
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_search(model), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return search(docs, fit(docs))
