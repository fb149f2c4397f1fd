"""Secret scan: fixed patterns and a battery of randomness tests.

Base patterns (kinds in order): ``assign``, a password-like name with a value
of 6 characters or more; ``access``, AKIA and capitals or digits, 20 characters
or more in all; ``hex``, 24 or more of 0-9a-f. Matches are leftmost and do not
overlap within a kind; those too short are dropped after matching.

The battery adds ``random`` spans. Every run of 20 or more characters of a
text encoding is a candidate. Its encoding is the smallest alphabet that holds
all its characters (decimal, hex, base 32, base 36, base 62, base 64 and its
URL form). Three tests ask whether its symbols are random in that alphabet:
chi-squared of the counts against uniform, the number of runs above and below
the alphabet's middle, and the serial correlation of neighbours. Fisher's
method combines their p-values to one randomness score.

Whether a score is remarkable depends on length: the shorter, the easier
ordinary text passes for random. So the false-discovery control works per
length class. The null distribution of a class comes from the corpus: the
letters and digits of every text, cut into pieces of the lengths of the
classes, go through the same battery. A candidate's p-value is the share of
such pieces that score as high, and the Benjamini-Hochberg rule at rate ``q``,
over all candidates of the class in the corpus, sets the class's limit; nor
may the tests reject randomness itself at level ALPHA. Both distributions are histograms of a fixed number of bins, summed by Spark.

Spans are (kind, start, end) in code points, end exclusive, ordered by start,
then kind as listed. A random span that overlaps a base span is not added.
Null text is empty; empty text has no spans. Repeated rows each give a row; an
empty table gives an empty result. Columns other than id and text are ignored.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, lean, texts, with_id

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
NAMES = (b"passw", b"secret", b"token", b"api")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
HEX = re.compile(rb"[0-9a-f]{24,}")  # a maximal run, as [0-9a-f]+ would match
CANDIDATE = re.compile(rb"[A-Za-z0-9+/_-]{20,}")
CLASSES = (20, 28, 40, 64)  # least length of each length class
PIECES = (24, 32, 48, 80)  # lengths of the null distribution's pieces
BINS, DECADES = 240, 12
ALPHA = 0.001

_DIGITS, _LOW, _UP = b"0123456789", bytes(range(97, 123)), bytes(range(65, 91))
ALPHABETS = (_DIGITS, _DIGITS + b"abcdef", _DIGITS + b"ABCDEF", _UP + b"234567", _DIGITS + _LOW, _DIGITS + _UP,
             _DIGITS + _UP + _LOW, _UP + _LOW + _DIGITS + b"+/", _UP + _LOW + _DIGITS + b"-_", _UP + _LOW + _DIGITS + b"+/-_")
_SIZE = np.array([len(a) for a in ALPHABETS])
_MEMBER = np.zeros(256, np.uint16)
_VALUE = np.zeros((len(ALPHABETS), 256), np.int16)
for _k, _a in enumerate(ALPHABETS):
    for _v, _c in enumerate(_a):
        _MEMBER[_c] |= 1 << _k
        _VALUE[_k, _c] = _v


def base_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes."""
    out = []
    low = text.lower()
    if any(n in low for n in NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if b"AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


# ----------------------------------------------------------------- battery
def _tail(z: np.ndarray) -> np.ndarray:
    """P(Z >= z) of a standard normal, z >= 0: Chebyshev fit of erfc, relative error about 1e-7."""
    x = z / np.sqrt(2)
    t = 1 / (1 + x / 2)
    poly = np.zeros_like(t)
    for c in (0.17087277, -0.82215223, 1.48851587, -1.13520398, 0.27886807, -0.18628806, 0.09678418, 0.37409196, 1.00002368, -1.26551223):
        poly = poly * t + c
    return np.maximum(t * np.exp(-x * x + poly) / 2, 1e-300)


def battery(data: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Combined p-value, under randomness, of each token; the tokens lie end to
    end in ``data``, every one at least two characters long."""
    if not len(ends):
        return np.empty(0)
    starts = np.concatenate(([0], ends[:-1]))
    n = ends - starts
    fits = np.bitwise_and.reduceat(_MEMBER[data], starts)
    enc = np.argmax((fits[:, None] >> np.arange(len(ALPHABETS))) & 1, axis=1)
    size = _SIZE[enc]
    tok = np.repeat(np.arange(len(n)), n)
    v = _VALUE[enc[tok], data].astype(float)
    width = int(_SIZE.max())
    counts = np.bincount(tok * width + v.astype(np.int64), minlength=len(n) * width).reshape(-1, width)
    expected = n / size
    chi = (counts.astype(float) ** 2).sum(1) / expected - n
    p1 = np.where(chi >= size - 1, _tail(np.maximum(chi - (size - 1), 0) / np.sqrt(2 * (size - 1) * (n - 1) / n)), 0.5)
    high = v >= (size / 2)[tok]
    inner = np.ones(len(data), bool)
    inner[starts] = False  # pairs (i - 1, i) within a token
    turns = np.concatenate(([0], (high[1:] != high[:-1]) & inner[1:]))
    runs = np.add.reduceat(turns, starts)
    p2 = 2 * _tail(np.abs(runs - (n - 1) / 2) / np.sqrt((n - 1) / 4))
    c = v - ((size - 1) / 2)[tok]
    pairs = np.concatenate(([0.0], np.where(inner[1:], c[1:] * c[:-1], 0.0)))
    p3 = 2 * _tail(np.abs(np.add.reduceat(pairs, starts)) / ((size**2 - 1) / 12 * np.sqrt(n - 1)))
    half = -(np.log(np.minimum(p1, 1)) + np.log(np.minimum(p2, 1)) + np.log(np.minimum(p3, 1)))
    return np.exp(-half) * (1 + half + half * half / 2)  # chi-squared with 6 degrees of freedom


def _bin(score: np.ndarray) -> np.ndarray:
    return np.clip((np.log10(np.maximum(score, 1e-300)) + DECADES) * (BINS / DECADES), 0, BINS - 1).astype(np.int64)


def _class(length: np.ndarray) -> np.ndarray:
    return np.searchsorted(np.array(CLASSES), length, "right") - 1


_DROP = bytes(i for i in range(256) if i not in _DIGITS + _LOW + _UP)


def candidates(text: bytes) -> list[tuple[int, int]]:
    return [m.span() for m in CANDIDATE.finditer(text)]


def _scores(tokens: list[bytes]) -> np.ndarray:
    return battery(np.frombuffer(b"".join(tokens), np.uint8), np.cumsum([len(t) for t in tokens], dtype=np.int64))


def _pieces(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The text's letters and digits, cut into pieces of the lengths in turn."""
    data = np.frombuffer(text.translate(None, _DROP), np.uint8)
    rounds, cycle = len(data) // sum(PIECES) + 1, np.cumsum(PIECES)
    ends = (np.arange(rounds)[:, None] * cycle[-1] + cycle).ravel()
    ends = ends[ends <= len(data)]
    return data[: ends[-1] if len(ends) else 0], ends


def _histograms(batches):
    for b in batches:
        null, found = np.zeros((len(CLASSES), BINS), np.int64), np.zeros((len(CLASSES), BINS), np.int64)
        rows, tokens, datas, ends, size = texts(b.column(1)), [], [], [], 0
        for i, t in enumerate(rows):
            tokens += [t[a:z] for a, z in candidates(t)]
            for lo in range(0, len(t), 1 << 20):  # a very long text in blocks
                d, e = _pieces(t[lo : lo + (1 << 20)])
                datas.append(d)
                ends.append(e + size)
                size += len(d)
            if size >= 1 << 19 or i == len(rows) - 1:
                e = np.concatenate(ends) if ends else np.empty(0, np.int64)
                if len(e):
                    np.add.at(null, (_class(np.diff(e, prepend=0)), _bin(battery(np.concatenate(datas), e))), 1)
                if tokens:
                    np.add.at(found, (_class(np.array([len(x) for x in tokens])), _bin(_scores(tokens))), 1)
                tokens, datas, ends, size = [], [], [], 0
        out = [(k, c, s, int(h[c, s])) for k, h in enumerate((null, found)) for c, s in zip(*np.nonzero(h))]
        cols = list(zip(*out)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["kind", "length_class", "bin", "n"])


def limits(text: DataFrame, q: float) -> np.ndarray:
    """Per length class the least bin that is called random; BINS for none."""
    null, found = np.zeros((len(CLASSES), BINS)), np.zeros((len(CLASSES), BINS))
    rows = text.mapInArrow(lean(_histograms), "kind long, length_class long, bin long, n long")
    for r in rows.groupBy("kind", "length_class", "bin").agg(F.sum("n").alias("n")).collect():
        (found if r["kind"] else null)[r["length_class"], r["bin"]] = r["n"]
    above = lambda h: h[:, ::-1].cumsum(1)[:, ::-1]
    p = (above(null) + 1) / (null.sum(1, keepdims=True) + 1)
    good = (p * found.sum(1, keepdims=True) <= q * above(found)) & (above(found) > 0)
    return np.where(good.any(1), np.maximum(good.argmax(1), _bin(np.array([ALPHA]))), BINS)


# -------------------------------------------------------------------- scan
def scan(text: bytes, least: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans of a text, (start, kind, end) in code points, in order."""
    spans = base_spans(text)
    found = candidates(text)
    if found:
        scores, size = _bin(_scores([text[a:z] for a, z in found])), np.array([z - a for a, z in found])
        for (a, z), ok in zip(found, scores >= least[_class(size)]):
            if ok and not any(a < e and s < z for s, _, e in spans[: len(spans)] if _ != 3):
                spans.append((a, 3, z))
    if not spans:
        return []
    if not text.isascii():
        head = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
        spans = [(int(head[a]), k, int(head[z])) for a, k, z in spans]
    return sorted(spans)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", q: float = 0.01) -> DataFrame:
    """One row per row of ``docs``: doc_id, spans (array of kind, start, end)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    text = id_and_text(docs, id_col, text_col)
    least = limits(text, q)
    schema = with_id(docs, id_col, ("spans", "array<struct<kind:string,start:long,end:long>>"))
    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            yield batch_of(arrow, [b.column(0), [[{"kind": KINDS[k], "start": a, "end": z} for a, k, z in scan(t, least)] for t in texts(b.column(1))]])

    return text.mapInArrow(lean(run), schema)


def joined(spans):
    """kind:start:end of an array of spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(found: DataFrame) -> DataFrame:
    """The counts and digests of ``find_secrets``' spans."""
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"] != "random")
    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), count("random").alias("n_random"))
