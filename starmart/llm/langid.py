"""Language identification with interpolated Kneser-Ney character models.

Text is lower-cased, every run of characters other than letters and marks
becomes one blank, and each language gets an interpolated Kneser-Ney model of
character n-grams. The models lie together in sorted arrays of n-gram hashes,
one per order, with a row of log-probabilities (one column per language) per
hash: one binary search serves all languages. An n-gram that no language knows
adds its context's back-off weights and goes on one order lower.

A text gets the language of the lowest cross-entropy per character. ``score``
is a softmax over the cross-entropies; its temperature is fitted on calibration
texts that the models have not seen. A text is ``rejected`` when its
cross-entropy lies further above its language's median than ``LIMIT`` spreads
and than twice the ``QUANTILE`` of the calibration texts, and is past half way
to that of a model which knows the alphabet only. The spread depends on the
length (short texts spread more); it starts from the median absolute deviation
and is fitted again without the texts past ``TRIM`` spreads, which take no part
in the quantile either. So some junk among the labelled texts (fewer than half)
does not widen the limit, which is at most ``2 * TRIM`` spreads.

The models are fitted on a bounded sample: about ``sample_docs`` labelled texts
per language, drawn of its distinct texts, of which a fifth calibrates;
``max_grams`` bounds a language's n-grams of the highest order (the most
frequent ones stay; all orders derive from them). Every language that has a
labelled text is learned (of fewer than five texts, all are trained on).
Languages lie together in blocks of ``BLOCK``, whose arrays have a column per
language, so the model's size is so many n-grams times the number of languages:
it is collected and broadcast. Prediction covers every text, whole, and uses
the text alone.

A null text, or one without a letter, gives ``und``, score 0, rejected. A null
id counts as the empty string for the held-out split. Without any labelled text
every prediction is ``und``. Equal cross-entropies go to the language first in
code-point order. Repeated rows each give a row; other columns are ignored by
``identify`` and kept, whatever their names, by ``keep_identified``.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batch_of, id_and_text, lean, materialize, ship, texts, with_id

ORDER = 4
SAMPLE_DOCS, MAX_GRAMS, BLOCK = 1000, 100_000, 8
LIMIT, TRIM, QUANTILE = 8.0, 6.0, 0.999
BLANK, EDGE = 32, 0
_R = np.random.Generator(np.random.PCG64(77)).integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


@lru_cache(maxsize=1)
def _folds() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: the symbol it stands for, and whether it is a letter."""
    fold, letter = np.full(0x110000, BLANK, np.int32), np.zeros(0x110000, bool)
    for i in range(0x110000):
        kind = unicodedata.category(chr(i))[0]
        if kind in "LM":
            fold[i], letter[i] = ord(chr(i).lower()[0]), kind == "L"
    fold[0] = EDGE
    return fold, letter


def symbols(group: list[bytes], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of some texts, each after ``pad`` edges; each symbol's text; each text's letters."""
    fold, letter = _folds()
    edge = "\0" * pad
    joined = edge + edge.join(t.replace(b"\0", b" ").decode("utf-8", "replace") for t in group)
    points = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32)
    sym = fold[points]
    text = np.cumsum(sym == EDGE, dtype=np.int32) // pad - 1
    letters = np.bincount(text[letter[points]], minlength=len(group))
    keep = np.ones(len(sym), bool)
    keep[1:] = (sym[1:] != BLANK) | ((sym[:-1] != BLANK) & (sym[:-1] != EDGE))
    return sym[keep], text[keep], letters


def _grouped(rows: list[bytes], size: int = 1 << 18):
    at, held = 0, 0
    for i, t in enumerate(rows):
        held += len(t)
        if held >= size or i == len(rows) - 1:
            yield at, i + 1
            at, held = i + 1, 0


def _keys(idx: np.ndarray, order: int) -> list[np.ndarray]:
    """Hashes of the n-grams of 1 to ``order`` symbols that end at each position."""
    out, h = [], np.zeros(len(idx), np.uint64)
    plus = (idx + 1).astype(np.uint64)
    for j in range(order):
        h = h.copy()
        h[j:] += plus[: len(plus) - j] * _R[j]
        out.append(h)
    return out


def _row_keys(cols: np.ndarray, n: int) -> np.ndarray:
    """Hash of the last ``n`` columns of each row of symbols."""
    h = np.zeros(len(cols), np.uint64)
    for j in range(n):
        h += (cols[:, cols.shape[1] - 1 - j] + 1).astype(np.uint64) * _R[j]
    return h


def _find(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    pos = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return pos, keys[pos] == wanted


# ------------------------------------------------------------------ fitting
def _discount(c: np.ndarray) -> float:
    n1, n2 = int((c == 1).sum()), int((c == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


@dataclass
class _OneLanguage:
    """probs[n]: sorted hashes and log of the discounted part; backoff[n]: of contexts."""
    direct: list
    backoff: list
    uniform: float


def kneser_ney(cols: np.ndarray, counts: np.ndarray, vocabulary: int) -> _OneLanguage:
    """Model of one language from its distinct n-grams (rows of symbols) and their counts."""
    order = cols.shape[1]
    direct, backoff, uniform = [None] * (order + 1), [None] * (order + 1), 0.0
    for n in range(order, 0, -1):
        d = _discount(counts)
        ctx = _row_keys(cols[:, :-1], n - 1)
        u, first, inv = np.unique(ctx, return_index=True, return_inverse=True)
        total, kinds = np.bincount(inv, counts), np.bincount(inv)
        key = _row_keys(cols, n)
        o = np.argsort(key)
        direct[n] = (key[o], (np.maximum(counts - d, 0) / total[inv])[o])
        backoff[n] = (u, np.log(d * kinds / total))
        if n == 1:
            uniform = float(d * kinds[0] / total[0] / vocabulary)
        else:  # continuation counts: in how many contexts a shorter n-gram occurs
            low = cols[:, 1:]
            _, first, inv = np.unique(_row_keys(low, n - 1), return_index=True, return_inverse=True)
            cols, counts = low[first], np.bincount(inv).astype(float)
    return _OneLanguage(direct, backoff, uniform)


@dataclass
class Block:
    """The models of some neighbouring languages."""
    keys: list  # per order, sorted hashes
    logp: list  # per order, (hashes, languages)
    ctx_keys: list
    ctx_logw: list
    unknown: np.ndarray

    def logprobs(self, keys: list[np.ndarray]) -> np.ndarray:
        """(positions, languages): log-probability of each symbol after the ones
        before it; ``keys`` are the hashes of the n-grams that end at each position."""
        order, size = len(keys), len(self.unknown)
        out = np.empty((len(keys[0]), size), np.float32)
        rows, carry = np.arange(len(out)), None
        for n in range(order, 0, -1):
            pos, hit = _find(self.keys[n], keys[n - 1][rows])
            got = self.logp[n][pos[hit]]
            out[rows[hit]] = got if carry is None else got + carry[hit]
            rows, carry = rows[~hit], None if carry is None else carry[~hit]
            if not len(rows):
                return out
            carry = np.zeros((len(rows), size), np.float32) if carry is None else carry
            if n > 1:
                pos, hit = _find(self.ctx_keys[n], keys[n - 2][np.maximum(rows - 1, 0)])
                carry[hit] += self.ctx_logw[n][pos[hit]]
        out[rows] = carry + self.unknown
        return out


@dataclass
class Model:
    languages: list
    alphabet: np.ndarray  # sorted symbols; index + 1 is a symbol's number, 0 an unknown one
    order: int
    blocks: list  # of BLOCK languages each, in order
    temperature: float = 10.0
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None  # per language: variance of long texts, variance times length
    cut: np.ndarray | None = None

    def number(self, sym: np.ndarray) -> np.ndarray:
        table = getattr(self, "_number", None)
        if table is None:
            table = np.zeros(0x110000, np.int64)
            table[self.alphabet] = np.arange(1, len(self.alphabet) + 1)
            self._number = table
        return table[sym]

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "_number"}

    def logprobs(self, idx: np.ndarray) -> np.ndarray:
        """(positions, languages): log-probability of each symbol after the ones before it."""
        keys = _keys(idx, self.order)
        return np.concatenate([b.logprobs(keys) for b in self.blocks], 1)

    def entropies(self, rows: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cross-entropy (texts, languages), symbols scored and letters of each text."""
        xent = np.zeros((len(rows), len(self.languages)))
        length, letters = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for lo, hi in _grouped(rows):
            sym, text, found = symbols(rows[lo:hi], self.order - 1)
            letters[lo:hi] = found
            step = 1 << 18  # a very long text goes through in pieces that overlap by a context
            for a in range(0, len(sym), step):
                b = max(0, a - self.order + 1)
                s, t = sym[b : a + step], text[b : a + step]
                keys = _keys(self.number(s), self.order)
                real = s != EDGE
                real[: a - b] = False
                length[lo:hi] += np.bincount(t[real], minlength=hi - lo)
                k = 0
                for block in self.blocks:
                    for column in block.logprobs(keys)[real].T:
                        xent[lo:hi, k] -= np.bincount(t[real], column, minlength=hi - lo)
                        k += 1
        return xent / np.maximum(length, 1)[:, None], length, letters

    def predict(self, rows: list[bytes]) -> tuple[list, np.ndarray, np.ndarray, np.ndarray]:
        """Language, score, cross-entropy, rejected of each text."""
        if not self.languages:
            return ["und"] * len(rows), np.zeros(len(rows)), np.zeros(len(rows)), np.ones(len(rows), bool)
        xent, length, letters = self.entropies(rows)
        best = xent.argmin(1)
        low = xent[np.arange(len(rows)), best]
        score = 1 / np.exp(-self.temperature * (xent - low[:, None])).sum(1)
        none = letters == 0
        z = (low - self.mean[best]) / np.sqrt(self.spread[best, 0] + self.spread[best, 1] / np.maximum(length, 1))
        lang = [("und" if n else self.languages[k]) for n, k in zip(none, best)]
        # ... and the model must do little better than one that knows the alphabet only.
        far = low > (self.mean[best] + np.log(len(self.alphabet) + 1)) / 2
        return lang, np.where(none, 0.0, score), np.where(none, 0.0, low), none | (far & (z > self.cut[best]))


def combine(models: list, cols: list, order: int) -> Block:
    """Put some languages' models into common arrays."""
    keys, logp, ctx_keys, ctx_logw = ([None] * (order + 1) for _ in range(4))
    every = np.concatenate(cols)
    unknown = np.log(np.array([m.uniform for m in models], np.float32))
    for n in range(1, order + 1):
        u, first = np.unique(_row_keys(every, n), return_index=True)
        grams = every[first][:, -n:]
        ck = np.unique(_row_keys(grams[:, :-1], n - 1))
        cw = np.zeros((len(ck), len(models)), np.float32)
        lp = np.empty((len(u), len(models)), np.float32)
        at, _ = _find(ck, _row_keys(grams[:, :-1], n - 1))
        low = None if n == 1 else _find(keys[n - 1], _row_keys(grams, n - 1))[0]
        for k, m in enumerate(models):
            pos, hit = _find(m.backoff[n][0], ck)
            cw[hit, k] = m.backoff[n][1][pos[hit]]
            rest = np.log(m.uniform) if n == 1 else cw[at, k] + logp[n - 1][low, k]
            pos, hit = _find(m.direct[n][0], u)
            lp[:, k] = np.log(np.where(hit, m.direct[n][1][pos], 0.0) + np.exp(rest))
        keys[n], logp[n], ctx_keys[n], ctx_logw[n] = u, lp, ck, cw
    return Block(keys, logp, ctx_keys, ctx_logw, unknown)


def _count(order: int):
    def run(batches):
        for b in batches:
            rows, langs = texts(b.column("text")), np.array(b.column("lang").to_pylist(), object)
            for lang in sorted(set(langs)):
                mine = [rows[i] for i in np.flatnonzero(langs == lang)]
                for lo, hi in _grouped(mine):
                    sym, _, _ = symbols(mine[lo:hi], order - 1)
                    win = np.lib.stride_tricks.sliding_window_view(sym, order)
                    win = win[win[:, -1] != EDGE]
                    if len(win):
                        _, first, n = np.unique(_row_keys(win, order), return_index=True, return_counts=True)
                        arrays = [pa.array([lang] * len(n), pa.string()), pa.array(win[first].tolist(), pa.list_(pa.int32())), pa.array(n, pa.int64())]
                        yield pa.RecordBatch.from_arrays(arrays, names=["lang", "gram", "n"])
    return run


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", order: int = ORDER, sample_docs: int = SAMPLE_DOCS,
        max_grams: int = MAX_GRAMS) -> Model:
    """Fit on a bounded sample, per language, of the rows whose text and language are not null."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    # The sample is drawn of distinct texts, by their digest: a text that fills a third of a language's rows counts once.
    rows = rows.where("text IS NOT NULL AND lang IS NOT NULL").withColumn("u", F.pmod(F.xxhash64("text"), F.lit(1 << 40)) / float(1 << 40))
    of_lang = rows.groupBy("lang").agg(F.approx_count_distinct("u").alias("n")).select("lang", "n", F.least(F.lit(1.0), F.lit(1.25 * sample_docs) / F.col("n")).alias("rate"))
    rows = rows.join(materialize(of_lang), "lang").where("u < rate")
    rows = materialize(rows.select(F.col("text").cast("binary").alias("text"), "lang", ((F.col("n") < 5) | (F.col("u") < F.col("rate") * 0.8)).alias("train")).distinct())
    grams = rows.where("train").select("text", "lang").mapInArrow(lean(_count(order)), "lang string, gram array<int>, n long")
    grams = materialize(grams.groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    # The least count that leaves at most max_grams n-grams, from the histogram of counts.
    least: dict = {}
    total: dict = {}
    for r in grams.groupBy("lang", F.least("n", F.lit(1000)).alias("c")).agg(F.count("*").alias("k")).orderBy(F.desc("c")).collect():
        total[r["lang"]] = total.get(r["lang"], 0) + r["k"]
        if total[r["lang"]] <= max_grams or r["lang"] not in least:
            least[r["lang"]] = r["c"]
    if not least:
        return Model([], np.empty(0, np.int64), order, [])
    keep = grams.sparkSession.createDataFrame(list(least.items()), "lang string, least long")
    table = grams.join(keep, "lang").where("n >= least").select("lang", "gram", "n").toArrow()
    langs = sorted(least)
    flat = np.array(table.column("gram").combine_chunks().flatten(), np.int64).reshape(-1, order)
    counts, of = np.array(table.column("n"), float), np.array(table.column("lang").to_pylist(), object)
    alphabet = np.unique(flat)
    cols = np.searchsorted(alphabet, flat) + 1
    parts = [np.flatnonzero(of == k) for k in langs]
    # In one order whatever the order of arrival, so that a fit is repeatable.
    parts = [p[np.argsort(_row_keys(cols[p], order))] for p in parts]
    models = [kneser_ney(cols[p], counts[p], len(alphabet) + 1) for p in parts]
    cols = [cols[p] for p in parts]
    blocks = [combine(models[k : k + BLOCK], cols[k : k + BLOCK], order) for k in range(0, len(langs), BLOCK)]
    return calibrate(Model(langs, alphabet, order, blocks), rows)


def _robust_spread(dev: np.ndarray, inverse: np.ndarray) -> tuple[tuple[float, float], np.ndarray]:
    """(base, slope) of the variance by 1 / length, and the texts within ``TRIM`` of it.
    It starts from the median absolute deviation, which up to half of the texts cannot
    move, and leaves out what is too far until the same texts stay."""
    base, slope = max((1.4826 * float(np.median(dev))) ** 2, 1e-2), 0.05
    fine = np.zeros(len(dev), bool)
    for _ in range(20):
        near = dev**2 <= TRIM**2 * (base + slope * inverse)
        if near.sum() < 5 or (near == fine).all():
            break
        fine = near
        rise, level = np.polyfit(inverse[fine], dev[fine] ** 2, 1) if np.ptp(inverse[fine]) > 0 else (0.0, float(np.mean(dev[fine] ** 2)))
        base, slope = max(level, 1e-2), max(rise, 0.05)
    return (base, slope), near


def calibrate(model: Model, rows: DataFrame) -> Model:
    """Temperature and rejection limits from the sampled texts that were not trained on."""
    def run(batches):
        for b in batches:
            xent, length, letters = model.entropies(texts(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("lang"), pa.array(xent.tolist(), pa.list_(pa.float64())), pa.array(length), pa.array(letters)], names=["lang", "xent", "length", "letters"])

    held = rows.where("NOT train").select("text", "lang").mapInArrow(lean(run), "lang string, xent array<double>, length long, letters long").where("letters > 0").orderBy("lang", "length", "xent").collect()
    L = len(model.languages)
    model.mean, model.spread, model.cut = np.zeros(L), np.tile([1.0, 1.0], (L, 1)), np.full(L, 6.0)
    held = [r for r in held if r["lang"] in model.languages]
    if held:
        xent, true = np.array([r["xent"] for r in held]), np.array([model.languages.index(r["lang"]) for r in held])
        loss = [(-t * (xent[np.arange(len(true)), true] - xent.min(1)) - np.log(np.exp(-t * (xent - xent.min(1, keepdims=True))).sum(1))).mean() for t in np.geomspace(1, 64, 25)]
        model.temperature = float(np.geomspace(1, 64, 25)[int(np.argmax(loss))])
        length = np.array([r["length"] for r in held], float)
        for k in range(L):
            own = (true == k) & (xent.argmin(1) == k)
            x, n = xent[own, k], length[own]
            if own.sum() < 5:  # too few to tell: a wide limit
                model.mean[k] = x.mean() if len(x) else np.log(len(model.alphabet) + 1)
                continue
            model.mean[k] = np.median(x)
            model.spread[k], fine = _robust_spread(np.abs(x - model.mean[k]), 1 / n)
            z = (x - model.mean[k]) / np.sqrt(model.spread[k, 0] + model.spread[k, 1] / n)
            model.cut[k] = max(LIMIT, 2 * np.quantile(z[fine], QUANTILE))
    return model


# --------------------------------------------------------------- prediction
def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, cross_entropy, rejected."""
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("lang_pred", "string"), ("score", "double"), ("cross_entropy", "double"), ("rejected", "boolean"))
    arrow, sent = to_arrow_schema(schema), docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield batch_of(arrow, [b.column(0), *sent.value.predict(texts(b.column(1)))])

    return id_and_text(docs, id_col, text_col).mapInArrow(lean(run), schema)


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, whole, whose text is not rejected."""
    ship(docs.sparkSession)
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            _, _, _, rejected = sent.value.predict(texts(b.column(at).cast(pa.binary())))
            yield b.filter(pa.array(~rejected))

    return docs.mapInArrow(lean(run), docs.schema)


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).cast("binary")) % 4 == 2
