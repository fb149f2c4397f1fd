"""Language-model scoring by masked pseudo-likelihood.

A small network predicts every word of a text from the words on both sides of
it (``WINDOW`` each way, the word itself masked): position-wise embeddings are
summed, squashed by tanh, and a two-level softmax gives first the word's class,
then the word within its class. A document's score is the sum of the
conditional log-probabilities of its words.

Word numbers: the most frequent words of the corpus, counted over all
documents, have a number each; all other words share numbers (buckets) by hash
in the network, whose size is fixed. A rare word's probability is its bucket's
times the word's share of the bucket's occurrences in the corpus, so every word
has its own. These shares are a Spark table of all distinct rare words, which
grows with the corpus. Each bucket counts one occurrence more than the corpus
has, which is the share of a word not in it, so a bucket's shares sum to one. A
word that occurs once has the share of one that does not occur, so only words
that occur twice need to be found: those of the highest counts, ``FREQUENT`` at
most, are broadcast with their shares; of the others a filter of fixed size is,
and a word that it holds meets the table in a join. Words are told apart by
64-bit hashes.

Training covers every document once. Documents are dealt to ``rounds`` rounds,
and within a round to learners of about ``LEARNER`` words, by hashes of id and
text. In a round every learner starts from the same network, trains a copy in
numpy over all words of its documents in the order of their hashes (Adagrad),
and sends its weights with its number of words; Spark sums them piece by piece
in the learners' order, and the weighted mean starts the next round. So the
model depends on the documents only, not on how they are read, dealt to tasks
or batched. The network's size is fixed by parameters, so it is collected and
broadcast; what the learners send grows with the corpus.

A null text, and a text without words, has no tokens, log-probability 0 and a
null mean. A text of one word is predicted from its edges. Texts of any length
go through in pieces of ``BATCH`` words with whole contexts. Without any words
the network stays as it starts. Repeated rows each give a row (and train twice,
in one learner where id and text repeat); columns other than id and text are
ignored. A score may differ in the last digits of single precision by the texts
that are scored beside it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _tables, batch_of, hash_filter, id_and_text, in_hash_filter, lean, materialize, spans_hash, texts, with_id

WINDOW, WIDTH, CLASSES, PER_CLASS, NAMED = 2, 16, 32, 32, 768
ROUNDS, RATE, BATCH, PIECE = 2, 0.2, 8192, 4096
LEARNER = 4_000_000  # words of a learner in a round
# Words whose shares are broadcast; bits of the filter of the others; text of a group of batches.
FREQUENT, LOG2_BITS, GROUP = 1 << 19, 26, 16 << 20
LAST = 2**31 - 1
BUCKETS = CLASSES * PER_CLASS - NAMED  # a power of two, so that it divides signed and unsigned hashes alike
EDGE = CLASSES * PER_CLASS  # number of the place before and after a text


def _hashed(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of some texts, and the number of words of each text."""
    data = np.frombuffer(b"\n".join(rows), np.uint8)
    space = np.empty(len(data) + 2, bool)
    space[0] = space[-1] = True
    space[1:-1] = _tables()[1][data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    cuts = np.searchsorted(edge[0::2], np.cumsum([len(t) + 1 for t in rows]))
    return spans_hash(data, edge[0::2], edge[1::2]), np.diff(cuts, prepend=0)


def numbered(rows: list[bytes], vocabulary: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers of some texts, ``WINDOW`` edges round each, and each place's text."""
    return _numbered(*_hashed(rows), vocabulary)


def _numbered(h: np.ndarray, lengths: np.ndarray, vocabulary: tuple) -> tuple[np.ndarray, np.ndarray]:
    keys, numbers = vocabulary
    ids = NAMED + (h % np.uint64(BUCKETS)).astype(np.int64)
    if len(keys):
        pos = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        ids = np.where(keys[pos] == h, numbers[pos], ids)
    at = np.arange(len(ids)) + np.repeat(WINDOW * (2 * np.arange(len(lengths)) + 1), lengths)
    out = np.full(len(ids) + 2 * WINDOW * len(lengths), EDGE, np.int64)
    out[at] = ids
    return out, np.repeat(np.arange(len(lengths)), lengths + 2 * WINDOW)


def _grouped(rows: list[bytes], size: int = 1 << 20):
    lo, held = 0, 0
    for i, t in enumerate(rows):
        held += len(t)
        if held >= size or i == len(rows) - 1:
            yield rows[lo : i + 1]
            lo, held = i + 1, 0


@dataclass
class Network:
    weights: np.ndarray  # one flat array; the parts are views of it

    OFFSETS = [d for d in range(-WINDOW, WINDOW + 1) if d]

    @staticmethod
    def shapes():
        return [(2 * WINDOW, EDGE + 1, WIDTH), (WIDTH,), (WIDTH, CLASSES), (CLASSES,), (CLASSES, WIDTH, PER_CLASS), (CLASSES, PER_CLASS)]

    @classmethod
    def size(cls) -> int:
        return sum(int(np.prod(s)) for s in cls.shapes())

    @classmethod
    def start(cls, seed: int = 5) -> Network:
        rng = np.random.Generator(np.random.PCG64(seed))
        return cls(rng.normal(0, 0.1, cls.size()).astype(np.float32))

    def parts(self, flat: np.ndarray | None = None) -> list[np.ndarray]:
        flat, out, at = self.weights if flat is None else flat, [], 0
        for s in self.shapes():
            n = int(np.prod(s))
            out.append(flat[at : at + n].reshape(s))
            at += n
        return out

    def forward(self, ids: np.ndarray, places: np.ndarray):
        """State of the network at some places, which are put in order of their
        words' classes, and last the log-probability of each place's word, in
        the places' own order. Matrices have a column per place."""
        emb, bias, wc, bc, ww, bw = self.parts()
        cls, word = np.divmod(ids[places], PER_CLASS)
        order = np.argsort(cls.astype(np.int8), kind="stable")  # a radix sort
        places, cls, word = places[order], cls[order], word[order]
        near = [ids[places + d] for d in self.OFFSETS]
        h = sum(emb[j][x] for j, x in enumerate(near))
        h += bias
        h = np.tanh(h, out=h).T.copy()
        pc, lc = _softmax(wc.T @ h + bc[:, None], cls)
        bounds = np.searchsorted(cls, np.arange(CLASSES + 1))
        pw = np.empty((PER_CLASS, len(places)), np.float32)
        for c in np.flatnonzero(np.diff(bounds)):
            lo, hi = bounds[c], bounds[c + 1]
            np.matmul(ww[c].T, h[:, lo:hi], out=pw[:, lo:hi])
            pw[:, lo:hi] += bw[c][:, None]
        pw, lw = _softmax(pw, word)
        lp = np.empty(len(places), np.float32)
        lp[order] = lc + lw
        return h, near, cls, word, pc, pw, bounds, lp

    def gradient(self, ids: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Gradient of the mean negative log-probability."""
        h, near, cls, word, pc, pw, bounds, _ = self.forward(ids, places)
        emb, bias, wc, bc, ww, bw = self.parts()
        flat = np.zeros_like(self.weights)
        gemb, gbias, gwc, gbc, gww, gbw = self.parts(flat)
        rows = np.arange(len(places))
        pc[cls, rows] -= 1
        pw[word, rows] -= 1
        gwc[:], gbc[:] = h @ pc.T, pc.sum(1)
        gh = wc @ pc
        for c in np.flatnonzero(np.diff(bounds)):
            lo, hi = bounds[c], bounds[c + 1]
            gww[c], gbw[c] = h[:, lo:hi] @ pw[:, lo:hi].T, pw[:, lo:hi].sum(1)
            gh[:, lo:hi] += ww[c] @ pw[:, lo:hi]
        gh *= 1 - h * h
        gbias[:] = gh.sum(1)
        gh = gh.T.copy()
        for j, x in enumerate(near):
            o = np.argsort(x.astype(np.int16), kind="stable")
            x = x[o]
            first = np.flatnonzero(np.diff(x, prepend=-1))
            gemb[j][x[first]] = np.add.reduceat(gh[o], first)
        flat /= len(places)
        return flat


def _softmax(z: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by column, and the logarithm of the one at ``at``."""
    z -= z.max(0)
    chosen = z[at, np.arange(z.shape[1])]
    np.exp(z, out=z)
    total = z.sum(0)
    z /= total
    return z, chosen - np.log(total)


# ---------------------------------------------------------------- training
def _counts(batches):
    for b in batches:
        for rows in _grouped(texts(b.column("text")), 1 << 24):
            data = np.frombuffer(b"\n".join(rows), np.uint8)
            space = np.empty(len(data) + 2, bool)
            space[0] = space[-1] = True
            space[1:-1] = _tables()[1][data]
            edge = np.flatnonzero(space[1:] != space[:-1])
            u, n = np.unique(spans_hash(data, edge[0::2], edge[1::2]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(n, pa.int64())], names=["word", "n"])


def vocabulary(counts: DataFrame, named: int = NAMED) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the most frequent words, sorted, and their numbers by rank."""
    top = np.array([r["word"] for r in counts.orderBy(F.desc("n"), "word").limit(named).collect()], np.int64).view(np.uint64)
    o = np.argsort(top)
    return top[o], o


def _rare(counts: DataFrame, words: tuple) -> tuple[DataFrame, np.ndarray]:
    """Log of every rare word's share of its bucket (word, n, share), and of a new word's per bucket."""
    named = counts.sparkSession.createDataFrame([(int(w),) for w in words[0].view(np.int64)], "word long")
    rare = counts.join(F.broadcast(named), "word", "left_anti").withColumn("bucket", F.pmod("word", F.lit(BUCKETS)))
    total = np.ones(BUCKETS)
    for r in rare.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        total[r["bucket"]] += r["n"]
    return rare.select("word", "n", (F.log("n") + _of_bucket(-np.log(total), F.col("bucket"))).alias("share")), -np.log(total)


def _least_frequent(shares: DataFrame, frequent: int) -> int:
    """The least count, 2 or more, that at most ``frequent`` rare words reach;
    counts are looked at on a logarithmic scale, some hundreds of steps in all."""
    step = F.floor(8 * F.log2("n"))
    least, held = 1 << 62, 0
    steps = shares.where("n > 1").groupBy(step.alias("step")).agg(F.min("n").alias("n"), F.count("*").alias("words"))
    for r in sorted(steps.collect(), key=lambda r: -r["step"]):
        held += r["words"]
        if held > frequent:
            break
        least = r["n"]
    return least


def _of_bucket(values: np.ndarray, bucket):
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (bucket + 1).cast("int"))


class _Learner:
    """A copy of the network that trains on texts, about 1 MB at a time."""

    def __init__(self, weights: np.ndarray, words: tuple, rate: float):
        self.net, self.words, self.rate = Network(weights.copy()), words, rate
        self.square, self.seen, self.held, self.size = np.full_like(weights, 1e-4), 0, [], 0

    def add(self, text: bytes) -> None:
        self.held.append(text)
        self.size += len(text)
        if self.size >= 1 << 20:
            self.step()

    def step(self) -> None:
        ids, _ = numbered(self.held, self.words) if self.held else (np.empty(0, np.int64), None)
        self.held, self.size = [], 0
        places = np.flatnonzero(ids != EDGE)
        # neighbouring words would share a step: deal the places out
        places = np.random.Generator(np.random.PCG64(len(places))).permutation(places)
        for lo in range(0, len(places), BATCH):
            g = self.net.gradient(ids, places[lo : lo + BATCH])
            self.square += g * g
            self.net.weights -= self.rate * g / np.sqrt(self.square)
        self.seen += len(places)

    def pieces(self, number: int):
        self.step()
        if self.seen:
            w, cut = self.net.weights, range(0, len(self.net.weights), PIECE)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(cut)), pa.int32()), pa.array([number] * len(cut), pa.int64()), pa.array([self.seen] * len(cut), pa.int64()), pa.array([w[i : i + PIECE].tobytes() for i in cut], pa.binary())],
                names=["piece", "learner", "words", "weights"])


def _train(start, words, rate: float):
    """Rows (learner, text) in order, to the learners' weights."""
    def run(batches):
        now = learner = None
        for b in batches:
            for number, text in zip(b.column(0).to_pylist(), b.column(1)):
                if number != now:
                    if learner:
                        yield from learner.pieces(now)
                    now, learner = number, _Learner(start.value, words.value, rate)
                learner.add(text.as_py() or b"")
        if learner:
            yield from learner.pieces(now)
    return run


def _mean(batches):
    """Weighted mean of every piece of the weights, one learner's copy at a time."""
    held: dict[int, list] = {}
    for b in batches:
        for piece, _, n, raw in zip(*(c.to_pylist() for c in b.columns)):
            s = held.setdefault(piece, [0, 0.0])
            s[0] += n
            s[1] = s[1] + n * np.frombuffer(raw, np.float32).astype(float)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(held), pa.int32()), pa.array([(v / n).astype(np.float32).tobytes() for n, v in held.values()], pa.binary())], names=["piece", "weights"])


@dataclass
class Model:
    weights: np.ndarray
    words: tuple
    shares: DataFrame | None = None  # word, n, share (log) of all rare words
    new: np.ndarray | None = None  # log share of a word that the corpus does not have, or has once, per bucket
    frequent: tuple | None = None  # sorted hashes of the most frequent rare words, and their shares
    tail: DataFrame | None = None  # word, share of all other rare words that occur twice
    bits: np.ndarray | None = None  # filter of the words in ``tail``


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS, rate: float = RATE,
        frequent: int = FREQUENT, learner: int = LEARNER) -> Model:
    sc = docs.sparkSession.sparkContext
    mark = F.xxhash64("doc_id", "text")
    text = id_and_text(docs, id_col, text_col)
    counts = materialize(text.select("text").mapInArrow(lean(_counts), "word long, n long").groupBy("word").agg(F.sum("n").alias("n")))
    words = vocabulary(counts)
    learners = max(1, -(-(counts.agg(F.sum("n")).first()[0] or 0) // (rounds * learner)))
    sent, weights = sc.broadcast(words), Network.start().weights
    for r in range(rounds):
        dealt = text.where(F.pmod(mark, F.lit(rounds)) == r).select(F.pmod(F.xxhash64("text", "doc_id"), F.lit(learners)).alias("learner"), mark.alias("mark"), "text")
        dealt = dealt.repartition("learner").sortWithinPartitions("learner", "mark").select("learner", "text")
        start = sc.broadcast(weights)
        parts = dealt.mapInArrow(lean(_train(start, sent, rate)), "piece int, learner long, words long, weights binary")
        got = parts.repartition("piece").sortWithinPartitions("piece", "learner").mapInArrow(lean(_mean), "piece int, weights binary").collect()
        start.unpersist()
        if got:
            weights = np.concatenate([np.frombuffer(x["weights"], np.float32) for x in sorted(got, key=lambda x: x["piece"])])
    sent.unpersist()
    shares, new = _rare(counts, words)
    least = _least_frequent(shares, frequent)
    top = shares.where(F.col("n") >= least).select("word", "share").orderBy("word").toArrow()
    hashes = top.column(0).to_numpy().view(np.uint64)
    o = np.argsort(hashes)
    tail = materialize(shares.where((F.col("n") > 1) & (F.col("n") < least)).select("word", "share"))
    return Model(weights, words, shares, new, (hashes[o], top.column(1).to_numpy()[o]), tail, hash_filter(tail, "word", LOG2_BITS))


# ----------------------------------------------------------------- scoring
def log_probabilities(rows: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Words and summed conditional log-probability of each text by the network
    alone, in which rare words stand for their buckets."""
    return _by_network(rows, model)[:2]


def _by_network(rows: list[bytes], model: Model):
    """The same, then text and hash of every rare word."""
    net, n, total, rare, at = Network(model.weights), [], [], [], 0
    for group in _grouped(rows):
        h, lengths = _hashed(group)
        ids, owner = _numbered(h, lengths, model.words)
        places = np.flatnonzero(ids != EDGE)
        lp = np.empty(len(places))
        for lo in range(0, len(places), BATCH):
            lp[lo : lo + BATCH] = net.forward(ids, places[lo : lo + BATCH])[-1]
        n.append(np.bincount(owner[places], minlength=len(group)))
        total.append(np.bincount(owner[places], lp, len(group)))
        bucket = ids[places] >= NAMED
        if len(model.words[0]):  # fewer named words than numbers leave numbers free, so look at the words
            bucket = model.words[0][np.minimum(np.searchsorted(model.words[0], h), len(model.words[0]) - 1)] != h
        rare.append((owner[places][bucket] + at, h[bucket]))
        at += len(group)
    if not n:
        return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(n), np.concatenate(total), *(np.concatenate(x) for x in zip(*rare))


def _known(words: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Shares of some rare words, and which are still to be asked for."""
    share = model.new[(words % np.uint64(BUCKETS)).astype(np.int64)]
    keys, values = model.frequent
    here = np.zeros(len(words), bool)
    if len(keys):
        pos = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
        here = keys[pos] == words
        share = np.where(here, values[pos], share)
    return share, ~here & in_hash_filter(model.bits, words)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, log_prob, mean_log_prob.

    Some batches of texts become one row: what is known of each text from the
    network and the broadcast shares, the distinct words still to be asked for, and which text has
    which of them how often. Those words, one row per group and word, meet
    the table of shares, whose answers return to the group in order, so that a
    task holds one group at a time."""
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = with_id(docs, id_col, ("n_tokens", "long"), ("log_prob", "double"))
    kind = schema["doc_id"].dataType
    held = T.StructType([T.StructField("doc_ids", T.ArrayType(kind)), *(T.StructField(c, T.BinaryType()) for c in ("tokens", "logs", "pairs")), T.StructField("words", T.ArrayType(T.LongType()))])
    arrow, arrow_held = to_arrow_schema(schema), to_arrow_schema(held)
    sent = docs.sparkSession.sparkContext.broadcast(Model(model.weights, model.words, None, model.new, model.frequent, None, model.bits))

    def one(values, f):
        return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values).cast(f.type)

    def group(ids, n, total, owner, asked):
        words, index = np.unique(np.concatenate(asked), return_inverse=True)
        pair, times = np.unique(np.concatenate(owner) * len(words) + index, return_counts=True)
        pairs = np.stack([*np.divmod(pair, max(len(words), 1)), times]).astype(np.int32)
        return batch_of(arrow_held, [one(pa.concat_arrays(ids), arrow_held[0]), [np.concatenate(n).astype(np.int64).tobytes()], [np.concatenate(total).tobytes()], [pairs.tobytes()],
                                     one(pa.array(words.view(np.int64)), arrow_held[4])])

    def by_network(batches):
        parts, rows, size = [], 0, 0
        for b in batches:
            if b.num_rows:
                n, total, owner, h = _by_network(texts(b.column(1)), sent.value)
                words, index = np.unique(h, return_inverse=True)
                share, ask = _known(words, sent.value)
                total = total + np.bincount(owner, np.where(ask, 0.0, share)[index], len(n))
                asked = ask[index]
                parts.append((b.column(0), n, total, owner[asked] + rows, h[asked]))
                rows += b.num_rows
                size += b.column(1).nbytes
                if size >= GROUP:
                    yield group(*zip(*parts))
                    parts, rows, size = [], 0, 0
        if parts:
            yield group(*zip(*parts))

    def add(batches):
        shares = []
        for b in batches:
            place, share, at = b.column("at").to_numpy(), b.column("share").to_numpy(zero_copy_only=False), 0
            for k in np.flatnonzero(place == LAST):
                shares.append(share[at:k])
                of, at = b.column("of")[int(k)], k + 1
                n, total, pairs = (np.frombuffer(of[c].as_py(), t) for c, t in (("tokens", np.int64), ("logs", float), ("pairs", np.int32)))
                owner, index, times = pairs.reshape(3, -1)
                if len(owner):
                    total = total + np.bincount(owner, times * np.concatenate(shares)[index], len(n))
                shares = []
                yield batch_of(arrow, [of["doc_ids"].values.cast(arrow[0].type), n, total])
            shares.append(share[at:].copy())

    rows = id_and_text(docs, id_col, text_col).mapInArrow(lean(by_network), held)
    rows = materialize(rows.withColumn("batch", F.monotonically_increasing_id()))
    asked = rows.select("batch", F.posexplode("words").alias("at", "word"))
    share = F.coalesce("share", _of_bucket(model.new, F.pmod("word", F.lit(BUCKETS))))
    told = asked.join(model.tail, "word", "left").select("batch", "at", share.alias("share"), F.lit(None).alias("of"))
    whole = rows.select("batch", F.lit(LAST).alias("at"), F.lit(None).cast("double").alias("share"), F.struct("doc_ids", "tokens", "logs", "pairs").alias("of"))
    # every group's shares in the order of its words, then the group itself
    both = whole.unionByName(told).repartition("batch").sortWithinPartitions("batch", "at").select("at", "share", "of")
    scored = both.mapInArrow(lean(add), schema)
    return scored.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
