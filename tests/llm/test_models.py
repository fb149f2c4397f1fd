"""Language ID, language-model scoring and SentencePiece."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import langid, lm, pieces
from tests.llm.conftest import ODD, table


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return langid.fit(docs.where(~langid.held_out()))


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    cols = np.unique(rng.integers(1, 6, (200, 3)), axis=0)
    one = langid.kneser_ney(cols, rng.integers(1, 5, len(cols)).astype(float), 6)
    m = langid.Model(["x"], np.arange(97, 102), 3, [langid.combine([one], [cols], 3)])
    for context in ([1, 2], [5, 5], [3, 1], [0, 4]):
        p = sum(np.exp(m.logprobs(np.array([*context, w]))[2, 0]) for w in range(6))
        assert p == pytest.approx(1, abs=1e-5)  # number 0 is any unknown symbol


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").where(langid.held_out())
    got = {r.doc_id: r for r in langid.identify(docs, model).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in rows]) > 0.98
    assert not any(r.rejected for r in got.values()) and all(0 <= r.score <= 1 for r in got.values())


def test_rejection(model):
    strange = ["Привет мир, как дела, это русский текст о погоде", "zzqx qqwx kkjw zxqk vvkq jjxw qzkx wvkj xxqz", "12 34 !!", "", "日本語のテキストです"]
    lang, score, xent, rejected = model.predict([t.encode() for t in strange])
    assert rejected.all() and lang[2] == lang[3] == "und" and lang[0] in model.languages


def test_each_text_is_scored_on_its_own(model):
    rows = [t.encode() for t in ["the and of thonre", "", "le de ouaire la", "x " * 400_000, "the and of thonre"]]
    together = model.entropies(rows)[0]
    for i, t in enumerate(rows):
        assert together[i] == pytest.approx(model.entropies([t])[0][0], abs=1e-6)


def test_language_id_odd_and_empty(spark, odd, none, model):
    got = langid.identify(odd, model).collect()
    assert len(got) == len(ODD)
    assert Counter(r.doc_id for r in got) == Counter(i for i, *_ in ODD)
    und = Counter(r.doc_id for r in got if r.lang_pred == "und")
    assert und == Counter([2, 3, 4, None, 7])
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and 7 not in {r.doc_id for r in kept.collect()}
    nothing = langid.fit(none)
    assert {(r.lang_pred, r.score, r.rejected) for r in langid.identify(odd, nothing).collect()} == {("und", 0.0, True)}
    assert langid.identify(none, model).count() == 0
    assert langid.fit(odd).languages == ["en", "nl"]  # a handful of texts will do


def test_every_language_is_learned_in_blocks(spark, monkeypatch):
    """More languages than fit in a block, each with an alphabet of its own; blocks do not change a prediction."""
    rng = random.Random(8)

    def text(k):
        letters = [chr(0x4E00 + 12 * k + i) for i in range(12)]
        return " ".join("".join(rng.choice(letters[: 4 + i % 8]) for i in range(6)) for _ in range(12))

    rows = [(text(k), f"l{k:03d}") for k in range(230) for _ in range(3)] + [(text(229), "l229")] * 300  # one text fills a language
    docs = spark.createDataFrame(rows, "text string, lang string")
    fitted = langid.fit(docs)
    assert len(fitted.languages) == 230 and [len(b.unknown) for b in fitted.blocks] == [8] * 28 + [6]
    asked = [text(k).encode() for k in range(230)]
    assert fitted.predict(asked)[0] == fitted.languages
    monkeypatch.setattr(langid, "BLOCK", 1000)
    whole = langid.fit(docs)
    assert len(whole.blocks) == 1 and whole.entropies(asked[:40])[0] == pytest.approx(fitted.entropies(asked[:40])[0], rel=1e-5)


def junk(rng, n):
    return [" ".join("".join(rng.choice("qxzjkvwyhbgfpcm") for _ in range(rng.randrange(3, 11))) for _ in range(rng.randrange(20, 200))) for _ in range(n)]


def test_junk_among_the_labelled_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    clean, rng = [(r.text, r.lang) for r in docs.where(~langid.held_out()).collect()], random.Random(6)
    langs = sorted({k for _, k in clean})
    # 2% of the labels are on junk
    rows = clean + [(t, langs[i % len(langs)]) for i, t in enumerate(junk(rng, len(clean) // 49))]
    fitted = langid.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert fitted.predict([t.encode() for t in junk(rng, 50)])[3].all()
    held = [r.text.encode() for r in docs.where(langid.held_out()).collect()]
    assert not fitted.predict(held)[3].any()


def test_spread_is_not_moved_by_outliers():
    rng = np.random.default_rng(2)
    inverse = 1 / rng.integers(50, 2000, 250)
    dev = np.abs(rng.normal(0, np.sqrt(0.02 + 3 * inverse)))
    plain, _ = langid._robust_spread(dev, inverse)
    mixed, fine = langid._robust_spread(np.append(dev, [5.0] * 20), np.append(inverse, [1 / 500] * 20))
    assert mixed == plain and not fine[250:].any()


# ------------------------------------------------------------- LM scoring
def test_gradient_against_differences():
    net = lm.Network.start()
    ids, _ = lm.numbered([b"a b c d e f g", b"", b"x", b"q w e r t y"], (np.empty(0, np.uint64), np.empty(0, np.int64)))
    places = np.flatnonzero(ids != lm.EDGE)
    assert len(places) == 14
    net.weights = net.weights.astype(float)
    g = net.gradient(ids, places)
    step = np.random.default_rng(0).normal(size=len(g)) * 1e-4

    def loss(w):
        return -lm.Network(w).forward(ids, places)[-1].astype(float).mean()

    assert loss(net.weights + step) - loss(net.weights - step) == pytest.approx(2 * g @ step, rel=0.05)


def test_word_probabilities_sum_to_one():
    net = lm.Network.start()
    ids = np.full(5, lm.EDGE)
    total = 0.0
    for w in range(lm.EDGE):
        ids[2] = w
        total += np.exp(net.forward(ids, np.array([2]))[-1][0])
    assert total == pytest.approx(1, abs=1e-3)


def test_scores_prefer_held_out_text_to_shuffled(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    fitted = lm.fit(docs.where(~held))
    rows = [r.text.encode() for r in docs.where(held).collect()]
    rng = random.Random(1)
    mixed = []
    for t in rows:
        w = t.split()
        rng.shuffle(w)
        mixed.append(b" ".join(w))
    (n, a), (_, b) = lm.log_probabilities(rows, fitted), lm.log_probabilities(mixed, fitted)
    assert a.sum() / n.sum() > b.sum() / n.sum() + 0.05
    assert a.sum() / n.sum() > -np.log(lm.EDGE) + 0.5
    alone = [lm.log_probabilities([t], fitted)[1][0] for t in rows[:20]]
    assert a[:20] == pytest.approx(alone, rel=1e-4)


def test_lm_odd_and_empty(odd, none):
    fitted = lm.fit(odd)
    got = lm.score(odd, fitted).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in got) == Counter((i, len((t or "").encode().split())) for i, t, *_ in ODD)
    assert all((r.n_tokens == 0) == (r.mean_log_prob is None) and r.log_prob <= 0 for r in got)
    assert lm.score(none, lm.fit(none)).count() == 0


def test_every_rare_word_has_its_own_probability(spark):
    common = " ".join(" ".join([f"c{i:03d}"] * 8) for i in range(lm.NAMED))
    bucket = lambda w: int(lm._hashed([w.encode()])[0][0] % np.uint64(lm.BUCKETS))
    often, seldom, new = [w for w in (f"r{i}" for i in range(5000)) if bucket(w) == 7][:3]
    docs = table(spark, [(0, common, None, None), (1, often, None, None), (1, often, None, None), (2, often, None, None), (3, seldom, None, None), (4, f"c000 {often} {often} c001", None, None)])
    fitted = lm.fit(docs)
    asked = table(spark, [(1, often, None, None), (2, seldom, None, None), (3, new, None, None), (4, "c000", None, None), (5, f"{often} c001 {often} {seldom}", None, None), (5, f"{often} c001 {often} {seldom}", None, None), (6, None, None, None)])
    got = {r.doc_id: r.log_prob for r in lm.score(asked, fitted).collect()}
    of = lambda t: lm.log_probabilities([t.encode()], fitted)[1][0]
    assert of(often) == of(seldom) == of(new)  # one bucket: 5 + 1 occurrences, and one for all others
    assert [got[i] - of(often) for i in (1, 2, 3)] == pytest.approx(np.log([5 / 7, 1 / 7, 1 / 7]), abs=1e-4)
    assert got[4] == pytest.approx(of("c000"), abs=1e-4) and got[6] == 0
    assert got[5] - of(f"{often} c001 {often} {seldom}") == pytest.approx(2 * np.log(5 / 7) + np.log(1 / 7), abs=1e-4)
    assert fitted.shares.count() == 2


def test_model_and_scores_do_not_depend_on_partitions(spark, small):
    """Read as given, dealt anew, in smaller batches; shares looked up, or all joined."""
    a = lm.fit(small, learner=20_000)
    want = {r.doc_id: r.log_prob for r in lm.score(small, a).collect()}
    was = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 17)
    try:
        b = lm.fit(small.repartition(7, F.hash("text")), learner=20_000, frequent=0)
        assert (a.weights == b.weights).all() and len(a.frequent[0]) > 100 and len(b.frequent[0]) == 0
        assert a.tail.count() == 0 and b.tail.count() == len(a.frequent[0]) < a.shares.count()
        got = {r.doc_id: r.log_prob for r in lm.score(small, b).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", was)
    assert got == pytest.approx(want, rel=1e-5)


def test_scores_against_brute_force(spark, small):
    """The network by plain loops, and each word's share from plain counts."""
    rows = [(r.doc_id, (r.text or "").encode()) for r in small.collect()]
    fitted = lm.fit(small)
    counts = Counter(w.lower() for _, t in rows for w in t.split())
    named = {int(h): int(i) for h, i in zip(*fitted.words)}
    of = lambda w: int(lm._hashed([w])[0][0])
    total = Counter()
    for w, n in counts.items():
        if of(w) not in named:
            total[of(w) % lm.BUCKETS] += n
    emb, bias, wc, bc, ww, bw = (p.astype(float) for p in lm.Network(fitted.weights).parts())
    log_softmax = lambda z: z - z.max() - np.log(np.exp(z - z.max()).sum())
    got = {r.doc_id: r.log_prob for r in lm.score(small, fitted).collect()}
    for i, t in sorted(rows, key=lambda r: len(r[1]))[:25]:
        words = [w.lower() for w in t.split()]
        ids = [lm.EDGE] * lm.WINDOW + [named.get(of(w), lm.NAMED + of(w) % lm.BUCKETS) for w in words] + [lm.EDGE] * lm.WINDOW
        want = 0.0
        for k, w in enumerate(words, lm.WINDOW):
            h = np.tanh(bias + sum(emb[j][ids[k + d]] for j, d in enumerate(lm.Network.OFFSETS)))
            c, x = divmod(ids[k], lm.PER_CLASS)
            want += log_softmax(h @ wc + bc)[c] + log_softmax(h @ ww[c] + bw[c])[x]
            if of(w) not in named:
                want += np.log(counts[w] / (total[of(w) % lm.BUCKETS] + 1))
        assert got[i] == pytest.approx(want, rel=1e-4, abs=1e-3)


# ---------------------------------------------------------- SentencePiece
@pytest.fixture(scope="module")
def pieces_table():
    return pieces.load_pieces()


def best_path(unit: str, t) -> list[int]:
    """Plain dynamic programme over one unit."""
    known = {p: (i, s) for p, i, s in t.rows}
    unit = unit.replace(" ", pieces.BLANK)
    best = [(0.0, [])] + [None] * len(unit)
    for e in range(1, len(unit) + 1):
        for s in range(max(0, e - t.longest), e):
            i, score = known.get(unit[s:e], (None, None))
            if i is None and e == s + 1:
                i, score = [t.byte_ids[b] for b in unit[s].encode()], t.unknown
            if i is not None and (best[e] is None or best[s][0] + score > best[e][0]):
                best[e] = (best[s][0] + score, best[s][1] + (i if isinstance(i, list) else [i]))
    return best[-1][1]


def units(text: str) -> list[str]:
    out, text = [], " " + text
    for i, c in enumerate(text):
        if i == 0 or (c == " " and text[i - 1] != " "):
            out.append("")
        out[-1] += c
    return out


SAMPLES = ["  a  b ", "日本語 🙂\n\tx", "     lots   of      blanks    ", "naïve café — “quoted” … ½ ﬁ", " ", "x" * 3000]


def test_encoding_is_the_librarys_own(spark, small, pieces_table):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    rows = [(r.doc_id, r.text) for r in small.collect()] + [(1000 + i, t) for i, t in enumerate(SAMPLES)]
    got = {r.doc_id: r.ids for r in pieces.encode(table(spark, [(i, t, None, None) for i, t in rows]), pieces_table).collect()}
    assert pieces_table.merging
    for i, t in rows:
        assert got[i] == own.encode(t)


def test_best_path_of_a_model_with_probabilities(spark, small, pieces_table):
    plain = pieces.Pieces(pieces_table.rows, pieces_table.byte_ids, pieces_table.spelled, pieces_table.unknown)
    rows = [(r.doc_id, r.text[:600]) for r in small.limit(60).collect()] + [(1000 + i, t) for i, t in enumerate(SAMPLES)] + [(2000, "▁x")]
    got = {r.doc_id: r.ids for r in pieces.encode(table(spark, [(i, t, None, None) for i, t in rows]), plain).collect()}
    for i, t in rows:
        assert got[i] == [p for u in units(t.replace(pieces.BLANK, " ")) for p in best_path(u, plain)]


@pytest.mark.parametrize("merging", [True, False])
def test_relational_lattice_agrees(spark, small, pieces_table, merging):
    t = pieces.Pieces(pieces_table.rows, pieces_table.byte_ids, pieces_table.spelled, pieces_table.unknown, merging)
    words = sorted({w for r in small.limit(4).collect() for w in r.text.split()})[:200] + ["naïve🙂", "x" * 40]
    got = pieces.encode_words(spark.createDataFrame([(pieces.BLANK + w,) for w in words], "word string"), t).collect()
    assert len(got) == len(set(words))
    encoder, bytes_ = pieces.Encoder(t), set(t.byte_ids)
    for r in got:
        want = encoder.group([r.word[1:].encode()])[0].tolist()
        assert [p for p in r.path if p >= 0] == [p for p in want if p not in bytes_]


def test_round_trip(spark, odd, none, small, pieces_table):
    for docs in (small, odd):
        back = pieces.decode(pieces.encode(docs, pieces_table), pieces_table).select("doc_id", "ids", "text").collect()
        assert Counter((r.doc_id, bytes(r.text).decode()) for r in back) == Counter((r.doc_id, r.text or "") for r in docs.collect())
        both = pieces.round_trip(docs, pieces_table).collect()
        assert Counter((r.doc_id, tuple(r.ids), bytes(r.text)) for r in both) == Counter((r.doc_id, tuple(r.ids), bytes(r.text)) for r in back)
    assert pieces.encode(none, pieces_table).count() == pieces.round_trip(none, pieces_table).count() == 0
    encoder = pieces.Encoder(pieces_table, limit=3)  # hardly anything is remembered
    raw = [b"\xff\xfe broken \xe9 bytes", b" ", b"", b"x" * 5000, b"a b a b"]
    for _ in range(2):
        ids, n = encoder.group(raw)
        assert pieces.spell(pieces_table, ids, n) == raw


def test_what_a_worker_remembers_is_bounded(pieces_table):
    import pickle

    sent = pickle.loads(pickle.dumps(pieces_table))
    assert not hasattr(sent, "rows") and sent.spelling == pieces_table.spelling
    encoder = pieces.Encoder(sent)
    ids, n = encoder.group([b"some words, some more", "na\u00efve \u4f60\u597d".encode(), b""])
    want, m = pieces.Encoder(pieces_table).group([b"some words, some more", "na\u00efve \u4f60\u597d".encode(), b""])
    assert ids.tolist() == want.tolist() and n.tolist() == m.tolist()
    per_unit = sum(x.itemsize for x in (encoder.keys, encoder.at, encoder.n))
    assert per_unit <= 16 and per_unit * encoder.limit <= 8 << 20


def test_memory_of_a_worker_is_bounded(spark, small, pieces_table):
    import pickle
    import tracemalloc

    assert pieces.round_trip(small, pieces_table).count() == small.count()
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 1 << 20
    assert not hasattr(pickle.loads(pickle.dumps(pieces_table)), "spelled")
    rng = random.Random(3)
    words = [" " + "".join(rng.choices("etaoinshr", k=9)) for _ in range(5_000)]
    want = pieces.lattice(words, pieces_table)  # from now on all pairs are known
    tracemalloc.start()
    got = pieces.lattice(words, pieces_table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert [x.tolist() for x in got] == [x.tolist() for x in want]
    assert peak < 200 * sum(map(len, words))
