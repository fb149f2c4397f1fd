"""Exact dedup, line dedup, mixing and the n-gram join."""

import hashlib
import random
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from starmart.llm import exact_dedup, line_dedup, mixing, ngram_join
from starmart.llm.common import without
from tests.llm.conftest import ODD, table

low = lambda t: (t or "").translate({c: c + 32 for c in range(65, 91)})


def test_misra_gries_keeps_what_is_frequent():
    rng = random.Random(1)
    stream = [b"hot"] * 400 + [b"warm"] * 250 + [bytes([rng.randrange(256), rng.randrange(256)]) for _ in range(350)]
    rng.shuffle(stream)
    held = Counter()
    for i in range(0, len(stream), 50):
        held.update(stream[i : i + 50])
        held = exact_dedup.misra_gries(held, 4)
    assert len(held) <= 4 and held[b"hot"] and held[b"warm"]
    assert held[b"hot"] >= 400 - len(stream) / 5


@pytest.mark.parametrize("k", [1, 1024])
def test_exact_dedup_odd_rows(odd, k):
    rows = exact_dedup.exact_dedup(odd, k=k).collect()
    assert len(rows) == len(ODD)
    groups = defaultdict(list)
    for i, t, *_ in ODD:
        groups[hashlib.sha256(low(t).encode()).hexdigest()].append(i)
    for r in rows:
        ids = groups[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == max((i for i in ids if i is not None), default=None)
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert kept == {g: 1 for g in groups}  # exactly one of repeated rows too


def test_exact_dedup_empty(none):
    assert exact_dedup.exact_dedup(none).count() == 0


def brute_lines(rows, min_chars=40, min_docs=5):
    key = lambda x: low(x.strip(" \t\n\x0b\x0c\r"))
    docs = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= min_chars:
                docs[key(x)].add(i)
    least = lambda i: (i is not None, i or 0)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(docs.get(key(x), ())) < min_docs or least(i) >= max(map(least, docs[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return Counter(out)


def line_rows():
    hot, wide = "This line is in very many documents of the table.", "é" * 39 + "x"
    rng = random.Random(4)
    rows = [(i, "\n".join([f"own line {i}", f"  {hot.upper()}\t" if i % 2 else hot, hot if i % 3 == 0 else "x", wide if i < 5 else "é" * 39, ""])) for i in range(40)]
    rows += [(100 + i, "\n".join(rng.choice("abc") * rng.choice((39, 40, 41)) for _ in range(4))) for i in range(20)]
    return [*rows, (None, hot), (None, None), (200, ""), (3, hot), (41, hot)]


@pytest.mark.parametrize("bits", [8, 20])  # 8: every key is a suspect
def test_line_dedup_against_brute_force(spark, bits):
    rows = line_rows()
    docs = table(spark, [(i, t, "en", "s") for i, t in rows])
    got = line_dedup.line_dedup(docs, log2_bits=bits, log2_chunk=6).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept_text).decode()) for r in got) == brute_lines(rows)
    whole = line_dedup.drop_repeated_lines(docs, chars_col="n", log2_bits=bits, log2_chunk=6)
    assert whole.columns == docs.columns
    assert Counter((r.doc_id, r.text or "") for r in whole.collect()) == Counter((i, t) for (i, _, _, t), n in brute_lines(rows).items() for _ in range(n))


def same_as_sql(spark, tmp_path, rows, query, sql):
    path = str(tmp_path / "documents.parquet")
    docs = table(spark, rows)
    docs.select("doc_id", "text", "lang", "source").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{path}/*.parquet'")
    got = query(spark.read.parquet(path))
    rel = con.sql(sql)
    want = rel.fetchall()
    order = [got.columns.index(c) for c in rel.columns]
    assert sorted((tuple(str(r[i]) for i in order) for r in got.collect())) == sorted(tuple(str(v) for v in r) for r in want)
    return got


def hot_rows():
    """A third of the rows under one id, a third without any, all of different texts that share lines."""
    shared = [f"A line that many of these documents hold, number {i}." for i in range(30)]
    rows = [((7 if i % 3 == 0 else None if i % 3 == 1 else i), "\n".join([f"own {i}", *shared[i % 25 : i % 25 + 5]]), "en", "a" if i % 2 else None) for i in range(300)]
    return rows + rows[:6]  # and some whole rows again


def test_line_dedup_hot_and_missing_ids(spark, tmp_path):
    rows = hot_rows()
    got = line_dedup.line_dedup(table(spark, rows))
    assert Counter((r.doc_id, r.n_lines, r.n_dropped, bytes(r.kept_text).decode()) for r in got.collect()) == brute_lines([r[:2] for r in rows])
    same_as_sql(spark, tmp_path, rows, lambda d: line_dedup.line_dedup(d).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")), line_dedup.SQL)


def test_exact_dedup_hot_and_missing_ids_as_sql(spark, tmp_path):
    rows = [r for r in hot_rows() for _ in range(2)] + [(None, None, None, None), (None, "", None, None), (3, "x", None, None), (3, "X", None, None), (2, "x", None, None)]
    same_as_sql(spark, tmp_path, rows, exact_dedup.exact_dedup, exact_dedup.SQL)


def test_mix_deals_rows_of_one_id_out(spark, tmp_path):
    rows = [(None, f"w{i} " * 5, "en", "a") for i in range(800)] + [(5, f"v{i} " * 5, "en", "a") for i in range(800)] + [(i, "x y z", "en", "b") for i in range(200)]
    got = same_as_sql(spark, tmp_path, rows, mixing.mix, mixing.SQL).collect()
    for i in (None, 5):
        assert len({r.copies for r in got if r.doc_id == i}) > 1  # not all or none
    taken = sum(r.taken for r in got if r.source == "a")
    assert abs(taken - next(r.target for r in got if r.source == "a")) <= 3


def test_line_dedup_odd_and_empty(odd, none):
    got = line_dedup.line_dedup(odd).collect()
    assert Counter((r.doc_id, r.n_lines, r.n_dropped) for r in got) == Counter((i, (t or "").count("\n") + 1, 0) for i, t, *_ in ODD)
    assert line_dedup.line_dedup(none).count() == 0 and line_dedup.drop_repeated_lines(none).count() == 0


def test_targets_fill_up(spark):
    rows = [(f"s{i}", n) for i, n in enumerate([10, 1000, 50, 3000, 7])] + [(None, 100)]
    got = {r.source: r for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    weight = dict(zip(["s0", "s1", "s2", "s3", "s4", None], [5, 2, 1, 5, 2, 1]))
    size, goal = dict(rows), dict.fromkeys(weight, 0.0)
    left, open_ = 1.5 * sum(size.values()), set(weight)
    while open_ and left > 1e-9:  # hand out by weight, again and again
        unit = left / sum(weight[s] for s in open_)
        left = 0.0
        for s in list(open_):
            goal[s] += unit * weight[s]
            if goal[s] >= 2 * size[s]:
                left += goal[s] - 2 * size[s]
                goal[s] = 2 * size[s]
                open_.discard(s)
    for s in weight:
        assert got[s].target == pytest.approx(goal[s], rel=1e-9)


def test_mix_meets_targets_and_repeats(spark):
    rng = random.Random(2)
    rows = [(i, " ".join("w" * rng.randrange(1, 5) for _ in range(rng.randrange(0, 60))), "en", rng.choice(["a", "a", "a", "b", "c", None])) for i in range(600)]
    docs = table(spark, rows)
    got = mixing.mix(docs, slices=64).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.mix(docs.repartition(7), slices=1000).collect()), key=str)
    taken, target = Counter(), {}
    for r in got:
        assert r.taken == r.copies * r.size and r.copies in (0, 1, 2)
        taken[r.source] += r.taken
        target[r.source] = r.target
    for s in target:
        assert abs(taken[s] - target[s]) <= 30  # half of the longest document
    out = mixing.mixed(docs, slices=64)
    assert out.columns == docs.columns
    assert Counter(r.doc_id for r in out.collect()) == Counter({r.doc_id: r.copies for r in got if r.copies})


def test_mix_odd_and_empty(spark, odd, none):
    got = mixing.mix(odd).collect()
    assert len(got) == len(ODD) and all(0 <= r.taken <= 2 * r.size for r in got)
    assert mixing.mix(none).count() == 0 and mixing.mixed(none).count() == 0
    assert [r.taken for r in mixing.mix(table(spark, [(1, None, None, "a"), (2, "", None, None)])).collect()] == [0, 0]


def near_rows():
    rng = random.Random(7)
    base = [f"w{rng.randrange(400)}" for _ in range(120)]
    rows = [(i, " ".join([*base[: rng.randrange(100, 120)], f"z{i}"])) for i in range(40)]  # one large group of near copies
    for i in range(40, 70):  # chains, each a little further away
        base[rng.randrange(120)] = f"q{i}"
        rows.append((i, " ".join(base)))
    passage = " ".join(f"p{i}" for i in range(30))
    rows += [(i, passage + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(1, 40)))) for i in range(70, 110)]
    rows += [(110, "a b"), (111, "A  b"), (112, "a"), (113, None), (114, ""), (115, "a b"), (116, "x " * 5000), (117, "x x x x")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n,num,den,cells", [(3, 90, 100, 23), (5, 80, 100, 4), (2, 60, 100, 12), (1, 100, 100, 17)])
def test_jaccard_components_against_brute_force(spark, n, num, den, cells):
    rows = near_rows()
    got = ngram_join.jaccard_components(table(spark, [(i, t, None, None) for i, t in rows]), n=n, num=num, den=den, log2_cells=cells).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == ngram_join.brute_force(rows, n, num, den)


def test_jaccard_components_odd_and_empty(odd, none):
    got = ngram_join.jaccard_components(odd).collect()
    assert len(got) == len(ODD)
    by_id = {r.doc_id: r.component_id for r in got if r.doc_id is not None}
    assert by_id == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1, 7: 7, 8: 8, 9: 9, 10: 10, 11: 10}
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["1", "None"]
    assert ngram_join.jaccard_components(none).count() == 0


def test_components_of_long_chain_and_star(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 260)] + [(300, 5)]
    rng.shuffle(links)
    got = dict(map(tuple, ngram_join.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 5 for i in [5, 300, *range(200, 260)]}}


def test_without(spark, odd):
    ids = spark.createDataFrame([(5,), (None,), (10,)], "doc_id long")
    left = without(odd, ids, "doc_id")
    assert left.columns == odd.columns
    assert sorted(r.doc_id for r in left.collect()) == [1, 2, 3, 4, 7, 8, 9, 11]


def test_jaccard_as_sql(spark, tmp_path, small):
    rng = random.Random(3)
    rows = [(r.doc_id, r.text, None, None) for r in small.collect()[:80]]
    for i, (_, t, *_) in enumerate(rows[:25]):
        w = (t or "").split(" ")
        w[rng.randrange(len(w))] = "changed"
        rows.append((500 + i, " ".join(w).upper(), None, None))
    rows += [(None, "One two", None, None), (900, "one  TWO", None, None), (901, None, None, None), (902, " ", None, None), (903, "one", None, None), rows[3], rows[3]]
    same_as_sql(spark, tmp_path, rows, ngram_join.jaccard_components, ngram_join.SQL)
