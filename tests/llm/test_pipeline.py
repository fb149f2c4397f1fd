"""Every stage of the corpus pipeline on its own input."""

from collections import Counter, defaultdict

import corpus_pipeline
from starmart.llm import mixing, ngram_join, queries
from starmart.llm.common import materialize
from tests.llm.test_dedup import brute_lines

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        kept.append(materialize(stage(spark, kept[-1], SF)))
        if k < 4:
            assert kept[-1].columns == columns
    rows = [df.collect() for df in kept]
    # language ID: these documents all have letters
    assert Counter(r.doc_id for r in rows[1]) == Counter(r.doc_id for r in rows[0])
    # line dedup
    want = brute_lines([(r.doc_id, r.text) for r in rows[1]])
    assert Counter((r.doc_id, r.text) for r in rows[2]) == Counter((i, t) for i, _, _, t in want)
    assert all(r.n_chars == len(r.text) for r in rows[2] if (r.doc_id, r.text) not in {(x.doc_id, x.text) for x in rows[1]})
    # near duplicates: the least id of each group
    groups = ngram_join.brute_force([(r.doc_id, r.text) for r in rows[2]], 5, 80, 100)
    assert sorted(r.doc_id for r in rows[3]) == sorted({c for _, c in groups.values()})
    # the mix
    copies = {r.doc_id: r.copies for r in mixing.mix(kept[3]).collect()}
    assert Counter(r.doc_id for r in rows[4]) == Counter({d: n for d, n in copies.items() if n})
    # tokens
    assert Counter(r.doc_id for r in rows[5]) == Counter(r.doc_id for r in rows[4]) and all(r.n_tokens == len(r.ids) for r in rows[5])


def test_repeated_and_null_ids(spark):
    text = " ".join(f"word{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " more"), (None, text + " again"), (None, None), (4, None), (4, "other words here"), (4, "different text of its own")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_duplicates(spark, docs, SF).collect()
    by = defaultdict(list)
    for r in got:
        by[r.doc_id].append(r.text)
    assert by[1] == [text] and 2 not in by and sorted(map(str, by[4])) == ["None", "different text of its own", "other words here"]


def test_near_copies_go_by_row(spark):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    other = "one unique text that nothing else is like at all"

    def left(rows):
        docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
        got = corpus_pipeline.near_duplicates(spark, docs, SF)
        assert got.columns == docs.columns
        return Counter((r.doc_id, r.text) for r in got.collect())

    assert left([(3, a), (4, a + " x"), (4, other)]) == Counter([(3, a), (4, other)])
    assert left([(7, a), (12, a + " x"), (3, b), (7, b + " y")]) == Counter([(7, a), (3, b)])
    assert left([(5, a), (5, a + " x"), (None, b), (None, b + " y"), (None, b + " z")]) in [Counter([(5, t), (None, u)]) for t in (a, a + " x") for u in (b, b + " y", b + " z")]
    assert left([(None, a), (9, a + " x"), (8, None), (8, None), (8, " "), (None, None), (None, None)]) == Counter([(9, a + " x"), (8, None), (8, " "), (None, None)])


def test_last_stage_decodes(spark, small):
    import hashlib

    docs = small.limit(30)
    got = Counter((r.doc_id, r.decoded_sha256) for r in corpus_pipeline.sentencepiece(spark, docs, SF).collect())
    assert got == Counter((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in docs.collect())


def test_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 11)} <= {k.split("_")[0] + "_" for k in names} and "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert entry.oracle_sql().keys() <= names.keys()
