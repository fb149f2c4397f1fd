"""Vector codes against comparing everything."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.llm import codebooks
from starmart.llm.codebooks import Tree, assign

SCHEMA = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    *[T.StructField(c, T.IntegerType()) for c in ("code", "error", "of", "ids", "trees", "part", "entry", "at", "value")]])


def table(spark, rows):
    return spark.createDataFrame([(*r, *([0] * 9)) for r in rows], SCHEMA)


@pytest.mark.parametrize("n,e,d,spread", [(1, 1, 4, 3), (40, 7, 3, 50), (700, 256, 16, 200), (900, 5, 2, 3), (64, 3, 1, 1), (50, 4, 0, 1)])
def test_assignment_is_that_of_comparing_everything(n, e, d, spread):
    rng = np.random.default_rng(n)
    x = rng.integers(-spread, spread + 1, (n, d)).astype(np.int32)
    entries = x[rng.integers(0, n, e)].astype(np.int64)
    entries[-1] = entries[0]  # equal entries: the lower index wins
    label, sums, counts = assign(Tree(x, 8), entries)
    want = ((x[:, None].astype(np.int64) - entries[None]) ** 2).sum(2).argmin(1)
    total = np.zeros_like(entries)
    np.add.at(total, want, x)
    assert (label == want).all() and (counts == np.bincount(want, minlength=e)).all() and (sums == total).all()


def test_whole_nodes_use_cached_sums():
    x = np.repeat(np.array([[0, 0], [1000, 1000]], np.int32), 100, 0)
    tree = Tree(x, 8)
    tree.x = None  # integers of single rows are not needed
    label, sums, counts = assign(tree, np.array([[1, 1], [999, 999]]))
    assert counts.tolist() == [100, 100] and sums.tolist() == [[0, 0], [100000, 100000]] and label.tolist() == [0] * 100 + [1] * 100


def check(spark, rows, **options):
    got = codebooks.compress(table(spark, rows).repartition(3), **options).collect()
    want, digest = codebooks.brute_force([r[:2] for r in rows], **{k: v for k, v in options.items() if k != "leaf"})
    assert sorted(((r["vec_id"], r["code"], r["error"]) for r in got), key=str) == sorted(want, key=str)
    assert {r["codebooks_sha256"] for r in got} <= {digest}
    for r in got:
        assert r["label_error"] == sum(x["error"] for x in got if x["label"] == r["label"])
    return got


def test_against_brute_force(spark):
    random.seed(5)
    rows = [(i, [random.gauss(0, 0.1) for _ in range(12)], random.choice([1, 2, None])) for i in range(120)]
    check(spark, rows, entries=9, leaf=4)


def test_odd_rows(spark):
    v = [0.1, 0.2, -0.3, 0.4, 0.5]
    rows = [(5, v, 1), (5, v, 1), (5, [0.0] * 5, None), (None, [1.0] * 5, None), (1, None, 1), (2, [0.1, None, 0.2], 1), (3, [0.1, math.nan, 0.2], 1), (4, [math.inf], 1),
            (6, [], 2), (7, [0.25], 2), (8, [3e38] * 5, 2)]
    got = codebooks.compress(table(spark, rows), entries=3).collect()
    assert sorted(r["vec_id"] or -1 for r in got) == [-1, 5, 5, 5, 6, 7, 8]
    check(spark, rows[:-1], entries=3)


def test_hot_vector(spark):
    rows = [(i, [0.5, 0.25, 0.125, 0.0] if i % 3 == 0 else [i / 100, 0.1, -i / 100, 0.2], i % 2) for i in range(90)]
    check(spark, rows, entries=8, leaf=4)


def test_empty(spark):
    out = codebooks.compress(table(spark, []))
    assert out.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"] and out.collect() == []


def test_does_not_depend_on_partitions_and_equals_sql(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    vectors = spark.read.parquet(path)
    a, b = (codebooks.compress(v).orderBy("vec_id").collect() for v in (vectors, vectors.repartition(7, F.hash("vec_id"))))
    assert a == b
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{path}'")
    assert sorted(tuple(r) for r in a) == sorted(con.sql(codebooks.SQL).fetchall())
