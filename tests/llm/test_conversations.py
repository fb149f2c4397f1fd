"""Repaired conversations against trying all cheapest edits, and against SQL."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import types as T

from starmart.llm import conversations as C

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    *[T.StructField(c, T.IntegerType()) for c in ("c", "k", "part", "times", "u", "cost", "rows", "state", "m")]])


def table(spark, rows):
    return spark.createDataFrame([(*r, *([0] * 9)) for r in rows], SCHEMA)


def damaged(rows):
    """Plain form of ``damage`` and of the order of rows."""
    out: dict = {}
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        u, role, text = zlib.crc32(name.encode()) % 20, " " if role is None else role, " " if text is None else text
        kept = out.setdefault(conv, [])
        if u:
            row = (turn, "user" if u == 4 else role, "" if u == 1 else "".join(x for x in text if x not in ".!?") if u == 2 else text)
            kept += [row] * (1 + (u == 3))
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).digest()))
    return out


def check(spark, rows, parts=3):
    got = C.repair_damaged(table(spark, rows).repartition(parts)).collect()
    want = {}
    for conv, kept in damaged(rows).items():
        *numbers, text = C.brute_force(kept)
        want[conv] = (*numbers, hashlib.sha256(text.encode()).hexdigest(), len(kept))
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def rows_of(seed, n_convs, longest=9, ids=None):
    random.seed(seed)
    rows = []
    for conv in ids or range(n_convs):
        for i in range(random.randint(1, longest)):
            text = random.choice(["a.", "b.", "c", "", "d!", " \t\x0b", "g?\n ", "h.", None])
            if text and text.strip() and random.random() < 0.7:
                text = f"{i} {text}"
            rows.append((conv, random.choice([i, i, i, i // 2, None]), random.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), text))
    return rows


def test_powers_advance_like_single_rows():
    for symbol in range(9):
        v = w = C.at_end()
        for n in range(1, 40):
            w = C._apply(C.power(symbol, 0), w)
            assert (C.advance(symbol, n, v) == w).all()
            assert (C._apply(C.matrix([(symbol, n)]), v) == w).all()


def test_long_runs():
    audit, state = C.unroll([(2, 3000)], 0, C.at_end())  # users only
    assert len(audit) == 3000 and state == C.AFTER_A
    assert sum({"K": 0, "R": 1, "D": 2, "I": 5}[e] for e in audit) == 1500 == C.advance(2, 3000, C.at_end())[0]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    check(spark, rows_of(seed, 60))


def test_a_large_conversation_in_many_pieces(spark):
    random.seed(7)
    rows = [(1, i, random.choice(["user", "assistant", "assistant", "tool"]), random.choice([f"{i} x.", f"{i}", "again.", ""])) for i in range(90)] + rows_of(3, 0, ids=[0, 2, None])
    for n in (7,):
        was = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", n)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            check(spark, rows, 5)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", was)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_pieces_are_cut_at_partitions(spark):
    rows = C._keyed(C.damage(table(spark, [(1, i, "user", f"{i}.") for i in range(300)])))
    ordered = C._symbols(rows).repartitionByRange(5, "c", "turn", "k").sortWithinPartitions("c", "turn", "k")
    assert ordered.rdd.getNumPartitions() > 1


def test_nulls_ties_repeats_and_only_dropped_rows(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "x."), (None, None, None, None), (None, None, "user", "a."), (None, 3, "user", "a."), (None, 3, "user", "a."), (-5, None, "system", "s."), (-5, None, "user", "q."),
            (-5, 0, "assistant", "long. " * 30000), (-6, 1, "sys", "one\ntwo."), (-6, 9, "ux", "u."), (-6, 10, "ax", "é🙂.")]
    check(spark, rows)


def test_empty(spark):
    assert C.repair_damaged(table(spark, [])).collect() == []


def test_equals_sql(spark, tmp_path):
    path = str(tmp_path / "conversations.parquet")
    table(spark, rows_of(11, 40) + [(None, 1, "user", "x.")]).select("conv_id", "turn", "role", "text").write.parquet(path)
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{path}/*.parquet'")
    got = C.repair_damaged(spark.read.parquet(path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(con.sql(C.SQL).fetchall(), key=str)
    assert np.array([r["cost"] for r in got]).sum() > 0
