"""The driver contract: entry() runs, every query runs at the smallest
scale, and every query has an oracle with the same column names."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL

# The warehouse's queries; those of the corpus operators have tests of their own.
OWN = {name: fn for name, fn in entry.queries().items() if name in entry._QUERIES}
TABLES = "region nation customer supplier part orders lineitem events".split()


def test_entry_smoke(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["year_num", "month_num", "month_name", "revenue"]


def test_outputs_are_portable_types(spark):
    from pyspark.sql import types as T

    for name, fn in OWN.items():
        for f in fn(spark, SF_SMALL).schema.fields:
            assert not isinstance(f.dataType, (T.DecimalType, T.DateType)), (name, f.name)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_no_query_named_with_reserved_patterns():
    for name in OWN:
        assert not re.match(r"op\d+_", name)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(OWN))
def test_query_matches_oracle_at_smallest_scale(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    got = sorted(tuple(str(v) for v in r) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    want = sorted(tuple(str(r[i]) for i in order) for r in rel.fetchall())
    assert len(got) == len(want)
    assert got == want
