"""Plan properties: the shapes the design relies on, read from the
optimized physical plans (no execution)."""

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from starmart.operators import analytics
from starmart.operators.extract import changed_since, extract
from starmart.sources import testdata as td


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_extract_uses_semi_joins_and_pushes_the_watermark(spark):
    src = td.sources(spark, SF_SMALL, with_item_ids=False)
    st = extract(src, "2000-07-01 00:00:00")
    p = plan(st["order_items"])
    assert "LeftSemi" in p and "Or(Or(" in p[p.index("PushedFilters"):]  # the staged ids' intervals reach the scan
    o = plan(changed_since(src["orders"], "2000-07-01 00:00:00"))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThan(o_orderdate" in o


def test_no_python_udf_in_any_registered_query(spark):
    for name, fn in entry._QUERIES.items():
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_analytics_reduce_the_fact_before_joining(spark):
    s = entry._star(spark, SF_SMALL)
    p = plan(analytics.revenue_by_month(s.fact_sales, s.dim_date))
    # Two aggregations: per date_key (below the join) and per month (above).
    assert p.count("HashAggregate") >= 4
    assert p.index("keys=[date_key") > p.index("Join")  # the per-day aggregate is under the join


@pytest.mark.parametrize("name", ["top_customers", "top_products"])
def test_top_k_is_not_a_full_sort(spark, name):
    p = plan(entry.queries()[name](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p


def test_fact_load_reads_only_needed_columns(spark):
    s = entry._star(spark, SF_SMALL)
    p = plan(analytics.weekday_weekend_revenue(s.fact_sales, s.dim_date))
    assert "l_shipdate" not in p and "l_suppkey" not in p


def test_watermark_prunes_date_partitioned_sources(spark, tmp_path):
    from pyspark.sql import functions as F

    from starmart import schemas
    from starmart.operators.extract import changed_since
    from starmart.sources.oltp import read_table, write_sources

    src = td.sources(spark, SF_SMALL, with_item_ids=False)
    write_sources({"orders": src["orders"]}, str(tmp_path), date_partitioned=True)
    orders = read_table(spark, str(tmp_path / "orders.parquet"), schemas.ORDERS)
    staged = changed_since(orders, "2001-07-01 00:00:00")
    p = plan(staged)
    assert "PartitionFilters: [isnotnull(last_updated_date" in p and ">= 2001-07-01" in p
    want = src["orders"].where(F.col("last_updated") > F.lit("2001-07-01 00:00:00").cast("timestamp_ntz")).count()
    assert staged.count() == want
