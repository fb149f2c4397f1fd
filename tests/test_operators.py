"""Small hand-made fixtures, one per semantic hazard."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import calendar_columns, date_key, is_blank, line_amount, pick, range_label
from starmart.operators.clean import dedup_by_email, fill_unknown
from starmart.operators.dims import initial_customers, initial_products, new_dates, scd1_upsert, scd2_apply
from starmart.operators.extract import changed_since, children_of, high_watermark
from starmart.operators.facts import fact_candidates, fact_rejects, load_facts
from starmart.operators.keys import assign_surrogate_keys
from starmart.operators.maintain import refresh_order_totals
from starmart.operators.quality import (decimal_violations, duplicate_keys, length_violations, null_counts,
                                        orphans)

T0 = dt.datetime(2026, 1, 1)


def users_df(spark, rows):
    return spark.createDataFrame(
        [(uid, f"U{uid}", email, city, country, T0, T0) for uid, email, city, country in rows],
        schemas.USERS)


def test_blank_fill(spark):
    df = users_df(spark, [(1, "a", "x", None), (2, "b", "x", ""), (3, "c", "x", "  "), (4, "d", "x", "\t"),
                          (5, "e", "x", "UK")])
    got = [r.country for r in fill_unknown(df).orderBy("user_id").collect()]
    assert got == ["Unknown", "Unknown", "Unknown", "\t", "UK"]


def test_is_blank_tab_is_not_blank(spark):
    df = spark.createDataFrame([(" ",), ("\t",), (None,)], "x string")
    assert [r[0] for r in df.select(is_blank("x")).collect()] == [True, False, True]


def test_dedup_binary_and_case_insensitive(spark):
    df = users_df(spark, [(1, "a@x", "c", "k"), (2, "a@x", "c", "k"), (5, "a@x", "c", "k"),
                          (3, "b@x", "c", "k"), (4, "A@x", "c", "k")])
    assert sorted(r.user_id for r in dedup_by_email(df).collect()) == [1, 3, 4]
    assert sorted(r.user_id for r in dedup_by_email(df, case_insensitive=True).collect()) == [1, 3]


def test_dedup_keeps_null_email_rows(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "z")], "user_id long, email string")
    assert sorted(r.user_id for r in dedup_by_email(df).collect()) == [1, 2, 3]


def test_watermark_is_strict(spark):
    df = spark.createDataFrame([(1, T0), (2, T0 + dt.timedelta(seconds=1))], "id int, last_updated timestamp_ntz")
    assert [r.id for r in changed_since(df, T0).collect()] == [2]


def test_child_capture_needs_restamped_order(spark):
    items = spark.createDataFrame([(1, 10), (2, 11)], "order_item_id long, order_id long")
    staged_orders = spark.createDataFrame([(10,)], "order_id long")
    assert [r.order_item_id for r in children_of(items, staged_orders).collect()] == [1]


def test_high_watermark_ignores_failures_and_defaults(spark):
    log = spark.createDataFrame([("SUCCESS", T0), ("FAILED", T0 + dt.timedelta(days=1))],
                                "status string, last_loaded_time timestamp_ntz")
    assert high_watermark(log).first()[0] == T0
    assert high_watermark(log.where("false")).first()[0] == dt.datetime(1900, 1, 1)


def test_scd2_change_rules(spark):
    base = users_df(spark, [(1, "a@x", "Pune", None), (2, "b@x", "Pune", "UK"), (3, "c@x", "Pune", "UK")])
    dim = initial_customers(base, T0)
    staged = users_df(spark, [
        (1, "a@x", "Pune", ""),        # NULL vs '' -> unchanged
        (2, "b@x", "Delhi", "UK"),     # changed -> expire + new version
        (4, "d@x", "Goa", "IN"),       # new user
    ])
    run2 = dt.datetime(2026, 2, 1)
    out = scd2_apply(dim, staged, run2)
    rows = {(r.user_id, r.is_active): r for r in out.collect()}
    assert out.count() == 5
    assert rows[(2, 0)].end_date == run2 and rows[(2, 1)].start_date == run2
    assert rows[(2, 1)].city == "Delhi" and rows[(4, 1)].customer_key == 5
    assert rows[(2, 1)].customer_key == 4  # next keys in user_id order: 2 -> 4, 4 -> 5
    assert rows[(1, 1)].end_date is None and (1, 0) not in rows
    # Already-closed history is carried through untouched.
    again = scd2_apply(out, staged, dt.datetime(2026, 3, 1))
    assert again.count() == 5


def test_scd1_upsert_overwrites_and_appends(spark):
    p = spark.createDataFrame([(1, "P1", "Books", Decimal("10.00"), T0), (2, "P2", "Toys", Decimal("5.00"), T0)],
                              schemas.PRODUCTS)
    dim = initial_products(p)
    inc = spark.createDataFrame([(2, "P2b", "Toys", Decimal("7.50"), T0), (9, "P9", "Home", Decimal("1.00"), T0)],
                                schemas.PRODUCTS)
    out = {r.product_id: r for r in scd1_upsert(dim, inc).collect()}
    assert out[2].product_key == 2 and out[2].price == Decimal("7.50") and out[2].product_name == "P2b"
    assert out[9].product_key == 3 and out[1].product_name == "P1"


def test_new_dates_and_calendar(spark):
    orders = spark.createDataFrame([(dt.datetime(2027, 1, 1, 5),), (dt.datetime(2024, 12, 30, 23),),
                                    (dt.datetime(2024, 12, 30, 1),)], "order_date timestamp_ntz")
    out = {r.date_key: r for r in new_dates(orders, schemas.empty(spark, schemas.DIM_DATE)).collect()}
    assert set(out) == {20270101, 20241230}
    assert (out[20270101].week_of_year, out[20270101].year_num) == (53, 2027)
    assert (out[20241230].week_of_year, out[20241230].year_num) == (1, 2024)
    assert out[20270101].month_name == "January" and out[20270101].is_weekend == 0
    again = new_dates(orders, new_dates(orders, schemas.empty(spark, schemas.DIM_DATE)))
    assert again.count() == 0


def test_range_label(spark):
    df = spark.createDataFrame([(20241231,), (20250101,), (20271231,), (20280101,)], "k int")
    assert [r[0] for r in df.select(range_label("k")).collect()] == ["p_before_2025", "p_2025", "p_2027", "p_max"]


def test_pick_out_of_range_is_null(spark):
    df = spark.createDataFrame([(1,), (3,), (4,)], "i int")
    assert [r[0] for r in df.select(pick("i", ["a", "b", "c"])).collect()] == ["a", "c", None]


def test_line_amount_half_up(spark):
    df = spark.createDataFrame([(3, Decimal("0.35"))], "q int, p decimal(12,2)")
    assert df.select(line_amount("q", "p")).first()[0] == Decimal("1.05")


def _star_inputs(spark):
    users = users_df(spark, [(1, "a@x", "c", "k"), (2, "b@x", "c", "k")])
    cust = initial_customers(users, T0)
    prod = initial_products(spark.createDataFrame([(7, "P7", "Books", Decimal("2.00"), T0)], schemas.PRODUCTS))
    orders = spark.createDataFrame([
        (100, 1, dt.datetime(2026, 3, 1, 10), Decimal("0"), "DELIVERED", T0),
        (101, 2, dt.datetime(2026, 3, 2), Decimal("0"), "CANCELLED", T0),
        (102, 3, dt.datetime(2026, 3, 3), Decimal("0"), "PLACED", T0),
    ], schemas.ORDERS)
    items = spark.createDataFrame([
        (1, 100, 7, 2, Decimal("2.00")), (2, 100, 8, 1, Decimal("1.00")),
        (3, 101, 7, 1, Decimal("2.00")), (4, 102, 7, 1, Decimal("2.00")),
    ], schemas.ORDER_ITEMS)
    return users, cust, prod, orders, items


def test_fact_load_cancelled_orphans_and_idempotency(spark):
    _, cust, prod, orders, items = _star_inputs(spark)
    cands = fact_candidates(items, orders, cust, prod)
    empty = schemas.empty(spark, schemas.FACT_SALES)
    first = load_facts(cands, empty, T0)
    rows = first.collect()
    assert [(r.source_order_item_id, r.date_key, r.total_amount) for r in rows] == [(1, 20260301, Decimal("4.00"))]
    assert load_facts(cands, first, T0).count() == 0
    rejects = {r.order_item_id: r.reason for r in fact_rejects(items, orders, cust, prod).collect()}
    assert rejects == {2: "unknown product", 4: "no active customer"}


def test_moved_order_date_split_vs_combined(spark):
    _, cust, prod, orders, items = _star_inputs(spark)
    first = load_facts(fact_candidates(items, orders, cust, prod), schemas.empty(spark, schemas.FACT_SALES), T0)
    moved = orders.withColumn("order_date", F.when(F.col("order_id") == 100, F.lit(dt.datetime(2026, 3, 5)))
                              .otherwise(F.col("order_date")))
    cands = fact_candidates(items, moved, cust, prod)
    split = load_facts(cands, first, T0, match_on="split").collect()
    assert [(r.source_order_item_id, r.date_key, r.sale_id) for r in split] == [(1, 20260305, 2)]
    assert load_facts(cands, first, T0, match_on="combined").count() == 0


def test_surrogate_keys_match_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") % 37).alias("a"), (F.col("id") * 7919 % 5000).alias("b"))
    ref = df.withColumn("r", F.row_number().over(Window.orderBy("a", "b")) + 10)
    for bound in (None, 10 ** 12):  # single-task window, distributed numbering
        keyed = assign_surrogate_keys(df, ["a", "b"], "k", base=10, num_partitions=7)
        assert keyed.join(ref, ["a", "b"]).where("k != r").count() == 0
        assert keyed.select(F.countDistinct("k"), F.min("k"), F.max("k")).first() == (5000, 11, 5010)


def test_surrogate_keys_distributed_over_join_input(spark):
    # Input downstream of a shuffle: the numbering must still be dense.
    left = spark.range(0, 4000).select(F.col("id").alias("a"), (F.col("id") % 50).alias("g"))
    right = spark.range(0, 50).select(F.col("id").alias("g"), (F.col("id") * 3).alias("w"))
    df = left.join(right.hint("shuffle_hash"), "g").select("a", "w")
    keyed = assign_surrogate_keys(df, ["a"], "k", num_partitions=5)
    assert keyed.select(F.countDistinct("k"), F.min("k"), F.max("k")).first() == (4000, 1, 4000)
    assert keyed.where("k != a + 1").count() == 0


def test_surrogate_keys_skewed_leading_column(spark):
    # A third of the rows share one leading value: range partitioning on the
    # full key still splits them.
    df = spark.range(0, 3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("a"),
                                     F.col("id").alias("b"))
    keyed = assign_surrogate_keys(df, ["a", "b"], "k", num_partitions=6)
    ranged = df.repartitionByRange(6, "a", "b")
    sizes = ranged.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 1000
    assert keyed.select(F.countDistinct("k")).first()[0] == 3000


def test_quality_checks(spark):
    u = users_df(spark, [(1, "a@x", None, "UK"), (2, "a@x", "c" * 101, None)])
    assert [tuple(r) for r in duplicate_keys(u, ["email"]).collect()] == [("a@x", 2)]
    nulls = {r.column_name: r.null_count for r in null_counts(u).collect()}
    assert nulls["city"] == 1 and nulls["country"] == 1 and nulls["user_id"] == 0
    lens = {r.column_name: r.violations for r in length_violations(u, {"city": 100}).collect()}
    assert lens == {"city": 1}
    orders = spark.createDataFrame([(1, 1), (2, 9)], "order_id long, user_id long")
    assert [r.order_id for r in orphans(orders, u, "user_id").collect()] == [2]
    money = spark.createDataFrame([(Decimal("12345678901.00"),), (Decimal("1.00"),)], "v decimal(20,2)")
    assert decimal_violations(money, "v", 12, 2).count() == 1


def test_refresh_totals_keeps_orders_without_items(spark):
    orders = spark.createDataFrame([(1, Decimal("9.00"), T0), (2, Decimal("5.00"), T0)],
                                   "order_id long, total_amount decimal(12,2), last_updated timestamp_ntz")
    items = spark.createDataFrame([(1, 2, Decimal("1.25"))], "order_id long, quantity int, price decimal(12,2)")
    touch = dt.datetime(2026, 5, 1)
    out = {r.order_id: r for r in refresh_order_totals(orders, items, touch_ts=touch).collect()}
    assert out[1].total_amount == Decimal("2.50") and out[1].last_updated == touch
    assert out[2].total_amount == Decimal("5.00") and out[2].last_updated == T0


def test_date_key_and_calendar_match(spark):
    df = spark.createDataFrame([(dt.date(2026, 8, 9),)], "d date")
    r = df.select(date_key("d").alias("k"), *calendar_columns("d")).first()
    assert r.k == 20260809 and r.is_weekend == 1 and r.quarter_num == 3


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_source_roundtrip(spark, tmp_path, fmt):
    from starmart.sources.oltp import read_sources, write_sources

    users = users_df(spark, [(1, "a@x", "Pune", None)])
    tables = {n: schemas.empty(spark, s) for n, s in schemas.SOURCES.items()}
    tables["users"] = users
    write_sources(tables, str(tmp_path), fmt=fmt)
    back = read_sources(spark, str(tmp_path), fmt=fmt)
    assert back["users"].collect() == users.collect()
    assert [(f.name, f.dataType) for f in back["users"].schema] == [(f.name, f.dataType) for f in schemas.USERS]


def test_csv_permissive_reports_bad_rows(spark, tmp_path):
    from starmart.sources.oltp import csv_clean, csv_rejects, read_table

    p = tmp_path / "products.csv"
    p.write_text("product_id,product_name,category,price,last_updated\n"
                 "1,P1,Books,10.00,2026-01-01 00:00:00\n"
                 "x,P2,Books,oops,2026-01-01 00:00:00\n")
    df = read_table(spark, str(p), schemas.PRODUCTS, fmt="csv", mode="PERMISSIVE").cache()
    assert csv_clean(df).count() == 1 and csv_rejects(df).count() == 1
    df.unpersist()


def test_collation_option(spark):
    df = users_df(spark, [(1, "a@x", "Delhi", "k"), (2, "A@X", "c", "k"), (3, "b@x", "c", "k")])
    assert sorted(r.user_id for r in dedup_by_email(df, collation="UNICODE_CI_AI").collect()) == [1, 3]
    dim = initial_customers(users_df(spark, [(1, "a@x", "Delhi", "India")]), T0)
    staged = users_df(spark, [(1, "a@x", "délhi", "INDIA")])
    assert scd2_apply(dim, staged, dt.datetime(2026, 2, 1), collation="UNICODE_CI_AI").count() == 1
    assert scd2_apply(dim, staged, dt.datetime(2026, 2, 1)).count() == 2


def test_scd1_merge_on_read_equals_full_snapshot(spark):
    from starmart.operators.dims import latest_products, scd1_changes

    p = spark.createDataFrame([(i, f"P{i}", "Books", Decimal("10.00"), T0) for i in range(1, 6)], schemas.PRODUCTS)
    dim = initial_products(p)
    inc1 = spark.createDataFrame([(2, "P2b", "Toys", Decimal("7.50"), T0), (9, "P9", "Home", Decimal("1.00"), T0)],
                                 schemas.PRODUCTS)
    inc2 = spark.createDataFrame([(2, "P2c", "Toys", Decimal("8.00"), T0), (7, "P7", "Home", Decimal("2.00"), T0)],
                                 schemas.PRODUCTS)
    full = scd1_upsert(scd1_upsert(dim, inc1), inc2)
    c1 = scd1_changes(dim, inc1, 5)
    step1 = latest_products(dim, c1.withColumn("batch_seq", F.lit(2)))
    c2 = scd1_changes(step1, inc2, 6)
    later = c1.withColumn("batch_seq", F.lit(2)).unionByName(c2.withColumn("batch_seq", F.lit(3)))
    merged = latest_products(dim, later)
    assert sorted(tuple(r) for r in merged.collect()) == sorted(tuple(r) for r in full.collect())
    assert c1.count() == 2 and c2.count() == 2
