"""The batch runner: watermarks, clocks, failures, CSV rejects, plans."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from fixtures import AS_OF, apply_changes, freeze, generate
from starmart import schemas
from starmart.operators import analytics
from starmart.operators.facts import not_yet_loaded
from starmart.operators.keys import assign_surrogate_keys
from starmart.plans.batch import now_ts, run_batch, run_staged
from starmart.plans.compaction import compact
from starmart.plans.warehouse import TABLES, Warehouse
from starmart.session import apply_conf, scratch_tables
from starmart.sources import testdata as td
from starmart.sources.oltp import csv_clean, csv_rejects, read_sources, read_table

H = dt.timedelta(hours=1)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _users(spark, rows):
    return spark.createDataFrame([(i, f"n{i}", f"u{i}@x", city, "UK", AS_OF, ts) for i, city, ts in rows], schemas.USERS)


def test_a_micro_batch_does_not_move_the_watermark(spark, tmp_path):
    root = str(tmp_path)
    wh = Warehouse(spark, root)
    empty = {n: schemas.empty(spark, s) for n, s in schemas.SOURCES.items()}
    run_batch(spark, lambda: {**empty, "users": _users(spark, [(1, "Rome", AS_OF)])}, root, run_ts=AS_OF + H)
    later = lambda: {**empty, "users": _users(spark, [(1, "Oslo", AS_OF + 2 * H), (2, "Bonn", AS_OF + 2 * H)])}
    run_staged(spark, wh, {}, run_ts=AS_OF + 3 * H, keep_watermark=True)
    r = run_batch(spark, later, root, run_ts=AS_OF + 4 * H)
    assert r.rows["TRANSFORM"] == 2 and r.rows["SCD_LOAD"] == 2
    active = wh.snapshot().dim_customer_active
    assert {(x.user_id, x.city) for x in active.collect()} == {(1, "Oslo"), (2, "Bonn")}


def test_files_that_land_after_the_listing_belong_to_the_next_batch(spark, tmp_path):
    src, root = str(tmp_path / "src"), str(tmp_path / "wh")
    empty = {n: schemas.empty(spark, s) for n, s in schemas.SOURCES.items()}

    def land(part, rows):
        _users(spark, rows).write.mode("append").parquet(os.path.join(src, "users.parquet"))

    def load():
        tables = {**empty, "users": read_table(spark, os.path.join(src, "users.parquet"), schemas.USERS)}
        return tables

    land(0, [(1, "Rome", AS_OF)])
    seen = []

    def load_while_a_file_lands():
        tables = load()
        seen.append(tables)
        land(1, [(2, "Bonn", AS_OF + 1.5 * H)])  # stamped after this batch's run stamp
        return tables

    run_batch(spark, load_while_a_file_lands, root, run_ts=AS_OF + H)
    run_batch(spark, load, root, run_ts=AS_OF + 2 * H)
    assert {x.user_id for x in Warehouse(spark, root).snapshot().dim_customer_active.collect()} == {1, 2}


def test_run_stamp_is_sparks_clock(spark):
    there = spark.sql("SELECT localtimestamp() AS t").first().t
    assert abs((now_ts(spark) - there).total_seconds()) < 60 and now_ts(spark).microsecond == 0


@pytest.mark.parametrize("what", ["column", "loader"])
def test_a_failure_in_the_extract_is_recorded(spark, tmp_path, what):
    root = str(tmp_path)
    wh = Warehouse(spark, root)
    good = {n: schemas.empty(spark, s) for n, s in schemas.SOURCES.items()} | {"users": _users(spark, [(1, "Rome", AS_OF)])}
    run_batch(spark, good, root, run_ts=AS_OF + H)

    def bad():
        if what == "loader":
            raise OSError("source is away")
        return {**good, "users": good["users"].drop("last_updated")}

    r = run_batch(spark, bad, root, run_ts=AS_OF + 2 * H, swallow=True)
    snap = wh.snapshot()
    assert r.status == "FAILED" and snap.etl_error_log.count() == 1
    assert [x.status for x in snap.etl_log.orderBy("etl_id").collect()][-1] == "FAILED"
    assert entry.high_watermark(snap.etl_log).first()[0] == AS_OF + H


def test_csv_rejects_for_any_columns_and_all_tables(spark, tmp_path):
    lines = {
        "users": ["1,a,a@x,Rome,IT,2026-01-01 00:00:00,2026-01-01 00:00:00", "x,b,b@x,Rome,IT,2026-01-01 00:00:00,2026-01-01 00:00:00"],
        "products": ["1,P,Books,10.00,2026-01-01 00:00:00", "2,Q,Books,abc,2026-01-01 00:00:00"],
        "orders": ["1,1,2026-01-01 00:00:00,5.00,PLACED,2026-01-01 00:00:00", "2,1,yesterday,5.00,PLACED,2026-01-01 00:00:00"],
        "order_items": ["1,1,1,2,5.00", "2,1,1,two,5.00"],
        "payments": ["1,1,CARD,SUCCESS,2026-01-01 00:00:00", "2,one,CARD,SUCCESS,2026-01-01 00:00:00"],
    }
    for name, rows in lines.items():
        (tmp_path / f"{name}.csv").write_text("\n".join([",".join(schemas.SOURCES[name].fieldNames()), *rows]) + "\n")
    for name, df in read_sources(spark, str(tmp_path), fmt="csv", mode="PERMISSIVE").items():
        assert csv_clean(df).count() == 1 and csv_rejects(df).count() == 1, name
        assert csv_rejects(df).first()[0] == lines[name][1]
        for c in schemas.SOURCES[name].fieldNames():
            assert len(csv_clean(df).select(c).collect()) == 1, (name, c)


def test_listings_do_not_grow_with_batches(spark, tmp_path, monkeypatch):
    wh = Warehouse(spark, str(tmp_path))
    for _ in range(3):
        run_staged(spark, wh, {}, run_ts=AS_OF + H)
    listed = []
    real = Warehouse._batches
    monkeypatch.setattr(Warehouse, "_batches", lambda self, t: listed.append(t) or real(self, t))
    wh.snapshot()
    few = len(listed)
    for seq in range(4, 54):  # 50 more committed batches, of their log rows alone
        wh.write(wh.read("etl_log", schemas.ETL_LOG, [1]).drop("batch_seq"), "etl_log", seq)
    listed.clear()
    assert len(wh.snapshot().committed) == 53 and len(listed) == few


def test_next_seq_passes_over_any_leftover(spark, tmp_path):
    for table in TABLES:
        wh = Warehouse(spark, str(tmp_path / table.replace("/", "_")))
        wh.write(spark.range(1), table, 7)
        assert wh.next_seq() == 8, table


def test_compaction_folds_only_what_came_since(spark, tmp_path):
    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    root = str(tmp_path / "wh")
    run_batch(spark, src, root, run_ts=AS_OF + H)
    assert compact(spark, root).rows["COMPACT"] == 4500
    changed = freeze(apply_changes(spark, src, AS_OF + 2 * H), str(tmp_path / "src2"), spark)
    run_batch(spark, changed, root, run_ts=AS_OF + 3 * H)
    assert compact(spark, root).rows["COMPACT"] == 2
    s = Warehouse(spark, root).snapshot()
    assert s.fact_sales.count() == 4502 and s.fact_sales.select("sale_id").distinct().count() == 4502
    assert s.dim_customer.count() == 1001 and s.dim_customer_active.count() == 1000


# ------------------------------------------------------------------- plans
def test_keys_number_no_rows_in_a_single_partition(spark):
    df = spark.range(0, 300_000).select((F.col("id") * 3).alias("a"), F.col("id").alias("b"))
    for key in (["a"], ["a", "b"]):
        keyed = assign_surrogate_keys(df, key, "k")
        for part in plan(keyed).split("Exchange SinglePartition")[1:]:
            assert "max(_k1_place" in part[:600]  # only the size of each range partition
        assert keyed.where(F.col("k") != F.col("b") + 1).count() == 0


def test_top_customers_moves_no_string_at_order_grain(spark):
    s = entry._star(spark, SF_SMALL)
    p = plan(analytics.top_customers(s.fact_sales, s.dim_customer))
    grain = [x for x in p.split("\n") if "Exchange hashpartitioning" in x and "order_id" in x]
    assert 0 < len(grain) <= 2 and not any("name" in x or "city" in x for x in grain)


def test_reload_is_one_anti_join(spark):
    facts = schemas.empty(spark, schemas.FACT_SALES).withColumn("sales_year", F.lit(2000))
    cands = schemas.empty(spark, schemas.FACT_CANDIDATES)
    p = not_yet_loaded(cands, facts)._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("Join LeftAnti") <= 1 and "LeftSemi" not in p


# ------------------------------------------------ bytes moved at scale
def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_numbered_rows_are_shuffled_by_their_range_only(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    spark.conf.set(threshold, "-1")  # as with rows beyond any threshold
    try:
        p = plan(assign_surrogate_keys(spark.range(0, 5000).select((F.col("id") * 3).alias("a"), F.col("id").alias("b")), ["a"], "k"))
    finally:
        spark.conf.set(threshold, before)
    assert "BroadcastHashJoin" in p and "SortMergeJoin" not in p
    assert not any("Exchange" in x and "_k1_of" in x and "hashpartitioning" in x for x in p.split("\n"))


def test_numbering_writes_the_kept_columns_only(spark):
    df = spark.range(0, 100).select((100 - F.col("id")).alias("a"), F.col("id").alias("b"), F.lit("x").alias("c"))
    keyed = assign_surrogate_keys(df, ["a", "c"], "k", keep=[F.col("b").cast("int").alias("b")])
    assert keyed.columns == ["b", "k"] and [tuple(r) for r in keyed.orderBy("k").limit(2).collect()] == [(99, 1), (98, 2)]
    assert set(spark.read.parquet(*keyed.inputFiles()).columns) == {"b", "_k1_group", "_k1_place"}


def test_keyed_items_are_written_once_and_outlive_the_batch(spark, tmp_root):
    rows = [(o, p, 1, n, float(n), 10.0 * n, f"2000-01-0{n} 00:00:00") for o in (1, 2) for p in (5, 6) for n in (1, 2)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, ship string").select(
        "*", F.col("ship").cast("timestamp_ntz").alias("l_shipdate")).drop("ship").write.parquet(f"{tmp_root}/lineitem.parquet")
    with scratch_tables():
        items = td.order_items(spark, tmp_root)
    tables = {f.split("/tables/")[1].split("/")[0] for f in items.inputFiles()}
    assert len(tables) == 1 and items.count() == 8
    assert set(spark.read.parquet(*items.inputFiles()).columns) == {"order_id", "product_id", "quantity", "price", "_k1_group", "_k1_place"}
    got = sorted(tuple(r) for r in items.select("order_item_id", "order_id", "product_id", "quantity", F.col("price").cast("double")).collect())
    want = sorted((o, n, p, q, x) for o, p, _, n, q, x, _ in rows)
    assert got == [(i, o, p, int(q), x) for i, (o, n, p, q, x) in enumerate(want, 1)]


def test_first_batch_joins_nothing_with_empty_tables(spark):
    facts = schemas.empty(spark, schemas.FACT_SALES).withColumn("sales_year", F.lit(2000))
    cands = spark.range(3).select(F.col("id").alias("source_order_item_id"), F.lit(20200101).alias("date_key"))
    for match_on in ("split", "combined"):
        fresh = not_yet_loaded(cands, facts, match_on)
        assert "Join" not in _optimized(fresh) and fresh.count() == 3


def test_reload_by_item_reads_the_batchs_items_only(spark, tmp_root):
    spark.range(0, 1000).select(F.col("id").alias("source_order_item_id"), F.lit(20200101).alias("date_key")).write.parquet(f"{tmp_root}/facts")
    facts = spark.read.parquet(f"{tmp_root}/facts")
    cands = spark.createDataFrame([(998, 20200102), (1001, 20200102), (None, 20200102)], "source_order_item_id long, date_key int")
    fresh = not_yet_loaded(cands, facts, "combined")
    assert {r[0] for r in fresh.collect()} == {1001, None}
    p = _optimized(fresh)
    assert "source_order_item_id" in p and ">= scalar-subquery" in p and "<= scalar-subquery" in p
    assert {r[0] for r in not_yet_loaded(cands.where("source_order_item_id IS NULL"), facts, "combined").collect()} == {None}


def test_money_sums_join_the_fact_once(spark):
    # numbering an order's customer and product takes a join of its own each
    p = _optimized(entry._QUERIES["money_exact"](spark, SF_SMALL))
    assert p.count("l_returnflag") == 1


def test_broadcast_threshold_is_lowered_never_raised(spark):
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        for given, kept in (("10485760b", str(1 << 20)), ("10MB", str(1 << 20)), ("256k", "256k"), ("-1", "-1")):
            spark.conf.set(threshold, given)
            apply_conf(spark)
            assert spark.conf.get(threshold) == kept
    finally:
        spark.conf.set(threshold, before)
