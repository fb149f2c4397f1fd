"""Golden two-batch scenario, re-run idempotency and the failure path."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from fixtures import AS_OF, apply_changes, freeze, generate
from starmart.operators import analytics
from starmart.operators.quality import row_count_audit
from starmart.plans.batch import BatchError, run_batch
from starmart.plans.warehouse import Warehouse

H = dt.timedelta(hours=1)


def _phase_rows(wh, seq):
    log = wh.snapshot().etl_log
    return {r["phase"]: r["rows_affected"] for r in log.where(F.col("etl_id") > 0).collect()
            if r["batch_id"] == _batch_id(wh, seq)}


def _batch_id(wh, seq):
    return wh.read("etl_log", __import__("starmart").schemas.ETL_LOG, [seq]).first()["batch_id"]


@pytest.fixture(scope="module")
def golden(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("golden"))
    src1 = freeze(generate(spark), os.path.join(base, "src1"), spark)
    root = os.path.join(base, "wh")
    r1 = run_batch(spark, src1, root, run_ts=AS_OF + H)
    wh = Warehouse(spark, root)
    snap1 = wh.snapshot()
    after1 = {
        "facts": snap1.fact_sales.count(),
        "customers": snap1.dim_customer.count(),
        "products": snap1.dim_product.count(),
        "dates": snap1.dim_date.count(),
        "fact_stats": snap1.fact_sales.agg(
            F.countDistinct("product_key"), F.countDistinct("customer_key"), F.countDistinct("order_id"),
            F.sum("quantity")).first(),
        "unknown_country": snap1.dim_customer.where("country = 'Unknown'").count(),
    }
    src2 = freeze(apply_changes(spark, src1, AS_OF + 2 * H), os.path.join(base, "src2"), spark)
    r2 = run_batch(spark, src2, root, run_ts=AS_OF + 3 * H)
    r3 = run_batch(spark, src2, root, run_ts=AS_OF + 4 * H)
    return {"r1": r1, "r2": r2, "r3": r3, "after1": after1, "wh": wh, "src2": src2}


def test_batch1_counts(golden):
    a = golden["after1"]
    assert golden["r1"].rows == {"EXTRACT": 2500, "TRANSFORM": 1000, "SCD_LOAD": 1000,
                                 "FACT_INCREMENTAL": 4500, "RUN": 1}
    assert (a["facts"], a["customers"], a["products"], a["dates"]) == (4500, 1000, 300, 365)
    assert tuple(a["fact_stats"])[:3] == (225, 750, 1875)
    assert a["fact_stats"][3] == 13500
    assert a["unknown_country"] == 40


def test_batch2_scd_and_incremental(golden):
    assert golden["r2"].rows == {"EXTRACT": 1, "TRANSFORM": 1, "SCD_LOAD": 1, "FACT_INCREMENTAL": 2, "RUN": 1}
    s = golden["wh"].snapshot()
    assert s.fact_sales.count() == 4502
    assert s.dim_customer.count() == 1001
    assert s.dim_customer.where("is_active = 1").count() == 1000
    v = s.dim_customer.where("user_id = 101").orderBy("customer_key").collect()
    assert [r["is_active"] for r in v] == [0, 1]
    assert v[1]["city"] == "Delhi NCR" and v[0]["end_date"] == v[1]["start_date"]
    p = s.dim_product.where("product_id = 20").collect()
    assert len(p) == 1 and s.dim_product.count() == 300
    assert s.fact_sales.select(F.countDistinct("product_key")).first()[0] == 226
    per_key = {r["customer_key"]: (r["n"], r["amt"]) for r in
               s.fact_sales.where(F.col("customer_key").isin([x["customer_key"] for x in v]))
               .groupBy("customer_key").agg(F.count("*").alias("n"), F.sum("total_amount").alias("amt")).collect()}
    assert per_key[v[0]["customer_key"]][0] == 7
    assert per_key[v[1]["customer_key"]] == (2, __import__("decimal").Decimal("3997.00"))
    # Merge-on-read: the batch wrote the one opened and the one closed
    # version, not the active set.
    from starmart import schemas
    seq2 = golden["r2"].seq
    assert golden["wh"].read("dim_customer_versions", schemas.DIM_CUSTOMER, [seq2]).count() == 1
    assert golden["wh"].read("dim_customer_closed", schemas.DIM_CUSTOMER, [seq2]).count() == 1
    assert golden["wh"].read("dim_product", schemas.DIM_PRODUCT, [seq2]).count() == 1
    # Top-customer groups before the limit: user 101 is split in two.
    groups = analytics.top_customers(s.fact_sales, s.dim_customer, k=100000).count()
    assert groups == 751


def test_batch3_no_changes(golden):
    assert golden["r3"].rows == {"EXTRACT": 0, "TRANSFORM": 0, "SCD_LOAD": 0, "FACT_INCREMENTAL": 0, "RUN": 1}
    s = golden["wh"].snapshot()
    assert s.fact_sales.count() == 4502 and s.dim_customer.count() == 1001
    assert s.etl_log.count() == 15


def test_row_count_audit(golden):
    src = golden["src2"]
    got = {r["table_name"]: r["row_count"] for r in row_count_audit(src).collect()}
    assert got == {"users": 1000, "products": 300, "orders": 2501, "order_items": 6002, "payments": 2501}


def test_invariants(golden):
    s = golden["wh"].snapshot()
    dup_active = s.dim_customer.where("is_active = 1").groupBy("user_id").count().where("count > 1").count()
    assert dup_active == 0
    assert s.fact_sales.groupBy("sale_id").count().where("count > 1").count() == 0
    assert s.dim_customer.groupBy("customer_key").count().where("count > 1").count() == 0


def test_failure_publishes_nothing(spark, tmp_path):
    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    root = str(tmp_path / "wh")
    run_batch(spark, src, root, run_ts=AS_OF + H)
    changed = freeze(apply_changes(spark, src, AS_OF + 2 * H), str(tmp_path / "src2"), spark)
    wh = Warehouse(spark, root)
    before = wh.snapshot()
    with pytest.raises(BatchError):
        run_batch(spark, changed, root, run_ts=AS_OF + 3 * H, fail_at="dims")
    after = wh.snapshot()
    assert after.seq == before.seq
    assert after.dim_customer.count() == 1000 and after.fact_sales.count() == 4500
    failed = after.etl_log.where("status = 'FAILED'").collect()
    assert len(failed) == 1 and failed[0]["phase"] == "RUN" and failed[0]["rows_affected"] == 0
    assert after.etl_error_log.count() == 1
    # Watermark did not move: the retry picks the same changes up.
    r = run_batch(spark, changed, root, run_ts=AS_OF + 4 * H)
    assert r.rows["FACT_INCREMENTAL"] == 2
    assert wh.snapshot().fact_sales.count() == 4502


def test_swallow_returns_failed(spark, tmp_path):
    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    r = run_batch(spark, src, str(tmp_path / "wh"), run_ts=AS_OF + H, fail_at="transform", swallow=True)
    assert r.status == "FAILED"


def test_combined_variant_phases(spark, tmp_path):
    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    r = run_batch(spark, src, str(tmp_path / "wh"), run_ts=AS_OF + H, variant="combined")
    assert r.rows == {"EXTRACT": 2500, "TRANSFORM": 1000, "LOAD": 4500, "RUN": 1}


def test_overlap_restages_but_adds_nothing(spark, tmp_path):
    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    root = str(tmp_path / "wh")
    run_batch(spark, src, root, run_ts=AS_OF + H)
    r = run_batch(spark, src, root, run_ts=AS_OF + 2 * H, overlap=dt.timedelta(days=400))
    assert r.rows["EXTRACT"] == 2500 and r.rows["FACT_INCREMENTAL"] == 0 and r.rows["SCD_LOAD"] == 0
    s = Warehouse(spark, root).snapshot()
    assert s.fact_sales.count() == 4500 and s.dim_customer.count() == 1000 and s.dim_date.count() == 365


def test_compaction_keeps_state_and_later_batches_work(spark, tmp_path):
    from starmart.plans.compaction import compact, superseded_paths

    src = freeze(generate(spark), str(tmp_path / "src"), spark)
    root = str(tmp_path / "wh")
    run_batch(spark, src, root, run_ts=AS_OF + H)
    changed = freeze(apply_changes(spark, src, AS_OF + 2 * H), str(tmp_path / "src2"), spark)
    run_batch(spark, changed, root, run_ts=AS_OF + 3 * H)
    wh = Warehouse(spark, root)
    before = wh.snapshot()
    want = sorted(tuple(r) for r in before.fact_sales.drop("sales_year").collect())
    r = compact(spark, root)
    assert r.rows["COMPACT"] == 4502
    after = wh.snapshot()
    assert sorted(tuple(r) for r in after.fact_sales.drop("sales_year").collect()) == want
    assert after.dim_customer.count() == 1001 and after.dim_date.count() == before.dim_date.count()
    assert after.max_keys == before.max_keys
    gone = superseded_paths(spark, root)
    assert len(gone) == 12  # 2 batches x 5 tables, and their log rows
    log = sorted(map(tuple, before.etl_log.collect()))
    import shutil

    for path in gone:  # storage retention
        shutil.rmtree(path)
    assert [x for x in sorted(map(tuple, wh.snapshot().etl_log.collect())) if x[0] <= len(log)] == log
    assert wh.committed_batches() == [1, 2, 3]
    # The watermark did not move and a later batch still loads idempotently.
    r2 = run_batch(spark, changed, root, run_ts=AS_OF + 4 * H)
    assert r2.rows["EXTRACT"] == 0 and r2.rows["FACT_INCREMENTAL"] == 0
    r3 = run_batch(spark, changed, root, run_ts=AS_OF + 5 * H, overlap=dt.timedelta(hours=3))
    assert r3.rows["EXTRACT"] == 1 and r3.rows["FACT_INCREMENTAL"] == 0
    assert wh.snapshot().fact_sales.count() == 4502


def test_staging_rejects_nulls_and_duplicates(spark, tmp_path):
    from starmart.plans.batch import check_staging
    from starmart import schemas

    users = spark.createDataFrame([(1, "a", None, None, None, AS_OF, AS_OF)], schemas.USERS.simpleString()
                                  .replace("struct<", "").replace(">", "").replace(":", " "))
    with pytest.raises(BatchError, match="users: NULL in email"):
        check_staging({"users": users})
    dup = generate(spark)["orders"].limit(3)
    with pytest.raises(BatchError, match="orders: duplicate"):
        check_staging({"orders": dup.unionByName(dup)})
    check_staging({"orders": dup})
