"""Work kept up to date: pruned scans, file-grain updates, totals, key
filters, CSV rejects, sparse keys, what the writes observe."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from conftest import SF_SMALL
from starmart import schemas
from starmart.operators import analytics
from starmart.operators.extract import changed_since, children_of, key_intervals, within
from starmart.operators.keyfilter import KeyFilter
from starmart.operators.keys import assign_surrogate_keys
from starmart.operators.maintain import refresh_order_totals
from starmart.plans.filetable import FileTable
from starmart.plans.totals import OrderTotals
from starmart.plans.warehouse import Warehouse
from starmart.session import discard, materialize, scratch_tables
from starmart.sources import testdata as td
from starmart.sources.imports import import_csv, parse_csv


def executed(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan()


def scanned(df, column):
    """Rows that the scans of files with ``column`` gave out when ``df`` ran."""
    total, todo = 0, [executed(df)]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
            continue
        if "QueryStage" in name:
            todo.append(node.plan())
            continue
        kids = node.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if name.startswith("Scan parquet") and column in node.simpleString(1000):
            total += node.metrics().apply("numOutputRows").value()
    return total


# ------------------------------------------------------------------ K1
@pytest.mark.parametrize("keys", ["sparse", "dense", "hot", "with null", "one row", "none"])
def test_surrogate_keys_are_the_rank(spark, keys):
    ids = spark.range(0, 3000)
    df = {"sparse": ids.select((F.col("id") * 70_000 - 10**8).alias("a"), F.lit(1).alias("b")), "dense": ids.select(F.col("id").alias("a"), F.lit(1).alias("b")),
          "hot": ids.select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), F.col("id").alias("b")),
          "with null": ids.select(F.when(F.col("id") == 5, None).otherwise(F.col("id")).alias("a"), F.lit(1).alias("b")),
          "one row": ids.where("id = 9").select(F.col("id").alias("a"), F.lit(1).alias("b")), "none": ids.where("id < 0").select(F.col("id").alias("a"), F.lit(1).alias("b"))}[keys]
    got = [(r["a"], r["b"], r["k"]) for r in assign_surrogate_keys(df, ["a", "b"], "k", base=10, num_partitions=5).collect()]
    rows = sorted(((r["a"], r["b"]) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    assert sorted(got, key=lambda r: r[2]) == [(a, b, 11 + i) for i, (a, b) in enumerate(rows)]


def test_only_partition_sizes_meet_in_one_task(spark):
    """The window without partitions reads one row per range partition, of sparse keys too."""
    df = spark.range(0, 4000).select((F.col("id") * 70_000).alias("a"))
    plan = executed(assign_surrogate_keys(df, ["a"], "k", num_partitions=6))
    todo, rows = [plan], None
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            todo.append(node.executedPlan())
        elif "QueryStage" in name:
            todo.append(node.plan())
        else:
            if name == "Exchange" and "SinglePartition" in node.simpleString(200):
                rows = node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    assert rows is not None and rows <= 6


def test_scratch_tables_are_removed(spark):
    with scratch_tables():
        gone = materialize(spark.range(5))
        kept = materialize(spark.range(5), keep=True)
    path = gone._table.replace("file:", "")
    assert not os.path.exists(path) and kept.count() == 5
    discard(kept, spark.range(3))
    assert not os.path.exists(kept._table.replace("file:", ""))


# -------------------------------------------------------------- J1 / J2
def test_intervals_hold_every_key(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(100, 140), 5000, -7, 2**62, None]], "order_id long")
    got = key_intervals(ids, "order_id")
    assert len(got) <= 64 and all(any(a <= i <= b for a, b in got) for i in [*range(100, 140), 5000, -7, 2**62])
    assert got == sorted(got) and all(b < c for (_, b), (c, _) in zip(got, got[1:]))
    assert key_intervals(ids.where("order_id > 2 and order_id < 3"), "order_id") == []
    assert spark.range(3).where(within("id", [])).count() == 0


def test_child_scan_skips_what_no_staged_order_can_have(spark, tmp_path):
    path = str(tmp_path / "items")
    spark.range(0, 200_000).select(F.floor(F.col("id") / 4).alias("order_id"), F.col("id").alias("order_item_id")).repartitionByRange(16, "order_id").sortWithinPartitions(
        "order_id").write.parquet(path)
    items = spark.read.parquet(path)
    staged = spark.createDataFrame([(i,) for i in [*range(10, 30), *range(49_000, 49_050)]], "order_id long")  # old and new orders, far apart
    pruned = children_of(items, staged, intervals=key_intervals(staged, "order_id"))
    plain = children_of(items, staged)
    assert sorted(map(tuple, pruned.collect())) == sorted(map(tuple, plain.collect())) and pruned.count() == 4 * 70
    assert scanned(plain, "order_item_id") == 200_000
    assert scanned(pruned, "order_item_id") <= 200_000 / 4


# ---------------------------------------------------------------- D10
def test_update_rewrites_only_files_that_hold_the_row(spark, tmp_path):
    products = td.products(spark, SF_SMALL)
    table = FileTable(spark, str(tmp_path / "products"), schemas.PRODUCTS)
    table.create(products.repartitionByRange(8, "product_id"))
    before = table.files()
    done = table.update(F.col("product_id").isin(20, 21, 190), {"price": F.col("price") + 100})
    after = table.files()
    assert len(done.rewritten) == 2 and done.kept == len(before) - 2 and done.version == 2
    assert set(before) - set(after) == set(done.rewritten)
    want = {r["product_id"]: r["price"] + (100 if r["product_id"] in (20, 21, 190) else 0) for r in products.collect()}
    assert {r["product_id"]: r["price"] for r in table.read().collect()} == want
    # the earlier version can still be read; an update without a match writes nothing
    assert table.read(1).where("product_id = 20").first()["price"] == want[20] - 100
    assert table.update(F.col("product_id") == -1, {"price": F.lit(0)}).version == 2 and table.files() == after


# ----------------------------------------------------------------- D8
def test_totals_touch_changed_orders_only(spark, tmp_path):
    src = td.sources(spark, SF_SMALL)
    orders, items = src["orders"], src["order_items"]
    totals = OrderTotals(spark, str(tmp_path))
    totals.write(1, items)
    now = items.withColumn("price", F.when(F.col("order_id") % 10 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(12,2)")).where("order_id <> 30")
    staged = orders.where("order_id % 10 = 0")
    assert totals.write(2, now.where("order_id % 10 = 0"), staged) == staged.count()
    want = sorted((r["order_id"], r["total_amount"]) for r in refresh_order_totals(orders, now).collect())
    assert sorted((r["order_id"], r["total_amount"]) for r in totals.apply(orders).collect()) == want
    totals.fold(3)
    assert sorted((r["order_id"], r["total_amount"]) for r in totals.apply(orders).collect()) == want
    assert totals.wh._batches("order_totals") == [1, 2, 3]


# ----------------------------------------------------------------- Q1
def test_key_filter_finds_every_duplicate_and_reads_suspects_only(spark, tmp_path):
    path = str(tmp_path / "loaded")
    spark.range(0, 50_000).select("id", (F.col("id") % 7).alias("day")).repartitionByRange(10, "id").sortWithinPartitions("id").write.parquet(path)
    loaded = spark.read.parquet(path)
    filt = KeyFilter(["id", "day"], 60_000).add(loaded.where("id < 20000")).add(loaded.where("id >= 20000"))
    new = spark.range(100_000, 101_000).select("id", (F.col("id") % 7).alias("day"))
    again = loaded.where("id between 300 and 340")
    twice = new.where("id < 100010")
    batch = materialize(new.unionByName(again).unionByName(twice).unionByName(spark.sql("select cast(null as long) id, 1L day union all select null, 1L")))
    found = filt.duplicates(batch, loaded)
    assert sorted((r["id"], r["n"]) for r in found.collect()) == sorted([(i, 2) for i in range(300, 341)] + [(i, 2) for i in range(100_000, 100_010)])
    assert filt.suspects(new).count() < 1000 / 2
    assert filt.duplicates(new, loaded).count() == 0
    scans = filt.duplicates(batch.where("id < 100000"), loaded)
    assert scanned(scans, "loaded") <= 50_000 / 5


# ----------------------------------------------------------------- S2
def test_csv_reasons(spark, tmp_path):
    os.makedirs(tmp_path / "in")
    with open(tmp_path / "in" / "products.csv", "w") as f:
        f.write("product_id,product_name,category,price,last_updated\n1,\"a, \"\"b\"\"\",c,1.50,2020-01-01 00:00:00\n2,x,c,1.50\n3,x,c,1.50,2020-01-01 00:00:00,9\nfour,x,c,1.50,2020-01-01 00:00:00\n"
                "5,,c,1.50,2020-01-01 00:00:00\n6,x,c,cheap,2020-01-01 00:00:00\n7,x,c,1.50,2020-13-01 00:00:00\n\n8,é,c,99999999999.00,2020-01-01 00:00:00\n9,y,d,2,2020-01-01 00:00:00\n")
    got = import_csv(spark, str(tmp_path / "in"), str(tmp_path / "out"), ["products"])
    assert sorted(map(tuple, got["products"].select("product_id", "product_name", F.col("price").cast("string")).collect())) == [(1, 'a, "b"', "1.50"), (9, "y", "2.00")]
    reasons = {r["line"].split(",")[0]: r["reason"] for r in got["rejects"].collect()}
    assert reasons == {"2": "number of fields", "3": "number of fields", "four": "product_id: no bigint", "5": "product_name: empty", "6": "price: no decimal(12,2)",
                       "7": "last_updated: no timestamp_ntz", "8": "price: no decimal(12,2)"}
    assert parse_csv(spark, str(tmp_path / "in" / "products.csv"), schemas.PRODUCTS).where("reason IS NULL").count() == 2


# ------------------------------------------------------- J11, A9, stream
def test_a_calendar_filter_prunes_years(spark):
    snap = entry._two_batches(spark, SF_SMALL)
    df = analytics.revenue_by_month(snap.fact_sales, snap.dim_date.where("week_of_year = 53"))
    assert "dynamicpruning" in df._jdf.queryExecution().executedPlan().toString()
    assert scanned(df, "total_amount") < snap.fact_sales.count() / 2


def test_writes_observe_their_rows(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path))
    seen = wh.write(spark.range(0, 1000, 1, 7), "t", 1, counting={"odd": F.col("id") % 2 == 1, "none": F.lit(None).cast("boolean")})
    assert seen == {"rows": 1000, "odd": 500, "none": 0}
    assert wh.write(spark.range(0), "t", 2)["rows"] == 0


def test_changed_since_a_date_partitioned_source(spark):
    df = spark.createDataFrame([("2020-01-01 00:00:00",), ("2020-01-02 00:00:01",)], "s string").select(F.col("s").cast("timestamp_ntz").alias("last_updated"), F.to_date("s").alias("last_updated_date"))
    assert changed_since(df, "2020-01-02 00:00:00").count() == 1


def test_folded_dedup_groups_by_hash(spark):
    from starmart.functions import folded
    from starmart.operators.clean import dedup_by_email

    words = ["É", "e", "E\u0301", "Ñandú", "nandu", "ß", "ss", "Ω", "ώ", "Ёж", "еж", "ǅ", "", None, "日本", "ﬁ"]
    df = spark.createDataFrame(list(enumerate(words)), "user_id long, email string")
    got = {r["user_id"]: r["k"] for r in df.select("user_id", folded("email").alias("k")).collect()}
    assert got[0] == got[1] == got[2] == "e" and got[3] == got[4] == "nandu" and got[7] == got[8] and got[9] == got[10]
    assert got[5] != got[6] and got[12] == "" and got[13] is None and got[14] == "日本"
    kept = dedup_by_email(df, fold=True)
    assert sorted(r["user_id"] for r in kept.collect()) == [0, 3, 5, 6, 7, 9, 11, 12, 13, 14, 15]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
