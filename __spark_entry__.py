"""

Every query reads the driver tables at ``sf_dir`` through the adapter in
``starmart.sources.testdata`` (TPC-H-style tables -> users, products, orders,
order_items, payments) and runs the library's operators on them. The oracle
SQL restates the adapter's rules and each operator's semantics in plain SQL
over the same tables (as DuckDB views), so the two sides share data but no
code.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import datetime as dt  # noqa: E402

from starmart import schemas  # noqa: E402
from starmart.functions import date_key, range_label, sales_year  # noqa: E402
from starmart.operators import analytics, quality  # noqa: E402
from starmart.operators.clean import dropped_by_dedup, fill_unknown, transform_users  # noqa: E402
from starmart.operators.dims import initial_customers, initial_products, new_dates, scd1_upsert, scd2_apply  # noqa: E402
from starmart.operators.extract import changed_since, extract, high_watermark  # noqa: E402
from starmart.operators.facts import fact_candidates, fact_rejects, load_facts  # noqa: E402
from starmart.operators.keyfilter import KeyFilter  # noqa: E402
from starmart.operators.keys import assign_surrogate_keys  # noqa: E402
from starmart.operators.maintain import derive_payments, point_update, raise_price, refresh_order_totals  # noqa: E402
from starmart.plans.batch import ERROR_MESSAGE, FAILED_MESSAGE, MESSAGES, run_batch, run_staged  # noqa: E402
from starmart.plans.filetable import FileTable  # noqa: E402
from starmart.plans.star import first_batch_log, first_load  # noqa: E402
from starmart.plans.totals import OrderTotals  # noqa: E402
from starmart.plans.warehouse import Warehouse  # noqa: E402
from starmart.session import apply_conf, ensure_checkpoint_dir, materialize, session_key  # noqa: E402
from starmart.sources import testdata as td  # noqa: E402
from starmart.sources.imports import import_csv  # noqa: E402
from starmart.streaming.hourly import start_feed_stream  # noqa: E402

try:  # the corpus operators and their pipeline may be left out of an installation
    import corpus_pipeline
    from starmart.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "starmart.llm"):
        raise  # a module that the operators need
    _LLM_QUERIES, _LLM_SQL = {}, {}
else:
    _LLM_QUERIES = llm.QUERIES | {"pipeline": corpus_pipeline.run}
    _LLM_SQL = llm.SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})

SMOKE_DIR = "/root/testdata/sf0.001"
RUN_TS = td.AS_OF  # run stamp of the first batch


def _shift(ts: str, **delta) -> str:
    return (dt.datetime.fromisoformat(ts) + dt.timedelta(**delta)).strftime("%Y-%m-%d %H:%M:%S")


# Scenario parameters of the registered queries (fixed values).
RUN2_TS = _shift(RUN_TS, days=1)                 # second batch
ORDERS_WATERMARK = "2000-07-01 00:00:00"         # incremental extract of orders
USERS_WATERMARK = _shift(RUN_TS, days=-30)       # incremental extract of users
LOADED_UNTIL = _shift(RUN_TS, days=-20)          # dims loaded from rows stamped <= this
CHANGES_SINCE = _shift(RUN_TS, days=-35)         # next batch: rows stamped > this
DIM_DATE_LOADED_BEFORE = "1998-01-01 00:00:00"   # dim_date already holds earlier dates
DIM_DATE_STAGED_FROM = "1997-07-01 00:00:00"     # staged orders from this date on
FACT_LOADED_BEFORE = 19990101                    # facts already loaded below this date key
FACT_MOVED_FROM = 19980101                       # ... of which these were loaded one day early
STREAM_RUN_TS = "2024-02-01 00:00:00"
RELOCATED_REGION = "EUROPE"                      # users there change city in batch 2


def _prepare(spark: SparkSession) -> None:
    apply_conf(spark)
    ensure_checkpoint_dir(spark)


def _star(spark: SparkSession, sf_dir: str, with_ids: bool = False, dedup: bool = False):
    _prepare(spark)
    return first_load(td.sources(spark, sf_dir, with_item_ids=with_ids), RUN_TS, dedup=dedup, with_ids=with_ids)


# ----------------------------------------------------------------- analytics
def q_revenue_by_month(spark, sf_dir):
    s = _star(spark, sf_dir)
    return analytics.revenue_by_month(s.fact_sales, s.dim_date)


def q_revenue_by_quarter(spark, sf_dir):
    s = _star(spark, sf_dir)
    return analytics.revenue_by_quarter(s.fact_sales, s.dim_date)


def q_weekday_weekend_revenue(spark, sf_dir):
    s = _star(spark, sf_dir)
    return analytics.weekday_weekend_revenue(s.fact_sales, s.dim_date)


def q_top_customers(spark, sf_dir):
    s = _star(spark, sf_dir)
    return analytics.top_customers(s.fact_sales, s.dim_customer)


def q_top_products(spark, sf_dir):
    s = _star(spark, sf_dir)
    return analytics.top_products(s.fact_sales, s.dim_product)


# ------------------------------------------------------------- helpers
def _src(spark, sf_dir, with_ids: bool = True):
    _prepare(spark)
    return td.sources(spark, sf_dir, with_item_ids=with_ids)


def _ts(value: str):
    return F.lit(value).cast("timestamp_ntz")


def _empty_dim_date(spark):
    return schemas.empty(spark, schemas.DIM_DATE)


# --------------------------------------------------------- D1 calendar
def q_dim_date_build(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    return new_dates(s["orders"], _empty_dim_date(spark))


def q_dim_date_incremental(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    o = s["orders"]
    existing = new_dates(o.where(F.col("order_date") < _ts(DIM_DATE_LOADED_BEFORE)), _empty_dim_date(spark))
    return new_dates(o.where(F.col("order_date") >= _ts(DIM_DATE_STAGED_FROM)), existing)


# ------------------------------------------------------------ C2 extract
def q_extract_orders_incremental(spark, sf_dir):
    return changed_since(_src(spark, sf_dir, False)["orders"], ORDERS_WATERMARK)


def q_extract_users_incremental(spark, sf_dir):
    return changed_since(_src(spark, sf_dir, False)["users"], USERS_WATERMARK)


def q_extract_items_semi(spark, sf_dir):
    return extract(_src(spark, sf_dir), ORDERS_WATERMARK)["order_items"]


def q_extract_payments_semi(spark, sf_dir):
    return extract(_src(spark, sf_dir, False), ORDERS_WATERMARK)["payments"]


# ---------------------------------------------------------- C3 transform
def q_clean_users(spark, sf_dir):
    return fill_unknown(_src(spark, sf_dir, False)["users"])


def q_dedup_users(spark, sf_dir):
    return transform_users(_src(spark, sf_dir, False)["users"])


def q_dedup_users_folded(spark, sf_dir):
    """E-mails that differ in case and accents only are one: a third of them is
    written in capitals, a third with accents."""
    users, k = _src(spark, sf_dir, False)["users"], F.col("user_id")
    spelled = F.when(k % 3 == 0, F.upper("email")).when(k % 3 == 1, F.replace(F.replace("email", F.lit("user"), F.lit("ùsér")), F.lit("example"), F.lit("ÉXÄMPLÉ"))).otherwise(F.col("email"))
    return transform_users(users.withColumn("email", spelled), fold=True)


def q_dedup_dropped(spark, sf_dir):
    """Users the de-duplication removes, with the surviving user id of
    their e-mail (reported, since their orders never reach the fact)."""
    users = fill_unknown(_src(spark, sf_dir, False)["users"])
    kept = transform_users(users)
    dropped = dropped_by_dedup(users, kept)
    return dropped.join(kept.select("email", F.col("user_id").alias("kept_user_id")), "email").select(
        "user_id", "email", "kept_user_id")


# ----------------------------------------------------------- D2 / D3 / D4
def _scd1(spark, sf_dir):
    p = _src(spark, sf_dir, False)["products"]
    old = initial_products(p.where(F.col("last_updated") <= _ts(LOADED_UNTIL)))
    incoming = raise_price(changed_since(p, CHANGES_SINCE), F.lit(True), 100)
    return scd1_upsert(old, incoming)


def q_scd1_upsert(spark, sf_dir):
    return _scd1(spark, sf_dir)


def _scd2(spark, sf_dir):
    u = fill_unknown(_src(spark, sf_dir, False)["users"])
    old = initial_customers(u.where(F.col("last_updated") <= _ts(LOADED_UNTIL)), RUN_TS)
    incoming = point_update(changed_since(u, CHANGES_SINCE), F.col("country") == RELOCATED_REGION,
                            {"city": F.concat(F.col("city"), F.lit(" NCR"))})
    return scd2_apply(old, incoming, RUN2_TS)


def q_scd2_apply(spark, sf_dir):
    return _scd2(spark, sf_dir)


def q_scd2_active_unique(spark, sf_dir):
    d = _scd2(spark, sf_dir)
    active = F.col("is_active") == 1
    return d.agg(
        F.count(F.lit(1)).alias("versions"),
        F.sum("is_active").cast("long").alias("active_rows"),
        F.countDistinct(F.when(active, F.col("user_id"))).alias("active_users"),
        F.countDistinct("user_id").alias("users"),
    )


def q_dim_customer_load(spark, sf_dir):
    return _star(spark, sf_dir).dim_customer


# ------------------------------------------------------------ D5 facts
def q_fact_load(spark, sf_dir):
    return _star(spark, sf_dir, with_ids=True).fact_sales


def _reload(spark, sf_dir, match_on):
    """Facts below FACT_LOADED_BEFORE were loaded by an earlier batch, those
    from FACT_MOVED_FROM on under the previous day's date key (their order
    date has since moved); the batch now offers every fact again."""
    s = _src(spark, sf_dir)
    star = first_load(s, RUN_TS, with_ids=True)
    prev_day = date_key(F.date_sub(F.to_date(F.col("date_key").cast("string"), "yyyyMMdd"), 1))
    existing = star.fact_sales.where(F.col("date_key") < FACT_LOADED_BEFORE).withColumn(
        "date_key", F.when(F.col("date_key") >= FACT_MOVED_FROM, prev_day).otherwise(F.col("date_key")))
    cands = fact_candidates(s["order_items"], s["orders"], star.dim_customer, star.dim_product)
    return load_facts(cands, existing, RUN2_TS, match_on=match_on)


def q_fact_load_idempotent(spark, sf_dir):
    return _reload(spark, sf_dir, "split")


def q_fact_match_item_only(spark, sf_dir):
    return _reload(spark, sf_dir, "combined")


def q_fact_range_label(spark, sf_dir):
    f = _star(spark, sf_dir).fact_sales
    return f.groupBy(sales_year("date_key").alias("sales_year"), range_label("date_key").alias("range_partition")).agg(
        F.count(F.lit(1)).alias("rows_in_partition"),
        F.round(F.sum("total_amount"), 2).cast("decimal(38,2)").alias("revenue"))


def q_fact_rejects(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    star = first_load(s, RUN_TS, dedup=True, with_ids=False)
    return fact_rejects(s["order_items"], s["orders"], star.dim_customer, star.dim_product).select(
        "order_id", "product_id", "quantity", "price", "user_id", "reason")


# -------------------------------------------------------- D8-D10, K1
def q_order_totals_refresh(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    return refresh_order_totals(s["orders"], s["order_items"])


def q_derive_payments(spark, sf_dir):
    return derive_payments(_src(spark, sf_dir, False)["orders"])


def q_point_update_price(spark, sf_dir):
    return raise_price(_src(spark, sf_dir, False)["products"], F.col("product_id") == 20, 100)


def q_point_update_user(spark, sf_dir):
    return point_update(_src(spark, sf_dir, False)["users"], F.col("user_id") == 101,
                        {"city": "Delhi NCR", "country": "India"})


def q_surrogate_keys(spark, sf_dir):
    return _src(spark, sf_dir)["order_items"]


# ----------------------------------------------------------- Q1-Q6
def q_check_unique(spark, sf_dir):
    return quality.duplicate_keys(_src(spark, sf_dir, False)["users"], ["email"])


def q_check_orphans(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    return quality.orphan_summary(s, schemas.FOREIGN_KEYS)


def q_check_not_null(spark, sf_dir):
    return quality.null_counts(_src(spark, sf_dir, False)["users"])


def q_check_lengths(spark, sf_dir):
    return quality.length_violations(_src(spark, sf_dir, False)["users"], schemas.VARCHAR_LIMITS["users"])


# Keys declared by the source and warehouse schemas.
DECLARED_KEYS = [*((t, k) for t, k in schemas.PRIMARY_KEYS.items()),
                 *((t, k) for t, ks in schemas.UNIQUE_KEYS.items() for k in ks),
                 ("dim_product", ["product_id"]), ("dim_date", ["full_date"]),
                 ("fact_sales", ["source_order_item_id", "date_key"])]
# Driver columns that become DECIMAL(12,2) (fixed values).
MONEY_COLUMNS = {"part": ["p_retailprice"], "orders": ["o_totalprice"], "lineitem": ["l_extendedprice"]}


def q_check_unique_all(spark, sf_dir):
    s = _src(spark, sf_dir)
    star = first_load(s, RUN_TS)
    return quality.unique_summary({**s.materialize(), "dim_product": star.dim_product, "dim_date": star.dim_date,
                                   "fact_sales": star.fact_sales}, DECLARED_KEYS)


def q_check_not_null_all(spark, sf_dir):
    return quality.per_table(_src(spark, sf_dir).materialize(), lambda _, df: quality.null_counts(df))


def q_check_lengths_all(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    return quality.per_table({t: s[t] for t in schemas.VARCHAR_LIMITS},
                             lambda t, df: quality.length_violations(df, schemas.VARCHAR_LIMITS[t]))


def q_check_decimals_all(spark, sf_dir):
    _prepare(spark)
    return quality.per_table({t: td.table(spark, sf_dir, t) for t in MONEY_COLUMNS},
                             lambda t, df: quality.decimal_summary(df, {c: (12, 2) for c in MONEY_COLUMNS[t]}))


def q_money_exact(spark, sf_dir):
    """Exact sums, as text, and the declared type of every money column."""
    s, star = _src(spark, sf_dir), _star(spark, sf_dir)
    parts = []
    for t, df, columns in [("products", s["products"], ["price"]), ("orders", s["orders"], ["total_amount"]), ("order_items", s["order_items"], ["price"]),
                           ("fact_sales", star.fact_sales, ["unit_price", "total_amount"])]:
        # all sums of a table from one pass over it
        rows = [F.struct(F.lit(t).alias("table_name"), F.lit(c).alias("column_name"), F.lit(df.schema[c].dataType.simpleString()).alias("type"),
                         F.col(c).alias("total")) for c in columns]
        parts.append(df.agg(*(F.sum(c).cast("string").alias(c) for c in columns)).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, parts)


# ------------------------------------------- two batches of the runner
# Between the batches: customers move, prices rise, and every so many orders
# there is a new one, of two lines, by the same customer (fixed values).
CHANGE_TS = _shift(RUN_TS, minutes=30)
NEW_ORDER_EVERY, NEW_ID, RAISED_EVERY = 50, 1_000_000_000_000, 20
_WAREHOUSES: dict = {}


def _changed_sources(spark, sf_dir):
    s, stamp = td.sources(spark, sf_dir), _ts(CHANGE_TS)
    moved = (F.col("country") == RELOCATED_REGION) & (F.col("user_id") % 10 != 9)
    out = {
        "users": point_update(s["users"], moved, {"city": F.concat(F.col("city"), F.lit(" NCR")), "last_updated": stamp}),
        "products": raise_price(s["products"], F.col("product_id") % RAISED_EVERY == 0, 100, touch_ts=CHANGE_TS),
    }
    again = s["orders"].where(F.col("order_id") % NEW_ORDER_EVERY == 0)
    new = again.select((F.col("order_id") + NEW_ID).alias("order_id"), "user_id", stamp.alias("order_date"),
                       F.lit("3997.00").cast("decimal(12,2)").alias("total_amount"), F.lit("DELIVERED").alias("status"),
                       stamp.alias("last_updated"))
    lines = F.explode(F.array(F.struct(F.lit(0).alias("j"), F.lit(20).alias("p"), F.lit(2).alias("q"), F.lit("1499.00").alias("c")),
                              F.struct(F.lit(1).alias("j"), F.lit(35).alias("p"), F.lit(1).alias("q"), F.lit("999.00").alias("c"))))
    items = new.select("order_id", lines.alias("x")).select(
        (F.col("order_id") * 2 + F.col("x.j")).alias("order_item_id"), "order_id", F.col("x.p").cast("long").alias("product_id"),
        F.col("x.q").alias("quantity"), F.col("x.c").cast("decimal(12,2)").alias("price"))
    paid = new.select(F.col("order_id").alias("payment_id"), "order_id", F.lit("CARD").alias("payment_method"),
                      F.lit("SUCCESS").alias("payment_status"), F.col("order_date").alias("payment_date"))
    for name, more in (("orders", new), ("order_items", items), ("payments", paid)):
        out[name] = s[name].unionByName(more)
    return out


def _two_batches(spark, sf_dir, variant="split"):
    """A warehouse after two batches, a micro-batch of the feed that adds
    nothing (no orders), and a batch that fails in its extract; written once
    per session."""
    _prepare(spark)
    key = (session_key(spark), sf_dir, variant)
    if key not in _WAREHOUSES:
        root = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/warehouse-{uuid.uuid4().hex}"
        run = partial(run_batch, spark, root=root, variant=variant)
        run(lambda: td.sources(spark, sf_dir), run_ts=dt.datetime.fromisoformat(RUN_TS), batch_id="batch-1")
        run(lambda: _changed_sources(spark, sf_dir), run_ts=dt.datetime.fromisoformat(RUN2_TS), batch_id="batch-2")
        wh = Warehouse(spark, root)
        run_staged(spark, wh, {}, run_ts=dt.datetime.fromisoformat(_shift(RUN2_TS, hours=1)), batch_id="feed-1", variant=variant, keep_watermark=True)
        broken = lambda: {**td.sources(spark, sf_dir).materialize(), "users": td.table(spark, sf_dir, "customer")}
        run(broken, run_ts=dt.datetime.fromisoformat(_shift(RUN2_TS, hours=2)), batch_id="batch-3", swallow=True)
        _WAREHOUSES[key] = root
    return Warehouse(spark, _WAREHOUSES[key]).snapshot()


def q_batch2_dim_product(spark, sf_dir):
    return _two_batches(spark, sf_dir).dim_product


def q_batch2_dim_customer(spark, sf_dir):
    return _two_batches(spark, sf_dir).dim_customer


def q_batch2_dim_date(spark, sf_dir):
    return _two_batches(spark, sf_dir).dim_date


def q_batch2_fact(spark, sf_dir):
    return _two_batches(spark, sf_dir).fact_sales.select(*schemas.FACT_SALES.fieldNames())


def q_batch2_log(spark, sf_dir):
    return _two_batches(spark, sf_dir).etl_log


def q_batch2_log_combined(spark, sf_dir):
    return _two_batches(spark, sf_dir, "combined").etl_log


def q_batch2_watermark(spark, sf_dir):
    return high_watermark(_two_batches(spark, sf_dir).etl_log)


def q_batch2_error_tail(spark, sf_dir):
    log = _two_batches(spark, sf_dir).etl_error_log.withColumn("error_message", F.substring_index("error_message", ":", 1))
    return quality.log_tail(log, 10, "error_id")


def q_row_count_audit(spark, sf_dir):
    s = _src(spark, sf_dir, False)
    star = first_load(s, RUN_TS, with_ids=False)
    return quality.row_count_audit({
        "users": s["users"], "products": s["products"], "orders": s["orders"],
        "order_items": s["order_items"], "payments": s["payments"],
        "dim_customer": star.dim_customer, "dim_product": star.dim_product,
        "dim_date": star.dim_date, "fact_sales": star.fact_sales,
    })


def _log(spark, sf_dir):
    return first_batch_log(_src(spark, sf_dir, False), RUN_TS)


def q_etl_batch_log(spark, sf_dir):
    return _log(spark, sf_dir)


def q_watermark(spark, sf_dir):
    log = _log(spark, sf_dir)
    failed = log.where(F.col("phase") == "RUN").select(
        (F.col("etl_id") + 1).alias("etl_id"), "batch_id", "phase",
        (F.col("last_loaded_time") + F.expr("INTERVAL 1 HOUR")).alias("last_loaded_time"),
        F.lit(0).cast("long").alias("rows_affected"), F.lit("FAILED").alias("status"),
        F.lit("ETL failed and rolled back").alias("message"), "created_at")
    return high_watermark(log.unionByName(failed))


def q_log_tail(spark, sf_dir):
    return quality.log_tail(_log(spark, sf_dir), 10, columns=["phase", "status", "rows_affected"])



# ------------------------------------------------ K1 on awkward keys
SPARSE_STEP = 70_000  # distance of neighbouring ids (fixed value)


def q_surrogate_keys_sparse(spark, sf_dir):
    """Ids far apart: one key each, dense."""
    o = _src(spark, sf_dir, False)["orders"].select((F.col("order_id") * SPARSE_STEP).alias("sparse_id"))
    return assign_surrogate_keys(o, ["sparse_id"], "surrogate_key", base=1000)


def q_surrogate_keys_hot(spark, sf_dir):
    """A first key column that many rows share."""
    o = _src(spark, sf_dir, False)["orders"].select("status", "order_id")
    return assign_surrogate_keys(o, ["status", "order_id"], "surrogate_key")


# ------------------------------------------------ J1 with a pruned scan
def _scratch(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def _sorted_items(spark, sf_dir):
    """The changed sources with order lines laid out by order id, as a table that is loaded in order is."""
    s = _changed_sources(spark, sf_dir)
    items = materialize(s["order_items"].repartitionByRange(8, "order_id").sortWithinPartitions("order_id"))
    return {**{t: s[t] for t in ("users", "products", "orders", "payments")}, "order_items": items}


def q_extract_items_pruned(spark, sf_dir):
    """The lines of the orders that are new since the first batch, from the row groups that can hold them."""
    _prepare(spark)
    return extract(_sorted_items(spark, sf_dir), RUN_TS)["order_items"]


# ------------------------------------------------ S2 CSV with rejects
# Planted faults (fixed values): every so many ids a field is broken.
BAD_FIELDS, BAD_USER, BAD_DATE, BAD_AMOUNT = 101, 103, 107, 97
BAD_PRICE, BAD_NAME = 53, 59


def _csv_files(spark, sf_dir) -> str:
    """Orders and products as CSV files, with planted faults."""
    s, base = _src(spark, sf_dir, False), _scratch(spark, "csv")
    k = F.col("order_id")
    orders = s["orders"].select(F.concat_ws(
        ",", k.cast("string"), F.when(k % BAD_USER == 0, "").otherwise(F.col("user_id").cast("string")),
        F.when(k % BAD_DATE == 0, "yesterday").otherwise(F.date_format("order_date", "yyyy-MM-dd HH:mm:ss")),
        F.when(k % BAD_AMOUNT == 0, "n/a").otherwise(F.col("total_amount").cast("string")), "status",
        F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss"), F.when(k % BAD_FIELDS == 0, "extra")).alias("value"))
    p = F.col("product_id")
    quoted = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    products = s["products"].select(F.concat_ws(
        ",", p.cast("string"), F.when(p % BAD_NAME == 0, "").otherwise(quoted(F.concat("product_name", F.lit(', "new"')))), quoted(F.col("category")),
        F.when(p % BAD_PRICE == 0, "12,50").otherwise(F.col("price").cast("string")), F.date_format("last_updated", "yyyy-MM-dd HH:mm:ss")).alias("value"))
    for name, rows in (("orders", orders), ("products", products)):
        header = spark.createDataFrame([(",".join(schemas.SOURCES[name].fieldNames()),)], "value string")
        header.unionByName(rows).write.text(f"{base}/{name}.csv")
    return base


def _imported(spark, sf_dir):
    _prepare(spark)
    key = (session_key(spark), sf_dir, "csv")
    if key not in _WAREHOUSES:
        _WAREHOUSES[key] = import_csv(spark, _csv_files(spark, sf_dir), _scratch(spark, "imported"), ["orders", "products"])
    return _WAREHOUSES[key]


def q_csv_orders(spark, sf_dir):
    return _imported(spark, sf_dir)["orders"]


def q_csv_products(spark, sf_dir):
    return _imported(spark, sf_dir)["products"]


def q_csv_rejects(spark, sf_dir):
    return _imported(spark, sf_dir)["rejects"]


# ------------------------------------------------ D10, D8, Q1 kept up to date
def q_point_update_files(spark, sf_dir):
    """A price raise that rewrites the one file that holds the product."""
    _prepare(spark)
    table = FileTable(spark, _scratch(spark, "products"), schemas.PRODUCTS)
    table.create(_src(spark, sf_dir, False)["products"].repartitionByRange(8, "product_id"))
    done = table.update(F.col("product_id") == 20, {"price": F.col("price") + 100})
    return table.read().withColumn("rewritten_files", F.lit(len(done.rewritten)))


REPRICED_EVERY = 40  # orders whose lines cost 1.00 more in the second batch (fixed value)


def _repriced(s):
    """Second state of orders and lines: new orders, and every so many orders at another price."""
    old = F.col("order_id") < NEW_ID
    items = s["order_items"].withColumn("price", F.when(old & (F.col("order_id") % REPRICED_EVERY == 0), (F.col("price") + 1).cast("decimal(12,2)")).otherwise(F.col("price")))
    return s["orders"], items, F.when(old, F.col("order_id") % REPRICED_EVERY == 0).otherwise(True)


def q_order_totals_incremental(spark, sf_dir):
    """Totals of a first batch, then of the orders that changed; merged on read."""
    _prepare(spark)
    first = td.sources(spark, sf_dir)
    orders, items, changed = _repriced(_changed_sources(spark, sf_dir))
    totals = OrderTotals(spark, _scratch(spark, "totals"))
    totals.write(1, first["order_items"])
    totals.write(2, items.where(changed), orders.where(changed))
    return totals.apply(orders)


def q_check_unique_incremental(spark, sf_dir):
    """Keys of a batch against the filter of those loaded: the batch is the later
    facts, and every so many of the earlier ones again."""
    f = materialize(_star(spark, sf_dir, with_ids=True).fact_sales)
    loaded = f.where(F.col("date_key") < FACT_LOADED_BEFORE)
    batch = f.where((F.col("date_key") >= FACT_LOADED_BEFORE) | (F.col("source_order_item_id") % NEW_ORDER_EVERY == 0))
    keys = ["source_order_item_id", "date_key"]
    return KeyFilter(keys, loaded.count()).add(loaded).duplicates(batch, loaded)


# ------------------------------------------------ AN1 by a calendar filter
def q_revenue_of_week_53(spark, sf_dir):
    """AN1 over days of ISO week 53: only years that have some are scanned."""
    s = _two_batches(spark, sf_dir)
    return analytics.revenue_by_month(s.fact_sales, s.dim_date.where("week_of_year = 53"))


# ------------------------------------------------ log tail, ids, stamps
def q_batch2_log_tail(spark, sf_dir):
    return quality.log_tail(_two_batches(spark, sf_dir).etl_log, 3, columns=["etl_id", "batch_id", "phase", "status", "rows_affected"])


def q_batch2_last_keys(spark, sf_dir):
    """LAST_INSERT_ID: the last key handed out per table, beside the largest in it."""
    s = _two_batches(spark, sf_dir)
    tables = [("dim_customer", s.dim_customer, "customer_key"), ("dim_product", s.dim_product, "product_key"), ("fact_sales", s.fact_sales, "sale_id")]
    parts = [df.agg(F.max(k).alias("largest_key"), F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(t).alias("table_name"), F.lit(int(s.max_keys[t])).cast("long").alias("last_key"), "largest_key", "n_rows") for t, df, k in tables]
    return reduce(DataFrame.unionByName, parts)


def q_batch_identity(spark, sf_dir):
    """Two batches under their own ids and stamps (UUID, NOW): that ids differ
    and are UUIDs, that stamps lie in the run, and the products loaded."""
    s, root = _src(spark, sf_dir, False), _scratch(spark, "warehouse")
    now = lambda: spark.sql("SELECT localtimestamp() AS t").first()["t"].replace(microsecond=0)
    began = now()
    for part in (0, 1):
        run_staged(spark, Warehouse(spark, root), {"products": s["products"].where(F.col("product_id") % 2 == part)})
    ended = now()
    snap = Warehouse(spark, root).snapshot()
    runs = snap.etl_log.where("phase = 'RUN'")
    inside = F.col("created_at").between(F.lit(str(began)).cast("timestamp_ntz"), F.lit(str(ended)).cast("timestamp_ntz"))
    return runs.agg(F.count_distinct("batch_id").alias("batch_ids"), F.count_if(F.col("batch_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")).alias("uuids"),
                    F.count_if(inside).alias("stamps_in_run")).crossJoin(snap.dim_product.agg(F.count(F.lit(1)).alias("products")))


# ------------------------------------------------------------ C9 stream
class _Crash(RuntimeError):
    pass


def _streamed(spark, sf_dir):
    """The warehouse after the feed came in as files and went through the stream
    in four micro-batches. The stream crashes when the warehouse holds the first, before its
    checkpoint knows; started again, it replays that one and goes on."""
    _prepare(spark)
    key = (session_key(spark), sf_dir, "stream")
    if key not in _WAREHOUSES:
        root, landing, checkpoint = (_scratch(spark, x) for x in ("warehouse", "landing", "stream"))
        s = td.sources(spark, sf_dir)
        run_staged(spark, Warehouse(spark, root), {"users": s["users"], "products": s["products"]}, run_ts=dt.datetime.fromisoformat(RUN_TS), batch_id="dimensions")
        td.table(spark, sf_dir, "events").repartition(8, "event_id").write.parquet(landing)
        files = -(-len(spark.read.parquet(landing).inputFiles()) // 4)
        results = []

        def crash(epoch, result):
            results.append(result)
            if len(results) == 1:
                raise _Crash("the driver is gone")

        def run():
            start_feed_stream(spark, landing, root, checkpoint, query_name="feed", available_now=True, max_files_per_trigger=files,
                              run_ts=dt.datetime.fromisoformat(STREAM_RUN_TS), after_commit=crash).awaitTermination()

        try:
            run()
        except Exception as stopped:
            if "the driver is gone" not in str(stopped):
                raise
        run()
        _WAREHOUSES[key] = root, sum(r is None for r in results)
    root, replays = _WAREHOUSES[key]
    return Warehouse(spark, root).snapshot(), replays


def q_stream_restart_fact(spark, sf_dir):
    """Facts that a stopped and restarted stream committed. Their ids follow the order of arrival: see stream_restart_log."""
    return _streamed(spark, sf_dir)[0].fact_sales.select(*[c for c in schemas.FACT_SALES.fieldNames() if c != "sale_id"])


def q_stream_restart_log(spark, sf_dir):
    """What the stream committed: micro-batches, replays that were skipped, and facts by the log, by the table, and by their ids."""
    snap, replays = _streamed(spark, sf_dir)
    log = snap.etl_log.where("batch_id LIKE 'feed:%' AND status = 'SUCCESS'")
    counts = log.agg(F.count_if(F.col("phase") == "RUN").alias("micro_batches"), F.sum(F.when(F.col("phase") == "FACT_INCREMENTAL", F.col("rows_affected"))).alias("logged_facts"))
    facts = snap.fact_sales.agg(F.count(F.lit(1)).alias("facts"), F.count_distinct("sale_id").alias("sale_ids"), F.max("sale_id").alias("largest_sale_id"))
    return counts.crossJoin(facts).withColumn("replays", F.lit(replays))


def q_stream_incremental_fact(spark, sf_dir):
    """The stream's per-micro-batch logic over the whole purchase feed."""
    star = _star(spark, sf_dir)
    feed = td.purchase_feed(spark, sf_dir)
    cands = fact_candidates(feed, feed, star.dim_customer, star.dim_product)
    return load_facts(cands, schemas.empty(spark, schemas.FACT_SALES), STREAM_RUN_TS)


# Query outputs leave the library as portable types: exact decimals become
# doubles (converted once, from the exact value) and dates become timestamps,
# so results compare equal however a consumer converts them. The oracle
# applies the same casts to the same columns (OUTPUT_CASTS).
OUTPUT_CASTS = {
    "revenue_by_month": (["revenue"], []),
    "revenue_by_quarter": (["revenue"], []),
    "weekday_weekend_revenue": (["revenue"], []),
    "top_customers": (["total_spent"], []),
    "top_products": (["sales_amount"], []),
    "dim_date_build": ([], ["full_date"]),
    "dim_date_incremental": ([], ["full_date"]),
    "extract_orders_incremental": (["total_amount"], []),
    "extract_items_semi": (["price"], []),
    "extract_payments_semi": ([], []),
    "scd1_upsert": (["price"], []),
    "fact_load": (["unit_price", "total_amount"], []),
    "fact_load_idempotent": (["unit_price", "total_amount"], []),
    "fact_match_item_only": (["unit_price", "total_amount"], []),
    "fact_range_label": (["revenue"], []),
    "fact_rejects": (["price"], []),
    "order_totals_refresh": (["total_amount"], []),
    "point_update_price": (["price"], []),
    "surrogate_keys": (["price"], []),
    "stream_incremental_fact": (["unit_price", "total_amount"], []),
    "batch2_dim_product": (["price"], []),
    "extract_items_pruned": (["price"], []),
    "csv_orders": (["total_amount"], []),
    "csv_products": (["price"], []),
    "point_update_files": (["price"], []),
    "order_totals_incremental": (["total_amount"], []),
    "stream_restart_fact": (["unit_price", "total_amount"], []),
    "revenue_of_week_53": (["revenue"], []),
    "batch2_dim_date": ([], ["full_date"]),
    "batch2_fact": (["unit_price", "total_amount"], []),
}


def portable(df: DataFrame) -> DataFrame:
    from pyspark.sql import types as T

    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.DateType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def _portable_query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(fn(spark, sf_dir))

    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: monthly revenue of a first load at sf0.001."""
    return portable(q_revenue_by_month(spark, SMOKE_DIR))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _portable_query(fn) for name, fn in _QUERIES.items()} | _LLM_QUERIES


_QUERIES = {
    "revenue_by_month": q_revenue_by_month,
    "revenue_by_quarter": q_revenue_by_quarter,
    "weekday_weekend_revenue": q_weekday_weekend_revenue,
    "top_customers": q_top_customers,
    "top_products": q_top_products,
    "dim_date_build": q_dim_date_build,
    "dim_date_incremental": q_dim_date_incremental,
    "extract_orders_incremental": q_extract_orders_incremental,
    "extract_users_incremental": q_extract_users_incremental,
    "extract_items_semi": q_extract_items_semi,
    "extract_payments_semi": q_extract_payments_semi,
    "clean_users": q_clean_users,
    "dedup_users": q_dedup_users,
    "dedup_dropped": q_dedup_dropped,
    "dedup_users_folded": q_dedup_users_folded,
    "scd1_upsert": q_scd1_upsert,
    "scd2_apply": q_scd2_apply,
    "scd2_active_unique": q_scd2_active_unique,
    "dim_customer_load": q_dim_customer_load,
    "fact_load": q_fact_load,
    "fact_load_idempotent": q_fact_load_idempotent,
    "fact_match_item_only": q_fact_match_item_only,
    "fact_range_label": q_fact_range_label,
    "fact_rejects": q_fact_rejects,
    "order_totals_refresh": q_order_totals_refresh,
    "derive_payments": q_derive_payments,
    "point_update_price": q_point_update_price,
    "point_update_user": q_point_update_user,
    "surrogate_keys": q_surrogate_keys,
    "check_unique": q_check_unique,
    "check_orphans": q_check_orphans,
    "check_not_null": q_check_not_null,
    "check_lengths": q_check_lengths,
    "check_unique_all": q_check_unique_all,
    "check_not_null_all": q_check_not_null_all,
    "check_lengths_all": q_check_lengths_all,
    "check_decimals_all": q_check_decimals_all,
    "money_exact": q_money_exact,
    "batch2_dim_product": q_batch2_dim_product,
    "batch2_dim_customer": q_batch2_dim_customer,
    "batch2_dim_date": q_batch2_dim_date,
    "batch2_fact": q_batch2_fact,
    "batch2_log": q_batch2_log,
    "batch2_log_combined": q_batch2_log_combined,
    "batch2_watermark": q_batch2_watermark,
    "batch2_error_tail": q_batch2_error_tail,
    "row_count_audit": q_row_count_audit,
    "etl_batch_log": q_etl_batch_log,
    "watermark": q_watermark,
    "log_tail": q_log_tail,
    "stream_incremental_fact": q_stream_incremental_fact,
    "stream_restart_fact": q_stream_restart_fact,
    "stream_restart_log": q_stream_restart_log,
    "surrogate_keys_sparse": q_surrogate_keys_sparse,
    "surrogate_keys_hot": q_surrogate_keys_hot,
    "extract_items_pruned": q_extract_items_pruned,
    "csv_orders": q_csv_orders,
    "csv_products": q_csv_products,
    "csv_rejects": q_csv_rejects,
    "point_update_files": q_point_update_files,
    "order_totals_incremental": q_order_totals_incremental,
    "check_unique_incremental": q_check_unique_incremental,
    "revenue_of_week_53": q_revenue_of_week_53,
    "batch2_log_tail": q_batch2_log_tail,
    "batch2_last_keys": q_batch2_last_keys,
    "batch_identity": q_batch_identity,
}


# ===================================================================== oracle
# The adapter's rules and the first load, restated in SQL.
_AS_OF = f"TIMESTAMP '{td.AS_OF}'"

_SRC = f"""
src_users AS (
  SELECT c.c_custkey AS user_id, c.c_name AS name,
         'user' || CAST(CASE WHEN c.c_custkey % 10 = 9 THEN c.c_custkey - 1 ELSE c.c_custkey END AS VARCHAR)
           || '@example.com' AS email,
         CASE WHEN c.c_custkey % 20 = 0 THEN '' ELSE g.n_name END AS city,
         CASE WHEN c.c_custkey % 25 = 0 THEN NULL ELSE g.r_name END AS country,
         {_AS_OF} - to_days(CAST(c.c_custkey % 365 AS INTEGER)) AS created_at,
         {_AS_OF} - to_days(CAST(c.c_custkey % 60 AS INTEGER)) AS last_updated
  FROM customer c
  LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name
             FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
    ON c.c_nationkey = g.n_nationkey),
src_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(12,2)) AS price,
         {_AS_OF} - to_days(CAST(p_partkey % 50 AS INTEGER)) AS last_updated
  FROM part),
src_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS user_id, o_orderdate AS order_date,
         CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount,
         CASE o_orderstatus WHEN 'F' THEN 'DELIVERED' WHEN 'O' THEN 'PLACED'
              WHEN 'P' THEN 'CANCELLED' ELSE o_orderstatus END AS status,
         o_orderdate AS last_updated
  FROM orders),
src_items AS (
  SELECT row_number() OVER (ORDER BY l_orderkey NULLS FIRST, l_linenumber NULLS FIRST,
                            l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_shipdate NULLS FIRST) AS order_item_id,
         l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem),
clean_users AS (
  SELECT user_id, name, email,
         CASE WHEN city IS NULL OR trim(city) = '' THEN 'Unknown' ELSE city END AS city,
         CASE WHEN country IS NULL OR trim(country) = '' THEN 'Unknown' ELSE country END AS country,
         created_at, last_updated
  FROM src_users)"""


def _calendar(d: str) -> str:
    return f"""CAST(strftime({d}, '%Y%m%d') AS INTEGER) AS date_key, {d} AS full_date,
         CAST(day({d}) AS INTEGER) AS day_num, CAST(month({d}) AS INTEGER) AS month_num,
         monthname({d}) AS month_name, CAST(quarter({d}) AS INTEGER) AS quarter_num,
         CAST(year({d}) AS INTEGER) AS year_num, CAST(weekofyear({d}) AS INTEGER) AS week_of_year,
         CASE WHEN dayofweek({d}) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend"""


_STAR = f"""
dim_customer AS (
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id, name, email, city, country,
         {_AS_OF} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, 1 AS is_active,
         last_updated AS source_last_updated
  FROM clean_users),
dim_product AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category, price,
         last_updated AS source_last_updated
  FROM src_products),
dim_date AS (
  SELECT {_calendar('d')}
  FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM src_orders WHERE order_date IS NOT NULL)),
fact_rows AS (
  SELECT i.order_item_id AS source_order_item_id, c.customer_key, p.product_key,
         CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key, o.order_id, i.quantity,
         i.price AS unit_price, CAST(ROUND(i.quantity * i.price, 2) AS DECIMAL(14,2)) AS total_amount
  FROM src_items i
  JOIN src_orders o ON o.order_id = i.order_id
  JOIN dim_customer c ON c.user_id = o.user_id AND c.is_active = 1
  JOIN dim_product p ON p.product_id = i.product_id
  WHERE o.status <> 'CANCELLED'),
fact_sales AS (
  SELECT row_number() OVER (ORDER BY source_order_item_id, date_key) AS sale_id, *, {_AS_OF} AS load_dts
  FROM fact_rows)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


_STAR_WITH = _with(_SRC, _STAR)

_REV = "CAST(ROUND(SUM({}), 2) AS DECIMAL(38,2))"


def _ts_sql(value: str) -> str:
    return f"TIMESTAMP '{value}'"


_PAYMENTS = f"""
src_payments AS (
  SELECT row_number() OVER (ORDER BY order_id) AS payment_id, order_id,
         ['CARD', 'UPI', 'NETBANKING', 'WALLET'][1 + order_id % 4] AS payment_method,
         CASE WHEN status = 'CANCELLED' THEN 'FAILED' ELSE 'SUCCESS' END AS payment_status,
         order_date + to_minutes(CAST(order_id % 180 AS INTEGER)) AS payment_date
  FROM src_orders)"""

# Users kept by the e-mail de-duplication, and the star built from them.
_DEDUP = """
dedup_users AS (
  SELECT u1.* FROM clean_users u1
  WHERE NOT EXISTS (SELECT 1 FROM clean_users u2 WHERE u2.email = u1.email AND u1.user_id > u2.user_id)),
dd_customer AS (
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id FROM dedup_users),
dd_facts AS (
  SELECT i.order_item_id
  FROM src_items i
  JOIN src_orders o ON o.order_id = i.order_id
  JOIN dd_customer c ON c.user_id = o.user_id
  JOIN src_products p ON p.product_id = i.product_id
  WHERE o.status <> 'CANCELLED')"""


def _log_sql() -> str:
    phases = [
        ("EXTRACT", "(SELECT COUNT(*) FROM src_orders)", "Incremental extract completed"),
        ("TRANSFORM", "(SELECT COUNT(*) FROM dedup_users)", "Data cleansing and dedup completed"),
        ("SCD_LOAD", "(SELECT COUNT(*) FROM dedup_users)", "SCD Type 1 and Type 2 completed"),
        ("FACT_INCREMENTAL", "(SELECT COUNT(*) FROM dd_facts)", "Incremental fact load completed"),
        ("RUN", "1", "ETL pipeline completed successfully"),
    ]
    rows = [
        f"SELECT CAST({i + 1} AS BIGINT) AS etl_id, 'first-load' AS batch_id, '{ph}' AS phase, "
        f"{_AS_OF} AS last_loaded_time, CAST({n} AS BIGINT) AS rows_affected, 'SUCCESS' AS status, "
        f"'{msg}' AS message, {_AS_OF} AS created_at"
        for i, (ph, n, msg) in enumerate(phases)
    ]
    return "\netl_log AS (\n  " + "\n  UNION ALL ".join(rows) + ")"


def _scd2_sql() -> str:
    tracked = ["name", "email", "city", "country"]
    diff = " OR ".join(f"coalesce(o.{c}, '') <> coalesce(i.{c}, '')" for c in tracked)
    cols = "customer_key, user_id, name, email, city, country"
    return f"""
old AS (
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, user_id, name, email, city, country,
         {_AS_OF} AS start_date, CAST(NULL AS TIMESTAMP) AS end_date, 1 AS is_active,
         last_updated AS source_last_updated
  FROM clean_users WHERE last_updated <= {_ts_sql(LOADED_UNTIL)}),
inc AS (
  SELECT user_id, name, email,
         CASE WHEN country = '{RELOCATED_REGION}' THEN city || ' NCR' ELSE city END AS city,
         country, last_updated
  FROM clean_users WHERE last_updated > {_ts_sql(CHANGES_SINCE)}),
flagged AS (
  SELECT o.*, (i.user_id IS NOT NULL AND ({diff})) AS changed
  FROM old o LEFT JOIN inc i ON o.user_id = i.user_id AND o.is_active = 1),
kept AS (SELECT {cols}, start_date, end_date, is_active, source_last_updated FROM flagged WHERE NOT changed),
closed AS (
  SELECT {cols}, start_date, {_ts_sql(RUN2_TS)} AS end_date, 0 AS is_active, source_last_updated
  FROM flagged WHERE changed),
inserted AS (
  SELECT (SELECT COALESCE(MAX(customer_key), 0) FROM old) + row_number() OVER (ORDER BY user_id) AS customer_key,
         user_id, name, email, city, country, {_ts_sql(RUN2_TS)} AS start_date,
         CAST(NULL AS TIMESTAMP) AS end_date, 1 AS is_active, last_updated AS source_last_updated
  FROM inc WHERE user_id NOT IN (SELECT user_id FROM kept WHERE is_active = 1)),
scd2 AS (SELECT * FROM kept UNION ALL SELECT * FROM closed UNION ALL SELECT * FROM inserted)"""


def _reload_sql(keys: list[str]) -> str:
    on = " AND ".join(f"e.{k} = c.{k}" for k in keys)
    return _STAR_WITH.replace("WITH ", "WITH ", 1) + f""",
existing AS (
  SELECT sale_id, source_order_item_id,
         CASE WHEN date_key >= {FACT_MOVED_FROM}
              THEN CAST(strftime(strptime(CAST(date_key AS VARCHAR), '%Y%m%d') - INTERVAL 1 DAY, '%Y%m%d') AS INTEGER)
              ELSE date_key END AS date_key
  FROM fact_sales WHERE date_key < {FACT_LOADED_BEFORE}),
fresh AS (
  SELECT c.* FROM fact_rows c WHERE NOT EXISTS (SELECT 1 FROM existing e WHERE {on}))
SELECT (SELECT COALESCE(MAX(sale_id), 0) FROM existing)
         + row_number() OVER (ORDER BY source_order_item_id, date_key) AS sale_id,
       source_order_item_id, customer_key, product_key, date_key, order_id, quantity, unit_price, total_amount,
       {_ts_sql(RUN2_TS)} AS load_dts
FROM fresh"""


def _stream_sql() -> str:
    """Facts of the purchase feed, with the dimensions the runner loads (after e-mail de-duplication)."""
    return _with(_SRC, _DEDUP) + """,
products AS (SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id FROM src_products),
rows AS (
  SELECT e.event_id AS source_order_item_id, c.customer_key, p.product_key, CAST(strftime(e.ts, '%Y%m%d') AS INTEGER) AS date_key, e.event_id AS order_id,
         1 AS quantity, CAST(e.value AS DECIMAL(12,2)) AS unit_price, CAST(ROUND(CAST(e.value AS DECIMAL(12,2)), 2) AS DECIMAL(14,2)) AS total_amount
  FROM events e
  JOIN dd_customer c ON c.user_id = e.user_id
  JOIN products p ON p.product_id = CAST(json_extract_string(e.props, '$.k') AS BIGINT)
  WHERE e.event_type = 'purchase')
"""


def _batch2_sql() -> str:
    """The star after two batches of the runner (with e-mail de-duplication)."""
    ts = _ts_sql(CHANGE_TS)
    cols = "user_id, name, email, city, country"
    return _with(_SRC, _DEDUP) + f""",
c1 AS (
  SELECT row_number() OVER (ORDER BY user_id) AS customer_key, {cols}, {_AS_OF} AS start_date,
         CAST(NULL AS TIMESTAMP) AS end_date, 1 AS is_active, last_updated AS source_last_updated
  FROM dedup_users),
moved AS (
  SELECT user_id, name, email, city || ' NCR' AS city, country, {ts} AS last_updated
  FROM src_users WHERE country = '{RELOCATED_REGION}' AND user_id % 10 <> 9),
c2 AS (
  SELECT customer_key, {cols}, start_date,
         CASE WHEN user_id IN (SELECT user_id FROM moved) THEN {_ts_sql(RUN2_TS)} END AS end_date,
         CASE WHEN user_id IN (SELECT user_id FROM moved) THEN 0 ELSE 1 END AS is_active, source_last_updated
  FROM c1
  UNION ALL
  SELECT (SELECT COALESCE(MAX(customer_key), 0) FROM c1) + row_number() OVER (ORDER BY user_id), {cols},
         {_ts_sql(RUN2_TS)}, CAST(NULL AS TIMESTAMP), 1, last_updated
  FROM moved),
p2 AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category,
         CASE WHEN product_id % {RAISED_EVERY} = 0 THEN CAST(price + 100 AS DECIMAL(12,2)) ELSE price END AS price,
         CASE WHEN product_id % {RAISED_EVERY} = 0 THEN {ts} ELSE last_updated END AS source_last_updated
  FROM src_products),
new_orders AS (
  SELECT order_id + {NEW_ID} AS order_id, user_id FROM src_orders WHERE order_id % {NEW_ORDER_EVERY} = 0),
f1 AS (
  SELECT i.order_item_id AS source_order_item_id, c.customer_key, p.product_key,
         CAST(strftime(o.order_date, '%Y%m%d') AS INTEGER) AS date_key, o.order_id, i.quantity,
         i.price AS unit_price, CAST(ROUND(i.quantity * i.price, 2) AS DECIMAL(14,2)) AS total_amount
  FROM src_items i JOIN src_orders o ON o.order_id = i.order_id
  JOIN c1 c ON c.user_id = o.user_id JOIN p2 p ON p.product_id = i.product_id
  WHERE o.status <> 'CANCELLED'),
f2 AS (
  SELECT o.order_id * 2 + x.j AS source_order_item_id, c.customer_key, p.product_key,
         CAST(strftime({ts}, '%Y%m%d') AS INTEGER) AS date_key, o.order_id, x.q AS quantity,
         CAST(x.c AS DECIMAL(12,2)) AS unit_price, CAST(x.q * x.c AS DECIMAL(14,2)) AS total_amount
  FROM new_orders o CROSS JOIN (VALUES (0, 20, 2, 1499.00), (1, 35, 1, 999.00)) AS x(j, p, q, c)
  JOIN c2 c ON c.user_id = o.user_id AND c.is_active = 1 JOIN p2 p ON p.product_id = x.p),
facts AS (
  SELECT row_number() OVER (ORDER BY source_order_item_id, date_key) AS sale_id, *, {_AS_OF} AS load_dts FROM f1
  UNION ALL
  SELECT (SELECT COUNT(*) FROM f1) + row_number() OVER (ORDER BY source_order_item_id, date_key), *, {_ts_sql(RUN2_TS)} FROM f2),
dates AS (
  SELECT DISTINCT CAST(order_date AS DATE) AS d FROM src_orders WHERE order_date IS NOT NULL
  UNION SELECT CAST({ts} AS DATE) FROM new_orders)"""


def _batch2_log_sql(variant: str) -> str:
    loads = ["SCD_LOAD", "FACT_INCREMENTAL"] if variant == "split" else ["LOAD"]
    counts = [
        {"EXTRACT": "(SELECT COUNT(*) FROM src_orders)", "TRANSFORM": "(SELECT COUNT(*) FROM dedup_users)",
         "SCD_LOAD": "(SELECT COUNT(*) FROM c1)", "FACT_INCREMENTAL": "(SELECT COUNT(*) FROM f1)", "LOAD": "(SELECT COUNT(*) FROM f1)"},
        {"EXTRACT": "(SELECT COUNT(*) FROM new_orders)", "TRANSFORM": "(SELECT COUNT(*) FROM moved)",
         "SCD_LOAD": "(SELECT COUNT(*) FROM moved)", "FACT_INCREMENTAL": "(SELECT COUNT(*) FROM f2)", "LOAD": "(SELECT COUNT(*) FROM f2)"},
        {},
    ]
    rows = []
    for batch, n, loaded, run in zip(["batch-1", "batch-2", "feed-1"], counts, [RUN_TS, RUN2_TS, RUN2_TS],
                                     [RUN_TS, RUN2_TS, _shift(RUN2_TS, hours=1)]):
        for phase in ["EXTRACT", "TRANSFORM", *loads, "RUN"]:
            rows.append((batch, phase, "1" if phase == "RUN" else n.get(phase, "0"), loaded, run, "SUCCESS", MESSAGES[phase]))
    failed = _shift(RUN2_TS, hours=2)
    rows.append(("batch-3", "RUN", "0", failed, failed, "FAILED", FAILED_MESSAGE))
    return _batch2_sql() + "\n" + _union_counts(
        f"SELECT CAST({i + 1} AS BIGINT) AS etl_id, '{b}' AS batch_id, '{p}' AS phase, {_ts_sql(loaded)} AS last_loaded_time, "
        f"CAST({n} AS BIGINT) AS rows_affected, '{status}' AS status, '{msg}' AS message, {_ts_sql(run)} AS created_at"
        for i, (b, p, n, loaded, run, status, msg) in enumerate(rows))


def _union_counts(items) -> str:
    return "\nUNION ALL ".join(items)


def _portable_sql(name: str, sql: str) -> str:
    money, dates = OUTPUT_CASTS.get(name, ([], []))
    repl = [f"CAST({c} AS DOUBLE) AS {c}" for c in money] + [f"CAST({c} AS TIMESTAMP) AS {c}" for c in dates]
    if not repl:
        return sql
    return f"SELECT * REPLACE ({', '.join(repl)}) FROM (\n{sql}\n) AS q"


def oracle_sql() -> dict[str, str]:
    return {name: _portable_sql(name, sql) for name, sql in _oracle_sql().items()} | _LLM_SQL


def _oracle_sql() -> dict[str, str]:
    rev = _REV.format("f.total_amount")
    src = _with(_SRC)
    src_pay = _with(_SRC, _PAYMENTS)
    user_cols = ["user_id", "name", "email", "city", "country", "created_at", "last_updated"]
    limits = schemas.VARCHAR_LIMITS["users"]
    staged_orders = f"SELECT order_id FROM src_orders WHERE last_updated > {_ts_sql(ORDERS_WATERMARK)}"
    log_with = _with(_SRC, _DEDUP, _log_sql())
    names = {"users": "src_users", "products": "src_products", "orders": "src_orders", "order_items": "src_items", "payments": "src_payments"}
    fk_sql = {
        ("orders", "user_id", "users", "user_id"): ("src_orders", "src_users"),
        ("order_items", "order_id", "orders", "order_id"): ("src_items", "src_orders"),
        ("order_items", "product_id", "products", "product_id"): ("src_items", "src_products"),
        ("payments", "order_id", "orders", "order_id"): ("src_payments", "src_orders"),
    }
    orphan_parts = [
        f"SELECT '{c}.{cc} -> {p}.{pc}' AS relation, COUNT(*) AS orphan_rows FROM {fk_sql[(c, cc, p, pc)][0]} x "
        f"WHERE x.{cc} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {fk_sql[(c, cc, p, pc)][1]} y WHERE y.{pc} = x.{cc})"
        for c, cc, p, pc in schemas.FOREIGN_KEYS
    ]
    return {
        "revenue_by_month": _STAR_WITH + f"""
SELECT d.year_num, d.month_num, d.month_name, {rev} AS revenue
FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key
GROUP BY d.year_num, d.month_num, d.month_name
ORDER BY d.year_num, d.month_num""",
        "revenue_by_quarter": _STAR_WITH + f"""
SELECT d.year_num, d.quarter_num, {rev} AS revenue
FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key
GROUP BY d.year_num, d.quarter_num
ORDER BY d.year_num, d.quarter_num""",
        "weekday_weekend_revenue": _STAR_WITH + f"""
SELECT CASE WHEN d.is_weekend = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type, {rev} AS revenue
FROM fact_sales f JOIN dim_date d ON d.date_key = f.date_key
GROUP BY d.is_weekend""",
        "top_customers": _STAR_WITH + f"""
SELECT c.user_id, c.name, c.city, c.country, {rev} AS total_spent,
       COUNT(DISTINCT f.order_id) AS total_orders
FROM fact_sales f JOIN dim_customer c ON c.customer_key = f.customer_key
GROUP BY c.user_id, c.name, c.city, c.country
ORDER BY total_spent DESC, c.user_id NULLS FIRST, c.name NULLS FIRST, c.city NULLS FIRST, c.country NULLS FIRST
LIMIT 10""",
        "top_products": _STAR_WITH + f"""
SELECT p.product_id, p.product_name, p.category, CAST(SUM(f.quantity) AS BIGINT) AS units_sold,
       {rev} AS sales_amount
FROM fact_sales f JOIN dim_product p ON p.product_key = f.product_key
GROUP BY p.product_id, p.product_name, p.category
ORDER BY units_sold DESC, sales_amount DESC, p.product_id NULLS FIRST, p.product_name NULLS FIRST,
         p.category NULLS FIRST
LIMIT 10""",
        "dim_date_build": src + f"""
SELECT {_calendar('d')}
FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM src_orders WHERE order_date IS NOT NULL)""",
        "dim_date_incremental": src + f"""
SELECT {_calendar('d')}
FROM (SELECT DISTINCT CAST(order_date AS DATE) AS d FROM src_orders
      WHERE order_date >= {_ts_sql(DIM_DATE_STAGED_FROM)}) st
WHERE d NOT IN (SELECT DISTINCT CAST(order_date AS DATE) FROM src_orders
                WHERE order_date < {_ts_sql(DIM_DATE_LOADED_BEFORE)})""",
        "extract_orders_incremental": src + f"""
SELECT * FROM src_orders WHERE last_updated > {_ts_sql(ORDERS_WATERMARK)}""",
        "extract_users_incremental": src + f"""
SELECT * FROM src_users WHERE last_updated > {_ts_sql(USERS_WATERMARK)}""",
        "extract_items_semi": src + f"""
SELECT i.* FROM src_items i WHERE i.order_id IN ({staged_orders})""",
        "extract_payments_semi": src_pay + f"""
SELECT p.* FROM src_payments p WHERE p.order_id IN ({staged_orders})""",
        "clean_users": src + "\nSELECT * FROM clean_users",
        "dedup_users": _with(_SRC, _DEDUP) + "\nSELECT * FROM dedup_users",
        "dedup_users_folded": src + """,
spelled AS (
  SELECT user_id, name, CASE user_id % 3 WHEN 0 THEN upper(email) WHEN 1 THEN replace(replace(email, 'user', 'ùsér'), 'example', 'ÉXÄMPLÉ') ELSE email END AS email,
         city, country, created_at, last_updated FROM clean_users)
SELECT * FROM spelled QUALIFY user_id = min(user_id) OVER (PARTITION BY strip_accents(lower(email)))""",
        "dedup_dropped": _with(_SRC, _DEDUP) + """
SELECT u.user_id, u.email, d.user_id AS kept_user_id
FROM clean_users u JOIN dedup_users d ON d.email = u.email
WHERE u.user_id NOT IN (SELECT user_id FROM dedup_users)""",
        "scd1_upsert": src + f""",
old AS (
  SELECT row_number() OVER (ORDER BY product_id) AS product_key, product_id, product_name, category, price,
         last_updated AS source_last_updated
  FROM src_products WHERE last_updated <= {_ts_sql(LOADED_UNTIL)}),
inc AS (
  SELECT product_id, product_name, category, CAST(price + 100 AS DECIMAL(12,2)) AS price,
         last_updated AS source_last_updated
  FROM src_products WHERE last_updated > {_ts_sql(CHANGES_SINCE)})
SELECT o.product_key, o.product_id,
       CASE WHEN i.product_id IS NOT NULL THEN i.product_name ELSE o.product_name END AS product_name,
       CASE WHEN i.product_id IS NOT NULL THEN i.category ELSE o.category END AS category,
       CASE WHEN i.product_id IS NOT NULL THEN i.price ELSE o.price END AS price,
       CASE WHEN i.product_id IS NOT NULL THEN i.source_last_updated ELSE o.source_last_updated END
         AS source_last_updated
FROM old o LEFT JOIN inc i ON i.product_id = o.product_id
UNION ALL
SELECT (SELECT COALESCE(MAX(product_key), 0) FROM old) + row_number() OVER (ORDER BY product_id) AS product_key,
       product_id, product_name, category, price, source_last_updated
FROM inc WHERE product_id NOT IN (SELECT product_id FROM old)""",
        "scd2_apply": _with(_SRC, _scd2_sql()) + "\nSELECT * FROM scd2",
        "scd2_active_unique": _with(_SRC, _scd2_sql()) + """
SELECT COUNT(*) AS versions, CAST(SUM(is_active) AS BIGINT) AS active_rows,
       COUNT(DISTINCT CASE WHEN is_active = 1 THEN user_id END) AS active_users,
       COUNT(DISTINCT user_id) AS users
FROM scd2""",
        "dim_customer_load": _STAR_WITH + "\nSELECT * FROM dim_customer",
        "fact_load": _STAR_WITH + "\nSELECT * FROM fact_sales",
        "fact_load_idempotent": _reload_sql(["source_order_item_id", "date_key"]),
        "fact_match_item_only": _reload_sql(["source_order_item_id"]),
        "fact_range_label": _STAR_WITH + """
SELECT CAST(date_key // 10000 AS INTEGER) AS sales_year,
       CASE WHEN date_key < 20250101 THEN 'p_before_2025' WHEN date_key < 20260101 THEN 'p_2025'
            WHEN date_key < 20270101 THEN 'p_2026' WHEN date_key < 20280101 THEN 'p_2027'
            ELSE 'p_max' END AS range_partition,
       COUNT(*) AS rows_in_partition, CAST(ROUND(SUM(total_amount), 2) AS DECIMAL(38,2)) AS revenue
FROM fact_sales GROUP BY 1, 2""",
        "fact_rejects": _with(_SRC, _DEDUP) + """
SELECT i.order_id, i.product_id, i.quantity, i.price, o.user_id,
       CASE WHEN o.order_id IS NULL THEN 'unknown order' WHEN c.user_id IS NULL THEN 'no active customer'
            ELSE 'unknown product' END AS reason
FROM src_items i
LEFT JOIN src_orders o ON o.order_id = i.order_id
LEFT JOIN dd_customer c ON c.user_id = o.user_id
LEFT JOIN src_products p ON p.product_id = i.product_id
WHERE o.order_id IS NULL OR (o.status <> 'CANCELLED' AND (c.user_id IS NULL OR p.product_id IS NULL))""",
        "order_totals_refresh": src + """
SELECT o.order_id, o.user_id, o.order_date,
       CASE WHEN t.amt IS NOT NULL THEN CAST(t.amt AS DECIMAL(12,2)) ELSE o.total_amount END AS total_amount,
       o.status, o.last_updated
FROM src_orders o
LEFT JOIN (SELECT order_id, ROUND(SUM(quantity * price), 2) AS amt FROM src_items GROUP BY order_id) t
  ON t.order_id = o.order_id""",
        "derive_payments": src_pay + "\nSELECT * FROM src_payments",
        "point_update_price": src + """
SELECT product_id, product_name, category,
       CASE WHEN product_id = 20 THEN CAST(price + 100 AS DECIMAL(12,2)) ELSE price END AS price, last_updated
FROM src_products""",
        "point_update_user": src + """
SELECT user_id, name, email,
       CASE WHEN user_id = 101 THEN 'Delhi NCR' ELSE city END AS city,
       CASE WHEN user_id = 101 THEN 'India' ELSE country END AS country, created_at, last_updated
FROM src_users""",
        "surrogate_keys": src + "\nSELECT * FROM src_items",
        "check_unique": src + """
SELECT email, COUNT(*) AS n FROM src_users GROUP BY email HAVING COUNT(*) > 1""",
        "check_orphans": src_pay + "\n" + _union_counts(orphan_parts),
        "check_not_null": src + "\n" + _union_counts(
            f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_count "
            f"FROM src_users" for c in user_cols),
        "check_lengths": src + "\n" + _union_counts(
            f"SELECT '{c}' AS column_name, CAST(SUM(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS violations FROM src_users" for c, n in limits.items()),
        "check_unique_all": _with(_SRC, _PAYMENTS, _STAR) + "\n" + _union_counts(
            f"SELECT '{t}' AS table_name, '{', '.join(k)}' AS key_columns, COUNT(*) AS duplicated FROM (SELECT 1 FROM {names.get(t, t)} "
            f"WHERE {' AND '.join(f'{c} IS NOT NULL' for c in k)} GROUP BY {', '.join(k)} HAVING COUNT(*) > 1)" for t, k in DECLARED_KEYS),
        "check_not_null_all": src_pay + "\n" + _union_counts(
            f"SELECT '{t}' AS table_name, '{f.name}' AS column_name, CAST(COALESCE(SUM(CASE WHEN {f.name} IS NULL THEN 1 ELSE 0 END), 0) AS BIGINT) "
            f"AS null_count FROM {names[t]}" for t, schema in schemas.SOURCES.items() for f in schema.fields),
        "check_lengths_all": src_pay + "\n" + _union_counts(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(SUM(CASE WHEN length({c}) > {n} THEN 1 ELSE 0 END) AS BIGINT) "
            f"AS violations FROM {names[t]}" for t, cs in schemas.VARCHAR_LIMITS.items() for c, n in cs.items()),
        "check_decimals_all": _union_counts(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, CAST(SUM(CASE WHEN {c} IS NOT NULL AND TRY_CAST({c} AS DECIMAL(12,2)) IS NULL "
            f"THEN 1 ELSE 0 END) AS BIGINT) AS violations FROM {t}" for t, cs in MONEY_COLUMNS.items() for c in cs),
        "money_exact": _STAR_WITH + _union_counts(
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, '{kind}' AS type, CAST(SUM({c}) AS VARCHAR) AS total FROM {names.get(t, t)}"
            for t, c, kind in [("products", "price", "decimal(12,2)"), ("orders", "total_amount", "decimal(12,2)"), ("order_items", "price", "decimal(12,2)"),
                               ("fact_sales", "unit_price", "decimal(12,2)"), ("fact_sales", "total_amount", "decimal(14,2)")]),
        "batch2_dim_product": _batch2_sql() + "\nSELECT * FROM p2",
        "batch2_dim_customer": _batch2_sql() + "\nSELECT * FROM c2",
        "batch2_dim_date": _batch2_sql() + f"\nSELECT {_calendar('d')} FROM dates",
        "batch2_fact": _batch2_sql() + "\nSELECT * FROM facts",
        "batch2_log": _batch2_log_sql("split"),
        "batch2_log_combined": _batch2_log_sql("combined"),
        "batch2_watermark": f"SELECT MAX(last_loaded_time) AS last_loaded_time FROM ({_batch2_log_sql('split')}) AS l WHERE status = 'SUCCESS'",
        "batch2_error_tail": f"SELECT CAST(1 AS BIGINT) AS error_id, 'batch-3' AS batch_id, 'run_etl' AS procedure_name, "
                             f"'{ERROR_MESSAGE}' AS error_message, {_ts_sql(_shift(RUN2_TS, hours=2))} AS created_at",
        "row_count_audit": _with(_SRC, _PAYMENTS, _STAR) + "\n" + _union_counts(
            f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {rel}" for name, rel in [
                ("users", "src_users"), ("products", "src_products"), ("orders", "src_orders"),
                ("order_items", "src_items"), ("payments", "src_payments"), ("dim_customer", "dim_customer"),
                ("dim_product", "dim_product"), ("dim_date", "dim_date"), ("fact_sales", "fact_sales")]),
        "etl_batch_log": log_with + "\nSELECT * FROM etl_log",
        "watermark": log_with + """,
with_failed AS (
  SELECT * FROM etl_log
  UNION ALL
  SELECT etl_id + 1, batch_id, phase, last_loaded_time + INTERVAL 1 HOUR, 0, 'FAILED',
         'ETL failed and rolled back', created_at
  FROM etl_log WHERE phase = 'RUN')
SELECT COALESCE(MAX(last_loaded_time), TIMESTAMP '1900-01-01 00:00:00') AS last_loaded_time
FROM with_failed WHERE status = 'SUCCESS'""",
        "log_tail": log_with + """
SELECT phase, status, rows_affected FROM etl_log ORDER BY etl_id DESC LIMIT 10""",
        "stream_incremental_fact": _STAR_WITH + f""",
feed AS (
  SELECT event_id AS order_item_id, event_id AS order_id, user_id,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id, ts AS order_date,
         1 AS quantity, CAST(value AS DECIMAL(12,2)) AS price
  FROM events WHERE event_type = 'purchase'),
rows AS (
  SELECT e.order_item_id AS source_order_item_id, c.customer_key, p.product_key,
         CAST(strftime(e.order_date, '%Y%m%d') AS INTEGER) AS date_key, e.order_id, e.quantity,
         e.price AS unit_price, CAST(ROUND(e.quantity * e.price, 2) AS DECIMAL(14,2)) AS total_amount
  FROM feed e
  JOIN dim_customer c ON c.user_id = e.user_id AND c.is_active = 1
  JOIN dim_product p ON p.product_id = e.product_id)
SELECT row_number() OVER (ORDER BY source_order_item_id, date_key) AS sale_id, *,
       {_ts_sql(STREAM_RUN_TS)} AS load_dts
FROM rows""",
        "stream_restart_fact": _stream_sql() + f"SELECT *, {_ts_sql(STREAM_RUN_TS)} AS load_dts FROM rows",
        "stream_restart_log": _stream_sql() + """
SELECT CAST(4 AS BIGINT) AS micro_batches, count(*) AS logged_facts, count(*) AS facts, count(*) AS sale_ids, count(*) AS largest_sale_id, 1 AS replays FROM rows""",
        "surrogate_keys_sparse": src + f"""
SELECT order_id * {SPARSE_STEP} AS sparse_id, 1000 + row_number() OVER (ORDER BY order_id) AS surrogate_key FROM src_orders""",
        "surrogate_keys_hot": src + """
SELECT status, order_id, row_number() OVER (ORDER BY status NULLS FIRST, order_id) AS surrogate_key FROM src_orders""",
        "extract_items_pruned": src + f""",
new_orders AS (SELECT order_id + {NEW_ID} AS order_id FROM src_orders WHERE order_id % {NEW_ORDER_EVERY} = 0)
SELECT order_id * 2 + j AS order_item_id, order_id, CAST(p AS BIGINT) AS product_id, q AS quantity, CAST(c AS DECIMAL(12,2)) AS price
FROM new_orders, (VALUES (0, 20, 2, '1499.00'), (1, 35, 1, '999.00')) x(j, p, q, c)""",
        "csv_orders": src + f"""
SELECT * FROM src_orders WHERE order_id % {BAD_FIELDS} <> 0 AND order_id % {BAD_USER} <> 0 AND order_id % {BAD_DATE} <> 0 AND order_id % {BAD_AMOUNT} <> 0""",
        "csv_products": src + f"""
SELECT product_id, product_name || ', "new"' AS product_name, category, price, last_updated FROM src_products
WHERE product_id % {BAD_PRICE} <> 0 AND product_id % {BAD_NAME} <> 0""",
        "csv_rejects": src + f"""
SELECT 'orders' AS table_name, concat_ws(',', CAST(order_id AS VARCHAR), CASE WHEN order_id % {BAD_USER} = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END,
    CASE WHEN order_id % {BAD_DATE} = 0 THEN 'yesterday' ELSE strftime(order_date, '%Y-%m-%d %H:%M:%S') END,
    CASE WHEN order_id % {BAD_AMOUNT} = 0 THEN 'n/a' ELSE CAST(total_amount AS VARCHAR) END, status, strftime(last_updated, '%Y-%m-%d %H:%M:%S'),
    CASE WHEN order_id % {BAD_FIELDS} = 0 THEN 'extra' END) AS line,
  CASE WHEN order_id % {BAD_FIELDS} = 0 THEN 'number of fields' WHEN order_id % {BAD_USER} = 0 THEN 'user_id: empty'
    WHEN order_id % {BAD_DATE} = 0 THEN 'order_date: no timestamp_ntz' ELSE 'total_amount: no decimal(12,2)' END AS reason
FROM src_orders WHERE order_id % {BAD_FIELDS} = 0 OR order_id % {BAD_USER} = 0 OR order_id % {BAD_DATE} = 0 OR order_id % {BAD_AMOUNT} = 0
UNION ALL
SELECT 'products', concat_ws(',', CAST(product_id AS VARCHAR), CASE WHEN product_id % {BAD_NAME} = 0 THEN '' ELSE '"' || replace(product_name || ', "new"', '"', '""') || '"' END,
    '"' || replace(category, '"', '""') || '"', CASE WHEN product_id % {BAD_PRICE} = 0 THEN '12,50' ELSE CAST(price AS VARCHAR) END, strftime(last_updated, '%Y-%m-%d %H:%M:%S')),
  CASE WHEN product_id % {BAD_PRICE} = 0 THEN 'number of fields' ELSE 'product_name: empty' END
FROM src_products WHERE product_id % {BAD_PRICE} = 0 OR product_id % {BAD_NAME} = 0""",
        "point_update_files": src + """
SELECT product_id, product_name, category, CASE WHEN product_id = 20 THEN CAST(price + 100 AS DECIMAL(12,2)) ELSE price END AS price, last_updated, 1 AS rewritten_files
FROM src_products""",
        "order_totals_incremental": src + f""",
all_items AS (
  SELECT order_id, quantity, price + CASE WHEN order_id % {REPRICED_EVERY} = 0 THEN 1 ELSE 0 END AS price FROM src_items
  UNION ALL SELECT order_id + {NEW_ID}, q, c FROM src_orders, (VALUES (2, 1499.00), (1, 999.00)) x(q, c) WHERE order_id % {NEW_ORDER_EVERY} = 0),
all_orders AS (
  SELECT * FROM src_orders
  UNION ALL SELECT order_id + {NEW_ID}, user_id, {_ts_sql(CHANGE_TS)}, 3997.00, 'DELIVERED', {_ts_sql(CHANGE_TS)} FROM src_orders WHERE order_id % {NEW_ORDER_EVERY} = 0),
sums AS (SELECT order_id, CAST(ROUND(SUM(quantity * price), 2) AS DECIMAL(12,2)) AS amt FROM all_items GROUP BY order_id)
SELECT o.order_id, o.user_id, o.order_date, COALESCE(t.amt, o.total_amount) AS total_amount, o.status, o.last_updated
FROM all_orders o LEFT JOIN sums t ON t.order_id = o.order_id""",
        "check_unique_incremental": _STAR_WITH + f"""
SELECT source_order_item_id, date_key, CAST(2 AS BIGINT) AS n FROM fact_sales
WHERE date_key < {FACT_LOADED_BEFORE} AND source_order_item_id % {NEW_ORDER_EVERY} = 0""",
        "revenue_of_week_53": _batch2_sql() + f""",
cal AS (SELECT {_calendar('d')} FROM dates)
SELECT d.year_num, d.month_num, d.month_name, {_REV.format('f.total_amount')} AS revenue
FROM facts f JOIN cal d ON d.date_key = f.date_key WHERE d.week_of_year = 53 GROUP BY ALL""",
        "batch2_log_tail": f"SELECT etl_id, batch_id, phase, status, rows_affected FROM ({_batch2_log_sql('split')}) AS log ORDER BY etl_id DESC LIMIT 3",
        "batch2_last_keys": _batch2_sql() + """
SELECT 'dim_customer' AS table_name, count(*) AS last_key, max(customer_key) AS largest_key, count(*) AS n_rows FROM c2
UNION ALL SELECT 'dim_product', count(*), max(product_key), count(*) FROM p2
UNION ALL SELECT 'fact_sales', count(*), max(sale_id), count(*) FROM facts""",
        "batch_identity": "SELECT CAST(2 AS BIGINT) AS batch_ids, CAST(2 AS BIGINT) AS uuids, CAST(2 AS BIGINT) AS stamps_in_run, count(*) AS products FROM part",
    }
