"""Calendar dimension, SCD-1 product dimension, SCD-2 customer
dimension. Parquet files are immutable, so every "update" returns the next
snapshot as a DataFrame; the warehouse layer decides what gets written."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import any_changed, calendar_columns, date_key
from starmart.operators.keys import assign_surrogate_keys, max_key
from starmart.session import materialize

CUSTOMER_TRACKED = ["name", "email", "city", "country"]
PRODUCT_ATTRIBUTES = ["product_name", "category", "price", "source_last_updated"]


# ---------------------------------------------------------------- D1 dim_date
def date_rows(dates: DataFrame, full_date: str = "full_date") -> DataFrame:
    """``dim_date`` rows for a frame of distinct dates."""
    d = F.col(full_date)
    return schemas.conform(
        dates.select(date_key(d).alias("date_key"), d.alias("full_date"), *calendar_columns(d)),
        schemas.DIM_DATE,
    )


def new_dates(staged_orders: DataFrame, dim_date: DataFrame, order_date: str = "order_date") -> DataFrame:
    """Calendar rows for order dates not yet in ``dim_date`` (cancelled
    orders included). Distinct on the date first - a map-side combined
    aggregate - then the anti join, then the attributes."""
    dates = staged_orders.select(F.to_date(order_date).alias("full_date")).where("full_date IS NOT NULL").distinct()
    fresh = dates.join(dim_date.select("full_date"), "full_date", "left_anti")
    return date_rows(fresh)


# ---------------------------------------------------------- D2 SCD-1 product
def scd1_upsert(dim_product: DataFrame, staged_products: DataFrame, base_key: Column | int | None = None) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE`` on ``product_id``.

    Known products take every incoming attribute (no change detection, an
    incoming NULL overwrites) and keep their ``product_key``; new products get
    the next keys in ``product_id`` order. One left join overwrites; the new
    products come from an anti join of the batch, which is all that is numbered.
    """
    inc = staged_products.select(
        "product_id", "product_name", "category", "price",
        F.col("last_updated").alias("source_last_updated"),
    )
    d, i = dim_product.alias("d"), inc.alias("i")
    incoming = F.col("i.product_id").isNotNull()
    known = d.join(i, F.col("d.product_id") == F.col("i.product_id"), "left").select(
        "d.product_key", "d.product_id",
        *[F.when(incoming, F.col(f"i.{c}")).otherwise(F.col(f"d.{c}")).alias(c) for c in PRODUCT_ATTRIBUTES],
    )
    base = max_key(dim_product, "product_key") if base_key is None else base_key
    fresh = assign_surrogate_keys(inc.join(dim_product.select("product_id"), "product_id", "left_anti"),
                                  ["product_id"], "product_key", base=base)
    return schemas.conform(known.unionByName(fresh), schemas.DIM_PRODUCT)


def scd1_changes(dim_product: DataFrame, staged_products: DataFrame, base_key: Column | int) -> DataFrame:
    """The rows an SCD-1 upsert writes, and only those: known products with
    every incoming attribute under their existing ``product_key``, and new
    products with the next keys in ``product_id`` order.

    The staged ids find the known products in a semi join, written once, and the
    staged rows are split against that result, which is no larger than the
    batch; Spark broadcasts either where its measured size allows.
    """
    inc = staged_products.select(
        "product_id", "product_name", "category", "price",
        F.col("last_updated").alias("source_last_updated"),
    )
    known = materialize(dim_product.select("product_key", "product_id").join(inc.select("product_id"), "product_id", "left_semi"))
    updated = inc.join(known, "product_id")
    fresh = assign_surrogate_keys(inc.join(known.select("product_id"), "product_id", "left_anti"),
                                  ["product_id"], "product_key", base=base_key)
    return schemas.conform(updated.unionByName(fresh), schemas.DIM_PRODUCT)


def latest_rows(base: DataFrame, later: DataFrame, key: str) -> DataFrame:
    """Current rows of a table kept by upserts: ``later`` holds upserts tagged
    with ``batch_seq``; per key the latest wins, and base rows with a later
    upsert drop out. Columns and their order are those of ``base``."""
    cols = base.columns
    newest = later.groupBy(key).agg(F.max_by(F.struct(*cols), "batch_seq").alias("_row")).select("_row.*")
    return base.join(newest.select(key), key, "left_anti").select(*cols).unionByName(newest)


def latest_products(base: DataFrame, later: DataFrame) -> DataFrame:
    """Current SCD-1 rows (see ``latest_rows``)."""
    return latest_rows(base.select(*schemas.DIM_PRODUCT.fieldNames()), later, "product_id")


# --------------------------------------------------------- D3/D4 SCD-2 customer
class Scd2Result(NamedTuple):
    active: DataFrame   # next set of active rows (unchanged, plus new versions)
    closed: DataFrame   # rows expired by this batch
    inserted: DataFrame  # the new versions alone (also inside ``active``)


def scd2_split(active: DataFrame, staged_users: DataFrame, run_ts, base_key: Column | int,
               collation: str | None = None) -> Scd2Result:
    """SCD-2 over the active rows only.

    D3: an active row whose tracked attributes differ from the staged user
    (NULL and '' equal) is closed: ``end_date = run_ts``, ``is_active = 0``.
    D4: every staged user left without an active row after D3 - new users
    and those just closed - gets a new active version starting at ``run_ts``
    with the next surrogate key. Closed history is never touched, so a
    warehouse can keep it append-only and rewrite only the active set.
    """
    ts = run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")
    s = staged_users.select("user_id", *CUSTOMER_TRACKED, "last_updated").alias("s")
    a = active.alias("a")
    # Large active side, batch-sized staged side: what they share is no larger
    # than the batch. Written once, it decides which versions close and which
    # staged users need a new one; the dimension is scanned a single time.
    changed = any_changed("a", "s", CUSTOMER_TRACKED, collation)
    cols = [F.col(f"a.{f.name}") for f in schemas.DIM_CUSTOMER.fields]
    matched = materialize(a.join(s, F.col("a.user_id") == F.col("s.user_id")).select(*cols, changed.alias("_changed")))
    closed = matched.where("_changed").drop("_changed").withColumns({"end_date": ts, "is_active": F.lit(0)})
    still_active = active.join(closed.select("customer_key"), "customer_key", "left_anti")
    kept_ids = matched.where(~F.col("_changed")).select("user_id")
    inserts = staged_users.join(kept_ids, "user_id", "left_anti").select(
        "user_id", *CUSTOMER_TRACKED,
        ts.alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"),
        F.lit(1).alias("is_active"),
        F.col("last_updated").alias("source_last_updated"),
    )
    inserted = schemas.conform(
        assign_surrogate_keys(inserts, ["user_id"], "customer_key", base=base_key),
        schemas.DIM_CUSTOMER
    )
    next_active = schemas.conform(still_active, schemas.DIM_CUSTOMER).unionByName(inserted)
    return Scd2Result(next_active, schemas.conform(closed, schemas.DIM_CUSTOMER), inserted)


def scd2_apply(dim_customer: DataFrame, staged_users: DataFrame, run_ts,
               base_key: Column | int | None = None, collation: str | None = None) -> DataFrame:
    """Full next snapshot of ``dim_customer`` (all versions)."""
    active = dim_customer.where(F.col("is_active") == 1)
    history = dim_customer.where(~(F.col("is_active") == 1) | F.col("is_active").isNull())
    base = max_key(dim_customer, "customer_key") if base_key is None else base_key
    r = scd2_split(active, staged_users, run_ts, base, collation=collation)
    return schemas.conform(history, schemas.DIM_CUSTOMER).unionByName(r.closed).unionByName(r.active)


def initial_customers(staged_users: DataFrame, run_ts) -> DataFrame:
    """First load of an empty ``dim_customer``: one active version per user."""
    ts = F.lit(run_ts).cast("timestamp_ntz") if not isinstance(run_ts, Column) else run_ts
    rows = staged_users.select(
        "user_id", *CUSTOMER_TRACKED, ts.alias("start_date"),
        F.lit(None).cast("timestamp_ntz").alias("end_date"), F.lit(1).alias("is_active"),
        F.col("last_updated").alias("source_last_updated"),
    )
    return schemas.conform(assign_surrogate_keys(rows, ["user_id"], "customer_key"), schemas.DIM_CUSTOMER)


def initial_products(staged_products: DataFrame) -> DataFrame:
    """First load of an empty ``dim_product``."""
    rows = staged_products.select(
        "product_id", "product_name", "category", "price", F.col("last_updated").alias("source_last_updated")
    )
    return schemas.conform(assign_surrogate_keys(rows, ["product_id"], "product_key"), schemas.DIM_PRODUCT)
