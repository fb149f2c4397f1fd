"""Idempotent incremental load of ``fact_sales``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart import schemas
from starmart.functions import date_key, line_amount, not_cancelled
from starmart.operators.keys import assign_surrogate_keys, max_key

# Which columns identify an already-loaded fact.
MATCH_KEYS = {
    "split": ["source_order_item_id", "date_key"],   # the declared unique key
    "combined": ["source_order_item_id"],
}


def _ts(run_ts) -> Column:
    return run_ts if isinstance(run_ts, Column) else F.lit(run_ts).cast("timestamp_ntz")


def fact_candidates(staged_items: DataFrame, staged_orders: DataFrame, dim_customer: DataFrame,
                    dim_product: DataFrame, with_item_id: bool = True) -> DataFrame:
    """Star join of staged items with their order, the customer's **active**
    version (at load time, not as of the order date) and the product.

    Orders are filtered (not cancelled) and joined to customers before they
    meet the items: orders are the narrower side, so the user-id join runs on
    fewer rows. Items whose customer or product is missing drop out (see
    ``fact_rejects``).
    """
    orders = staged_orders.where(not_cancelled()).select(
        "order_id", "user_id", date_key("order_date").alias("date_key")
    )
    customers = dim_customer.where(F.col("is_active") == 1).select("user_id", "customer_key")
    products = dim_product.select("product_id", "product_key")
    item_cols = ["order_id", "product_id", "quantity", "price"] + (["order_item_id"] if with_item_id else [])
    rows = (
        staged_items.select(*item_cols)
        .join(orders.join(customers, "user_id"), "order_id")
        .join(products, "product_id")
    )
    out = [
        F.col("customer_key"), F.col("product_key"), F.col("date_key"), F.col("order_id"),
        F.col("quantity"), F.col("price").alias("unit_price"),
        line_amount("quantity", "price").alias("total_amount"),
    ]
    if with_item_id:
        out = [F.col("order_item_id").alias("source_order_item_id")] + out
    return rows.select(*out)


def fact_rejects(staged_items: DataFrame, staged_orders: DataFrame, dim_customer: DataFrame,
                 dim_product: DataFrame) -> DataFrame:
    """Non-cancelled staged items that produce no fact because their order,
    active customer or product is missing, with the reason."""
    orders = staged_orders.select("order_id", "user_id", F.coalesce(not_cancelled(), F.lit(False)).alias("_live"))
    customers = dim_customer.where(F.col("is_active") == 1).select("user_id", F.lit(True).alias("_has_c"))
    products = dim_product.select("product_id", F.lit(True).alias("_has_p"))
    items = staged_items.join(orders.join(customers, "user_id", "left"), "order_id", "left").join(products, "product_id", "left")
    reason = (
        F.when(F.col("_live").isNull(), F.lit("unknown order"))
        .when(~F.col("_live"), F.lit(None))
        .when(F.col("_has_c").isNull(), F.lit("no active customer"))
        .when(F.col("_has_p").isNull(), F.lit("unknown product"))
    )
    return items.withColumn("reason", reason).where(F.col("reason").isNotNull()).drop("_live", "_has_c", "_has_p")


def not_yet_loaded(candidates: DataFrame, existing_fact: DataFrame, match_on: str = "split") -> DataFrame:
    """Candidates whose match key is not in the fact table.

    One anti join. The existing fact is cut to the batch's range of every key
    column first (and of ``sales_year``, where the date is part of the key and the
    fact is partitioned by it), so that partitions and row groups outside the
    range are skipped, and only facts within it are shuffled.
    """
    keys = MATCH_KEYS[match_on]
    existing = existing_fact
    ends = candidates.agg(*(f(k).alias(f"{end}_{k}") for k in keys for end, f in (("low", F.min), ("high", F.max))))
    for k in keys:
        low, high = ends.select(f"low_{k}").scalar(), ends.select(f"high_{k}").scalar()
        existing = existing.where(F.col(k).between(low, high))
        if k == "date_key" and "sales_year" in existing_fact.columns:
            existing = existing.where(F.col("sales_year").between(F.floor(low / 10000), F.floor(high / 10000)))
    return candidates.join(existing.select(*keys), keys, "left_anti").select(*candidates.columns)


def load_facts(candidates: DataFrame, existing_fact: DataFrame, run_ts, match_on: str = "split",
               base_sale_id: Column | int | None = None) -> DataFrame:
    """New ``fact_sales`` rows: not-yet-loaded candidates with the next
    ``sale_id`` values (in natural-key order) and ``load_dts = run_ts``."""
    fresh = not_yet_loaded(candidates, existing_fact, match_on)
    base = max_key(existing_fact, "sale_id") if base_sale_id is None else base_sale_id
    keyed = assign_surrogate_keys(fresh, ["source_order_item_id", "date_key"], "sale_id", base=base)
    return schemas.conform(keyed.withColumn("load_dts", _ts(run_ts)), schemas.FACT_SALES)
