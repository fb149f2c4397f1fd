"""Source-side maintenance (order totals, payments, point updates)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starmart.functions import money, pick

# Payment methods picked by ``1 + order_id MOD 4``.
PAYMENT_METHODS = ["CARD", "UPI", "NETBANKING", "WALLET"]
PAYMENT_DELAY_CYCLE_MINUTES = 180


def order_totals(order_items: DataFrame) -> DataFrame:
    """``SELECT order_id, ROUND(SUM(quantity * price), 2) AS amt ... GROUP BY
    order_id`` (map-side combined)."""
    return order_items.groupBy("order_id").agg(
        F.round(F.sum(F.col("quantity") * F.col("price")), 2).alias("amt")
    )


def refresh_order_totals(orders: DataFrame, order_items: DataFrame, touch_ts=None) -> DataFrame:
    """``UPDATE orders JOIN (totals) SET total_amount = amt``: orders without
    items keep their total. With ``touch_ts`` the updated rows also get
    ``last_updated = touch_ts`` (what an ON UPDATE CURRENT_TIMESTAMP column
    does)."""
    totals = order_totals(order_items)
    j = orders.join(totals, "order_id", "left")
    hit = F.col("amt").isNotNull()
    out = j.withColumn("total_amount", F.when(hit, money("amt")).otherwise(F.col("total_amount")))
    if touch_ts is not None:
        ts = touch_ts if isinstance(touch_ts, Column) else F.lit(touch_ts).cast("timestamp_ntz")
        out = out.withColumn("last_updated", F.when(hit, ts).otherwise(F.col("last_updated")))
    return out.select(*orders.columns)


def derive_payments(orders: DataFrame) -> DataFrame:
    """One payment per order: method by ``order_id`` cycle, FAILED for a
    cancelled order else SUCCESS, paid ``order_id MOD 180`` minutes after the
    order. ``payment_id`` follows ``order_id`` order (dense, from 1)."""
    from starmart.operators.keys import assign_surrogate_keys

    rows = orders.select(
        "order_id",
        pick(F.lit(1) + F.col("order_id") % 4, PAYMENT_METHODS).alias("payment_method"),
        F.when(F.col("status") == "CANCELLED", F.lit("FAILED")).otherwise(F.lit("SUCCESS")).alias("payment_status"),
        F.timestamp_add("MINUTE", F.col("order_id") % PAYMENT_DELAY_CYCLE_MINUTES, F.col("order_date")).alias("payment_date"),
    )
    keyed = assign_surrogate_keys(rows, ["order_id"], "payment_id")
    return keyed.select("payment_id", "order_id", "payment_method", "payment_status", "payment_date")


def point_update(df: DataFrame, predicate: Column, assignments: dict) -> DataFrame:
    """``UPDATE t SET c = v, ... WHERE predicate`` as a projection. Values are
    columns or literals; each result keeps the column's type."""
    types = dict(df.dtypes)
    hit = F.coalesce(predicate, F.lit(False))
    new_cols = {}
    for c, v in assignments.items():
        val = v if isinstance(v, Column) else F.lit(v)
        new_cols[c] = F.when(hit, val.cast(types[c])).otherwise(F.col(c))
    return df.withColumns(new_cols)


def raise_price(products: DataFrame, predicate: Column, delta, touch_ts=None) -> DataFrame:
    """``price = price + delta`` (kept DECIMAL(12,2)) for matching rows."""
    sets = {"price": F.col("price") + F.lit(delta)}
    if touch_ts is not None:
        sets["last_updated"] = F.lit(touch_ts).cast("timestamp_ntz")
    return point_update(products, predicate, sets)
