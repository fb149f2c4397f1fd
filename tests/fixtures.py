"""Generator-shaped fixture (1,000 users, 300 products, 2,500 orders, 6,000
items, one payment per order) with a fixed ``as_of`` and hash-derived
prices instead of NOW() / RAND(), plus the reference's change scenario."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from starmart.functions import money, pick, shift_days
from starmart.operators.maintain import derive_payments, point_update, raise_price, refresh_order_totals
from starmart.sources.oltp import number_series

AS_OF = dt.datetime(2026, 6, 1, 0, 0, 0)

# The generator's pick lists.
CITIES = ["Delhi", "Mumbai", "Bengaluru", "Hyderabad", "Pune", "Chennai", "Kolkata", "Jaipur", "Ahmedabad", "Lucknow"]
COUNTRIES = ["India", "USA", "UK", "UAE", "Canada"]
CATEGORIES = ["Electronics", "Books", "Home", "Fashion", "Beauty", "Sports", "Toys", "Grocery"]
STATUSES = ["PLACED", "SHIPPED", "DELIVERED", "CANCELLED"]


def ts(value: dt.datetime):
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def _price(salt: str):
    # 50.00 .. 5049.99, derived from a hash of the row number.
    h = F.abs(F.xxhash64(F.lit(salt), F.col("n"))) % 500000
    return money(F.lit(50) + h / 100)


def generate(spark, as_of: dt.datetime = AS_OF):
    n = F.col("n")
    now = ts(as_of)
    users = number_series(spark, 1000).select(
        n.cast("long").alias("user_id"),
        F.concat(F.lit("User_"), n.cast("string")).alias("name"),
        F.concat(F.lit("user"), n.cast("string"), F.lit("@demo.com")).alias("email"),
        pick(F.lit(1) + n % 10, CITIES).alias("city"),
        F.when(n % 25 == 0, F.lit(None).cast("string")).otherwise(pick(F.lit(1) + n % 5, COUNTRIES)).alias("country"),
        shift_days(now, n % 365).alias("created_at"),
        shift_days(now, n % 60).alias("last_updated"),
    )
    products = number_series(spark, 300).select(
        n.cast("long").alias("product_id"),
        F.concat(F.lit("Product_"), n.cast("string")).alias("product_name"),
        pick(F.lit(1) + n % 8, CATEGORIES).alias("category"),
        _price("product").alias("price"),
        shift_days(now, n % 50).alias("last_updated"),
    )
    orders = number_series(spark, 2500).select(
        n.cast("long").alias("order_id"),
        (F.lit(1) + n % 1000).cast("long").alias("user_id"),
        F.timestamp_add("HOUR", n % 24, shift_days(now, n % 365)).alias("order_date"),
        money(F.lit(0)).alias("total_amount"),
        pick(F.lit(1) + n % 4, STATUSES).alias("status"),
        shift_days(now, n % 30).alias("last_updated"),
    )
    items = number_series(spark, 6000).select(
        n.cast("long").alias("order_item_id"),
        (F.lit(1) + n % 2500).cast("long").alias("order_id"),
        (F.lit(1) + n % 300).cast("long").alias("product_id"),
        (F.lit(1) + n % 5).cast("int").alias("quantity"),
        _price("item").alias("price"),
    )
    payments = derive_payments(orders)
    orders = refresh_order_totals(orders, items, touch_ts=now)
    return {"users": users, "products": products, "orders": orders, "order_items": items, "payments": payments}


def apply_changes(spark, tables, at: dt.datetime):
    """The reference's change scenario: user 101 moves, product 20 costs 100
    more, user 101 places a new order of two items, paid by card."""
    stamp = ts(at)
    users = point_update(tables["users"], F.col("user_id") == 101,
                         {"city": "Delhi NCR", "country": "India", "last_updated": stamp})
    products = raise_price(tables["products"], F.col("product_id") == 20, 100, touch_ts=at.strftime("%Y-%m-%d %H:%M:%S"))
    new_order = spark.createDataFrame([(2501, 101)], "order_id long, user_id long").select(
        "order_id", "user_id", stamp.alias("order_date"), money(F.lit(0)).alias("total_amount"),
        F.lit("DELIVERED").alias("status"), stamp.alias("last_updated"))
    new_items = spark.createDataFrame(
        [(6001, 2501, 20, 2, "1499.00"), (6002, 2501, 35, 1, "999.00")],
        "order_item_id long, order_id long, product_id long, quantity int, price string",
    ).withColumn("price", money("price"))
    items = tables["order_items"].unionByName(new_items)
    orders = tables["orders"].unionByName(new_order)
    totals = refresh_order_totals(orders.where("order_id = 2501"), new_items, touch_ts=stamp)
    orders = orders.where("order_id <> 2501").unionByName(totals)
    pay = spark.createDataFrame([(2501, 2501, "CARD", "SUCCESS")],
                                "payment_id long, order_id long, payment_method string, payment_status string"
                                ).withColumn("payment_date", stamp)
    payments = tables["payments"].unionByName(pay)
    return {"users": users, "products": products, "orders": orders, "order_items": items, "payments": payments}


def freeze(tables, path_prefix: str, spark):
    """Write the tables once and read them back (a stable source snapshot)."""
    from starmart import schemas
    from starmart.sources.oltp import read_sources, write_sources

    write_sources({k: schemas.conform(v, schemas.SOURCES[k]) for k, v in tables.items()}, path_prefix)
    return read_sources(spark, path_prefix)
