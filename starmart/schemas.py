"""Fixed table schemas: OLTP sources, staging (same shapes), star schema and
control tables. Nothing is inferred; every reader and writer uses these."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(12, 2)
LINE_MONEY = T.DecimalType(14, 2)
TS = T.TimestampNTZType()

# Declared maximum string lengths, checked by quality.length_violations.
VARCHAR_LIMITS = {
    "users": {"name": 120, "email": 180, "city": 100, "country": 100},
    "products": {"product_name": 180, "category": 80},
    "orders": {"status": 30},
    "payments": {"payment_method": 40, "payment_status": 40},
}


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


USERS = T.StructType([
    _f("user_id", T.LongType(), False),
    _f("name", T.StringType(), False),
    _f("email", T.StringType(), False),
    _f("city", T.StringType()),
    _f("country", T.StringType()),
    _f("created_at", TS, False),
    _f("last_updated", TS, False),
])

PRODUCTS = T.StructType([
    _f("product_id", T.LongType(), False),
    _f("product_name", T.StringType(), False),
    _f("category", T.StringType(), False),
    _f("price", MONEY, False),
    _f("last_updated", TS, False),
])

ORDERS = T.StructType([
    _f("order_id", T.LongType(), False),
    _f("user_id", T.LongType(), False),
    _f("order_date", TS, False),
    _f("total_amount", MONEY, False),
    _f("status", T.StringType(), False),
    _f("last_updated", TS, False),
])

ORDER_ITEMS = T.StructType([
    _f("order_item_id", T.LongType(), False),
    _f("order_id", T.LongType(), False),
    _f("product_id", T.LongType(), False),
    _f("quantity", T.IntegerType(), False),
    _f("price", MONEY, False),
])

PAYMENTS = T.StructType([
    _f("payment_id", T.LongType(), False),
    _f("order_id", T.LongType(), False),
    _f("payment_method", T.StringType(), False),
    _f("payment_status", T.StringType(), False),
    _f("payment_date", TS, False),
])

SOURCES = {
    "users": USERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
    "payments": PAYMENTS,
}

# Primary keys and foreign keys of the source tables.
PRIMARY_KEYS = {
    "users": ["user_id"],
    "products": ["product_id"],
    "orders": ["order_id"],
    "order_items": ["order_item_id"],
    "payments": ["payment_id"],
}
UNIQUE_KEYS = {"users": [["email"]]}
FOREIGN_KEYS = [
    # (child, child column, parent, parent column)
    ("orders", "user_id", "users", "user_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "product_id", "products", "product_id"),
    ("payments", "order_id", "orders", "order_id"),
]

DIM_CUSTOMER = T.StructType([
    _f("customer_key", T.LongType(), False),
    _f("user_id", T.LongType(), False),
    _f("name", T.StringType(), False),
    _f("email", T.StringType(), False),
    _f("city", T.StringType()),
    _f("country", T.StringType()),
    _f("start_date", TS, False),
    _f("end_date", TS),
    _f("is_active", T.IntegerType(), False),
    _f("source_last_updated", TS, False),
])

DIM_PRODUCT = T.StructType([
    _f("product_key", T.LongType(), False),
    _f("product_id", T.LongType(), False),
    _f("product_name", T.StringType(), False),
    _f("category", T.StringType(), False),
    _f("price", MONEY, False),
    _f("source_last_updated", TS, False),
])

DIM_DATE = T.StructType([
    _f("date_key", T.IntegerType(), False),
    _f("full_date", T.DateType(), False),
    _f("day_num", T.IntegerType(), False),
    _f("month_num", T.IntegerType(), False),
    _f("month_name", T.StringType(), False),
    _f("quarter_num", T.IntegerType(), False),
    _f("year_num", T.IntegerType(), False),
    _f("week_of_year", T.IntegerType(), False),
    _f("is_weekend", T.IntegerType(), False),
])

FACT_SALES = T.StructType([
    _f("sale_id", T.LongType(), False),
    _f("source_order_item_id", T.LongType(), False),
    _f("customer_key", T.LongType(), False),
    _f("product_key", T.LongType(), False),
    _f("date_key", T.IntegerType(), False),
    _f("order_id", T.LongType(), False),
    _f("quantity", T.IntegerType(), False),
    _f("unit_price", MONEY, False),
    _f("total_amount", LINE_MONEY, False),
    _f("load_dts", TS, False),
])

# Fact rows before they get a sale_id and load stamp.
FACT_CANDIDATES = T.StructType([f for f in FACT_SALES.fields if f.name not in ("sale_id", "load_dts")])

ETL_LOG = T.StructType([
    _f("etl_id", T.LongType(), False),
    _f("batch_id", T.StringType(), False),
    _f("phase", T.StringType(), False),
    _f("last_loaded_time", TS, False),
    _f("rows_affected", T.LongType(), False),
    _f("status", T.StringType(), False),
    _f("message", T.StringType()),
    _f("created_at", TS, False),
])

ETL_ERROR_LOG = T.StructType([
    _f("error_id", T.LongType(), False),
    _f("batch_id", T.StringType()),
    _f("procedure_name", T.StringType()),
    _f("error_message", T.StringType()),
    _f("created_at", TS, False),
])

TARGETS = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
    "etl_log": ETL_LOG,
    "etl_error_log": ETL_ERROR_LOG,
}


def conform(df, schema: T.StructType):
    """Select ``schema``'s columns by name, cast to its types (by name, never
    by position - the staging clones are aligned by name)."""
    from pyspark.sql import functions as F

    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def empty(spark, schema: T.StructType):
    """A clone of a table with no rows (``CREATE TABLE ... LIKE``). The filter
    tells the optimizer so: joins with it are left out, and nothing is shuffled for them."""
    return spark.createDataFrame([], schema).where("false")
