"""AN1-AN5: the analytical queries over the star schema.

Each query first reduces the fact table to the grain of the dimension key
it joins on (per day, per product, per customer version and order). The
partial aggregates are combined map-side, so the shuffle carries one row
per key per task, and the following dimension join works on a table that
is small no matter how large the fact is; a hot key (a peak day, a
best-selling product) costs no more than any other. Sums are exact
decimals, so summing partial sums gives the same result as summing rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REVENUE_TYPE = "decimal(38,2)"


def _revenue(c: str) -> F.Column:
    return F.round(F.sum(c), 2).cast(REVENUE_TYPE)


def daily_revenue(fact: DataFrame) -> DataFrame:
    return fact.groupBy("date_key").agg(F.sum("total_amount").alias("_rev"))


def _by_calendar(fact: DataFrame, dim_date: DataFrame, attrs: list[str]) -> DataFrame:
    """Revenue by calendar attributes. Of a fact that is partitioned by year the
    join states the redundant ``sales_year = year_num`` too: a filter on the calendar, whatever
    attribute it is on, then prunes the fact's partitions (dynamic partition pruning)."""
    if "sales_year" in fact.columns:
        days = fact.groupBy("sales_year", "date_key").agg(F.sum("total_amount").alias("_rev"))
        cal = dim_date.select("date_key", F.col("year_num").alias("sales_year"), *attrs)
        joined = days.join(cal, ["date_key", "sales_year"])
    else:
        joined = daily_revenue(fact).join(dim_date.select("date_key", *attrs), "date_key")
    return joined.groupBy(*attrs).agg(_revenue("_rev").alias("revenue"))


def revenue_by_month(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AN1: year_num, month_num, month_name, revenue, by year and month."""
    return _by_calendar(fact, dim_date, ["year_num", "month_num", "month_name"]).orderBy("year_num", "month_num")


def revenue_by_quarter(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AN5: year_num, quarter_num, revenue."""
    return _by_calendar(fact, dim_date, ["year_num", "quarter_num"]).orderBy("year_num", "quarter_num")


def weekday_weekend_revenue(fact: DataFrame, dim_date: DataFrame) -> DataFrame:
    """AN4: day_type ('Weekend' / 'Weekday'), revenue; grouped by the flag."""
    g = _by_calendar(fact, dim_date, ["is_weekend"])
    day_type = F.when(F.col("is_weekend") == 1, F.lit("Weekend")).otherwise(F.lit("Weekday"))
    return g.select(day_type.alias("day_type"), "revenue")


def top_customers(fact: DataFrame, dim_customer: DataFrame, k: int = 10) -> DataFrame:
    """AN2: user_id, name, city, country, total_spent, total_orders; top ``k``
    by spend (ties broken by the group columns).

    Grouped by the customer's attributes, so a user with history appears
    once per distinct attribute set. Each set is named by its least customer
    key, on the dimension side; the fact, reduced per (version, order), is
    mapped to that name and reduced per (name, order), then per name, which
    counts distinct orders exactly. No string moves at order grain: the
    attributes come back by the name, one row per set, at the end.
    """
    attrs = ["user_id", "name", "city", "country"]
    groups = dim_customer.groupBy(*attrs).agg(F.min("customer_key").alias("_group"), F.collect_set("customer_key").alias("_keys"))
    names = groups.select("_group", F.explode("_keys").alias("customer_key"))
    per_order = fact.groupBy("customer_key", "order_id").agg(F.sum("total_amount").alias("_amt"))
    per_group_order = per_order.join(names, "customer_key").groupBy("_group", "order_id").agg(F.sum("_amt").alias("_amt"))
    g = per_group_order.groupBy("_group").agg(
        _revenue("_amt").alias("total_spent"), F.count("order_id").alias("total_orders")
    )
    j = g.join(groups.select("_group", *attrs), "_group").select(*attrs, "total_spent", "total_orders")
    return j.orderBy(F.col("total_spent").desc(), *attrs).limit(k)


def top_products(fact: DataFrame, dim_product: DataFrame, k: int = 10) -> DataFrame:
    """AN3: product_id, product_name, category, units_sold, sales_amount; top
    ``k`` by units then sales (ties broken by the group columns)."""
    per_key = fact.groupBy("product_key").agg(
        F.sum("quantity").alias("_units"), F.sum("total_amount").alias("_sales")
    )
    attrs = ["product_id", "product_name", "category"]
    j = per_key.join(dim_product.select("product_key", *attrs), "product_key")
    g = j.groupBy(*attrs).agg(
        F.sum("_units").cast("long").alias("units_sold"), _revenue("_sales").alias("sales_amount")
    )
    return g.orderBy(F.col("units_sold").desc(), F.col("sales_amount").desc(), *attrs).limit(k)
