"""High watermark and incremental extract into staging frames."""

from __future__ import annotations

import datetime as dt
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starmart.session import materialize

LOW_WATERMARK = "1900-01-01 00:00:00"
SUCCESS = "SUCCESS"
# Intervals of the staged keys that prune the scan of a child table.
INTERVALS = 64


def _ts(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(value)).cast("timestamp_ntz")


def high_watermark(etl_log: DataFrame) -> DataFrame:
    """One row, ``last_loaded_time`` = latest SUCCESS stamp of any phase, or
    1900-01-01 when nothing succeeded yet."""
    return etl_log.where(F.col("status") == SUCCESS).agg(
        F.coalesce(F.max("last_loaded_time"), _ts(LOW_WATERMARK)).alias("last_loaded_time")
    )


def changed_since(df: DataFrame, watermark, stamp: str = "last_updated",
                  date_column: str | None = "last_updated_date") -> DataFrame:
    """Rows stamped strictly after ``watermark``.

    If the source carries a date companion column (``last_updated_date``,
    e.g. as a partition column), the redundant ``date >= to_date(watermark)``
    is added: parquet row-group and partition skipping work on it, which a
    ``timestamp_ntz`` comparison alone does not give.
    """
    wm = _ts(watermark)
    out = df.where(F.col(stamp) > wm)
    if date_column and date_column in df.columns:
        out = out.where(F.col(date_column) >= F.to_date(wm))
    return out


def key_intervals(parent: DataFrame, key: str, intervals: int = INTERVALS) -> list[tuple[int, int]]:
    """At most ``intervals`` ranges (low, high), in order, that hold every value of an integer
    key: its span is cut into equal parts, and each part that has a value gives
    its least and largest. One aggregate; nothing else reaches the driver."""
    k = F.col(key).cast("decimal(20,0)")
    ends = parent.agg(F.min(k).alias("low"), F.max(k).alias("high"))
    low, high = ends.select("low").scalar(), ends.select("high").scalar()
    part = F.floor((k - low) * intervals / (high - low + 1))
    parts = parent.where(F.col(key).isNotNull()).groupBy(part.alias("part")).agg(F.min(key).alias("low"), F.max(key).alias("high"))
    return sorted((r["low"], r["high"]) for r in parts.collect())


def within(key: str, intervals: list[tuple[int, int]]) -> Column:
    """Whether a key lies in one of the ranges; literals, so that it reaches the scan."""
    return reduce(or_, [F.col(key).between(low, high) for low, high in intervals], F.lit(False))


def children_of(child: DataFrame, staged_parent: DataFrame, key: str = "order_id",
                intervals: list[tuple[int, int]] | None = None) -> DataFrame:
    """Child rows whose parent was staged (``child JOIN staged ON key``,
    child columns only). The staged parent is unique on ``key``, so this is a
    semi join; Spark broadcasts the small staged side when its measured size
    allows and falls back to a shuffle join otherwise.

    ``intervals`` (``key_intervals`` of the staged parent) go to the child's
    scan as pushed filters: files and row groups whose statistics hold none of
    the staged keys are skipped, as the source database would read by its key.
    The semi join confirms what is left."""
    if intervals is not None:
        child = child.where(within(key, intervals))
    return child.join(staged_parent.select(key), key, "left_semi").select(*child.columns)


def extract(sources: dict[str, DataFrame], watermark) -> dict[str, DataFrame]:
    """The five staging frames for one batch. Item and payment rows have no
    change stamp: they are captured only through a re-stamped order. The
    staged orders are written first: the intervals of their ids and both semi joins
    read them, and the orders' source is scanned once."""
    staged_orders = materialize(changed_since(sources["orders"], watermark))
    whole = isinstance(staged_orders.schema["order_id"].dataType, T.IntegralType)
    ids = key_intervals(staged_orders, "order_id") if whole else None
    return {
        "users": changed_since(sources["users"], watermark),
        "products": changed_since(sources["products"], watermark),
        "orders": staged_orders,
        "order_items": children_of(sources["order_items"], staged_orders, intervals=ids),
        "payments": children_of(sources["payments"], staged_orders, intervals=ids),
    }
