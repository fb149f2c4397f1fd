"""Date surrogate keys and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def date_key(ts) -> Column:
    """``yyyymmdd`` integer of a date or timestamp (``CAST(DATE_FORMAT(DATE(d),
    '%Y%m%d') AS UNSIGNED)``). Integer arithmetic instead of string formatting:
    same value, no string per row."""
    d = F.to_date(_c(ts))
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def sales_year(date_key_col) -> Column:
    """Calendar year of a ``yyyymmdd`` key; the fact table's partition column."""
    return F.floor(_c(date_key_col) / 10000).cast("int")


def calendar_columns(full_date) -> list[Column]:
    """Calendar attributes of a date, named as in ``dim_date``.

    ``week_of_year`` is the ISO-8601 week (MySQL ``WEEK(d, 3)``) while
    ``year_num`` is the calendar year; ``is_weekend`` is 1 on Saturday and
    Sunday (``dayofweek`` 1 = Sunday, 7 = Saturday).
    """
    d = _c(full_date)
    return [
        F.dayofmonth(d).alias("day_num"),
        F.month(d).alias("month_num"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.quarter(d).alias("quarter_num"),
        F.year(d).alias("year_num"),
        F.weekofyear(d).alias("week_of_year"),
        F.when(F.dayofweek(d).isin(1, 7), F.lit(1)).otherwise(F.lit(0)).alias("is_weekend"),
    ]


# The fact table's declared range partitions, as
# (exclusive upper bound on date_key, partition name), in order; rows at or
# above the last bound fall into "p_max".
RANGE_BOUNDS = [
    (20250101, "p_before_2025"),
    (20260101, "p_2025"),
    (20270101, "p_2026"),
    (20280101, "p_2027"),
]
RANGE_TAIL = "p_max"


def range_label(date_key_col, bounds=RANGE_BOUNDS, tail: str = RANGE_TAIL) -> Column:
    """Name of the range partition a ``date_key`` falls into."""
    k = _c(date_key_col)
    expr = None
    for upper, label in bounds:
        expr = F.when(k < upper, F.lit(label)) if expr is None else expr.when(k < upper, F.lit(label))
    return expr.otherwise(F.lit(tail)) if expr is not None else F.lit(tail)


def shift_days(ts, days) -> Column:
    """``ts - INTERVAL days DAY`` keeping ``timestamp_ntz``."""
    return F.timestamp_add("DAY", -_c(days) if not isinstance(days, int) else F.lit(-days), _c(ts))
