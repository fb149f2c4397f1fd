"""Column expressions. All are built-in Spark functions (JVM side, inside
whole-stage codegen); nothing here runs Python per row."""

from starmart.functions.dates import (
    RANGE_BOUNDS,
    calendar_columns,
    date_key,
    range_label,
    sales_year,
    shift_days,
)
from starmart.functions.predicates import any_changed, folded, is_blank, not_cancelled
from starmart.functions.values import line_amount, money, pick

__all__ = [
    "RANGE_BOUNDS",
    "any_changed",
    "calendar_columns",
    "date_key",
    "folded",
    "is_blank",
    "line_amount",
    "money",
    "not_cancelled",
    "pick",
    "range_label",
    "sales_year",
    "shift_days",
]
