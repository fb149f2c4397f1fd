"""Money arithmetic and index pick."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c, precision: int = 12, scale: int = 2) -> Column:
    """Cast to ``DECIMAL(p, s)``; under ANSI an out-of-range value raises."""
    return _c(c).cast(f"decimal({precision},{scale})")


def line_amount(quantity="quantity", price="price") -> Column:
    """``ROUND(quantity * price, 2)`` as ``DECIMAL(14,2)`` (half away from
    zero; the product of an int and a decimal is exact)."""
    return F.round(_c(quantity) * _c(price), 2).cast("decimal(14,2)")


def pick(index, values) -> Column:
    """``ELT(index, v1, v2, ...)``: 1-based pick, NULL when out of range."""
    return F.try_element_at(F.array(*[F.lit(v) for v in values]), _c(index).cast("int"))
