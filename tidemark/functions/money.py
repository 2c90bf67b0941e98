"""Exact money arithmetic on decimals.

Prices are DECIMAL(12,2), line totals DECIMAL(18,2) and sums DECIMAL(28,2), which
holds 10^12 rows of the largest line total without overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PRICE = "decimal(12,2)"
LINE = "decimal(18,2)"
TOTAL = "decimal(28,2)"


def line_total(quantity: str | Column, unit_price: str | Column) -> Column:
    return (_col(quantity) * _col(unit_price)).cast(LINE)


def total(amount: str | Column) -> Column:
    """Sum of an amount, as an aggregate."""
    return F.sum(_col(amount)).cast(TOTAL)


def average(total_amount: str | Column, count: str | Column) -> Column:
    """``total / count`` in cents, halves away from zero; NULL for an empty group."""
    return F.round(F.try_divide(_col(total_amount), _col(count)), 2).cast(TOTAL)


def percent(part: str | Column, whole: str | Column, places: int = 1) -> Column:
    """``100 * part / whole`` rounded half up; 0 when ``whole`` is 0 or NULL."""
    exact = F.try_divide(_col(part).cast(TOTAL) * 100, _col(whole))
    return F.coalesce(F.round(exact, places), F.lit(0)).cast(f"decimal(18,{places})")


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
