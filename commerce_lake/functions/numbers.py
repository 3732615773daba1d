"""Arithmetic helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from commerce_lake.schemas import SUM_DECIMAL


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole, rounded half-even; NULL for an empty whole."""
    return F.bround(F.try_divide(part.cast("double") * F.lit(100.0), whole.cast("double")), digits)


def line_value(price: Column, quantity: Column) -> Column:
    return price * quantity


def exact_sum(c: Column) -> Column:
    """Decimal sum with one result type whatever the input's width."""
    return F.sum(c).cast(SUM_DECIMAL)


def sum_or_zero(c: Column, result: str) -> Column:
    """Sum that is 0, not NULL, when nothing was added."""
    return F.coalesce(F.sum(c), F.lit(0)).cast(result)
