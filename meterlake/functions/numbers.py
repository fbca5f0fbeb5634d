"""Ratios, money and counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def usd(x: str | Column, places: int = 2) -> Column:
    """Exact decimal money rounded half away from zero, then as DOUBLE."""
    return F.round(x, places).cast("double")


def safe_divide(x: str | Column, y: str | Column) -> Column:
    """x / y as DOUBLE; NULL where y is 0 or NULL."""
    return F.try_divide(_c(x).cast("double"), _c(y).cast("double"))


def percent(x: str | Column, y: str | Column, places: int = 2) -> Column:
    return F.round(safe_divide(_c(x) * 100, y), places)


def cents_to_usd(cents: str | Column, to: str = "decimal(18,6)") -> Column:
    """Decimal text or integer cents to dollars, without a binary float in between."""
    return (_c(cents).cast("decimal(28,10)") / 100).cast(to)


def sum_if(cond: Column, value: str | Column) -> Column:
    """Σ value where cond holds; other rows add 0, so an all-false group is 0."""
    return F.sum(F.when(cond, _c(value)).otherwise(0))


def count_distinct_if(cond: Column, value: str | Column) -> Column:
    return F.countDistinct(F.when(cond, _c(value)))


def rate(cond: Column) -> Column:
    """Share of rows for which cond holds."""
    return F.avg(F.when(cond, 1.0).otherwise(0.0))


def count_big(cond: Column | None = None) -> Column:
    return F.count(F.lit(1)) if cond is None else F.count_if(cond)


def arg_max(value: str | Column, by: str | Column) -> Column:
    """value of the row with the largest ``by``; the smaller value wins a tie.

    Negating a string is not possible, so the tie is broken by taking the
    smallest value among those that reach the maximum of ``by``:
    ``min_by(value, (-by, value))``.
    """
    v, b = _c(value), _c(by)
    return F.min_by(v, F.struct((-b).alias("b"), v.alias("v")))
