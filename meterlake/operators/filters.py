"""Row filters. Date predicates stay on the bare column so that they prune."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, day


def between_dates(df: DataFrame, col: str, start: Day | None, end: Day | None) -> DataFrame:
    """start ≤ col ≤ end; a bound that is None does not filter."""
    if start is not None:
        df = df.filter(F.col(col) >= day(start))
    if end is not None:
        df = df.filter(F.col(col) <= day(end))
    return df


def trailing(df: DataFrame, col: str, days: int, as_of: Day) -> DataFrame:
    """Rows from ``days`` before as_of onwards; later rows are kept too."""
    return df.filter(F.col(col) >= F.date_sub(day(as_of), days))


def trailing_window(df: DataFrame, col: str, days: int, end: Day) -> DataFrame:
    """Rows from ``days`` before end up to end, both included."""
    return df.filter(F.col(col).between(F.date_sub(day(end), days), day(end)))


def filter_day(df: DataFrame, d: Day, col: str = "activity_date") -> DataFrame:
    return df.filter(F.col(col) == day(d))


def optional_filter(df: DataFrame, col: str, values=None) -> DataFrame:
    """No filter without values, equality or IN with them."""
    if values is None:
        return df
    if isinstance(values, (str, int, float)):
        values = [values]
    return df.filter(F.col(col).isin(list(values)))


# The dashboard's default date range.
DEFAULT_START, DEFAULT_END = "2025-10-01", "2025-12-31"


def with_defaults(start: Day | None = None, end: Day | None = None) -> tuple[Day, Day]:
    """Absent date parameters take the dashboard's defaults."""
    return (DEFAULT_START if start is None else start, DEFAULT_END if end is None else end)


def any_violation(df: DataFrame, rules: Iterable[Column]) -> DataFrame:
    """Rows that break at least one rule."""
    return df.filter(reduce(lambda a, b: a | b, rules))


def semi_filter(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a list that is itself a table.

    The keys need not be distinct. Left as they are, both sides of the join are
    plain shuffles, which AQE can split where a key is hot.
    """
    return df.join(keys.select(on), on, "left_semi")


def label(df: DataFrame, name: str, value) -> DataFrame:
    """A constant column, first in the row."""
    return df.select(F.lit(value).alias(name), "*")


def run_sql(spark: SparkSession, text: str, tables: dict[str, DataFrame] | None = None, **params) -> DataFrame:
    """SQL with ``:name`` markers bound as values, and ``{table}`` as DataFrames."""
    return spark.sql(text, args=params, **(tables or {}))
