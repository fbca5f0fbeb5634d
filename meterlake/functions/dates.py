"""Date columns. Weeks start on Sunday; Spark's own week starts on Monday."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Day = dt.date | str


def day(value: Day | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def week_start(d: str | Column) -> Column:
    d = F.col(d) if isinstance(d, str) else d
    return F.date_sub(d, F.dayofweek(d) - 1)


def month_start(d: str | Column) -> Column:
    return F.trunc(d, "MM")


def days_in_month(d: str | Column) -> Column:
    return F.dayofmonth(F.last_day(d))


def iso_date(text: str | Column) -> Column:
    """The calendar day an ISO text names in its own offset: its first ten characters."""
    return F.substring(text, 1, 10).cast("date")


def iso_timestamp(text: str | Column) -> Column:
    """ISO text, with ``Z`` or an offset, as an instant."""
    text = F.col(text) if isinstance(text, str) else text
    return text.cast("timestamp")


def epoch_millis(ms: str | Column) -> Column:
    return F.timestamp_millis(ms)


def month_label(d: str | Column) -> Column:
    return F.date_format(d, "MMMM yyyy")


def month_key(d: str | Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def shift_weeks(d: str | Column, n: int) -> Column:
    return F.date_add(d, 7 * n)


def elapsed(start: Column, end: Column) -> Column:
    """The time from start to end as an interval."""
    return end - start


def hours_between(start: Column, end: Column) -> Column:
    """Whole hours from start to end."""
    return F.timestamp_diff("HOUR", start, end)


def date_spine(spark: SparkSession, start: Day, end: Day, name: str = "date") -> DataFrame:
    """Every calendar day from start to end, both included."""
    return spark.range(1).select(F.explode(F.sequence(day(start), day(end))).alias(name))


def date_spine_offsets(spark: SparkSession, start: Day, days: int, name: str = "date") -> DataFrame:
    """start + 0 … start + days, the offset form of the spine."""
    return spark.range(days + 1).select(F.date_add(day(start), F.col("id").cast("int")).alias(name))
