"""Loading a range of days in one job, with a status per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, date_spine, day
from meterlake.functions.numbers import count_big
from meterlake.operators.filters import between_dates, semi_filter
from meterlake.operators.joins import anti_join
from meterlake.session import checkpointed

# Fixed value: the longest range one request may ask for.
MAX_CHUNK_DAYS = 90


def day_status(
    days: DataFrame, rows: DataFrame, day_max: float | None, invalid: Column | None, col: str, amount: str | Column
) -> DataFrame:
    """One row per day: rows read, total, ok/failed/empty and why."""
    bad = F.coalesce(invalid, F.lit(False)) if invalid is not None else F.lit(False)
    per_day = rows.groupBy(F.col(col).alias("date")).agg(
        count_big().alias("n"), F.sum(amount).alias("total"), count_big(bad).alias("bad")
    )
    reason = F.when(F.col("n").isNull(), "no rows").when(F.col("bad") > 0, "invalid rows")
    if day_max is not None:
        reason = reason.when(F.col("total") > day_max, "day total above ceiling")
    status = F.when(F.col("n").isNull(), "empty").when(reason.isNull(), "ok").otherwise("failed")
    return days.join(per_day, "date", "left").select(
        "date",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("rows"),
        F.col("total").cast("double").alias("total_cost"),
        status.alias("status"),
        reason.alias("reason"),
    )


def backfill_status(
    rows: DataFrame, start: Day, end: Day, *, day_max: float | None = 1000.0, invalid: Column | None = None,
    col: str = "activity_date", amount: str = "amount_usd",
) -> DataFrame:
    """One row per day of the range: rows read, total, ok/failed/empty and why.

    A day fails if it has invalid rows or its total exceeds day_max; the other
    days are not affected.
    """
    days = date_spine(rows.sparkSession, start, end)
    return day_status(days, between_dates(rows, col, start, end), day_max, invalid, col, amount)


def with_failures(status: DataFrame, failures: DataFrame) -> DataFrame:
    """The status with further failures (date, reason); a null date fails every day."""
    per_day = failures.groupBy("date").agg(F.min("reason").alias("_why"))
    every = per_day.filter("date IS NULL").agg(F.min("_why")).scalar()
    joined = status.join(per_day.filter("date IS NOT NULL"), "date", "left").withColumn("_why", F.coalesce("_why", every))
    return joined.select(
        "date", "rows", "total_cost",
        F.when(F.col("_why").isNotNull(), "failed").otherwise(F.col("status")).alias("status"),
        F.coalesce(F.when(F.col("status") == "failed", F.col("reason")), "_why", "reason").alias("reason"),
    )


def backfill_rows(rows: DataFrame, status: DataFrame, col: str = "activity_date") -> DataFrame:
    """The rows of the days that passed, to be written with one date-partitioned job."""
    good = status.filter(F.col("status") == "ok").select(F.col("date").alias(col))
    return rows.join(good, col, "left_semi")


def retry_dates(
    rows: DataFrame, dates: DataFrame, *, day_max: float | None = 1000.0, invalid: Column | None = None,
    col: str = "activity_date", amount: str = "amount_usd",
) -> DataFrame:
    """Status of the listed days only."""
    days = dates.select("date").distinct()
    return day_status(days, semi_filter(rows, days.withColumnRenamed("date", col), col), day_max, invalid, col, amount)


def auto_detect_missing(target: DataFrame, start: Day, end: Day, col: str = "activity_date") -> DataFrame:
    """Days of the range the target table has no rows for, as input of retry_dates."""
    return anti_join(date_spine(target.sparkSession, start, end), between_dates(target, col, start, end), "date", col)


def chunk_range(spark: SparkSession, start: Day | Column, end: Day | Column, days: int = MAX_CHUNK_DAYS) -> DataFrame:
    """Split [start, end] into chunks that span at most ``days`` days, ends included.

    A chunk runs from its start to ``days`` later and the next begins the day
    after. The last day is always covered.
    """
    s, e = day(start), day(end)
    n = F.floor(F.datediff(e, s) / (days + 1)).cast("int")
    i = spark.range(1).select(F.explode(F.sequence(F.lit(0), n)).alias("i"), s.alias("s"), e.alias("e"))
    first = F.date_add("s", F.col("i") * (days + 1))
    return i.select(
        F.col("i").cast("bigint").alias("chunk"),
        first.alias("chunk_start"),
        F.least(F.date_add(first, days), F.col("e")).alias("chunk_end"),
    )


def chunk_load(rows: DataFrame, col: str = "activity_date", days: int = MAX_CHUNK_DAYS) -> DataFrame:
    """The chunks that cover a table's dates, with the rows each would load."""
    per_day = checkpointed(rows.groupBy(col).agg(count_big().alias("n")))  # one row per calendar day, the table is read once
    bounds = per_day.agg(F.struct(F.min(col).alias("s"), F.max(col).alias("e"))).scalar()
    chunks = chunk_range(rows.sparkSession, bounds["s"], bounds["e"], days)
    index = F.floor(F.datediff(F.col(col), bounds["s"]) / (days + 1)).cast("bigint")
    loads = per_day.groupBy(index.alias("chunk")).agg(F.sum("n").cast("bigint").alias("rows"))
    return chunks.join(loads, "chunk", "left").select(
        "chunk", "chunk_start", "chunk_end", F.coalesce("rows", F.lit(0)).cast("bigint").alias("rows")
    )
