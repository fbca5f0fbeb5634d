"""Run logs and date lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def failed_dates(lines: DataFrame) -> DataFrame:
    """Distinct dates of ``FAILED: YYYY-MM-DD`` log lines, in order."""
    text = F.regexp_extract("value", r"FAILED: (\d{4}-\d{2}-\d{2})", 1)
    return lines.select(F.nullif(text, F.lit("")).cast("date").alias("date")).filter("date IS NOT NULL").distinct().orderBy("date")


def date_list(lines: DataFrame) -> DataFrame:
    """One date per line; blank lines are skipped."""
    return lines.filter(F.trim("value") != "").select(F.trim("value").cast("date").alias("date"))


def read_failed_dates(spark: SparkSession, path: str) -> DataFrame:
    return failed_dates(spark.read.text(path))


def read_dates(spark: SparkSession, path: str) -> DataFrame:
    return date_list(spark.read.text(path))
