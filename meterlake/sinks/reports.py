"""Validation reports and result exports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.plans.validation import status_counts


def write_report(results: DataFrame, path: str) -> None:
    """Per-check results and their summary, as JSON in two folders below path."""
    results.write.mode("overwrite").json(f"{path}/results")
    summary = status_counts(results).withColumn("generated_at", F.current_timestamp())
    summary.write.mode("overwrite").json(f"{path}/summary")


def export(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Any result as CSV (with header), JSON or Parquet."""
    if fmt not in ("csv", "json", "parquet"):
        raise ValueError(f"unknown format {fmt}")
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(path)
