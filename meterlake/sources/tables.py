"""Stored tables and their columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from meterlake.functions.dates import Day
from meterlake.operators.filters import between_dates
from meterlake.schemas import TABLES


def read_table(spark: SparkSession, name: str, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """A catalog table; the date range on the partition column prunes partitions."""
    df = spark.table(name)
    spec = TABLES.get(name.rsplit(".", 1)[-1])
    return between_dates(df, spec.partition, start, end) if spec and spec.partition else df


def read_parquet(spark: SparkSession, path: str, name: str, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """The same for a folder; columns the files lack come back as NULL."""
    spec = TABLES[name]
    df = spark.read.schema(spec.schema).parquet(path)
    return between_dates(df, spec.partition, start, end) if spec.partition else df


def matching_columns(schema: StructType, like: str | list[str]) -> list[str]:
    """Column names that match any of the LIKE patterns."""
    patterns = [like] if isinstance(like, str) else like
    regexes = [re.compile(".*".join(map(re.escape, p.split("%"))), re.DOTALL) for p in patterns]
    return [f.name for f in schema if any(r.fullmatch(f.name) for r in regexes)]


def columns_of(spark: SparkSession, source: DataFrame | StructType | str, like: str | list[str] | None = None) -> DataFrame:
    """Column names and types of a table, DataFrame or schema, filtered by LIKE patterns."""
    schema = source if isinstance(source, StructType) else (spark.table(source) if isinstance(source, str) else source).schema
    wanted = set(matching_columns(schema, like) if like else schema.names)
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(schema, 1) if f.name in wanted]
    return spark.createDataFrame(rows, "ordinal_position int, column_name string, data_type string, is_nullable boolean")
