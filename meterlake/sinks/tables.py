"""Date-partitioned tables of the catalog. What must replace several days at once goes through ``loads``.

Rows are rebalanced by date before a write: AQE merges small dates and splits a
date that is too large for one task, so files come out of even size and no
writer holds a whole hot day. Replacing is one dynamic partition overwrite: new
files are staged and put in place when the job commits, so a lost executor or a
failed job leaves the old partitions as they were, and running it again gives
the same table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, day
from meterlake.schemas import TABLES, Table

DYNAMIC = "spark.sql.sources.partitionOverwriteMode"


def spec_of(table: str) -> Table:
    return TABLES[table.rsplit(".", 1)[-1]]


def create_table(spark: SparkSession, name: str, table: str | None = None, location: str | None = None) -> str:
    """Create a declared table, partitioned by its date, if it does not exist."""
    spec, table = TABLES[name], table or name
    parts = f" PARTITIONED BY ({spec.partition})" if spec.partition else ""
    where = f" LOCATION '{location}'" if location else ""
    cluster = f" TBLPROPERTIES ('cluster_by' = '{','.join(spec.cluster)}')" if spec.cluster else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({spec.ddl}) USING parquet{parts}{where}{cluster}")
    return table


def _laid_out(df: DataFrame, table: str, stamp: bool = True) -> DataFrame:
    """Columns in table order, typed, stamped, and clustered within files."""
    spec = spec_of(table)
    if stamp and "ingestion_timestamp" in spec.columns and "ingestion_timestamp" not in df.columns:
        df = df.withColumn("ingestion_timestamp", F.current_timestamp())
    target = df.sparkSession.table(table)
    extra = [c for c in df.columns if c not in target.columns]
    if extra:
        raise ValueError(f"{table} has no column {', '.join(extra)}; add it with add_columns first")
    types = {f.name: f.dataType for f in target.schema}
    df = df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in target.columns
    ])
    if spec.partition:
        df = df.hint("rebalance", spec.partition).sortWithinPartitions(spec.partition, *spec.cluster)
    return df


def add_columns(df: DataFrame, table: str) -> list[str]:
    """Add columns of df that the table does not have yet; existing rows get NULL."""
    have = set(df.sparkSession.table(table).columns)
    new = [f for f in df.schema if f.name not in have]
    if new:
        cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in new)
        df.sparkSession.sql(f"ALTER TABLE {table} ADD COLUMNS ({cols})")
    return [f.name for f in new]


def append(df: DataFrame, table: str) -> None:
    """Append with a load time. Appending the same rows twice stores them twice."""
    _laid_out(df, table).write.mode("append").insertInto(table)


def replace_dates(df: DataFrame, table: str) -> None:
    """Replace every day df has rows for; other days stay."""
    spark = df.sparkSession
    before = spark.conf.get(DYNAMIC, "static")
    spark.conf.set(DYNAMIC, "dynamic")
    try:
        _laid_out(df, table).write.insertInto(table, overwrite=True)
    finally:
        spark.conf.set(DYNAMIC, before)


def replace_date(df: DataFrame, table: str, target: Day) -> None:
    """Replace one day; empty input leaves the stored day alone."""
    col = spec_of(table).partition
    replace_dates(df.filter(F.col(col) == day(target)), table)


def range_replaced(existing: DataFrame, new: DataFrame, col: str = "activity_date") -> DataFrame:
    """What ``Loads.replace_range`` leaves in a table, as a DataFrame."""
    lo, hi = new.agg(F.min(col)).scalar(), new.agg(F.max(col)).scalar()
    kept = existing.filter(lo.isNull() | (F.col(col) < lo) | (F.col(col) > hi))
    return kept.unionByName(new, allowMissingColumns=True)
