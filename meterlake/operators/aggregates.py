"""Shares, ranks, top-k and set operations over aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.numbers import safe_divide


def pct_of_total(df: DataFrame, col: str, alias: str = "pct_of_total", places: int = 2) -> DataFrame:
    """Each row's share of the column total, in percent.

    The total is a scalar subquery: unlike a window without partitions it does
    not move all groups into one task. It reads every column of ``df`` so that
    its plan below the sum equals that of ``df``, and Spark runs the shuffle
    they share once.
    """
    every = F.max(F.struct(*df.columns))
    total = df.agg(F.struct(F.sum(col).alias("total"), every)).scalar()["total"]
    return df.withColumn(alias, F.round(safe_divide(F.col(col) * 100, total), places))


def top_k(df: DataFrame, key: str, k: int, tiebreak: str | list[str]) -> DataFrame:
    """The k largest by key, ties in tiebreak order (a per-task heap, then a merge)."""
    ties = [tiebreak] if isinstance(tiebreak, str) else tiebreak
    return df.orderBy(F.col(key).desc_nulls_last(), *[F.col(t).asc_nulls_last() for t in ties]).limit(k)


def union_all(dfs: list[DataFrame], missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing), dfs)


def union_distinct(dfs: list[DataFrame]) -> DataFrame:
    """Set union; NULL is one value. Each input is deduplicated before the shuffle."""
    return union_all(dfs).distinct()


def distinct_sorted(df: DataFrame, *cols: str) -> DataFrame:
    return df.select(*cols).distinct().orderBy(*cols)


def having(df: DataFrame, keys: list[str | Column], aggs: list[Column], pred: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs).filter(pred)


def order_by_agg(df: DataFrame, keys: list[str | Column], aggs: list[Column], order: Column) -> DataFrame:
    """Sorted by an aggregate that is not part of the result."""
    return df.groupBy(*keys).agg(*aggs, order.alias("_order")).orderBy("_order").drop("_order")


def global_rank(df: DataFrame, value: str, within: str | None = None, buckets: int | None = None) -> DataFrame:
    """Add ``rank``, ``dense_rank`` and ``percent_rank`` over all rows, or those of one value of ``within``, ascending.

    A window over all of them would sort everything in one task. Here the
    distinct values are counted first (so ties are one row), cut into buckets
    by approximate quantiles, and ranked within a bucket; the bucket offsets
    come from at most ``buckets`` + 1 totals (as many as there are shuffle
    partitions, 64 at least). The ranks are exact whatever the cuts are,
    because a bucket only has to hold a contiguous range of values. NULL values
    are not ranked.
    """
    if buckets is None:
        buckets = max(64, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    part = [within] if within else []
    # Rows without a value are a group that counts nothing.
    hist = df.groupBy(*part, value).agg(F.count(value).alias("_n"))
    points = [i / buckets for i in range(1, buckets)]
    cuts = hist.agg(F.percentile_approx(value, points, 20 * buckets)).scalar()
    hist = hist.withColumn("_cuts", cuts)
    hist = hist.withColumn("_b", F.size(F.filter("_cuts", lambda c: c < F.col(value)))).drop("_cuts")

    order = Window.partitionBy(*part).orderBy("_b")  # over at most buckets + 1 rows
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*part)
    offsets = (
        hist.groupBy(*part, "_b")
        .agg(F.sum("_n").alias("_rows"), F.count(value).alias("_values"))
        .select(
            *part,
            "_b",
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
            F.coalesce(F.sum("_values").over(before), F.lit(0)).alias("_values_before"),
            F.sum("_rows").over(whole).alias("_total"),
        )
    )
    inside = Window.partitionBy(*part, "_b").orderBy(value)
    smaller = inside.rowsBetween(Window.unboundedPreceding, -1)
    # A left join, though every bucket matches: an inner one would push a NULL
    # check on the bucket, and with it the bucket search, down to every row.
    # Null-safe for the same reason: a NULL check on ``within`` would reach the rows of one branch only.
    offsets = offsets.withColumnsRenamed({c: f"_o_{c}" for c in [*part, "_b"]})
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in [*part, "_b"]])
    ranks = hist.join(offsets, same, "left").select(
        *part,
        value,
        (F.col("_rows_before") + F.coalesce(F.sum("_n").over(smaller), F.lit(0)) + 1).alias("rank"),
        (F.col("_values_before") + F.count(value).over(inside)).cast("bigint").alias("dense_rank"),
        "_total",
    )
    ranks = ranks.withColumn(
        "percent_rank", F.when(F.col("_total") > 1, safe_divide(F.col("rank") - 1, F.col("_total") - 1)).otherwise(0.0)
    )
    # A value that very many rows share stays one key: nothing else uses this shuffle, so AQE splits its partition.
    names = ["rank", "dense_rank", "percent_rank"]
    ranks = ranks.select(*[F.col(c).alias(f"_r_{c}") for c in [*part, value]], *[F.when(F.col(value).isNotNull(), F.col(c)).alias(c) for c in names])
    if not part:
        return df.join(ranks, F.col(value) == F.col(f"_r_{value}"), "left").select(*df.columns, *names)
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in [*part, value]])
    return df.join(ranks, same, "left").select(*df.columns, *names)
