"""File layout by several columns at once.

Rows sorted by one column after the other are clustered by the first one
only: a filter on the second meets every row group. Here each column is
reduced to its place among cuts of about equal row counts, the bits of the
places are interleaved, and rows are ranged and sorted by the result. A file,
and each row group in it, then spans a short range of every column, so that
Parquet's minima and maxima rule out most of them whatever column is filtered.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
SAMPLE = 10_000
# Longer strings are cut by their beginnings; a shorter cut keeps the order.
PREFIX = 64


def cuts_of(rows: DataFrame, columns: list[str], bits: int = BITS, sample: int = SAMPLE) -> dict[str, list]:
    """2^bits - 1 ascending cuts of each column, from a random sample of at most ``sample`` rows; none for a column without a value.

    The sample decides how even the files are, never which rows they hold.
    """
    short = [F.substring(c, 1, PREFIX).alias(c) if isinstance(rows.schema[c].dataType, T.StringType) else F.col(c) for c in columns]
    some = rows.select(*short).orderBy(F.rand(1)).limit(sample)
    found = some.agg(*[F.array_sort(F.collect_list(c)).alias(c) for c in columns]).first()  # at most ``sample`` values a column
    n = 1 << bits
    return {c: [found[c][i * len(found[c]) // n] for i in range(1, n)] if found[c] else [] for c in columns}


def placed(rows: DataFrame, cuts: dict[str, list], bits: int = BITS, prefix: str = "_place") -> DataFrame:
    """rows with ``_place0``, ``_place1``, ... (or another prefix): how many cuts of each column are not above its value; 0 for NULL.

    A binary search, one projection a step, in generated code for all columns together.
    """
    names = {f"{prefix}{i}": (c, F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(rows.schema[c].dataType)))
             for i, (c, values) in enumerate(cuts.items())}
    out = rows.withColumns({p: F.lit(0) for p in names})
    for step in [1 << b for b in reversed(range(bits))]:
        out = out.withColumns({
            p: F.when(F.get(values, F.col(p) + (step - 1)) <= F.col(c), F.col(p) + step).otherwise(F.col(p))
            for p, (c, values) in names.items()
        })
    return out


def interleaved(places: list[str], bits: int = BITS) -> Column:
    """One number from the bits of all places, the highest bits of each first."""
    k = len(places)
    if k * bits > 62:
        raise ValueError(f"{k} columns of {bits} bits do not fit into a bigint")
    one = [
        F.shiftleft(F.shiftright(F.col(p).cast("bigint"), b).bitwiseAND(F.lit(1)), b * k + k - 1 - j)
        for j, p in enumerate(places)
        for b in range(bits)
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), one)


def laid_out(rows: DataFrame, day: str, columns: list[str], bits: int = BITS, sample: int = SAMPLE) -> DataFrame:
    """The same rows, ranged over ``spark.sql.shuffle.partitions`` tasks and sorted by day and the interleaved columns.

    AQE merges small ranges. A day, or one combination of values, that holds
    very many rows is divided further by a hash of the row, so only rows equal
    in every column stay together. Columns must be of ordered types. NULL
    values go with the smallest ones; no rows give no rows.
    """
    if not columns:
        raise ValueError("no columns to cluster by")
    cuts = {c: values for c, values in cuts_of(rows, columns, bits, sample).items() if values}
    if not cuts:
        return rows.hint("rebalance", day).sortWithinPartitions(day)
    prefix = "_" * (1 + max(map(len, rows.columns)))  # longer than any name the table has
    out = placed(rows, cuts, bits, prefix)
    out = out.withColumns({f"{prefix}z": interleaved([f"{prefix}{i}" for i in range(len(cuts))], bits), f"{prefix}row": F.xxhash64(*rows.columns)})
    # Inside a cell the columns order the rows, so that row groups of a cell differ too.
    order = [day, f"{prefix}z", *cuts, f"{prefix}row"]
    return out.repartitionByRange(*order).sortWithinPartitions(*order).select(*rows.columns)
