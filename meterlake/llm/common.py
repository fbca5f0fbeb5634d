"""What the operators share: staging in the cluster's folder, word splitting on bytes, hash mixing."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from meterlake.session import shared_dir

U64 = np.uint64
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
BROADCASTS = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
BROADCAST_BYTES = 256 << 10
BROADCAST_ROWS = 100_000


def staged(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: lineage is cut, and any executor can read it again.

    The shuffle files of the write go with its end, as nothing reads them again.
    """
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(-?\d+)([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def narrow_broadcasts(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """step(df, ...), while it runs no table of more than 256 KB is broadcast; it stages what it returns.

    A staged table counts with its compressed file, of which a few bytes a row
    are left, and the driver builds every broadcast side: one of 10 MB held
    600,000 rows, 50 MB. A smaller limit of the session stays.
    """

    @wraps(step)
    def run(df: DataFrame, *args, **kwargs) -> DataFrame:
        conf = df.sparkSession.conf
        now = {BROADCASTS[0]: conf.get(BROADCASTS[0]), BROADCASTS[1]: conf.get(BROADCASTS[1], None)}
        before = {k: conf.get(k, None) for k, v in now.items() if v is not None and _bytes(v) > BROADCAST_BYTES}
        for k in before:
            conf.set(k, BROADCAST_BYTES)
        try:
            return step(df, *args, **kwargs)
        finally:
            for k, v in before.items():
                conf.unset(k) if v is None else conf.set(k, v)

    return run


def beside(df: DataFrame) -> DataFrame:
    """df as the smaller side of a join, which is broadcast only if it has at most 100,000 rows."""
    return df if df.count() <= BROADCAST_ROWS else df.hint("merge")


def mapped(df: DataFrame, step: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """df.mapInArrow(step, schema), with batches of about 4 MB on their way to Python.

    Bounded by rows alone, a batch of texts has tens of megabytes, and the JVM
    and the worker hold several of them beside the heap. The session keeps the
    setting, as the plan reads it when it runs; results do not depend on it.
    """
    df.sparkSession.conf.set(BATCH, BATCH_BYTES)
    return df.mapInArrow(step, schema)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 2000) -> Iterator[pa.RecordBatch]:
    """The batches in smaller steps, so that what a step builds beside the text stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def as_bytes(column: pa.Array) -> list[bytes | None]:
    """A string column as UTF-8 bytes."""
    return column.cast(pa.large_binary()).to_pylist()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit integers (a splitmix finisher)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))
