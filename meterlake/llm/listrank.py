"""Distributed list ranking: how far each element of a linked list is from its end."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake.llm.common import staged


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distances in a short list that one task holds."""
    after, ends = {}, set()
    for batch in batches:
        for a, b, w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            after[a] = b, w
            ends.add(b)
    at = next((b for b in ends if b not in after), None)  # the end has no successor
    before = {b: a for a, (b, _) in after.items()}
    names, far = [], []
    distance = 0
    while at is not None:
        names.append(at)
        far.append(distance)
        at = before.get(at)
        if at is not None:
            distance += after[at][1]
    yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(far, pa.int64())], ["a", "far"])


def ranked(links: DataFrame, every: int = 16, bound: int = 32_768, seed: int = 0) -> DataFrame:
    """(a, far): the steps from each element to the list's end, which has 0. ``links`` has (a, b), both long, b following a.

    One element in ``every`` is a ruler, by a hash. All others jump to where
    their successor points, twice as far each round, until they meet a ruler;
    only those still on their way take part in a round, and a gap between
    rulers is a few hundred steps at most, so rounds do not grow with the list.
    The rulers then form a shorter list, ranked the same way until ``bound``
    elements are left for one task to walk. Work is linear in the list. No
    rows give no rows.
    """
    weighted = links if "w" in links.columns else links.withColumn("w", F.lit(1).cast("long"))
    weighted = weighted.select("a", "b", "w")
    ends = weighted.select(F.col("b").alias("a")).join(weighted.select("a"), "a", "left_anti")
    ruler = lambda c: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(every)) == 0
    weighted = weighted.join(F.broadcast(ends.select(F.col("a").alias("b"), F.lit(True).alias("last"))), "b", "left")  # one row
    state = staged(weighted.select("a", "b", "w", (ruler(F.col("b")) | F.coalesce("last", F.lit(False))).alias("done")), "hops")
    while state.where("NOT done").limit(1).count():
        known = state.select(F.col("a").alias("b"), F.col("b").alias("c"), F.col("w").alias("v"), "done")
        moved = state.where("NOT done").drop("done").join(known, "b").select("a", F.col("c").alias("b"), (F.col("w") + F.col("v")).alias("w"), "done")
        state = staged(state.where("done").unionByName(moved), "hops")
    found = state.drop("done")
    rulers = staged(found.where(ruler(F.col("a"))), "rulers")
    if rulers.count() > bound:
        far = ranked(rulers, every, bound, seed + 1)
    else:
        far = staged(rulers.coalesce(1).mapInArrow(_walk, "a long, far long"), "far")
    ends = ends.select("a", F.lit(0).cast("long").alias("far"))
    far = far.unionByName(ends.join(far, "a", "left_anti"))  # a list without rulers has its end only
    rest = found.where(~ruler(F.col("a"))).join(far.withColumnsRenamed({"a": "b"}), "b").select("a", (F.col("w") + F.col("far")).alias("far"))
    return rest.unionByName(far)
