"""Joins.

Catalyst broadcasts a side whose size it knows to be below
``spark.sql.autoBroadcastJoinThreshold``, AQE does so from measured sizes, and
anything larger is shuffled with skewed partitions split. The one hint is on a
list of hot keys, whose length is bounded by their definition.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SALT, SALTS = "_salt", "_salts"
REPEATS = 65_536  # equal rows written by one task at a time


def _same(on: list[str], prefix: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in on])


def hot_keys(counts: DataFrame, on: list[str], n: str) -> DataFrame:
    """Keys with more rows than half a partition's share, and the number of sub-keys that bring them below it.

    With p shuffle partitions a key is hot from 1/(2p) of all rows on, so there
    are fewer than 2p of them, whatever the table's size. Nothing is computed
    until the join that uses them runs.
    """
    parts = 2 * int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = counts.agg(F.sum(n)).scalar()
    salts = F.ceil(F.col(n) * parts / total).cast("int")
    return counts.select(*[F.col(k).alias(f"_h_{k}") for k in on], salts.alias(SALTS)).filter(F.col(SALTS) > 1)


def _with_salts(df: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    joined = df.join(F.broadcast(hot), _same(on, "_h_"), "left")
    return joined.select(*df.columns, F.coalesce(SALTS, F.lit(1)).alias(SALTS))


def salted(rows: DataFrame, hot: DataFrame, on: list[str], spread: list[str]) -> DataFrame:
    """Rows with a sub-key: 0, or for a hot key a hash of the ``spread`` columns.

    Not a random number, so a recomputed task gives the same rows. Rows that
    are equal in all of ``spread`` share a sub-key. NULL keys are spread too:
    a left join keeps them all, though they match nothing.
    """
    salt = F.pmod(F.xxhash64(*(spread or on)), F.col(SALTS)).cast("int")
    return _with_salts(rows, hot, on).withColumn(SALT, salt).drop(SALTS)


def repeated(totals: DataFrame, hot: DataFrame, on: list[str]) -> DataFrame:
    """Totals with one row per sub-key; those of other keys stay single."""
    return _with_salts(totals, hot, on).withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(SALTS) - 1))).drop(SALTS)


def _join_salted(left: DataFrame, right: DataFrame, on: list[str], how: str, null_safe: bool) -> DataFrame:
    extra = [c for c in right.columns if c not in (*on, SALT)]
    if not null_safe:
        return left.join(right, [*on, SALT], how).select(*left.columns, *extra)
    right = right.withColumnsRenamed({c: f"_r_{c}" for c in [*on, SALT]})
    return left.join(right, _same([*on, SALT], "_r_"), how).select(*left.columns, *extra)


def join_totals(
    rows: DataFrame, totals: DataFrame, on: list[str], *, spread: list[str], how: str = "left", null_safe: bool = False, n: str | None = None
) -> DataFrame:
    """Bring one row of totals per key back to the detail rows.

    A single key may hold a large share of the rows, and AQE cannot split a
    shuffle that also feeds an aggregate. Hot keys are therefore spread over
    sub-keys, as many as their counts ask for. ``n`` names the rows per key
    among the totals and is left out of the result; without it keys are
    counted in a pass over the key columns.
    """
    counts = totals.select(*on, F.col(n).alias("_n")) if n else rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    hot = hot_keys(counts, on, "_n")
    right = repeated(totals.drop(n) if n else totals, hot, on)
    return _join_salted(salted(rows, hot, on, spread), right, on, how, null_safe).drop(SALT)


def three_way_left(
    base: DataFrame, first: DataFrame, second: DataFrame, on: list[str], null_safe: bool = False
) -> DataFrame:
    """base ⟕ first ⟕ second on the same keys, each with one row per key.

    Plain equality never matches NULL. Both joins use the same sub-keys, so the
    second finds its rows where the first has put them.
    """
    hot = hot_keys(base.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), on, "_n")
    out = salted(base, hot, on, [c for c in base.columns if c not in on])
    for other in (first, second):
        out = _join_salted(out, repeated(other, hot, on), on, "left", null_safe)
    return out.drop(SALT)


def lookup(facts: DataFrame, dim: DataFrame, key: str, values: dict[str, str]) -> DataFrame:
    """Dimension attributes (new name: dimension column) per fact row in one join; a key listed twice takes the smallest value.

    Reducing the dimension to one row per key first keeps the fact grain. A
    dimension that Catalyst knows to be small is broadcast, so that the facts
    are not shuffled; for a larger one AQE splits the partitions of hot keys.
    Facts without a key match nothing and are spread by a hash of their other
    columns: as one key they would all go to one task.
    """
    rest = [c for c in facts.columns if c != key]
    # An aggregate, as a plain 0 would make the second key a filter and not part of the join.
    one = dim.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.lit(0).cast("bigint")).alias(SALT), *[F.min(c).alias(a) for a, c in values.items()])
    spread = facts.withColumn(SALT, F.when(F.col(key).isNull(), F.xxhash64(*rest) if rest else F.lit(0)).otherwise(0).cast("bigint"))
    return spread.join(one, [key, SALT], "left").select(*facts.columns, *values)


def anti_join(spine: DataFrame, df: DataFrame, spine_col: str, col: str) -> DataFrame:
    """Spine rows without a match."""
    seen = df.select(F.col(col).alias(spine_col)).distinct()
    return spine.join(seen, spine_col, "left_anti")


def gap_having(spine: DataFrame, df: DataFrame, spine_col: str, col: str) -> DataFrame:
    """The same gaps by left join, count and HAVING 0, with the count kept."""
    per_day = df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias(spine_col)).agg(F.count(F.lit(1)).alias("n"))
    counted = spine.join(per_day, spine_col, "left").select(
        spine_col, F.coalesce("n", F.lit(0)).cast("bigint").alias("records_count")
    )
    return counted.filter(F.col("records_count") == 0)


def presence(spine: DataFrame, tables: list[tuple[str, DataFrame, str]], on: str = "date") -> DataFrame:
    """One boolean column per table: does it have rows on that spine day?

    Each table is reduced to its distinct days before the join; all joined
    sides are then at most one row per calendar day.
    """
    out = spine
    for name, df, col in tables:
        days = df.select(F.col(col).alias(on)).distinct().withColumn(name, F.lit(True))
        out = out.join(days, on, "left")
    return out.select(on, *[F.coalesce(name, F.lit(False)).alias(name) for name, _, _ in tables])


def self_join_shift(weekly: DataFrame, week: str, user: str, weeks: list[int]) -> DataFrame:
    """Mark, per (user, week), whether the user is also active k weeks later.

    Equal to a left self-join per k on (user, week + k): after the rows are
    distinct each such join matches at most once. Collecting a user's weeks
    needs one shuffle by user instead of one join per k; the set holds no more
    than the calendar's weeks and is combined before the shuffle.
    """
    per_user = weekly.groupBy(user).agg(F.collect_set(week).alias("_weeks"))
    out = per_user.select(user, "_weeks", F.explode("_weeks").alias(week))
    # A NULL user equals no user, not even another NULL.
    return out.select(
        user,
        week,
        *[
            (F.col(user).isNotNull() & F.array_contains("_weeks", F.date_add(week, 7 * k))).alias(f"after_{k}")
            for k in weeks
        ],
    )


def join_global_counts(df: DataFrame, col: str, counts_from: DataFrame | None = None, name: str = "cnt") -> DataFrame:
    """Attach the whole-table row count of each value of col."""
    counts = (counts_from or df).groupBy(col).agg(F.count(F.lit(1)).alias(name))
    rest = [c for c in df.columns if c != col]
    if rest:
        known = counts.withColumn("_rows", F.col(name)) if counts_from is None else counts
        return join_totals(df, known, [col], spread=rest, n=None if counts_from is not None else "_rows")
    # Rows of nothing but the key are their count, written as often; a NULL key matches no count.
    own = df.groupBy(col).agg(F.count(F.lit(1)).alias("_rows"))
    per = own.join(counts, col, "left").withColumn("_first", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"), F.lit(REPEATS).cast("long"))))
    per = per.hint("rebalance").withColumn("_each", F.explode(F.sequence(F.col("_first"), F.least("_rows", F.col("_first") + (REPEATS - 1)))))
    return per.select(col, name)
