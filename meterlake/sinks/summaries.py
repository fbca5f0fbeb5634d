"""Summaries of long spans, folded from daily partials that are kept and updated by day.

A day of a fact is reduced to small tables: sums by user, and the users
themselves, as well as the values of other columns whose distinct numbers are
asked for, as bitmaps over a dictionary that numbers them densely. Sums of
days add up and bitmaps of days are OR-ed, so a month, a quarter or any other
span comes out exactly, all distinct counts included, without its facts and
without a copy of each row per count. When a day is loaded again only that
day's facts are read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, month_start
from meterlake.plans import costs as C
from meterlake.plans import insights as I
from meterlake.session import checkpointed
from meterlake.sinks.loads import Change, Conflict, Loads

IDS, VALUES = "user_ids", "value_ids"


@dataclass(frozen=True)
class Summary:
    """What is kept of a fact: ``sums`` (SQL aggregates that add up) by day, user and ``keys``, the users by day and ``keys``,
    and in the table ``bits`` the values of the string columns ``counted``."""

    day: str
    keys: tuple[str, ...]
    sums: dict[str, str]
    totals: str
    users: str
    sources: tuple[str, ...]
    counted: tuple[str, ...] = ()
    bits: str = ""


COSTS = Summary(
    "cost_date", ("provider",), {"amount_usd": "sum(amount_usd)", "rows": "count(1)"}, "daily_user_costs", "daily_cost_users",
    ("claude_costs", "claude_code_usage_stats", "cursor_daily_metrics"),
)
EVENTS = Summary(
    "activity_date", ("event_type", "client_platform"), {"events": "count(1)"}, "daily_user_events", "daily_event_users",
    ("claude_app_usage_logs",), ("conversation_uuid", "project_uuid"), "daily_event_values",
)


def numbered(values: DataFrame, first: int, value: str = "user_email") -> DataFrame:
    """Distinct values with ``id`` from ``first`` upwards, without a gap.

    Values are sorted within shards of their hash; a shard starts after the
    values of the shards before it. Only the totals of the shards, one row for
    each shuffle partition, pass one task.
    """
    shards = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    values = checkpointed(values.withColumn("_shard", F.pmod(F.xxhash64(value), F.lit(shards))))
    before = Window.orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = values.groupBy("_shard").agg(F.count(F.lit(1)).alias("_n")).select("_shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.row_number().over(Window.partitionBy("_shard").orderBy(value)) - 1
    return values.join(starts, "_shard").withColumn("id", F.lit(first) + F.col("_start") + place).drop("_shard", "_start")


def _bitmaps(seen: DataFrame, known: DataFrame, day: str, value: str, by: list[str], bits: str) -> tuple[DataFrame, DataFrame]:
    """Bitmaps of the values in ``seen`` (one row per value, day and key), and the new entries of the dictionary ``known``."""
    known = known.select("first_date", value, "id")
    last = known.agg(F.max("id")).first()[0]
    came = seen.groupBy(value).agg(F.trunc(F.min(day), "MM").alias("first_date"))
    new = checkpointed(numbered(came.join(known, value, "left_anti"), (last or 0) + 1, value).select("first_date", value, "id"))
    ids = known.unionByName(new).select(value, "id")
    parts = seen.select(*by, value).join(ids, value).groupBy(*by, F.bitmap_bucket_number("id").alias("part"))
    return parts.agg(F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias(bits)), new


def refresh(store: Loads, summary: Summary, facts: Callable[[list[dt.date]], DataFrame], days: list[dt.date], load: str | None = None, tries: int = 3) -> int:
    """Bring the partials of ``days`` up to date; ``facts`` returns the rows of the days it is given.

    A day without rows loses its partials. Totals, bitmaps and new numbers
    commit together; if another load commits meanwhile the days are computed
    again, so that a number is never given twice. Rows without a user are in
    the sums and in no bitmap. No days change nothing.
    """
    load = load or uuid.uuid4().hex
    for _ in range(tries):
        base = store.version()
        if store.loaded(load) is not None or not days:
            return base
        try:
            return store.commit(_changes(store, summary, facts(days), days), load, after=base)
        except Conflict:
            continue
    raise Conflict(load)


def _changes(store: Loads, summary: Summary, rows: DataFrame, days: list[dt.date]) -> dict[str, Change]:
    by = [summary.day, *summary.keys]
    sums = [F.expr(sql).alias(name) for name, sql in summary.sums.items()]
    rows = rows.where(F.col(summary.day).isin(days))
    totals = checkpointed(rows.groupBy(*by, "user_email").agg(*sums))
    users, new = _bitmaps(totals.where("user_email IS NOT NULL"), store.read(IDS), summary.day, "user_email", by, "users")
    out = {summary.totals: Change(totals, days=days), summary.users: Change(users, days=days), IDS: Change(new, append=True)}
    if summary.counted:
        values = store.read(VALUES)
        found = [_values(rows, values.where(F.col("name") == c), summary.day, c, by) for c in summary.counted]
        out[summary.bits] = Change(reduce(DataFrame.unionByName, [bits for bits, _ in found]), days=days)
        out[VALUES] = Change(reduce(DataFrame.unionByName, [new for _, new in found]), append=True)
    return out


def _values(rows: DataFrame, known: DataFrame, day: str, column: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """The same for a column other than the user; its facts are read once, as distinct values by day and key."""
    seen = checkpointed(rows.where(F.col(column).isNotNull()).select(*by, F.col(column).alias("value")).distinct())
    bits, new = _bitmaps(seen, known, day, "value", by, "bits")
    return bits.withColumn("name", F.lit(column)), new.withColumn("name", F.lit(column))


def stale_days(store: Loads, summary: Summary) -> list[dt.date]:
    """Days of the sources that were loaded, or removed, after the partials of the day."""
    log = store.log().groupBy("table", "day").agg(F.max("version").alias("version"))
    mine = log.where(F.col("table") == summary.totals).select("day", F.col("version").alias("done"))
    theirs = log.where(F.col("table").isin(*summary.sources)).groupBy("day").agg(F.max("version").alias("version"))
    late = theirs.join(mine, "day", "left").where(F.col("version") > F.coalesce("done", F.lit(0)))
    return sorted(r[0] for r in late.select("day").collect())  # calendar days


def refresh_costs(store: Loads, ide_workspace: str | None = None, load: str | None = None) -> int:
    """Update the cost partials for the days whose facts changed; reads those days only."""

    def facts(days: list[dt.date]) -> DataFrame:
        return C.combined_daily_costs(*[store.read_days(t, days) for t in COSTS.sources], ide_workspace)

    return refresh(store, COSTS, facts, stale_days(store, COSTS), load)


def refresh_events(store: Loads, load: str | None = None) -> int:
    """The same for the activity log."""
    return refresh(store, EVENTS, lambda days: store.read_days(EVENTS.sources[0], days), stale_days(store, EVENTS), load)


# --- reading ---------------------------------------------------------------------------


def distinct_users(store: Loads, summary: Summary, *by: Column, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """``users``: the number of distinct users of each group, exact; ``by`` may use the day and the keys.

    Bitmaps of 32768 users are OR-ed before and after the shuffle; no user is
    sorted, exploded or compared.
    """
    return _distinct(store.read(summary.users, start, end), "users", by, "users")


def distinct_values(store: Loads, summary: Summary, column: str, *by: Column, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """``values``: the same for one of the columns that ``summary`` counts."""
    if column not in summary.counted:
        raise ValueError(f"{column} is not counted; {summary.totals} counts {', '.join(summary.counted)}")
    return _distinct(store.read(summary.bits, start, end).where(F.col("name") == column), "bits", by, "values")


def _distinct(rows: DataFrame, bits: str, by: tuple[Column, ...], out: str) -> DataFrame:
    names = [f"_{i}" for i in range(len(by))]
    whole = rows.groupBy(*[c.alias(n) for c, n in zip(by, names)], "part").agg(F.bitmap_or_agg(bits).alias("_bits"))
    counts = whole.groupBy(*names).agg(F.coalesce(F.sum(F.bitmap_count("_bits")), F.lit(0)).cast("bigint").alias(out))
    given = rows.limit(0).select(*by).columns
    return counts.select(*[F.col(n).alias(g) for n, g in zip(names, given)], out)


def event_summary(store: Loads, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """``validation.event_summary`` from the partials: four distinct counts, no fact read."""
    totals = store.read(EVENTS.totals, start, end)
    users = distinct_users(store, EVENTS, start=start, end=end)
    types = totals.groupBy("event_type").agg(F.lit(1)).agg(F.count("event_type"))
    values = {c: distinct_values(store, EVENTS, c, start=start, end=end) for c in EVENTS.counted}
    return totals.agg(
        F.lit("Claude AI Usage Summary").alias("metric_name"),
        F.coalesce(F.sum("events"), F.lit(0)).cast("bigint").alias("total_events"),
        F.min("activity_date").alias("earliest_date"),
        F.max("activity_date").alias("latest_date"),
    ).select(
        "metric_name", "total_events", users.scalar().alias("unique_users"), types.scalar().alias("unique_event_types"),
        values["conversation_uuid"].scalar().alias("unique_conversations"), values["project_uuid"].scalar().alias("unique_projects"),
        "earliest_date", "latest_date",
    )


def events_by_type(store: Loads, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """``validation.events_by_type`` from the partials."""
    kind = F.col("event_type")
    users = distinct_users(store, EVENTS, kind.alias("_of_users"), start=start, end=end)
    talks = distinct_values(store, EVENTS, "conversation_uuid", kind.alias("_of_talks"), start=start, end=end)
    out = store.read(EVENTS.totals, start, end).groupBy(kind).agg(
        F.sum("events").cast("bigint").alias("event_count"),
        F.min("activity_date").alias("first_occurrence"),
        F.max("activity_date").alias("last_occurrence"),
    )
    out = out.join(users, kind.eqNullSafe(F.col("_of_users")), "left").join(talks, kind.eqNullSafe(F.col("_of_talks")), "left")
    none = F.lit(0).cast("bigint")
    return out.select(
        kind, "event_count", F.coalesce("users", none).alias("unique_users"), F.coalesce("values", none).alias("unique_conversations"),
        "first_occurrence", "last_occurrence",
    ).orderBy(F.col("event_count").desc(), "event_type")


def monthly_summary(store: Loads) -> DataFrame:
    """``costs.monthly_summary`` from the partials."""
    return C.monthly_summary(store.read(COSTS.totals))


def monthly_finance(store: Loads) -> DataFrame:
    """``insights.monthly_finance`` from the partials."""
    return I.monthly_finance(store.read(COSTS.totals))


def executive_summary(store: Loads, monthly_budget: float = 73000.0 / 3) -> DataFrame:
    """``insights.executive_summary`` from the partials; users come from the bitmaps."""
    nobody = store.read(COSTS.totals).withColumn("user_email", F.lit(None).cast("string"))
    months = I.executive_summary(nobody, monthly_budget)
    users = distinct_users(store, COSTS, month_start("cost_date").alias("cost_month"))
    out = months.join(users, "cost_month", "left").withColumn("active_users", F.coalesce("users", F.lit(0)).cast("bigint"))
    return out.select(*months.columns).orderBy("cost_month")
