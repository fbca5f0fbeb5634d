"""The daily loads and the backfill: read landed files once, check, then replace days.

A load commits its tables, the rows it rejected and its status together
(``sinks.loads``): a failed one leaves everything as it was, and running it
again replaces what it stored, rejected rows included.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.functions.dates import Day, date_spine
from meterlake.functions.numbers import count_big
from meterlake.operators.filters import filter_day
from meterlake.plans import attribution as A
from meterlake.plans import backfill as B
from meterlake.plans import validation as V
from meterlake.plans.costs import combined_daily_costs
from meterlake.plans.insights import check_rows, negative, required
from meterlake.schemas import TABLES
from meterlake.session import checkpointed, shared_dir
from meterlake.sinks.loads import REJECTED, STATUS, Change, Loads
from meterlake.sources import csv_exports, json_reports

# Fixed value: the share of rejected rows, in percent, above which a load raises an alert.
ALERT_PCT = 5.0


class CheckFailed(Exception):
    """A load was refused; nothing was written."""


# What tells one cost row from another; rows that differ in any of it are no duplicates.
COST_KEY = [
    "activity_date", "organization_id", "workspace_id", "model", "token_type", "cost_type", "description", "service_tier", "context_window",
]

def row_rules(name: str, credits: bool = True) -> dict[str, Column]:
    """What a row must not break to get into a table. Credits are negative amounts; leaving them out overstates cost."""
    return {
        "claude_costs": lambda: required("activity_date", "amount_usd") | ({} if credits else negative("amount_usd")),
        "claude_usage_keys": lambda: required("activity_date", "api_key_id") | negative("uncached_input_tokens", "output_tokens"),
        "claude_code_productivity": lambda: required("activity_date") | negative("num_sessions", "lines_added", "lines_removed"),
        "cursor_daily_metrics": lambda: required("activity_date", "user_email"),
        "claude_app_usage_logs": lambda: required("activity_date", "activity_timestamp", "event_type"),
    }[name]()


def check_day(costs: DataFrame, stored: StructType, day_max: float | None = None) -> None:
    """Refuse a day that has the same cost row twice, whose total is above ``day_max``, or a productivity table with cost columns."""
    groups = costs.groupBy(*COST_KEY).agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usd").alias("usd"))
    row = groups.agg(F.count_if(F.col("n") > 1).alias("dups"), F.sum("usd").alias("total")).first()
    if day_max is not None and (row.total or 0) > day_max:
        raise CheckFailed(f"total cost ${row.total:.2f} exceeds ${day_max:.2f}; amounts may be cents")
    if row.dups:
        raise CheckFailed(f"{row.dups} duplicate cost keys")
    bad = V.matching_columns(stored, V.FORBIDDEN)
    if bad:
        raise CheckFailed(f"cost columns in productivity: {', '.join(bad)}")


def pages_once(spark: SparkSession, paths: str | list[str], schema: str) -> DataFrame:
    """A report's pages, parsed once and kept: what is checked is what is loaded.

    A report whose last page did not land is refused; a page that landed twice
    counts once.
    """
    pages = checkpointed(json_reports.read_pages(spark, paths, schema))
    if "has_more" in pages.columns:
        gaps = json_reports.gaps_of(pages).first()
        if gaps.pages and not gaps.last_pages:
            raise CheckFailed(f"the last of {gaps.pages} pages is missing")
    elif "totalPages" in pages.columns:
        told = pages.agg(F.max("totalPages").alias("told"), count_big().alias("landed")).first()
        if told.told is not None and told.landed < told.told:
            raise CheckFailed(f"{told.told - told.landed} of {told.told} pages are missing")
    return pages


class Checked:
    """Rows of one table held against its rules: what is valid, what is not, and the status of each day.

    The status is that of the rows to be stored. A rejected row without a date
    belongs to ``first``, so that loading the same days again replaces it too.
    """

    def __init__(self, name: str, rows: DataFrame, days: DataFrame, first: Day, *, credits: bool, day_max: float | None, failures: DataFrame | None, run: str):
        col = TABLES[name].partition
        checked = checkpointed(check_rows(rows, row_rules(name, credits)).withColumn("load_day", F.coalesce(F.col(col), F.lit(str(first)).cast("date"))))
        valid, bad = checked.where(F.size("errors") == 0).drop("errors", "load_day"), checked.where(F.size("errors") > 0)
        amount = "amount_usd" if "amount_usd" in valid.columns else F.lit(None).cast("double")
        status = B.day_status(days, valid, day_max if "amount_usd" in valid.columns else None, None, col, amount)
        if failures is not None:
            status = B.with_failures(status, failures)
        rejected = bad.groupBy(F.col("load_day").alias("date")).agg(count_big().alias("rejected"))
        status = status.join(rejected, "date", "left").withColumn("rejected", F.coalesce("rejected", F.lit(0)))
        only = (F.col("status") == "empty") & (F.col("rejected") > 0)
        status = status.select(
            "date", "rows", "rejected", "total_cost", F.when(only, "failed").otherwise(F.col("status")).alias("status"),
            F.when(only, "all rows rejected").otherwise(F.col("reason")).alias("reason"),
            (F.col("rejected") * 100 > ALERT_PCT * (F.col("rows") + F.col("rejected"))).alias("alert"), F.lit(run).alias("run"),
        )
        self.name, self.status, self.rejected = name, checkpointed(status), bad
        self.valid = B.backfill_rows(valid, self.status, col)

    def changes(self, days: list[dt.date]) -> dict[str, Change]:
        """The day's rows, its rejected rows and its status, as one change; a day that is not ok keeps its stored rows."""
        return {
            self.name: Change(self.valid),
            self.name + REJECTED: Change(self.rejected, days=days),
            self.name + STATUS: Change(self.status, days=days),
        }

    def told(self) -> DataFrame:
        return self.status.withColumn("table", F.lit(self.name))


def _commit(store: Loads, tables: list[Checked], load: str | None) -> DataFrame:
    """All tables of a load at once; one status row per table and day."""
    changes, out = {}, None
    for t in tables:
        days = [r[0] for r in t.status.select("date").collect()]  # calendar days
        changes |= t.changes(days)
        out = t.told() if out is None else out.unionByName(t.told())
    store.commit(changes, load)
    return out


def load_vendor_day(
    store: Loads,
    target: Day,
    organization_id: str,
    *,
    cost_pages: str | list[str],
    usage_pages: str | list[str],
    productivity_pages: str | list[str],
    day_max: float | None = None,
    credits: bool = True,
    load: str | None = None,
) -> DataFrame:
    """Costs, key usage and IDE productivity of one day, all or none; returns the status of each table."""
    spark, load = store.spark, load or uuid.uuid4().hex
    costs, usage, ide = (pages_once(spark, paths, REPORTS[name][0]) for name, paths in _pages(cost_pages, usage_pages, productivity_pages).items())
    rows = {
        "claude_costs": filter_day(json_reports.cost_rows(costs, organization_id), target),
        "claude_usage_keys": filter_day(json_reports.usage_rows(usage, organization_id), target),
        "claude_code_productivity": filter_day(json_reports.productivity_rows(ide), target),
    }
    check_day(rows["claude_costs"], TABLES["claude_code_productivity"].schema, day_max)
    day = date_spine(spark, target, target)
    tables = [Checked(name, r, day, target, credits=credits, day_max=day_max, failures=None, run=load) for name, r in rows.items()]
    return _commit(store, tables, load)


def load_editor_day(store: Loads, target: Day, *, usage_pages: str | list[str], spend_pages: str | list[str], load: str | None = None) -> DataFrame:
    """Editor usage of one day with its spend, as the increase over the deltas stored in the cycle.

    Usage and spend are each parsed once and joined before the write, so the
    day is written once.
    """
    name, spark, load = "cursor_daily_metrics", store.spark, load or uuid.uuid4().hex
    usage = json_reports.team_usage_rows(pages_once(spark, usage_pages, json_reports.TEAM_USAGE_PAGE), target, target)
    usage = usage.withColumn("daily_spend_usd", F.lit(None).cast("decimal(18,2)"))
    spend = json_reports.spend_rows(pages_once(spark, spend_pages, json_reports.SPEND_PAGE), target)
    cycle = spend.agg(F.max("billing_cycle_start").cast("date")).first()[0]
    if cycle is not None:
        deltas = A.spend_deltas_for_day(spend, store.read(name, cycle, target), cycle, target)
        usage = A.apply_spend(usage, deltas, target)
    checked = Checked(name, usage, date_spine(spark, target, target), target, credits=True, day_max=None, failures=None, run=load)
    return _commit(store, [checked], load)


def load_activity_export(store: Loads, paths: str | list[str], load: str | None = None) -> DataFrame:
    """An audit export replaces the days it spans; returns the summary of the loaded range.

    Rows that break a rule, one without a date for instance, are kept beside
    the table with what is wrong with them; the others load.
    """
    name, spark, load = "claude_app_usage_logs", store.spark, load or uuid.uuid4().hex
    rows = checkpointed(csv_exports.app_usage_rows(csv_exports.read_activity_csv(spark, paths)))
    span = rows.agg(F.min("activity_date"), F.max("activity_date")).first()
    if span[0] is None:
        return V.load_summary(store.read(name).limit(0))
    checked = Checked(name, rows, date_spine(spark, *map(str, span)), span[0], credits=True, day_max=None, failures=None, run=load)
    days = [r[0] for r in checked.status.select("date").collect()]
    # All days of the span go, also those without a valid row.
    store.commit(checked.changes(days) | {name: Change(checked.valid, span=(span[0], span[1]))}, load)
    return V.load_summary(store.read(name, *map(str, span)))


REPORTS = {
    "claude_costs": (json_reports.COST_PAGE, json_reports.cost_rows),
    "claude_usage_keys": (json_reports.USAGE_PAGE, json_reports.usage_rows),
    "claude_code_productivity": (json_reports.PRODUCTIVITY_PAGE, lambda pages, _: json_reports.productivity_rows(pages)),
}


def _pages(cost_pages, usage_pages, productivity_pages) -> dict[str, str | list[str]]:
    given = {"claude_costs": cost_pages, "claude_usage_keys": usage_pages, "claude_code_productivity": productivity_pages}
    return {name: paths for name, paths in given.items() if paths is not None}


def _done(store: Loads, name: str, run: str) -> DataFrame:
    """The ledger of a run: days of a table whose outcome is committed."""
    return store.read(name + STATUS).where(F.col("run") == run).select("date")


def _load_days(
    store: Loads, days: DataFrame, organization_id: str, pages: dict[str, str | list[str]], day_max: float | None, credits: bool, run: str | None, chunk_days: int
) -> DataFrame:
    """Load the listed days of each report, a chunk of days at a time; one status row per table and day.

    A day fails when a page that names it is broken, when it has the same cost
    row twice, or when its total is above ``day_max``; the other days load. A
    broken page that names no day fails all days of its table, since any may
    be incomplete. Which file holds which days is read first, once a run; then
    a chunk parses the files of its days only and commits rows, rejected rows
    and status together. A run of the same name goes on after the last commit.
    """
    spark, resumed = store.spark, run is not None
    run = run or uuid.uuid4().hex
    out = None
    for name, paths in pages.items():
        schema, parse = REPORTS[name]
        wanted = days.select("date").distinct()
        if resumed:
            wanted = wanted.join(_done(store, name, run), "date", "left_anti")
        todo = sorted(r[0] for r in wanted.collect())  # calendar days
        index = store.root + f"/index/{run}/{name}" if resumed else shared_dir(spark, "index")
        if todo and not (resumed and store._exists("index", run, name, "_SUCCESS")):
            json_reports.page_days(spark, paths).write.mode("overwrite").parquet(index)
        for at in range(0, len(todo), chunk_days):
            chunk = todo[at : at + chunk_days]
            named = spark.read.schema("file string, date date").parquet(index)
            files = [r[0] for r in named.where(F.col("date").isNull() | F.col("date").isin(chunk)).select("file").distinct().collect()]  # files of the chunk
            spine = spark.createDataFrame([(d,) for d in chunk], "date date")
            good, broken = json_reports.read_good_pages(spark, files, schema) if files else (spark.createDataFrame([], schema), spark.createDataFrame([], "date date, reason string"))
            rows = parse(good, organization_id)
            undated = rows.where("activity_date IS NULL") if at == 0 else rows.limit(0)
            rows = checkpointed(rows.join(spine.select(F.col("date").alias("activity_date")), "activity_date", "left_semi").unionByName(undated))
            if name == "claude_costs":
                twice = rows.groupBy(*COST_KEY).count().filter("count > 1").groupBy(F.col("activity_date").alias("date")).agg(F.lit("duplicate cost rows").alias("reason"))
                broken = broken.unionByName(twice.where("date IS NOT NULL"))
            checked = Checked(name, rows, spine, chunk[0], credits=credits, day_max=day_max, failures=broken, run=run)
            _commit(store, [checked], f"{run}-{name}-{chunk[0]}")
        status = store.read(name + STATUS).where(F.col("run") == run).withColumn("table", F.lit(name))
        status = status.join(days.select("date").distinct(), "date", "left_semi")
        out = status if out is None else out.unionByName(status)
    return checkpointed(out)


def backfill(
    store: Loads, start: Day, end: Day, organization_id: str, *, cost_pages: str | list[str] | None = None, usage_pages: str | list[str] | None = None,
    productivity_pages: str | list[str] | None = None, day_max: float | None = None, credits: bool = True, run: str | None = None, chunk_days: int = 366,
) -> DataFrame:
    """A whole range; days that fail are left out and reported, one status row per table and calendar day.

    With ``run`` named, a backfill that was stopped goes on where it stopped
    when called again: days whose outcome is committed are not parsed again.
    """
    pages = _pages(cost_pages, usage_pages, productivity_pages)
    return _load_days(store, date_spine(store.spark, start, end), organization_id, pages, day_max, credits, run, chunk_days)


def retry_failed(
    store: Loads, dates: DataFrame, organization_id: str, *, cost_pages: str | list[str] | None = None, usage_pages: str | list[str] | None = None,
    productivity_pages: str | list[str] | None = None, day_max: float | None = None, credits: bool = True, run: str | None = None, chunk_days: int = 366,
) -> DataFrame:
    """The same for listed days: from a run log, a date file, or the table's own gaps."""
    pages = _pages(cost_pages, usage_pages, productivity_pages)
    return _load_days(store, dates, organization_id, pages, day_max, credits, run, chunk_days)


def unusual_loads(status: DataFrame, days: int = 7, low_pct: float = 50.0, high_pct: float = 200.0) -> DataFrame:
    """Days whose rows are far from the mean of the ``days`` loaded days before, per table; the first day has nothing to compare with."""
    from pyspark.sql import Window

    before = Window.partitionBy("table").orderBy("date").rowsBetween(-days, -1)
    usual = status.where("status = 'ok'").withColumn("usual_rows", F.avg("rows").over(before))  # a row per calendar day
    out = (F.col("rows") * 100 < F.col("usual_rows") * low_pct) | (F.col("rows") * 100 > F.col("usual_rows") * high_pct)
    return usual.where(out).select("table", "date", "rows", F.round("usual_rows", 2).alias("usual_rows"))


def register_views(store: Loads, ide_workspace: str | None = None) -> None:
    """Temporary views over the live tables, for SQL.

    ``claude_usage_report`` and ``claude_cost_report`` are older names of tables
    that are stored once; ``vw_combined_daily_costs`` is the combined fact. The
    views show the version that is current when they are registered.
    """
    for view, name in (("claude_usage_report", "claude_usage_keys"), ("claude_cost_report", "claude_costs")):
        rows = store.read(name)
        absent = [f for f in TABLES[view].schema if f.name not in rows.columns]
        rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in absent])
        rows.select(*TABLES[view].columns).createOrReplaceTempView(view)
    combined = combined_daily_costs(store.read("claude_costs"), store.read("claude_code_usage_stats"), store.read("cursor_daily_metrics"), ide_workspace)
    combined.createOrReplaceTempView("vw_combined_daily_costs")
