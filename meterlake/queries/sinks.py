"""Writers run against tables in the shared folder and read back."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.functions.dates import week_start
from meterlake.plans.attribution import apply_spend, spend_deltas
from meterlake.queries import Query
from meterlake.queries.attribution import _APPLY, _metrics
from meterlake.queries.validation import EVENT_SUMMARY, EVENTS_BY_TYPE
from meterlake.queries.views import dbl, week
from meterlake.session import checkpointed, shared_dir
from meterlake.sinks import history, reports, summaries, tables
from meterlake.sinks.loads import REJECTED, Change, Loads
from meterlake.plans.validation import quality_long, quality_profile

# The new export of replace_range holds these two days only.
FIRST, LAST = "2024-01-10", "2024-01-20"
TARGET = "2024-01-15"


@contextmanager
def _table(s, name: str):
    """A declared, managed table in a database of its own at a fresh place, both gone afterwards."""
    at = shared_dir(s, name)
    db = "run_" + at.rsplit("-", 1)[-1]
    s.sql(f"CREATE DATABASE {db} LOCATION '{at}'")
    try:
        yield tables.create_table(s, name, f"{db}.{name}"), f"{at}/{name}"
    finally:
        s.sql(f"DROP DATABASE {db} CASCADE")


def _back(s, path: str, name: str) -> DataFrame:
    return s.read.schema(s.table(name).schema).parquet(path)


def _events(s, d) -> DataFrame:
    return P.app_usage_logs(s, d).drop("activity_timestamp")


def _daily(df: DataFrame) -> DataFrame:
    return df.groupBy("activity_date", "event_type").agg(
        F.count(F.lit(1)).alias("rows"),
        F.countDistinct("event_id").alias("event_ids"),
        F.countDistinct("user_email").alias("users"),
    )


_DAILY = "SELECT activity_date, event_type, COUNT(*) AS rows, COUNT(DISTINCT event_id) AS event_ids, COUNT(DISTINCT user_email) AS users"


def append_rows(s, d):
    """Two appends store the rows twice, each stamped with its load time."""
    with _table(s, "claude_ai_usage_stats") as (t, path):
        for _ in range(2):
            tables.append(_events(s, d), t)
        return checkpointed(_daily(_back(s, path, t).filter("ingestion_timestamp IS NOT NULL")))


def replace_date(s, d):
    """One day is replaced, twice, by its project events; the other days stay."""
    new = _events(s, d).filter("event_type = 'project_created'")
    with _table(s, "claude_ai_usage_stats") as (t, path):
        tables.append(_events(s, d), t)
        for _ in range(2):
            tables.replace_date(new, t, TARGET)
        return checkpointed(_daily(_back(s, path, t)))


def _new_export(s, d) -> DataFrame:
    return _events(s, d).filter(F.col("activity_date").isin(FIRST, LAST) & (F.col("event_type") == "project_created"))


def replace_range(s, d):
    """An export of two days replaces, twice, everything from the first to the last, at once."""
    store = Loads(s, shared_dir(s, "lake"))
    store.commit({"claude_ai_usage_stats": Change(_events(s, d))})
    for _ in range(2):
        store.replace_range("claude_ai_usage_stats", _new_export(s, d))
    return _daily(store.read("claude_ai_usage_stats"))


def range_replaced(s, d):
    """The same result as a DataFrame."""
    return _daily(tables.range_replaced(_events(s, d), _new_export(s, d)))


_REPLACED = f"""{_DAILY} FROM logs WHERE activity_date < DATE '{FIRST}' OR activity_date > DATE '{LAST}'
  OR (activity_date IN (DATE '{FIRST}', DATE '{LAST}') AND event_type = 'project_created') GROUP BY 1, 2"""


def update_spend(s, d):
    """Stored rows get their spend deltas; only the files that hold one of them are rewritten."""
    deltas = checkpointed(spend_deltas(P.spend_snapshots(s, d).filter("user_role = 'member'")))
    store = Loads(s, shared_dir(s, "lake"))
    store.commit({"cursor_daily_metrics": Change(_metrics(s, d))})
    store.update("cursor_daily_metrics", deltas, ["activity_date", "user_email"], lambda rows: apply_spend(rows, deltas))
    out = store.read("cursor_daily_metrics")
    return out.select("activity_date", "user_email", "total_applies", F.col("daily_spend_usd").cast("double").alias("daily_spend_usd"))


def recluster_events(s, d):
    """Two appends are laid out again by all cluster columns; a filter on the second one then reads few row groups."""
    name, store = "claude_ai_usage_stats", Loads(s, shared_dir(s, "lake"))
    for created in (True, False):
        store.commit({name: Change(_events(s, d).filter((F.col("event_type") == "project_created") == created), append=True)})
    store.recluster(name)
    return _daily(store.read(name))


def append_new(s, d):
    """The second export overlaps the first one: what is stored already is refused, so every event is stored once."""
    name, store = "claude_ai_usage_stats", Loads(s, shared_dir(s, "lake"))
    history.append_new(store, name, _events(s, d).filter("event_type <> 'project_created'"), ["event_id"])
    for _ in range(2):
        history.append_new(store, name, _events(s, d), ["event_id"])
    return _daily(store.read(name))


def append_new_refused(s, d):
    """What the second export brought again, beside the table."""
    name, store = "claude_ai_usage_stats", Loads(s, shared_dir(s, "lake"))
    history.append_new(store, name, _events(s, d).filter("event_type <> 'project_created'"), ["event_id"])
    history.append_new(store, name, _events(s, d), ["event_id"])
    return _daily(store.read(name + REJECTED))


def kept_event_users(s, d):
    """Distinct users by week and event type from the bitmaps of days; one day's events are replaced first."""
    store, logs = Loads(s, shared_dir(s, "lake")), P.app_usage_logs(s, d)
    days = [r[0] for r in logs.select("activity_date").distinct().collect()]  # calendar days
    summaries.refresh(store, summaries.EVENTS, lambda _: logs, days)
    only = logs.filter("event_type = 'project_created'")
    summaries.refresh(store, summaries.EVENTS, lambda _: only, [x for x in days if str(x) == TARGET])
    by = week_start("activity_date").alias("week")
    users = summaries.distinct_users(store, summaries.EVENTS, by, F.col("event_type"))
    events = store.read(summaries.EVENTS.totals).groupBy(by, "event_type").agg(F.sum("events").alias("events"))
    return events.join(users, ["week", "event_type"])


def _kept_events(s, d) -> Loads:
    """Partials of all events, one day at first with other rows."""
    store, logs = Loads(s, shared_dir(s, "lake")), P.app_usage_logs(s, d)
    days = [r[0] for r in logs.select("activity_date").distinct().collect()]  # calendar days
    early = logs.filter((F.col("activity_date") != TARGET) | (F.col("event_type") == "project_created"))
    summaries.refresh(store, summaries.EVENTS, lambda _: early, days)
    summaries.refresh(store, summaries.EVENTS, lambda _: logs, [x for x in days if str(x) == TARGET])
    return store


def kept_event_summary(s, d):
    """``event_summary`` from bitmaps of users, conversations and projects."""
    return summaries.event_summary(_kept_events(s, d))


def kept_events_by_type(s, d):
    """``events_by_type`` from the same."""
    return summaries.events_by_type(_kept_events(s, d))


def validation_report(s, d):
    """A quality report written as JSON and read back."""
    logs = P.app_usage_logs(s, d)
    rules = {"null_platforms": F.col("client_platform").isNull(), "null_users": F.col("user_email").isNull()}
    path = shared_dir(s, "report")
    reports.write_report(quality_long(quality_profile(logs, "logs", rules)), path)
    return s.read.schema("table_name string, check string, issues bigint, total_records bigint, status string").json(f"{path}/results")


def export_roundtrip(s, d):
    """A card exported as CSV and read back."""
    daily = P.claude_costs(s, d).groupBy("activity_date", "model").agg(F.sum("amount_usd").cast("double").alias("cost"))
    path = shared_dir(s, "export")
    reports.export(daily, path, "csv")
    return s.read.schema("activity_date date, model string, cost double").option("header", True).csv(path)


QUERIES = {
    "append_rows": Query(append_rows, f"{_DAILY.replace('COUNT(*)', '2 * COUNT(*)')} FROM logs GROUP BY 1, 2"),
    "replace_date": Query(
        replace_date, f"{_DAILY} FROM logs WHERE activity_date <> DATE '{TARGET}' OR event_type = 'project_created' GROUP BY 1, 2"
    ),
    "replace_range": Query(replace_range, _REPLACED),
    "range_replaced": Query(range_replaced, _REPLACED),
    "update_spend": Query(update_spend, _APPLY),
    "recluster_events": Query(recluster_events, f"{_DAILY} FROM logs GROUP BY 1, 2"),
    "append_new": Query(append_new, f"{_DAILY} FROM logs GROUP BY 1, 2"),
    "append_new_refused": Query(append_new_refused, f"{_DAILY} FROM logs WHERE event_type <> 'project_created' GROUP BY 1, 2"),
    "kept_event_users": Query(
        kept_event_users,
        f"""SELECT {week('activity_date')} AS week, event_type, COUNT(*) AS events, COUNT(DISTINCT user_email) AS users FROM logs
WHERE activity_date <> DATE '{TARGET}' OR event_type = 'project_created' GROUP BY 1, 2""",
    ),
    "kept_event_summary": Query(kept_event_summary, EVENT_SUMMARY),
    "kept_events_by_type": Query(kept_events_by_type, EVENTS_BY_TYPE),
    "write_report": Query(
        validation_report,
        """WITH n AS (SELECT COUNT(*) AS t, COUNT(*) FILTER (client_platform IS NULL) AS p, COUNT(*) FILTER (user_email IS NULL) AS u FROM logs)
SELECT 'logs' AS table_name, 'null_platforms' AS "check", p AS issues, t AS total_records, CASE WHEN p > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM n
UNION ALL SELECT 'logs', 'null_users', u, t, CASE WHEN u > 0 THEN 'FAIL' ELSE 'PASS' END FROM n""",
    ),
    "export_csv": Query(
        export_roundtrip, f"SELECT activity_date, model, {dbl('SUM(amount_usd)')} AS cost FROM costs GROUP BY 1, 2"
    ),
}
