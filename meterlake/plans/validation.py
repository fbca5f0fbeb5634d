"""Validation, reconciliation and coverage checks.

Each check is one aggregate pass per table. Checks over several tables stack
one-row results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, date_spine, day, hours_between, month_key, month_label
from meterlake.functions.numbers import count_big, percent, rate, safe_divide
from meterlake.functions.text import string_agg_distinct
from meterlake.operators.aggregates import top_k, union_all
from meterlake.operators.filters import any_violation, between_dates, trailing
from meterlake.operators.joins import SALT, anti_join, presence
from meterlake.sources.tables import columns_of, matching_columns

PASS, FAIL, WARN = "PASS", "FAIL", "WARNING"


def _in(df: DataFrame, start: Day | None, end: Day | None, col: str = "activity_date") -> DataFrame:
    return between_dates(df, col, start, end)


def _long(col: str, alias: str | None = None) -> Column:
    return F.sum(col).cast("bigint").alias(alias or col)


def _dollars(cents: str, alias: str) -> Column:
    return (F.sum(cents).cast("double") / 100).alias(alias)


def _amount(alias: str = "total_cost_usd") -> Column:
    return F.sum("amount_usd").cast("double").alias(alias)


# --- spend snapshots ----------------------------------------------------------

_SPEND = [
    ("total_spend_cents", "total_cost_usd"),
    ("spend_cents", "actual_spend_usd"),
    ("included_spend_cents", "included_spend_usd"),
]


def spend_summary(spend: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(spend, start, end, "snapshot_date").agg(
        F.lit("Cursor Total Cost").alias("metric_name"),
        *[_dollars(c, a) for c, a in _SPEND],
        F.countDistinct("user_email").alias("unique_users"),
        F.min("snapshot_date").alias("earliest_date"),
        F.max("snapshot_date").alias("latest_date"),
        count_big().alias("total_records"),
    )


def spend_by_user(spend: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(spend, start, end, "snapshot_date").groupBy("user_email", "user_name", "user_role").agg(
        *[_dollars(c, a) for c, a in _SPEND],
        _long("fast_premium_requests", "total_fast_premium_requests"),
        F.max("hard_limit_override_dollars").alias("hard_limit_override"),
        F.countDistinct("snapshot_date").alias("days_with_data"),
    )
    return out.orderBy(F.col("total_cost_usd").desc(), "user_email")


def spend_daily(spend: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(spend, start, end, "snapshot_date").groupBy("snapshot_date").agg(
        *[_dollars(c, f"daily_{a}") for c, a in _SPEND],
        F.countDistinct("user_email").alias("daily_active_users"),
        count_big().alias("daily_records"),
    )
    return out.orderBy("snapshot_date")


def monthly_spend(spend: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Month label, users and dollars, in calendar order."""
    out = _in(spend, start, end, "snapshot_date").groupBy(
        month_key("snapshot_date").alias("_key"), month_label("snapshot_date").alias("month")
    ).agg(F.countDistinct("user_email").alias("users"), _dollars("total_spend_cents", "total_dollars"))
    return out.orderBy("_key").drop("_key")


# --- editor and IDE usage -------------------------------------------------------

_EDITOR_SUMS = [
    "total_lines_added", "total_lines_deleted", "accepted_lines_added", "accepted_lines_deleted",
    "total_applies", "total_accepts", "total_rejects", "total_tabs_shown", "total_tabs_accepted",
    "composer_requests", "chat_requests", "agent_requests",
]


def editor_activity_summary(usage: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(usage, start, end).agg(
        F.lit("Cursor Usage Summary").alias("metric_name"),
        F.countDistinct("user_email").alias("total_unique_users"),
        count_big(F.col("is_active")).alias("active_users"),
        *[_long(c) for c in _EDITOR_SUMS],
    )


def editor_top_users(usage: DataFrame, start: Day | None = None, end: Day | None = None, k: int = 20) -> DataFrame:
    """A row with an unknown request count adds nothing to ``total_requests``."""
    requests = F.col("composer_requests") + F.col("chat_requests") + F.col("agent_requests")
    users = _in(usage, start, end).groupBy("user_email").agg(
        F.countDistinct("activity_date").alias("active_days"),
        count_big(F.col("is_active")).alias("days_marked_active"),
        _long("total_lines_added", "lines_added"),
        _long("total_lines_deleted", "lines_deleted"),
        _long("total_accepts"),
        _long("total_rejects"),
        F.sum(requests).cast("bigint").alias("total_requests"),
        string_agg_distinct("most_used_model").alias("models_used"),
    )
    return top_k(users, "total_requests", k, "user_email")


def _tool_sum(outcome: str) -> Column:
    tools = [F.col(f"{t}_{outcome}") for t in ("edit_tool", "multi_edit_tool", "write_tool", "notebook_edit_tool")]
    return F.sum(tools[0] + tools[1] + tools[2] + tools[3]).cast("bigint")


def ide_summary(ide: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(ide, start, end).agg(
        F.lit("Claude Code Usage").alias("metric_name"),
        F.countDistinct("user_email").alias("unique_users"),
        F.countDistinct("organization_id").alias("unique_organizations"),
        _long("num_sessions", "total_sessions"),
        _long("lines_added", "total_lines_added"),
        _long("lines_removed", "total_lines_removed"),
        _long("commits_by_claude_code", "total_commits"),
        _long("pull_requests_by_claude_code", "total_pull_requests"),
        _tool_sum("accepted").alias("total_tool_accepts"),
        _tool_sum("rejected").alias("total_tool_rejects"),
        F.sum(F.col("total_input_tokens") + F.col("total_output_tokens")).cast("bigint").alias("total_tokens"),
        F.sum(F.col("total_estimated_cost_usd").cast("decimal(18,6)")).cast("double").alias("total_estimated_cost_usd"),
    )


def ide_top_users(ide: DataFrame, start: Day | None = None, end: Day | None = None, k: int = 20) -> DataFrame:
    users = _in(ide, start, end).groupBy("user_email", "terminal_type").agg(
        _long("num_sessions", "sessions"),
        _long("lines_added"),
        _long("lines_removed"),
        _long("commits_by_claude_code", "commits"),
        F.sum(F.col("total_input_tokens") + F.col("total_output_tokens")).cast("bigint").alias("total_tokens"),
        F.sum(F.col("total_estimated_cost_usd").cast("decimal(18,6)")).cast("double").alias("estimated_cost_usd"),
        F.countDistinct("activity_date").alias("active_days"),
    )
    return top_k(users, "sessions", k, ["user_email", "terminal_type"])


def ide_coverage(ide: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Users and terminals that report productivity, with lines and commits."""
    return _in(ide, start, end).agg(
        F.countDistinct("user_email").alias("unique_users"),
        F.countDistinct("terminal_type").alias("unique_terminals"),
        _long("lines_added", "total_lines_added"),
        _long("commits_by_claude_code", "total_commits"),
    )


def engineering_activity(view: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Active users and events per day over a productivity view."""
    out = _in(view, start, end).groupBy("activity_date").agg(
        F.countDistinct("user_email").alias("active_users"), _long("total_events")
    )
    return out.orderBy("activity_date")


# --- event log -------------------------------------------------------------------

def event_summary(logs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(logs, start, end).agg(
        F.lit("Claude AI Usage Summary").alias("metric_name"),
        count_big().alias("total_events"),
        F.countDistinct("user_email").alias("unique_users"),
        F.countDistinct("event_type").alias("unique_event_types"),
        F.countDistinct("conversation_uuid").alias("unique_conversations"),
        F.countDistinct("project_uuid").alias("unique_projects"),
        F.min("activity_date").alias("earliest_date"),
        F.max("activity_date").alias("latest_date"),
    )


def events_by_type(logs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(logs, start, end).groupBy("event_type").agg(
        count_big().alias("event_count"),
        F.countDistinct("user_email").alias("unique_users"),
        F.countDistinct("conversation_uuid").alias("unique_conversations"),
        F.min("activity_date").alias("first_occurrence"),
        F.max("activity_date").alias("last_occurrence"),
    )
    return out.orderBy(F.col("event_count").desc(), "event_type")


def top_event_users(logs: DataFrame, start: Day | None = None, end: Day | None = None, k: int = 20) -> DataFrame:
    users = _in(logs, start, end).groupBy("user_email", "user_name").agg(
        count_big().alias("total_events"),
        F.countDistinct("event_type").alias("unique_event_types"),
        F.countDistinct("conversation_uuid").alias("conversations"),
        F.countDistinct("activity_date").alias("active_days"),
        F.countDistinct("client_platform").alias("platforms_used"),
    )
    return top_k(users, "total_events", k, ["user_email", "user_name"])


def load_summary(logs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(logs, start, end).groupBy("activity_date").agg(
        count_big().alias("records"),
        F.countDistinct("user_email").alias("users"),
        F.countDistinct("event_type").alias("event_types"),
    )
    return out.orderBy(F.col("activity_date").desc())


# --- costs and tokens --------------------------------------------------------------

def cost_summary(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(costs, start, end).agg(
        F.lit("Claude Cost Summary").alias("metric_name"),
        _amount(),
        F.countDistinct("organization_id").alias("unique_organizations"),
        F.countDistinct("workspace_id").alias("unique_workspaces"),
        F.countDistinct("model").alias("unique_models"),
        F.countDistinct("cost_type").alias("unique_cost_types"),
        F.min("activity_date").alias("earliest_date"),
        F.max("activity_date").alias("latest_date"),
    )


def cost_by_model(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(costs, start, end).filter(F.col("model").isNotNull()).groupBy("model").agg(
        _amount(),
        count_big().alias("record_count"),
        F.countDistinct("workspace_id").alias("unique_workspaces"),
        string_agg_distinct("cost_type").alias("cost_types"),
    )
    return out.orderBy(F.col("total_cost_usd").desc(), "model")


def cost_by_type(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(costs, start, end).groupBy("cost_type", "token_type").agg(
        _amount(), count_big().alias("record_count"), F.countDistinct("model").alias("models_involved")
    )
    return out.orderBy(F.col("total_cost_usd").desc(), "cost_type", "token_type")


def cost_by_day(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(costs, start, end).groupBy("activity_date").agg(_amount("daily_cost"), count_big().alias("records"))
    return out.orderBy("activity_date")


_TOKEN_SUMS = [
    ("uncached_input_tokens", "total_uncached_input_tokens"),
    ("output_tokens", "total_output_tokens"),
    ("cache_read_input_tokens", "total_cache_read_tokens"),
    ("cache_creation_1h_tokens", "total_cache_creation_1h_tokens"),
    ("cache_creation_5m_tokens", "total_cache_creation_5m_tokens"),
    ("web_search_requests", "total_web_search_requests"),
]


def token_summary(usage: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _in(usage, start, end).agg(
        F.lit("Claude Usage Report").alias("metric_name"),
        *[_long(c, a) for c, a in _TOKEN_SUMS],
        F.countDistinct("organization_id").alias("unique_organizations"),
        F.countDistinct("workspace_id").alias("unique_workspaces"),
        F.countDistinct("model").alias("unique_models"),
    )


def token_by_model(usage: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    kinds = [c for c, _ in _TOKEN_SUMS[:-1]]
    total = sum((F.sum(c) for c in kinds[1:]), F.sum(kinds[0]))
    out = _in(usage, start, end).filter(F.col("model").isNotNull()).groupBy("model").agg(
        _long("uncached_input_tokens"),
        _long("output_tokens"),
        _long("cache_read_input_tokens", "cache_read_tokens"),
        F.sum(F.col("cache_creation_1h_tokens") + F.col("cache_creation_5m_tokens")).cast("bigint").alias("cache_creation_tokens"),
        F.round(safe_divide(total, F.lit(1000000)), 2).alias("total_tokens_millions"),
        F.countDistinct("workspace_id").alias("unique_workspaces"),
    )
    return out.orderBy(F.col("total_tokens_millions").desc(), "model")


def key_coverage(usage: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Distinct keys, rows and tokens."""
    tokens = F.col("uncached_input_tokens") + F.col("output_tokens") + F.col("cache_read_input_tokens")
    return _in(usage, start, end).agg(
        F.countDistinct("api_key_id").alias("unique_api_keys"),
        count_big().alias("total_usage_records"),
        F.sum(tokens).cast("bigint").alias("total_tokens"),
    )


def provider_costs(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in(costs, start, end, "cost_date").groupBy("provider").agg(
        _amount(),
        F.countDistinct("user_email").alias("unique_users"),
        F.countDistinct("cost_date").alias("days_with_data"),
        F.min("cost_date").alias("earliest_date"),
        F.max("cost_date").alias("latest_date"),
    )
    return out.orderBy(F.col("total_cost_usd").desc(), "provider")


def daily_provider_costs(costs: DataFrame, start: Day | None = None, end: Day | None = None, by_user: bool = False) -> DataFrame:
    keys = ["cost_date", "provider", *(["user_email"] if by_user else [])]
    aggs = [_amount("daily_cost_usd")]
    if not by_user:
        aggs.append(F.countDistinct("user_email").alias("daily_users"))
    return _in(costs, start, end, "cost_date").groupBy(*keys).agg(*aggs).orderBy(*keys)


# --- quality ---------------------------------------------------------------------

def quality_profile(
    df: DataFrame,
    table_name: str,
    rules: dict[str, Column],
    start: Day | None = None,
    end: Day | None = None,
    col: str = "activity_date",
    distinct: dict[str, str] | None = None,
) -> DataFrame:
    """Row count and, per rule, the rows that meet it; all in one pass.

    The ``any_issue`` flag is true if any rule counted a row.
    """
    counts = [count_big(cond).alias(name) for name, cond in rules.items()]
    uniques = [F.countDistinct(c).alias(name) for name, c in (distinct or {}).items()]
    out = _in(df, start, end, col).agg(
        F.lit(table_name).alias("table_name"), count_big().alias("total_records"), *counts, *uniques
    )
    return out.withColumn("any_issue", F.greatest(*[F.col(n) for n in rules], F.lit(0)) > 0)


def null_rules(*cols: str) -> dict[str, Column]:
    return {f"null_{c}": F.col(c).isNull() for c in cols}


def negative_rules(*cols: str) -> dict[str, Column]:
    return {f"negative_{c}": F.col(c) < 0 for c in cols}


def future_rule(col: str, as_of: Day) -> dict[str, Column]:
    return {"future_dates": F.col(col) > day(as_of)}


def quality_long(profile: DataFrame) -> DataFrame:
    """A profile as (table_name, check, issues, status) rows, to stack tables with different rules."""
    checks = [c for c in profile.columns if c not in ("table_name", "total_records", "any_issue")]
    pairs = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("issues")) for c in checks])
    return profile.select("table_name", "total_records", F.explode(pairs).alias("e")).select(
        "table_name",
        F.col("e.check").alias("check"),
        F.col("e.issues").alias("issues"),
        "total_records",
        F.when(F.col("e.issues") > 0, FAIL).otherwise(PASS).alias("status"),
    )


# --- coverage ---------------------------------------------------------------------

Tables = list[tuple[str, DataFrame, str]]


def date_coverage(
    tables: Tables, start: Day, end: Day, only_gaps: bool = False, as_boolean: bool = False
) -> DataFrame:
    """Per calendar day, whether each table has rows: Present/MISSING or booleans."""
    spark = tables[0][1].sparkSession
    ranged = [(name, _in(df, start, end, col), col) for name, df, col in tables]
    flags = presence(date_spine(spark, start, end), ranged)
    names = [name for name, _, _ in tables]
    if only_gaps:
        flags = any_violation(flags, [~F.col(n) for n in names])
    if not as_boolean:
        flags = flags.select("date", *[F.when(F.col(n), "Present").otherwise("MISSING").alias(n) for n in names])
    return flags.orderBy("date")


def coverage_summary(tables: Tables, start: Day, end: Day) -> DataFrame:
    """Days expected and present per table, and an overall status."""
    flags = date_coverage(tables, start, end, as_boolean=True)
    names = [name for name, _, _ in tables]
    complete = F.bool_and(F.expr(" AND ".join(f"`{n}`" for n in names)))
    return flags.agg(
        count_big().alias("total_days_expected"),
        *[count_big(F.col(n)).alias(f"{n}_days_present") for n in names],
        F.when(complete, PASS).otherwise(WARN).alias("status"),
    )


def missing_dates(df: DataFrame, col: str, start: Day, end: Day) -> DataFrame:
    spine = date_spine(df.sparkSession, start, end, "missing_date")
    return anti_join(spine, _in(df, start, end, col), "missing_date", col).orderBy("missing_date")


def table_inventory(tables: list[tuple[str, DataFrame, str, str | None]]) -> DataFrame:
    """Rows, distinct dates, first and last date and optional cost per table, stacked."""
    def one(name: str, df: DataFrame, col: str, amount: str | None) -> DataFrame:
        cost = F.sum(amount).cast("double") if amount else F.lit(None).cast("double")
        return df.agg(
            F.lit(name).alias("table_name"),
            count_big().alias("total_records"),
            F.countDistinct(col).alias("unique_dates"),
            F.min(col).alias("earliest_date"),
            F.max(col).alias("latest_date"),
            cost.alias("total_cost"),
        )

    return union_all([one(*t) for t in tables])


def freshness(df: DataFrame, col: str = "activity_date", ingested: str = "ingestion_timestamp", min_days: int = 7) -> DataFrame:
    """Last date and load, days covered against the span, and the more-than-a-page check."""
    span = F.datediff(F.max(col), F.min(col))
    days = F.countDistinct(col)
    return df.agg(
        F.max(col).alias("latest_date"),
        F.max(ingested).alias("last_run"),
        days.alias("total_days"),
        span.cast("bigint").alias("days_covered"),
        F.when(days > min_days, PASS).otherwise(FAIL).alias("status"),
    )


def hours_since_update(df: DataFrame, ingested: str, now: Column) -> DataFrame:
    return df.agg(hours_between(F.max(ingested), now).alias("hours_since_update"))


# --- cost accuracy ------------------------------------------------------------------

DUPLICATE_KEYS = ["activity_date", "workspace_id", "model", "token_type"]


def duplicate_groups(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Key groups with more than one row.

    The default key leaves out description and context window, so rows that
    differ only there are reported too.
    """
    return df.groupBy(*(keys or DUPLICATE_KEYS)).agg(count_big().alias("cnt")).filter(F.col("cnt") > 1)


def duplicate_check(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    n = count_big()
    return duplicate_groups(df, keys).agg(
        F.lit("Duplicate Check").alias("test"), n.alias("duplicate_groups"), F.when(n == 0, PASS).otherwise(FAIL).alias("status")
    )


def dedup_compare(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Totals of all rows, workspace rows and organisation rows, from one scan."""
    ws = F.col("workspace_id").isNotNull()
    one = _in(costs, start, end).agg(
        F.sum("amount_usd").cast("double").alias("a"), count_big().alias("an"),
        F.sum(F.when(ws, F.col("amount_usd"))).cast("double").alias("w"), count_big(ws).alias("wn"),
        F.sum(F.when(~ws, F.col("amount_usd"))).cast("double").alias("o"), count_big(~ws).alias("on"),
    )
    return one.select(
        F.expr(
            "stack(3, 'BEFORE (with dupes)', a, an, 'AFTER (workspace only)', w, wn, 'AFTER (org only)', o, on)"
            " AS (scenario, total_cost, record_count)"
        )
    )


def dedup_view(costs: DataFrame, workspace_only: bool = True) -> DataFrame:
    """Optional filter only: NULL and named workspaces are disjoint, so the default reads both."""
    ws = F.col("workspace_id")
    return costs.filter(ws.isNotNull() if workspace_only else ws.isNull())


def cost_ceiling(costs: DataFrame, day_max: float = 1000.0, row_warn: float = 100.0, row_max: float = 1000.0) -> DataFrame:
    """Per day: total above day_max fails; a single amount above row_warn warns, above row_max fails."""
    top = F.max("amount_usd")
    out = costs.groupBy("activity_date").agg(
        F.sum("amount_usd").cast("double").alias("total_cost"),
        top.cast("double").alias("max_single_cost"),
        F.when(F.sum("amount_usd") > day_max, FAIL).otherwise(PASS).alias("day_status"),
        F.when(top > row_max, FAIL).when(top >= row_warn, WARN).otherwise(PASS).alias("row_status"),
    )
    return out.orderBy("activity_date")


def high_costs(costs: DataFrame, threshold: float = 100.0, k: int = 20) -> DataFrame:
    rows = costs.filter(F.col("amount_usd") > threshold).select("activity_date", "workspace_id", "model", "token_type", "amount_usd")
    top = top_k(rows, "amount_usd", k, ["activity_date", "workspace_id", "model", "token_type"])
    return top.withColumn("amount_usd", F.col("amount_usd").cast("double"))


# Name patterns no productivity column may match.
FORBIDDEN = ["%cost%", "%amount%"]
FORBIDDEN_WITH_TOKENS = [*FORBIDDEN, "%token%"]


def forbidden_columns(df: DataFrame, patterns: list[str] | None = None) -> DataFrame:
    n = count_big()
    return columns_of(df.sparkSession, df, patterns or FORBIDDEN_WITH_TOKENS).agg(
        F.lit("Cost Column Check").alias("test"),
        n.alias("cost_columns_found"),
        F.when(n == 0, PASS).otherwise(FAIL).alias("status"),
    )


def checkpoint_report(
    costs: DataFrame,
    productivity: DataFrame,
    expected: float,
    tol: float = 10.0,
    start: Day | None = None,
    end: Day | None = None,
    min_days: int = 250,
    max_single: float = 100.0,
) -> DataFrame:
    """Five acceptance checks, stacked with PASS or FAIL.

    The duplicate check needs the rows grouped by their key; the other figures
    are taken from those groups, so the cost table is read once.
    """
    d, amount = F.col("activity_date"), F.col("amount_usd")
    in_range = F.lit(True)
    if start is not None:
        in_range = in_range & (d >= day(start))
    if end is not None:
        in_range = in_range & (d <= day(end))
    groups = costs.groupBy(*DUPLICATE_KEYS).agg(
        count_big().alias("cnt"), F.sum(F.when(in_range, amount)).alias("total"), F.max(amount).alias("top")
    )
    forbidden = len(matching_columns(productivity.schema, FORBIDDEN))
    exact = F.lit(str(expected)).cast("decimal(18,6)")
    total, dups, days, top = F.sum("total"), count_big(F.col("cnt") > 1), F.countDistinct("activity_date"), F.max("top")
    checks = [
        ("Cost Accuracy", total, F.abs(total - exact) <= tol),
        ("No Duplicates", dups, dups == 0),
        ("Data Completeness", days, days >= min_days),
        ("No Cost Columns in Productivity", F.lit(forbidden), F.lit(forbidden == 0)),
        ("Amounts in Dollars (not cents)", top, top < max_single),
    ]
    rows = [
        F.struct(
            F.lit(n).cast("bigint").alias("checkpoint"),
            F.lit(test).alias("test"),
            result.cast("double").alias("result"),
            F.when(ok, PASS).otherwise(FAIL).alias("status"),
        )
        for n, (test, result, ok) in enumerate(checks, 1)
    ]
    return groups.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def cost_accuracy(
    costs: DataFrame, expected: float, tol: float = 10.0, start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Total against a known total, with an absolute tolerance."""
    total = F.sum("amount_usd")
    exact = F.lit(str(expected)).cast("decimal(18,6)")
    return _in(costs, start, end).agg(
        total.cast("double").alias("total_cost"),
        F.lit(float(expected)).alias("expected_total"),
        F.abs(total - exact).cast("double").alias("difference"),
        F.when(F.abs(total - exact) <= tol, PASS).otherwise(FAIL).alias("status"),
    )


# Tolerances in percent.
TOKENS_PERCENT, COST_PERCENT = 2.0, 1.0


def tolerance_compare(
    actual: DataFrame,
    expected: DataFrame,
    key: str,
    measures: dict[str, float] | None = None,
    expected_only: bool = False,
) -> DataFrame:
    """Actual against expected per key, each measure with its tolerance in percent.

    A key without an expected row is a warning. Expected keys without an actual
    row are ignored as coded; ``expected_only`` reports them as failed.
    """
    measures = measures or {"cost": COST_PERCENT, "tokens": TOKENS_PERCENT}
    a = actual.select(key, *[F.col(m).cast("double").alias(f"actual_{m}") for m in measures], F.lit(True).alias("_a"))
    e = expected.select(key, *[F.col(m).cast("double").alias(f"expected_{m}") for m in measures], F.lit(True).alias("_e"))
    joined = a.join(e, key, "full" if expected_only else "left")
    raw = {m: safe_divide(F.abs(F.col(f"actual_{m}") - F.col(f"expected_{m}")), f"expected_{m}") * 100 for m in measures}
    within = None
    for m, tol in measures.items():
        ok = F.coalesce(raw[m] <= tol, F.lit(False))
        within = ok if within is None else within & ok
    status = F.when(F.col("_e").isNull(), WARN).when(within, "PASSED").otherwise("FAILED")
    out = [key]
    for m in measures:
        out += [F.col(f"actual_{m}"), F.col(f"expected_{m}"), F.round(raw[m], 2).alias(f"{m}_variance_percent")]
    return joined.select(*out, status.alias("status"))


def status_counts(results: DataFrame) -> DataFrame:
    """Totals by outcome, the head of a validation report."""
    return results.agg(
        count_big().alias("total"),
        *[count_big(F.col("status").isin(*names)).alias(alias) for alias, names in
          (("passed", (PASS, "PASSED")), ("failed", (FAIL, "FAILED")), ("warnings", (WARN,)))],
    )


# --- attribution health -----------------------------------------------------------

def unmapped_keys(fct: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    rows = trailing(fct, "usage_date", days, as_of).filter(F.col("user_email").isNull())
    out = rows.groupBy("api_key_id", "platform").agg(count_big().alias("usage_count"))
    return out.orderBy(F.col("usage_count").desc(), "api_key_id", "platform")


def _by_user(rows: DataFrame, **flags: Column) -> DataFrame:
    """Rows per day, platform and user (``n``), and for how many of them each flag holds.

    A task that computes the fact should not also hold a table of its users:
    rows go to their users first, in as many partitions as the session has
    for shuffles, which AQE does not merge. Rows without a user are spread over
    sub-keys and so are several rows of the result.
    """
    parts, keys = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), ["usage_date", "platform", "user_email", SALT]
    salt = F.when(F.col("user_email").isNull(), F.pmod(F.xxhash64("api_key_id", "model"), F.lit(parts))).otherwise(0)
    placed = rows.select("usage_date", "platform", "user_email", salt.alias(SALT), *[c.alias(name) for name, c in flags.items()])
    return placed.repartition(parts, *keys).groupBy(*keys).agg(count_big().alias("n"), *[count_big(F.col(name)).alias(name) for name in flags])


def attribution_rate(fct: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    known = F.sum(F.when(F.col("user_email").isNotNull(), F.col("n")).otherwise(0))
    out = _by_user(trailing(fct, "usage_date", days, as_of)).groupBy("usage_date", "platform").agg(
        F.sum("n").alias("total_records"),
        F.count("user_email").alias("unique_users"),
        F.round(safe_divide(known, F.sum("n")), 6).alias("attribution_rate"),
    )
    return out.orderBy(F.col("usage_date").desc(), "platform")


def attribution_by_platform(fct: DataFrame) -> DataFrame:
    n, known = count_big(), F.count("user_email")
    return fct.groupBy("platform").agg(
        n.alias("total"), known.alias("attributed"), F.round(safe_divide(known, n), 6).alias("rate")
    )


_COUNTERS = ["input_tokens", "output_tokens", "loc_added", "loc_accepted"]


def usage_anomalies(fct: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    """Rows with a negative counter, or more than twice as many lines accepted as added."""
    rules = [F.col(c) < 0 for c in _COUNTERS] + [F.col("loc_accepted") > F.col("loc_added") * 2]
    rows = any_violation(trailing(fct, "usage_date", days, as_of), rules)
    # Sorted by every column: a day with very many rows still spreads over tasks.
    return rows.select("usage_date", "platform", "user_email", *_COUNTERS).orderBy(
        F.col("usage_date").desc(), "platform", "user_email", *_COUNTERS
    )


def anomaly_counts(fct: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    negative = (F.col("input_tokens") < 0) | (F.col("output_tokens") < 0)
    out = _by_user(trailing(fct, "usage_date", days, as_of), negative=negative).groupBy("usage_date", "platform").agg(
        F.sum("n").alias("record_count"),
        F.sum("negative").alias("negative_values"),
        F.count("user_email").alias("unique_users"),
    )
    return out.orderBy(F.col("usage_date").desc())


def cross_platform_presence(fct: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    rows = trailing(fct, "usage_date", days, as_of).filter(F.col("user_email").isNotNull())
    out = rows.groupBy("user_email", "platform").agg(count_big().alias("days_active"), _long("sessions", "total_sessions"))
    return out.orderBy("user_email", "platform")


def recent_tokens(fct: DataFrame, as_of: Day, days: int = 7) -> DataFrame:
    out = trailing(fct, "usage_date", days, as_of).groupBy("usage_date", "platform").agg(
        F.sum(F.col("input_tokens") + F.col("output_tokens")).cast("bigint").alias("total_tokens")
    )
    return out.orderBy(F.col("usage_date").desc(), "platform")


def incident_recent(incidents: DataFrame, as_of: Day, days: int = 30) -> DataFrame:
    since = F.date_sub(day(as_of), days).cast("timestamp")
    rows = incidents.filter(F.col("detection_time") >= since)
    return rows.orderBy(F.col("detection_time").desc(), "incident_id").select(
        "incident_id", "severity_level", "mttr_minutes", "root_cause_category", "resolution_time"
    )


# --- filter widgets ----------------------------------------------------------------

# Fixed value: up to this many values a filter is a list, beyond it a search box.
LIST_LIMIT = 100


def filter_values(df: DataFrame, col: str, limit: int | None = None) -> DataFrame:
    out = df.filter(F.col(col).isNotNull()).select(col).distinct().orderBy(col)
    return out if limit is None else out.limit(limit)


def filter_widget(df: DataFrame, col: str) -> DataFrame:
    """The column's cardinality and the widget it calls for."""
    n = F.countDistinct(col)
    name = col.lower()
    if "email" in name or "id" in name:
        widget = F.lit("search")
    elif "date" in name:
        widget = F.lit("date_range")
    else:
        widget = F.when(n > LIST_LIMIT, "search").otherwise("list")
    return df.agg(F.lit(col).alias("column_name"), n.alias("distinct_values"), widget.alias("widget"))


def preview(df: DataFrame, limit: int = 5) -> DataFrame:
    return df.limit(limit)
