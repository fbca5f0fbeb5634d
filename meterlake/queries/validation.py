"""Validation, coverage and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.functions.dates import date_spine
from meterlake.operators import joins as J
from meterlake.plans import validation as V
from meterlake.queries import Query
from meterlake.queries.attribution import _star
from meterlake.queries.views import (
    ALL_DAYS, AS_OF, END, EVENTS_AS_OF, EVENTS_END, EVENTS_START, START, big, dbl, sdiv,
)

RANGE = f"activity_date BETWEEN DATE '{START}' AND DATE '{END}'"
COST_RANGE = f"cost_date BETWEEN DATE '{START}' AND DATE '{END}'"
S = "SUM(amount_usd)"
FCT = f"fct WHERE usage_date >= DATE '{AS_OF}' - {ALL_DAYS}"


def _on(proxy, fn, *args, start=START, end=END, **kw):
    return lambda spark, d: fn(proxy(spark, d), *args, start, end, **kw)


def _spend(fn):
    return _on(P.spend_snapshots, fn, start=EVENTS_START, end=EVENTS_END)


def _logs(fn):
    return _on(P.app_usage_logs, fn, start=EVENTS_START, end=EVENTS_END)


def _fct(fn, *args):
    return lambda spark, d: fn(_star(spark, d), *args)


def _dollars(prefix: str = "") -> str:
    return ", ".join(
        f"{dbl(f'SUM({c})')} / 100 AS {prefix}{a}"
        for c, a in (("total_spend_cents", "total_cost_usd"), ("spend_cents", "actual_spend_usd"), ("included_spend_cents", "included_spend_usd"))
    )


def _sums(*cols: str) -> str:
    return ", ".join(f"{big(f'SUM({c})')} AS {c}" for c in cols)


def _profile(proxy, name, rules, sql_rules, view, col="activity_date", distinct=None, start=START, end=END):
    def run(spark, d):
        return V.quality_profile(proxy(spark, d), name, rules(), start, end, col, distinct)

    counts = ", ".join(f"COUNT(*) FILTER ({cond}) AS {k}" for k, cond in sql_rules.items())
    uniques = "".join(f", COUNT(DISTINCT {c}) AS {k}" for k, c in (distinct or {}).items())
    sql = f"""WITH q AS (SELECT '{name}' AS table_name, COUNT(*) AS total_records, {counts}{uniques} FROM {view}
WHERE {col} BETWEEN DATE '{start}' AND DATE '{end}') SELECT *, GREATEST({', '.join(sql_rules)}) > 0 AS any_issue FROM q"""
    return Query(run, sql)


# Rules are built when a query runs: a Column needs a session.
def _editor_rules():
    return {
        **V.null_rules("user_email", "user_id", "activity_date"),
        **V.future_rule("activity_date", "2001-06-30"),
        **V.negative_rules("total_lines_added", "total_rejects"),
    }


def _spend_rules():
    return {
        **V.null_rules("user_email", "snapshot_date", "billing_cycle_start"),
        **V.future_rule("snapshot_date", EVENTS_AS_OF),
        **V.negative_rules("total_spend_cents", "spend_cents", "included_spend_cents"),
    }


def _log_rules():
    return {
        **V.null_rules("user_email", "event_type", "activity_date", "client_platform", "event_id"),
        **V.future_rule("activity_date", "2024-01-28"),
    }


EDITOR_SQL = {
    "null_user_email": "user_email IS NULL", "null_user_id": "user_id IS NULL", "null_activity_date": "activity_date IS NULL",
    "future_dates": "activity_date > DATE '2001-06-30'",
    "negative_total_lines_added": "total_lines_added < 0", "negative_total_rejects": "total_rejects < 0",
}
SPEND_SQL = {
    "null_user_email": "user_email IS NULL", "null_snapshot_date": "snapshot_date IS NULL",
    "null_billing_cycle_start": "billing_cycle_start IS NULL", "future_dates": f"snapshot_date > DATE '{EVENTS_AS_OF}'",
    "negative_total_spend_cents": "total_spend_cents < 0", "negative_spend_cents": "spend_cents < 0",
    "negative_included_spend_cents": "included_spend_cents < 0",
}
LOG_SQL = {
    "null_user_email": "user_email IS NULL", "null_event_type": "event_type IS NULL", "null_activity_date": "activity_date IS NULL",
    "null_client_platform": "client_platform IS NULL", "null_event_id": "event_id IS NULL", "future_dates": "activity_date > DATE '2024-01-28'",
}


def _quality_report(s, d):
    editor = V.quality_profile(P.cursor_usage_stats(s, d), "editor", _editor_rules(), START, END)
    spend = V.quality_profile(P.spend_snapshots(s, d), "spend", _spend_rules(), EVENTS_START, EVENTS_END, "snapshot_date")
    return V.quality_long(editor).unionByName(V.quality_long(spend))


def _long_sql(view, name, rules, col, start, end):
    cases = " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{k}' AS \"check\", COUNT(*) FILTER ({c}) AS issues, COUNT(*) AS total_records FROM {view}"
        f" WHERE {col} BETWEEN DATE '{start}' AND DATE '{end}'" for k, c in rules.items()
    )
    return cases


_QUALITY = f"""WITH u AS ({_long_sql('editor', 'editor', EDITOR_SQL, 'activity_date', START, END)}
UNION ALL {_long_sql('spend', 'spend', SPEND_SQL, 'snapshot_date', EVENTS_START, EVENTS_END)})
SELECT *, CASE WHEN issues > 0 THEN 'FAIL' ELSE 'PASS' END AS status FROM u"""


def _tables(s, d):
    return [
        ("claude_costs", P.claude_costs(s, d), "activity_date"),
        ("claude_code_usage", P.claude_code_usage_stats(s, d), "activity_date"),
        ("app_usage", P.app_usage_logs(s, d), "activity_date"),
    ]


COVER_START, COVER_END = "1994-12-20", "2024-01-31"
_COVER = f"""
WITH x AS (SELECT CAST(s AS DATE) AS date, CAST(s AS DATE) IN (SELECT activity_date FROM costs) AS claude_costs,
  CAST(s AS DATE) IN (SELECT activity_date FROM ide) AS claude_code_usage, CAST(s AS DATE) IN (SELECT activity_date FROM logs) AS app_usage
FROM generate_series(DATE '{COVER_START}', DATE '{COVER_END}', INTERVAL 1 DAY) g(s))"""
_COVER_TEXT = "SELECT date, " + ", ".join(
    f"CASE WHEN {n} THEN 'Present' ELSE 'MISSING' END AS {n}" for n in ("claude_costs", "claude_code_usage", "app_usage")
) + " FROM x"


def _missing(s, d):
    return V.missing_dates(P.claude_costs(s, d), "activity_date", COVER_START, END)


def _gap_having(s, d):
    return J.gap_having(date_spine(s, COVER_START, END), P.claude_costs(s, d), "date", "activity_date")


_SPINE_GAPS = f"""FROM generate_series(DATE '{COVER_START}', DATE '{END}', INTERVAL 1 DAY) g(s)
WHERE CAST(s AS DATE) NOT IN (SELECT activity_date FROM costs)"""


def _inventory(s, d):
    return V.table_inventory([
        ("claude_costs", P.claude_costs(s, d), "activity_date", "amount_usd"),
        ("claude_usage_keys", P.usage_keys(s, d), "activity_date", None),
        ("claude_code_productivity", P.claude_code_productivity(s, d), "activity_date", None),
    ])


_INVENTORY = " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, COUNT(*) AS total_records, COUNT(DISTINCT activity_date) AS unique_dates,
  MIN(activity_date) AS earliest_date, MAX(activity_date) AS latest_date, {dbl(cost)} AS total_cost FROM {view}"""
    for name, view, cost in (("claude_costs", "costs", S), ("claude_usage_keys", "usage_keys", "NULL"), ("claude_code_productivity", "ide", "NULL"))
)


def _freshness(s, d):
    out = V.freshness(P.claude_costs(s, d))
    return out.withColumn("last_run", F.date_format("last_run", "yyyy-MM-dd HH:mm:ss"))


def _checkpoint(s, d):
    return V.checkpoint_report(P.claude_costs(s, d), P.claude_code_productivity(s, d), 30000000.0, 10.0, START, END)


_CHECKPOINT = f"""
SELECT CAST(1 AS BIGINT) AS checkpoint, 'Cost Accuracy' AS test, {dbl(S)} AS result,
  CASE WHEN ABS({S} - 30000000) <= 10 THEN 'PASS' ELSE 'FAIL' END AS status FROM costs WHERE {RANGE}
UNION ALL SELECT 2, 'No Duplicates', {dbl('COUNT(*)')}, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END
  FROM (SELECT 1 FROM costs GROUP BY activity_date, workspace_id, model, token_type HAVING COUNT(*) > 1) g
UNION ALL SELECT 3, 'Data Completeness', {dbl('COUNT(DISTINCT activity_date)')}, CASE WHEN COUNT(DISTINCT activity_date) >= 250 THEN 'PASS' ELSE 'FAIL' END FROM costs
UNION ALL SELECT 4, 'No Cost Columns in Productivity', {dbl('0')}, 'PASS'
UNION ALL SELECT 5, 'Amounts in Dollars (not cents)', {dbl('MAX(amount_usd)')}, CASE WHEN MAX(amount_usd) < 100 THEN 'PASS' ELSE 'FAIL' END FROM costs"""


def _actual_expected(s, d):
    """Per brand: billed price and units against list price less discount, and units."""
    rows = P.load(s, d, "lineitem").join(P.load(s, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    known = F.col("p_brand") != "Brand#1"
    keep = F.lit(1).cast("decimal(3,2)") - F.col("l_discount").cast("decimal(3,2)") * F.lit("0.2").cast("decimal(2,1)")
    actual = rows.groupBy(F.col("p_brand").alias("model")).agg(F.sum(price).alias("cost"), F.sum("l_quantity").alias("tokens"))
    expected = rows.filter(known).groupBy(F.col("p_brand").alias("model")).agg(
        F.sum((price * keep).cast("decimal(18,4)")).alias("cost"), F.sum("l_quantity").alias("tokens")
    )
    return actual, expected


_TOLERANCE_CTE = f"""
r AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price FROM lineitem JOIN part ON l_partkey = p_partkey),
a AS (SELECT p_brand AS model, {dbl('SUM(price)')} AS actual_cost, {dbl('SUM(l_quantity)')} AS actual_tokens FROM r GROUP BY 1),
e AS (SELECT p_brand AS model, {dbl('SUM(CAST(price * (1 - CAST(l_discount AS DECIMAL(3,2)) * 0.2) AS DECIMAL(18,4)))')} AS expected_cost,
  {dbl('SUM(l_quantity)')} AS expected_tokens FROM r WHERE p_brand <> 'Brand#1' GROUP BY 1),
v AS (SELECT *, ABS(actual_cost - expected_cost) / NULLIF(expected_cost, 0) * 100 AS vc,
  ABS(actual_tokens - expected_tokens) / NULLIF(expected_tokens, 0) * 100 AS vt FROM a LEFT JOIN e USING (model)),
t AS (SELECT model, actual_cost, expected_cost, ROUND(vc, 2) AS cost_variance_percent, actual_tokens, expected_tokens,
  ROUND(vt, 2) AS tokens_variance_percent, CASE WHEN expected_cost IS NULL THEN 'WARNING' WHEN vc <= 1 AND vt <= 2 THEN 'PASSED' ELSE 'FAILED' END AS status FROM v)"""


def _incidents(s, d):
    out = V.incident_recent(P.incidents(s, d), EVENTS_AS_OF, 30)
    return out.withColumn("resolution_time", F.date_format("resolution_time", "yyyy-MM-dd HH:mm:ss"))


def _widgets(s, d):
    logs = P.app_usage_logs(s, d)
    out = None
    for c in ("event_type", "project_uuid", "conversation_uuid", "client_platform", "user_email", "activity_date"):
        one = V.filter_widget(logs, c)
        out = one if out is None else out.unionByName(one)
    return out


_WIDGETS = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, COUNT(DISTINCT {c}) AS distinct_values, {w} AS widget FROM logs"
    for c, w in (
        ("event_type", "CASE WHEN COUNT(DISTINCT event_type) > 100 THEN 'search' ELSE 'list' END"),
        ("project_uuid", "'search'"), ("conversation_uuid", "'search'"),
        ("client_platform", "CASE WHEN COUNT(DISTINCT client_platform) > 100 THEN 'search' ELSE 'list' END"),
        ("user_email", "'search'"), ("activity_date", "'date_range'"),
    )
)

_EDITOR_SUMS = [
    "total_lines_added", "total_lines_deleted", "accepted_lines_added", "accepted_lines_deleted", "total_applies",
    "total_accepts", "total_rejects", "total_tabs_shown", "total_tabs_accepted", "composer_requests", "chat_requests", "agent_requests",
]
_TOOL = lambda o: big(f"SUM(edit_tool_{o} + multi_edit_tool_{o} + write_tool_{o} + notebook_edit_tool_{o})")
_ALL_TOKENS = " + ".join(
    f"SUM({c})" for c in ("uncached_input_tokens", "output_tokens", "cache_read_input_tokens", "cache_creation_1h_tokens", "cache_creation_5m_tokens")
)


def _event_view(s, d):
    """A productivity view: one row per order activity, with its sessions as events."""
    return P.claude_code_usage_stats(s, d).select("activity_date", "user_email", F.col("num_sessions").alias("total_events"))


EVENT_SUMMARY = """SELECT 'Claude AI Usage Summary' AS metric_name, COUNT(*) AS total_events, COUNT(DISTINCT user_email) AS unique_users,
  COUNT(DISTINCT event_type) AS unique_event_types, COUNT(DISTINCT conversation_uuid) AS unique_conversations,
  COUNT(DISTINCT project_uuid) AS unique_projects, MIN(activity_date) AS earliest_date, MAX(activity_date) AS latest_date FROM logs"""

EVENTS_BY_TYPE = """SELECT event_type, COUNT(*) AS event_count, COUNT(DISTINCT user_email) AS unique_users,
  COUNT(DISTINCT conversation_uuid) AS unique_conversations, MIN(activity_date) AS first_occurrence,
  MAX(activity_date) AS last_occurrence FROM logs GROUP BY 1"""

QUERIES = {
    "spend_summary": Query(
        _spend(V.spend_summary),
        f"""SELECT 'Cursor Total Cost' AS metric_name, {_dollars()}, COUNT(DISTINCT user_email) AS unique_users,
  MIN(snapshot_date) AS earliest_date, MAX(snapshot_date) AS latest_date, COUNT(*) AS total_records FROM spend""",
    ),
    "spend_by_user": Query(
        _spend(V.spend_by_user),
        f"""SELECT user_email, user_name, user_role, {_dollars()}, {big('SUM(fast_premium_requests)')} AS total_fast_premium_requests,
  MAX(hard_limit_override_dollars) AS hard_limit_override, COUNT(DISTINCT snapshot_date) AS days_with_data FROM spend GROUP BY 1, 2, 3""",
    ),
    "spend_daily": Query(
        _spend(V.spend_daily),
        f"""SELECT snapshot_date, {_dollars('daily_')}, COUNT(DISTINCT user_email) AS daily_active_users, COUNT(*) AS daily_records
FROM spend GROUP BY 1""",
    ),
    "monthly_spend": Query(
        _spend(V.monthly_spend),
        f"""SELECT strftime(snapshot_date, '%B %Y') AS month, COUNT(DISTINCT user_email) AS users,
  {dbl('SUM(total_spend_cents)')} / 100 AS total_dollars FROM spend GROUP BY 1""",
    ),
    "editor_activity_summary": Query(
        _on(P.cursor_usage_stats, V.editor_activity_summary),
        f"""SELECT 'Cursor Usage Summary' AS metric_name, COUNT(DISTINCT user_email) AS total_unique_users,
  COUNT(*) FILTER (is_active) AS active_users, {_sums(*_EDITOR_SUMS)} FROM editor WHERE {RANGE}""",
    ),
    "editor_top_users": Query(
        _on(P.cursor_usage_stats, V.editor_top_users),
        f"""SELECT user_email, COUNT(DISTINCT activity_date) AS active_days, COUNT(*) FILTER (is_active) AS days_marked_active,
  {big('SUM(total_lines_added)')} AS lines_added, {big('SUM(total_lines_deleted)')} AS lines_deleted, {_sums('total_accepts', 'total_rejects')},
  {big('SUM(composer_requests + chat_requests + agent_requests)')} AS total_requests,
  STRING_AGG(DISTINCT most_used_model, ',' ORDER BY most_used_model) AS models_used
FROM editor WHERE {RANGE} GROUP BY 1 ORDER BY total_requests DESC NULLS LAST, user_email NULLS LAST LIMIT 20""",
    ),
    "quality_editor_usage": _profile(P.cursor_usage_stats, "Cursor Usage Stats Quality", _editor_rules, EDITOR_SQL, "editor"),
    "quality_spend": _profile(
        P.spend_snapshots, "Cursor Spending Quality", _spend_rules, SPEND_SQL, "spend", "snapshot_date", start=EVENTS_START, end=EVENTS_END
    ),
    "quality_app_logs": _profile(
        P.app_usage_logs, "Claude AI Usage Stats Quality", _log_rules, LOG_SQL, "logs",
        distinct={"unique_event_ids": "event_id"}, start=EVENTS_START, end=EVENTS_END,
    ),
    "quality_report": Query(_quality_report, _QUALITY),
    "event_summary": Query(
        _logs(V.event_summary),
        EVENT_SUMMARY,
    ),
    "events_by_type": Query(
        _logs(V.events_by_type),
        EVENTS_BY_TYPE,
    ),
    "top_event_users": Query(
        _logs(V.top_event_users),
        """SELECT user_email, user_name, COUNT(*) AS total_events, COUNT(DISTINCT event_type) AS unique_event_types,
  COUNT(DISTINCT conversation_uuid) AS conversations, COUNT(DISTINCT activity_date) AS active_days,
  COUNT(DISTINCT client_platform) AS platforms_used FROM logs GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 20""",
    ),
    "load_summary": Query(
        _logs(V.load_summary),
        """SELECT activity_date, COUNT(*) AS records, COUNT(DISTINCT user_email) AS users, COUNT(DISTINCT event_type) AS event_types
FROM logs GROUP BY 1""",
    ),
    "cost_summary": Query(
        _on(P.claude_costs, V.cost_summary),
        f"""SELECT 'Claude Cost Summary' AS metric_name, {dbl(S)} AS total_cost_usd, COUNT(DISTINCT organization_id) AS unique_organizations,
  COUNT(DISTINCT workspace_id) AS unique_workspaces, COUNT(DISTINCT model) AS unique_models, COUNT(DISTINCT cost_type) AS unique_cost_types,
  MIN(activity_date) AS earliest_date, MAX(activity_date) AS latest_date FROM costs WHERE {RANGE}""",
    ),
    "cost_by_model": Query(
        _on(P.claude_costs, V.cost_by_model),
        f"""SELECT model, {dbl(S)} AS total_cost_usd, COUNT(*) AS record_count, COUNT(DISTINCT workspace_id) AS unique_workspaces,
  STRING_AGG(DISTINCT cost_type, ',' ORDER BY cost_type) AS cost_types FROM costs WHERE {RANGE} AND model IS NOT NULL GROUP BY 1""",
    ),
    "cost_by_type": Query(
        _on(P.claude_costs, V.cost_by_type),
        f"""SELECT cost_type, token_type, {dbl(S)} AS total_cost_usd, COUNT(*) AS record_count, COUNT(DISTINCT model) AS models_involved
FROM costs WHERE {RANGE} GROUP BY 1, 2""",
    ),
    "cost_by_day": Query(
        _on(P.claude_costs, V.cost_by_day),
        f"SELECT activity_date, {dbl(S)} AS daily_cost, COUNT(*) AS records FROM costs WHERE {RANGE} GROUP BY 1",
    ),
    "token_summary": Query(
        _on(P.usage_keys, V.token_summary),
        f"""SELECT 'Claude Usage Report' AS metric_name, {big('SUM(uncached_input_tokens)')} AS total_uncached_input_tokens,
  {big('SUM(output_tokens)')} AS total_output_tokens, {big('SUM(cache_read_input_tokens)')} AS total_cache_read_tokens,
  {big('SUM(cache_creation_1h_tokens)')} AS total_cache_creation_1h_tokens, {big('SUM(cache_creation_5m_tokens)')} AS total_cache_creation_5m_tokens,
  {big('SUM(web_search_requests)')} AS total_web_search_requests, COUNT(DISTINCT organization_id) AS unique_organizations,
  COUNT(DISTINCT workspace_id) AS unique_workspaces, COUNT(DISTINCT model) AS unique_models FROM usage_keys WHERE {RANGE}""",
    ),
    "token_by_model": Query(
        _on(P.usage_keys, V.token_by_model),
        f"""SELECT model, {_sums('uncached_input_tokens', 'output_tokens')}, {big('SUM(cache_read_input_tokens)')} AS cache_read_tokens,
  {big('SUM(cache_creation_1h_tokens + cache_creation_5m_tokens)')} AS cache_creation_tokens,
  ROUND({sdiv(_ALL_TOKENS, '1000000')}, 2) AS total_tokens_millions, COUNT(DISTINCT workspace_id) AS unique_workspaces
FROM usage_keys WHERE {RANGE} AND model IS NOT NULL GROUP BY 1""",
    ),
    "key_coverage": Query(
        _on(P.usage_keys, V.key_coverage),
        f"""SELECT COUNT(DISTINCT api_key_id) AS unique_api_keys, COUNT(*) AS total_usage_records,
  {big('SUM(uncached_input_tokens + output_tokens + cache_read_input_tokens)')} AS total_tokens FROM usage_keys WHERE {RANGE}""",
    ),
    "ide_summary": Query(
        _on(P.claude_code_usage_stats, V.ide_summary),
        f"""SELECT 'Claude Code Usage' AS metric_name, COUNT(DISTINCT user_email) AS unique_users,
  COUNT(DISTINCT organization_id) AS unique_organizations, {big('SUM(num_sessions)')} AS total_sessions,
  {big('SUM(lines_added)')} AS total_lines_added, {big('SUM(lines_removed)')} AS total_lines_removed,
  {big('SUM(commits_by_claude_code)')} AS total_commits, {big('SUM(pull_requests_by_claude_code)')} AS total_pull_requests,
  {_TOOL('accepted')} AS total_tool_accepts, {_TOOL('rejected')} AS total_tool_rejects,
  {big('SUM(total_input_tokens + total_output_tokens)')} AS total_tokens, {dbl('SUM(total_estimated_cost_usd)')} AS total_estimated_cost_usd
FROM ide WHERE {RANGE}""",
    ),
    "ide_top_users": Query(
        _on(P.claude_code_usage_stats, V.ide_top_users),
        f"""SELECT user_email, terminal_type, {big('SUM(num_sessions)')} AS sessions, {_sums('lines_added', 'lines_removed')},
  {big('SUM(commits_by_claude_code)')} AS commits, {big('SUM(total_input_tokens + total_output_tokens)')} AS total_tokens,
  {dbl('SUM(total_estimated_cost_usd)')} AS estimated_cost_usd, COUNT(DISTINCT activity_date) AS active_days
FROM ide WHERE {RANGE} GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS LAST, 2 LIMIT 20""",
    ),
    "ide_coverage": Query(
        _on(P.claude_code_usage_stats, V.ide_coverage),
        f"""SELECT COUNT(DISTINCT user_email) AS unique_users, COUNT(DISTINCT terminal_type) AS unique_terminals,
  {big('SUM(lines_added)')} AS total_lines_added, {big('SUM(commits_by_claude_code)')} AS total_commits FROM ide WHERE {RANGE}""",
    ),
    "provider_costs": Query(
        _on(P.combined_daily_costs, V.provider_costs),
        f"""SELECT provider, {dbl(S)} AS total_cost_usd, COUNT(DISTINCT user_email) AS unique_users, COUNT(DISTINCT cost_date) AS days_with_data,
  MIN(cost_date) AS earliest_date, MAX(cost_date) AS latest_date FROM combined WHERE {COST_RANGE} GROUP BY 1""",
    ),
    "daily_provider_costs": Query(
        _on(P.combined_daily_costs, V.daily_provider_costs),
        f"""SELECT cost_date, provider, {dbl(S)} AS daily_cost_usd, COUNT(DISTINCT user_email) AS daily_users
FROM combined WHERE {COST_RANGE} GROUP BY 1, 2""",
    ),
    "daily_provider_user_costs": Query(
        _on(P.combined_daily_costs, V.daily_provider_costs, by_user=True),
        f"SELECT cost_date, provider, user_email, {dbl(S)} AS daily_cost_usd FROM combined WHERE {COST_RANGE} GROUP BY 1, 2, 3",
    ),
    "date_coverage": Query(lambda s, d: V.date_coverage(_tables(s, d), COVER_START, COVER_END), f"{_COVER} {_COVER_TEXT}"),
    "date_coverage_flags": Query(
        lambda s, d: V.date_coverage(_tables(s, d), COVER_START, COVER_END, as_boolean=True), f"{_COVER} SELECT * FROM x"
    ),
    "date_coverage_gaps": Query(
        lambda s, d: V.date_coverage(_tables(s, d), COVER_START, END, only_gaps=True),
        _COVER.replace(COVER_END, END)
        + f" {_COVER_TEXT} WHERE NOT (claude_costs AND claude_code_usage AND app_usage)",
    ),
    "coverage_summary": Query(
        lambda s, d: V.coverage_summary(_tables(s, d), COVER_START, COVER_END),
        _COVER
        + " SELECT COUNT(*) AS total_days_expected, "
        + ", ".join(f"COUNT(*) FILTER ({n}) AS {n}_days_present" for n in ("claude_costs", "claude_code_usage", "app_usage"))
        + ", CASE WHEN BOOL_AND(claude_costs AND claude_code_usage AND app_usage) THEN 'PASS' ELSE 'WARNING' END AS status FROM x",
    ),
    "missing_dates": Query(_missing, f"SELECT CAST(s AS DATE) AS missing_date {_SPINE_GAPS}"),
    "missing_dates_having": Query(_gap_having, f"SELECT CAST(s AS DATE) AS date, {big('0')} AS records_count {_SPINE_GAPS}"),
    "dedup_compare": Query(
        _on(P.claude_costs, V.dedup_compare),
        " UNION ALL ".join(
            f"SELECT '{name}' AS scenario, {dbl(S)} AS total_cost, COUNT(*) AS record_count FROM costs WHERE {RANGE}{cond}"
            for name, cond in (("BEFORE (with dupes)", ""), ("AFTER (workspace only)", " AND workspace_id IS NOT NULL"),
                               ("AFTER (org only)", " AND workspace_id IS NULL"))
        ),
    ),
    "dedup_view": Query(
        lambda s, d: V.cost_by_day(V.dedup_view(P.claude_costs(s, d))),
        f"SELECT activity_date, {dbl(S)} AS daily_cost, COUNT(*) AS records FROM costs WHERE workspace_id IS NOT NULL GROUP BY 1",
    ),
    "duplicate_groups": Query(
        lambda s, d: V.duplicate_groups(P.claude_costs(s, d)),
        "SELECT activity_date, workspace_id, model, token_type, COUNT(*) AS cnt FROM costs GROUP BY 1, 2, 3, 4 HAVING COUNT(*) > 1",
    ),
    "duplicate_check": Query(
        lambda s, d: V.duplicate_check(P.claude_costs(s, d)),
        """SELECT 'Duplicate Check' AS test, COUNT(*) AS duplicate_groups, CASE WHEN COUNT(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS status
FROM (SELECT 1 FROM costs GROUP BY activity_date, workspace_id, model, token_type HAVING COUNT(*) > 1) g""",
    ),
    "cost_ceiling": Query(
        lambda s, d: V.cost_ceiling(P.claude_costs(s, d)),
        f"""SELECT activity_date, {dbl(S)} AS total_cost, {dbl('MAX(amount_usd)')} AS max_single_cost,
  CASE WHEN {S} > 1000 THEN 'FAIL' ELSE 'PASS' END AS day_status,
  CASE WHEN MAX(amount_usd) > 1000 THEN 'FAIL' WHEN MAX(amount_usd) >= 100 THEN 'WARNING' ELSE 'PASS' END AS row_status
FROM costs GROUP BY 1""",
    ),
    "high_costs": Query(
        lambda s, d: V.high_costs(P.claude_costs(s, d)),
        f"""SELECT activity_date, workspace_id, model, token_type, {dbl('amount_usd')} AS amount_usd FROM costs WHERE amount_usd > 100
ORDER BY costs.amount_usd DESC, 1, 2 NULLS LAST, 3, 4 LIMIT 20""",
    ),
    "checkpoint_report": Query(_checkpoint, _CHECKPOINT),
    "cost_accuracy": Query(
        lambda s, d: V.cost_accuracy(P.claude_costs(s, d), 286.74, 10.0, START, END),
        f"""SELECT {dbl(S)} AS total_cost, {dbl('286.74')} AS expected_total, {dbl(f'ABS({S} - 286.74)')} AS difference,
  CASE WHEN ABS({S} - 286.74) <= 10 THEN 'PASS' ELSE 'FAIL' END AS status FROM costs WHERE {RANGE}""",
    ),
    "tolerance_compare": Query(
        lambda s, d: V.tolerance_compare(*_actual_expected(s, d), "model"), f"WITH {_TOLERANCE_CTE} SELECT * FROM t"
    ),
    "validation_report": Query(
        lambda s, d: V.status_counts(V.tolerance_compare(*_actual_expected(s, d), "model")),
        f"""WITH {_TOLERANCE_CTE} SELECT COUNT(*) AS total, COUNT(*) FILTER (status = 'PASSED') AS passed,
  COUNT(*) FILTER (status = 'FAILED') AS failed, COUNT(*) FILTER (status = 'WARNING') AS warnings FROM t""",
    ),
    "table_inventory": Query(_inventory, _INVENTORY),
    "freshness": Query(
        _freshness,
        f"""SELECT MAX(activity_date) AS latest_date, strftime(MAX(ingestion_timestamp), '%Y-%m-%d %H:%M:%S') AS last_run,
  COUNT(DISTINCT activity_date) AS total_days, {big("date_diff('day', MIN(activity_date), MAX(activity_date))")} AS days_covered,
  CASE WHEN COUNT(DISTINCT activity_date) > 7 THEN 'PASS' ELSE 'FAIL' END AS status FROM costs""",
    ),
    "hours_since_update": Query(
        lambda s, d: V.hours_since_update(P.app_usage_logs(s, d), "activity_timestamp", F.lit("2024-02-01 12:00:00").cast("timestamp_ntz")),
        "SELECT date_sub('hour', MAX(activity_timestamp), TIMESTAMP '2024-02-01 12:00:00') AS hours_since_update FROM logs",
    ),
    "unmapped_keys": Query(
        _fct(V.unmapped_keys, AS_OF, ALL_DAYS),
        f"SELECT api_key_id, platform, COUNT(*) AS usage_count FROM {FCT} AND user_email IS NULL GROUP BY 1, 2",
    ),
    "attribution_rate": Query(
        _fct(V.attribution_rate, AS_OF, ALL_DAYS),
        f"""SELECT usage_date, platform, COUNT(*) AS total_records, COUNT(DISTINCT user_email) AS unique_users,
  ROUND(AVG(CASE WHEN user_email IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END), 6) AS attribution_rate FROM {FCT} GROUP BY 1, 2""",
    ),
    "attribution_by_platform": Query(
        _fct(V.attribution_by_platform),
        f"""SELECT platform, COUNT(*) AS total, COUNT(user_email) AS attributed,
  ROUND({sdiv('COUNT(user_email)', 'COUNT(*)')}, 6) AS rate FROM fct GROUP BY 1""",
    ),
    "usage_anomalies": Query(
        _fct(V.usage_anomalies, AS_OF, ALL_DAYS),
        f"""SELECT usage_date, platform, user_email, input_tokens, output_tokens, loc_added, loc_accepted FROM {FCT}
  AND (input_tokens < 0 OR output_tokens < 0 OR loc_added < 0 OR loc_accepted < 0 OR loc_accepted > loc_added * 2)""",
    ),
    "anomaly_counts": Query(
        _fct(V.anomaly_counts, AS_OF, ALL_DAYS),
        f"""SELECT usage_date, platform, COUNT(*) AS record_count, COUNT(*) FILTER (input_tokens < 0 OR output_tokens < 0) AS negative_values,
  COUNT(DISTINCT user_email) AS unique_users FROM {FCT} GROUP BY 1, 2""",
    ),
    "cross_platform_presence": Query(
        _fct(V.cross_platform_presence, AS_OF, ALL_DAYS),
        f"""SELECT user_email, platform, COUNT(*) AS days_active, {big('SUM(sessions)')} AS total_sessions FROM {FCT}
  AND user_email IS NOT NULL GROUP BY 1, 2""",
    ),
    "recent_tokens": Query(
        _fct(V.recent_tokens, AS_OF, ALL_DAYS),
        f"SELECT usage_date, platform, {big('SUM(input_tokens + output_tokens)')} AS total_tokens FROM {FCT} GROUP BY 1, 2",
    ),
    "incident_recent": Query(
        _incidents,
        """SELECT incident_id, severity_level, mttr_minutes, root_cause_category,
  strftime(resolution_time, '%Y-%m-%d %H:%M:%S') AS resolution_time FROM incidents""",
    ),
    "filter_values": Query(
        lambda s, d: V.filter_values(P.app_usage_logs(s, d), "project_uuid"),
        "SELECT DISTINCT project_uuid FROM logs WHERE project_uuid IS NOT NULL",
    ),
    "filter_widgets": Query(_widgets, _WIDGETS),
    "engineering_activity": Query(
        lambda s, d: V.engineering_activity(_event_view(s, d), START, END),
        f"""SELECT activity_date, COUNT(DISTINCT user_email) AS active_users, {big('SUM(num_sessions)')} AS total_events
FROM ide WHERE {RANGE} GROUP BY 1""",
    ),
}
