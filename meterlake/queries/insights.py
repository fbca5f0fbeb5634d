"""Finance, productivity and quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.plans import insights as I
from meterlake.queries import Query
from meterlake.queries.views import big, dbl, month, pct, sdiv, usd, week

S = "SUM(amount_usd)"
M = month("cost_date")
PROVIDERS = ("claude_api", "claude_code", "cursor")


def _combined(fn, **kw):
    return lambda s, d: fn(P.combined_daily_costs(s, d), **kw)


_TREND = "CASE WHEN g IS NULL THEN NULL WHEN g < 20 THEN 'green' WHEN g <= 50 THEN 'yellow' ELSE 'red' END"


def _prev(keys: str = "") -> str:
    """Months with the calendar month before."""
    k = f", {keys}" if keys else ""
    using = f"USING (cost_month{k})"
    return f"""m AS (SELECT {M} AS cost_month{k}, {S} AS cost FROM combined GROUP BY ALL),
p AS (SELECT CAST(cost_month + INTERVAL 1 MONTH AS DATE) AS cost_month{k}, cost AS previous FROM m),
j AS (SELECT * FROM m LEFT JOIN p {using})"""


def _productivity(grain: str, period: str) -> Query:
    # Half-up rounding of the exact fraction, in integers: a DOUBLE may sit just below a tie.
    a, t = "SUM(accepted_lines_added)", "SUM(total_lines_added)"
    rate = f"CASE WHEN {t} <> 0 THEN CAST((20000 * {a} + {t}) // (2 * {t}) AS DOUBLE) / 10000 END"
    sql = f"""
WITH r AS (SELECT {period} AS period_start, user_email, {big('SUM(total_lines_added)')} AS lines_added,
  {big('SUM(accepted_lines_added)')} AS lines_accepted, COUNT(DISTINCT activity_date) AS active_days, {rate} AS acceptance_rate, {sdiv(a, t)} AS exact FROM editor GROUP BY 1, 2),
k AS (SELECT *, PERCENT_RANK() OVER (PARTITION BY period_start ORDER BY exact) AS p FROM r)
SELECT period_start, user_email, lines_added, lines_accepted, active_days, acceptance_rate,
  CASE WHEN exact * 100 > 80 THEN 'Excellent' WHEN exact * 100 > 60 THEN 'Good'
    WHEN exact * 100 > 40 THEN 'Average' ELSE 'Needs attention' END AS performance_band,
  ROUND(p, 6) AS percentile, CASE WHEN p >= 0.75 THEN 'Top 25%' WHEN p >= 0.5 THEN 'Upper half'
    WHEN p >= 0.25 THEN 'Lower half' ELSE 'Bottom 25%' END AS tier FROM k"""
    return Query(lambda s, d: I.productivity_metrics(P.cursor_usage_stats(s, d), grain), sql)


_USERS = f"""c AS (SELECT user_email, {S} AS cost FROM combined WHERE user_email IS NOT NULL GROUP BY 1),
u AS (SELECT user_email, {big('SUM(accepted_lines_added)')} AS lines FROM editor WHERE user_email IS NOT NULL GROUP BY 1),
x AS (SELECT user_email, cost, {big('COALESCE(lines, 0)')} AS lines_accepted FROM c LEFT JOIN u USING (user_email))"""
_ROI = """CASE WHEN cpl IS NULL THEN NULL WHEN cpl < 0.15 THEN 'Excellent' WHEN cpl < 0.30 THEN 'Good'
  WHEN cpl < 0.50 THEN 'Acceptable' ELSE 'Poor' END AS efficiency_band"""
_RANK = "CASE WHEN cpl IS NOT NULL THEN DENSE_RANK() OVER (ORDER BY cpl NULLS LAST) END"


def _invoices(s, d):
    """Invoices: the order book's month totals, scaled to the cost of one order line in four."""
    orders = P.load(s, d, "orders")
    return orders.groupBy(F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("cost_month")).agg(
        F.sum((F.col("o_totalprice").cast("decimal(18,2)") * F.lit("0.00016").cast("decimal(6,5)")).cast("decimal(18,6)")).alias("cost")
    )


def _quality(s, d):
    return I.quality_score(
        P.app_usage_logs(s, d),
        required=["user_email", "event_type", "client_platform", "conversation_uuid"],
        accurate=[F.col("activity_date") <= F.lit("2024-01-29").cast("date")],
        valid=[F.col("user_email").rlike(I.EMAIL), F.col("client_platform").isin("desktop_app", "web_claude_ai", "ios", "android")],
        key=["user_email", "activity_date", "event_type", "client_platform"],
        updated="activity_timestamp",
        as_of="2024-01-31 00:00:00",
    )


_QUALITY = f"""
WITH g AS (SELECT user_email, activity_date, event_type, client_platform, COUNT(*) AS n,
  SUM(1 + 1 + CASE WHEN client_platform IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN conversation_uuid IS NOT NULL THEN 1 ELSE 0 END) AS filled,
  COUNT(*) FILTER (activity_date <= DATE '2024-01-29') AS acc, COUNT(*) FILTER (client_platform IS NOT NULL) AS val,
  MAX(activity_timestamp) AS upd FROM logs GROUP BY 1, 2, 3, 4),
s AS (SELECT {big('SUM(n)')} AS total_records, ROUND({sdiv('SUM(filled) * 100', 'SUM(n) * 4')}, 4) AS completeness,
  ROUND({sdiv('SUM(acc) * 100', 'SUM(n)')}, 4) AS accuracy, ROUND({sdiv('SUM(val) * 100', 'SUM(n)')}, 4) AS validity,
  ROUND({sdiv('SUM(CASE WHEN n = 1 THEN 1 ELSE 0 END) * 100', 'SUM(n)')}, 4) AS consistency,
  CASE WHEN date_sub('second', MAX(upd), TIMESTAMP '2024-01-31 00:00:00') <= 90000 THEN {dbl('100')} ELSE {dbl('0')} END AS freshness FROM g)
SELECT *, ROUND((completeness + accuracy + validity + consistency + freshness) / 5, 2) AS quality_score,
  completeness >= 95 AS completeness_ok, accuracy >= 98 AS accuracy_ok, validity >= 99 AS validity_ok FROM s"""

def _checked(s, d):
    logs = P.app_usage_logs(s, d).select("event_id", "user_email", "event_type", "client_platform")
    known = P.dim_api_keys(s, d).select(F.lower("mapped_user_email").alias("user_email"))
    rules = {
        **I.required("client_platform"),
        **I.not_in("event_type", ["conversation_created", "file_uploaded", "project_created", "project_document_created"]),
        **I.bad_email("user_email"),
        **I.negative("event_id"),
    }
    return I.validate_rows(logs, rules, {"user_email": (known, "user_email")})


_CHECKED = """
k AS (SELECT DISTINCT LOWER(mapped_user_email) AS u FROM dim_keys WHERE mapped_user_email IS NOT NULL),
v AS (SELECT event_id, user_email, event_type, client_platform, client_platform IS NULL AS e1,
  event_type NOT IN ('conversation_created', 'file_uploaded', 'project_created', 'project_document_created') AS e2,
  u IS NULL AS e3 FROM logs LEFT JOIN k ON user_email = u)"""


def _hourly_errors(s, d):
    out = I.rate_limit_alert(P.load(s, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", F.col("event_type") == "error", 1)
    return out.withColumn("hour", F.date_format("hour", "yyyy-MM-dd HH:mm:ss"))


QUERIES = {
    "monthly_finance": Query(
        _combined(I.monthly_finance),
        f"""WITH {_prev('provider')}, t AS (SELECT cost_month, SUM(cost) AS all_cost FROM m GROUP BY 1),
x AS (SELECT *, {pct('cost - previous', 'previous')} AS g FROM j JOIN t USING (cost_month))
SELECT cost_month, strftime(cost_month, '%Y-%m') AS month_year_label, provider AS platform, {usd('cost')} AS platform_monthly_cost,
  {usd('previous')} AS previous_month_cost, g AS mom_growth_pct, {_TREND} AS trend, {usd('cost * 12')} AS annual_run_rate,
  {pct('cost', 'all_cost')} AS share_pct FROM x""",
    ),
    "monthly_increase_alert": Query(
        _combined(I.monthly_increase_alert, pct=5.0),
        f"""WITH {_prev()} SELECT cost_month, {usd('cost')} AS month_cost, {usd('previous')} AS previous_month_cost,
  {pct('cost - previous', 'previous')} AS increase_pct FROM j WHERE cost * 100 > previous * 105""",
    ),
    "user_spend_class": Query(
        _combined(I.user_spend_class),
        f"""WITH m AS (SELECT {M} AS cost_month, user_email, {S} AS cost FROM combined WHERE user_email IS NOT NULL GROUP BY 1, 2)
SELECT cost_month, user_email, {usd('cost')} AS monthly_cost_usd,
  CASE WHEN cost > 200 THEN 'Power' WHEN cost >= 50 THEN 'Regular' ELSE 'Occasional' END AS spend_class FROM m""",
    ),
    "productivity_metrics_daily": _productivity("day", "activity_date"),
    "productivity_metrics_weekly": _productivity("week", week("activity_date")),
    "productivity_metrics": _productivity("month", month("activity_date")),
    "cost_allocation": Query(
        lambda s, d: I.cost_allocation(P.combined_daily_costs(s, d), P.cursor_usage_stats(s, d)),
        f"""WITH {_USERS}, y AS (SELECT *, {sdiv('cost', 'lines_accepted')} AS cpl FROM x)
SELECT user_email, {usd('cost')} AS total_cost_usd, lines_accepted, ROUND(cpl, 4) AS cost_per_line_usd, {_ROI}, {_RANK} AS user_rank FROM y""",
    ),
    "team_cost_allocation": Query(
        lambda s, d: I.team_cost_allocation(P.combined_daily_costs(s, d), P.cursor_usage_stats(s, d), P.dim_api_keys(s, d)),
        f"""WITH {_USERS}, k AS (SELECT LOWER(mapped_user_email) AS mu, MIN(mapped_team_name) AS team FROM dim_keys
  WHERE mapped_user_email IS NOT NULL GROUP BY 1),
t AS (SELECT COALESCE(team, 'Unmapped') AS team, COUNT(*) AS user_count, SUM(cost) AS cost, {big('SUM(lines_accepted)')} AS lines_accepted
  FROM x LEFT JOIN k ON user_email = mu GROUP BY 1),
y AS (SELECT *, {sdiv('cost', 'lines_accepted')} AS cpl FROM t)
SELECT team, user_count, {usd('cost')} AS team_cost_usd, lines_accepted, ROUND(cpl, 4) AS cost_per_line_usd, {_ROI}, {_RANK} AS team_rank FROM y""",
    ),
    "executive_summary": Query(
        _combined(I.executive_summary),
        f"""WITH m AS (SELECT {M} AS cost_month, {S} AS cost, COUNT(DISTINCT user_email) AS active_users,
  {', '.join(f"SUM(CASE WHEN provider = '{p}' THEN amount_usd ELSE 0 END) AS {p}" for p in PROVIDERS)} FROM combined GROUP BY 1),
p AS (SELECT CAST(cost_month + INTERVAL 1 MONTH AS DATE) AS cost_month, cost AS previous FROM m)
SELECT cost_month, {usd('cost')} AS total_cost_usd, active_users, {pct('cost - previous', 'previous')} AS mom_growth_pct,
  {usd('cost - 24333.333333')} AS budget_variance_usd, {', '.join(f"{pct(p, 'cost')} AS {p}_share_pct" for p in PROVIDERS)}
FROM m LEFT JOIN p USING (cost_month)""",
    ),
    "monthly_top_spenders": Query(
        _combined(I.monthly_top_spenders),
        f"""WITH m AS (SELECT {M} AS cost_month, user_email, {S} AS cost FROM combined WHERE user_email IS NOT NULL GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY cost_month ORDER BY cost DESC, user_email) AS position FROM m)
SELECT cost_month, position, user_email, {usd('cost')} AS total_cost_usd FROM r WHERE position <= 5""",
    ),
    "user_platform_matrix": Query(
        _combined(I.user_platform_matrix),
        f"""SELECT user_email, {', '.join(f"{usd(f'''SUM(CASE WHEN provider = '{p}' THEN amount_usd ELSE 0 END)''')} AS {p}_cost_usd" for p in PROVIDERS)},
  {usd(S)} AS total_cost_usd FROM combined WHERE user_email IS NOT NULL GROUP BY 1""",
    ),
    "tool_comparison": Query(
        lambda s, d: I.tool_comparison(P.cursor_usage_stats(s, d), P.claude_code_usage_stats(s, d)),
        f"""WITH u AS (SELECT 'cursor' AS tool, user_email, accepted_lines_added AS lines, 0 AS commits, 0 AS prs FROM editor
  UNION ALL SELECT 'claude_code', user_email, lines_added, commits_by_claude_code, pull_requests_by_claude_code FROM ide),
t AS (SELECT tool, COUNT(DISTINCT user_email) AS users, {big('SUM(lines)')} AS lines_accepted, {big('SUM(commits)')} AS commits,
  {big('SUM(prs)')} AS pull_requests FROM u GROUP BY 1)
SELECT *, ROW_NUMBER() OVER (ORDER BY lines_accepted DESC, tool) AS rank FROM t""",
    ),
    "cost_anomaly": Query(
        _combined(I.cost_anomaly),
        f"""WITH d AS (SELECT cost_date, {S} AS cost FROM combined GROUP BY 1),
g AS (SELECT CAST(s AS DATE) AS cost_date FROM generate_series((SELECT MIN(cost_date) FROM d), (SELECT MAX(cost_date) FROM d), INTERVAL 1 DAY) x(s)),
f AS (SELECT cost_date, cost, SUM(COALESCE(cost, 0)) OVER w AS before, COUNT(*) OVER w AS n FROM g LEFT JOIN d USING (cost_date)
  WINDOW w AS (ORDER BY cost_date ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)),
e AS (SELECT *, ROUND({sdiv('before', 'n')}, 6) AS mean FROM f WHERE cost IS NOT NULL AND n > 0)
SELECT cost_date, {usd('cost')} AS daily_cost_usd, ROUND(mean, 2) AS trailing_mean_usd, {pct('cost', 'mean')} AS pct_of_mean
FROM e WHERE CAST(cost AS DOUBLE) > mean * CAST(1.2 AS DOUBLE)""",
    ),
    "invoice_reconciliation": Query(
        lambda s, d: I.invoice_reconciliation(P.combined_daily_costs(s, d), _invoices(s, d)),
        f"""WITH a AS (SELECT {M} AS cost_month, {dbl(S)} AS actual_cost FROM combined GROUP BY 1),
e AS (SELECT {month('CAST(o_orderdate AS DATE)')} AS cost_month,
  {dbl('SUM(CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.00016 AS DECIMAL(18,6)))')} AS expected_cost FROM orders GROUP BY 1),
v AS (SELECT *, ABS(actual_cost - expected_cost) / NULLIF(expected_cost, 0) * 100 AS vc FROM a FULL JOIN e USING (cost_month))
SELECT cost_month, actual_cost, expected_cost, ROUND(vc, 2) AS cost_variance_percent,
  CASE WHEN expected_cost IS NULL THEN 'WARNING' WHEN vc <= 5 THEN 'PASSED' ELSE 'FAILED' END AS status FROM v""",
    ),
    "quality_score": Query(_quality, _QUALITY),
    "validate_rows": Query(
        lambda s, d: _checked(s, d)[0],
        f"WITH {_CHECKED} SELECT event_id, user_email, event_type, client_platform FROM v WHERE NOT (e1 OR e2 OR e3)",
    ),
    "rejected_rows": Query(
        lambda s, d: _checked(s, d)[1].withColumn("errors", F.array_join("errors", "; ")),
        f"""WITH {_CHECKED} SELECT event_id, user_email, event_type, client_platform,
  concat_ws('; ', CASE WHEN e1 THEN 'missing client_platform' END, CASE WHEN e2 THEN 'event_type is unknown' END,
    CASE WHEN e3 THEN 'user_email has no match' END) AS errors FROM v WHERE e1 OR e2 OR e3""",
    ),
    "rejected_by_error": Query(
        lambda s, d: I.rejected_by_error(_checked(s, d)[1]),
        f"""WITH {_CHECKED}, n AS (SELECT 'missing client_platform' AS error, COUNT(*) FILTER (e1) AS rows FROM v
UNION ALL SELECT 'event_type is unknown', COUNT(*) FILTER (e2) FROM v
UNION ALL SELECT 'user_email has no match', COUNT(*) FILTER (e3) FROM v) SELECT * FROM n WHERE rows > 0""",
    ),
    "schema_drift": Query(
        lambda s, d: I.field_drift(P.load(s, d, "events"), "props", ["key", "value"]),
        """WITH n AS (SELECT COUNT(props) AS records FROM events),
f AS (SELECT field, COUNT(*) AS n FROM (SELECT UNNEST(json_keys(props)) AS field FROM events) u GROUP BY 1),
k AS (SELECT UNNEST(['key', 'value']) AS expected)
SELECT COALESCE(field, expected) AS field, CAST(COALESCE(f.n, 0) AS BIGINT) AS records_with_field, records,
  CASE WHEN expected IS NULL THEN 'added' WHEN field IS NULL THEN 'removed' ELSE 'expected' END AS status
FROM f FULL JOIN k ON field = expected CROSS JOIN n""",
    ),
    "error_rate_alert": Query(
        lambda s, d: I.error_rate_alert(P.app_usage_logs(s, d), F.col("event_type") == "other", "activity_date"),
        f"""SELECT activity_date, COUNT(*) AS total, COUNT(*) FILTER (event_type = 'other') AS errors,
  {pct("COUNT(*) FILTER (event_type = 'other')", 'COUNT(*)')} AS error_pct,
  {sdiv("COUNT(*) FILTER (event_type = 'other') * 100", 'COUNT(*)')} > 5 AS alert FROM logs GROUP BY 1""",
    ),
    "rate_limit_alert": Query(
        _hourly_errors,
        """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS hour, COUNT(*) AS hits FROM events
WHERE event_type = 'error' GROUP BY 1 HAVING COUNT(*) > 1""",
    ),
}
