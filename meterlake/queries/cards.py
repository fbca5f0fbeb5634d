"""Dashboard cards and summaries over the combined cost fact."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.plans import costs as C
from meterlake.queries import Query
from meterlake.queries.views import AS_OF, END, EVENTS_AS_OF, START, big, dbl, month, pct, sdiv, usd, week

RANGE = f"cost_date BETWEEN DATE '{START}' AND DATE '{END}'"
S = "SUM(amount_usd)"
USERS = f"SELECT user_email, {S} AS total FROM combined WHERE {RANGE} AND user_email IS NOT NULL GROUP BY user_email"
SEATS = 2000


def _card(fn, with_model=False, **kw):
    return lambda spark, d: fn(P.combined_daily_costs(spark, d, with_model), START, END, **kw)


def _of(provider: str) -> str:
    return usd(f"SUM(CASE WHEN provider = '{provider}' THEN amount_usd ELSE 0 END)")


def _seats(window_days, seats, end):
    def run(spark, d):
        usages = [P.cursor_usage_stats(spark, d), P.claude_code_usage_stats(spark, d), P.order_logs(spark, d)]
        return C.alert_seat_utilization(usages, end, window_days, seats)

    w = f"activity_date BETWEEN DATE '{end}' - {window_days} AND DATE '{end}'"
    sql = f"""
WITH active AS (SELECT user_email FROM editor WHERE {w} UNION SELECT user_email FROM ide WHERE {w}
  UNION SELECT user_email FROM order_logs WHERE {w}), n AS (SELECT COUNT(*) AS n FROM active)
SELECT {big(seats)} AS total_seats, n AS active_users, {big(f'GREATEST({seats} - n, 0)')} AS inactive_users,
  ROUND({sdiv('n', str(seats))} * 100, 2) AS utilization_pct FROM n"""
    return Query(run, sql)


def _team(dedupe):
    def run(spark, d):
        return C.team_attribution(P.combined_daily_costs(spark, d), P.dim_api_keys(spark, d), START, END, dedupe_mapping=dedupe)

    sql = f"""
WITH users AS ({USERS}),
mapping AS (SELECT {'DISTINCT' if dedupe else ''} LOWER(mapped_user_email) AS u, COALESCE(mapped_team_name, 'Unmapped') AS team
  FROM dim_keys WHERE mapped_user_email IS NOT NULL),
joined AS (SELECT COALESCE(team, 'Unmapped') AS team, user_email, total FROM users LEFT JOIN mapping ON LOWER(user_email) = u),
ranked AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY team ORDER BY total DESC, user_email) AS rn FROM joined)
SELECT team, COUNT(DISTINCT user_email) AS user_count, {usd('SUM(total)')} AS team_cost_usd,
  ROUND({sdiv('SUM(total)', 'COUNT(DISTINCT user_email)')}, 2) AS cost_per_user_usd,
  MAX(CASE WHEN rn = 1 THEN user_email END) AS top_user, {dbl('MAX(total)')} AS top_user_cost_usd
FROM ranked GROUP BY team"""
    return Query(run, sql)


def _combined_union(spark, d):
    spend = P.cursor_usage_stats(spark, d).withColumn("daily_spend_usd", F.col("usage_based_reqs") * 0.5)
    out = C.combined_daily_costs(P.claude_costs(spark, d), P.claude_code_usage_stats(spark, d), spend)
    return out.groupBy("cost_date", "provider", "cost_category").agg(
        F.sum("amount_usd").cast("double").alias("amount_usd"),
        F.countDistinct("user_email").alias("users"),
        F.countDistinct("model").alias("models"),
        F.count(F.lit(1)).alias("rows"),
    )


NAMES = {"wrkspc_a": "Claude Code"}
CRANGE = f"activity_date BETWEEN DATE '{START}' AND DATE '{END}'"

QUERIES = {
    "kpi_total_cost": Query(
        _card(C.kpi_total_cost),
        f"SELECT {usd(S)} AS total_cost_usd, {_of('claude_api')} AS claude_api_cost_usd,"
        f" {_of('claude_code')} AS claude_code_cost_usd, {_of('cursor')} AS cursor_cost_usd FROM combined WHERE {RANGE}",
    ),
    "kpi_daily_average": Query(
        _card(C.kpi_daily_average),
        f"""WITH s AS (SELECT {S} AS total, date_diff('day', MIN(cost_date), MAX(cost_date)) + 1 AS n FROM combined WHERE {RANGE})
SELECT ROUND({sdiv('total', 'n')}, 2) AS average_daily_cost_usd, {big('n')} AS day_count FROM s""",
    ),
    "kpi_cost_per_user": Query(
        _card(C.kpi_cost_per_user),
        f"WITH u AS ({USERS}) SELECT ROUND({sdiv('SUM(total)', 'COUNT(*)')}, 2) AS cost_per_user_usd, COUNT(*) AS active_users FROM u",
    ),
    "kpi_budget_variance": Query(
        _card(C.kpi_budget_variance),
        f"""SELECT {usd(S)} AS total_cost_usd, {dbl('73000')} AS budget_usd, {usd(f'{S} - 73000')} AS variance_usd,
  {pct(f'{S} - 73000', '73000')} AS variance_pct FROM combined WHERE {RANGE}""",
    ),
    "kpi_budget_variance_zero": Query(
        _card(C.kpi_budget_variance, quarter_budget=0.0),
        f"""SELECT {usd(S)} AS total_cost_usd, {dbl('0')} AS budget_usd, {usd(S)} AS variance_usd,
  CAST(NULL AS DOUBLE) AS variance_pct FROM combined WHERE {RANGE}""",
    ),
    "daily_spend_trend": Query(
        _card(C.daily_spend_trend),
        f"""SELECT cost_date, {usd(S)} AS total_cost_usd, {dbl('793.48')} AS budget_reference_usd,
  {pct(f'{S} - 793.48', '793.48')} AS pct_vs_budget FROM combined WHERE {RANGE} GROUP BY cost_date""",
    ),
    "provider_breakdown": Query(
        _card(C.provider_breakdown),
        f"SELECT provider, {usd(S)} AS total_cost_usd FROM combined WHERE {RANGE} GROUP BY provider",
    ),
    "top_spenders": Query(
        _card(C.top_spenders),
        f"""WITH u AS ({USERS}) SELECT user_email, {usd('total')} AS total_cost_usd, {dbl('500')} AS alert_threshold_usd
FROM u ORDER BY 2 DESC, 1 LIMIT 15""",
    ),
    "top_spenders_by_provider": Query(
        _card(C.top_spenders_by_provider, providers=["claude_api", "cursor"]),
        f"""SELECT user_email, provider, {usd(S)} AS total_cost_usd FROM combined
WHERE {RANGE} AND provider IN ('claude_api', 'cursor') GROUP BY 1, 2 ORDER BY 3 DESC, 1 NULLS LAST, 2 LIMIT 15""",
    ),
    "user_cost_histogram": Query(
        _card(C.user_cost_histogram),
        f"""WITH u AS ({USERS}) SELECT CASE WHEN total < 100 THEN '$0-100' WHEN total < 300 THEN '$100-300'
  WHEN total < 500 THEN '$300-500' WHEN total < 1000 THEN '$500-1000' ELSE '$1000+' END AS cost_range,
  COUNT(*) AS user_count FROM u GROUP BY 1""",
    ),
    "weekly_cost_by_model": Query(
        _card(C.weekly_cost_by_model, with_model=True),
        f"""SELECT {week('cost_date')} AS week_start, model, {usd(S)} AS model_cost_usd FROM combined
WHERE {RANGE} AND model IS NOT NULL GROUP BY 1, 2""",
    ),
    "weekly_cost_by_token_type": Query(
        _card(C.weekly_cost_by_token_type),
        f"""SELECT {week('cost_date')} AS week_start, CASE WHEN description LIKE '%Cache Hit%' THEN 'Cache Read'
  WHEN description LIKE '%Cache Write%' THEN 'Cache Write' WHEN description LIKE '%Output Tokens%' THEN 'Output'
  WHEN description LIKE '%Input Tokens%' AND description NOT LIKE '%Cache%' THEN 'Input' ELSE 'Other' END AS token_category,
  {usd(S)} AS token_cost_usd FROM combined WHERE {RANGE} AND cost_category = 'tokens' GROUP BY 1, 2""",
    ),
    "team_attribution": _team(False),
    "team_attribution_deduped": _team(True),
    "alert_user_budget": Query(
        _card(C.alert_user_budget),
        f"""WITH u AS ({USERS}) SELECT COUNT(*) FILTER (total > 500) AS users_over_threshold,
  {usd('MAX(total)')} AS highest_user_spend_usd FROM u""",
    ),
    "alert_cache_efficiency": Query(
        lambda s, d: C.alert_cache_efficiency(P.usage_keys(s, d), START, END),
        f"""SELECT ROUND({sdiv('SUM(cache_read_input_tokens)', 'SUM(uncached_input_tokens) + SUM(cache_read_input_tokens)')} * 100, 2)
  AS cache_hit_rate_pct, {big('SUM(cache_read_input_tokens)')} AS cache_read_tokens,
  {big('SUM(uncached_input_tokens)')} AS uncached_input_tokens FROM usage_keys WHERE {CRANGE}""",
    ),
    "alert_seat_utilization": _seats(2556, SEATS, END),
    "alert_seat_utilization_clamped": _seats(14, 10, "2001-07-31"),
    "combined_daily_costs": Query(
        _combined_union,
        f"""WITH u AS (
  SELECT activity_date AS cost_date, 'claude_api' AS provider, NULL AS user_email, model, cost_type AS cost_category, amount_usd FROM costs
  UNION ALL SELECT activity_date, 'claude_code', user_email, NULL, 'ide', total_estimated_cost_usd FROM ide
  UNION ALL SELECT activity_date, 'cursor', user_email, most_used_model, 'subscription', CAST(usage_based_reqs * 0.5 AS DECIMAL(18,6)) FROM editor)
SELECT cost_date, provider, cost_category, {dbl(S)} AS amount_usd, COUNT(DISTINCT user_email) AS users,
  COUNT(DISTINCT model) AS models, COUNT(*) AS rows FROM u GROUP BY 1, 2, 3""",
    ),
    "workspace_costs": Query(
        lambda s, d: C.workspace_costs(P.claude_costs(s, d), NAMES, START, END),
        f"""SELECT CASE WHEN workspace_id IS NULL THEN 'Default Workspace' WHEN workspace_id = 'wrkspc_a' THEN 'Claude Code'
  ELSE 'Other' END AS workspace, COUNT(*) AS num_records, {dbl(S)} AS total_cost, {dbl('MIN(amount_usd)')} AS min_cost,
  {dbl('MAX(amount_usd)')} AS max_cost FROM costs WHERE {CRANGE} GROUP BY 1""",
    ),
    "workspace_costs_daily": Query(
        lambda s, d: C.workspace_costs_daily(P.claude_costs(s, d), start=START, end=END),
        f"""SELECT activity_date, CASE WHEN workspace_id IS NULL THEN 'Default' ELSE 'Claude Code' END AS workspace,
  COUNT(*) AS num_line_items, {dbl(S)} AS daily_cost FROM costs WHERE {CRANGE} GROUP BY 1, 2""",
    ),
    "daily_cost_by_kind": Query(
        lambda s, d: C.daily_cost_by_kind(P.claude_costs(s, d)),
        "SELECT activity_date, workspace_id, model, "
        + ", ".join(
            f"{dbl(f'SUM(CASE WHEN {cond} THEN amount_usd ELSE 0 END)')} AS {name}_cost_usd"
            for cond, name in [
                ("token_type LIKE '%input%' AND token_type NOT LIKE '%cache%'", "input"),
                ("token_type = 'output_tokens'", "output"),
                ("token_type LIKE '%cache_read%'", "cache_read"),
                ("token_type LIKE '%cache_creation%'", "cache_write"),
            ]
        )
        + f", {dbl(S)} AS total_cost_usd FROM costs GROUP BY 1, 2, 3",
    ),
    "model_share": Query(
        lambda s, d: C.model_share(P.claude_costs(s, d), START, END),
        f"""SELECT model, COUNT(*) AS num_records, {dbl(S)} AS total_cost,
  ROUND({sdiv(f'{S} * 100', f'SUM({S}) OVER ()')}, 2) AS pct_of_total
FROM costs WHERE {CRANGE} AND model IS NOT NULL GROUP BY model""",
    ),
    "monthly_summary": Query(
        lambda s, d: C.monthly_summary(P.combined_daily_costs(s, d)),
        f"""SELECT {month('cost_date')} AS summary_month, user_email,
  {usd("SUM(CASE WHEN provider IN ('claude_code', 'cursor') THEN amount_usd ELSE 0 END)")} AS total_coding_cost,
  {_of('claude_api')} AS total_api_cost, {dbl('0')} AS total_assistant_cost, {usd(S)} AS total_ai_investment
FROM combined GROUP BY 1, 2""",
    ),
    "current_month": Query(
        lambda s, d: C.current_month(P.app_usage_logs(s, d), EVENTS_AS_OF, "activity_date")
        .groupBy("activity_date", "user_email").agg(F.count(F.lit(1)).alias("events")),
        """SELECT activity_date, user_email, COUNT(*) AS events FROM logs
WHERE date_trunc('month', activity_date) = DATE '2024-01-01' GROUP BY 1, 2""",
    ),
    "daily_cost_trend": Query(
        lambda s, d: C.daily_cost_trend(P.claude_costs(s, d), AS_OF, 2556, 30),
        f"SELECT activity_date, {dbl(S)} AS daily_cost FROM costs GROUP BY 1 ORDER BY 1 DESC LIMIT 30",
    ),
}
