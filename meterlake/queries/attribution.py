"""Spend deltas, allocation, request pricing, the daily star, backfill."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.operators import joins as J
from meterlake.plans import attribution as A
from meterlake.plans import backfill as B
from meterlake.queries import Query
from meterlake.queries.views import END, START, big, dbl, sdiv

TOKENS5 = "uncached_input_tokens + output_tokens + cache_read_input_tokens + cache_creation_5m_tokens + cache_creation_1h_tokens"
TOKENS4 = "uncached_input_tokens + output_tokens + cache_read_input_tokens + cache_creation_5m_tokens"
GRAIN = "activity_date, workspace_id, model"


def _money(df, *cols):
    """Registered results carry DOUBLE money."""
    return df.select(*[F.col(c).cast("double").alias(c) if c in cols else F.col(c) for c in df.columns])


def _cycle_text(df):
    return df.withColumn("billing_cycle_start", F.col("billing_cycle_start").cast("date"))


def _allocate(null_safe):
    def run(s, d):
        return A.allocate_cost_to_keys(P.claude_costs(s, d), P.usage_keys(s, d), null_safe=null_safe)

    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    on = lambda t: " AND ".join(f"k.{c} {eq} {t}.{c}" for c in ("activity_date", "workspace_id", "model"))
    sql = f"""
WITH c AS (SELECT {GRAIN}, SUM(amount_usd) AS cost FROM costs GROUP BY ALL),
k AS (SELECT activity_date, api_key_id, workspace_id, model, {big(TOKENS5)} AS total_tokens FROM usage_keys),
t AS (SELECT {GRAIN}, SUM(total_tokens) AS tokens FROM k GROUP BY ALL)
SELECT k.activity_date, k.api_key_id, k.workspace_id, k.model, k.total_tokens, {dbl('cost')} AS workspace_model_cost,
  {big('tokens')} AS workspace_model_tokens, ROUND({sdiv('cost * total_tokens', 'tokens')}, 6) AS allocated_cost_usd
FROM k LEFT JOIN c ON {on('c')} LEFT JOIN t ON {on('t')}"""
    return Query(run, sql)


_DELTA_ROWS = """
r AS (SELECT user_email, billing_cycle_start, snapshot_date, total_spend_cents AS c,
  ROW_NUMBER() OVER (PARTITION BY user_email, billing_cycle_start ORDER BY snapshot_date) AS rn FROM spend)"""

_FOLD = f"""
WITH RECURSIVE {_DELTA_ROWS},
f AS (
  SELECT user_email, billing_cycle_start, snapshot_date, rn,
    CAST(CASE WHEN c < -1 THEN 0 ELSE c END AS BIGINT) AS delta, CAST(CASE WHEN c < -1 THEN 0 ELSE c END AS BIGINT) AS prev
  FROM r WHERE rn = 1
  UNION ALL
  SELECT r.user_email, r.billing_cycle_start, r.snapshot_date, r.rn,
    CAST(CASE WHEN r.c - f.prev < -1 THEN 0 ELSE r.c - f.prev END AS BIGINT),
    CAST(f.prev + CASE WHEN r.c - f.prev < -1 THEN 0 ELSE r.c - f.prev END AS BIGINT)
  FROM r JOIN f ON r.user_email = f.user_email AND r.billing_cycle_start = f.billing_cycle_start AND r.rn = f.rn + 1)
SELECT snapshot_date AS activity_date, user_email, billing_cycle_start,
  {dbl('CAST(delta AS DECIMAL(18,2)) / 100')} AS daily_spend_usd FROM f"""

_RUNNING_MAX = f"""
SELECT snapshot_date AS activity_date, user_email, billing_cycle_start, {dbl('top - GREATEST(COALESCE(LAG(top) OVER w, 0), 0)')} / 100 AS daily_spend_usd
FROM (SELECT *, GREATEST(MAX(total_spend_cents) OVER (PARTITION BY user_email, billing_cycle_start ORDER BY snapshot_date), 0) AS top FROM spend) m
WINDOW w AS (PARTITION BY user_email, billing_cycle_start ORDER BY snapshot_date)"""


def _metrics(s, d):
    """Daily metrics with a stored spend per user and day, from the event log."""
    e = P.load(s, d, "events")
    return e.groupBy(F.col("ts").cast("date").alias("activity_date"), F.concat(F.lit("user"), F.col("user_id").cast("string"), F.lit("@example.com")).alias("user_email")).agg(
        F.count(F.lit(1)).alias("total_applies"),
        (F.sum(F.round(F.col("value") * 100).cast("bigint")).cast("decimal(18,2)") / 100).cast("decimal(18,2)").alias("daily_spend_usd"),
    )


_METRICS = """m AS (SELECT CAST(ts AS DATE) AS activity_date, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS user_email,
  COUNT(*) AS total_applies, SUM(CAST(ROUND(value * 100) AS BIGINT)) AS cents FROM events GROUP BY 1, 2)"""

DAY = "2024-01-22"


def _deltas_for_day(s, d):
    return _money(A.spend_deltas_for_day(P.spend_snapshots(s, d), _metrics(s, d), "2024-01-01", DAY), "daily_spend_usd")


_FOR_DAY = f"""
WITH {_METRICS},
p AS (SELECT user_email, SUM(cents) AS prev FROM m WHERE activity_date >= DATE '2024-01-01' AND activity_date < DATE '{DAY}' GROUP BY 1),
x AS (SELECT s.user_email, s.total_spend_cents - COALESCE(prev, 0) AS delta FROM spend s LEFT JOIN p USING (user_email) WHERE snapshot_date = DATE '{DAY}')
SELECT DATE '{DAY}' AS activity_date, user_email, {dbl('CASE WHEN delta < -1 THEN 0 ELSE delta END')} / 100 AS daily_spend_usd FROM x"""


def _apply(s, d):
    deltas = A.spend_deltas(P.spend_snapshots(s, d).filter("user_role = 'member'"))
    return _money(A.apply_spend(_metrics(s, d), deltas), "daily_spend_usd")


_APPLY = _FOLD.replace("FROM spend)", "FROM spend WHERE user_role = 'member')").replace(
    f"SELECT snapshot_date AS activity_date, user_email, billing_cycle_start,\n  {dbl('CAST(delta AS DECIMAL(18,2)) / 100')} AS daily_spend_usd FROM f",
    f"SELECT m.activity_date, m.user_email, m.total_applies, {dbl('CASE WHEN f.user_email IS NOT NULL THEN f.delta ELSE m.cents END')} / 100 AS daily_spend_usd\n"
    "FROM m LEFT JOIN f ON m.user_email = f.user_email AND m.activity_date = f.snapshot_date",
).replace("WITH RECURSIVE", f"WITH RECURSIVE {_METRICS},")


def _backfill(s, d):
    out = A.backfill_spend(P.cursor_usage_stats(s, d), START, "2002-01-01", "2001-10-03 20:33:27")
    return out.withColumn("billing_cycle_start", F.date_format("billing_cycle_start", "yyyy-MM-dd HH:mm:ss"))


def _star(s, d):
    return A.fct_usage_daily(
        P.usage_keys(s, d), P.claude_code_usage_stats(s, d), P.cursor_usage_stats(s, d), P.dim_api_keys(s, d)
    )


def _cost_star(s, d):
    """Plain equality leaves the default workspace's cost to no key: it comes as unallocated."""
    allocated = A.allocate_cost_to_keys(P.claude_costs(s, d), P.usage_keys(s, d))
    out = A.fct_cost_daily(allocated, P.combined_daily_costs(s, d), P.dim_api_keys(s, d), P.claude_costs(s, d))
    return out.groupBy("cost_date", "platform", "cost_type").agg(
        F.round(F.sum("cost_usd"), 2).cast("double").alias("cost_usd"),
        F.countDistinct("user_email").alias("users"),
        F.countDistinct("api_key_id").alias("api_keys"),
    )


_COST_STAR = f"""
WITH c AS (SELECT {GRAIN}, SUM(amount_usd) AS cost FROM costs GROUP BY ALL),
k AS (SELECT activity_date, api_key_id, workspace_id, model, {TOKENS5} AS n FROM usage_keys),
t AS (SELECT {GRAIN}, SUM(n) AS tokens FROM k GROUP BY ALL),
a AS (SELECT k.activity_date AS d, k.workspace_id, k.model, k.api_key_id, CAST(ROUND({sdiv('cost * n', 'tokens')}, 6) AS DECIMAL(18,6)) AS usd
  FROM k LEFT JOIN c ON k.activity_date = c.activity_date AND k.workspace_id = c.workspace_id AND k.model = c.model
  LEFT JOIN t ON k.activity_date = t.activity_date AND k.workspace_id = t.workspace_id AND k.model = t.model),
r AS (SELECT activity_date, workspace_id, model, SUM(usd) AS usd FROM (SELECT {GRAIN}, CAST(amount_usd AS DECIMAL(18,6)) AS usd FROM costs
  UNION ALL SELECT d, workspace_id, model, -COALESCE(usd, 0) FROM a) GROUP BY ALL),
u AS (SELECT d, 'anthropic' AS platform, 'usage' AS cost_type, usd, LOWER(x.user_email) AS user_email, a.api_key_id FROM a LEFT JOIN key_user x USING (api_key_id)
  UNION ALL SELECT activity_date, 'anthropic', 'unallocated', usd, NULL, NULL FROM r WHERE usd <> 0
  UNION ALL SELECT cost_date, provider, cost_category, amount_usd, LOWER(user_email), NULL FROM combined WHERE provider IS DISTINCT FROM 'claude_api')
SELECT d AS cost_date, platform, cost_type, CAST(ROUND(SUM(usd), 2) AS DOUBLE) AS cost_usd, COUNT(DISTINCT user_email) AS users,
  COUNT(DISTINCT api_key_id) AS api_keys FROM u GROUP BY 1, 2, 3"""


def _three_way(s, d):
    grain = ["activity_date", "workspace_id", "model"]
    u = P.usage_keys(s, d).groupBy("activity_date", "workspace_id", "model", "api_key_id").agg(F.sum("output_tokens").alias("tokens"))
    c = P.claude_costs(s, d).groupBy(*grain).agg(F.sum("amount_usd").cast("double").alias("cost"))
    t = P.usage_keys(s, d).groupBy(*grain).agg(F.sum("output_tokens").alias("all_tokens"))
    return J.three_way_left(u, c, t, grain)


def _lookups(s, d):
    """Key to name, user and team in one join, and workspace to its name, for every fact row."""
    rows = P.usage_keys(s, d).select("activity_date", "api_key_id", "workspace_id", "output_tokens")
    rows = J.lookup(rows, P.dim_api_keys(s, d), "api_key_id", {"key_name": "api_key_name", "user_email": "mapped_user_email", "team": "mapped_team_name"})
    rows = J.lookup(rows, P.dim_workspaces(s, d), "workspace_id", {"workspace": "workspace_name"})
    return rows.groupBy("activity_date", "team", "workspace").agg(
        F.countDistinct("key_name").alias("key_names"),
        F.countDistinct("user_email").alias("users"), F.sum("output_tokens").alias("output_tokens")
    )


def _status(s, d):
    return B.backfill_status(
        P.claude_costs(s, d), START, END, day_max=15000.0, invalid=(F.col("cost_type") == "web_search") & (F.col("amount_usd") > 1040)
    )


_STATUS = f"""
p AS (SELECT activity_date, COUNT(*) AS n, SUM(amount_usd) AS total,
  COUNT(*) FILTER (cost_type = 'web_search' AND amount_usd > 1040) AS bad FROM costs GROUP BY 1),
x AS (SELECT CAST(s AS DATE) AS date, n, total, CASE WHEN n IS NULL THEN 'no rows' WHEN bad > 0 THEN 'invalid rows'
  WHEN total > 15000 THEN 'day total above ceiling' END AS reason
  FROM generate_series(DATE '{START}', DATE '{END}', INTERVAL 1 DAY) g(s) LEFT JOIN p ON activity_date = CAST(s AS DATE)),
st AS (SELECT date, {big('COALESCE(n, 0)')} AS rows, {dbl('total')} AS total_cost,
  CASE WHEN n IS NULL THEN 'empty' WHEN reason IS NULL THEN 'ok' ELSE 'failed' END AS status, reason FROM x)"""


def _backfill_rows(s, d):
    rows = B.backfill_rows(P.claude_costs(s, d), _status(s, d))
    return rows.groupBy("activity_date").agg(F.count(F.lit(1)).alias("n"), F.sum("amount_usd").cast("double").alias("total"))


def _retry(s, d):
    failed = _status(s, d).filter("status = 'failed'").select("date")
    return B.retry_dates(P.claude_costs(s, d), failed, day_max=None)


QUERIES = {
    "spend_deltas": Query(lambda s, d: _money(_cycle_text(A.spend_deltas(P.spend_snapshots(s, d))), "daily_spend_usd"), _FOLD),
    "spend_deltas_running_max": Query(
        lambda s, d: _money(_cycle_text(A.spend_deltas_running_max(P.spend_snapshots(s, d))), "daily_spend_usd"), _RUNNING_MAX
    ),
    "spend_deltas_for_day": Query(_deltas_for_day, _FOR_DAY),
    "apply_spend": Query(_apply, _APPLY),
    "backfill_spend": Query(
        _backfill,
        f"""SELECT activity_date AS snapshot_date, '2001-10-03 20:33:27' AS billing_cycle_start, user_email,
  'user_backfill_' || md5(user_email) AS user_id, CAST(NULL AS VARCHAR) AS user_name, 'member' AS user_role,
  {big('usage_based_reqs * 10')} AS spend_cents, {big('0')} AS included_spend_cents, {big('usage_based_reqs * 10')} AS total_spend_cents,
  {big('0')} AS fast_premium_requests, {dbl('NULL')} AS monthly_limit_dollars, {dbl('1000')} AS hard_limit_override_dollars
FROM editor WHERE activity_date >= DATE '{START}' AND activity_date < DATE '2002-01-01'""",
    ),
    "estimated_spend": Query(
        lambda s, d: A.estimated_spend(P.cursor_usage_stats(s, d), START),
        f"""SELECT activity_date, user_email, usage_based_reqs, {dbl('usage_based_reqs * 0.10')} AS estimated_spend_usd
FROM editor WHERE activity_date >= DATE '{START}'""",
    ),
    "request_cost_model": Query(
        lambda s, d: A.request_cost_model(P.cursor_usage_stats(s, d)),
        f"""WITH x AS (SELECT *, day(last_day(activity_date)) AS days FROM editor)
SELECT activity_date, user_email, subscription_included_reqs, usage_based_reqs,
  ROUND({dbl('20')} / days, 6) AS subscription_cost_usd, ROUND(usage_based_reqs * {dbl('0.05')}, 6) AS overage_cost_usd,
  ROUND({dbl('20')} / days + usage_based_reqs * {dbl('0.05')}, 6) AS total_cost_usd, {big('days')} AS days_in_month FROM x""",
    ),
    "allocate_cost_to_keys": _allocate(False),
    "allocate_cost_to_keys_null_safe": _allocate(True),
    "allocate_cost_window": Query(
        lambda s, d: A.allocate_cost_window(P.claude_costs(s, d), P.usage_keys(s, d)),
        f"""WITH c AS (SELECT {GRAIN}, SUM(amount_usd) AS cost FROM costs GROUP BY ALL),
k AS (SELECT activity_date, api_key_id, workspace_id, model, {TOKENS4} AS n FROM usage_keys)
SELECT activity_date, api_key_id, workspace_id, model,
  ROUND({sdiv('cost * n', 'SUM(n) OVER (PARTITION BY workspace_id, model, activity_date)')}, 6) AS allocated_cost_usd
FROM k JOIN c USING (workspace_id, model, activity_date)""",
    ),
    "fct_usage_daily": Query(
        lambda s, d: _money(_star(s, d), "acceptance_rate"),
        f"""SELECT *, {dbl(f"CAST(COALESCE(ROUND({sdiv('loc_accepted', 'loc_added')}, 4), 0) AS DECIMAL(18,4))")} AS acceptance_rate FROM fct""",
    ),
    "fct_cost_daily": Query(_cost_star, _COST_STAR),
    "three_way_left_join": Query(
        _three_way,
        f"""WITH u AS (SELECT {GRAIN}, api_key_id, SUM(output_tokens) AS tokens FROM usage_keys GROUP BY ALL),
c AS (SELECT {GRAIN}, SUM(amount_usd) AS cost FROM costs GROUP BY ALL),
t AS (SELECT {GRAIN}, SUM(output_tokens) AS n FROM usage_keys GROUP BY ALL)
SELECT u.activity_date, u.workspace_id, u.model, u.api_key_id, {big('tokens')} AS tokens, {dbl('cost')} AS cost, {big('n')} AS all_tokens FROM u
LEFT JOIN c ON u.activity_date = c.activity_date AND u.workspace_id = c.workspace_id AND u.model = c.model
LEFT JOIN t ON u.activity_date = t.activity_date AND u.workspace_id = t.workspace_id AND u.model = t.model""",
    ),
    "dimension_lookups": Query(
        _lookups,
        f"""WITH k AS (SELECT api_key_id, MIN(api_key_name) AS key_name, MIN(mapped_user_email) AS user_email, MIN(mapped_team_name) AS team FROM dim_keys GROUP BY 1)
SELECT activity_date, team, w.workspace, COUNT(DISTINCT key_name) AS key_names, COUNT(DISTINCT user_email) AS users,
  {big('SUM(output_tokens)')} AS output_tokens
FROM usage_keys LEFT JOIN k USING (api_key_id)
LEFT JOIN (SELECT 'wrkspc_' || lower(l_returnflag) AS workspace_id, 'Workspace ' || l_returnflag AS workspace FROM lineitem GROUP BY ALL) w USING (workspace_id)
GROUP BY 1, 2, 3""",
    ),
    "backfill_range": Query(_status, f"WITH {_STATUS} SELECT * FROM st"),
    "backfill_rows": Query(
        _backfill_rows,
        f"""WITH {_STATUS} SELECT activity_date, COUNT(*) AS n, {dbl('SUM(amount_usd)')} AS total FROM costs
WHERE activity_date IN (SELECT date FROM st WHERE status = 'ok') GROUP BY 1""",
    ),
    "retry_dates": Query(
        _retry,
        f"WITH {_STATUS} SELECT date, rows, total_cost, 'ok' AS status, CAST(NULL AS VARCHAR) AS reason FROM st WHERE status = 'failed'",
    ),
    "chunk_range": Query(
        lambda s, d: B.chunk_load(P.claude_costs(s, d)),
        f"""WITH b AS (SELECT MIN(activity_date) AS s, MAX(activity_date) AS e FROM costs),
c AS (SELECT i AS chunk, s + CAST(i * 91 AS INTEGER) AS chunk_start, LEAST(s + CAST(i * 91 + 90 AS INTEGER), e) AS chunk_end
  FROM b, generate_series(0, (SELECT (e - s) // 91 FROM b)) g(i))
SELECT chunk, chunk_start, chunk_end, COUNT(activity_date) AS rows FROM c
LEFT JOIN costs ON activity_date BETWEEN chunk_start AND chunk_end GROUP BY 1, 2, 3""",
    ),
}
