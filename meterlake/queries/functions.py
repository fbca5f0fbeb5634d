"""Scalar functions, parameter binding and join forms, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.functions import dates as D
from meterlake.functions import numbers as N
from meterlake.functions import text as X
from meterlake.operators import filters as O
from meterlake.operators import joins as J
from meterlake.operators.aggregates import distinct_sorted, having, union_distinct
from meterlake.queries import Query
from meterlake.queries.views import END, START, big, dbl, month, sdiv, week

RANGE = f"cost_date BETWEEN DATE '{START}' AND DATE '{END}'"


def date_functions(s, d):
    c = P.load(s, d, "orders").select(F.col("o_orderdate").cast("date").alias("d"))
    iso = F.concat(F.date_format("d", "yyyy-MM-dd"), F.lit("T23:30:00Z"))
    return c.groupBy("d").agg(F.count(F.lit(1)).alias("n")).select(
        "d", "n",
        D.week_start("d").alias("week_start"), D.month_start("d").alias("month_start"),
        D.days_in_month("d").cast("bigint").alias("days_in_month"),
        F.datediff("d", D.month_start("d")).cast("bigint").alias("day_offset"),
        D.shift_weeks("d", 4).alias("four_weeks_on"), D.month_label("d").alias("month_label"), D.month_key("d").alias("month_key"),
        D.iso_date(iso).alias("iso_date"),
        F.date_format(D.iso_timestamp(iso), "yyyy-MM-dd HH:mm:ss").alias("instant"),
        F.date_format(D.iso_timestamp(F.regexp_replace(iso, "Z$", "+02:00")), "yyyy-MM-dd HH:mm:ss").alias("instant_from_offset"),
        F.date_format(D.epoch_millis(F.unix_millis(D.iso_timestamp(iso))), "yyyy-MM-dd HH:mm:ss").alias("from_millis"),
    )


_DATES = f"""
WITH o AS (SELECT CAST(o_orderdate AS DATE) AS d, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT d, n, {week('d')} AS week_start, {month('d')} AS month_start, {big('day(last_day(d))')} AS days_in_month, {big('day(d) - 1')} AS day_offset,
  d + 28 AS four_weeks_on, strftime(d, '%B %Y') AS month_label, strftime(d, '%Y-%m') AS month_key, d AS iso_date,
  strftime(d, '%Y-%m-%d') || ' 23:30:00' AS instant, strftime(d, '%Y-%m-%d') || ' 21:30:00' AS instant_from_offset,
  strftime(d, '%Y-%m-%d') || ' 23:30:00' AS from_millis FROM o"""


def number_functions(s, d):
    r = P.load(s, d, "lineitem")
    price, disc = F.col("l_extendedprice").cast("decimal(18,2)"), F.col("l_discount").cast("decimal(18,2)")
    return r.select(
        "l_orderkey", "l_linenumber",
        N.usd(price / 8, 2).alias("rounded"), N.cents_to_usd(price).cast("double").alias("dollars"),
        N.safe_divide(price, disc).alias("safe_ratio"),
        F.nullif(disc, F.lit(0).cast("decimal(18,2)")).cast("double").alias("non_zero"),
        F.greatest(disc, F.lit("0.05").cast("decimal(18,2)")).cast("double").alias("at_least"),
        F.abs(disc - F.lit("0.05").cast("decimal(18,2)")).cast("double").alias("distance"),
        F.coalesce(F.when(F.col("l_returnflag") == "A", disc).cast("double"), F.lit(-1.0)).alias("filled"),
        F.col("l_quantity").cast("bigint").alias("units"),
    )


_P2, _D2 = "CAST(l_extendedprice AS DECIMAL(18,2))", "CAST(l_discount AS DECIMAL(18,2))"
_NUMBERS = f"""
SELECT l_orderkey, l_linenumber, {dbl(f'ROUND(CAST({_P2} * 0.125 AS DECIMAL(18,5)), 2)')} AS rounded, {dbl(f'CAST({_P2} * 0.01 AS DECIMAL(18,6))')} AS dollars,
  {sdiv(_P2, _D2)} AS safe_ratio, {dbl(f'NULLIF({_D2}, 0)')} AS non_zero, {dbl(f'GREATEST({_D2}, 0.05)')} AS at_least, {dbl(f'ABS({_D2} - 0.05)')} AS distance,
  COALESCE(CASE WHEN l_returnflag = 'A' THEN {dbl(_D2)} END, {dbl('-1')}) AS filled, {big('l_quantity')} AS units FROM lineitem"""


def text_functions(s, d):
    c = P.load(s, d, "customer")
    return c.select(
        "c_custkey", X.blank_to_null(F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))).alias("segment"),
        F.lower("c_name").alias("lower_name"), X.backfill_user_id("c_name").alias("user_id"),
        X.classify_like("c_name", [("%#%00%", "many zeros"), ("Customer#%", "customer")], "other").alias("kind"),
        F.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
    )


_TEXT = """
SELECT c_custkey, NULLIF(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, '') AS segment, LOWER(c_name) AS lower_name,
  'user_backfill_' || md5(c_name) AS user_id, CASE WHEN c_name LIKE '%#%00%' THEN 'many zeros' WHEN c_name LIKE 'Customer#%' THEN 'customer' ELSE 'other' END AS kind,
  c_name || '/' || c_mktsegment AS joined FROM customer"""


def bound_parameters(s, d):
    return O.run_sql(
        s,
        """SELECT provider, CAST(SUM(amount_usd) AS DOUBLE) AS total, :label AS label FROM {costs}
           WHERE cost_date BETWEEN CAST(:start AS DATE) AND CAST(:end AS DATE) AND amount_usd >= :floor GROUP BY provider""",
        {"costs": P.combined_daily_costs(s, d)}, start=START, end=END, label="it's bound", floor=1,
    )


def optional_filters(s, d):
    costs = P.combined_daily_costs(s, d)
    every = O.optional_filter(costs, "provider")
    some = O.optional_filter(costs, "provider", ["cursor", "claude_api"])
    one = O.optional_filter(costs, "cost_category", "web_search")
    count = lambda df, name: O.label(df.groupBy("provider").agg(F.count(F.lit(1)).alias("n")), "filter", name)
    return count(every, "none").unionByName(count(some, "list")).unionByName(count(one, "single"))


_OPTIONAL = """
SELECT 'none' AS filter, provider, COUNT(*) AS n FROM combined GROUP BY 2 UNION ALL
SELECT 'list', provider, COUNT(*) FROM combined WHERE provider IN ('cursor', 'claude_api') GROUP BY 2 UNION ALL
SELECT 'single', provider, COUNT(*) FROM combined WHERE cost_category = 'web_search' GROUP BY 2"""


def date_ranges(s, d):
    """The date filters side by side: absent bounds, trailing days, trailing window, null filter."""
    logs = P.app_usage_logs(s, d)
    start, end = O.with_defaults("2024-01-01", None)
    n = F.count(F.lit(1)).alias("n")
    parts = {
        "open": O.between_dates(logs, "activity_date", None, None),
        "default end": O.between_dates(logs, "activity_date", start, end),
        "trailing": O.trailing(logs, "activity_date", 7, "2024-01-20"),
        "window": O.trailing_window(logs, "activity_date", 7, "2024-01-20"),
        "no platform": logs.filter(F.col("client_platform").isNull()),
    }
    out = None
    for name, df in parts.items():
        one = df.agg(F.lit(name).alias("filter"), n)
        out = one if out is None else out.unionByName(one)
    return out


_DATE_RANGES = """
SELECT 'open' AS filter, COUNT(*) AS n FROM logs UNION ALL
SELECT 'default end', COUNT(*) FROM logs WHERE activity_date BETWEEN DATE '2024-01-01' AND DATE '2025-12-31' UNION ALL
SELECT 'trailing', COUNT(*) FROM logs WHERE activity_date >= DATE '2024-01-13' UNION ALL
SELECT 'window', COUNT(*) FROM logs WHERE activity_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-20' UNION ALL
SELECT 'no platform', COUNT(*) FROM logs WHERE client_platform IS NULL"""


def global_counts(s, d):
    logs = P.app_usage_logs(s, d).select("event_id", "event_type", "client_platform")
    out = J.join_global_counts(logs, "client_platform")
    return out.groupBy("event_type", "client_platform", "cnt").agg(F.count(F.lit(1)).alias("n"))


def semi_filtered(s, d):
    keys = P.dim_api_keys(s, d).filter(F.col("mapped_user_email").isNotNull())
    out = O.semi_filter(P.usage_keys(s, d), keys, "api_key_id")
    return out.groupBy("api_key_id").agg(F.sum("output_tokens").alias("output_tokens"))


def busy_days(s, d):
    """GROUP BY an expression, HAVING on an aggregate alias."""
    logs = P.app_usage_logs(s, d)
    return having(logs, [D.week_start("activity_date").alias("week"), "user_email"],
                  [F.count(F.lit(1)).alias("n"), F.min("activity_date").alias("first"), F.max("activity_date").alias("last")], F.col("n") > 15)


def distinct_pairs(s, d):
    return distinct_sorted(P.claude_code_usage_stats(s, d), "actor_type", "terminal_type", "user_email")


def user_union(s, d):
    parts = [P.cursor_usage_stats(s, d), P.claude_code_usage_stats(s, d), P.app_usage_logs(s, d)]
    return union_distinct([p.select("user_email") for p in parts])


QUERIES = {
    "date_functions": Query(date_functions, _DATES),
    "number_functions": Query(number_functions, _NUMBERS),
    "text_functions": Query(text_functions, _TEXT),
    "bound_parameters": Query(
        bound_parameters,
        f"""SELECT provider, {dbl('SUM(amount_usd)')} AS total, 'it''s bound' AS label FROM combined
WHERE {RANGE} AND amount_usd >= 1 GROUP BY provider""",
    ),
    "optional_filters": Query(optional_filters, _OPTIONAL),
    "date_ranges": Query(date_ranges, _DATE_RANGES),
    "join_global_counts": Query(
        global_counts,
        """WITH g AS (SELECT client_platform, COUNT(*) AS cnt FROM logs GROUP BY 1)
SELECT event_type, l.client_platform, cnt, COUNT(*) AS n FROM logs l LEFT JOIN g ON l.client_platform = g.client_platform GROUP BY 1, 2, 3""",
    ),
    "semi_filter": Query(
        semi_filtered,
        f"""SELECT api_key_id, {big('SUM(output_tokens)')} AS output_tokens FROM usage_keys
WHERE api_key_id IN (SELECT api_key_id FROM dim_keys WHERE mapped_user_email IS NOT NULL) GROUP BY 1""",
    ),
    "group_having": Query(
        busy_days,
        f"""SELECT {week('activity_date')} AS week, user_email, COUNT(*) AS n, MIN(activity_date) AS first, MAX(activity_date) AS last
FROM logs GROUP BY 1, 2 HAVING COUNT(*) > 15""",
    ),
    "distinct_rows": Query(distinct_pairs, "SELECT DISTINCT actor_type, terminal_type, user_email FROM ide"),
    "union_distinct": Query(user_union, "SELECT user_email FROM editor UNION SELECT user_email FROM ide UNION SELECT user_email FROM logs"),
}
