"""Reports, exports and logs rebuilt as raw text from the tables, then parsed.

Every row becomes its own page or line, so no group is collected to build one.
The file readers share the parsing functions used here; tests cover the files.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake import proxies as P
from meterlake.functions.dates import date_spine
from meterlake.functions.text import parse_literal
from meterlake.operators.filters import filter_day
from meterlake.queries import Query
from meterlake.queries.views import END, START, big, dbl
from meterlake.session import shared_dir
from meterlake.sources import csv_exports as X
from meterlake.sources import json_reports as R
from meterlake.sources import text_files as T
from meterlake.streaming import ingest as ST


def _pages(rows: DataFrame, page: Column, schema: str) -> DataFrame:
    """Through JSON text, as a landed page would be."""
    text = rows.select(F.to_json(page).alias("value"))
    return text.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("p")).select("p.*")


def _bucket(date: str, result: Column) -> Column:
    at = F.concat(F.date_format(date, "yyyy-MM-dd"), F.lit("T00:00:00Z"))
    bucket = F.struct(at.alias("starting_at"), at.alias("ending_at"), F.array(result).alias("results"))
    return F.struct(F.array(bucket).alias("data"), F.lit(False).alias("has_more"))


def cost_pages(s, d) -> DataFrame:
    line = F.col("l_linenumber")
    result = F.struct(
        F.lit("USD").alias("currency"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("amount"),
        F.when(F.col("l_linestatus") == "O", "").otherwise("wrkspc_a").alias("workspace_id"),
        F.when(line == 7, "").when(line != 3, F.concat(F.lit("model-"), F.col("l_returnflag"))).alias("model"),
        F.when(line != 6, F.lit("tokens")).alias("cost_type"),
        F.lit("").alias("token_type"),
        F.when(line == 1, "Usage - Input Tokens, \"Cache\"").alias("description"),
    )
    return _pages(P.load(s, d, "lineitem"), _bucket("l_shipdate", result), R.COST_PAGE)


_COST = f"""
SELECT CAST(l_shipdate AS DATE) AS activity_date, 'org-1' AS organization_id, CASE WHEN l_linestatus <> 'O' THEN 'wrkspc_a' END AS workspace_id,
  CASE WHEN l_linenumber NOT IN (3, 7) THEN 'model-' || l_returnflag END AS model, CAST(NULL AS VARCHAR) AS token_type, 'tokens' AS cost_type,
  {dbl('CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,6))')} AS amount_usd, 'USD' AS currency,
  CASE WHEN l_linenumber = 1 THEN 'Usage - Input Tokens, "Cache"' END AS description,
  CAST(NULL AS VARCHAR) AS service_tier, CAST(NULL AS VARCHAR) AS context_window FROM lineitem"""


def cost_report_scan(s, d) -> DataFrame:
    out = R.cost_rows(cost_pages(s, d), "org-1")
    return out.withColumn("amount_usd", F.col("amount_usd").cast("double"))


def usage_report_scan(s, d) -> DataFrame:
    line, q = F.col("l_linenumber").cast("bigint"), F.col("l_quantity").cast("bigint")
    result = F.struct(
        q.alias("uncached_input_tokens"),
        F.when(line != 2, F.struct(line.alias("ephemeral_5m_input_tokens"))).alias("cache_creation"),
        (q * line).alias("cache_read_input_tokens"),
        F.when(line != 4, q * 20).alias("output_tokens"),
        F.when(line % 2 == 1, F.struct(line.alias("web_search_requests"))).alias("server_tool_use"),
        F.concat(F.lit("apikey_"), F.col("l_suppkey").cast("string")).alias("api_key_id"),
        F.when(F.col("l_linestatus") != "O", "wrkspc_a").alias("workspace_id"),
        F.lit("model-1").alias("model"),
    )
    pages = _pages(P.load(s, d, "lineitem"), _bucket("l_shipdate", result), R.USAGE_PAGE)
    return R.usage_rows(pages, "org-1")


_USAGE = f"""
SELECT CAST(l_shipdate AS DATE) AS activity_date, 'org-1' AS organization_id, 'apikey_' || CAST(l_suppkey AS VARCHAR) AS api_key_id,
  CASE WHEN l_linestatus <> 'O' THEN 'wrkspc_a' END AS workspace_id, 'model-1' AS model, {big('l_quantity')} AS uncached_input_tokens,
  {big('CASE WHEN l_linenumber <> 4 THEN l_quantity * 20 ELSE 0 END')} AS output_tokens, {big('l_quantity * l_linenumber')} AS cache_read_input_tokens,
  {big('CASE WHEN l_linenumber <> 2 THEN l_linenumber ELSE 0 END')} AS cache_creation_5m_tokens, {big('0')} AS cache_creation_1h_tokens,
  {big('CASE WHEN l_linenumber % 2 = 1 THEN l_linenumber ELSE 0 END')} AS web_search_requests FROM lineitem"""


def productivity_scan(s, d) -> DataFrame:
    """Pages that also carry the per-model breakdown, which the reader leaves out."""
    u = P.claude_code_usage_stats(s, d)

    def tool(name: str) -> Column:
        return F.struct(F.col(f"{name}_accepted").alias("accepted"), F.col(f"{name}_rejected").alias("rejected")).alias(name)

    record = F.struct(
        F.concat(F.date_format("activity_date", "yyyy-MM-dd"), F.lit("T00:00:00Z")).alias("date"),
        F.struct(F.col("actor_type").alias("type"), F.col("user_email").alias("email_address"), "api_key_name").alias("actor"),
        "organization_id",
        "terminal_type",
        F.struct(
            "num_sessions",
            F.struct(F.col("lines_added").alias("added"), F.col("lines_removed").alias("removed")).alias("lines_of_code"),
            F.when(F.col("actor_type") == "user_actor", F.col("commits_by_claude_code")).alias("commits_by_claude_code"),
            "pull_requests_by_claude_code",
        ).alias("core_metrics"),
        F.struct(tool("edit_tool"), tool("multi_edit_tool"), tool("write_tool")).alias("tool_actions"),
        F.array(F.struct("total_estimated_cost_usd")).alias("model_breakdown"),
    )
    return R.productivity_rows(_pages(u, F.struct(F.array(record).alias("data")), R.PRODUCTIVITY_PAGE))


_PRODUCTIVITY = """
SELECT activity_date, organization_id, actor_type, user_email, api_key_name, terminal_type, CAST(NULL AS VARCHAR) AS customer_type,
  num_sessions, lines_added, lines_removed, CAST(CASE WHEN actor_type = 'user_actor' THEN commits_by_claude_code ELSE 0 END AS BIGINT) AS commits_by_claude_code,
  pull_requests_by_claude_code, edit_tool_accepted, edit_tool_rejected, multi_edit_tool_accepted, multi_edit_tool_rejected,
  write_tool_accepted, write_tool_rejected, CAST(0 AS BIGINT) AS notebook_edit_tool_accepted, CAST(0 AS BIGINT) AS notebook_edit_tool_rejected FROM ide"""

# Wire fields that the editor proxy fills; the others are absent and take their defaults.
_FILLED = [(w, c) for w, c, *_ in R.TEAM_USAGE_FIELDS if c not in
           ("cmdk_usages", "bugbot_usages", "api_key_reqs", "apply_most_used_extension", "tab_most_used_extension", "client_version")]


def team_usage_pages(s, d) -> DataFrame:
    u = P.cursor_usage_stats(s, d)
    record = F.struct(F.date_format("activity_date", "yyyy-MM-dd").alias("day"), *[F.col(c).alias(w) for w, c in _FILLED])
    return _pages(u, F.struct(F.array(record).alias("data")), R.TEAM_USAGE_PAGE)


_TEAM_COLS = ", ".join(
    c if c in ("user_email", "user_id", "is_active")
    else f"COALESCE({c}, {'0' if t == 'bigint' else repr('')}) AS {c}" if (c in {x for _, x in _FILLED})
    else f"CAST({'0' if t == 'bigint' else repr('')} AS {'BIGINT' if t == 'bigint' else 'VARCHAR'}) AS {c}"
    for _, c, t, _ in R.TEAM_USAGE_FIELDS
)


def spend_scan(s, d) -> DataFrame:
    snap = P.spend_snapshots(s, d)
    member = F.struct(
        F.when(F.col("user_role") == "member", F.col("user_email")).alias("email"), F.col("spend_cents").alias("spendCents"),
        F.col("included_spend_cents").alias("includedSpendCents"), F.col("user_name").alias("name"), F.col("user_role").alias("role"),
    )
    start = F.unix_millis(F.col("billing_cycle_start").cast("timestamp"))
    page = F.struct(F.array(member).alias("teamMemberSpend"), start.alias("subscriptionCycleStart"), F.col("snapshot_date").alias("day"))
    text = snap.select(F.to_json(page).alias("value"))
    parsed = text.select(F.from_json("value", f"{R.SPEND_PAGE}, day date", {"mode": "FAILFAST"}).alias("p")).select("p.*")
    rows = R.spend_rows(parsed, F.col("day"))
    return rows.withColumn("billing_cycle_start", F.col("billing_cycle_start").cast("date"))


_SPEND = """
SELECT snapshot_date, billing_cycle_start, user_email, user_name, user_role, spend_cents, included_spend_cents, total_spend_cents,
  CAST(0 AS BIGINT) AS fast_premium_requests, CAST(NULL AS DOUBLE) AS hard_limit_override_dollars FROM spend WHERE user_role = 'member'"""


def raw_activity(s, d) -> DataFrame:
    """Audit export rows whose info columns are Python dict literals.

    The events are dealt out first: parsing costs far more than reading, and a
    file has few splits.
    """
    e = P.load(s, d, "events").select("event_id", "ts", "user_id", "event_type").repartition("event_id")
    uid, eid = F.col("user_id").cast("string"), F.col("event_id").cast("string")
    is_chat = F.col("event_type") == "click"
    email = F.when(F.col("event_type") == "error", "None").otherwise(F.concat(F.lit("'user"), uid, F.lit("@example.com'")))
    name = F.when(F.col("user_id") % 3 == 0, F.concat(F.lit('"O\'Neil '), uid, F.lit('"'))).otherwise(F.concat(F.lit("'None "), uid, F.lit("'")))
    project = F.when(F.col("event_type").isin("signup", "purchase"), F.concat(F.lit("'proj-"), (F.col("event_id") % 97).cast("string"), F.lit("'"))).otherwise("None")
    return e.select(
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("created_at"),
        F.col("event_type").alias("event"),
        F.concat(F.lit("{'name': "), name, F.lit(", 'uuid': 'u-"), uid, F.lit("', 'metadata': {'email_address': "), email, F.lit("}}")).alias("actor_info"),
        F.when(F.col("event_type") == "view", "{broken").otherwise(
            F.concat(F.lit("{'type': '"), F.when(is_chat, "chat_conversation").otherwise("chat_project"), F.lit("', 'uuid': 'e-"), eid, F.lit("', 'metadata': {'project_uuid': "), project, F.lit("}}"))
        ).alias("entity_info"),
        F.when(is_chat, F.concat(F.lit("{'k': True, 'n': None, 'id': "), eid, F.lit(", 'note': 'it\\'s \"None\"'}"))).otherwise("{}").alias("event_info"),
        F.when(F.col("event_id") % 5 == 4, "").otherwise("ios").alias("client_platform"),
        F.lit("").alias("device_id"),
        F.lit("agent").alias("user_agent"),
        F.lit(None).cast("string").alias("ip_address"),
    )


def app_log_transform(s, d) -> DataFrame:
    out = X.app_usage_rows(raw_activity(s, d))
    return out.withColumn("activity_timestamp", F.date_format("activity_timestamp", "yyyy-MM-dd HH:mm:ss"))


_APP = """
SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS activity_timestamp, CAST(ts AS DATE) AS activity_date, 'user' || CAST(user_id AS VARCHAR) || '@example.com' AS user_email,
  CASE WHEN user_id % 3 = 0 THEN 'O''Neil ' ELSE 'None ' END || CAST(user_id AS VARCHAR) AS user_name, 'u-' || CAST(user_id AS VARCHAR) AS user_uuid,
  event_type, CASE WHEN event_type = 'click' THEN '{"id":' || CAST(event_id AS VARCHAR) || ',"k":true,"n":null,"note":"it''s \\"None\\""}' END AS event_info,
  CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'chat_conversation' ELSE 'chat_project' END AS entity_type,
  CASE WHEN event_type <> 'view' THEN 'e-' || CAST(event_id AS VARCHAR) END AS entity_uuid,
  CASE WHEN event_type = 'click' THEN 'e-' || CAST(event_id AS VARCHAR) END AS conversation_uuid,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'proj-' || CAST(event_id % 97 AS VARCHAR) END AS project_uuid,
  CASE WHEN event_id % 5 <> 4 THEN 'ios' END AS client_platform, CAST(NULL AS VARCHAR) AS device_id, 'agent' AS user_agent,
  CAST(NULL AS VARCHAR) AS ip_address, 'claude_activity_export' AS data_source FROM events WHERE event_type <> 'error'"""


def activity_csv_scan(s, d) -> DataFrame:
    """Rows written as CSV lines with quoted, doubled-quote cells and parsed back."""
    raw = raw_activity(s, d)
    opts = {"escape": '"', "quoteAll": "true", "nullValue": "\\N", "emptyValue": ""}
    text = raw.select(F.to_csv(F.struct(*raw.columns), opts).alias("value"))
    parsed = text.select(F.from_csv("value", X.ACTIVITY_CSV, {"escape": '"', "nullValue": "\\N", "emptyValue": ""}).alias("r")).select("r.*")
    return X.skipped_rows(parsed)


def literal_parse(s, d) -> DataFrame:
    raw = raw_activity(s, d).select(parse_literal("actor_info", "name string, uuid string, metadata struct<email_address: string>").alias("a"))
    return raw.groupBy(F.col("a.name").alias("name"), F.col("a.metadata.email_address").alias("email")).agg(F.count(F.lit(1)).alias("n"))


def key_mapping_scan(s, d) -> DataFrame:
    c = P.load(s, d, "customer")
    key = F.col("c_custkey").cast("string")
    kind = F.when(F.col("c_mktsegment") == "BUILDING", "cursor-dev-").when(F.col("c_mktsegment") == "MACHINERY", "claude-ide-").otherwise("shared-")
    raw = c.select(
        F.concat(kind, key).alias("api_key_name"),
        F.concat(F.lit(" User"), key, F.lit("@Example.com")).alias("email"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "Team Cursor key").otherwise("Production key").alias("description"),
    )
    return X.key_mapping_rows(raw)


_KEYS = """
SELECT CASE c_mktsegment WHEN 'BUILDING' THEN 'cursor-dev-' WHEN 'MACHINERY' THEN 'claude-ide-' ELSE 'shared-' END || CAST(c_custkey AS VARCHAR) AS api_key_name,
  'user' || CAST(c_custkey AS VARCHAR) || '@example.com' AS user_email,
  CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'Team Cursor key' ELSE 'Production key' END AS description,
  CASE WHEN c_mktsegment IN ('BUILDING', 'HOUSEHOLD') THEN 'cursor' ELSE 'anthropic' END AS platform FROM customer"""


def team_csv_scan(s, d) -> DataFrame:
    c = P.load(s, d, "customer")
    key = F.col("c_custkey").cast("string")
    cents = F.abs(F.col("c_acctbal")).cast("decimal(18,2)")
    raw = c.select(
        F.when(F.col("c_mktsegment") == "MACHINERY", F.concat(F.lit("key-"), key, F.lit(" [API key]")))
        .otherwise(F.concat(F.lit("user"), key, F.lit("@example.com"))).alias("user"),
        F.concat(F.lit("$"), F.format_number(cents, 2)).alias("spend"),
        F.format_number(F.col("c_custkey") * 37, 0).alias("lines"),
    )
    return X.team_rows(raw).withColumn("spend_usd", F.col("spend_usd").cast("double"))


_TEAM = f"""
SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN 'api_key' ELSE 'user' END AS actor_kind,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'user' || CAST(c_custkey AS VARCHAR) || '@example.com' END AS user_email,
  CASE WHEN c_mktsegment = 'MACHINERY' THEN 'key-' || CAST(c_custkey AS VARCHAR) END AS api_key_name,
  {dbl('CAST(ABS(c_acctbal) AS DECIMAL(18,2))')} AS spend_usd, {big('c_custkey * 37')} AS lines FROM customer"""


def run_log(s, d) -> DataFrame:
    """A run log: a line per order, failed for urgent ones of one status."""
    o = P.load(s, d, "orders")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    failed = (F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderstatus") == "F")
    return o.select(
        F.when(failed, F.concat(F.lit("ERROR ❌ FAILED: "), day, F.lit(" - timeout"))).otherwise(F.concat(F.lit("✅ SUCCESS: "), day)).alias("value")
    )


def date_list_scan(s, d) -> DataFrame:
    o = P.load(s, d, "orders")
    line = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), F.date_format("o_orderdate", "yyyy-MM-dd")))
    return T.date_list(o.select(line.alias("value"))).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


def day_rows(s, d) -> DataFrame:
    rows = R.team_usage_rows(team_usage_pages(s, d))
    return filter_day(rows, "1999-03-01").groupBy("activity_date", "user_id").agg(F.sum("chat_requests").alias("chat_requests"))


def spine_scan(s, d) -> DataFrame:
    bounds = P.claude_costs(s, d).agg(F.min("activity_date").alias("lo"), F.max("activity_date").alias("hi"))
    return date_spine(s, bounds.select("lo").scalar(), bounds.select("hi").scalar())


def hourly_event_counts(s, d) -> DataFrame:
    """The event log as a stream, closed: windows passed by the watermark, and those still open when it had caught up.

    A third of the ids land again in a second run, twenty minutes later by their
    time, so that many fall into the next window; none counts twice.
    """
    events = P.load(s, d, "events")
    landing, out, state = (shared_dir(s, f"hourly-{n}") for n in ("in", "out", "state"))
    again = events.where("event_id % 3 = 0").withColumn("ts", F.col("ts") + F.expr("INTERVAL 20 MINUTES"))
    for rows in (events, again):
        rows.write.mode("append").parquet(landing)
        counts = ST.run_to_parquet(ST.hourly_event_counts(s.readStream.schema(events.schema).parquet(landing)), out, state)
    out = ST.with_open_windows(counts, state)
    return out.select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "event_type", "events")


def ingest_stream(s, d) -> DataFrame:
    """Cost pages landed as files, loaded by the stream, summed per day; all land again in a second run, with a page cut short."""
    landing, out, state = (shared_dir(s, f"ingest-{n}") for n in ("in", "out", "state"))
    line = P.load(s, d, "lineitem")
    result = F.struct(F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("amount"), F.lit("m").alias("model"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("description"))

    def texts(rows: DataFrame) -> DataFrame:
        return rows.select(_bucket("l_shipdate", result).alias("p")).select(F.to_json("p").alias("value"))

    def to_rows(pages: DataFrame) -> DataFrame:
        return R.cost_rows(pages, "org-1")

    day = F.to_date("l_shipdate")
    first = line.where(day.isNull() | (day == line.agg(F.min(day).alias("lo")).select("lo").scalar()))  # their texts sort first
    pages = texts(line)
    for _ in range(2):
        # Files that are not split, so each has about as much text as a split.
        pages.write.mode("append").option("compression", "gzip").option("maxRecordsPerFile", 500_000).text(landing)
        ST.ingest_stream(s, landing, out, state, R.COST_PAGE, to_rows, multi_line=False, partition=None)
        pages = pages.unionByName(texts(first).orderBy("value").limit(1).select(F.substring("value", 1, 40).alias("value")))
    return s.read.parquet(out).groupBy("activity_date").agg(
        F.sum("amount_usd").cast("double").alias("amount_usd"), F.count(F.lit(1)).alias("rows")
    )


QUERIES = {
    "cost_report_scan": Query(cost_report_scan, _COST),
    "usage_report_scan": Query(usage_report_scan, _USAGE),
    "productivity_scan": Query(productivity_scan, _PRODUCTIVITY),
    "team_usage_scan": Query(
        lambda s, d: R.team_usage_rows(team_usage_pages(s, d), START, END),
        f"SELECT activity_date, {_TEAM_COLS} FROM editor WHERE activity_date BETWEEN DATE '{START}' AND DATE '{END}'",
    ),
    "filter_day": Query(
        day_rows,
        f"SELECT activity_date, user_id, {big('SUM(chat_requests)')} AS chat_requests FROM editor WHERE activity_date = DATE '1999-03-01' GROUP BY 1, 2",
    ),
    "spend_scan": Query(spend_scan, _SPEND),
    "activity_csv_scan": Query(
        activity_csv_scan,
        "SELECT COUNT(*) FILTER (event_type <> 'error') AS kept, COUNT(*) FILTER (event_type = 'error') AS skipped FROM events",
    ),
    "literal_parse": Query(
        literal_parse,
        """SELECT CASE WHEN user_id % 3 = 0 THEN 'O''Neil ' ELSE 'None ' END || CAST(user_id AS VARCHAR) AS name,
  CASE WHEN event_type <> 'error' THEN 'user' || CAST(user_id AS VARCHAR) || '@example.com' END AS email, COUNT(*) AS n FROM events GROUP BY 1, 2""",
    ),
    "app_log_transform": Query(app_log_transform, _APP),
    "key_mapping_scan": Query(key_mapping_scan, _KEYS),
    "team_csv_scan": Query(team_csv_scan, _TEAM),
    "failed_dates": Query(
        lambda s, d: T.failed_dates(run_log(s, d)),
        "SELECT DISTINCT CAST(o_orderdate AS DATE) AS date FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'",
    ),
    "date_list": Query(
        date_list_scan, "SELECT CAST(o_orderdate AS DATE) AS date, COUNT(*) AS n FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1"
    ),
    "date_spine": Query(
        spine_scan,
        "SELECT CAST(s AS DATE) AS date FROM generate_series((SELECT MIN(activity_date) FROM costs), (SELECT MAX(activity_date) FROM costs), INTERVAL 1 DAY) g(s)",
    ),
    "hourly_event_counts": Query(
        hourly_event_counts,
        """SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, event_type, COUNT(*) AS events FROM events
GROUP BY 1, 2""",
    ),
    "ingest_stream": Query(
        ingest_stream,
        f"""SELECT CAST(l_shipdate AS DATE) AS activity_date, {dbl('SUM(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,6)))')} AS amount_usd,
  COUNT(*) AS rows FROM lineitem GROUP BY 1""",
    ),
}
