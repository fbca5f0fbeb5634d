"""The logical tables as SQL, for the oracle, and small SQL fragments."""

from __future__ import annotations

import re

# Parameters that take in the whole of the given tables.
START, END = "1995-01-01", "2001-12-31"
EVENTS_START, EVENTS_END, EVENTS_AS_OF = "2024-01-01", "2024-01-30", "2024-01-30"
AS_OF, ALL_DAYS = "2001-12-31", 2556


def usd(x: str, places: int = 2) -> str:
    return f"CAST(ROUND({x}, {places}) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def sdiv(x: str, y: str) -> str:
    return f"(CAST({x} AS DOUBLE) / NULLIF(CAST({y} AS DOUBLE), 0))"


def pct(x: str, y: str, places: int = 2) -> str:
    return f"ROUND({sdiv(f'({x}) * 100', y)}, {places})"


def week(d: str) -> str:
    return f"({d} - CAST(dayofweek({d}) AS INTEGER))"


def month(d: str) -> str:
    return f"CAST(date_trunc('month', {d}) AS DATE)"


def cents(price: str) -> str:
    return f"CAST(CAST({price} AS DECIMAL(18,2)) * 100 AS BIGINT)"


_EMAIL = "'user' || CAST({} AS VARCHAR) || '@example.com'"
_C = cents("o_totalprice")
_TOOLS = ", ".join(
    f"{_C} % {7 * i} AS {tool}_accepted, {_C} % {3 * i} AS {tool}_rejected"
    for i, tool in enumerate(("edit_tool", "multi_edit_tool", "write_tool", "notebook_edit_tool"), 2)
)
_DESCRIPTION = """CASE l_linenumber WHEN 1 THEN 'Usage - Input Tokens' WHEN 2 THEN 'Usage - Output Tokens'
    WHEN 3 THEN 'Usage - Input Tokens, Cache Hit' WHEN 4 THEN 'Usage - Input Tokens, Cache Write'
    WHEN 5 THEN 'Web Search Usage' WHEN 6 THEN 'Usage - Other' END"""

# In dependency order.
VIEWS = {
    "combined": f"""
SELECT CAST(o_orderdate AS DATE) AS cost_date,
  CASE l_returnflag WHEN 'A' THEN 'claude_api' WHEN 'N' THEN 'claude_code' WHEN 'R' THEN 'cursor' END AS provider,
  CASE WHEN l_linenumber <> 7 THEN {_EMAIL.format('o_custkey')} END AS user_email,
  CASE WHEN l_returnflag <> 'R' THEN p_brand END AS model,
  {_DESCRIPTION} AS description,
  CASE WHEN l_linenumber = 5 THEN 'web_search' ELSE 'tokens' END AS cost_category,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.0002 AS DECIMAL(18,6)) AS amount_usd
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "logs": f"""
SELECT event_id, ts AS activity_timestamp, CAST(ts AS DATE) AS activity_date,
  {_EMAIL.format('user_id')} AS user_email, 'User ' || CAST(user_id AS VARCHAR) AS user_name,
  CASE event_type WHEN 'click' THEN 'conversation_created' WHEN 'view' THEN 'file_uploaded'
    WHEN 'signup' THEN 'project_created' WHEN 'purchase' THEN 'project_document_created' ELSE 'other' END AS event_type,
  CASE event_id % 5 WHEN 0 THEN 'desktop_app' WHEN 1 THEN 'web_claude_ai' WHEN 2 THEN 'ios' WHEN 3 THEN 'android' END AS client_platform,
  CASE WHEN event_type = 'click' THEN 'conv-' || CAST(event_id % 1009 AS VARCHAR) END AS conversation_uuid,
  CASE WHEN event_type IN ('signup', 'purchase') THEN 'proj-' || CAST(event_id % 97 AS VARCHAR) END AS project_uuid
FROM events""",
    "order_logs": f"""
SELECT CAST(o_orderdate AS DATE) AS activity_date,
  CASE WHEN o_orderpriority <> '1-URGENT' THEN {_EMAIL.format('o_custkey')} END AS user_email
FROM orders""",
    "dim_keys": f"""
SELECT 'apikey_' || CAST(c_custkey AS VARCHAR) || suffix AS api_key_id,
  'key-' || CAST(c_custkey AS VARCHAR) || suffix AS api_key_name,
  CASE WHEN c_mktsegment <> 'MACHINERY' THEN UPPER({_EMAIL.format('c_custkey')}) END AS mapped_user_email,
  CASE WHEN n_regionkey <> 4 THEN n_name END AS mapped_team_name
FROM (SELECT *, UNNEST(CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN ['', '_batch'] ELSE [''] END) AS suffix FROM customer) c
JOIN nation ON c_nationkey = n_nationkey""",
    "usage_keys": """
SELECT CAST(l_shipdate AS DATE) AS activity_date, 'org_' || l_returnflag AS organization_id,
  'apikey_' || CAST(l_suppkey AS VARCHAR) AS api_key_id,
  CASE WHEN l_linestatus <> 'O' THEN 'wrkspc_a' END AS workspace_id,
  'model-' || CAST(l_partkey % 5 AS VARCHAR) AS model,
  CAST(l_quantity AS BIGINT) * 100 AS uncached_input_tokens, CAST(l_quantity AS BIGINT) * 20 AS output_tokens,
  CAST(l_quantity AS BIGINT) * l_linenumber AS cache_read_input_tokens,
  CAST(l_linenumber AS BIGINT) AS cache_creation_5m_tokens, CAST(l_linenumber AS BIGINT) * 2 AS cache_creation_1h_tokens,
  CAST(l_linenumber % 2 AS BIGINT) AS web_search_requests
FROM lineitem""",
    "costs": f"""
SELECT CAST(l_shipdate AS DATE) AS activity_date, 'org_' || l_returnflag AS organization_id,
  CASE WHEN l_linestatus <> 'O' THEN 'wrkspc_a' END AS workspace_id,
  'model-' || CAST(l_partkey % 5 AS VARCHAR) AS model,
  CASE l_linenumber % 4 WHEN 1 THEN 'output_tokens' WHEN 2 THEN 'cache_read_input_tokens'
    WHEN 3 THEN 'cache_creation.ephemeral_5m_input_tokens' ELSE 'uncached_input_tokens' END AS token_type,
  CASE WHEN l_linenumber = 5 THEN 'web_search' ELSE 'tokens' END AS cost_type,
  {_DESCRIPTION} AS description,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 0.01 AS DECIMAL(18,6)) AS amount_usd,
  l_shipdate AS ingestion_timestamp
FROM lineitem""",
    "spend": f"""
SELECT snapshot_date, {month('snapshot_date')} AS billing_cycle_start, {_EMAIL.format('user_id')} AS user_email,
  'User ' || CAST(user_id AS VARCHAR) AS user_name, CASE WHEN user_id % 10 = 0 THEN 'admin' ELSE 'member' END AS user_role,
  total - included AS spend_cents, included AS included_spend_cents, total AS total_spend_cents,
  n AS fast_premium_requests, CAST(user_id AS DOUBLE) AS hard_limit_override_dollars
FROM (SELECT user_id, snapshot_date, n,
    CAST(SUM(cents) OVER w AS BIGINT) - CASE WHEN day(snapshot_date) IN (11, 22) THEN 5000 ELSE 0 END AS total,
    CAST(SUM(inc) OVER w AS BIGINT) AS included
  FROM (SELECT user_id, CAST(ts AS DATE) AS snapshot_date, SUM(CAST(ROUND(value * 100) AS BIGINT)) AS cents,
      SUM(CASE WHEN event_type = 'signup' THEN CAST(ROUND(value * 100) AS BIGINT) ELSE 0 END) AS inc, COUNT(*) AS n
    FROM events GROUP BY 1, 2) d
  WINDOW w AS (PARTITION BY user_id, date_trunc('month', snapshot_date) ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING)) s""",
    "editor": f"""
SELECT CAST(l_shipdate AS DATE) AS activity_date,
  CASE WHEN l_linenumber <> 7 THEN {_EMAIL.format('l_partkey')} END AS user_email,
  'u-' || CAST(l_partkey AS VARCHAR) AS user_id, l_returnflag <> 'N' AS is_active,
  q * 10 AS total_lines_added, q * 2 AS total_lines_deleted, q * CASE WHEN l_linenumber = 6 THEN 21 ELSE line * 2 END AS accepted_lines_added, q AS accepted_lines_deleted,
  line AS total_applies, q AS total_accepts, line - 2 AS total_rejects, q * 3 AS total_tabs_shown, q AS total_tabs_accepted,
  line AS composer_requests, q AS chat_requests, CASE WHEN l_linenumber <> 6 THEN line * 2 END AS agent_requests,
  line % 3 AS subscription_included_reqs, q % 7 AS usage_based_reqs,
  CASE WHEN l_linestatus <> 'O' THEN 'model-' || CAST(l_partkey % 5 AS VARCHAR) END AS most_used_model
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS q, CAST(l_linenumber AS BIGINT) AS line FROM lineitem) l""",
    "ide": f"""
SELECT CAST(o_orderdate AS DATE) AS activity_date, 'org_' || o_orderstatus AS organization_id,
  CASE WHEN o_orderstatus = 'P' THEN 'api_actor' ELSE 'user_actor' END AS actor_type,
  CASE WHEN o_orderstatus <> 'P' THEN {_EMAIL.format('o_custkey')} END AS user_email,
  CASE WHEN o_orderstatus = 'P' THEN 'key-' || CAST(o_custkey AS VARCHAR) END AS api_key_name,
  o_orderpriority AS terminal_type, {_C} % 5 + 1 AS num_sessions, {_C} % 1000 AS lines_added, {_C} % 300 AS lines_removed,
  {_C} % 4 AS commits_by_claude_code, {_C} % 2 AS pull_requests_by_claude_code, {_TOOLS},
  {_C} % 100000 AS total_input_tokens, {_C} % 10000 AS total_output_tokens,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.0001 AS DECIMAL(18,6)) AS total_estimated_cost_usd
FROM orders""",
    "incidents": """
SELECT 'INC-' || CAST(event_id AS VARCHAR) AS incident_id, CASE WHEN value > 50 THEN 'P1' ELSE 'P2' END AS severity_level,
  ts AS detection_time, CAST(FLOOR(value) AS INTEGER) AS mttr_minutes, props AS root_cause_category,
  ts + to_minutes(CAST(FLOOR(value) AS BIGINT)) AS resolution_time
FROM events WHERE event_type = 'error'""",
    "key_user": """
SELECT api_key_id, LOWER(MIN(mapped_user_email)) AS user_email FROM dim_keys GROUP BY 1""",
    "name_user": """
SELECT api_key_name, LOWER(MIN(mapped_user_email)) AS key_user FROM dim_keys GROUP BY 1""",
    "fct": f"""
SELECT a.usage_date, 'anthropic' AS platform, k.user_email, a.api_key_id, a.model, input_tokens, output_tokens,
  requests, CAST(0 AS BIGINT) AS sessions, CAST(0 AS BIGINT) AS loc_added, CAST(0 AS BIGINT) AS loc_accepted
FROM (SELECT activity_date AS usage_date, api_key_id, model,
    CAST(SUM(uncached_input_tokens + cache_read_input_tokens) AS BIGINT) AS input_tokens,
    CAST(SUM(output_tokens) AS BIGINT) AS output_tokens, COUNT(*) AS requests FROM usage_keys GROUP BY ALL) a
LEFT JOIN key_user k USING (api_key_id)
UNION ALL
SELECT i.usage_date, 'claude_code', LOWER(COALESCE(i.user_email, n.key_user)), NULL, NULL, input_tokens, output_tokens,
  requests, sessions, loc, loc
FROM (SELECT activity_date AS usage_date, user_email, api_key_name,
    CAST(SUM(total_input_tokens) AS BIGINT) AS input_tokens, CAST(SUM(total_output_tokens) AS BIGINT) AS output_tokens,
    CAST(SUM(edit_tool_accepted + multi_edit_tool_accepted + write_tool_accepted + notebook_edit_tool_accepted
      + edit_tool_rejected + multi_edit_tool_rejected + write_tool_rejected + notebook_edit_tool_rejected) AS BIGINT) AS requests,
    CAST(SUM(num_sessions) AS BIGINT) AS sessions, CAST(SUM(lines_added) AS BIGINT) AS loc FROM ide GROUP BY ALL) i
LEFT JOIN name_user n USING (api_key_name)
UNION ALL
SELECT activity_date, 'cursor', user_email, NULL, most_used_model, 0, 0,
  CAST(SUM(composer_requests + chat_requests + COALESCE(agent_requests, 0)) AS BIGINT), 0,
  CAST(SUM(total_lines_added) AS BIGINT), CAST(SUM(accepted_lines_added) AS BIGINT)
FROM editor GROUP BY activity_date, user_email, most_used_model""",
}


def with_views(sql: str) -> str:
    """Prefix a query with the views it names, and those they name."""
    used: set[str] = set()
    todo = [sql]
    while todo:
        text = todo.pop()
        for name in VIEWS:
            if name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                used.add(name)
                todo.append(VIEWS[name])
    ctes = ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in VIEWS if name in used)
    body = sql.strip()
    if not ctes:
        return body
    if body.upper().startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes},\n{body[len('WITH RECURSIVE'):].strip()}"
    if body.upper().startswith("WITH"):
        return f"WITH {ctes},\n{body[4:].strip()}"
    return f"WITH {ctes}\n{body}"
