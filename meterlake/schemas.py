"""Logical tables: columns, date partition and cluster columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = "decimal(18,6)"


@dataclass(frozen=True)
class Table:
    name: str
    ddl: str
    partition: str | None = None
    cluster: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.ddl)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_TOOL_ACTIONS = """
    edit_tool_accepted bigint, edit_tool_rejected bigint,
    multi_edit_tool_accepted bigint, multi_edit_tool_rejected bigint,
    write_tool_accepted bigint, write_tool_rejected bigint,
    notebook_edit_tool_accepted bigint, notebook_edit_tool_rejected bigint
"""

_IDE_ACTIVITY = f"""
    num_sessions bigint, lines_added bigint, lines_removed bigint,
    commits_by_claude_code bigint, pull_requests_by_claude_code bigint, {_TOOL_ACTIONS}
"""

_EDITOR_ACTIVITY = """
    activity_date date, user_email string, user_id string, is_active boolean,
    total_lines_added bigint, total_lines_deleted bigint,
    accepted_lines_added bigint, accepted_lines_deleted bigint,
    total_applies bigint, total_accepts bigint, total_rejects bigint,
    total_tabs_shown bigint, total_tabs_accepted bigint,
    composer_requests bigint, chat_requests bigint, agent_requests bigint,
    cmdk_usages bigint, bugbot_usages bigint,
    subscription_included_reqs bigint, usage_based_reqs bigint, api_key_reqs bigint,
    most_used_model string, apply_most_used_extension string,
    tab_most_used_extension string, client_version string
"""

_KEY_USAGE = """
    uncached_input_tokens bigint, output_tokens bigint, cache_read_input_tokens bigint,
    cache_creation_5m_tokens bigint, cache_creation_1h_tokens bigint,
    web_search_requests bigint
"""

# model and token_type stay nullable: reports without grouping carry no value.
CLAUDE_COSTS = Table(
    "claude_costs",
    f"""activity_date date, organization_id string, workspace_id string, model string,
    token_type string, cost_type string, amount_usd {MONEY}, currency string,
    description string, service_tier string, context_window string,
    ingestion_timestamp timestamp""",
    "activity_date",
    ("workspace_id", "model", "token_type"),
)

CLAUDE_USAGE_KEYS = Table(
    "claude_usage_keys",
    f"""activity_date date, organization_id string, api_key_id string, workspace_id string,
    model string, {_KEY_USAGE}, ingestion_timestamp timestamp""",
    "activity_date",
    ("api_key_id", "workspace_id", "model"),
)

# Holds no cost or token column: those amounts are already in claude_costs.
CLAUDE_CODE_PRODUCTIVITY = Table(
    "claude_code_productivity",
    f"""activity_date date, organization_id string, actor_type string, user_email string,
    api_key_name string, terminal_type string, customer_type string,
    {_IDE_ACTIVITY}, ingestion_timestamp timestamp""",
    "activity_date",
    ("user_email", "terminal_type"),
)

CLAUDE_APP_USAGE_LOGS = Table(
    "claude_app_usage_logs",
    """activity_timestamp timestamp, activity_date date, user_email string, user_name string,
    user_uuid string, event_type string, event_info string, entity_type string,
    entity_uuid string, conversation_uuid string, project_uuid string,
    client_platform string, device_id string, user_agent string, ip_address string,
    ingestion_timestamp timestamp, data_source string""",
    "activity_date",
    ("user_email", "event_type", "client_platform"),
)

CLAUDE_AI_USAGE_STATS = Table(
    "claude_ai_usage_stats",
    """activity_date date, event_id string, user_email string, user_name string,
    event_type string, conversation_uuid string, project_uuid string,
    client_platform string, ingestion_timestamp timestamp""",
    "activity_date",
    ("user_email", "event_type"),
)

CLAUDE_CODE_USAGE_STATS = Table(
    "claude_code_usage_stats",
    f"""activity_date date, organization_id string, actor_type string, user_email string,
    api_key_name string, terminal_type string, customer_type string,
    subscription_type string, {_IDE_ACTIVITY},
    total_input_tokens bigint, total_output_tokens bigint,
    total_cache_read_tokens bigint, total_cache_creation_tokens bigint,
    total_estimated_cost_usd double, ingestion_timestamp timestamp""",
    "activity_date",
    ("user_email", "terminal_type"),
)

CURSOR_USAGE_STATS = Table(
    "cursor_usage_stats",
    f"""{_EDITOR_ACTIVITY}, estimated_subscription_cost_usd double,
    estimated_overage_cost_usd double, estimated_total_cost_usd double,
    ingestion_timestamp timestamp""",
    "activity_date",
    ("user_email",),
)

CURSOR_DAILY_METRICS = Table(
    "cursor_daily_metrics",
    f"{_EDITOR_ACTIVITY}, ingestion_timestamp timestamp, daily_spend_usd decimal(18,2)",
    "activity_date",
    ("user_email",),
)

CURSOR_SPENDING = Table(
    "cursor_spending",
    """snapshot_date date, billing_cycle_start timestamp, user_email string, user_id string,
    user_name string, user_role string, spend_cents bigint, included_spend_cents bigint,
    total_spend_cents bigint, fast_premium_requests bigint, monthly_limit_dollars double,
    hard_limit_override_dollars double, ingestion_timestamp timestamp""",
    "snapshot_date",
    ("user_email",),
)

# The older name of claude_usage_keys, kept for the efficiency card.
CLAUDE_USAGE_REPORT = Table(
    "claude_usage_report",
    f"""activity_date date, organization_id string, api_key_id string, workspace_id string,
    model string, service_tier string, context_window string, {_KEY_USAGE},
    ingestion_timestamp timestamp""",
    "activity_date",
    ("api_key_id", "workspace_id", "model"),
)

CLAUDE_COST_REPORT = Table(
    "claude_cost_report",
    """activity_date date, organization_id string, workspace_id string, model string,
    cost_type string, token_type string, service_tier string, context_window string,
    description string, currency string, amount_usd decimal(12,6),
    ingestion_timestamp timestamp""",
    "activity_date",
    ("workspace_id", "model", "token_type"),
)

CURSOR_EXPENSES_CALCULATED = Table(
    "cursor_expenses_calculated",
    """activity_date date, user_email string, subscription_included_reqs bigint,
    usage_based_reqs bigint, api_key_reqs bigint, total_requests bigint,
    subscription_cost_usd double, overage_cost_usd double, api_key_cost_usd double,
    total_cost_usd double, subscription_monthly_rate double,
    overage_rate_per_request double, days_in_month bigint,
    calculation_timestamp timestamp""",
    "activity_date",
    ("user_email",),
)

DIM_API_KEYS = Table(
    "dim_api_keys",
    """api_key_id string, api_key_name string, partial_key_hint string, workspace_id string,
    created_at timestamp, status string, created_by_user_id string,
    mapped_user_email string, mapped_team_name string, last_updated timestamp""",
    cluster=("api_key_id",),
)

DIM_WORKSPACES = Table(
    "dim_workspaces",
    """workspace_id string, workspace_name string, display_color string,
    created_at timestamp, archived_at timestamp, last_updated timestamp""",
    cluster=("workspace_id",),
)

DIM_USERS = Table(
    "dim_users",
    """user_id string, email string, first_name string, last_name string, department string,
    is_active boolean, created_at timestamp, updated_at timestamp""",
)

RAW_ANTHROPIC_USAGE = Table(
    "raw_anthropic_usage",
    """ingest_date date, fetched_at timestamp, api_key_id string, workspace_id string,
    model string, uncached_input_tokens bigint, output_tokens bigint,
    cache_read_input_tokens bigint, cache_creation_tokens bigint, service_tier string,
    context_window string, starting_at timestamp, ending_at timestamp""",
    "ingest_date",
    ("api_key_id", "model"),
)

RAW_CURSOR_USAGE = Table(
    "raw_cursor_usage",
    """ingest_date date, fetched_at timestamp, email string, usage_date date,
    total_lines_added bigint, accepted_lines_added bigint, total_accepts bigint,
    total_rejects bigint, subscription_included_reqs bigint, usage_based_reqs bigint,
    most_used_model string, client_version string""",
    "ingest_date",
    ("email", "usage_date"),
)

FCT_USAGE_DAILY = Table(
    "fct_usage_daily",
    """usage_date date, platform string, user_email string, api_key_id string, model string,
    input_tokens bigint, output_tokens bigint, requests bigint, sessions bigint,
    loc_added bigint, loc_accepted bigint, acceptance_rate decimal(5,4),
    processed_at timestamp""",
    "usage_date",
    ("platform", "user_email"),
)

FCT_COST_DAILY = Table(
    "fct_cost_daily",
    f"""cost_date date, platform string, workspace_id string, api_key_id string,
    user_email string, cost_usd {MONEY}, cost_type string, model string,
    processed_at timestamp""",
    "cost_date",
    ("platform", "user_email"),
)

OPERATIONAL_METRICS = Table(
    "operational_metrics",
    """metric_date date, incident_id string, severity_level string, detection_time timestamp,
    acknowledgment_time timestamp, resolution_time timestamp, mttr_minutes int,
    impact_scope string, root_cause_category string""",
    "metric_date",
)

MB_MONTHLY_SUMMARY = Table(
    "mb_monthly_summary",
    """summary_month date, user_email string, total_coding_cost double,
    total_api_cost double, total_assistant_cost double, total_ai_investment double""",
)

# The unified daily cost fact every card reads.
COMBINED_DAILY_COSTS = Table(
    "vw_combined_daily_costs",
    f"""cost_date date, provider string, user_email string, model string,
    description string, cost_category string, amount_usd {MONEY}""",
    "cost_date",
    ("provider", "user_email"),
)

# Daily partials that summaries of longer spans are folded from (``sinks.summaries``).
DAILY_USER_COSTS = Table(
    "daily_user_costs",
    "cost_date date, user_email string, provider string, amount_usd decimal(28,6), rows bigint",
    "cost_date",
    ("user_email",),
)
DAILY_COST_USERS = Table(
    "daily_cost_users", "cost_date date, provider string, part bigint, users binary", "cost_date", ("provider",)
)
DAILY_USER_EVENTS = Table(
    "daily_user_events",
    "activity_date date, user_email string, event_type string, client_platform string, events bigint",
    "activity_date",
    ("user_email",),
)
DAILY_EVENT_USERS = Table(
    "daily_event_users",
    "activity_date date, event_type string, client_platform string, part bigint, users binary",
    "activity_date",
    ("event_type",),
)
DAILY_EVENT_VALUES = Table(
    "daily_event_values",
    "activity_date date, event_type string, client_platform string, name string, part bigint, bits binary",
    "activity_date",
    ("name", "event_type"),
)
# Numbers of the values of other columns, counted up within each ``name``.
VALUE_IDS = Table("value_ids", "first_date date, name string, value string, id bigint", "first_date", ("name", "value"))
# A user keeps the number for good; ``first_date`` is the month of the rows that brought it.
USER_IDS = Table("user_ids", "first_date date, user_email string, id bigint", "first_date", ("user_email",))

# The providers of the combined cost fact.
API, IDE, EDITOR = "claude_api", "claude_code", "cursor"

TABLES = {t.name: t for t in list(globals().values()) if isinstance(t, Table)}
