"""The logical tables expressed over a TPC-H-like star and an event log.

Used by the registered queries and the bench. Amounts are DECIMAL products, so
Spark and DuckDB agree to the last digit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _price(col: str = "l_extendedprice") -> Column:
    return F.col(col).cast("decimal(18,2)")


def _email(key: str) -> Column:
    return F.concat(F.lit("user"), F.col(key).cast("string"), F.lit("@example.com"))


def _pick(col: str, values: dict, default=None) -> Column:
    out = F
    for key, value in values.items():
        out = out.when(F.col(col) == key, value)
    return out.otherwise(F.lit(default))


# How codes of the star stand for values of the logical tables.
PROVIDERS = {"A": "claude_api", "N": "claude_code", "R": "cursor"}
DESCRIPTIONS = {
    1: "Usage - Input Tokens",
    2: "Usage - Output Tokens",
    3: "Usage - Input Tokens, Cache Hit",
    4: "Usage - Input Tokens, Cache Write",
    5: "Web Search Usage",
    6: "Usage - Other",
}
EVENT_TYPES = {
    "click": "conversation_created",
    "view": "file_uploaded",
    "signup": "project_created",
    "purchase": "project_document_created",
}
PLATFORMS = {0: "desktop_app", 1: "web_claude_ai", 2: "ios", 3: "android"}
TOKEN_TYPES = {
    1: "output_tokens",
    2: "cache_read_input_tokens",
    3: "cache_creation.ephemeral_5m_input_tokens",
    0: "uncached_input_tokens",
}


def combined_daily_costs(spark: SparkSession, sf_dir: str, with_model: bool = False) -> DataFrame:
    """lineitem ⋈ orders, and ⋈ part only for queries that need the model."""
    rows = load(spark, sf_dir, "lineitem").join(
        load(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    model = F.lit(None).cast("string")
    if with_model:
        rows = rows.join(load(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        model = F.when(F.col("l_returnflag") != "R", F.col("p_brand"))
    return rows.select(
        F.col("o_orderdate").cast("date").alias("cost_date"),
        _pick("l_returnflag", PROVIDERS).alias("provider"),
        F.when(F.col("l_linenumber") != 7, _email("o_custkey")).alias("user_email"),
        model.alias("model"),
        _pick("l_linenumber", DESCRIPTIONS).alias("description"),
        F.when(F.col("l_linenumber") == 5, "web_search").otherwise("tokens").alias("cost_category"),
        (_price() * F.lit("0.0002").cast("decimal(5,4)")).cast("decimal(18,6)").alias("amount_usd"),
    )


def app_usage_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    project = F.when(
        F.col("event_type").isin("signup", "purchase"), F.concat(F.lit("proj-"), (F.col("event_id") % 97).cast("string"))
    )
    conversation = F.when(F.col("event_type") == "click", F.concat(F.lit("conv-"), (F.col("event_id") % 1009).cast("string")))
    return load(spark, sf_dir, "events").select(
        "event_id",
        F.col("ts").alias("activity_timestamp"),
        F.col("ts").cast("date").alias("activity_date"),
        _email("user_id").alias("user_email"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("user_name"),
        _pick("event_type", EVENT_TYPES, "other").alias("event_type"),
        F.when(F.col("event_id") % 5 == 0, "desktop_app")
        .when(F.col("event_id") % 5 == 1, "web_claude_ai")
        .when(F.col("event_id") % 5 == 2, "ios")
        .when(F.col("event_id") % 5 == 3, "android")
        .alias("client_platform"),
        conversation.alias("conversation_uuid"),
        project.alias("project_uuid"),
    )


def order_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sparse activity log: customers are active in the weeks of their orders."""
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("activity_date"),
        F.when(F.col("o_orderpriority") != "1-URGENT", _email("o_custkey")).alias("user_email"),
    )


def dim_api_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A key per customer, a second one for one segment, some users or teams unmapped."""
    customers = load(spark, sf_dir, "customer").join(
        load(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")
    )
    keys = F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.array(F.lit(""), F.lit("_batch"))).otherwise(F.array(F.lit("")))
    return customers.withColumn("suffix", F.explode(keys)).select(
        F.concat(F.lit("apikey_"), F.col("c_custkey").cast("string"), "suffix").alias("api_key_id"),
        F.concat(F.lit("key-"), F.col("c_custkey").cast("string"), "suffix").alias("api_key_name"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.upper(_email("c_custkey"))).alias("mapped_user_email"),
        F.when(F.col("n_regionkey") != 4, F.col("n_name")).alias("mapped_team_name"),
    )


def dim_workspaces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A workspace per return flag; the facts name one of them."""
    flags = load(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    return flags.select(
        F.concat(F.lit("wrkspc_"), F.lower("l_returnflag")).alias("workspace_id"),
        F.concat(F.lit("Workspace "), "l_returnflag").alias("workspace_name"),
    )


def _quantity() -> Column:
    return F.col("l_quantity").cast("bigint")


def _workspace() -> Column:
    return F.when(F.col("l_linestatus") != "O", "wrkspc_a")


def _model() -> Column:
    return F.concat(F.lit("model-"), (F.col("l_partkey") % 5).cast("string"))


def usage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber").cast("bigint")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("activity_date"),
        F.concat(F.lit("org_"), "l_returnflag").alias("organization_id"),
        F.concat(F.lit("apikey_"), F.col("l_suppkey").cast("string")).alias("api_key_id"),
        _workspace().alias("workspace_id"),
        _model().alias("model"),
        (_quantity() * 100).alias("uncached_input_tokens"),
        (_quantity() * 20).alias("output_tokens"),
        (_quantity() * line).alias("cache_read_input_tokens"),
        line.alias("cache_creation_5m_tokens"),
        (line * 2).alias("cache_creation_1h_tokens"),
        (line % 2).alias("web_search_requests"),
    )


def claude_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    token_type = F.when(F.col("l_linenumber") % 4 == 1, TOKEN_TYPES[1])
    for i in (2, 3):
        token_type = token_type.when(F.col("l_linenumber") % 4 == i, TOKEN_TYPES[i])
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("activity_date"),
        F.concat(F.lit("org_"), "l_returnflag").alias("organization_id"),
        _workspace().alias("workspace_id"),
        _model().alias("model"),
        token_type.otherwise(TOKEN_TYPES[0]).alias("token_type"),
        F.when(F.col("l_linenumber") == 5, "web_search").otherwise("tokens").alias("cost_type"),
        _pick("l_linenumber", DESCRIPTIONS).alias("description"),
        (_price() * F.lit("0.01").cast("decimal(3,2)")).cast("decimal(18,6)").alias("amount_usd"),
        F.col("l_shipdate").cast("timestamp").alias("ingestion_timestamp"),
    )


def spend_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cumulative spend per user and month, with a drop on the 11th and 22nd."""
    from pyspark.sql import Window

    events = load(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("bigint")
    daily = events.groupBy("user_id", F.col("ts").cast("date").alias("snapshot_date")).agg(
        F.sum(cents).alias("cents"),
        F.sum(F.when(F.col("event_type") == "signup", cents).otherwise(0)).alias("included"),
        F.count(F.lit(1)).alias("n"),
    )
    cycle = F.trunc("snapshot_date", "MM")
    w = Window.partitionBy("user_id", cycle).orderBy("snapshot_date").rowsBetween(Window.unboundedPreceding, 0)
    drop = F.when(F.dayofmonth("snapshot_date").isin(11, 22), 5000).otherwise(0)
    total, included = F.sum("cents").over(w) - drop, F.sum("included").over(w)
    return daily.select(
        "snapshot_date",
        cycle.alias("billing_cycle_start"),
        _email("user_id").alias("user_email"),
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("user_name"),
        F.when(F.col("user_id") % 10 == 0, "admin").otherwise("member").alias("user_role"),
        (total - included).cast("bigint").alias("spend_cents"),
        included.cast("bigint").alias("included_spend_cents"),
        total.cast("bigint").alias("total_spend_cents"),
        F.col("n").alias("fast_premium_requests"),
        (F.col("user_id") * 1.0).alias("hard_limit_override_dollars"),
    )


def cursor_usage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, line = _quantity(), F.col("l_linenumber").cast("bigint")
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_shipdate").cast("date").alias("activity_date"),
        F.when(F.col("l_linenumber") != 7, _email("l_partkey")).alias("user_email"),
        F.concat(F.lit("u-"), F.col("l_partkey").cast("string")).alias("user_id"),
        (F.col("l_returnflag") != "N").alias("is_active"),
        (q * 10).alias("total_lines_added"),
        (q * 2).alias("total_lines_deleted"),
        (q * F.when(F.col("l_linenumber") == 6, F.lit(21)).otherwise(line * 2)).alias("accepted_lines_added"),
        q.alias("accepted_lines_deleted"),
        line.alias("total_applies"),
        q.alias("total_accepts"),
        (line - 2).alias("total_rejects"),
        (q * 3).alias("total_tabs_shown"),
        q.alias("total_tabs_accepted"),
        line.alias("composer_requests"),
        q.alias("chat_requests"),
        F.when(F.col("l_linenumber") != 6, line * 2).alias("agent_requests"),
        (line % 3).alias("subscription_included_reqs"),
        (q % 7).alias("usage_based_reqs"),
        F.when(F.col("l_linestatus") != "O", _model()).alias("most_used_model"),
    )


def claude_code_usage_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    cents = (_price("o_totalprice") * 100).cast("bigint")
    tools = {}
    for i, tool in enumerate(("edit_tool", "multi_edit_tool", "write_tool", "notebook_edit_tool"), 2):
        tools[f"{tool}_accepted"], tools[f"{tool}_rejected"] = cents % (7 * i), cents % (3 * i)
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderdate").cast("date").alias("activity_date"),
        F.concat(F.lit("org_"), "o_orderstatus").alias("organization_id"),
        F.when(F.col("o_orderstatus") == "P", "api_actor").otherwise("user_actor").alias("actor_type"),
        F.when(F.col("o_orderstatus") != "P", _email("o_custkey")).alias("user_email"),
        F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("key-"), F.col("o_custkey").cast("string"))).alias("api_key_name"),
        F.col("o_orderpriority").alias("terminal_type"),
        (cents % 5 + 1).alias("num_sessions"),
        (cents % 1000).alias("lines_added"),
        (cents % 300).alias("lines_removed"),
        (cents % 4).alias("commits_by_claude_code"),
        (cents % 2).alias("pull_requests_by_claude_code"),
        *[c.alias(name) for name, c in tools.items()],
        (cents % 100000).alias("total_input_tokens"),
        (cents % 10000).alias("total_output_tokens"),
        (_price("o_totalprice") * F.lit("0.0001").cast("decimal(5,4)")).cast("decimal(18,6)").alias("total_estimated_cost_usd"),
    )


def claude_code_productivity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return claude_code_usage_stats(spark, sf_dir).drop("total_input_tokens", "total_output_tokens", "total_estimated_cost_usd")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error event as an incident that takes its value in minutes to resolve."""
    minutes = F.floor("value").cast("int")
    ts = F.col("ts").cast("timestamp")
    return load(spark, sf_dir, "events").filter(F.col("event_type") == "error").select(
        ts.cast("date").alias("metric_date"),
        F.concat(F.lit("INC-"), F.col("event_id").cast("string")).alias("incident_id"),
        F.when(F.col("value") > 50, "P1").otherwise("P2").alias("severity_level"),
        ts.alias("detection_time"),
        (ts + F.make_dt_interval(mins=minutes)).alias("resolution_time"),
        minutes.alias("mttr_minutes"),
        F.col("props").alias("root_cause_category"),
    )
