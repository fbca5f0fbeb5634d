"""Spend deltas, cost allocation, request pricing and the daily star."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, day, days_in_month
from meterlake.functions.numbers import safe_divide
from meterlake.functions.text import backfill_user_id
from meterlake.operators.aggregates import union_all
from meterlake.operators.filters import between_dates
from meterlake.operators.joins import join_totals, lookup

# --- cumulative snapshots to daily deltas -----------------------------------

# Fixed value: a drop of at most one cent is kept as rounding.
TOLERANCE_CENTS = 1


def _daily_cumulative(snapshots: DataFrame) -> DataFrame:
    """One cumulative value in cents per user, cycle and day.

    Repeated snapshots of a day (a member listed on two pages) count once. This
    also bounds a (user, cycle) group by the days of a billing cycle.
    """
    rows = snapshots.filter(F.nullif("user_email", F.lit("")).isNotNull())
    return rows.groupBy("user_email", "billing_cycle_start", "snapshot_date").agg(
        F.max("total_spend_cents").alias("cents")
    )


def _usd_from_cents(cents: str | Column) -> Column:
    c = F.col(cents) if isinstance(cents, str) else cents
    return (c.cast("decimal(18,2)") / 100).cast("decimal(18,2)")


def spend_deltas(snapshots: DataFrame) -> DataFrame:
    """Daily spend of every user and cycle from cumulative snapshots.

    A day's delta is the snapshot minus the sum of the deltas before it in the
    cycle. A drop of more than a cent becomes 0 and leaves that sum unchanged,
    so the fold carries the running sum in exact integer cents.
    """
    per_cycle = _daily_cumulative(snapshots).groupBy("user_email", "billing_cycle_start").agg(
        F.sort_array(F.collect_list(F.struct("snapshot_date", "cents"))).alias("days")
    )

    def step(acc: Column, d: Column) -> Column:
        raw = d["cents"] - acc["prev"]
        delta = F.when(raw < -TOLERANCE_CENTS, F.lit(0)).otherwise(raw).cast("bigint")
        entry = F.struct(d["snapshot_date"].alias("snapshot_date"), delta.alias("delta"))
        return F.struct((acc["prev"] + delta).alias("prev"), F.concat(acc["out"], F.array(entry)).alias("out"))

    start = F.struct(
        F.lit(0).cast("bigint").alias("prev"),
        F.array().cast("array<struct<snapshot_date:date,delta:bigint>>").alias("out"),
    )
    folded = per_cycle.select(
        "user_email", "billing_cycle_start", F.explode(F.aggregate("days", start, step)["out"]).alias("e")
    )
    return folded.select(
        F.col("e.snapshot_date").alias("activity_date"),
        "user_email",
        "billing_cycle_start",
        _usd_from_cents("e.delta").alias("daily_spend_usd"),
    )


def spend_deltas_running_max(snapshots: DataFrame) -> DataFrame:
    """The same with no tolerance: the increase of the running maximum."""
    w = Window.partitionBy("user_email", "billing_cycle_start").orderBy("snapshot_date")
    top = F.greatest(F.max("cents").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    before = F.greatest(F.coalesce(F.max("cents").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)), F.lit(0))
    return _daily_cumulative(snapshots).select(
        F.col("snapshot_date").alias("activity_date"),
        "user_email",
        "billing_cycle_start",
        _usd_from_cents(top - before).alias("daily_spend_usd"),
    )


def spend_deltas_for_day(snapshots: DataFrame, metrics: DataFrame, cycle_start: Day, target: Day) -> DataFrame:
    """One day's deltas against the deltas already stored in the cycle.

    One grouped sum over the stored days replaces a query per user.
    """
    stored = metrics.filter((F.col("activity_date") >= day(cycle_start)) & (F.col("activity_date") < day(target)))
    previous = stored.groupBy("user_email").agg(F.sum(F.round(F.col("daily_spend_usd") * 100)).cast("bigint").alias("prev"))
    today = _daily_cumulative(snapshots.filter(F.col("snapshot_date") == day(target)))
    today = today.groupBy("user_email").agg(F.max("cents").alias("cents"))
    delta = F.col("cents") - F.coalesce("prev", F.lit(0))
    return today.join(previous, "user_email", "left").select(
        day(target).alias("activity_date"),
        "user_email",
        _usd_from_cents(F.when(delta < -TOLERANCE_CENTS, 0).otherwise(delta)).alias("daily_spend_usd"),
    )


def apply_spend(metrics: DataFrame, deltas: DataFrame, target: Day | None = None) -> DataFrame:
    """Set ``daily_spend_usd`` of rows that have a delta; other rows keep theirs.

    Deltas of users without a row that day add no row.
    """
    new = deltas.select("activity_date", "user_email", F.col("daily_spend_usd").alias("_new"), F.lit(True).alias("_hit"))
    if target is not None:
        metrics, new = metrics.filter(F.col("activity_date") == day(target)), new.filter(F.col("activity_date") == day(target))
    joined = metrics.join(new, ["activity_date", "user_email"], "left")
    spend = F.when(F.col("_hit"), F.col("_new")).otherwise(F.col("daily_spend_usd"))
    return joined.withColumn("daily_spend_usd", spend.cast("decimal(18,2)")).select(*metrics.columns)


# Fixed values of synthetic spend rows: ten cents per request beyond the plan.
CENTS_PER_REQUEST = 10
BACKFILL_LIMIT_USD = 1000.0


def backfill_spend(usage: DataFrame, start: Day, end: Day, cycle_start: str) -> DataFrame:
    """Synthetic spend rows for [start, end) from billable request counts."""
    cents = (F.col("usage_based_reqs") * CENTS_PER_REQUEST).cast("bigint")
    rows = usage.filter((F.col("activity_date") >= day(start)) & (F.col("activity_date") < day(end)))
    return rows.select(
        F.col("activity_date").alias("snapshot_date"),
        F.lit(cycle_start).cast("timestamp").alias("billing_cycle_start"),
        "user_email",
        backfill_user_id("user_email").alias("user_id"),
        F.lit(None).cast("string").alias("user_name"),
        F.lit("member").alias("user_role"),
        cents.alias("spend_cents"),
        F.lit(0).cast("bigint").alias("included_spend_cents"),
        cents.alias("total_spend_cents"),
        F.lit(0).cast("bigint").alias("fast_premium_requests"),
        F.lit(None).cast("double").alias("monthly_limit_dollars"),
        F.lit(BACKFILL_LIMIT_USD).alias("hard_limit_override_dollars"),
    )


def estimated_spend(usage: DataFrame, start: Day, rate: float = 0.10) -> DataFrame:
    return usage.filter(F.col("activity_date") >= day(start)).select(
        "activity_date",
        "user_email",
        "usage_based_reqs",
        (F.col("usage_based_reqs") * F.lit(str(rate)).cast("decimal(9,4)")).cast("double").alias("estimated_spend_usd"),
    )


def request_cost_model(usage: DataFrame, base: float = 20.0, rate: float = 0.05) -> DataFrame:
    """Plan price spread over the month's days, plus a price per request beyond the plan."""
    days = days_in_month("activity_date")
    subscription = F.lit(float(base)) / days
    overage = F.coalesce("usage_based_reqs", F.lit(0)) * F.lit(float(rate))
    return usage.select(
        "activity_date",
        "user_email",
        F.coalesce("subscription_included_reqs", F.lit(0)).alias("subscription_included_reqs"),
        F.coalesce("usage_based_reqs", F.lit(0)).alias("usage_based_reqs"),
        F.round(subscription, 6).alias("subscription_cost_usd"),
        F.round(overage, 6).alias("overage_cost_usd"),
        F.round(subscription + overage, 6).alias("total_cost_usd"),
        days.cast("bigint").alias("days_in_month"),
    )


# --- cost allocation ---------------------------------------------------------

TOKEN_KINDS = [
    "uncached_input_tokens",
    "output_tokens",
    "cache_read_input_tokens",
    "cache_creation_5m_tokens",
    "cache_creation_1h_tokens",
]

_GRAIN = ["activity_date", "workspace_id", "model"]


def _tokens(kinds: list[str]) -> Column:
    return sum((F.col(k) for k in kinds[1:]), F.col(kinds[0])).cast("bigint")


def _allocation_totals(costs: DataFrame, usage: DataFrame, how: str, null_safe: bool) -> DataFrame:
    """Cost and tokens per (date, workspace, model), both already aggregated."""
    cost = costs.groupBy(*_GRAIN).agg(F.sum("amount_usd").alias("workspace_model_cost"))
    tokens = usage.groupBy(*_GRAIN).agg(F.sum("total_tokens").alias("workspace_model_tokens"), F.count(F.lit(1)).alias("usage_rows"))
    cond = None
    for k in _GRAIN:
        same = tokens[k].eqNullSafe(cost[k]) if null_safe else tokens[k] == cost[k]
        cond = same if cond is None else cond & same
    return tokens.join(cost, cond, how).select(
        *[tokens[k] for k in _GRAIN], "workspace_model_tokens", "workspace_model_cost", "usage_rows"
    )


def allocate_cost_to_keys(costs: DataFrame, usage_keys: DataFrame, null_safe: bool = False) -> DataFrame:
    """Spread each (date, workspace, model) cost over its keys by their tokens.

    As coded, plain equality never matches the NULL (default) workspace, so its
    keys get a NULL cost; ``null_safe`` allocates them too. Costs and token
    totals are brought together first, so the usage rows are joined once.
    """
    usage = usage_keys.select("activity_date", "api_key_id", "workspace_id", "model", _tokens(TOKEN_KINDS).alias("total_tokens"))
    totals = _allocation_totals(costs, usage, "left", null_safe)
    joined = join_totals(usage, totals, _GRAIN, spread=["api_key_id", "total_tokens"], null_safe=null_safe, n="usage_rows")
    return _allocated(joined)


def allocate_cost_window(costs: DataFrame, usage_keys: DataFrame) -> DataFrame:
    """Variant that keeps only matched rows and leaves out 1-hour cache tokens."""
    kinds = [k for k in TOKEN_KINDS if k != "cache_creation_1h_tokens"]
    usage = usage_keys.select("activity_date", "api_key_id", "workspace_id", "model", _tokens(kinds).alias("total_tokens"))
    totals = _allocation_totals(costs, usage, "inner", False)
    joined = join_totals(usage, totals, _GRAIN, spread=["api_key_id", "total_tokens"], how="inner", n="usage_rows")
    return _allocated(joined).select("activity_date", "api_key_id", "workspace_id", "model", "allocated_cost_usd")


def _allocated(joined: DataFrame) -> DataFrame:
    # Cost times tokens stays exact in DECIMAL; only the quotient is a DOUBLE.
    share = safe_divide(F.col("workspace_model_cost") * F.col("total_tokens"), "workspace_model_tokens")
    return joined.select(
        "activity_date",
        "api_key_id",
        "workspace_id",
        "model",
        "total_tokens",
        F.col("workspace_model_cost").cast("double").alias("workspace_model_cost"),
        "workspace_model_tokens",
        F.round(share, 6).alias("allocated_cost_usd"),
    )


# --- daily star --------------------------------------------------------------

def _acceptance(accepted: Column, added: Column) -> Column:
    """Accepted share to four places; 0 without suggestions. More lines may be accepted than were added."""
    return F.coalesce(F.round(safe_divide(accepted, added), 4), F.lit(0.0)).cast("decimal(18,4)")


def fct_usage_daily(
    key_usage: DataFrame, ide_usage: DataFrame, editor_usage: DataFrame, dim_keys: DataFrame
) -> DataFrame:
    """API, IDE and editor usage as one daily fact; keys resolve to users.

    Each source is aggregated to its grain before the key lookup, which is then
    one row per key, day and model.
    """
    zero = F.lit(0).cast("bigint")
    api = key_usage.groupBy(F.col("activity_date").alias("usage_date"), "api_key_id", "model").agg(
        F.sum(F.col("uncached_input_tokens") + F.col("cache_read_input_tokens")).alias("input_tokens"),
        F.sum("output_tokens").alias("output_tokens"),
        F.count(F.lit(1)).alias("requests"),
    )
    api = lookup(api, dim_keys, "api_key_id", {"user_email": "mapped_user_email"})
    api = api.withColumn("user_email", F.lower("user_email"))
    api = _star(api, "anthropic", sessions=zero, loc_added=zero, loc_accepted=zero)

    accepted = sum((F.col(f"{t}_accepted") for t in ("multi_edit_tool", "write_tool", "notebook_edit_tool")), F.col("edit_tool_accepted"))
    rejected = sum((F.col(f"{t}_rejected") for t in ("multi_edit_tool", "write_tool", "notebook_edit_tool")), F.col("edit_tool_rejected"))
    ide = ide_usage.groupBy(F.col("activity_date").alias("usage_date"), "user_email", "api_key_name").agg(
        F.sum("total_input_tokens").alias("input_tokens"),
        F.sum("total_output_tokens").alias("output_tokens"),
        F.sum(accepted + rejected).alias("requests"),
        F.sum("num_sessions").alias("sessions"),
        F.sum("lines_added").alias("loc_added"),
        F.sum("lines_added").alias("loc_accepted"),
    )
    by_name = lookup(ide, dim_keys, "api_key_name", {"key_user": "mapped_user_email"})
    ide = by_name.withColumn("user_email", F.lower(F.coalesce("user_email", "key_user")))
    ide = _star(ide, "claude_code")

    editor = editor_usage.groupBy(
        F.col("activity_date").alias("usage_date"), F.lower("user_email").alias("user_email"), F.col("most_used_model").alias("model")
    ).agg(
        F.sum(F.col("composer_requests") + F.col("chat_requests") + F.coalesce("agent_requests", F.lit(0))).alias("requests"),
        F.sum("total_lines_added").alias("loc_added"),
        F.sum("accepted_lines_added").alias("loc_accepted"),
    )
    editor = _star(editor, "cursor", input_tokens=zero, output_tokens=zero, sessions=zero)
    return union_all([api, ide, editor])


def _star(df: DataFrame, platform: str, **fill: Column) -> DataFrame:
    none = F.lit(None).cast("string")
    for name, value in {"api_key_id": none, "model": none, **fill}.items():
        if name not in df.columns:
            df = df.withColumn(name, value)
    return df.select(
        "usage_date",
        F.lit(platform).alias("platform"),
        "user_email",
        "api_key_id",
        "model",
        *[F.col(c).cast("bigint").alias(c) for c in ("input_tokens", "output_tokens", "requests", "sessions", "loc_added", "loc_accepted")],
        _acceptance(F.col("loc_accepted"), F.col("loc_added")).alias("acceptance_rate"),
    )


def fct_cost_daily(allocated: DataFrame, combined: DataFrame, dim_keys: DataFrame, api_costs: DataFrame) -> DataFrame:
    """Daily cost fact: allocated API cost by key, other providers by user.

    What ``api_costs`` has beyond the allocated sum of a (date, workspace,
    model) is a row of its own, cost type ``unallocated``, without key and
    user: cost without usage, cost that plain equality leaves out, and the
    rest of rounding. The fact's total thus equals that of ``combined``, given
    that ``combined`` was made from the same ``api_costs``.
    """
    api = allocated.groupBy(F.col("activity_date").alias("cost_date"), "workspace_id", "api_key_id", "model").agg(
        F.sum(F.col("allocated_cost_usd").cast("decimal(18,6)")).alias("cost_usd")
    )
    api = lookup(api, dim_keys, "api_key_id", {"user_email": "mapped_user_email"}).select(
        "cost_date", F.lit("anthropic").alias("platform"), "workspace_id", "api_key_id",
        F.lower("user_email").alias("user_email"), F.col("cost_usd").cast("decimal(18,6)").alias("cost_usd"),
        F.lit("usage").alias("cost_type"), "model",
    )
    none = F.lit(None).cast("string")
    grain = ["cost_date", "workspace_id", "model"]
    billed = api_costs.select(F.col("activity_date").alias("cost_date"), "workspace_id", "model", F.col("amount_usd").cast("decimal(18,6)").alias("cost_usd"))
    spent = api.select(*grain, (-F.coalesce("cost_usd", F.lit(0))).cast("decimal(18,6)").alias("cost_usd"))
    left = billed.unionByName(spent).groupBy(*grain).agg(F.sum("cost_usd").cast("decimal(18,6)").alias("cost_usd")).filter("cost_usd <> 0")
    left = left.select(
        "cost_date", F.lit("anthropic").alias("platform"), "workspace_id", none.alias("api_key_id"), none.alias("user_email"),
        "cost_usd", F.lit("unallocated").alias("cost_type"), "model",
    )
    other = combined.filter(~F.col("provider").eqNullSafe("claude_api")).groupBy("cost_date", "provider", "user_email", "cost_category", "model").agg(
        F.sum("amount_usd").cast("decimal(18,6)").alias("cost_usd")
    ).select(
        "cost_date", F.col("provider").alias("platform"), none.alias("workspace_id"), none.alias("api_key_id"),
        F.lower("user_email").alias("user_email"), "cost_usd", F.col("cost_category").alias("cost_type"), "model",
    )
    return union_all([api, left, other])
