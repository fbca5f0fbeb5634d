"""Dashboard cards and summaries over the combined daily cost fact.

Money is summed as DECIMAL, rounded, and only then cast to DOUBLE, so results
do not depend on the order in which partial sums are merged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.functions.dates import Day, month_start, week_start
from meterlake.functions.numbers import arg_max, count_big, percent, safe_divide, sum_if, usd
from meterlake.functions.text import classify_like
from meterlake.operators.aggregates import order_by_agg, pct_of_total, top_k, union_all, union_distinct
from meterlake.operators.filters import between_dates, optional_filter, trailing_window
from meterlake.schemas import API, EDITOR, IDE

# Default parameters of the cards.
QUARTER_BUDGET_USD = 73000.0
DAILY_BUDGET_USD = 793.48
USER_THRESHOLD_USD = 500.0
TOTAL_SEATS = 250
INACTIVE_WINDOW_DAYS = 14

# Upper bound (exclusive) and label of each cost band.
COST_BANDS = [(100, "$0-100"), (300, "$100-300"), (500, "$300-500"), (1000, "$500-1000")]
TOP_BAND = "$1000+"

# Description patterns in order of precedence. "Cache" descriptions
# that are neither hit nor write also name input tokens, but are not input.
TOKEN_CATEGORIES = [
    ("%Cache Hit%", "Cache Read"),
    ("%Cache Write%", "Cache Write"),
    ("%Output Tokens%", "Output"),
    ("%Cache%", "Other"),
    ("%Input Tokens%", "Input"),
]


def _in_range(costs: DataFrame, start: Day | None, end: Day | None) -> DataFrame:
    return between_dates(costs, "cost_date", start, end)


def _user_totals(costs: DataFrame, start: Day | None, end: Day | None) -> DataFrame:
    rows = _in_range(costs, start, end).filter(F.col("user_email").isNotNull())
    return rows.groupBy("user_email").agg(F.sum("amount_usd").alias("total"))


def combined_daily_costs(
    api_costs: DataFrame, ide_costs: DataFrame, editor_spend: DataFrame, ide_workspace: str | None = None
) -> DataFrame:
    """One cost fact from API costs, IDE usage with estimated costs, and editor spend.

    API costs carry no user. IDE rows of API-key actors and unattributed editor
    spend keep a NULL user. The cost report bills IDE use under a workspace of
    its own; naming it leaves those rows out, so that they do not count twice.
    """
    if ide_workspace is not None:
        api_costs = api_costs.filter(F.col("workspace_id").isNull() | (F.col("workspace_id") != ide_workspace))
    api = api_costs.select(
        F.col("activity_date").alias("cost_date"),
        F.lit(API).alias("provider"),
        F.lit(None).cast("string").alias("user_email"),
        "model",
        "description",
        F.col("cost_type").alias("cost_category"),
        F.col("amount_usd").cast("decimal(18,6)").alias("amount_usd"),
    )
    ide = ide_costs.select(
        F.col("activity_date").alias("cost_date"),
        F.lit(IDE).alias("provider"),
        "user_email",
        F.lit(None).cast("string").alias("model"),
        F.lit(None).cast("string").alias("description"),
        F.lit("ide").alias("cost_category"),
        F.col("total_estimated_cost_usd").cast("decimal(18,6)").alias("amount_usd"),
    )
    editor = editor_spend.select(
        F.col("activity_date").alias("cost_date"),
        F.lit(EDITOR).alias("provider"),
        "user_email",
        F.col("most_used_model").alias("model"),
        F.lit(None).cast("string").alias("description"),
        F.lit("subscription").alias("cost_category"),
        F.col("daily_spend_usd").cast("decimal(18,6)").alias("amount_usd"),
    )
    return union_all([api, ide, editor])


def kpi_total_cost(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    def of(provider: str) -> Column:
        return usd(sum_if(F.col("provider") == provider, "amount_usd"))

    return _in_range(costs, start, end).agg(
        usd(F.sum("amount_usd")).alias("total_cost_usd"),
        of(API).alias("claude_api_cost_usd"),
        of(IDE).alias("claude_code_cost_usd"),
        of(EDITOR).alias("cursor_cost_usd"),
    )


def kpi_daily_average(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Total over the calendar days from the first to the last cost, gaps included."""
    span = F.datediff(F.max("cost_date"), F.min("cost_date")) + 1
    return _in_range(costs, start, end).agg(
        F.round(safe_divide(F.sum("amount_usd"), span), 2).alias("average_daily_cost_usd"),
        span.cast("bigint").alias("day_count"),
    )


def kpi_cost_per_user(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return _user_totals(costs, start, end).agg(
        F.round(safe_divide(F.sum("total"), count_big()), 2).alias("cost_per_user_usd"),
        count_big().alias("active_users"),
    )


def _variance(total: Column, budget: float) -> list[Column]:
    b = F.lit(str(budget)).cast("decimal(18,6)")
    return [
        usd(total - b).alias("variance_usd"),
        percent(total - b, b).alias("variance_pct"),
    ]


def kpi_budget_variance(
    costs: DataFrame, start: Day | None = None, end: Day | None = None, quarter_budget: float = QUARTER_BUDGET_USD
) -> DataFrame:
    """Variance against a budget; the percentage is NULL for a budget of 0."""
    total = F.sum("amount_usd")
    return _in_range(costs, start, end).agg(
        usd(total).alias("total_cost_usd"),
        F.lit(float(quarter_budget)).alias("budget_usd"),
        *_variance(total, quarter_budget),
    )


def daily_spend_trend(
    costs: DataFrame, start: Day | None = None, end: Day | None = None, daily_budget: float = DAILY_BUDGET_USD
) -> DataFrame:
    total = F.sum("amount_usd")
    _, pct = _variance(total, daily_budget)
    days = _in_range(costs, start, end).groupBy("cost_date").agg(
        usd(total).alias("total_cost_usd"),
        F.lit(float(daily_budget)).alias("budget_reference_usd"),
        pct.alias("pct_vs_budget"),
    )
    return days.orderBy("cost_date")


def provider_breakdown(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    out = _in_range(costs, start, end).groupBy("provider").agg(usd(F.sum("amount_usd")).alias("total_cost_usd"))
    return out.orderBy(F.col("total_cost_usd").desc(), "provider")


def top_spenders(
    costs: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    alert_threshold: float = USER_THRESHOLD_USD,
    k: int = 15,
    providers: list[str] | None = None,
    users: list[str] | None = None,
) -> DataFrame:
    rows = optional_filter(optional_filter(costs, "provider", providers), "user_email", users)
    totals = _user_totals(rows, start, end).select("user_email", usd("total").alias("total_cost_usd"))
    top = top_k(totals, "total_cost_usd", k, "user_email")
    return top.withColumn("alert_threshold_usd", F.lit(float(alert_threshold)))


def top_spenders_by_provider(
    costs: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    k: int = 15,
    providers: list[str] | None = None,
    users: list[str] | None = None,
) -> DataFrame:
    rows = optional_filter(optional_filter(_in_range(costs, start, end), "provider", providers), "user_email", users)
    totals = rows.groupBy("user_email", "provider").agg(usd(F.sum("amount_usd")).alias("total_cost_usd"))
    return top_k(totals, "total_cost_usd", k, ["user_email", "provider"])


def _band(total: Column) -> Column:
    out = F
    for bound, name in COST_BANDS:
        out = out.when(total < bound, name)
    return out.otherwise(TOP_BAND)


def user_cost_histogram(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    return order_by_agg(
        _user_totals(costs, start, end),
        [_band(F.col("total")).alias("cost_range")],
        [count_big().alias("user_count")],
        F.min("total"),
    )


def weekly_cost_by_model(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    """Rows without a model are left out, so no "Unknown" model appears."""
    rows = _in_range(costs, start, end).filter(F.col("model").isNotNull())
    out = rows.groupBy(week_start("cost_date").alias("week_start"), "model").agg(
        usd(F.sum("amount_usd")).alias("model_cost_usd")
    )
    return out.orderBy("week_start", F.col("model_cost_usd").desc(), "model")


def weekly_cost_by_token_type(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    category = classify_like("description", TOKEN_CATEGORIES, "Other").alias("token_category")
    rows = _in_range(costs, start, end).filter(F.col("cost_category") == "tokens")
    out = rows.groupBy(week_start("cost_date").alias("week_start"), category).agg(
        usd(F.sum("amount_usd")).alias("token_cost_usd")
    )
    return out.orderBy("week_start", "token_category")


def team_attribution(
    costs: DataFrame,
    dim_keys: DataFrame,
    start: Day | None = None,
    end: Day | None = None,
    dedupe_mapping: bool = False,
) -> DataFrame:
    """Cost, users and top user per team.

    The mapping has one row per API key. As coded, a user with k keys in a team
    therefore counts k times in its cost; ``dedupe_mapping`` counts every user
    once. The keys are counted per (user, team) before the join instead of being
    joined one by one, so a user with very many keys adds a single row.
    ``top_user_cost_usd`` is not rounded.
    """
    users = _user_totals(costs, start, end)
    mapping = (
        dim_keys.filter(F.col("mapped_user_email").isNotNull())
        .groupBy(
            F.lower("mapped_user_email").alias("mapped_user_email"),
            F.coalesce("mapped_team_name", F.lit("Unmapped")).alias("team"),
        )
        .agg(count_big().cast("int").alias("keys"))
    )
    joined = users.join(mapping, F.lower(users["user_email"]) == mapping["mapped_user_email"], "left")
    times = F.lit(1) if dedupe_mapping else F.coalesce("keys", F.lit(1))
    cost = F.sum(F.col("total") * times)
    teams = joined.groupBy(F.coalesce("team", F.lit("Unmapped")).alias("team")).agg(
        count_big().alias("user_count"),
        usd(cost).alias("team_cost_usd"),
        F.round(safe_divide(cost, count_big()), 2).alias("cost_per_user_usd"),
        arg_max("user_email", "total").alias("top_user"),
        F.max("total").cast("double").alias("top_user_cost_usd"),
    )
    return teams.orderBy(F.col("team_cost_usd").desc(), "team")


def alert_user_budget(
    costs: DataFrame, start: Day | None = None, end: Day | None = None, threshold: float = USER_THRESHOLD_USD
) -> DataFrame:
    return _user_totals(costs, start, end).agg(
        count_big(F.col("total") > threshold).alias("users_over_threshold"),
        usd(F.max("total")).alias("highest_user_spend_usd"),
    )


def alert_cache_efficiency(usage: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    read, uncached = F.sum("cache_read_input_tokens"), F.sum("uncached_input_tokens")
    return between_dates(usage, "activity_date", start, end).agg(
        F.round(safe_divide(read, uncached + read) * 100, 2).alias("cache_hit_rate_pct"),
        read.alias("cache_read_tokens"),
        uncached.alias("uncached_input_tokens"),
    )


def alert_seat_utilization(
    usages: list[DataFrame],
    end: Day,
    window_days: int = INACTIVE_WINDOW_DAYS,
    seats: int = TOTAL_SEATS,
    count_null_user: bool = True,
) -> DataFrame:
    """Seats without activity in the trailing window over all usage sources.

    As coded, activity without a user counts as one more active user;
    ``count_null_user=False`` leaves it out.
    """
    active = union_distinct([trailing_window(u, "activity_date", window_days, end).select("user_email") for u in usages])
    n = count_big() if count_null_user else F.count("user_email")
    return active.agg(n.alias("active_users")).select(
        F.lit(seats).cast("bigint").alias("total_seats"),
        "active_users",
        F.greatest(F.lit(seats) - F.col("active_users"), F.lit(0)).cast("bigint").alias("inactive_users"),
        F.round(safe_divide("active_users", F.lit(seats)) * 100, 2).alias("utilization_pct"),
    )


def workspace_label(workspace: str | Column, names: dict[str, str], other: str | None = "Other", default: str = "Default") -> Column:
    """NULL is the default workspace; listed ids get their name, the rest ``other``."""
    w = F.col(workspace) if isinstance(workspace, str) else workspace
    out = F.when(w.isNull(), default)
    for key, name in names.items():
        out = out.when(w == key, name)
    return out.otherwise(F.lit(other))


def workspace_costs(
    costs: DataFrame, names: dict[str, str], start: Day | None = None, end: Day | None = None
) -> DataFrame:
    rows = between_dates(costs, "activity_date", start, end)
    out = rows.groupBy(workspace_label("workspace_id", names, default="Default Workspace").alias("workspace")).agg(
        count_big().alias("num_records"),
        F.sum("amount_usd").cast("double").alias("total_cost"),
        F.min("amount_usd").cast("double").alias("min_cost"),
        F.max("amount_usd").cast("double").alias("max_cost"),
    )
    return out.orderBy(F.col("total_cost").desc())


def workspace_costs_daily(
    costs: DataFrame, named: str = "Claude Code", start: Day | None = None, end: Day | None = None
) -> DataFrame:
    """Two-way form per day: the default workspace against any other."""
    rows = between_dates(costs, "activity_date", start, end)
    out = rows.groupBy("activity_date", workspace_label("workspace_id", {}, other=named).alias("workspace")).agg(
        count_big().alias("num_line_items"), F.sum("amount_usd").cast("double").alias("daily_cost")
    )
    return out.orderBy(F.col("activity_date").desc(), "workspace")


def daily_cost_by_kind(costs: DataFrame) -> DataFrame:
    """Input, output, cache-read and cache-write cost side by side."""
    kind = F.col("token_type")
    plain_input = kind.like("%input%") & ~kind.like("%cache%")

    def of(cond: Column) -> Column:
        return sum_if(cond, "amount_usd").cast("double")

    return costs.groupBy("activity_date", "workspace_id", "model").agg(
        of(plain_input).alias("input_cost_usd"),
        of(kind == "output_tokens").alias("output_cost_usd"),
        of(kind.like("%cache_read%")).alias("cache_read_cost_usd"),
        of(kind.like("%cache_creation%")).alias("cache_write_cost_usd"),
        F.sum("amount_usd").cast("double").alias("total_cost_usd"),
    )


def model_share(costs: DataFrame, start: Day | None = None, end: Day | None = None) -> DataFrame:
    rows = between_dates(costs, "activity_date", start, end).filter(F.col("model").isNotNull())
    models = rows.groupBy("model").agg(count_big().alias("num_records"), F.sum("amount_usd").alias("cost"))
    out = pct_of_total(models, "cost").withColumn("total_cost", F.col("cost").cast("double")).drop("cost")
    return out.orderBy(F.col("total_cost").desc(), "model")


def monthly_summary(costs: DataFrame) -> DataFrame:
    """Per month and user: coding (IDE + editor), API and assistant cost, and their sum.

    The combined fact has no assistant provider yet; its column is 0.
    """
    provider = F.col("provider")
    return costs.groupBy(month_start("cost_date").alias("summary_month"), "user_email").agg(
        usd(sum_if(provider.isin(IDE, EDITOR), "amount_usd")).alias("total_coding_cost"),
        usd(sum_if(provider == API, "amount_usd")).alias("total_api_cost"),
        F.lit(0.0).alias("total_assistant_cost"),
        usd(F.sum("amount_usd")).alias("total_ai_investment"),
    )


def current_month(df: DataFrame, as_of: Day, col: str = "cost_date") -> DataFrame:
    """Rows of as_of's month, as a range on the bare column so that it prunes."""
    first = F.trunc(F.lit(str(as_of)).cast("date"), "MM")
    return df.filter((F.col(col) >= first) & (F.col(col) < F.add_months(first, 1)))


def daily_cost_trend(costs: DataFrame, as_of: Day, days: int = 30, k: int = 30) -> DataFrame:
    """The latest k days within the trailing window, newest first."""
    rows = costs.filter(F.col("activity_date") >= F.date_sub(F.lit(str(as_of)).cast("date"), days))
    out = rows.groupBy("activity_date").agg(F.sum("amount_usd").cast("double").alias("daily_cost"))
    return out.orderBy(F.col("activity_date").desc()).limit(k)
