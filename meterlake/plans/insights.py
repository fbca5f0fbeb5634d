"""Finance, productivity and data-quality analytics known by their thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from meterlake.functions.dates import month_key, month_start, week_start
from meterlake.functions.numbers import count_big, percent, safe_divide, sum_if, usd
from meterlake.operators.aggregates import global_rank, union_all
from meterlake.plans.validation import tolerance_compare
from meterlake.schemas import API, EDITOR, IDE
from meterlake.session import checkpointed

# Month-over-month bands in percent.
TREND_OK, TREND_HIGH = 20, 50

# Acceptance bands in percent, best first.
ACCEPTANCE_BANDS = [(80, "Excellent"), (60, "Good"), (40, "Average")]
ACCEPTANCE_LOW = "Needs attention"

# Cost per accepted line in dollars, best first.
ROI_BANDS = [(0.15, "Excellent"), (0.30, "Good"), (0.50, "Acceptable")]
ROI_POOR = "Poor"

# Monthly dollars that make a user a power or a regular user.
POWER_USD, REGULAR_USD = 200, 50


def trend_band(pct: Column) -> Column:
    return F.when(pct.isNull(), None).when(pct < TREND_OK, "green").when(pct <= TREND_HIGH, "yellow").otherwise("red")


def _monthly(costs: DataFrame, *keys: str) -> DataFrame:
    return costs.groupBy(month_start("cost_date").alias("cost_month"), *keys).agg(F.sum("amount_usd").alias("cost"))


def _with_previous(months: DataFrame, *keys: str) -> DataFrame:
    """Add the cost of the calendar month before; NULL if that month is missing.

    There is one row per calendar month (and key) by now, so the window is
    small, and the costs are read once.
    """
    w = Window.partitionBy(*keys).orderBy("cost_month")
    follows = F.lag("cost_month").over(w) == F.add_months("cost_month", -1)
    return months.withColumn("previous", F.when(follows, F.lag("cost").over(w)))


def _mom() -> Column:
    return percent(F.col("cost") - F.col("previous"), "previous")


def monthly_finance(costs: DataFrame) -> DataFrame:
    """Monthly cost per provider with growth, trend band, run rate and share of the month."""
    months = _with_previous(_monthly(costs, "provider"), "provider")
    months = months.withColumn("month_cost", F.sum("cost").over(Window.partitionBy("cost_month")))
    out = months.select(
        "cost_month",
        month_key("cost_month").alias("month_year_label"),
        F.col("provider").alias("platform"),
        usd("cost").alias("platform_monthly_cost"),
        usd("previous").alias("previous_month_cost"),
        _mom().alias("mom_growth_pct"),
        trend_band(_mom()).alias("trend"),
        usd(F.col("cost") * 12).alias("annual_run_rate"),
        percent("cost", "month_cost").alias("share_pct"),
    )
    return out.orderBy(F.col("cost_month").desc(), "platform")


def monthly_increase_alert(costs: DataFrame, pct: float = 20.0) -> DataFrame:
    """Months that cost more than pct percent above the month before."""
    months = _with_previous(_monthly(costs))
    over = F.col("cost") * 100 > F.col("previous") * F.lit(str(100 + pct)).cast("decimal(9,4)")
    return months.filter(over).select(
        "cost_month",
        usd("cost").alias("month_cost"),
        usd("previous").alias("previous_month_cost"),
        _mom().alias("increase_pct"),
    )


def user_spend_class(costs: DataFrame) -> DataFrame:
    total = F.col("cost")
    months = _monthly(costs.filter(F.col("user_email").isNotNull()), "user_email")
    return months.select(
        "cost_month",
        "user_email",
        usd("cost").alias("monthly_cost_usd"),
        F.when(total > POWER_USD, "Power").when(total >= REGULAR_USD, "Regular").otherwise("Occasional").alias("spend_class"),
    )


def _best_first(value: Column, bands: list[tuple[float, str]], last: str, ascending: bool) -> Column:
    out = F.when(value.isNull(), None)
    for bound, name in bands:
        out = out.when(value < bound if ascending else (value > bound), name)
    return out.otherwise(last)


GRAINS = {"day": lambda c: F.col(c), "week": week_start, "month": month_start}


def productivity_metrics(usage: DataFrame, grain: str = "month") -> DataFrame:
    """Accepted share of added lines per user and period, its band and its percentile tier.

    Band and tier go by the exact rate, which is rounded for output only. The
    tier is the user's quartile among the users of the same period.
    """
    days = usage.groupBy("activity_date", "user_email").agg(
        F.sum("total_lines_added").cast("bigint").alias("added"), F.sum("accepted_lines_added").cast("bigint").alias("accepted")
    )
    if grain == "day":  # nothing is left to fold; sums stand in the order of the rate's, so that all branches share one shuffle
        one = F.col("activity_date").isNotNull().cast("bigint").alias("active_days")
        rows = days.select(F.col("activity_date").alias("period_start"), "user_email", F.col("accepted").alias("lines_accepted"), F.col("added").alias("lines_added"), one)
    else:
        rows = days.groupBy(GRAINS[grain]("activity_date").alias("period_start"), "user_email").agg(
            F.sum("added").alias("lines_added"), F.sum("accepted").alias("lines_accepted"), F.count("activity_date").alias("active_days")
        )
    rows = rows.withColumn("rate", safe_divide("lines_accepted", "lines_added"))
    ranked = global_rank(rows, "rate", within="period_start")
    p = F.col("percent_rank")
    return ranked.select(
        "period_start",
        "user_email",
        "lines_added",
        "lines_accepted",
        "active_days",
        F.round("rate", 4).alias("acceptance_rate"),
        _best_first(F.col("rate") * 100, ACCEPTANCE_BANDS, ACCEPTANCE_LOW, False).alias("performance_band"),
        F.round(p, 6).alias("percentile"),
        F.when(p.isNull(), None).when(p >= 0.75, "Top 25%").when(p >= 0.5, "Upper half")
        .when(p >= 0.25, "Lower half").otherwise("Bottom 25%").alias("tier"),
    )


def _cost_and_lines(costs: DataFrame, usage: DataFrame) -> DataFrame:
    c = costs.filter(F.col("user_email").isNotNull()).groupBy("user_email").agg(F.sum("amount_usd").alias("cost"))
    u = usage.filter(F.col("user_email").isNotNull()).groupBy("user_email").agg(
        F.sum("accepted_lines_added").cast("bigint").alias("lines_accepted")
    )
    return c.join(u, "user_email", "left").withColumn("lines_accepted", F.coalesce("lines_accepted", F.lit(0)).cast("bigint"))


def cost_allocation(costs: DataFrame, usage: DataFrame) -> DataFrame:
    """Cost per accepted line by user, its band and rank (1 is the cheapest)."""
    users = _cost_and_lines(costs, usage).withColumn("cost_per_line", safe_divide("cost", "lines_accepted"))
    ranked = global_rank(users, "cost_per_line")
    return ranked.select(
        "user_email",
        usd("cost").alias("total_cost_usd"),
        "lines_accepted",
        F.round("cost_per_line", 4).alias("cost_per_line_usd"),
        _best_first(F.col("cost_per_line"), ROI_BANDS, ROI_POOR, True).alias("efficiency_band"),
        F.col("dense_rank").alias("user_rank"),
    )


def team_cost_allocation(costs: DataFrame, usage: DataFrame, dim_keys: DataFrame) -> DataFrame:
    """The same by team; a user belongs to the first team their keys name, by name."""
    mapping = dim_keys.filter(F.col("mapped_user_email").isNotNull()).groupBy(
        F.lower("mapped_user_email").alias("_mapped")
    ).agg(F.min("mapped_team_name").alias("team"))
    users = _cost_and_lines(costs, usage)
    joined = users.join(mapping, F.lower(users["user_email"]) == mapping["_mapped"], "left")
    teams = joined.groupBy(F.coalesce("team", F.lit("Unmapped")).alias("team")).agg(
        count_big().alias("user_count"), F.sum("cost").alias("cost"), F.sum("lines_accepted").cast("bigint").alias("lines_accepted")
    ).withColumn("cost_per_line", safe_divide("cost", "lines_accepted"))
    ranked = global_rank(teams, "cost_per_line")
    return ranked.select(
        "team",
        "user_count",
        usd("cost").alias("team_cost_usd"),
        "lines_accepted",
        F.round("cost_per_line", 4).alias("cost_per_line_usd"),
        _best_first(F.col("cost_per_line"), ROI_BANDS, ROI_POOR, True).alias("efficiency_band"),
        F.col("dense_rank").alias("team_rank"),
    )


def executive_summary(costs: DataFrame, monthly_budget: float = 73000.0 / 3) -> DataFrame:
    """Per month: spend, growth, budget variance and the cost of each provider."""
    rows = costs.groupBy(month_start("cost_date").alias("cost_month")).agg(
        F.sum("amount_usd").alias("cost"),
        F.countDistinct("user_email").alias("active_users"),
        *[sum_if(F.col("provider") == p, "amount_usd").alias(f"{p}_cost") for p in (API, IDE, EDITOR)],
    )
    budget = F.lit(f"{monthly_budget:.6f}").cast("decimal(18,6)")
    return _with_previous(rows).select(
        "cost_month",
        usd("cost").alias("total_cost_usd"),
        "active_users",
        _mom().alias("mom_growth_pct"),
        usd(F.col("cost") - budget).alias("budget_variance_usd"),
        *[percent(f"{p}_cost", "cost").alias(f"{p}_share_pct") for p in (API, IDE, EDITOR)],
    ).orderBy("cost_month")


def monthly_top_spenders(costs: DataFrame, k: int = 5) -> DataFrame:
    """The k users with the highest cost of each month.

    Every (user, month) is one row by then. ``rank <= k`` directly on the window
    lets Spark keep only k rows per month in each task before the shuffle.
    """
    months = _monthly(costs.filter(F.col("user_email").isNotNull()), "user_email")
    w = Window.partitionBy("cost_month").orderBy(F.col("cost").desc(), "user_email")
    return months.withColumn("position", F.row_number().over(w)).filter(F.col("position") <= k).select(
        "cost_month", F.col("position").cast("bigint").alias("position"), "user_email", usd("cost").alias("total_cost_usd")
    )


def user_platform_matrix(costs: DataFrame) -> DataFrame:
    """Users by provider; the provider list is fixed, so no extra pass finds it."""
    rows = costs.filter(F.col("user_email").isNotNull())
    out = rows.groupBy("user_email").pivot("provider", [API, IDE, EDITOR]).agg(F.sum("amount_usd"))
    money = [F.coalesce(p, F.lit(0)) for p in (API, IDE, EDITOR)]
    return out.select(
        "user_email",
        *[usd(m).alias(f"{p}_cost_usd") for p, m in zip((API, IDE, EDITOR), money)],
        usd(money[0] + money[1] + money[2]).alias("total_cost_usd"),
    )


def tool_comparison(editor_usage: DataFrame, ide_usage: DataFrame) -> DataFrame:
    """Lines, commits and pull requests by tool, with each tool's rank by lines."""
    zero = F.lit(0).cast("bigint")
    editor = editor_usage.select(
        F.lit(EDITOR).alias("tool"), "user_email", F.col("accepted_lines_added").alias("lines"),
        zero.alias("commits"), zero.alias("pull_requests"),
    )
    ide = ide_usage.select(
        F.lit(IDE).alias("tool"), "user_email", F.col("lines_added").alias("lines"),
        F.col("commits_by_claude_code").alias("commits"), F.col("pull_requests_by_claude_code").alias("pull_requests"),
    )
    tools = union_all([editor, ide]).groupBy("tool").agg(
        F.countDistinct("user_email").alias("users"),
        F.sum("lines").cast("bigint").alias("lines_accepted"),
        F.sum("commits").cast("bigint").alias("commits"),
        F.sum("pull_requests").cast("bigint").alias("pull_requests"),
    )
    # Two rows by construction: one per tool.
    w = Window.orderBy(F.col("lines_accepted").desc(), "tool")
    return tools.withColumn("rank", F.row_number().over(w).cast("bigint"))


def cost_anomaly(costs: DataFrame, pct: float = 120.0, days: int = 7) -> DataFrame:
    """Days that cost more than pct percent of the mean of the days before.

    Days without cost count as 0; a day with fewer than ``days`` days before it
    divides by those it has. The window holds one row per calendar day.
    """
    daily = costs.groupBy("cost_date").agg(F.sum("amount_usd").alias("cost"))
    daily = daily.withColumn("n", F.datediff("cost_date", F.lit("1970-01-01").cast("date")))
    w = Window.orderBy("n")
    before = F.coalesce(F.sum("cost").over(w.rangeBetween(-days, -1)), F.lit(0))
    seen = F.least(F.col("n") - F.min("n").over(w), F.lit(days))
    out = daily.select("cost_date", "cost", seen.alias("seen"), F.round(safe_divide(before, seen), 6).alias("mean"))
    over = F.col("cost").cast("double") > F.col("mean") * (pct / 100)
    return out.filter((F.col("seen") > 0) & over).select(
        "cost_date",
        usd("cost").alias("daily_cost_usd"),
        F.round("mean", 2).alias("trailing_mean_usd"),
        percent("cost", "mean").alias("pct_of_mean"),
    ).orderBy("cost_date")


def invoice_reconciliation(costs: DataFrame, invoices: DataFrame, tol: float = 5.0) -> DataFrame:
    """Month totals against invoices (``cost_month``, ``cost``), within tol percent."""
    return tolerance_compare(_monthly(costs), invoices, "cost_month", {"cost": tol}, expected_only=True)


# Quality targets.
COMPLETENESS_TARGET, ACCURACY_TARGET, VALIDITY_TARGET, FRESH_HOURS = 95.0, 98.0, 99.0, 25


def quality_score(
    df: DataFrame,
    *,
    required: list[str],
    accurate: list[Column],
    valid: list[Column],
    key: list[str],
    updated: str,
    as_of: str,
) -> DataFrame:
    """Five scores in percent and their plain mean (no weights are documented).

    Completeness: filled required cells. Accuracy: rows meeting every business
    rule. Validity: rows meeting every format rule. Consistency: rows whose key
    is unique. Freshness: 100 up to 25 hours after the last update, else 0.
    """
    def all_of(conds: list[Column]) -> Column:
        out = F.lit(True)
        for c in conds:
            out = out & F.coalesce(c, F.lit(False))
        return out

    filled = sum((F.when(F.col(c).isNotNull(), 1).otherwise(0) for c in required[1:]),
                 F.when(F.col(required[0]).isNotNull(), 1).otherwise(0))
    # One aggregate by key yields every figure, so the table is read once.
    groups = df.groupBy(*key).agg(
        count_big().alias("n"),
        F.sum(filled).alias("filled"),
        count_big(all_of(accurate)).alias("accurate"),
        count_big(all_of(valid)).alias("valid"),
        F.max(updated).alias("updated"),
    )
    n = F.sum("n")
    age = F.timestamp_diff("SECOND", F.max("updated").cast("timestamp"), F.lit(as_of).cast("timestamp"))
    scores = groups.agg(
        n.alias("total_records"),
        F.round(safe_divide(F.sum("filled") * 100, n * len(required)), 4).alias("completeness"),
        F.round(safe_divide(F.sum("accurate") * 100, n), 4).alias("accuracy"),
        F.round(safe_divide(F.sum("valid") * 100, n), 4).alias("validity"),
        F.round(safe_divide(F.sum(F.when(F.col("n") == 1, 1).otherwise(0)) * 100, n), 4).alias("consistency"),
        F.when(age <= FRESH_HOURS * 3600, 100.0).otherwise(0.0).alias("freshness"),
    )
    parts = ["completeness", "accuracy", "validity", "consistency", "freshness"]
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0]))
    return scores.select(
        "*",
        F.round(total / len(parts), 2).alias("quality_score"),
        (F.col("completeness") >= COMPLETENESS_TARGET).alias("completeness_ok"),
        (F.col("accuracy") >= ACCURACY_TARGET).alias("accuracy_ok"),
        (F.col("validity") >= VALIDITY_TARGET).alias("validity_ok"),
    )


EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}$"


def required(*cols: str) -> dict[str, Column]:
    return {f"missing {c}": F.col(c).isNull() for c in cols}


def bad_type(col: str, to: str) -> dict[str, Column]:
    """Text that is there but does not cast."""
    return {f"{col} is no {to}": F.col(col).isNotNull() & F.col(col).try_cast(to).isNull()}


def bad_email(col: str) -> dict[str, Column]:
    return {f"{col} is no e-mail": ~F.col(col).rlike(EMAIL)}


def not_in(col: str, values: list[str]) -> dict[str, Column]:
    return {f"{col} is unknown": ~F.col(col).isin(values)}


def negative(*cols: str) -> dict[str, Column]:
    return {f"{c} is negative": F.col(c) < 0 for c in cols}


def check_rows(df: DataFrame, rules: dict[str, Column], references: dict[str, tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Add an ``errors`` array: the names of the rules a row breaks.

    ``references`` maps a column to (table, key): a value that is not a key
    there is an error. A rule that evaluates to NULL is not broken.
    """
    for i, (col, (dim, key)) in enumerate((references or {}).items()):
        flag = f"_ref{i}"
        keys = dim.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias(col)).agg(F.lit(True).alias(flag))
        df = df.join(keys, col, "left")
        rules = {**rules, f"{col} has no match": F.col(col).isNotNull() & F.col(flag).isNull()}
    named = F.array(*[F.when(cond, F.lit(name)) for name, cond in rules.items()])
    out = df.withColumn("errors", F.filter(named, lambda e: e.isNotNull()))
    return out.drop(*[c for c in out.columns if c.startswith("_ref")])


def validate_rows(
    df: DataFrame, rules: dict[str, Column], references: dict[str, tuple[DataFrame, str]] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their errors)."""
    checked = check_rows(df, rules, references)
    return checked.filter(F.size("errors") == 0).drop("errors"), checked.filter(F.size("errors") > 0)


def rejected_by_error(rejected: DataFrame) -> DataFrame:
    return rejected.select(F.explode("errors").alias("error")).groupBy("error").agg(count_big().alias("rows"))


def schema_drift(current: StructType, previous: StructType) -> list[tuple[str, str, str | None, str | None]]:
    """(field path, added/removed/changed, old type, new type) between two schemas."""
    def flat(schema: StructType, prefix: str = "") -> dict[str, str]:
        out = {}
        for f in schema:
            inner = f.dataType
            while hasattr(inner, "elementType"):
                inner = inner.elementType
            if isinstance(inner, StructType):
                out.update(flat(inner, f"{prefix}{f.name}."))
            else:
                out[f"{prefix}{f.name}"] = f.dataType.simpleString()
        return out

    new, old = flat(current), flat(previous)
    drift = []
    for name in sorted(new.keys() | old.keys()):
        if name not in old:
            drift.append((name, "added", None, new[name]))
        elif name not in new:
            drift.append((name, "removed", old[name], None))
        elif new[name] != old[name]:
            drift.append((name, "changed", old[name], new[name]))
    return drift


def field_drift(df: DataFrame, json_col: str, expected: list[str]) -> DataFrame:
    """Drift inside landed JSON records: how many carry each field, against the expected list."""
    # Every record also counts once under a NULL field, so that one pass gives fields and records.
    fields = F.concat(F.coalesce(F.json_object_keys(json_col), F.array().cast("array<string>")), F.array(F.lit(None).cast("string")))
    named = df.filter(F.col(json_col).isNotNull()).select(F.explode(fields).alias("field"))
    seen = checkpointed(named.groupBy("field").agg(count_big().alias("n")))  # one row per field name
    total = seen.filter("field IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0))).scalar()
    seen = seen.filter("field IS NOT NULL")
    known = df.sparkSession.createDataFrame([(f,) for f in expected], "field string").withColumn("_known", F.lit(True))
    joined = seen.join(known, "field", "full")
    return joined.select(
        "field",
        F.coalesce("n", F.lit(0)).cast("bigint").alias("records_with_field"),
        total.cast("bigint").alias("records"),
        F.when(F.col("_known").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("expected").alias("status"),
    )


def error_rate_alert(results: DataFrame, failed: Column, by: str, threshold_pct: float = 5.0) -> DataFrame:
    """Share of failed results per group, and whether it exceeds the threshold."""
    n, bad = count_big(), count_big(failed)
    return results.groupBy(by).agg(
        n.alias("total"),
        bad.alias("errors"),
        percent(bad, n).alias("error_pct"),
        (safe_divide(bad * 100, n) > threshold_pct).alias("alert"),
    )


def rate_limit_alert(log: DataFrame, ts: str, is_hit: Column, max_per_hour: int = 10) -> DataFrame:
    """Hours with more than max_per_hour rate-limit responses."""
    hits = log.filter(is_hit).groupBy(F.window(ts, "1 hour").alias("w")).agg(count_big().alias("hits"))
    return hits.filter(F.col("hits") > max_per_hour).select(F.col("w.start").alias("hour"), "hits")
