"""Hand-written frames, one per rule that is easy to get wrong."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterlake.functions.dates import date_spine, date_spine_offsets, week_start
from meterlake.functions.numbers import arg_max, usd
from meterlake.functions.text import string_agg_distinct
from meterlake.operators import aggregates as G
from meterlake.operators import joins as J
from meterlake.plans import attribution as A
from meterlake.plans import backfill as B
from meterlake.plans import costs as C
from meterlake.plans import insights as I
from meterlake.plans import usage as U
from meterlake.plans import validation as V

COST = "cost_date string, provider string, user_email string, model string, description string, cost_category string, amount_usd string"
D = dt.date


def costs(spark, data):
    df = spark.createDataFrame(data, COST)
    return df.withColumn("cost_date", F.col("cost_date").cast("date")).withColumn("amount_usd", F.col("amount_usd").cast("decimal(18,6)"))


def cost(day, amount, user="user1@example.com", provider="cursor", model=None, description=None, category="tokens"):
    return (day, provider, user, model, description, category, str(amount))


def dated(spark, data, ddl, *cols):
    df = spark.createDataFrame(data, ddl)
    for c in cols:
        df = df.withColumn(c, F.col(c).cast("date"))
    return df


def test_empty_range_gives_nulls_not_errors(spark):
    df = costs(spark, [cost("2025-10-01", 5)])
    r = C.kpi_daily_average(df, "2030-01-01", "2030-12-31").first()
    assert tuple(r) == (None, None)
    r = C.kpi_cost_per_user(df, "2030-01-01", "2030-12-31").first()
    assert tuple(r) == (None, 0)
    assert C.alert_user_budget(df, "2030-01-01", "2030-12-31").first().users_over_threshold == 0


def test_daily_average_counts_calendar_days(spark):
    df = costs(spark, [cost("2025-10-01", 10), cost("2025-10-05", 10)])
    assert tuple(C.kpi_daily_average(df).first()) == (4.0, 5)


def test_zero_budget(spark):
    r = C.kpi_budget_variance(costs(spark, [cost("2025-10-01", 5)]), quarter_budget=0.0).first()
    assert (r.variance_usd, r.variance_pct) == (5.0, None)


def test_rounding_is_half_away_from_zero(spark):
    df = costs(spark, [cost("2025-10-01", "0.125"), cost("2025-10-02", "-0.125")])
    got = {r.cost_date: r.v for r in df.select("cost_date", usd("amount_usd").alias("v")).collect()}
    assert sorted(got.values()) == [-0.13, 0.13]


def test_weeks_start_on_sunday(spark):
    df = dated(spark, [("2025-10-18",), ("2025-10-19",), ("2025-10-20",)], "d string", "d")
    got = [r[0] for r in df.select(week_start("d")).collect()]
    assert got == [D(2025, 10, 12), D(2025, 10, 19), D(2025, 10, 19)]


def test_token_category_precedence(spark):
    texts = ["Input Tokens, Cache Hit", "Output Tokens, Cache Write", "Output Tokens", "Input Tokens", "Input Tokens, Cache", "cache hit", None]
    df = costs(spark, [cost("2025-10-01", 2**i, description=t) for i, t in enumerate(texts)])
    got = {r.token_category: r.token_cost_usd for r in C.weekly_cost_by_token_type(df).collect()}
    assert got == {"Cache Read": 1.0, "Cache Write": 2.0, "Output": 4.0, "Input": 8.0, "Other": 16.0 + 32 + 64}


def test_histogram_bounds(spark):
    amounts = ["99.99", "100", "299.99", "300", "500", "999.99", "1000"]
    df = costs(spark, [cost("2025-10-01", a, user=f"user{i}@example.com") for i, a in enumerate(amounts)])
    got = [tuple(r) for r in C.user_cost_histogram(df).collect()]
    assert got == [("$0-100", 1), ("$100-300", 2), ("$300-500", 1), ("$500-1000", 2), ("$1000+", 1)]


def test_threshold_is_strict(spark):
    df = costs(spark, [cost("2025-10-01", 500), cost("2025-10-01", "500.01", user="user2@example.com")])
    assert C.alert_user_budget(df).first().users_over_threshold == 1


KEYS = "api_key_id string, mapped_user_email string, mapped_team_name string"


def test_team_fan_out_and_its_correction(spark):
    df = costs(spark, [cost("2025-10-01", 10), cost("2025-10-01", 7, user="user2@example.com")])
    keys = spark.createDataFrame([("k1", "USER1@example.com", "t"), ("k2", "user1@example.com", "t"), ("k3", None, "t")], KEYS)
    coded = {r.team: r for r in C.team_attribution(df, keys).collect()}
    assert (coded["t"].team_cost_usd, coded["t"].user_count) == (20.0, 1)
    assert (coded["Unmapped"].team_cost_usd, coded["Unmapped"].top_user) == (7.0, "user2@example.com")
    fixed = {r.team: r.team_cost_usd for r in C.team_attribution(df, keys, dedupe_mapping=True).collect()}
    assert fixed == {"t": 10.0, "Unmapped": 7.0}


def test_arg_max_tie_goes_to_smaller_name(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 1)], "u string, n int")
    assert df.agg(arg_max("u", "n")).first()[0] == "a"


def test_string_agg_sorted_without_nulls(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "m string")
    assert df.agg(string_agg_distinct("m")).first()[0] == "a,b"
    assert df.filter("m IS NULL").agg(string_agg_distinct("m")).first()[0] is None


def test_seats_null_user_and_clamp(spark):
    use = dated(spark, [("2025-10-10", "user1@example.com"), ("2025-10-20", None), ("2025-10-05", "old")], "activity_date string, user_email string", "activity_date")
    other = use.filter("user_email IS NOT NULL")
    r = C.alert_seat_utilization([use, other, other], "2025-10-20", 14, 3).first()
    assert tuple(r) == (3, 2, 1, 66.67)
    assert C.alert_seat_utilization([use, other], "2025-10-20", 14, 3, count_null_user=False).first().active_users == 1
    assert C.alert_seat_utilization([use], "2025-10-20", 14, 1).first().inactive_users == 0
    assert C.alert_seat_utilization([use], "2025-10-20", 14, 0).first().utilization_pct is None


def test_retention_matches_self_joins(spark):
    data = [("2025-09-07", "a"), ("2025-09-14", "a"), ("2025-10-05", "a"), ("2025-09-07", "b"), ("2025-09-21", "b"), ("2025-09-08", "b"), ("2025-09-07", None), ("2025-09-14", None)]
    logs = dated(spark, data, "activity_date string, user_email string", "activity_date")
    got = {r.cohort_week: tuple(r)[1:5] for r in U.weekly_retention(logs, "2025-10-10", 12).collect()}
    assert got == {D(2025, 9, 7): (2, 1, 1, 1), D(2025, 9, 14): (1, 0, 0, 0), D(2025, 9, 21): (1, 0, 0, 0), D(2025, 10, 5): (1, 0, 0, 0)}


def _logs(spark, data):
    return dated(spark, data, "activity_date string, user_email string, user_name string, event_type string, client_platform string, project_uuid string", "activity_date")


def test_preferred_platform_global_and_own(spark):
    row = lambda u, p, d="2025-10-01": (d, u, u, "file_uploaded", p, None)
    logs = _logs(spark, [row("a", "ios"), row("a", "ios"), row("a", "web"), row("c", None)] + [row("b", "web", "2020-01-01")] * 5)
    glob = {r.user_email: r.preferred_platform for r in U.user_productivity_profile(logs, "2025-10-10").collect()}
    own = {r.user_email: r.preferred_platform for r in U.user_productivity_profile(logs, "2025-10-10", per_user=True).collect()}
    assert glob == {"a": "web", "c": None}
    assert own == {"a": "ios", "c": None}


def test_research_class_uses_unrounded_ratio(spark):
    row = lambda u, e: ("2025-10-01", u, u, e, None, None)
    data = [row("a", "conversation_created")] * 1000 + [row("a", "file_uploaded")] * 2999 + [row("n", "file_uploaded")]
    (r,) = U.research_power_users(_logs(spark, data), "2025-10-10").collect()
    assert (r.files_per_conversation, r.user_type) == (3.0, "Balanced")


SNAP = "user_email string, billing_cycle_start string, snapshot_date string, total_spend_cents bigint"


def snaps(spark, data):
    return dated(spark, data, SNAP, "billing_cycle_start", "snapshot_date")


def test_spend_delta_rules(spark, rows):
    u, c1, c2 = "user1@example.com", "2025-10-03", "2025-11-03"
    df = snaps(spark, [
        (u, c1, "2025-10-18", 1000), (u, c1, "2025-10-19", 999), (u, c1, "2025-10-20", 997), (u, c1, "2025-10-20", 997),
        (u, c1, "2025-10-21", 1500), (u, c2, "2025-11-04", 40), (None, c1, "2025-10-18", 5), ("", c1, "2025-10-18", 5),
    ])
    got = [r.daily_spend_usd for r in A.spend_deltas(df).orderBy("activity_date").collect()]
    # -1 cent is kept, -2 cents is clamped and the sum stays, a new cycle starts at 0.
    assert got == [Decimal("10.00"), Decimal("-0.01"), Decimal("0.00"), Decimal("5.01"), Decimal("0.40")]
    fast = [r.daily_spend_usd for r in A.spend_deltas_running_max(df).orderBy("activity_date").collect()]
    assert fast == [Decimal("10.00"), Decimal("0.00"), Decimal("0.00"), Decimal("5.00"), Decimal("0.40")]


def test_single_day_form_equals_fold(spark):
    u = "user1@example.com"
    df = snaps(spark, [(u, "2025-10-03", f"2025-10-{d}", c) for d, c in ((18, 1000), (19, 999), (20, 990), (21, 1500))])
    whole = {r.activity_date: r.daily_spend_usd for r in A.spend_deltas(df).collect()}
    metrics = spark.createDataFrame([], "activity_date date, user_email string, daily_spend_usd decimal(18,2)")
    for d in sorted(whole):
        one = A.spend_deltas_for_day(df, metrics, "2025-10-03", d).select("activity_date", "user_email", "daily_spend_usd")
        assert one.first().daily_spend_usd == whole[d]
        metrics = spark.createDataFrame(metrics.collect() + one.collect(), metrics.schema)


def test_apply_spend_updates_matches_only(spark):
    m = dated(spark, [("2025-10-01", "a", 1.0), ("2025-10-01", "b", 2.0), ("2025-10-02", "a", 3.0)], "activity_date string, user_email string, daily_spend_usd double", "activity_date")
    d = dated(spark, [("2025-10-01", "a", 9.0), ("2025-10-01", "z", 9.0)], "activity_date string, user_email string, daily_spend_usd double", "activity_date")
    got = sorted((str(r.activity_date), r.user_email, float(r.daily_spend_usd)) for r in A.apply_spend(m, d).collect())
    assert got == [("2025-10-01", "a", 9.0), ("2025-10-01", "b", 2.0), ("2025-10-02", "a", 3.0)]


USAGE = "activity_date string, api_key_id string, workspace_id string, model string, " + ", ".join(f"{k} bigint" for k in A.TOKEN_KINDS)
COSTS = "activity_date string, workspace_id string, model string, amount_usd decimal(18,6)"


def test_allocation_null_workspace(spark):
    usage = dated(spark, [("2025-10-01", k, w, "m", n, 0, 0, 0, 0) for k, w, n in (("k1", "w", 1), ("k2", "w", 3), ("k3", None, 5), ("k4", "z", 0))], USAGE, "activity_date")
    cs = dated(spark, [("2025-10-01", "w", "m", Decimal(8)), ("2025-10-01", None, "m", Decimal(2)), ("2025-10-01", "z", "m", Decimal(1))], COSTS, "activity_date")
    got = {r.api_key_id: r.allocated_cost_usd for r in A.allocate_cost_to_keys(cs, usage).collect()}
    assert got == {"k1": 2.0, "k2": 6.0, "k3": None, "k4": None}
    safe = {r.api_key_id: r.allocated_cost_usd for r in A.allocate_cost_to_keys(cs, usage, null_safe=True).collect()}
    assert safe == {"k1": 2.0, "k2": 6.0, "k3": 2.0, "k4": None}
    assert {r.api_key_id for r in A.allocate_cost_window(cs, usage).collect()} == {"k1", "k2", "k4"}


def test_hot_key_keeps_every_row(spark):
    """A key with most of the rows is spread over salts without loss."""
    df = spark.range(20000).select(F.when(F.col("id") % 10 < 7, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    totals = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = J.join_totals(df, totals, ["k"], spread=["id"])
    assert out.count() == 20000 and out.filter("n IS NULL").count() == 0
    assert out.filter("k = 'hot'").select("n").distinct().collect()[0].n == 14000


def test_global_rank_equals_window(spark):
    from pyspark.sql import Window

    df = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 97 == 0, None).otherwise(F.col("id") * 31 % 211).alias("v"))
    w = Window.orderBy("v")
    want = df.filter("v IS NOT NULL").select("id", F.rank().over(w).alias("r"), F.dense_rank().over(w).alias("d"), F.round(F.percent_rank().over(w), 9).alias("p"))
    got = G.global_rank(df, "v").select("id", F.col("rank").alias("r"), F.col("dense_rank").alias("d"), F.round("percent_rank", 9).alias("p"))
    assert got.count() == 5000
    assert got.filter("r IS NOT NULL").exceptAll(want.select("id", F.col("r").cast("bigint"), F.col("d").cast("bigint"), "p")).count() == 0
    assert got.filter("r IS NOT NULL").count() == want.count()


def test_duplicate_key_omits_description(spark):
    ddl = "activity_date string, workspace_id string, model string, token_type string, description string"
    df = dated(spark, [("2025-10-01", None, "m", "t", "a"), ("2025-10-01", None, "m", "t", "b"), ("2025-10-01", "w", "m", "t", "a")], ddl, "activity_date")
    assert [r.cnt for r in V.duplicate_groups(df).collect()] == [2]
    assert V.duplicate_groups(df, [*V.DUPLICATE_KEYS, "description"]).count() == 0
    assert V.duplicate_check(df).first().status == "FAIL"


def test_tolerance_bounds_and_unknown(spark):
    ddl = "model string, cost double, tokens double"
    actual = spark.createDataFrame([("at", 101.0, 102.0), ("over", 101.01, 100.0), ("new", 1.0, 1.0)], ddl)
    expected = spark.createDataFrame([("at", 100.0, 100.0), ("over", 100.0, 100.0), ("gone", 5.0, 5.0)], ddl)
    got = {r.model: r.status for r in V.tolerance_compare(actual, expected, "model").collect()}
    assert got == {"at": "PASSED", "over": "FAILED", "new": "WARNING"}
    full = {r.model: r.status for r in V.tolerance_compare(actual, expected, "model", expected_only=True).collect()}
    assert full == got | {"gone": "FAILED"}


def test_cost_ceiling_levels(spark):
    df = dated(spark, [("2025-10-01", 99.0), ("2025-10-02", 100.0), ("2025-10-03", 1000.0), ("2025-10-04", 1001.0)], "activity_date string, amount_usd double", "activity_date")
    got = [(r.day_status, r.row_status) for r in V.cost_ceiling(df).collect()]
    assert got == [("PASS", "PASS"), ("PASS", "WARNING"), ("PASS", "WARNING"), ("FAIL", "FAIL")]


def test_checkpoints_pass_and_fail(spark):
    ddl = "activity_date string, workspace_id string, model string, token_type string, amount_usd decimal(18,6)"
    df = dated(spark, [(f"2025-{m:02d}-{d:02d}", None, "m", "t", Decimal(1)) for m in range(1, 13) for d in range(1, 28)], ddl, "activity_date")
    ide = spark.createDataFrame([], "lines_added bigint")
    ok = V.checkpoint_report(df, ide, 30.0, 10.0, "2025-10-01", "2025-10-31")
    assert [(r.checkpoint, r.status) for r in ok.collect()] == [(i, "PASS") for i in range(1, 6)]
    bad = V.checkpoint_report(df.limit(3).unionAll(df.limit(3)).withColumn("amount_usd", F.lit(100).cast("decimal(18,6)")), spark.createDataFrame([], "total_cost_usd double"), 30.0)
    assert {r.status for r in bad.collect()} == {"FAIL"}
    assert V.forbidden_columns(spark.createDataFrame([], "output_tokens bigint")).first().status == "FAIL"


def test_gaps_and_coverage(spark, rows):
    a = dated(spark, [("2025-10-01",), ("2025-10-03",), ("2025-10-03",)], "d string", "d")
    b = dated(spark, [("2025-10-02",)], "d string", "d")
    assert rows(V.missing_dates(a, "d", "2025-10-01", "2025-10-03")) == [(D(2025, 10, 2),)]
    assert rows(J.gap_having(date_spine(spark, "2025-10-01", "2025-10-03"), a, "date", "d")) == [(D(2025, 10, 2), 0)]
    cov = rows(V.date_coverage([("a", a, "d"), ("b", b, "d")], "2025-10-01", "2025-10-03"))
    assert cov == [(D(2025, 10, 1), "Present", "MISSING"), (D(2025, 10, 2), "MISSING", "Present"), (D(2025, 10, 3), "Present", "MISSING")]
    assert rows(date_spine_offsets(spark, "2025-10-01", 2), "date") == rows(date_spine(spark, "2025-10-01", "2025-10-03"), "date")


def test_chunks_cover_the_range_once(spark):
    for end, n in (("2025-01-01", 1), ("2025-04-01", 1), ("2025-04-02", 2), ("2025-12-31", 5)):
        got = B.chunk_range(spark, "2025-01-01", end).orderBy("chunk").collect()
        assert len(got) == n and got[0].chunk_start == D(2025, 1, 1) and str(got[-1].chunk_end) == end
        assert all((b.chunk_start - a.chunk_end).days == 1 for a, b in zip(got, got[1:]))
        assert all((c.chunk_end - c.chunk_start).days <= 90 for c in got)


def test_backfill_status_and_retry(spark, rows):
    df = dated(spark, [("2025-10-01", 5.0, "ok"), ("2025-10-02", 2000.0, "ok"), ("2025-10-03", 1.0, "bad")], "activity_date string, amount_usd double, kind string", "activity_date")
    st = B.backfill_status(df, "2025-10-01", "2025-10-04", invalid=F.col("kind") == "bad")
    got = {str(r.date): (r.status, r.reason) for r in st.collect()}
    assert got == {"2025-10-01": ("ok", None), "2025-10-02": ("failed", "day total above ceiling"), "2025-10-03": ("failed", "invalid rows"), "2025-10-04": ("empty", "no rows")}
    assert B.backfill_rows(df, st).count() == 1
    again = B.retry_dates(df, st.filter("status <> 'ok'").select("date"), day_max=None)
    assert {str(r.date): r.status for r in again.collect()} == {"2025-10-02": "ok", "2025-10-03": "ok", "2025-10-04": "empty"}
    assert rows(B.auto_detect_missing(df, "2025-10-01", "2025-10-04")) == [(D(2025, 10, 4),)]


def test_monthly_growth_skips_no_month(spark):
    df = costs(spark, [cost("2025-01-05", 100), cost("2025-02-05", 130), cost("2025-04-05", 500)])
    got = {str(r.cost_month): (r.mom_growth_pct, r.trend) for r in I.monthly_finance(df).collect()}
    assert got == {"2025-01-01": (None, None), "2025-02-01": (30.0, "yellow"), "2025-04-01": (None, None)}
    assert [str(r.cost_month) for r in I.monthly_increase_alert(df).collect()] == ["2025-02-01"]


def test_cost_anomaly_counts_gaps_as_zero(spark):
    df = costs(spark, [cost("2025-10-01", 70), cost("2025-10-02", 70), cost("2025-10-09", 25)])
    got = [(str(r.cost_date), r.trailing_mean_usd) for r in I.cost_anomaly(df).collect()]
    assert got == [("2025-10-09", 10.0)]


def test_spend_classes(spark):
    df = costs(spark, [cost("2025-10-01", a, user=u) for a, u in (("200", "a"), ("200.01", "b"), ("50", "c"), ("49.99", "d"))])
    assert {r.user_email: r.spend_class for r in I.user_spend_class(df).collect()} == {"a": "Regular", "b": "Power", "c": "Regular", "d": "Occasional"}


def test_validation_splits_rows(spark):
    df = spark.createDataFrame([("user1@example.com", 1, "cursor", "7"), ("bad", -1, "x", "seven"), (None, 1, "cursor", None)], "email string, n int, platform string, q string")
    rules = {**I.required("email"), **I.bad_email("email"), **I.negative("n"), **I.not_in("platform", ["cursor"]), **I.bad_type("q", "bigint")}
    known = spark.createDataFrame([("user1@example.com",), ("bad",)], "email string")
    ok, rejected = I.validate_rows(df, rules, {"email": (known, "email")})
    assert [r.email for r in ok.collect()] == ["user1@example.com"]
    got = {r.email: set(r.errors) for r in rejected.collect()}
    assert got == {"bad": {"email is no e-mail", "n is negative", "platform is unknown", "q is no bigint"}, None: {"missing email"}}


def test_schema_drift(spark):
    from pyspark.sql.types import StructType

    old = StructType.fromDDL("a int, s struct<x: int, y: string>, arr array<struct<z: int>>")
    new = StructType.fromDDL("a bigint, s struct<x: int>, arr array<struct<z: int, w: int>>")
    assert I.schema_drift(new, old) == [("a", "changed", "int", "bigint"), ("arr.w", "added", None, "int"), ("s.y", "removed", "string", None)]


def test_alerts(spark):
    log = spark.createDataFrame([(f"2025-10-01 0{h}:{m:02d}:00", 429 if h == 1 else 200) for h in (1, 2) for m in range(11)], "ts string, code int").withColumn("ts", F.col("ts").cast("timestamp"))
    assert [r.hits for r in I.rate_limit_alert(log, "ts", F.col("code") == 429).collect()] == [11]
    got = {r.code: r.alert for r in I.error_rate_alert(log, F.col("code") == 429, "code").collect()}
    assert got == {429: True, 200: False}


@pytest.mark.parametrize("n,widget", [(3, "list"), (101, "search")])
def test_filter_widget(spark, n, widget):
    df = spark.range(n).select(F.col("id").cast("string").alias("model"))
    assert V.filter_widget(df, "model").first().widget == widget
    assert V.preview(df, 2).count() == 2


def test_ide_workspace_is_not_counted_twice(spark):
    api = dated(spark, [("2025-10-01", "w", 1.0), ("2025-10-01", None, 2.0)], "activity_date string, workspace_id string, amount_usd double", "activity_date")
    api = api.selectExpr("*", "'m' AS model", "'d' AS description", "'tokens' AS cost_type")
    ide = dated(spark, [("2025-10-01", "a", 4.0)], "activity_date string, user_email string, total_estimated_cost_usd double", "activity_date")
    ed = dated(spark, [("2025-10-01", "a", "m", None)], "activity_date string, user_email string, most_used_model string, daily_spend_usd double", "activity_date")
    total = lambda **kw: float(C.combined_daily_costs(api, ide, ed, **kw).agg(F.sum("amount_usd")).first()[0])
    assert (total(), total(ide_workspace="w")) == (7.0, 6.0)


def test_lookup_keeps_the_fact_grain(spark):
    facts = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3), (None, 4)], "k string, n int")
    dim = spark.createDataFrame([("k1", "b"), ("k1", "a"), (None, "z")], "k string, v string")
    got = sorted((r.n, r.v) for r in J.lookup(facts, dim, "k", {"v": "v"}).collect())
    assert got == [(1, "a"), (2, "a"), (3, None), (4, None)]


def test_acceptance_above_ten_is_kept(spark):
    from meterlake.plans.attribution import _acceptance

    df = spark.createDataFrame([(500, 1), (1, 3), (5, 0)], "a long, b long")
    assert [str(r[0]) for r in df.select(_acceptance(F.col("a"), F.col("b"))).collect()] == ["500.0000", "0.3333", "0.0000"]


def test_cost_star_total_is_the_combined_total(spark):
    """Cost without usage, a default workspace, a NULL model and a NULL provider all stay."""
    from meterlake.plans import attribution as A

    costs = spark.createDataFrame([("2025-10-01", "w", "m", "5.00"), ("2025-10-01", None, "m", "7.00"), ("2025-10-01", "w", None, "10.00"), ("2025-10-02", "w", "m", "0.01")], "d string, workspace_id string, model string, usd string")
    costs = costs.selectExpr("CAST(d AS DATE) AS activity_date", "workspace_id", "model", "CAST(usd AS DECIMAL(18,6)) AS amount_usd")
    usage = spark.createDataFrame([("2025-10-01", "k1", "w", "m", 1), ("2025-10-01", "k2", "w", "m", 2), ("2025-10-01", "k3", None, "m", 1)], "d string, api_key_id string, workspace_id string, model string, n long")
    usage = usage.select(F.col("d").cast("date").alias("activity_date"), "api_key_id", "workspace_id", "model", *[F.col("n").alias(k) for k in A.TOKEN_KINDS])
    combined = costs.selectExpr("activity_date AS cost_date", "'claude_api' AS provider", "CAST(NULL AS STRING) AS user_email", "model", "'x' AS cost_category", "amount_usd")
    more = combined.selectExpr("cost_date", "CAST(NULL AS STRING) AS provider", "user_email", "model", "cost_category", "CAST(2 AS DECIMAL(18,6)) AS amount_usd").limit(1)
    combined = combined.unionByName(more)
    keys = spark.createDataFrame([("k1", "u@x")], "api_key_id string, mapped_user_email string")
    for null_safe in (False, True):
        star = A.fct_cost_daily(A.allocate_cost_to_keys(costs, usage, null_safe), combined, keys, costs)
        assert star.agg(F.sum("cost_usd")).first()[0] == combined.agg(F.sum("amount_usd")).first()[0]


def test_bands_and_ranks_go_by_exact_values(spark):
    from meterlake.plans import insights as I

    costs = spark.createDataFrame([("a", "14.996"), ("b", "14.999")], "user_email string, usd string").selectExpr("DATE'2025-01-01' AS cost_date", "user_email", "CAST(usd AS DECIMAL(18,6)) AS amount_usd")
    usage = spark.createDataFrame([("a", 100), ("b", 100)], "user_email string, accepted_lines_added long")
    got = {r.user_email: (r.efficiency_band, r.user_rank) for r in I.cost_allocation(costs, usage).collect()}
    assert got == {"a": ("Excellent", 1), "b": ("Excellent", 2)}
    days = [("2025-01-05", "u", 100, 10), ("2025-01-05", "v", 100, 20), ("2025-02-05", "u", 100, 90), ("2025-02-05", "v", 100, 80)]
    rows = spark.createDataFrame(days, "d string, user_email string, total_lines_added long, accepted_lines_added long").selectExpr("CAST(d AS DATE) AS activity_date", "*")
    tiers = {(r.period_start.month, r.user_email): r.tier for r in I.productivity_metrics(rows).collect()}
    assert tiers == {(1, "u"): "Bottom 25%", (1, "v"): "Top 25%", (2, "u"): "Top 25%", (2, "v"): "Bottom 25%"}


def test_elapsed_is_an_interval(spark):
    from meterlake.functions.dates import elapsed

    row = spark.sql("SELECT TIMESTAMP'2025-01-01 10:00:00' AS a, TIMESTAMP'2025-01-02 11:30:00' AS b").select(elapsed(F.col("a"), F.col("b")).alias("e")).first()
    assert row.e == dt.timedelta(days=1, hours=1, minutes=30)


def test_users_by_day_are_held_in_all_shuffle_partitions(spark):
    """The fact's tasks hold no table of users beside their own; rows without a user do not meet in one task."""
    import datetime as dt

    from executed import final_plan

    from meterlake.plans import validation as V

    d = dt.date(2025, 1, 1)
    none = [(d, "a", None, f"k{i}", "m", 1 - i % 3, 0) for i in range(400)]
    fct = spark.createDataFrame(none + [(d, "a", f"u{i % 50}", "k", f"m{i}", 1, -(i % 2)) for i in range(100)],
                                "usage_date date, platform string, user_email string, api_key_id string, model string, input_tokens bigint, output_tokens bigint")
    users = V._by_user(fct)
    parts = [r["count"] for r in users.where("user_email IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    assert len(parts) > 4
    assert [tuple(r) for r in V.attribution_rate(fct, d).collect()] == [(d, "a", 500, 50, 0.2)]
    assert [tuple(r) for r in V.anomaly_counts(fct, d).collect()] == [(d, "a", 500, 133 + 50, 50)]
    assert "REPARTITION_BY_NUM" in final_plan(V.anomaly_counts(fct, d))


def test_daily_productivity_adds_up_once(spark, sf_dir):
    """By day nothing is left to fold: one table of users and days a task, not one of days and two of periods."""
    from meterlake.queries import all_queries

    plan = all_queries()["productivity_metrics_daily"].run(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    by_user = [line for line in plan if "Aggregate [" in line and "user_email" in line.split("],")[0]]
    assert len(by_user) == sum("Relation [" in line for line in plan) > 0
