"""Daily loads end to end on landed files."""

import json

import pytest
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake.plans.backfill import auto_detect_missing
from meterlake.sinks.loads import Loads


@pytest.fixture()
def store(spark, tmp_path):
    return Loads(spark, str(tmp_path / "lake"))


def put(path, name, obj):
    path.mkdir(exist_ok=True)
    (path / name).write_text(json.dumps(obj))
    return str(path)


def bucket(day, *results):
    return {"starting_at": f"{day}T00:00:00Z", "results": list(results)}


def cost_page(path, name, *days):
    return put(path, name, {"data": [bucket(d, *[{"amount": str(a), "model": f"m{i}"} for i, a in enumerate(amounts)]) for d, *amounts in days]})


def vendor(tmp_path, *amounts):
    day = "2025-10-15"
    return dict(
        cost_pages=cost_page(tmp_path / "c", "1.json", (day, *amounts), ("2025-10-16", 7)),
        usage_pages=put(tmp_path / "u", "1.json", {"data": [bucket(day, {"api_key_id": "k", "output_tokens": 3})]}),
        productivity_pages=put(tmp_path / "p", "1.json", {"data": [{"date": f"{day}T00:00:00Z", "actor": {"type": "user_actor"}}]}),
    )


def test_vendor_day_twice(spark, tmp_path, store):
    for _ in range(2):
        jobs.load_vendor_day(store, "2025-10-15", "org", **vendor(tmp_path, 150, 250))
    counts = {t: store.read(t).count() for t in ("claude_costs", "claude_usage_keys", "claude_code_productivity")}
    assert counts == {"claude_costs": 2, "claude_usage_keys": 1, "claude_code_productivity": 1}
    assert float(store.read("claude_costs").agg(F.sum("amount_usd")).first()[0]) == 4.0


def test_refused_day_writes_nothing(spark, tmp_path, store):
    with pytest.raises(jobs.CheckFailed, match="exceeds"):
        jobs.load_vendor_day(store, "2025-10-15", "org", day_max=1000.0, **vendor(tmp_path, 99999999))
    assert store.version() == 0 and store.read("claude_costs").count() == 0
    args = vendor(tmp_path, 1)
    args["cost_pages"] = put(tmp_path / "d", "1.json", {"data": [bucket("2025-10-15", {"amount": "1"}, {"amount": "2"})]})
    with pytest.raises(jobs.CheckFailed, match="duplicate"):
        jobs.load_vendor_day(store, "2025-10-15", "org", **args)


def test_editor_days_accumulate(spark, tmp_path, store):
    def day(d, cents):
        usage = put(tmp_path / f"u{d}", "1.json", [{"day": f"2025-10-{d}", "userId": "u", "email": "user1@example.com"}, {"day": f"2025-10-{d}", "userId": "v", "email": "user2@example.com"}])
        spend = put(tmp_path / f"s{d}", "1.json", {"teamMemberSpend": [{"email": "user1@example.com", "spendCents": cents}, {"email": "user9@example.com", "spendCents": 5}], "subscriptionCycleStart": 1759523607000})
        jobs.load_editor_day(store, f"2025-10-{d}", usage_pages=usage, spend_pages=spend)

    for d, cents in ((18, 1000), (19, 900), (20, 1750), (20, 1750)):
        day(d, cents)
    rows = store.read("cursor_daily_metrics").filter("user_id = 'u'").orderBy("activity_date").collect()
    assert [float(r.daily_spend_usd) for r in rows] == [10.0, 0.0, 7.5]
    others = store.read("cursor_daily_metrics").filter("user_id = 'v'").collect()
    assert len(others) == 3 and {r.daily_spend_usd for r in others} == {None}


def test_activity_export_replaces_its_span(spark, tmp_path, store):
    def export(name, *days):
        rows = [f"2025-10-{d:02d}T01:00:00Z,file_uploaded,\"{{'metadata': {{'email_address': 'user{d}@example.com'}}}}\",{{}},{{}},ios,,," for d in days]
        path = tmp_path / name
        path.write_text("created_at,event,actor_info,entity_info,event_info,client_platform,device_id,user_agent,ip_address\n" + "\n".join(rows) + "\n")
        return jobs.load_activity_export(store, str(path))

    assert export("a.csv", 1, 2, 3, 4).count() == 4
    summary = export("b.csv", 2, 4).collect()
    assert [(r.activity_date.day, r.records) for r in summary] == [(4, 1), (2, 1)]
    got = [r.activity_date.day for r in store.read("claude_app_usage_logs").orderBy("activity_date").collect()]
    assert got == [1, 2, 4]


def test_backfill_skips_bad_days_and_retry_fills_them(spark, tmp_path, store):
    pages = cost_page(tmp_path / "c", "1.json", ("2025-10-01", 100), ("2025-10-02", 99999999), ("2025-10-04", 300, 400))
    status = jobs.backfill(store, "2025-10-01", "2025-10-04", "org", cost_pages=pages, day_max=1000.0)
    assert [r.status for r in status.orderBy("date").collect()] == ["ok", "failed", "empty", "ok"]
    costs = store.read("claude_costs")
    assert costs.count() == 3
    missing = auto_detect_missing(costs, "2025-10-01", "2025-10-04")
    again = cost_page(tmp_path / "r", "1.json", ("2025-10-02", 200), ("2025-10-03", 50), ("2025-10-04", 1))
    done = jobs.retry_failed(store, missing, "org", cost_pages=again)
    assert {r.status for r in done.collect()} == {"ok"}
    got = {r.activity_date.day: float(r.c) for r in store.read("claude_costs").groupBy("activity_date").agg(F.sum("amount_usd").alias("c")).collect()}
    assert got == {1: 1.0, 2: 2.0, 3: 0.5, 4: 7.0}


def test_views_for_sql(spark, tmp_path, store):
    jobs.load_vendor_day(store, "2025-10-15", "org", **vendor(tmp_path, 150, 250))
    jobs.register_views(store)
    from meterlake.operators.filters import run_sql
    from meterlake.plans.costs import alert_cache_efficiency, kpi_total_cost

    total = run_sql(spark, "SELECT SUM(amount_usd) AS t FROM vw_combined_daily_costs WHERE cost_date <= CAST(:end AS DATE)", end="2025-10-15")
    assert float(total.first().t) == 4.0
    assert kpi_total_cost(spark.table("vw_combined_daily_costs")).first().claude_api_cost_usd == 4.0
    assert alert_cache_efficiency(spark.table("claude_usage_report")).first().cache_hit_rate_pct is None
    assert spark.table("claude_cost_report").count() == 2


def test_no_ceiling_unless_given_and_descriptions_differ(spark, tmp_path, store):
    args = vendor(tmp_path, 1)
    args["cost_pages"] = put(tmp_path / "d", "1.json", {"data": [bucket("2025-10-15", {"amount": "200000", "description": "a"}, {"amount": "2", "description": "b"})]})
    jobs.load_vendor_day(store, "2025-10-15", "org", **args)
    assert float(store.read("claude_costs").agg(F.sum("amount_usd")).first()[0]) == 2000.02


def test_repeated_and_missing_pages(spark, tmp_path, store):
    args = vendor(tmp_path, 100, 200)
    cost_page(tmp_path / "c", "2.json", ("2025-10-15", 100, 200), ("2025-10-16", 7))
    jobs.load_vendor_day(store, "2025-10-15", "org", **args)
    assert float(store.read("claude_costs").agg(F.sum("amount_usd")).first()[0]) == 3.0
    args["usage_pages"] = put(tmp_path / "more", "1.json", {"data": [], "has_more": True, "next_page": "x"})
    with pytest.raises(jobs.CheckFailed, match="missing"):
        jobs.load_vendor_day(store, "2025-10-15", "org", **args)


def test_rejected_rows_land_beside_the_table(spark, tmp_path, store):
    args = vendor(tmp_path, 100, -5)
    jobs.load_vendor_day(store, "2025-10-15", "org", credits=False, **args)
    assert store.read("claude_costs").count() == 1
    bad = store.read("claude_costs_rejected").collect()
    assert [(float(r.amount_usd), r.errors) for r in bad] == [(-0.05, ["amount_usd is negative"])]


def test_backfill_of_three_tables_with_a_broken_page(spark, tmp_path, store):
    day = lambda n: f"2025-10-0{n}"
    pages = cost_page(tmp_path / "c", "1.json", (day(1), 100))
    cost_page(tmp_path / "c", "3.json", (day(3), 300))
    (tmp_path / "c" / "2.json").write_text('{"data": [{"starting_at": "2025-10-02T00:00:00Z", "results": [{"amount": "5"')
    usage = put(tmp_path / "u", "1.json", {"data": [bucket(day(n), {"api_key_id": "k", "output_tokens": n}) for n in (1, 2, 3)]})
    ide = put(tmp_path / "p", "1.json", {"data": [{"date": f"{day(2)}T00:00:00Z", "actor": {"type": "user_actor"}}]})
    status = jobs.backfill(store, day(1), day(3), "org", cost_pages=pages, usage_pages=usage, productivity_pages=ide)
    got = {(r["table"], r["date"].day): (r["status"], r["reason"]) for r in status.collect()}
    assert [got["claude_costs", n] for n in (1, 2, 3)] == [("ok", None), ("failed", "malformed page 2.json"), ("ok", None)]
    assert [got["claude_usage_keys", n][0] for n in (1, 2, 3)] == ["ok"] * 3
    assert [got["claude_code_productivity", n][0] for n in (1, 2, 3)] == ["empty", "ok", "empty"]
    assert {t: store.read(t).count() for t in ("claude_costs", "claude_usage_keys", "claude_code_productivity")} == {"claude_costs": 2, "claude_usage_keys": 3, "claude_code_productivity": 1}
