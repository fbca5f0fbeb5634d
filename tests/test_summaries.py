"""Kept partials equal a full recompute, and a day loaded again reads that day only."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterlake.functions.dates import month_start
from meterlake.plans import costs as C
from meterlake.plans import insights as I
from meterlake.plans import validation as V
from meterlake.sinks import summaries as S
from meterlake.sinks.loads import Change, Conflict, Loads

EDITOR = "cursor_daily_metrics"


@pytest.fixture()
def store(spark, tmp_path):
    return Loads(spark, str(tmp_path / "lake"))


def editor(spark, *rows):
    """(day, user, dollars)"""
    df = spark.createDataFrame([(d, u, str(x)) for d, u, x in rows], "activity_date string, user_email string, daily_spend_usd string")
    return df.select(F.col("activity_date").cast("date"), "user_email", F.col("daily_spend_usd").cast("decimal(18,2)"))


def spend(seed, days, users):
    rng = random.Random(seed)
    return [(f"2025-{m:02d}-{d:02d}", rng.choice([None, *users]), rng.randint(0, 900)) for m in (9, 10) for d in days for _ in range(9)]


def full(store):
    return C.combined_daily_costs(*[store.read(t) for t in S.COSTS.sources])


def same(a, b):
    order = [str(r) for r in a.collect()], [str(r) for r in b.collect()]
    assert sorted(order[0]) == sorted(order[1]) and order[0]


def check(store):
    same(S.monthly_summary(store), C.monthly_summary(full(store)))
    same(S.monthly_finance(store), I.monthly_finance(full(store)))
    same(S.executive_summary(store), I.executive_summary(full(store)))


def test_replaced_days_only_are_read(spark, store, monkeypatch):
    read, real = [], Loads.read_days
    monkeypatch.setattr(Loads, "read_days", lambda self, t, days, **k: (read.append((t, sorted(days))), real(self, t, days, **k))[1])
    store.commit({EDITOR: Change(editor(spark, *spend(1, range(1, 6), "abcdef")))})
    S.refresh_costs(store)
    check(store)
    assert S.stale_days(store, S.COSTS) == []
    last = S.refresh_costs(store)
    assert store.version() == last == 2
    # One day gets other users, one of them new; a day goes.
    store.commit({EDITOR: Change(editor(spark, ("2025-09-03", "a", 5), ("2025-09-03", "new", 7)))})
    store.commit({EDITOR: Change(store.read(EDITOR).limit(0), days=[dt.date(2025, 10, 5)])})
    read.clear()
    S.refresh_costs(store)
    assert [d for t, d in read if t == EDITOR] == [[dt.date(2025, 9, 3), dt.date(2025, 10, 5)]]
    check(store)
    assert dt.date(2025, 10, 5) not in store.days(S.COSTS.totals) and dt.date(2025, 10, 5) not in store.days(S.COSTS.users)


def test_users_keep_their_numbers(spark, store):
    for seed, users in ((1, "abc"), (2, "bcdefgh"), (3, "ax")):
        store.commit({EDITOR: Change(editor(spark, *spend(seed, range(1, 4), users)))})
        before = {r.user_email: r.id for r in store.read(S.IDS).collect()}
        S.refresh_costs(store)
        after = {r.user_email: r.id for r in store.read(S.IDS).collect()}
        assert before.items() <= after.items()
        assert sorted(after.values()) == list(range(1, len(after) + 1))
    check(store)


def test_distinct_users_over_many_blocks(spark, store):
    """More users than one bitmap holds, in days that overlap."""
    rows = spark.range(50_000).select(
        F.explode(F.array(*[F.lit(f"2025-10-0{d}").cast("date") for d in (1, 2)])).alias("cost_date"), F.lit("cursor").alias("provider"),
        F.concat(F.lit("u"), "id").alias("user_email"), F.lit(1).cast("decimal(18,6)").alias("amount_usd"),
    )
    rows = rows.where("cost_date = DATE '2025-10-01' OR substr(user_email, -1) <> '7'")
    days = [dt.date(2025, 10, 1), dt.date(2025, 10, 2)]
    S.refresh(store, S.COSTS, lambda _: rows, days)
    assert {r.part for r in store.read(S.COSTS.users).collect()} == {1, 2}
    by_day = S.distinct_users(store, S.COSTS, F.col("cost_date"))
    assert sorted(r.users for r in by_day.collect()) == [45_000, 50_000]
    assert [tuple(r) for r in S.distinct_users(store, S.COSTS, month_start("cost_date").alias("m")).collect()] == [(dt.date(2025, 10, 1), 50_000)]
    assert S.distinct_users(store, S.COSTS).first().users == 50_000


def test_rows_without_user_and_empty_tables(spark, store):
    S.refresh_costs(store)
    assert store.version() == 0 and S.monthly_summary(store).count() == 0 and S.executive_summary(store).count() == 0
    store.commit({EDITOR: Change(editor(spark, ("2025-10-01", None, 3)))})
    S.refresh_costs(store)
    check(store)
    assert S.executive_summary(store).first().active_users == 0
    assert store.read(S.IDS).count() == 0


def test_two_refreshes_at_once_never_share_a_number(spark, store, monkeypatch):
    store.commit({EDITOR: Change(editor(spark, ("2025-10-01", "a", 1), ("2025-10-02", "b", 2)))})
    real = S._changes
    facts = lambda days: C.combined_daily_costs(*[store.read_days(t, days) for t in S.COSTS.sources])

    def overtaken(*args):
        mine = real(*args)
        monkeypatch.setattr(S, "_changes", real)
        S.refresh(store, S.COSTS, facts, [dt.date(2025, 10, 2)])
        return mine

    monkeypatch.setattr(S, "_changes", overtaken)
    S.refresh(store, S.COSTS, facts, [dt.date(2025, 10, 1)])
    assert sorted(r.id for r in store.read(S.IDS).collect()) == [1, 2]
    check(store)
    monkeypatch.setattr(S, "_changes", lambda *a: (store.commit({EDITOR: Change(editor(spark, ("2025-11-01", "c", 1)))}), real(*a))[1])
    with pytest.raises(Conflict):
        S.refresh(store, S.COSTS, facts, [dt.date(2025, 10, 1)], tries=2)


LOGS = "claude_app_usage_logs"


def logs(spark, seed, days, n=60):
    """Events with conversations and projects that come back on other days, of other types, or not at all."""
    rng = random.Random(seed)
    pick = lambda letter, m: rng.choice([None, *[f"{letter}{i}" for i in range(m)]])
    rows = [(f"2025-10-{d:02d}", pick("u", 9), pick("t", 4), pick("x", 3), pick("c", 40), pick("p", 5)) for d in days for _ in range(n)]
    names = "activity_date string, user_email string, event_type string, client_platform string, conversation_uuid string, project_uuid string"
    return spark.createDataFrame(rows, names).withColumn("activity_date", F.col("activity_date").cast("date"))


def check_events(store, **span):
    from executed import final_plan

    facts = store.read(LOGS)
    mine, whole = S.event_summary(store, **span), V.event_summary(facts, **span)
    assert mine.columns == whole.columns or set(mine.columns) == set(whole.columns)
    same(mine.select(*whole.columns), whole)
    kinds = S.events_by_type(store, **span)
    same(kinds.select(*V.events_by_type(facts, **span).columns), V.events_by_type(facts, **span))
    for df in (mine, kinds):
        plan = final_plan(df)
        assert "Expand" not in plan and LOGS not in plan


def test_several_distinct_counts_come_from_bitmaps(spark, store):
    store.commit({LOGS: Change(logs(spark, 1, range(1, 5)))})
    S.refresh_events(store)
    check_events(store)
    check_events(store, start="2025-10-02", end="2025-10-03")
    # A day is loaded again, with values that no other day has.
    store.commit({LOGS: Change(logs(spark, 2, [3], 5).unionByName(logs(spark, 3, [3], 2).withColumn("conversation_uuid", F.lit("new"))))})
    S.refresh_events(store)
    check_events(store)
    for name, group in (("conversation_uuid", 41), ("project_uuid", 5)):
        ids = [r.id for r in store.read(S.VALUES).where(F.col("name") == name).collect()]
        assert sorted(ids) == list(range(1, len(ids) + 1)) and len(ids) <= group
    by_day = S.distinct_values(store, S.EVENTS, "project_uuid", F.col("activity_date"))
    same(by_day, store.read(LOGS).groupBy("activity_date").agg(F.countDistinct("project_uuid").alias("values")))
    with pytest.raises(ValueError):
        S.distinct_values(store, S.EVENTS, "user_agent")


def test_event_counts_of_nothing(spark, store):
    S.refresh_events(store)
    row = S.event_summary(store).first()
    assert (row.total_events, row.unique_users, row.unique_event_types, row.unique_conversations, row.unique_projects) == (0, 0, 0, 0, 0)
    assert row.earliest_date is None and S.events_by_type(store).collect() == []
    store.commit({LOGS: Change(logs(spark, 4, [1], 3).withColumns({c: F.lit(None).cast("string") for c in ("user_email", "conversation_uuid", "project_uuid")}))})
    S.refresh_events(store)
    check_events(store)
