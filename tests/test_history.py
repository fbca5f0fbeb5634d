"""Rows that an earlier load stored are refused, and only days with a hit are read to know."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.sinks import history
from meterlake.sinks.history import append_new, filters, index, maybe_stored
from meterlake.sinks.loads import REJECTED, Change, Conflict, Loads

NAME, KEY = "claude_ai_usage_stats", ["event_id"]


@pytest.fixture()
def store(spark, tmp_path):
    return Loads(spark, str(tmp_path / "lake"))


def frame(spark, *rows):
    df = spark.createDataFrame(list(rows), "activity_date string, event_id string, user_email string")
    return df.withColumn("activity_date", F.col("activity_date").cast("date"))


def ids(df):
    return sorted((str(r.activity_date)[-2:], r.event_id or "", r.user_email) for r in df.collect())


def test_only_days_with_a_hit_are_read(spark, store, monkeypatch):
    read, real = [], Loads.read_days
    monkeypatch.setattr(Loads, "read_days", lambda self, t, days, **k: (read.append((t, sorted(days))), real(self, t, days, **k))[1])
    append_new(store, NAME, frame(spark, *[(f"2025-10-{d:02d}", f"e{d}", "u") for d in range(1, 6)]), KEY)
    append_new(store, NAME, frame(spark, ("2025-10-02", "e2", "late"), ("2025-10-02", "x", "v"), ("2025-10-04", "y", "v"), ("2025-10-09", "e1", "v")), KEY)
    assert [days for t, days in read if t == NAME] == [[dt.date(2025, 10, 2)]]
    assert ids(store.read(NAME)) == [("01", "e1", "u"), ("02", "e2", "u"), ("02", "x", "v"), ("03", "e3", "u"), ("04", "e4", "u"), ("04", "y", "v"), ("05", "e5", "u"), ("09", "e1", "v")]
    refused = store.read(NAME + REJECTED)
    assert ids(refused) == [("02", "e2", "late")] and refused.first().errors == [history.AGAIN]
    assert {r.day.day: r.rows for r in store.state().where(F.col("table") == NAME).collect()}[2] == 2


def test_nulls_and_copies_within_a_load(spark, store):
    twice = frame(spark, ("2025-10-01", None, "a"), ("2025-10-01", None, "b"), ("2025-10-01", "", "c"))
    append_new(store, NAME, twice, KEY)
    append_new(store, NAME, twice.limit(0), KEY)
    append_new(store, NAME, frame(spark, ("2025-10-01", None, "z"), ("2025-10-01", "", "z"), ("2025-10-01", "n", "z")), KEY)
    assert ids(store.read(NAME)) == [("01", "", "a"), ("01", "", "b"), ("01", "", "c"), ("01", "n", "z")]
    with pytest.raises(ValueError, match="without activity_date"):
        append_new(store, NAME, frame(spark, (None, "q", "z")), KEY)
    assert store.read(NAME).count() == 4


def test_a_named_load_counts_once_and_a_stopped_one_leaves_nothing(spark, store, monkeypatch):
    rows = frame(spark, ("2025-10-01", "a", "u"), ("2025-10-02", "b", "u"))

    def stop(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        m.setattr(Loads, "_publish", stop)
        with pytest.raises(KeyboardInterrupt):
            append_new(store, NAME, rows, KEY, load="x")
    assert store.read(NAME).count() == 0
    first = append_new(store, NAME, rows, KEY, load="x")
    assert append_new(store, NAME, rows, KEY, load="x") == first and store.read(NAME).count() == 2


def test_another_load_between_is_seen(spark, store, monkeypatch):
    """The row arrives by another load after it was looked up: the lookup is done again."""
    rows, real = frame(spark, ("2025-10-01", "a", "u")), history.maybe_stored
    append_new(store, NAME, frame(spark, ("2025-10-01", "old", "u")), KEY)

    def overtaken(*args):
        found = real(*args)
        monkeypatch.setattr(history, "maybe_stored", real)
        append_new(store, NAME, rows, KEY)
        return found

    monkeypatch.setattr(history, "maybe_stored", overtaken)
    append_new(store, NAME, rows, KEY)
    assert ids(store.read(NAME)) == [("01", "a", "u"), ("01", "old", "u")]
    with pytest.raises(Conflict):
        store.commit({NAME: Change(rows)}, after=1)


def test_filters_miss_nothing_and_hit_little_else(spark, store):
    day = F.lit("2025-10-01").cast("date").alias("activity_date")
    old = spark.range(20_000).select(day, F.col("id").cast("string").alias("event_id"))
    assert filters(old, "activity_date", ["activity_date", *KEY], "l").count() == 10  # 20,000 * 16 / 32768 blocks
    append_new(store, NAME, old, KEY)
    on = ["activity_date", *KEY]
    assert maybe_stored(store, NAME, old, on).count() == 20_000
    others = spark.range(20_000, 60_000).select(day, F.col("id").cast("string").alias("event_id"))
    assert maybe_stored(store, NAME, others, on).count() < 40_000 * 0.01


def test_days_stored_another_way_are_indexed(spark, store):
    store.commit({NAME: Change(frame(spark, ("2025-10-01", "a", "u"), ("2025-10-02", "b", "u")))})
    index(store, NAME, KEY)
    append_new(store, NAME, frame(spark, ("2025-10-01", "a", "v"), ("2025-10-02", "a", "v")), KEY)
    assert ids(store.read(NAME)) == [("01", "a", "u"), ("02", "a", "v"), ("02", "b", "u")]


def test_new_rows_are_found_once(spark, tmp_path, monkeypatch):
    """The table and its filters read the kept new rows; the comparison with the stored ones is not run for each of them."""
    store = Loads(spark, str(tmp_path / "lake"))
    append_new(store, NAME, frame(spark, ("2025-10-01", "a", "u"), ("2025-10-02", "b", "u")), KEY)
    plans, commit = [], Loads.commit
    monkeypatch.setattr(Loads, "commit", lambda self, changes, *a, **k: plans.append({t: c.rows._jdf.queryExecution().optimizedPlan().toString() for t, c in changes.items()}) or commit(self, changes, *a, **k))
    append_new(store, NAME, frame(spark, ("2025-10-01", "a", "v"), ("2025-10-01", "c", "v")), KEY)
    assert len(plans) == 1 and not any("LeftAnti" in p for p in plans[0].values())
    assert store.read(NAME).count() == 3 and store.read(NAME + "_rejected").count() == 1
