"""Loads take effect at once, can be repeated, and leave untouched files alone."""

import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from meterlake import jobs
from meterlake.plans.attribution import apply_spend
from meterlake.sinks import loads
from meterlake.sinks.loads import Change, Loads
from meterlake.sources import json_reports

NAME = "cursor_daily_metrics"


@pytest.fixture()
def store(spark, tmp_path):
    return Loads(spark, str(tmp_path / "lake"))


def frame(spark, *data):
    df = spark.createDataFrame(list(data), "activity_date string, user_email string, total_accepts bigint")
    return df.withColumn("activity_date", F.col("activity_date").cast("date"))


def stored(store, **at):
    return sorted((str(r.activity_date), r.user_email, r.total_accepts) for r in store.read(NAME, **at).collect())


def october(spark, *days, user="a"):
    return frame(spark, *[(f"2025-10-{d:02d}", user, d) for d in days])


class Killed(BaseException):
    pass


OLD = [(f"2025-10-0{i}", "a", i) for i in range(1, 6)]
NEW = [OLD[0], ("2025-10-02", "n", 2), ("2025-10-04", "n", 4), OLD[4]]


def test_range_is_replaced_with_days_the_export_lacks(spark, store):
    store.commit({NAME: Change(october(spark, 1, 2, 3, 4, 5))})
    for _ in range(2):
        assert store.replace_range(NAME, october(spark, 2, 4, user="n")) == (dt.date(2025, 10, 2), dt.date(2025, 10, 4))
        assert stored(store) == NEW
    assert store.replace_range(NAME, october(spark).limit(0)) is None
    assert stored(store) == NEW and stored(store, version=1) == OLD
    assert stored(store, start="2025-10-03", end="2025-10-04") == [NEW[2]]
    assert store.read(NAME).filter("ingestion_timestamp IS NULL").count() == 0
    assert store.vacuum() > 0 and stored(store) == NEW


@pytest.mark.parametrize("step", ["_written", "days", "version", "_publish"])
@pytest.mark.parametrize("after", [False, True])
def test_killed_between_any_two_steps(spark, store, monkeypatch, step, after):
    """Readers see the old range or the new one, and the same load can be run again."""
    store.commit({NAME: Change(october(spark, 1, 2, 3, 4, 5))})
    real = getattr(Loads, step)

    def stop(self, *args, **kwargs):
        if after:
            real(self, *args, **kwargs)
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(Loads, step, stop)
        with pytest.raises(Killed):
            store.replace_range(NAME, october(spark, 2, 4, user="n"), load="x")
    assert stored(store) == (NEW if step == "_publish" and after else OLD)
    store.replace_range(NAME, october(spark, 2, 4, user="n"), load="x")
    assert stored(store) == NEW
    assert store.replace_range(NAME, october(spark, 3, user="again"), load="x") and stored(store) == NEW  # the name is in the log


def test_killed_while_the_log_file_is_written(spark, store, monkeypatch):
    store.commit({NAME: Change(october(spark, 1))})
    (log,) = glob.glob(f"{store.root}/log/*.json")
    with open(f"{store.root}/log/_half", "w") as f:
        f.write(open(log).read()[:20])
    assert stored(store) == [OLD[0]]


def test_two_loads_at_once(spark, store, monkeypatch):
    """The one that comes second to a version takes the next; an update of files refuses."""
    other = Loads(spark, store.root)
    real = Loads._publish

    def late(self, name, text):
        monkeypatch.setattr(Loads, "_publish", real)
        other.commit({NAME: Change(october(spark, 2, user="o"))})
        return real(self, name, text)

    monkeypatch.setattr(Loads, "_publish", late)
    store.commit({NAME: Change(october(spark, 1))})
    assert stored(store) == [OLD[0], ("2025-10-02", "o", 2)]
    monkeypatch.setattr(Loads, "_publish", late)
    deltas = october(spark, 1).withColumn("daily_spend_usd", F.lit(1))
    with pytest.raises(loads.Conflict):
        store.update(NAME, deltas, ["activity_date", "user_email"], lambda r: apply_spend(r, deltas))


def test_undated_rows_refuse_a_plain_load(spark, store):
    store.commit({NAME: Change(october(spark, 1))})
    with pytest.raises(ValueError, match="without activity_date"):
        store.replace_range(NAME, frame(spark, ("2025-10-01", "n", 1), (None, "x", 1)))
    with pytest.raises(ValueError, match="no column"):
        store.commit({NAME: Change(october(spark, 1).withColumn("new_metric", F.lit(1)))})
    assert stored(store) == [OLD[0]]


def test_update_rewrites_only_files_with_a_key(spark, store):
    rows = spark.range(4000).selectExpr("DATE'2025-10-01' + CAST(id % 2 AS INT) AS activity_date", "CONCAT('u', id) AS user_email", "id AS total_accepts")
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "500")
    try:
        store.commit({NAME: Change(rows)})
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")

    def files():
        return {f: (os.path.getsize(f), os.path.getmtime(f)) for f in (p.removeprefix("file://") for p in store.read(NAME).inputFiles())}

    before = files()
    deltas = frame(spark, ("2025-10-01", "u0", 0), ("2025-10-01", "absent", 0), ("2025-12-24", "u2", 0)).withColumn("daily_spend_usd", F.lit("1.25").cast("decimal(18,2)"))
    on, apply = ["activity_date", "user_email"], lambda r: apply_spend(r, deltas)
    for _ in range(2):
        store.update(NAME, deltas, on, apply)
    after = files()
    assert len(before) >= 8 and len(before.keys() - after.keys()) == 1
    assert all(after[f] == before[f] for f in before.keys() & after.keys())
    got = store.read(NAME)
    assert got.count() == 4000 and got.where("daily_spend_usd = 1.25").select("user_email").collect() == [("u0",)]
    assert store.state().agg(F.sum("rows")).first()[0] == 4000
    version = store.version()
    assert store.update(NAME, deltas.where("user_email = 'absent'"), on, apply) == version
    store.vacuum()
    assert store.read(NAME).count() == 4000


def page(folder, name, *days):
    folder.mkdir(exist_ok=True)
    buckets = [{"starting_at": f"{d}T00:00:00Z", "results": [{"amount": str(a), "model": f"{name} {i}"} for i, a in enumerate(amounts)]} for d, *amounts in days]
    (folder / name).write_text(json.dumps({"data": buckets}))
    return str(folder)


def test_status_says_what_is_stored_and_rejects_land_once(spark, store, tmp_path):
    pages = page(tmp_path / "c", "1.json", ("2025-10-01", 100000, -40000), ("2025-10-02", -5))
    for credits, want in ((True, [(2, 0, 600.0, "ok", False), (1, 0, -0.05, "ok", False)]), (False, [(1, 1, 1000.0, "ok", True), (0, 1, None, "failed", True)])):
        for _ in range(2):
            status = jobs.backfill(store, "2025-10-01", "2025-10-02", "org", cost_pages=pages, credits=credits).orderBy("date").collect()
            assert [(r.rows, r.rejected, r.total_cost, r.status, r.alert) for r in status] == want
    assert status[1].reason == "all rows rejected"
    bad = store.read("claude_costs_rejected").collect()
    assert sorted((float(r.amount_usd), r.errors[0]) for r in bad) == [(-400.0, "amount_usd is negative"), (-0.05, "amount_usd is negative")]
    assert float(store.read("claude_costs", "2025-10-01", "2025-10-01").agg(F.sum("amount_usd")).first()[0]) == 1000.0
    jobs.backfill(store, "2025-10-01", "2025-10-02", "org", cost_pages=pages)
    assert store.read("claude_costs_rejected").count() == 0


def test_failed_load_leaves_its_rejects_out(spark, store, tmp_path, monkeypatch):
    pages = page(tmp_path / "c", "1.json", ("2025-10-01", 100, -5))

    def stop(*_):
        raise Killed

    monkeypatch.setattr(Loads, "_publish", stop)
    with pytest.raises(Killed):
        jobs.backfill(store, "2025-10-01", "2025-10-01", "org", cost_pages=pages, credits=False)
    monkeypatch.undo()
    assert [store.read(f"claude_costs{kind}").count() for kind in ("", "_rejected", "_status")] == [0, 0, 0]


def test_export_with_a_blank_date_loads_the_rest(spark, store, tmp_path):
    def line(at, who):
        return f"{at},file_uploaded,\"{{'metadata': {{'email_address': '{who}@example.com'}}}}\",{{}},{{}},ios,,,"

    path = tmp_path / "a.csv"
    path.write_text("created_at,event,actor_info,entity_info,event_info,client_platform,device_id,user_agent,ip_address\n" + "\n".join([line("2025-10-01T01:00:00Z", "a"), line("", "b"), line("2025-10-03T01:00:00Z", "c")]) + "\n")
    for _ in range(2):
        assert [(r.activity_date.day, r.records) for r in jobs.load_activity_export(store, str(path)).collect()] == [(3, 1), (1, 1)]
    bad = store.read("claude_app_usage_logs_rejected").collect()
    assert [(r.user_email, r.load_day.day) for r in bad] == [("b@example.com", 1)] and "missing activity_date" in bad[0].errors
    assert {r.date.day: (r.rows, r.rejected) for r in store.read("claude_app_usage_logs_status").collect()} == {1: (1, 1), 2: (0, 0), 3: (1, 0)}


def test_stopped_backfill_goes_on_without_parsing_done_days(spark, store, tmp_path, monkeypatch):
    folder = tmp_path / "c"
    for d in range(1, 7):
        page(folder, f"{d}.json", (f"2025-10-0{d}", d * 100), *([(f"2025-10-0{d + 1}", 7)] if d == 2 else []))
    read, published = [], []
    real_read, real_publish = json_reports.read_good_pages, Loads._publish
    monkeypatch.setattr(json_reports, "read_good_pages", lambda s, paths, schema: read.append(sorted(os.path.basename(p) for p in paths)) or real_read(s, paths, schema))

    def publish(self, *args):
        if len(published) == 2:
            raise Killed
        published.append(args[0])
        return real_publish(self, *args)

    monkeypatch.setattr(Loads, "_publish", publish)
    run = lambda: jobs.backfill(store, "2025-10-01", "2025-10-07", "org", cost_pages=str(folder), run="r", chunk_days=2)
    with pytest.raises(Killed):
        run()
    assert read == [["1.json", "2.json"], ["2.json", "3.json", "4.json"], ["5.json", "6.json"]]
    assert store.read("claude_costs_status").count() == 4
    monkeypatch.setattr(Loads, "_publish", real_publish)
    read.clear()
    status = {r.date.day: r.status for r in run().collect()}
    assert read == [["5.json", "6.json"]]  # the last chunk's day has no file
    assert status == {**dict.fromkeys(range(1, 7), "ok"), 7: "empty"}
    totals = {r.activity_date.day: float(r.c) for r in store.read("claude_costs").groupBy("activity_date").agg(F.sum("amount_usd").alias("c")).collect()}
    assert totals == {1: 1.0, 2: 2.0, 3: 3.07, 4: 4.0, 5: 5.0, 6: 6.0}
    read.clear()
    assert run().count() == 7 and read == []


def test_unusual_loads(spark):
    rows = [("t", f"2025-10-{d:02d}", 100 if d != 9 else 20, "ok") for d in range(1, 11)] + [("t", "2025-10-11", 0, "failed")]
    status = spark.createDataFrame(rows, "table string, date string, rows long, status string").withColumn("date", F.col("date").cast("date"))
    assert [(r.date.day, r.rows, r.usual_rows) for r in jobs.unusual_loads(status).collect()] == [(9, 20, 100.0)]


def test_editor_load_refuses_missing_spend_pages(spark, store, tmp_path):
    def put(name, obj):
        (tmp_path / name).mkdir()
        (tmp_path / name / "1.json").write_text(json.dumps(obj))
        return str(tmp_path / name)

    usage = put("u", [{"day": "2025-10-18", "userId": "u", "email": "user1@example.com"}])
    spend = put("s", {"teamMemberSpend": [{"email": "user1@example.com", "spendCents": 5}], "subscriptionCycleStart": 1759523607000, "totalPages": 2})
    with pytest.raises(jobs.CheckFailed, match="1 of 2"):
        jobs.load_editor_day(store, "2025-10-18", usage_pages=usage, spend_pages=spend)
    assert store.version() == 0
