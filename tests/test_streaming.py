"""Streams run until caught up; a second run adds nothing."""

import gzip
import json
import pathlib
import time

import pytest

from meterlake.queries import sources as Q
from meterlake.sources import json_reports as R
from meterlake.streaming import ingest as ST


def land(path, name, day, *amounts):
    results = [{"amount": str(a), "model": "m"} for a in amounts]
    (path / name).write_text(json.dumps({"data": [{"starting_at": f"{day}T00:00:00Z", "results": results}]}, indent=1))


def test_ingest_each_file_once(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    to_rows = lambda pages: R.cost_rows(pages, "org")

    def run():
        ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, to_rows)
        return sorted(float(r.amount_usd) for r in spark.read.parquet(out).collect())

    land(src, "a.json", "2025-10-01", 100, 200)
    assert run() == [1.0, 2.0]
    assert run() == [1.0, 2.0]
    land(src, "b.json", "2025-10-01", 300)  # a date that is stored already keeps its rows
    assert run() == [1.0, 2.0, 3.0]


def test_hourly_counts_dedup_and_late(spark, tmp_path):
    src = tmp_path / "ev"
    ddl = "event_id bigint, ts timestamp_ntz, event_type string"

    def add(*rows):
        spark.createDataFrame(list(rows), "event_id bigint, ts string, event_type string").selectExpr(
            "event_id", "CAST(ts AS timestamp_ntz) AS ts", "event_type"
        ).coalesce(1).write.mode("append").parquet(str(src))

    def run():
        stream = spark.readStream.schema(ddl).parquet(str(src))
        out = ST.run_to_parquet(ST.hourly_event_counts(stream), str(tmp_path / "o"), str(tmp_path / "c"))
        return sorted((r.window_start.hour, r.events) for r in out.collect())

    add((1, "2025-10-01 01:10:00", "x"), (1, "2025-10-01 01:10:00", "x"), (2, "2025-10-01 01:20:00", "x"), (3, "2025-10-01 04:30:00", "x"))
    assert run() == [(1, 2)]
    add((4, "2025-10-01 01:40:00", "x"), (5, "2025-10-01 07:00:00", "x"))  # id 4 is behind the watermark
    assert run() == [(1, 2), (4, 1)]


def test_closing_form_and_next_run_equal_one_count(spark, tmp_path):
    """An id that comes again in the next window is counted in its first one, open or emitted."""
    src, state = tmp_path / "ev", str(tmp_path / "c")
    ddl = "event_id string, ts timestamp_ntz, event_type string"

    def run(*rows):
        df = spark.createDataFrame(list(rows), "event_id string, ts string, event_type string")
        df.selectExpr("event_id", "CAST(ts AS timestamp_ntz) AS ts", "event_type").coalesce(1).write.mode("append").parquet(str(src))
        out = ST.run_to_parquet(ST.hourly_event_counts(spark.readStream.schema(ddl).parquet(str(src))), str(tmp_path / "o"), state)
        count = lambda df: sorted((r.window_start.hour, r.event_type, r.events) for r in df.collect())
        return count(out), count(ST.with_open_windows(out, state))

    assert run(("a", "2025-10-01 10:59:00", "x"), ("b", "2025-10-01 10:10:00", "x"), ("c", "2025-10-01 11:05:00", None)) == ([], [(10, "x", 2), (11, None, 1)])
    assert run(("a", "2025-10-01 11:01:00", "x"), ("d", "2025-10-01 12:30:00", "x")) == ([(10, "x", 2)], [(10, "x", 2), (11, None, 1), (12, "x", 1)])
    emitted, closed = run(("d", "2025-10-01 13:10:00", "x"), ("e", "2025-10-01 20:00:00", "x"))
    assert emitted == [(10, "x", 2), (11, None, 1), (12, "x", 1)] and closed == [*emitted, (20, "x", 1)]


def test_repeated_and_broken_pages(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()

    def run():
        ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, lambda pages: R.cost_rows(pages, "org"))
        broken = spark.read.schema("file string, raw string, digest string").parquet(f"{out}_broken")
        return sorted(float(r.amount_usd) for r in spark.read.parquet(out).collect()), sorted(r.file.rsplit("/", 1)[1] for r in broken.collect())

    land(src, "a.json", "2025-10-01", 100)
    land(src, "b.json", "2025-10-01", 100)
    assert run() == ([1.0], [])
    land(src, "c.json", "2025-10-01", 100)
    land(src, "d.json", "2025-10-01", 200)
    (src / "e.json").write_text('{"data": [{"starting_at": "2025-10-02T00:0')
    (src / "f.json").write_text('{"data": "no list"}')
    assert run() == ([1.0, 2.0], ["e.json", "f.json"])
    land(src, "g.json", "2025-10-02", 300)
    (src / "h.json").write_text((src / "g.json").read_text().replace("\n", ""))  # the same page, written otherwise
    assert run() == ([1.0, 2.0, 3.0], ["e.json", "f.json"])


def lines(path, name, *texts):
    (path / name).write_text("\n".join(texts) + "\n")


def a_page(amount):
    return json.dumps({"data": [{"starting_at": "2025-10-01T00:00:00Z", "results": [{"amount": str(amount), "model": "m"}]}]})


def test_a_page_is_parsed_once_and_whole_files_are_not_read_again(spark, tmp_path, monkeypatch):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    runs, run = [], ST._run
    monkeypatch.setattr(ST, "_run", lambda *a: runs.append(run(*a)) or runs[-1])
    lines(src, "a b.json", *(a_page(100 * i) for i in range(50)))
    lines(src, "c.json", a_page(100), '{"data": [', "  ", a_page(9900), '[{"data": []}]')
    ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, lambda pages: R.cost_rows(pages, "org"), None, False)
    assert sorted(float(r.amount_usd) for r in spark.read.parquet(out).collect()) == [*map(float, range(50)), 99.0]
    broken = spark.read.schema("file string, raw string, digest string").parquet(f"{out}_broken").collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.raw) for r in broken) == [("c.json", '[{"data": []}]'), ("c.json", '{"data": [')]
    assert [sum(p.numInputRows for p in q.recentProgress) for q in runs] == [55, 5]
    assert runs[0]._jsq.explainInternal(False).count("from_json(") == 1


def test_broken_pages_of_a_run_that_failed_between_its_queries(spark, tmp_path, monkeypatch):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    run = ST._run

    def load():
        ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, lambda pages: R.cost_rows(pages, "org"), None, False)

    def fails(frame, path, *rest):
        if path.endswith("_broken"):
            raise RuntimeError("stopped")
        return run(frame, path, *rest)

    lines(src, "a.json", a_page(100), "{")
    monkeypatch.setattr(ST, "_run", fails)
    with pytest.raises(RuntimeError):
        load()
    monkeypatch.setattr(ST, "_run", run)
    lines(src, "b.json", a_page(200))
    lines(src, "c.json", "{x")
    load()
    load()
    assert sorted(float(r.amount_usd) for r in spark.read.parquet(out).collect()) == [1.0, 2.0]
    broken = spark.read.schema("file string, raw string, digest string").parquet(f"{out}_broken").collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.raw) for r in broken) == [("a.json", "{"), ("c.json", "{x")]


def shuffles(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {p for d in dirs for p in pathlib.Path(d).rglob("shuffle_*")}


def test_a_run_leaves_no_shuffle_files(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    lines(src, "a.json", *(a_page(100 * i) for i in range(50)))
    before, kept = shuffles(spark), spark.conf.get(ST.CLEANUP)
    ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, lambda pages: R.cost_rows(pages, "org"), None, False)
    assert spark.conf.get(ST.CLEANUP) == kept
    for _ in range(50):  # they are removed in the background
        if not shuffles(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffles(spark) - before


def test_compressed_pages(spark, tmp_path):
    src, out, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    src.mkdir()
    for name, texts in (("a.txt.gz", [a_page(100), "{", a_page(200)]), ("b.txt.gz", [a_page(200), a_page(300)])):
        with gzip.open(src / name, "wt") as f:
            f.write("\n".join(texts) + "\n")
    lines(src, "c.json", a_page(300), a_page(400))
    ST.ingest_stream(spark, str(src), out, ckpt, R.COST_PAGE, lambda pages: R.cost_rows(pages, "org"), None, False)
    assert sorted(float(r.amount_usd) for r in spark.read.parquet(out).collect()) == [1.0, 2.0, 3.0, 4.0]
    broken = spark.read.schema("file string, raw string, digest string").parquet(f"{out}_broken").collect()
    assert [(r.file.rsplit("/", 1)[1], r.raw) for r in broken] == [("a.txt.gz", "{")]


def test_the_query_lands_compressed_pages(spark, sf_dir, tmp_path, monkeypatch):
    """A page is about 190 bytes of text; lineitem lands twice, with one page cut short."""
    monkeypatch.setattr(Q, "shared_dir", lambda s, name: str(tmp_path / name))
    days = Q.ingest_stream(spark, sf_dir).collect()
    n = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    landed = list((tmp_path / "ingest-in").glob("part-*"))
    assert sum(r["rows"] for r in days) == n and spark.read.text(str(tmp_path / "ingest-in")).count() == 2 * n + 1
    assert sum(p.stat().st_size for p in landed) < 2 * n * 40 and all(p.suffix == ".gz" for p in landed)
