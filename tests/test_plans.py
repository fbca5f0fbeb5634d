"""What the physical plans must and must not contain."""

import re

import pytest
from executed import scans

from meterlake import proxies as P
from meterlake.plans import costs as C
from meterlake.queries import all_queries

QUERIES = all_queries()
# These write files or run streams when called.
ACTIONS = {"append_rows", "replace_date", "replace_range", "update_spend", "write_report", "export_csv", "hourly_event_counts", "ingest_stream"}
# A window without partitions is allowed over a bounded number of rows: one per
# tool, rank bucket, calendar month or calendar day.
SMALL_WINDOWS = {"tool_comparison", "executive_summary", "monthly_increase_alert", "cost_anomaly", "productivity_metrics", "productivity_metrics_daily", "productivity_metrics_weekly", "cost_allocation", "team_cost_allocation"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().toString()


def physical(df) -> str:
    return plan_of(df).split("== Physical Plan ==")[1]


@pytest.fixture(scope="module")
def plans(spark, sf_dir):
    return {n: physical(q.run(spark, sf_dir)) for n, q in QUERIES.items() if n not in ACTIONS}


def test_no_python_workers(plans):
    assert [n for n, p in plans.items() if re.search("ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroups", p)] == []


def test_no_cross_joins(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p or "NestedLoopJoin" in p] == []


    import pathlib

    files = [p for p in pathlib.Path(C.__file__).parents[1].rglob("*.py") if p.parent.name != "llm"]
    src = "".join(p.read_text() for p in files)
    assert "localCheckpoint" not in src and ".toPandas(" not in src
    # The one hint is on a list of hot keys, fewer than two for each partition.
    assert src.count("broadcast(") == 1 and "F.broadcast(hot)" in src


def test_small_dimension_does_not_shuffle_the_facts(spark, tmp_path):
    from executed import final_plan

    from meterlake.operators.joins import lookup

    facts = spark.range(1000).selectExpr("IF(id % 2 = 0, 'hot', CAST(id AS STRING)) AS k", "id AS v")
    spark.createDataFrame([("hot", "b", "x"), ("hot", "a", "y"), ("1", "c", None)], "k string, u string, t string").coalesce(1).write.parquet(str(tmp_path / "dim"))
    dim = spark.read.parquet(str(tmp_path / "dim"))
    small = lookup(facts, dim, "k", {"user": "u", "team": "t"})
    shuffled = re.findall(r"Exchange hashpartitioning.*", final_plan(small).split("Initial Plan")[0])
    assert len(shuffled) <= 1  # the dimension's own aggregate
    assert small.filter("k = 'hot'").distinct().count() == 500 and {r.user for r in small.filter("k = 'hot'").collect()} == {"a"}


def test_facts_without_a_key_are_spread(spark):
    from pyspark.sql import functions as F

    from meterlake.operators.joins import lookup

    facts = spark.range(8000).selectExpr("IF(id % 4 = 0, CONCAT('k', id), NULL) AS k", "id AS v")
    dim = spark.range(8000).selectExpr("IF(id = 4, NULL, CONCAT('k', id)) AS k", "CONCAT('u', id) AS u")
    names = ["spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, ("false", "-1")):
            spark.conf.set(n, v)
        out = lookup(facts, dim, "k", {"user": "u"})
        parts = [r["count"] for r in out.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
        got = out.collect()
    finally:
        for n, v in zip(names, before):
            spark.conf.set(n, v)
    assert sum(parts) == 6000 and max(parts) < 2 * 6000 / 8
    assert len(got) == 8000 and {r.user for r in got if r.k is None or r.k == "k4"} == {None}
    assert all(r.user == f"u{r.v}" for r in got if r.k is not None and r.k != "k4")


def test_building_plans_starts_no_job(spark):
    from meterlake.operators import joins as J
    from meterlake.operators.aggregates import global_rank

    rows = spark.range(100).selectExpr("CONCAT('k', id % 3) AS k", "id AS v")
    spark.sparkContext.setJobGroup("plans", "built only")
    J.lookup(rows, rows.select("k", "v"), "k", {"u": "v"})
    J.three_way_left(rows, rows.select("k"), rows.select("k"), ["k"])
    J.join_global_counts(rows, "k")
    global_rank(rows, "v")
    started = spark.sparkContext.statusTracker().getJobIdsForGroup("plans")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(started) == []


@pytest.fixture()
def plain(spark):
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("hot", ["'hot'", "CAST(NULL AS STRING)"])
def test_a_key_on_half_the_rows_is_spread(spark, plain, hot):
    """The largest task has at most three times the median, and only hot keys are repeated."""
    from pyspark.sql import functions as F

    from meterlake.operators import joins as J

    rows = spark.range(40_000).selectExpr(f"IF(id % 2 = 0, {hot}, CONCAT('k', id % 500)) AS k", "id AS v")
    totals = rows.groupBy("k").agg(F.sum("v").alias("t"), F.count("*").alias("n"))
    for how in ({"n": "n"}, {}):
        out = J.join_totals(rows, totals if how else totals.drop("n"), ["k"], spread=["v"], null_safe=True, **how)
        sizes = sorted(r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect())
        assert len(sizes) == 8 and sizes[-1] <= 3 * sizes[4] and sum(sizes) == 40_000
        assert out.where("t IS NULL").count() == 0
    three = J.three_way_left(rows, totals.select("k", "t"), totals.select("k", "n"), ["k"])
    sizes = sorted(r["count"] for r in three.groupBy(F.spark_partition_id()).count().collect())
    assert sizes[-1] <= 3 * sizes[len(sizes) // 2] and sum(sizes) == 40_000
    keys = J.hot_keys(totals, ["k"], "n")
    assert [r[1] for r in keys.collect()] == [8]
    assert J.repeated(totals, keys, ["k"]).count() == totals.count() + 7
    even = totals.where("k LIKE 'k%'")
    assert J.repeated(even, J.hot_keys(even, ["k"], "n"), ["k"]).count() == even.count()
    alone = J.join_global_counts(rows.select("k"), "k")
    assert alone.count() == 40_000 and alone.distinct().count() == 251


def test_date_range_reaches_the_scan(spark, sf_dir):
    df = C.kpi_total_cost(P.combined_daily_costs(spark, sf_dir), "1996-10-01", "1996-12-31")
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(o_orderdate", physical(df))


def test_only_needed_columns_are_read(spark, sf_dir):
    p = physical(C.kpi_total_cost(P.combined_daily_costs(spark, sf_dir), "1996-10-01", "1996-12-31"))
    assert "part.parquet" not in p
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", p)
    assert sorted(len(s.split(",")) for s in schemas) == [2, 3]


@pytest.mark.parametrize(
    "name,tables",
    [
        ("kpi_total_cost", ["lineitem", "orders"]),
        ("team_attribution", ["customer", "lineitem", "nation", "orders"]),
        ("weekly_retention", ["orders"]),
        ("model_share", ["lineitem"]),
        ("event_type_distribution", ["events"]),
        ("productivity_metrics", ["lineitem"]),
        ("monthly_finance", ["lineitem", "orders"]),
        ("executive_summary", ["lineitem", "orders"]),
        ("cost_anomaly", ["lineitem", "orders"]),
        ("checkpoint_report", ["lineitem"]),
        ("quality_score", ["events"]),
        ("spend_deltas", ["events"]),
    ],
)
def test_files_are_scanned_once_at_run_time(spark, sf_dir, name, tables):
    assert scans(QUERIES[name].run(spark, sf_dir)) == tables
