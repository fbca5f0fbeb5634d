"""Writers: idempotence, gaps, evolution."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from meterlake.schemas import TABLES
from meterlake.sinks import reports, tables

D = dt.date


@pytest.fixture()
def metrics(spark, request):
    db = "sink_" + request.node.name
    spark.sql(f"CREATE DATABASE {db}")
    yield tables.create_table(spark, "cursor_daily_metrics", f"{db}.cursor_daily_metrics")


def frame(spark, *data):
    df = spark.createDataFrame(list(data), "activity_date string, user_email string, total_accepts bigint")
    return df.withColumn("activity_date", F.col("activity_date").cast("date"))


def stored(spark, table):
    return sorted((str(r.activity_date), r.user_email, r.total_accepts) for r in spark.table(table).collect())


def test_append_is_not_idempotent_and_stamps(spark, metrics):
    for _ in range(2):
        tables.append(frame(spark, ("2025-10-01", "a", 1)), metrics)
    assert stored(spark, metrics) == [("2025-10-01", "a", 1)] * 2
    assert spark.table(metrics).filter("ingestion_timestamp IS NULL").count() == 0


def test_replace_date_twice(spark, metrics):
    tables.append(frame(spark, ("2025-10-01", "a", 1), ("2025-10-02", "a", 2)), metrics)
    for _ in range(2):
        tables.replace_date(frame(spark, ("2025-10-02", "b", 9), ("2025-10-03", "c", 9)), metrics, "2025-10-02")
    assert stored(spark, metrics) == [("2025-10-01", "a", 1), ("2025-10-02", "b", 9)]
    tables.replace_date(frame(spark, ("2025-10-09", "b", 9)), metrics, "2025-10-02")
    assert len(stored(spark, metrics)) == 2



def test_new_column_needs_evolution(spark, metrics):
    wide = frame(spark, ("2025-10-01", "a", 1)).withColumn("new_metric", F.lit(7))
    tables.append(frame(spark, ("2025-10-02", "a", 1)), metrics)
    with pytest.raises(ValueError):
        tables.append(wide, metrics)
    assert tables.add_columns(wide, metrics) == ["new_metric"]
    tables.append(wide, metrics)
    assert sorted((r.new_metric for r in spark.table(metrics).collect()), key=str) == [7, None]


def test_all_tables_can_be_created(spark):
    spark.sql("CREATE DATABASE all_tables")
    for name, spec in TABLES.items():
        t = tables.create_table(spark, name, f"all_tables.{name}")
        assert sorted(spark.table(t).columns) == sorted(spec.columns)


def test_hot_day_is_split_over_writers(spark, tmp_path):
    """One day with all rows is written by several tasks once it is large enough."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(200000).select(F.lit("2025-10-01").cast("date").alias("activity_date"), F.col("id").cast("string").alias("user_email"))
        spark.sql("CREATE DATABASE hot_day")
        t = tables.create_table(spark, "cursor_daily_metrics", "hot_day.cursor_daily_metrics")
        tables.append(df, t)
        assert spark.table(t).count() == 200000
        assert spark.table(t).select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")


def test_reports_and_exports(spark, tmp_path):
    res = spark.createDataFrame([("a", "PASS"), ("b", "FAIL"), ("c", "WARNING"), ("d", "FAILED")], "test string, status string")
    reports.write_report(res, str(tmp_path / "r"))
    s = spark.read.json(str(tmp_path / "r" / "summary")).first()
    assert (s.total, s.passed, s.failed, s.warnings) == (4, 1, 2, 1)
    for fmt in ("csv", "json", "parquet"):
        reports.export(res, str(tmp_path / fmt), fmt)
        back = spark.read.option("header", True).format(fmt).load(str(tmp_path / fmt))
        assert back.count() == 4 and set(back.columns) == {"test", "status"}
    with pytest.raises(ValueError):
        reports.export(res, str(tmp_path / "x"), "xlsx")
