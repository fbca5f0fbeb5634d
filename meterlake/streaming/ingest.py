"""Landed files as streams that run until caught up and then stop."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from meterlake.functions.numbers import count_big


#: Shuffle files go with the end of a batch, as nothing reads them again.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: With more whole files than this, the second query of ``ingest_stream`` reads them all again, as their names burden its plan.
MOST_NAMES = 10_000


def _run(out: DataFrame, path: str, checkpoint: str, partition: str | None = None) -> StreamingQuery:
    writer = out.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition:
        writer = writer.partitionBy(partition)
    conf = out.sparkSession.conf
    before = conf.get(CLEANUP, "false")
    conf.set(CLEANUP, "true")  # else they stay until the driver collects its garbage
    try:
        query = writer.trigger(availableNow=True).start(path)
    finally:
        conf.set(CLEANUP, before)
    query.awaitTermination()
    return query


def landed_pages(spark: SparkSession, in_dir: str, schema: str, multi_line: bool = True) -> DataFrame:
    """A stream of (file, raw, page): each landed page with its text; ``page._broken`` is set where it does not parse."""
    raw = spark.readStream.format("text").option("wholetext", multi_line).load(in_dir)
    raw = raw.select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("raw")).where(F.length(F.trim("raw")) > 0)
    page = F.from_json("raw", f"{schema}, _broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken"})
    return raw.withColumn("page", page)


def whole_files(query: StreamingQuery, name: str = "files") -> list[str]:
    """The files that a finished run has read and in which every page parsed, by what its metric ``name`` observed."""
    seen = {(f["file"], f["broken"]) for p in query.recentProgress if name in p.observedMetrics for f in p.observedMetrics[name]["read"]}
    return sorted(f for f, broken in seen if not broken and (f, True) not in seen)


def ingest_stream(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    schema: str,
    to_rows: Callable[[DataFrame], DataFrame],
    partition: str | None = "activity_date",
    multi_line: bool = True,
    broken_dir: str | None = None,
) -> None:
    """Load pages that landed since the last run, each page exactly once.

    ``multi_line`` files hold one page each; otherwise a file has a page per
    line. A page with the contents of an earlier one, in whatever run it
    landed, is left out: the state keeps 32 bytes for each page ever loaded. A
    page that does not parse does not stop the others; its file, text and the
    SHA-256 of the text go to ``broken_dir`` (``<out_dir>_broken``), by a
    second query with its own checkpoint. Of files with a page per line, it
    leaves out those that the first one just found whole; any other, such as
    one left over by a run that failed between the two, it parses itself.

    The file sink appends and commits per batch. Overwriting dates instead would
    lose rows of a date that arrived in an earlier batch.
    """
    landed = landed_pages(spark, in_dir, schema, multi_line)
    is_broken = F.col("page._broken").isNotNull()
    # No filter moves below a metric, so a page is parsed once. One name per page would be too many for the plan below.
    seen = landed if multi_line else landed.observe("files", F.collect_set(F.struct("file", is_broken.alias("broken"))).alias("read"))
    good = seen.where(~is_broken).withColumn("digest", F.unhex(F.sha2(F.to_json("page"), 256)))
    pages = good.dropDuplicates(["digest"]).select("page.*").drop("_broken")
    whole = whole_files(_run(to_rows(pages), out_dir, checkpoint, partition))
    rest = landed.where(~F.col("file").isin(whole)) if 0 < len(whole) <= MOST_NAMES else landed
    broken = rest.where(is_broken).select("file", "raw", F.sha2("raw", 256).alias("digest"))
    _run(broken, broken_dir or f"{out_dir.rstrip('/')}_broken", f"{checkpoint.rstrip('/')}_broken")


def hourly_event_counts(
    stream: DataFrame, watermark: str = "1 hour", width: str = "1 hour", ts: str = "ts", key: str = "event_id"
) -> DataFrame:
    """Events per window and type, each event id counted once, late rows dropped.

    A window is emitted when the watermark passes its end. State is bounded by
    the watermark: ids and windows older than it are forgotten.
    """
    once = stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, watermark)
    once = once.dropDuplicatesWithinWatermark([key])
    counts = once.groupBy(F.window(ts, width).alias("w"), "event_type").agg(count_big().alias("events"))
    return counts.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "event_type", "events")


def open_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The windows of ``hourly_event_counts`` that a finished run still holds back, with their counts so far.

    They are read from the stream's own state, so an id that the stream has
    counted or dropped is counted or dropped here too.
    """
    operators = spark.read.format("state-metadata").load(checkpoint).where("operatorName = 'stateStoreSave'")
    number = operators.agg(F.max("operatorId")).first()[0]
    if number is None:
        return spark.createDataFrame([], "window_start timestamp, window_end timestamp, event_type string, events bigint")
    state = spark.read.format("statestore").option("operatorId", number).load(checkpoint)
    return state.select(
        F.col("key.window.start").alias("window_start"), F.col("key.window.end").alias("window_end"), F.col("key.event_type").alias("event_type"), F.col("value.count").alias("events")
    )


def with_open_windows(emitted: DataFrame, checkpoint: str) -> DataFrame:
    """What a finished run emitted, and the windows it still holds back.

    Append mode keeps a window back until the watermark has passed it, so a run
    that stops when it has caught up leaves the last ones out. The stream's own
    result does not change; when more lands, its next run emits them.
    """
    return emitted.unionByName(open_windows(emitted.sparkSession, checkpoint))


def run_to_parquet(out: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run a stream over all available input and return what it wrote."""
    _run(out, path, checkpoint)
    return out.sparkSession.read.schema(out.schema).parquet(path)
