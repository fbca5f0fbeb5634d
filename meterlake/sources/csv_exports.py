"""CSV exports: audit log, key mapping and team spend."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from meterlake.functions.dates import iso_date, iso_timestamp
from meterlake.functions.text import blank_to_null, literal_to_json, parse_literal

ACTIVITY_CSV = """
    created_at string, event string, actor_info string, entity_info string, event_info string,
    client_platform string, device_id string, user_agent string, ip_address string
"""

_ACTOR = "name string, uuid string, metadata struct<email_address: string>"
_ENTITY = "type string, uuid string, metadata struct<project_uuid: string>"


def _read_csv(spark: SparkSession, paths: str | list[str], schema: str | None) -> DataFrame:
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    return (reader.schema(schema) if schema else reader).csv(paths, mode="FAILFAST")


def csv_records(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, record) of CSV files whose quoted cells may span lines; a file may be cut into any number of splits.

    Spark reads lines, split by split. A line begins a record where the number
    of quotes before it is even, so a split needs one bit from those before it:
    the parity of their quotes, a running sum over one row per split. Records
    of one line, nearly all, stay where they are; only lines of longer ones are
    brought together, also across splits. Each file's first record is its
    header and left out, as are empty lines. Lines end in LF or CRLF; a quote
    stands in quoted cells only, where it is doubled.
    """
    lines = spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("_at"), F.col("value").alias("line"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    in_split = Window.partitionBy("file", "split").orderBy("_at")
    lines = lines.withColumn("quotes", quotes).select(
        "file", "split", "line", "quotes", F.row_number().over(in_split).alias("n"),
        ((F.sum("quotes").over(in_split) - F.col("quotes")) % 2).alias("odd"),
    )
    # Where the last record of a split begins, if it is entered between two records or inside of one.
    splits = lines.groupBy("file", "split").agg(
        F.sum("quotes").alias("quotes"), *[F.max(F.when(F.col("odd") == p, F.col("n"))).alias(f"last{p}") for p in (0, 1)]
    )
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    splits = splits.withColumn("entered", F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2)
    last = F.when(F.col("entered") == 0, F.col("last0")).otherwise(F.col("last1"))
    splits = splits.withColumn("last", F.when(last.isNotNull(), F.struct("split", last.alias("n"))))
    splits = splits.select("file", "split", "entered", F.last("last", ignorenulls=True).over(before).alias("open"))
    placed = lines.join(splits, ["file", "split"]).withColumn("begins", F.col("odd") == F.col("entered"))
    alone = F.col("begins") & (F.col("quotes") % 2 == 0)
    header = lambda at: (at["split"] == 0) & (at["n"] == 1)
    short = placed.where(alone & ~((F.col("split") == 0) & (F.col("n") == 1))).select("file", F.col("line").alias("record"))
    to_here = Window.partitionBy("file", "split").orderBy("n")
    begun = F.last(F.when(F.col("begins"), F.struct("split", "n")), ignorenulls=True).over(to_here)
    longer = placed.where(~alone).withColumn("record", F.coalesce(begun, "open"))
    longer = longer.groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("split", "n", "line"))).alias("lines"))
    longer = longer.where(~header(F.col("record"))).select("file", F.array_join(F.transform("lines", lambda x: x["line"]), "\n").alias("record"))
    records = short.unionByName(longer).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.where("record <> ''")


def read_activity_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Audit export; quoted cells may span lines and double their quotes. One large file is read by many tasks."""
    parsed = F.from_csv("record", ACTIVITY_CSV.strip().replace("\n", " "), {"escape": '"', "mode": "FAILFAST"})
    return csv_records(spark, paths).select(parsed.alias("r")).select("r.*")


def activity_rows(raw: DataFrame) -> DataFrame:
    """Audit export to event rows, with rows that carry no e-mail kept and flagged.

    ``has_user`` is false for them; ``app_usage_rows`` and ``skipped_rows``
    take one side each, so nothing is lost silently.
    """
    literals = F.struct(
        parse_literal("actor_info", _ACTOR).alias("actor"),
        parse_literal("entity_info", _ENTITY).alias("entity"),
        literal_to_json("event_info").alias("event_json"),
    )
    # Through a generator, which filters on what it yields stay above: otherwise each would parse again.
    parsed = raw.select("*", F.inline(F.array(literals)))
    email = F.col("actor.metadata.email_address")
    return parsed.select(
        iso_timestamp("created_at").alias("activity_timestamp"),
        iso_date("created_at").alias("activity_date"),
        email.alias("user_email"),
        F.col("actor.name").alias("user_name"),
        F.col("actor.uuid").alias("user_uuid"),
        F.col("event").alias("event_type"),
        F.col("event_json").alias("event_info"),
        F.col("entity.type").alias("entity_type"),
        F.col("entity.uuid").alias("entity_uuid"),
        F.when(F.col("entity.type") == "chat_conversation", F.col("entity.uuid")).alias("conversation_uuid"),
        F.col("entity.metadata.project_uuid").alias("project_uuid"),
        *[blank_to_null(c).alias(c) for c in ("client_platform", "device_id", "user_agent", "ip_address")],
        F.lit("claude_activity_export").alias("data_source"),
        blank_to_null(email).isNotNull().alias("has_user"),
    )


def app_usage_rows(raw: DataFrame) -> DataFrame:
    return activity_rows(raw).filter("has_user").drop("has_user")


def skipped_rows(raw: DataFrame) -> DataFrame:
    """How many rows were kept and skipped, in one pass."""
    return activity_rows(raw).agg(
        F.count_if("has_user").alias("kept"), F.count_if(~F.col("has_user")).alias("skipped")
    )


# Platforms and the keywords that name them; the first match wins.
PLATFORM_KEYWORDS = [("cursor", "cursor"), ("anthropic", "anthropic"), ("claude", "anthropic")]
DEFAULT_PLATFORM = "anthropic"


def platform_of(name: str | Column, description: str | Column) -> Column:
    text = F.lower(F.concat_ws(" ", name, description))
    out = F
    for word, platform in PLATFORM_KEYWORDS:
        out = out.when(text.contains(word), platform)
    return out.otherwise(DEFAULT_PLATFORM)


def key_mapping_rows(raw: DataFrame) -> DataFrame:
    return raw.select(
        "api_key_name",
        F.lower(F.trim("email")).alias("user_email"),
        "description",
        platform_of("api_key_name", "description").alias("platform"),
    )


def read_key_mapping(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return key_mapping_rows(_read_csv(spark, paths, "api_key_name string, email string, description string"))


def _plain_number(text: str | Column, to: str) -> Column:
    return F.regexp_replace(text, r"[$,\s]", "").cast(to)


def team_rows(raw: DataFrame) -> DataFrame:
    """Rows of ``user, spend, lines`` text: ``$1.25``, ``12,345``, ``name [API key]``."""
    suffix = r"\s*\[API key\]$"
    is_key = F.col("user").rlike(suffix)
    name = F.regexp_replace("user", suffix, "")
    return raw.select(
        F.when(is_key, "api_key").otherwise("user").alias("actor_kind"),
        F.when(~is_key, name).alias("user_email"),
        F.when(is_key, name).alias("api_key_name"),
        _plain_number("spend", "decimal(18,2)").alias("spend_usd"),
        _plain_number("lines", "bigint").alias("lines"),
    )


def read_team_csv(spark: SparkSession, path: str) -> DataFrame:
    """Monthly team export; older files have no spend column."""
    raw = _read_csv(spark, path, None)
    header = {c.lower().split(" ")[0]: c for c in raw.columns}
    spend = F.col(f"`{header['spend']}`") if "spend" in header else F.lit(None).cast("string")
    return team_rows(
        raw.select(F.col(header["user"]).alias("user"), spend.alias("spend"), F.col(f"`{header['lines']}`").alias("lines"))
    )
