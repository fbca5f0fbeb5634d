"""Mixing sources to target weights, exact to the word."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from meterlake.session import checkpointed

WORDS = r"[^\x20\x09-\x0D]+"


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, repeats: int) -> DataFrame:
    """Add ``target`` to one row per source (source, source_size).

    The weights go round over the sources by code point, null last; ``share``
    of the sum of sizes is dealt by weight. No source gets more than
    ``repeats`` times its size: what is above goes to the others by weight
    until nobody is above. Only sums come to the driver.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))  # one row per source
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    limit = F.lit(repeats) * F.col("source_size")
    sources = checkpointed(sources.withColumn("_w", w))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level = -1.0
    while True:
        above = (F.lit(level) * F.col("_w") > limit) if level >= 0 else F.lit(False)
        taken, rest = sources.agg(F.sum(F.when(above, limit).otherwise(0)), F.sum(F.when(above, 0.0).otherwise(F.col("_w")))).first()
        now = (budget - (taken or 0)) / rest if rest else level
        if now <= level:
            break
        level = now
    return sources.withColumn("target", F.least(F.lit(max(level, 0.0)) * F.col("_w"), limit.cast("double"))).drop("_w")


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    repeats: int = 2,
    range_rows: int = 1000,
    most_ranges: int = 65_536,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: id, size, source, source_size, target, taken.

    Each document's key is a hash of its id, uniform as a random number yet
    the same in every run and in a recomputed task. A source's key space is
    cut into equal ranges of about ``range_rows`` rows (longer ones beyond
    ``most_ranges``, as their totals meet in one window), each sorted by key;
    prefix sums of the ranges' sizes plus those within a range give the words
    before a document. The target, rounded down, holds whole epochs of the
    source plus a rest; the rest takes documents in key order and ends inside
    one, so a source's taken words are its target to the word.

    Null texts have size 0 and take nothing; a null source is a source of its
    own; rows with equal or null ids follow each other in key order, larger
    ones last; an empty table gives an empty result. Other columns are not read.
    """
    sized = checkpointed(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(source_col).alias("source"),
            F.coalesce(F.regexp_count(text_col, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit(""))).alias("_key"),
        )
    )
    sources = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows")), weights, share, repeats)
    per = sources.select(F.col("source").alias("_source"), "source_size", "target", F.least(F.ceil(F.col("_rows") / range_rows), F.lit(most_ranges)).alias("_ranges"))
    # Few rows a source and its ranges; the documents are the long side of every join.
    placed = sized.join(per, sized["source"].eqNullSafe(per["_source"])).drop("_source")
    part = F.conv(F.substring("_key", 1, 7), 16, 10).cast("long")
    placed = placed.withColumn("_range", F.floor(part * F.col("_ranges") / (1 << 28)))
    sums = placed.groupBy("source", "_range").agg(F.sum("size").alias("_words"))
    to_here = Window.partitionBy("source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("_source"), F.col("_range").alias("_at"), F.coalesce(F.sum("_words").over(to_here), F.lit(0)).alias("_before"))
    rows = placed.join(sums, placed["source"].eqNullSafe(sums["_source"]) & (placed["_range"] == sums["_at"]))
    in_range = Window.partitionBy("source", "_range").orderBy("_key", "_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_before") + F.coalesce(F.sum("size").over(in_range), F.lit(0))
    whole = F.floor(F.col("target"))
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0)
    rest = whole - epochs * F.col("source_size")
    taken = epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    return rows.select(F.col("_id").alias(id_col), "size", "source", "source_size", "target", taken.cast("long").alias("taken"))
