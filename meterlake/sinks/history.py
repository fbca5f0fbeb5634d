"""Rows are added to stored days unless an earlier load stored them already.

Beside a table, each load leaves one Bloom filter for each day, in blocks of
32768 bits: all bits of a key lie in one block, so a lookup is one join on day
and block. A new row is looked up in the filters of its day only, and just
the days with a hit are read for the exact comparison; for an export that
brings nothing twice no stored row is read at all.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.session import checkpointed
from meterlake.sinks.loads import REJECTED, SEEN, Change, Conflict, Loads, schema_of

# Bits of a block (those of Spark's bitmap functions), and bits set for each key.
BLOCK, PROBES = 32768, 4
AGAIN = "already stored"


def _hashes(on: list[str]) -> tuple[Column, Column]:
    """Two hashes of a key; NULL and an empty text differ."""
    parts = [c for name in on for c in (F.col(name).isNull(), F.col(name).cast("string"))]
    return F.xxhash64(*parts), F.xxhash64(F.lit(1), *parts)


def _positions(second: Column) -> list[Column]:
    return [F.shiftright(second, 15 * i).bitwiseAND(F.lit(BLOCK - 1)) for i in range(PROBES)]


def _bit(bits: Column, position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def filters(rows: DataFrame, day: str, on: list[str], load: str, bits: int = 16) -> DataFrame:
    """The blocks of a load: ``bits`` for each of a day's rows, at least one block a day."""
    first, second = _hashes(on)
    sizes = F.broadcast(rows.groupBy(day).agg(F.ceil(F.count(F.lit(1)) * bits / F.lit(BLOCK)).alias("parts")))  # a row per calendar day
    keys = rows.select(day, first.alias("_a"), F.explode(F.array(*_positions(second))).alias("_bit"))
    out = keys.join(sizes, day).groupBy(F.col(day).alias("day"), "parts", F.pmod("_a", "parts").alias("part"))
    return out.agg(F.bitmap_construct_agg("_bit").alias("bits")).withColumn("load", F.lit(load))


def maybe_stored(store: Loads, table: str, rows: DataFrame, on: list[str]) -> DataFrame:
    """Rows whose key is in a filter of their day: all that are stored, and about one in 400 of the others."""
    _, day, _ = schema_of(table)
    first, second = _hashes(on)
    days = [r[0] for r in rows.select(day).distinct().collect()]  # calendar days
    blocks = store.read_days(table + SEEN, days)
    sets = F.broadcast(blocks.select("day", "load", "parts").distinct())  # a row per day and load
    asked = rows.withColumn("_a", first).withColumn("_b", second)
    where = asked.select(day, "_a", "_b").distinct().join(sets, F.col(day) == F.col("day")).withColumn("part", F.pmod("_a", "parts"))
    hit = where.join(blocks.select("day", "load", "part", "bits"), ["day", "load", "part"])
    for position in _positions(F.col("_b")):
        hit = hit.where(_bit(F.col("bits"), position))
    return asked.join(hit.select(day, "_a", "_b").distinct(), [day, "_a", "_b"], "left_semi").drop("_a", "_b")


def append_new(store: Loads, table: str, rows: DataFrame, on: list[str], load: str | None = None, tries: int = 3) -> int:
    """Add the rows whose key no earlier load has stored; the others go to the rejected rows. Returns the version.

    ``on`` names the key; the table's day always belongs to it. NULL is a value
    of a key like any other. Rows that are equal within one load all stay:
    what a load may hold is for its own checks. Rows without a day refuse the
    load. A load of the same name is added once. All loads of the table have
    to come this way (or fill its filters with ``index``).
    """
    schema, day, _ = schema_of(table)
    on = list(dict.fromkeys([day, *on]))
    load = load or uuid.uuid4().hex
    rows = checkpointed(rows)
    for _ in range(tries):
        base = store.version()
        known = store.loaded(load)
        if known is not None:
            return known
        maybe = checkpointed(maybe_stored(store, table, rows, on).select(*on).distinct())
        days = [r[0] for r in maybe.select(day).distinct().collect()]  # calendar days
        again = maybe
        if days:
            stored = store.read_days(table, days).select(*[F.col(c).alias(f"_s_{c}") for c in on])
            again = checkpointed(maybe.join(stored, _same(on), "left_semi"))
        again = again.select(*[F.col(c).alias(f"_s_{c}") for c in on])
        # Kept, as it is read three times: for the table, the sizes of its filters and their bits.
        new = checkpointed(rows.join(again, _same(on), "left_anti")) if days else rows
        changes = {table: Change(new, append=True), table + SEEN: Change(filters(new, day, on, load), append=True)}
        if days:
            refused = rows.join(again, _same(on), "left_semi")
            errors = F.array(F.lit(AGAIN)).alias("errors")
            kept = [c for c in rows.columns if c in schema.names]
            changes[table + REJECTED] = Change(refused.select(*kept, errors, F.col(day).alias("load_day")), append=True)
        try:
            return store.commit(changes, load, after=base)
        except Conflict:
            continue
    raise Conflict(load)


def _same(on: list[str]) -> Column:
    out = F.lit(True)
    for c in on:
        out = out & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    return out


def index(store: Loads, table: str, on: list[str], days: list | None = None, load: str | None = None) -> int:
    """Fill the filters of days that were stored another way, or replaced since: all days, or those listed."""
    _, day, _ = schema_of(table)
    load, base = load or uuid.uuid4().hex, store.version()
    days = sorted(store.days(table)) if days is None else days
    blocks = filters(store.read_days(table, days), day, list(dict.fromkeys([day, *on])), load)
    return store.commit({table + SEEN: Change(blocks, days=days)}, load, after=base)
