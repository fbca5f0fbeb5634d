"""The trie of conversation prefixes, its subtree sums by an Euler tour."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from meterlake.llm.common import staged
from meterlake.llm.listrank import ranked

RUN = 256  # turn numbers sorted together
BLOCK = 1024  # turns folded into one key together
SPREAD = 50  # siblings go by the upper 14 of 64 bits first
PACK = 512  # conversation ids joined together
PART = 4096  # arcs summed, or copies of a turn numbered together


def ordered_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, pos, digest, n_bytes): each conversation's turns numbered from 1.

    Turns go by number, null first, those of one number by the digest of role
    and text; equal rows follow each other. A null role or text is empty, rows
    without a conversation are left out. A conversation may hold any share of
    the rows: numbers are sorted in runs of 256, run totals place the runs.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    rows = rows.withColumn("run", F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(1 << 62))))
    rows = rows.groupBy("conv", "run", "turn", "digest").agg(F.max("n_bytes").alias("n_bytes"), F.count("*").alias("copies"))
    rows = staged(rows, "turns")
    runs = rows.groupBy("conv", "run").agg(F.sum("copies").alias("n"))
    runs = runs.select("conv", "run", (F.sum("n").over(Window.partitionBy("conv").orderBy("run")) - F.col("n")).alias("before"))
    inside = Window.partitionBy("conv", "run").orderBy(F.asc_nulls_first("turn"), "digest").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("here", F.coalesce(F.sum("copies").over(inside), F.lit(0))).join(runs, ["conv", "run"])
    placed = placed.withColumn("at", F.col("before") + F.col("here"))
    placed = placed.withColumn("from", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"), F.lit(PART).cast("long"))))
    pos = F.sequence(F.col("at") + F.col("from"), F.col("at") + F.least("copies", F.col("from") + (PART - 1)))
    return placed.select("conv", F.explode(pos).alias("pos"), "digest", "n_bytes")


def spliced(turns: DataFrame, heads: DataFrame, longest: int) -> tuple[DataFrame, DataFrame]:
    """Conversations whose first turns are replaced by those of another one.

    ``heads`` has (conv, donor, h) for every conversation, h at most
    ``longest``. Returns (conv, pos, digest, n_bytes) and (conv, length).
    """
    lengths = turns.groupBy("conv").agg(F.max("pos").alias("n"))
    donors = lengths.select(F.col("conv").alias("donor"), F.col("n").alias("n_donor"))
    plan = heads.join(lengths, "conv").join(donors, "donor", "left").withColumn("taken", F.least("h", F.coalesce("n_donor", F.lit(0))))
    plan = staged(plan.select("conv", "donor", "h", "taken", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "plan")
    own = turns.join(plan.select("conv", "h", "taken"), "conv").where("pos > h")
    own = own.select("conv", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "digest", "n_bytes")
    given = turns.where(F.col("pos") <= longest).withColumnRenamed("conv", "donor")
    given = plan.where("taken > 0").select("conv", "donor", "taken").join(given, "donor").where("pos <= taken")
    return own.unionByName(given.select("conv", "pos", "digest", "n_bytes")), plan.select("conv", "length")


def _word(digest: Column, half: int) -> Column:
    return F.conv(F.substring(digest, 1 + 16 * half, 16), 16, -10).cast("long")


def prefix_keys(turns: DataFrame) -> DataFrame:
    """(conv, pos, p1, p2, q1, q2, n_bytes): 128-bit keys of the first pos turns (p) and of all but the last of them (q).

    A key is the exclusive or of hashes of (position, turn), so it folds like a
    sum: blocks of 1024 turns first, then within a block, whatever the length
    of a conversation. The root's key is 0.
    """
    own = F.md5(F.concat(F.col("pos").cast("string"), F.lit(":"), F.hex("digest")))
    rows = turns.withColumn("_own", own).withColumn("block", F.floor((F.col("pos") - 1) / BLOCK))
    rows = rows.select("conv", "pos", "block", "n_bytes", _word(F.col("_own"), 0).alias("k1"), _word(F.col("_own"), 1).alias("k2"))
    blocks = rows.groupBy("conv", "block").agg(F.bit_xor("k1").alias("b1"), F.bit_xor("k2").alias("b2"))
    earlier = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("conv", "block", *[F.coalesce(F.bit_xor(f"b{i}").over(earlier), F.lit(0)).alias(f"o{i}") for i in (1, 2)]).where("block > 0")
    to_here = Window.partitionBy("conv", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.bit_xor(f"k{i}").over(to_here).alias(f"x{i}") for i in (1, 2)]).join(blocks, ["conv", "block"], "left")
    p = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"o{i}", F.lit(0))) for i in (1, 2)]
    rows = rows.select("conv", "pos", "n_bytes", "k1", "k2", p[0].alias("p1"), p[1].alias("p2"))
    return rows.select("conv", "pos", "p1", "p2", F.col("p1").bitwiseXOR(F.col("k1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("k2")).alias("q2"), "n_bytes")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the joined ids of each key; the rows come sorted by key and pack, a key may go on in the next batch."""
    key, state = None, None
    for batch in batches:
        done = []
        for p1, p2, ids in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if (p1, p2) != key:
                if key is not None:
                    done.append((*key, state.hexdigest()))
                key, state = (p1, p2), hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        yield _rows(done)
    yield _rows([(*key, state.hexdigest())] if key is not None else [])


def _rows(found: list[tuple[int, int, str]]) -> pa.RecordBatch:
    a, b, c = zip(*found, strict=True) if found else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], ["p1", "p2", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(p1, p2, ends_sha256) of (conv, p1, p2): the ids that end at a key, ascending, joined by commas.

    Ids are sorted and joined in packs of 512, in parallel; the digest of one
    key is a chain by definition, so its packs pass one task as a stream.
    """
    packs = ends.groupBy("p1", "p2", F.floor(F.col("conv") / PACK).alias("pack")).agg(F.array_join(F.sort_array(F.collect_list("conv")), ",").alias("ids"))
    return packs.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "pack").select("p1", "p2", "ids").mapInArrow(_digests, "p1 long, p2 long, ends_sha256 string")


def nodes_of(keys: DataFrame, lengths: DataFrame) -> DataFrame:
    """One row per node, the root with id 0: id, conv_id, depth, n_convs, n_bytes, p1, p2, parent, parent_conv_id."""
    found = keys.groupBy("p1", "p2").agg(
        F.min("conv").alias("conv_id"), F.max("pos").alias("depth"), F.count("*").alias("n_convs"), F.max("n_bytes").alias("n_bytes"), F.min("q1").alias("q1"), F.min("q2").alias("q2")
    )
    found = staged(found.withColumn("id", F.monotonically_increasing_id() + 1), "nodes")
    root = lengths.agg(F.min("conv").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(zero.alias("id"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("n_bytes"), zero.alias("p1"), zero.alias("p2"), F.lit(None).cast("long").alias("parent"), F.lit(None).cast("long").alias("parent_conv_id"))
    data = ["id", "conv_id", "depth", "n_convs", "n_bytes", "p1", "p2"]
    top = found.where("depth = 1").select(*data, zero.alias("parent")).crossJoin(root.select(F.col("conv_id").alias("parent_conv_id")))  # the root is one row
    up = found.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    below = found.where("depth > 1").join(up, ["q1", "q2"]).select(*data, "parent", "parent_conv_id")
    return staged(root.unionByName(top).unionByName(below), "tree")


def tour(tree: DataFrame) -> DataFrame:
    """(a, b): the Euler tour's successor b of each arc a; node v enters by arc 2v and exits by 2v+1.

    Children follow each other by key. A parent may have any share of the
    nodes as children, so they are linked within 16,384 ranges of the key, and
    the ranges with each other.
    """
    children = tree.where("parent IS NOT NULL").select("id", "parent", "p1", "p2", F.shiftrightunsigned("p1", SPREAD).alias("range"))
    inside = Window.partitionBy("parent", "range").orderBy("p1", "p2")
    linked = staged(children.select("id", "parent", "range", F.lead("id").over(inside).alias("next"), (F.row_number().over(inside) == 1).alias("first")), "siblings")
    over = Window.partitionBy("parent").orderBy("range")
    ranges = linked.where("first").select("parent", "range", F.lead("id").over(over).alias("after"), F.col("id").alias("head"), (F.row_number().over(over) == 1).alias("eldest"))
    ranges = staged(ranges, "ranges")
    joined = linked.where("next IS NULL").drop("next").join(ranges.select("parent", "range", F.col("after").alias("next")), ["parent", "range"])
    siblings = linked.where("next IS NOT NULL").select("id", "parent", "next").unionByName(joined.select("id", "parent", "next"))
    leave = siblings.select((F.col("id") * 2 + 1).alias("a"), F.coalesce(F.col("next") * 2, F.col("parent") * 2 + 1).alias("b"))
    eldest = ranges.where("eldest")
    descend = eldest.select((F.col("parent") * 2).alias("a"), (F.col("head") * 2).alias("b"))
    leaves = tree.select("id").join(eldest.select(F.col("parent").alias("id")), "id", "left_anti")
    turn = leaves.select((F.col("id") * 2).alias("a"), (F.col("id") * 2 + 1).alias("b"))
    return staged(leave.unionByName(descend).unionByName(turn), "tour")


def subtree_sums(tree: DataFrame, arcs: DataFrame, **how: int) -> DataFrame:
    """(id, n_leaves, saved): sums over each node's subtree, as differences of prefix sums at its two arcs.

    Arcs are summed in parts of 4096 positions, parts in groups of 4096, then
    the groups, so no window holds more than 4096 rows until 10^11 arcs.
    """
    leaves = arcs.where("a % 2 = 0 AND b = a + 1").select(F.shiftright("a", 1).alias("id"), F.lit(1).cast("long").alias("leaf"))
    own = tree.join(leaves, "id", "left").select("id", F.coalesce("leaf", F.lit(0)).alias("leaf"), ((F.col("n_convs") - 1) * F.col("n_bytes")).alias("worth"))
    far = ranked(arcs, **how).select(F.shiftright("a", 1).alias("id"), (F.col("a") % 2 == 0).alias("enters"), "far")
    # Summed from the end: a node's exit comes before its enter arc, and what lies between them is its subtree.
    rows = far.join(own, "id").select("id", "enters", "far", F.when(F.col("enters"), F.col("leaf")).otherwise(0).alias("leaf"), F.when(F.col("enters"), F.col("worth")).otherwise(0).alias("worth"))
    rows = staged(rows.withColumn("part", F.floor(F.col("far") / PART)), "arcs")
    sums = ["leaf", "worth"]
    parts = rows.groupBy("part").agg(*[F.sum(c).alias(c) for c in sums]).withColumn("whole", F.floor(F.col("part") / PART))
    wholes = parts.groupBy("whole").agg(*[F.sum(c).alias(c) for c in sums])
    before = lambda w, name: [(F.sum(c).over(w) - F.col(c)).alias(f"{name}_{c}") for c in sums]
    wholes = wholes.select("whole", *before(Window.orderBy("whole"), "w"))
    parts = parts.select("part", "whole", *before(Window.partitionBy("whole").orderBy("part"), "p")).join(wholes, "whole")
    parts = parts.select("part", *[(F.col(f"w_{c}") + F.col(f"p_{c}")).alias(f"o_{c}") for c in sums])
    inside = Window.partitionBy("part").orderBy("far").rowsBetween(Window.unboundedPreceding, 0)
    summed = rows.select("id", "part", *[F.sum(c).over(inside).alias(c) for c in sums]).join(parts, "part")
    totals = [F.col(c) + F.col(f"o_{c}") for c in sums]
    return summed.groupBy("id").agg((F.max(totals[0]) - F.min(totals[0])).alias("n_leaves"), (F.max(totals[1]) - F.min(totals[1])).alias("saved"))


def trie(turns: DataFrame, lengths: DataFrame, **how: int) -> DataFrame:
    """One row per node of the trie of the conversations' prefixes.

    ``turns`` has (conv, pos, digest, n_bytes) with positions from 1 without
    gaps, ``lengths`` (conv, length) every conversation, turnless ones too. A
    node is a distinct sequence of first turns, the root the empty one.
    Returns conv_id (smallest member), depth, parent_conv_id (null for the
    root), n_convs (members), n_children, n_leaves and saved_tokens (subtree
    sums; a node saves its last turn's bytes for every member but one) and
    ends_sha256 (ids of members that end there). No conversation, no row.
    ``how`` goes to the list ranking.
    """
    keys = staged(prefix_keys(turns), "keys")
    tree = nodes_of(keys, lengths)
    sums = subtree_sums(tree, tour(tree), **how)
    counts = tree.groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("n_children")).where("id IS NOT NULL")
    last = keys.groupBy("conv").agg(F.max(F.struct("pos", "p1", "p2")).alias("last"))
    last = lengths.select("conv").join(last, "conv", "left").select("conv", F.coalesce("last.p1", F.lit(0)).alias("p1"), F.coalesce("last.p2", F.lit(0)).alias("p2"))
    out = tree.join(sums, "id").join(counts, "id", "left").join(end_digests(last), ["p1", "p2"], "left")
    return out.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )
