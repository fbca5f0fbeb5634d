"""Near-duplicate documents by bottom-k sketches of word shingles."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import U64, as_bytes, mapped, mixed, narrow_broadcasts, slices, staged
from meterlake.llm.components import components
from meterlake.operators.joins import join_totals

RUN = 3  # consecutive retained values that make a key
MEMO = 400_000
SIGNED = np.int64


class Shingles:
    """Sorted distinct 64-bit hashes of a text's shingles of ``width`` words; fewer words make one shingle."""

    def __init__(self, width: int):
        self.width = width
        self.memo: dict[bytes, int] = {}

    def of(self, text: bytes | None) -> np.ndarray:
        words = text.lower().split() if text else []  # bytes: A-Z only, and white space is 0x20, 0x09-0x0D
        if not words:
            return np.zeros(0, np.uint64)
        if len(self.memo) > MEMO:
            self.memo.clear()
        get, hashes = self.memo.get, []
        for w in words:
            h = get(w)
            if h is None:
                h = self.memo[w] = xxhash.xxh64_intdigest(w)
            hashes.append(h)
        h = np.array(hashes, np.uint64)
        n = min(self.width, len(h))
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = mixed(out * U64(0x9E3779B97F4A7C15) + h[i : i + len(out)])
        return np.unique(out)


def missed(similarity: float, values: int) -> float:
    """Chance that two sets of this similarity share no run of ``RUN`` values among the ``values`` smallest of their union."""
    none = [1.0] * RUN
    for _ in range(RUN - 1, values):
        none.append(sum((1 - similarity) * similarity**j * none[-1 - j] for j in range(RUN)))
    return none[values]


def enough_values(similarity: float, chance: float) -> int:
    """Fewest retained values in keys that miss a pair at the threshold less often than ``chance``."""
    return next((v for v in range(RUN, 1000) if missed(similarity, v) < chance), 1000)


def least_shared(similarity: float, k: int, chance: float) -> int:
    """Most values that a union sketch of ``k`` must share while a pair at the threshold has fewer less often than ``chance``."""
    below = 0.0
    for n in range(k + 1):
        below += math.comb(k, n) * similarity**n * (1 - similarity) ** (k - n)
        if below >= chance:
            return n
    return k


def small_sizes(percent: int, values: int) -> range:
    """Sizes of sets in pairs at the threshold whose union is retained whole and yet may hold no run that they share."""
    lost = {u: u * (100 - percent) // 100 for u in range(1, values + 1)}  # values of the union that one of them lacks
    lost = {u: d for u, d in lost.items() if d and u <= RUN * d + RUN - 1}
    return range(min(u - d for u, d in lost.items()), max(lost) + 1) if lost else range(0)


def keys_of(s: np.ndarray, percent: int, values: int, small: range) -> np.ndarray:
    """Keys of the runs among the ``values`` smallest hashes; of a set of a ``small`` size also its first hashes.

    Two sets that share 100 * n >= percent * size values have the smallest of
    them among the first size - n + 1 of each: no pair of small sets is missed.
    """
    low = s[:values]
    run = np.zeros(max(0, len(low) - RUN + 1), np.uint64)
    for i in range(RUN):
        run = mixed(run * U64(0xC2B2AE3D27D4EB4F) + low[i : i + len(run)])
    if len(s) in small:
        run = np.concatenate([run, mixed(s[: len(s) * (100 - percent) // 100 + 1] * U64(0x165667B19E3779F9))])
    return run


SKETCHED = "_id long, _n long, _set binary, _sketch array<long>, _keys array<long>"


def sketches(docs: DataFrame, width: int, percent: int, k: int, values: int) -> DataFrame:
    """Per row: set size, digest of the set, the k smallest hashes (as signed numbers), keys."""
    small = small_sizes(percent, values)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Shingles(width)
        for batch in slices(batches):
            n, sets, lists, keys = [], [], [], []
            for text in as_bytes(batch.column(1)):
                s = made.of(text)
                n.append(len(s))
                sets.append(xxhash.xxh128_digest(s.tobytes()) if len(s) else None)
                lists.append(s[:k].view(SIGNED))
                keys.append(keys_of(s, percent, values, small).view(SIGNED))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sets, pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array(keys, pa.list_(pa.int64()))],
                ["_id", "_n", "_set", "_sketch", "_keys"],
            )

    return mapped(docs, sketch, SKETCHED)


@narrow_broadcasts
def near_duplicates(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    k: int = 64,
    chance: float = 1e-6,
    small: int = 64,
    block: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id, kept (id = component_id).

    Documents are linked when 100 * intersection >= percent * union of their
    shingle sets. ``component_id`` is the smallest id reachable.

    Bottom-k sketches come from one hash function. Documents with equal sets
    are one candidate. Inverted lists over runs of consecutive retained values
    yield the others: two sets at the threshold share no run less often than
    ``chance`` (from which the number of values in runs follows), more similar
    ones less often still; where the whole union is too small for that (sets
    of 4 and 5 at 80 percent), single values are keys, too, and no pair is
    missed. Lists of up to ``small`` documents give their
    pairs. Longer ones give the pairs with their smallest and largest
    document; what these links leave in several components is compared within
    groups of overlapping lists, in pairs of hashed blocks of about ``block``
    documents, only across components, without writing the pairs; a group's
    largest component is not compared with itself. Estimates
    from union sketches drop pairs that share too few values for the
    threshold, which with the lack of a key stays below ``chance`` (if ``k``
    values suffice for it); the rest is verified on the full sets.

    Null and empty texts have no shingles: they are linked with nothing and
    kept. Rows with the same id are one document for links and each get their
    row; a null id is kept, its component null. Other columns are not read.
    """
    similarity = percent / 100
    values = min(k, enough_values(similarity, chance))
    least = least_shared(similarity, k, max(chance - missed(similarity, values), chance / 10))
    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).alias("_text"))
    made = staged(sketches(texts, width, percent, k, values), "sketches")
    linked = made.where("_id IS NOT NULL AND _set IS NOT NULL")
    narrow = linked.select("_id", "_set")
    kinds = narrow.groupBy("_set").agg(F.min("_id").alias("_rep"))
    # The sketch of a class comes from its smallest document.
    reps = linked.join(kinds.select(F.col("_rep").alias("_id"), F.col("_set").alias("_own")), "_id", "left_semi").dropDuplicates(["_id", "_set"])
    reps = reps.join(kinds, "_set").where("_id = _rep")
    keyed = staged(reps.select("_id", F.explode("_keys").alias("key")).distinct(), "keyed")
    lists = keyed.groupBy("key").agg(F.count("*").alias("size"), F.min("_id").alias("first"), F.max("_id").alias("last")).where("size > 1")
    # Long lists are spread over sub-keys by their counted sizes.
    lists = staged(lists.withColumn("_rows", F.col("size")), "sizes")
    members = staged(join_totals(keyed, lists, ["key"], spread=["_id"], how="inner", n="_rows"), "lists")

    few = members.where(F.col("size") <= small).select("key", "_id")
    pairs = few.select("key", F.col("_id").alias("a")).join(few.select("key", F.col("_id").alias("b")), "key").where("a < b").select("a", "b")
    many = members.where(F.col("size") > small)
    for end in ("first", "last"):
        pairs = pairs.unionByName(many.where(F.col("_id") != F.col(end)).select(F.least(end, "_id").alias("a"), F.greatest(end, "_id").alias("b")))
    pairs = pairs.distinct()
    sketch = made.select("_id", "_n", "_sketch").dropDuplicates(["_id"])
    for end in ("a", "b"):
        pairs = pairs.join(sketch.select(F.col("_id").alias(end), F.col("_n").alias(f"n_{end}"), F.col("_sketch").alias(f"s_{end}")), end)
    pairs = staged(pairs.where(_likely(similarity, k, least)).select("a", "b"), "pairs")

    needed = pairs.select(F.col("a").alias("_id")).unionByName(pairs.select(F.col("b").alias("_id"))).unionByName(many.select("_id")).distinct()
    sets = staged(_sets(texts.join(needed, "_id", "left_semi"), width).dropDuplicates(["_id"]), "sets")
    verified = pairs.join(sets.select(F.col("_id").alias("a"), F.col("_hashes").alias("h_a")), "a").join(sets.select(F.col("_id").alias("b"), F.col("_hashes").alias("h_b")), "b")
    both = F.size(F.array_intersect("h_a", "h_b"))
    links = staged(verified.where(100 * both >= percent * (F.size("h_a") + F.size("h_b") - both)).select("a", "b"), "links")
    found = components(links)

    more = _across(many, found, sets, percent, block)
    if more is not None:
        links = links.unionByName(more)
        found = components(links)

    classes = kinds.join(found.select(F.col("node").alias("_rep"), "component"), "_rep", "left").select("_set", F.coalesce("component", "_rep").alias("_component"))
    out = made.select("_id", "_n", "_set").join(classes, "_set", "left")
    component = F.when(F.col("_id").isNotNull(), F.coalesce("_component", "_id"))
    out = out.select(F.col("_id").alias(id_col), F.col("_n").alias("n_shingles"), component.alias("component_id"), F.coalesce(F.col("_id") == component, F.lit(True)).alias("kept"))
    return staged(out, "classes")


def _likely(similarity: float, k: int, least: int):
    """Whether the union sketch of a pair allows the threshold: exact if both sketches hold whole sets."""
    union = F.slice(F.sort_array(F.array_union("s_a", "s_b")), 1, k)
    shared = F.size(F.array_intersect(union, F.array_intersect("s_a", "s_b")))
    whole = (F.col("n_a") <= k) & (F.col("n_b") <= k) & (F.size(F.array_union("s_a", "s_b")) <= k)
    sizes = F.least("n_a", "n_b") >= F.lit(similarity - 1e-9) * F.greatest("n_a", "n_b")
    return sizes & (shared >= F.when(whole, F.size(union) * F.lit(similarity - 1e-9)).otherwise(F.lit(least)))


def _sets(texts: DataFrame, width: int) -> DataFrame:
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Shingles(width)
        for batch in slices(batches, 500):
            sets = [made.of(t).view(SIGNED) for t in as_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["_id", "_hashes"])

    return mapped(texts.select("_id", "_text"), hashed, "_id long, _hashes array<long>")


def _across(many: DataFrame, found: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame | None:
    """Links that join components within long lists, one for each pair of components that a task finds.

    Lists whose documents are in one component are done. The others are
    grouped by overlap, so that documents meet once and not in each list.
    """
    labelled = many.join(found.select(F.col("node").alias("_id"), "component"), "_id", "left").withColumn("component", F.coalesce("component", "_id"))
    open_lists = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    rest = staged(labelled.join(open_lists, "key"), "open")
    if not rest.limit(1).count():
        return None
    groups = components(rest.select(F.col("first").alias("a"), F.col("_id").alias("b")), "groups")
    docs = rest.select("_id", "component").distinct().join(groups.select(F.col("node").alias("_id"), F.col("component").alias("_group")), "_id")
    docs = staged(docs, "grouped")
    # The group's largest component need not meet itself: its documents get blocks of their own, after those of the rest.
    shares = docs.groupBy("_group", "component").count().groupBy("_group").agg(
        F.max_by("component", F.struct("count", "component")).alias("_main"), F.max("count").alias("_most"), F.sum("count").alias("_all")
    )
    count = lambda n: F.ceil(n / block).cast("int")
    shares = shares.select("_group", "_main", count(F.col("_all") - F.col("_most")).alias("_rest"), count(F.col("_most")).alias("_mains"))
    inside = F.col("component") == F.col("_main")
    at = F.pmod(F.xxhash64("_id"), F.when(inside, F.col("_mains")).otherwise(F.col("_rest"))).cast("int")
    placed = docs.join(shares, "_group").withColumn("_at", at + F.when(inside, F.col("_rest")).otherwise(0))
    # A block of the rest meets itself and every other block once.
    last = F.when(inside, F.col("_rest")).otherwise(F.col("_rest") + F.col("_mains")) - 1
    placed = placed.select("*", F.explode(F.sequence(F.lit(0), last)).alias("_other"))
    placed = placed.select("_group", "_id", "component", "_at", F.least("_at", "_other").alias("_i"), F.greatest("_at", "_other").alias("_j"))
    placed = placed.join(sets, "_id")

    def compare(table: pa.Table) -> pa.Table:
        at, i = table["_at"].to_numpy(), table["_i"][0].as_py()
        hashes = table["_hashes"].combine_chunks()
        sizes = np.diff(hashes.offsets.to_numpy())
        flat, owner = hashes.flatten().to_numpy(), np.repeat(np.arange(len(at)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        left, right = np.flatnonzero(at == i), np.flatnonzero((at != i) | (i == table["_j"][0].as_py()))
        place_l, place_r = np.full(len(at), -1), np.full(len(at), -1)
        place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
        shared = np.zeros((len(left), len(right)), np.int32)
        for part in np.split(owner, np.flatnonzero(np.diff(flat)) + 1):
            if len(part) > 1:
                rows, cols = place_l[part], place_r[part]
                shared[np.ix_(rows[rows >= 0], cols[cols >= 0])] += 1
        union = sizes[left][:, None] + sizes[right][None, :] - shared
        component, ids = table["component"].to_numpy(), table["_id"].to_numpy()
        hit = (100 * shared >= percent * union) & (component[left][:, None] != component[right][None, :])
        seen: dict[tuple[int, int], tuple[int, int]] = {}
        for x, y in zip(*np.nonzero(hit), strict=True):
            p, q = left[x], right[y]
            seen.setdefault((min(component[p], component[q]), max(component[p], component[q])), (min(ids[p], ids[q]), max(ids[p], ids[q])))
        return pa.table({"a": pa.array([p for p, _ in seen.values()], pa.int64()), "b": pa.array([q for _, q in seen.values()], pa.int64())})

    got = placed.groupBy("_group", "_i", "_j").applyInArrow(compare, T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())]))
    return staged(got.distinct(), "across")
