"""Hard negatives by exact inner product, searched in STR-packed R-trees with best-first queues."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import staged

LEAF = 128  # rows of a leaf
FAN = 16  # boxes of an inner node
CELL = "_tile long, _pack long, ids array<long>, firsts array<long>, labels array<long>, anchors array<boolean>, dim int, data binary, starts array<int>"
ANCHOR = "kid long, label long, data binary, floor long"
HIT = "anchor long, window int, kid long, first long, score long"
LEAST = -(1 << 62)


def usable(vectors: DataFrame, scale: int, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, vec) of rows with an id, a label and a vector of finite components, floor(scale * x) each; equal rows once."""
    v = F.transform(F.col(vec_col), lambda x: x.cast("double"))
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    fit = F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.col(vec_col).isNotNull() & finite
    rows = vectors.where(F.coalesce(fit, F.lit(False)))
    return rows.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.transform(v, lambda x: F.floor(x * scale)).alias("vec")).distinct()


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Vectors as rows; shorter ones end in zeros."""
    offsets = column.offsets.to_numpy()
    sizes = np.diff(offsets)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    out = np.zeros((len(column), dim), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(offsets[:-1] - offsets[0], sizes)] = flat
    return out


def packed_order(x: np.ndarray, leaf: int) -> tuple[np.ndarray, np.ndarray]:
    """Sort-tile-recursive order of the rows and where each leaf begins.

    The rows are sorted by the coordinate of the widest spread and cut into
    slabs of equally many, each slab by the next one, until a slab is a leaf.
    """
    axes = np.argsort(-x.std(axis=0), kind="stable") if len(x) else np.zeros(0, int)
    order, starts = [], []

    def tile(rows: np.ndarray, depth: int) -> None:
        pages = -(-len(rows) // leaf)
        if pages <= 1 or depth == len(axes):
            for at in range(0, len(rows), leaf):
                starts.append(sum(map(len, order)))
                order.append(rows[at : at + leaf])
            return
        rows = rows[np.argsort(x[rows, axes[depth]], kind="stable")]
        slabs = max(2, round(pages ** (1 / max(1, min(len(axes) - depth, int(np.log2(pages)))))))
        size = -(-pages // slabs) * leaf
        for at in range(0, len(rows), size):
            tile(rows[at : at + size], depth + 1)

    tile(np.arange(len(x)), 0)
    return np.concatenate(order) if order else np.zeros(0, int), np.array(starts, int)


class Tree:
    """An R-tree over packed rows: leaves of consecutive rows, inner nodes of consecutive boxes."""

    def __init__(self, x: np.ndarray, starts: np.ndarray):
        ends = np.append(starts[1:], len(x))
        # Sums of products stay exact in a double below 2^53; beyond that whole numbers are slower but exact.
        top = int(np.abs(x).max(initial=0))
        self.kind = np.float64 if top * top * max(1, x.shape[1]) < 1 << 50 else np.int64
        self.x = x.astype(self.kind)
        self.spans = list(zip(starts.tolist(), ends.tolist(), strict=True))
        low = np.array([self.x[a:b].min(axis=0) for a, b in self.spans])
        high = np.array([self.x[a:b].max(axis=0) for a, b in self.spans])
        self.levels = [(low, high)]
        while len(low) > 1:
            cuts = range(0, len(low), FAN)
            low, high = np.array([low[i : i + FAN].min(axis=0) for i in cuts]), np.array([high[i : i + FAN].max(axis=0) for i in cuts])
            self.levels.append((low, high))

    def bounds(self, q: np.ndarray, level: int, nodes: slice) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest inner product that each box allows: per coordinate the interval's end on the side of q's sign."""
        low, high = (side[nodes] for side in self.levels[level])
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        return low @ up + high @ down, high @ up + low @ down

    def search(self, q: np.ndarray, windows: list[tuple[int, int]], k: int, fit: np.ndarray, firsts: np.ndarray, floors: list[int]) -> list[list[tuple[int, int, int]]]:
        """For each window [low, high] the k best rows: (score, first, row), ties by ``first``.

        Boxes wait in one queue by their upper bound. A box is dropped when
        for every window it lies outside or strictly below the kth score found;
        ``floors`` are lower bounds of that score known beforehand.
        """
        best: list[list[tuple[int, int, int]]] = [[] for _ in windows]
        floor = [max(low, least) for (low, _), least in zip(windows, floors, strict=True)]
        ceiling = max(high for _, high in windows)
        needed = min(floor)
        top = len(self.levels) - 1
        low, high = self.bounds(q, top, slice(0, 1))
        queue = [(-high[0], top, 0, low[0])]
        while queue:
            upper, level, node, lower = heapq.heappop(queue)
            if -upper < needed:
                break
            if lower > ceiling or not any(-upper >= f and lower <= h for f, (_, h) in zip(floor, windows, strict=True)):
                continue
            if level:
                inside = slice(node * FAN, min(node * FAN + FAN, len(self.levels[level - 1][0])))
                low, high = self.bounds(q, level - 1, inside)
                for i in np.flatnonzero((high >= needed) & (low <= ceiling)).tolist():
                    heapq.heappush(queue, (-high[i], level - 1, inside.start + i, low[i]))
                continue
            a, b = self.spans[node]
            scores = self.x[a:b] @ q
            for i in np.flatnonzero((scores >= needed) & (scores <= ceiling) & fit[a:b]).tolist():
                score, row = int(scores[i]), a + i
                for w, (_, h) in enumerate(windows):
                    if floor[w] <= score <= h:
                        mine = best[w]
                        mine.append((-score, int(firsts[row]), row))
                        if len(mine) >= k:
                            mine.sort()
                            del mine[k:]
                            floor[w] = max(floor[w], -mine[-1][0])
                            needed = min(floor)
        return [[(-s, f, r) for s, f, r in sorted(mine)] for mine in best]


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Tree, dict]]:
    """The packed cells of a task, one at a time."""
    for batch in batches:
        for cell in batch.to_pylist():
            x = np.frombuffer(cell["data"], np.int64).reshape(-1, cell["dim"])
            yield Tree(x, np.array(cell["starts"], int)), {"kid": cell["ids"], "first": np.array(cell["firsts"], np.int64), "label": np.array(cell["labels"], np.int64), "anchor": np.array(cell["anchors"], bool)}


def packed(kinds: DataFrame, dim: int, cell_rows: int, sample_rows: int) -> DataFrame:
    """The kinds sort-tile-recursively packed into cells of at most ``cell_rows``, a row each.

    A hashed sample (at most about ``sample_rows``, on the driver) gives the
    cuts of the first coordinates; within such a tile Spark sorts by the next
    coordinate and takes runs of ``cell_rows``. A hash of the id breaks ties,
    so equal coordinates spread over cells. Within a cell a task packs leaves.
    """
    total = kinds.count()
    part = F.pmod(F.xxhash64("kid"), F.lit(1 << 20))
    sample = kinds.where(part < max(1, (1 << 20) * sample_rows // total)) if total > sample_rows else kinds
    table = sample.select("vec", F.xxhash64("kid").alias("h")).toArrow()
    x = _matrix(table.column(0).combine_chunks(), dim) if table.num_rows else np.zeros((0, dim), np.int64)
    hashes = np.array(table.column(1).to_pylist(), np.int64)
    axes = np.argsort(-x.std(axis=0), kind="stable").tolist() if len(x) else []
    tiles = min(-(-total // cell_rows), max(1, len(x) // 8))
    depth = min(len(axes), max(0, int(np.log2(max(1, tiles)) / 2)))
    slabs = int(np.ceil(tiles ** (1 / depth))) if depth else 1
    cuts: dict[tuple[int, ...], list[tuple[int, int]]] = {}

    def cut(rows: np.ndarray, path: tuple[int, ...]) -> None:
        if len(path) == depth:
            return
        rows = rows[np.lexsort((hashes[rows], x[rows, axes[len(path)]]))]
        at = [len(rows) * i // slabs for i in range(slabs + 1)]
        cuts[path] = [(int(x[rows[i], axes[len(path)]]), int(hashes[rows[i]])) for i in at[1:-1] if i < len(rows)]
        for i in range(slabs):
            cut(rows[at[i] : at[i + 1]], (*path, i))

    cut(np.arange(len(x)), ())
    known = kinds.sparkSession.sparkContext.broadcast((cuts, axes, depth, slabs))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the tile and the coordinate that the tile is sorted by."""
        cuts, axes, depth, slabs = known.value
        for batch in batches:
            x, h = _matrix(batch.column("vec"), dim), batch.column("_h").to_numpy()
            path = np.zeros(len(x), np.int64)
            paths: list[tuple[int, ...]] = [()]
            for d in range(depth):
                after = []
                moved = np.zeros(len(x), np.int64)
                for i, p in enumerate(paths):
                    rows = np.flatnonzero(path == i)
                    slab = np.zeros(len(rows), np.int64)
                    for value, hashed in cuts[p]:
                        at = x[rows, axes[d]]
                        slab += (at > value) | (at == value) & (h[rows] >= hashed)
                    moved[rows] = i * slabs + slab
                    after += [(*p, s) for s in range(slabs)]
                path, paths = moved, after
            along = x[:, axes[depth % len(axes)]] if axes and dim else np.zeros(len(x), np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(path), pa.array(along)], [*batch.schema.names, "_tile", "_along"])

    rows = kinds.withColumn("_h", F.xxhash64("kid"))
    rows = rows.mapInArrow(deal, T.StructType([*rows.schema.fields, T.StructField("_tile", T.LongType()), T.StructField("_along", T.LongType())]))
    order = Window.partitionBy("_tile").orderBy("_along", "_h", "kid")
    rows = rows.withColumn("_pack", F.floor((F.row_number().over(order) - 1) / cell_rows))

    def pack(table: pa.Table) -> pa.Table:
        x = _matrix(table.column("vec").combine_chunks(), dim)
        order, starts = packed_order(x, LEAF)
        column = lambda name: pa.array([table.column(name).take(pa.array(order)).to_pylist()])
        values = [table.column("_tile")[:1].combine_chunks(), table.column("_pack")[:1].combine_chunks(), column("kid"), column("first"), column("label"), column("asked")]
        values += [pa.array([dim], pa.int32()), pa.array([x[order].tobytes()], pa.binary()), pa.array([starts.tolist()], pa.list_(pa.int32()))]
        return pa.table(values, names=["_tile", "_pack", "ids", "firsts", "labels", "anchors", "dim", "data", "starts"])

    return staged(rows.select("kid", "label", "first", "asked", "vec", "_tile", "_pack").groupBy("_tile", "_pack").applyInArrow(pack, CELL), "cells")


def _seed(cells: DataFrame, k: int) -> DataFrame:
    """Anchors with the kth score of their own label in their own cell, which no search needs to go below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tree, rows in _trees(batches):
            found = []
            for i in np.flatnonzero(rows["anchor"]).tolist():
                hits = tree.search(tree.x[i], [(LEAST, -LEAST)], k, rows["label"] == rows["label"][i], rows["first"], [LEAST])[0]
                floor = min(h[0] for h in hits) if len(hits) == k else LEAST
                found.append((rows["kid"][i], int(rows["label"][i]), tree.x[i].astype(np.int64).tobytes(), floor))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True) if found else ((), (), (), ()), (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)], ["kid", "label", "data", "floor"])

    return cells.mapInArrow(run, ANCHOR)


def _search(cells: DataFrame, asked: DataFrame, k: int, same: bool, block_rows: int) -> DataFrame:
    """HIT rows of every cell for ``asked`` (kid, label, data, floor, windows), the k best of a task for each window.

    Anchors go round in blocks; a block meets every cell where the cell is. A
    cell's outermost box is held against all anchors of the block at once.
    """
    blocks = max(1, -(-asked.count() // block_rows))
    out = None
    for b in range(blocks):
        block = asked.where(F.pmod(F.xxhash64("kid"), F.lit(blocks)) == b).select("kid", "label", "data", "floor", "windows").collect()  # a block of anchors
        sent = cells.sparkSession.sparkContext.broadcast([(r.kid, r.label, r.data, r.floor, [(w[0], w[1]) for w in r.windows]) for r in block])

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            anchors = sent.value
            best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
            queries = np.array([np.frombuffer(a[2], np.int64) for a in anchors])
            least = np.array([max(a[3], min(w[0] for w in a[4])) for a in anchors])
            most = np.array([max(w[1] for w in a[4]) for a in anchors])
            for tree, rows in _trees(batches) if anchors else ():
                q = queries.astype(tree.kind)
                low, high = (side[0] for side in tree.levels[-1])
                up, down = np.maximum(q, 0), np.minimum(q, 0)
                reach = (up @ high + down @ low >= least) & (up @ low + down @ high <= most)
                for i in np.flatnonzero(reach).tolist():
                    kid, label, _, floor, windows = anchors[i]
                    fit = (rows["label"] == label) == same
                    known = [best.get((i, w), ()) for w in range(len(windows))]
                    floors = [max(floor, mine[-1][0]) if len(mine) == k else floor for mine in known]
                    for w, hits in enumerate(tree.search(q[i], windows, k, fit, rows["first"], floors)):
                        if hits:
                            mine = [*known[w], *((s, f, rows["kid"][r]) for s, f, r in hits)]
                            best[i, w] = sorted(mine, key=lambda h: (-h[0], h[1], h[2]))[:k]
            flat = [(anchors[i][0], w, kid, first, score) for (i, w), mine in best.items() for score, first, kid in mine]
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*flat, strict=True) if flat else ((),) * 5, kinds, strict=True)], ["anchor", "window", "kid", "first", "score"])

        got = cells.mapInArrow(run, HIT)
        out = got if out is None else out.unionByName(got)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "first", "kid")
    return staged(out.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k).drop("_n"), "hits")


def mine(
    vectors: DataFrame,
    is_anchor,
    positives: int = 5,
    negatives: int = 3,
    window: tuple[int, int] = (50, 95),
    relabel=None,
    scale: int = 256,
    cell_rows: int = 4096,
    sample_rows: int = 20_000,
    block_rows: int = 8192,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """Hard negatives of the rows for which ``is_anchor`` (over the id) holds.

    An anchor's positives are the ``positives`` nearest other rows of its label
    by integer inner product, ties to smaller ids. For each of them the
    ``negatives`` first rows of other labels with a score between
    window[0] and window[1] percent of the positive's (both included) are
    returned: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. A positive without any gives no row, nor does one with a
    negative score, as its window is empty.

    ``relabel`` (over id and label) may replace labels. Components are
    floor(scale * x); scores are expected to fit 64 bits. Rows with a null id,
    label, vector or component or a non-finite component take no part; shorter
    vectors count as ending in zeros; equal rows count once, rows that share
    only an id are separate. Rows of one vector and label are searched as one:
    their smallest ids suffice, as all have the same scores. Results are exact.
    """
    if not 0 <= window[0] < window[1]:
        raise ValueError("the window goes from a smaller to a larger percentage")
    spark, k = vectors.sparkSession, positives + 1  # an anchor may find itself
    rows = usable(vectors, scale, id_col, vec_col, label_col)
    if relabel is not None:
        rows = rows.withColumn("label", relabel(F.col("vec_id"), F.col("label")).cast("long"))
    rows = staged(rows.withColumn("asked", is_anchor(F.col("vec_id"))), "usable")
    dim = rows.agg(F.max(F.size("vec"))).first()[0] or 0
    first = Window.partitionBy("vec", "label").orderBy("vec_id")
    some = rows.withColumn("_n", F.row_number().over(first)).where(F.col("_n") <= k)
    ids = some.groupBy("vec", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    wanted = rows.where("asked").select("vec", "label").distinct().withColumn("asked", F.lit(True))
    kinds = ids.join(wanted, ["vec", "label"], "left").select("vec", "label", "ids", F.col("ids")[0].alias("first"), F.coalesce("asked", F.lit(False)).alias("asked"))
    kinds = staged(kinds.withColumn("kid", F.monotonically_increasing_id()), "kinds")
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not dim or not wanted.limit(1).count():
        return spark.createDataFrame([], empty)
    cells = packed(kinds, dim, cell_rows, sample_rows)
    anchors = staged(_seed(cells, k), "anchors")
    whole = F.array(F.struct(F.lit(LEAST).alias("low"), F.lit(-LEAST).alias("high")))
    near = _search(cells, anchors.withColumn("windows", whole), k, True, block_rows)
    near = near.join(kinds.select("kid", F.explode("ids").alias("id")), "kid")
    order = Window.partitionBy("anchor").orderBy(F.desc("score"), "id")
    near = near.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k)
    lists = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("_n", "id", "score"))).alias("list"))
    own = rows.where("asked").select("vec_id", "vec", "label").join(kinds.where("asked").select("vec", "label", F.col("kid").alias("anchor")), ["vec", "label"])
    # Rows that share an id are told apart by their vector: one's own entry is the first with that id at one's own score.
    own = own.select("vec_id", "anchor", F.aggregate("vec", F.lit(0).cast("long"), lambda s, x: s + x * x).alias("self"))
    own = own.join(lists, "anchor")
    at = F.array_position(F.transform("list", lambda h: (h["id"] == F.col("vec_id")) & (h["score"] == F.col("self"))), True)
    others = F.filter("list", lambda h, i: i + 1 != at)
    pairs = own.select("vec_id", "anchor", F.explode(F.slice(others, 1, positives)).alias("p"))
    pairs = staged(pairs.select("vec_id", "anchor", F.col("p.id").alias("positive_id"), F.col("p.score").alias("positive_score")), "pairs")
    asked = pairs.where("positive_score >= 0").groupBy("anchor").agg(F.sort_array(F.collect_set("positive_score")).alias("scores"))
    # In two steps, so that no product leaves 64 bits.
    low, high = (f"s div 100 * {w} + (s % 100 * {w} + {up}) div 100" for w, up in zip(window, (99, 0), strict=True))
    windows = F.expr(f"transform(scores, s -> named_struct('low', {low}, 'high', {high}))")
    asked = anchors.join(asked, F.col("kid") == F.col("anchor")).select("kid", "label", "data", F.lit(LEAST).alias("floor"), windows.alias("windows"), "scores")
    asked = staged(asked, "asked")
    hits = _search(cells, asked, negatives, False, block_rows)
    hits = hits.join(asked.select(F.col("kid").alias("anchor"), "scores"), "anchor").withColumn("positive_score", F.element_at("scores", F.col("window") + 1))
    hits = hits.join(kinds.select("kid", F.explode("ids").alias("negative_id")), "kid")
    order = Window.partitionBy("anchor", "positive_score").orderBy(F.desc("score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    hits = hits.select("anchor", "positive_score", "rank", "negative_id", F.col("score").alias("negative_score"))
    out = pairs.join(hits, ["anchor", "positive_score"])
    return out.select(F.col("vec_id").alias("anchor_id"), "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
