"""Benchmark decontamination by Wu-Manber search over words."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import as_bytes, mapped, slices, staged

# Bytes of words: 0-9, a-z and all of non-ASCII; A-Z become lower case, the rest separates.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)

WINDOW = T.StructType([T.StructField("words", T.BinaryType()), T.StructField("item", T.StringType())])
HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def search_tables(patterns: dict[tuple[bytes, ...], list[str]]) -> tuple[list, list[list[str]]]:
    """Wu-Manber tables for many word sequences, and the items of each sequence.

    Sequences of one length share a table. A block is the last two words of
    the text under the table's window. ``shift`` tells how far the window may
    move given its block, ``buckets`` holds the sequences that end in a block,
    under their first word; those are compared word by word.
    """
    tables = []
    for m in sorted({len(p) for p in patterns}):
        block = min(2, m)
        shift: dict[tuple[bytes, ...], int] = {}
        buckets: dict[tuple[bytes, ...], dict[bytes, list[tuple[list[bytes], int]]]] = {}
        for k, p in enumerate(patterns):
            if len(p) != m:
                continue
            for end in range(block, m + 1):
                key = p[end - block : end]
                shift[key] = min(shift.get(key, m), m - end)
            buckets.setdefault(p[m - block :], {}).setdefault(p[0], []).append((list(p), k))
        tables.append((m, block, shift, buckets))
    return tables, list(patterns.values())


def find(search: tuple[list, list[list[str]]], words: list[bytes]) -> tuple[list[list[int]], set[str]]:
    """Runs of covered words (start, end) in order, and the items that occur."""
    found: list[tuple[int, int]] = []
    items: set[str] = set()
    n = len(words)
    for m, block, shift, buckets in search[0]:
        end, far, move = m, m - block + 1, shift.get
        while end <= n:
            key = (words[end - 2], words[end - 1]) if block == 2 else (words[end - 1],)
            step = move(key, far)
            if step:
                end += step
                continue
            for pattern, k in buckets[key].get(words[end - m], ()):
                if words[end - m : end] == pattern:
                    found.append((end - m, end))
                    items.update(search[1][k])
            end += 1
    runs: list[list[int]] = []
    for start, end in sorted(found):
        if runs and start <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], end)
        else:
            runs.append([start, end])
    return runs, items

# Bytes that Python holds for a window of the search table and for each of its words, beside the text.
WINDOW_BYTES, WORD_BYTES = 500, 48


def windows(benchmark: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """Each item's windows of ``width`` words (a shorter item is one window): words joined by spaces, item id."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1)), strict=True):
                w = words_of(text)
                if w and item is not None:
                    rows += [(b" ".join(w[i : i + width]), item) for i in range(max(1, len(w) - width + 1))]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], ["words", "item"])

    return mapped(benchmark.select(F.col(id_col).cast("string"), text_col), cut, WINDOW).distinct()


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = 10,
    block_bytes: int = 64 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    bench_id: str = "item_id",
    bench_text: str = "text",
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per row of ``docs``: id, n_words, spans (runs of hit words, [start, end)), items (ids, sorted as strings).

    With ``keep`` there is also a struct ``kept`` of those columns.

    Words are runs of 0-9, a-z and non-ASCII after lower-casing A-Z. Windows
    go to the executors as one search table when they take at most
    ``block_bytes``; a larger benchmark is cut into blocks of that size by a
    hash, every block is searched in all documents, and the hits of a document
    are joined. No shuffle of texts in either case.

    Null and empty texts have no words and no hits; items without words or
    without id are no items; an empty benchmark hits nothing; repeated rows
    of documents each get their row; repeated items count once. Further
    columns of either table are not read.
    """
    spark = docs.sparkSession
    cut = windows(benchmark, width, bench_id, bench_text)
    size = cut.agg(F.sum(F.length("words") + F.length("item") + WINDOW_BYTES + WORD_BYTES * width)).first()[0] or 0
    blocks = -(-size // block_bytes) or 1
    kept = [*dict.fromkeys(keep)]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(kept)])
    apart = [F.struct(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(kept)]).alias("kept")] if kept else []
    named = [F.col("_id").alias(id_col), *apart, "n_words"]
    if blocks == 1:
        return _searched(texts, _table(cut)).select(*named, "spans", "items")
    cut = staged(cut.withColumn("block", F.pmod(F.xxhash64("words"), F.lit(blocks))), "windows")
    key = F.concat(F.coalesce(F.col("_id").cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce("_text", F.lit("")))
    keyed = texts.withColumn("_key", F.unhex(F.md5(key)))  # rows with one key have the same hits
    bare = keyed.select("_id", "_text", "_key")
    parts = [_searched(bare, _table(cut.where(F.col("block") == b))) for b in range(blocks)]
    hits = None
    for part in parts:
        part = part.where(F.size("items") > 0).select("_id", "_key", "spans", "items")
        hits = part if hits is None else hits.unionByName(part)
    hits = (
        hits.groupBy("_key")
        .agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .withColumn("spans", _merged(F.array_sort("spans")))
    )
    none = _searched(keyed, spark.sparkContext.broadcast(search_tables({})))
    return none.drop("spans", "items").join(hits, "_key", "left").select(
        *named,
        F.coalesce("spans", F.array().cast("array<array<bigint>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def _table(cut: DataFrame):
    patterns: dict[tuple[bytes, ...], list[str]] = {}
    for words, item in cut.select("words", "item").collect():  # at most block_bytes
        patterns.setdefault(tuple(bytes(words).split(b" ")), []).append(item)
    return cut.sparkSession.sparkContext.broadcast(search_tables(patterns))


def _searched(texts: DataFrame, table) -> DataFrame:
    names = [c for c in texts.columns if c != "_text"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = table.value
        for batch in slices(batches):
            counts, spans, items = [], [], []
            for text in as_bytes(batch.column("_text")):
                w = words_of(text)
                runs, found = find(tables, w)
                counts.append(len(w))
                spans.append(runs)
                items.append(sorted(found))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(items, pa.list_(pa.string()))],
                [*names, *HITS.names],
            )

    schema = T.StructType([*(texts.schema[c] for c in names), *HITS.fields])
    return mapped(texts, search, schema)


def _merged(spans):
    """Sorted runs with overlapping and touching ones joined."""
    last = F.element_at
    return F.aggregate(
        spans,
        F.array().cast("array<array<bigint>>"),
        lambda runs, s: F.when(
            (F.size(runs) > 0) & (s[0] <= F.coalesce(F.try_element_at(F.try_element_at(runs, F.lit(-1)), F.lit(2)), F.lit(-1))),
            F.concat(
                F.slice(runs, 1, F.greatest(F.size(runs) - 1, F.lit(0))),
                F.array(F.array(last(last(runs, -1), 1), F.greatest(last(last(runs, -1), 2), s[1]))),
            ),
        ).otherwise(F.concat(runs, F.array(s))),
    )


def n_hit(spans):
    """Number of words that the runs cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
