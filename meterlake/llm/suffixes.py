"""Removal of byte strings that an earlier document already holds, by prefix doubling over sampled positions."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import U64, as_bytes, mixed, staged

SEGMENT = 1 << 22  # bytes of a text handled at once
FLUSH = 1_000_000  # positions a task gathers before it sends them on
BUCKET = 1_000_000  # positions that meet in one task, about
BUSY = 64  # positions of one rank in a flush from which on they are spread
LAST = np.iinfo(np.int64).max


def lengths(threshold: int) -> list[int]:
    """Prefix lengths of the doubling, each at most twice the one before; the first at most twice 8."""
    out = [threshold]
    while out[0] > 16:
        out.insert(0, (out[0] + 1) // 2)
    return out


def ranks(data: bytes, steps: list[int]) -> dict[int, np.ndarray]:
    """Rank of the prefix of each length at each position: the pair of two ranks of the length before, hashed to 64 bits.

    Eight bytes are their own number. Equal strings have equal ranks in every
    document, so that ranks need no global sort to be named.
    """
    rank = np.frombuffer(data, np.uint8).astype(np.uint64)
    size = 1
    while size < 8:
        rank = (rank[: max(0, len(rank) - size)] << U64(8 * size)) | rank[size:]
        size *= 2
    out = {}
    for step in steps:
        offset = step - size
        rank = mixed(rank[: max(0, len(rank) - offset)] * U64(0x9E3779B97F4A7C15) + rank[offset:])
        size, out[step] = step, rank
    return out


def least_in_window(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    rest = width - size
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def segments(data: bytes, threshold: int) -> Iterator[tuple[int, bytes]]:
    """Parts of the text such that every string of ``threshold`` bytes starts in one of them."""
    for at in range(0, max(0, len(data) - threshold + 1), SEGMENT):
        yield at, data[at : at + SEGMENT + threshold - 1]


def sampled(data: bytes, threshold: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Runs of neighbouring starts of whole strings that sample the same position.

    A string samples the position of its least rank at half its length; equal
    strings sample equal ranks. Yields the sampled rank, the rank of the run
    (from its first and last whole string, which cover it), start, count.
    """
    steps = lengths(threshold)
    half = steps[-2] if len(steps) > 1 else 8
    width = threshold - half + 1
    for at, part in segments(data, threshold):
        got = ranks(part, steps if len(steps) > 1 else [8, threshold])
        least = least_in_window(got[half], width)
        whole = got[threshold]
        start = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
        count = np.diff(np.concatenate([start, [len(least)]]))
        pieces = -(-count // width)
        of = np.repeat(np.arange(len(start)), pieces)
        nth = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        begin = start[of] + nth * width
        n = np.minimum(width, count[of] - nth * width)
        run = mixed(mixed(whole[begin] * U64(0x9E3779B97F4A7C15) + whole[begin + n - 1]) + n.astype(np.uint64))
        yield least[begin], run, begin + at, n


BLOB = "bucket int, kind int, rank binary, run binary, doc binary, row binary, start binary, n binary"
NAMES = [part.split()[0] for part in BLOB.split(", ")]
OPEN, DONE, KNOWN = 0, 1, 2


def blobs(kind: int, bucket: np.ndarray, rank: np.ndarray, run: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """One Arrow row for each bucket with its positions, in the order of documents, which compresses best."""
    order = np.lexsort((start, row, doc, bucket))
    bucket = bucket[order]
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(bucket)]])
    parts = [x[order].astype(t) for x, t in ((rank, np.uint32), (run, np.uint64), (doc, np.int64), (row, np.int64), (start, np.int64), (n, np.uint8))]
    spans = list(zip(cuts[:-1], cuts[1:], strict=True)) if len(bucket) else []
    columns = [pa.array([int(bucket[a]) for a, _ in spans], pa.int32()), pa.array([kind] * len(spans), pa.int32())]
    columns += [pa.array([x[a:b].tobytes() for a, b in spans], pa.binary()) for x in parts]
    return pa.RecordBatch.from_arrays(columns, NAMES)


def unpacked(table: pa.Table) -> list[np.ndarray]:
    types = (np.uint32, np.uint64, np.int64, np.int64, np.int64, np.uint8)
    return [np.frombuffer(b"".join(table[name].to_pylist()), t) for name, t in zip(NAMES[2:], types, strict=True)]


def homes(row: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket where everything about a document meets."""
    return (mixed(row.astype(np.int64).view(np.uint64)) % U64(buckets)).astype(np.int64)


def first_of(key_change: np.ndarray, values: np.ndarray) -> np.ndarray:
    """For sorted rows, the first value of each row's group."""
    starts = np.flatnonzero(key_change)
    return values[starts][np.cumsum(key_change) - 1]


def changes(*keys: np.ndarray) -> np.ndarray:
    out = np.ones(len(keys[0]), bool)
    if len(out):
        out[1:] = False
        for k in keys:
            out[1:] |= k[1:] != k[:-1]
    return out


def _none(n: int) -> np.ndarray:
    return np.zeros(n, np.uint64)


def _settle(batch: list[tuple[np.ndarray, ...]], buckets: int, by_run: bool) -> Iterator[pa.RecordBatch]:
    """What a task knows by itself is settled, the rest goes to the buckets of its ranks.

    Of equal runs (or strings) in a task only those of the smallest document
    go on; the others are removed. So a task sends at most one document for a
    string, however frequent. Ranks that a task has met very often, in two
    documents, need no proof that they repeat: their positions are dealt by
    run, but for two that tell the rank's bucket.
    """
    rank, run, doc, row, start, n = (np.concatenate(x) for x in zip(*batch, strict=True))
    order = np.lexsort((doc, run, rank))
    rank, run, doc, row, start, n = (x[order] for x in (rank, run, doc, row, start, n))
    later = doc > first_of(changes(rank, run), doc)
    if later.any():
        yield blobs(DONE, homes(row[later], buckets), _none(later.sum()), _none(later.sum()), doc[later], row[later], start[later], n[later])
    rank, run, doc, row, start, n = (x[~later] for x in (rank, run, doc, row, start, n))
    order = np.lexsort((doc, rank))
    rank, run, doc, row, start, n = (x[order] for x in (rank, run, doc, row, start, n))
    new = changes(rank)
    starts = np.flatnonzero(new)
    sizes = np.diff(np.concatenate([starts, [len(rank)]]))
    ends = starts + sizes - 1
    busy = (sizes > BUSY) & (doc[starts] < doc[ends]) & by_run
    known = busy[np.cumsum(new) - 1]
    known[starts] = known[ends] = False
    for kind, own, key in ((OPEN, ~known, rank), (KNOWN, known, run)):
        if own.any():
            # The low 32 bits of a rank go along, its bucket comes from the others.
            bucket = ((mixed(key[own]) if kind == KNOWN else key[own] >> U64(32)) % U64(buckets)).astype(np.int64)
            yield blobs(kind, bucket, rank[own] & U64(0xFFFFFFFF), run[own], doc[own], row[own], start[own], n[own])


def _gathered(parts: Iterator[tuple[np.ndarray, ...]], buckets: int, by_run: bool) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= FLUSH:
            yield from _settle(held, buckets, by_run)
            held, size = [], 0
    if held:
        yield from _settle(held, buckets, by_run)


def _ids(batch: pa.RecordBatch) -> Iterator[tuple[int, int, bytes]]:
    for doc, row, text in zip(batch.column("doc").to_pylist(), batch.column("row").to_pylist(), as_bytes(batch.column("text")), strict=True):
        yield LAST if doc is None else doc, row, text or b""


def _sample(texts: DataFrame, threshold: int, buckets: int) -> DataFrame:
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        for batch in batches:
            for doc, row, text in _ids(batch):
                for rank, run, start, n in sampled(text, threshold):
                    yield rank, run, np.full(len(rank), doc), np.full(len(rank), row), start, n

    return texts.mapInArrow(lambda batches: _gathered(parts(batches), buckets, True), BLOB)


def _apart(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """What the sending task has settled, to be passed on, and the rest."""
    table = table.select(NAMES)
    done = np.asarray(table["kind"].to_numpy() == DONE)
    fields = pa.schema([(name, pa.int32() if i < 2 else pa.binary()) for i, name in enumerate(NAMES)])
    return table.filter(pa.array(done)).cast(fields), table.filter(pa.array(~done)).cast(fields)


def _by_rank(sample: DataFrame, buckets: int) -> DataFrame:
    """Sampled positions sorted by rank, run and document.

    A rank met in one document only is unique: its strings stay. Runs that a
    smaller document has are removed. The others of ranks with several runs
    stay open, string by string.
    """

    def settle(table: pa.Table) -> pa.Table:
        settled, table = _apart(table)
        if not table.num_rows:
            return settled
        kind = np.repeat(table["kind"].to_numpy(), [len(x) // 4 for x in table["rank"].to_pylist()])
        rank, run, doc, row, start, n = unpacked(table)
        order = np.lexsort((doc, run, rank))
        kind, rank, run, doc, row, start, n = (x[order] for x in (kind, rank, run, doc, row, start, n))
        new_run, new_rank = changes(rank, run), changes(rank)
        starts = np.flatnonzero(new_rank)
        of = np.cumsum(new_rank) - 1
        several = (np.add.reduceat(new_run.astype(np.int64), starts) > 1) & (np.minimum.reduceat(doc, starts) < np.maximum.reduceat(doc, starts))
        several |= np.maximum.reduceat(kind, starts) == KNOWN
        first = first_of(new_run, doc)
        out = []
        for say, own in ((DONE, doc > first), (OPEN, (doc == first) & several[of])):
            k = int(own.sum())
            out.append(blobs(say, homes(row[own], buckets), _none(k), _none(k), doc[own], row[own], start[own], n[own]))
        return pa.concat_tables([settled, pa.Table.from_batches(out)])

    return sample.groupBy("bucket").applyInArrow(settle, BLOB)


def _by_string(strings: DataFrame, buckets: int) -> DataFrame:
    """Whole strings sorted by rank and document: those that a smaller document has are removed."""

    def settle(table: pa.Table) -> pa.Table:
        settled, table = _apart(table)
        if not table.num_rows:
            return settled
        _, run, doc, row, start, n = unpacked(table)
        order = np.lexsort((doc, run))
        run, doc, row, start, n = (x[order] for x in (run, doc, row, start, n))
        own = doc > first_of(changes(run), doc)
        k = int(own.sum())
        found = blobs(DONE, homes(row[own], buckets), _none(k), _none(k), doc[own], row[own], start[own], n[own])
        return pa.concat_tables([settled, pa.Table.from_batches([found])])

    return strings.groupBy("bucket").applyInArrow(settle, BLOB)


def _by_document(found: DataFrame) -> DataFrame:
    """(row, starts): for each document its runs of starts, as pairs (start, count) of 64-bit numbers."""

    def gather(table: pa.Table) -> pa.Table:
        _, _, _, row, start, n = unpacked(table)
        order = np.lexsort((start, row))
        row, pairs = row[order], np.stack([start[order], n[order].astype(np.int64)], axis=1)
        at = np.flatnonzero(changes(row))
        ends = np.concatenate([at[1:], [len(row)]])
        return pa.table({"row": pa.array(row[at], pa.int64()), "starts": pa.array([pairs[a:b].tobytes() for a, b in zip(at, ends, strict=True)], pa.binary())})

    return found.groupBy("bucket").applyInArrow(gather, "row long, starts binary")


def _strings(texts: DataFrame, threshold: int, buckets: int) -> DataFrame:
    """Ranks of the open strings of each text, whole length."""

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
        steps = lengths(threshold)
        for batch in batches:
            for (doc, row, text), packed in zip(_ids(batch), batch.column("starts").to_pylist(), strict=True):
                pairs = np.frombuffer(packed, np.int64).reshape(-1, 2)
                wanted = np.repeat(pairs[:, 0], pairs[:, 1]) + np.arange(pairs[:, 1].sum()) - np.repeat(np.cumsum(pairs[:, 1]) - pairs[:, 1], pairs[:, 1])
                for at, part in segments(text, threshold):
                    mine = wanted[(wanted >= at) & (wanted < at + SEGMENT)]
                    if len(mine):
                        rank = ranks(part, steps)[threshold][mine - at]
                        yield rank, rank, np.full(len(rank), doc), np.full(len(rank), row), mine, np.ones(len(rank), np.int64)

    return texts.mapInArrow(lambda batches: _gathered(parts(batches), buckets, False), BLOB)


def _cut(texts: DataFrame, threshold: int) -> DataFrame:
    """What is left of the texts with removed strings."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for (_, row, text), packed in zip(_ids(batch), batch.column("starts").to_pylist(), strict=True):
                pairs = np.frombuffer(packed, np.int64).reshape(-1, 2)
                begin, end = pairs[:, 0], np.maximum.accumulate(pairs[:, 0] + pairs[:, 1] - 1 + threshold)
                new = np.concatenate([[True], begin[1:] > end[:-1]])
                begin, end = begin[new], end[np.concatenate([new[1:], [True]])]
                edges = [0, *np.stack([begin, end], axis=1).ravel().tolist(), len(text)]
                left = b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
                rows.append((row, len(text) - len(left), len(begin), hashlib.sha256(left).hexdigest(), np.stack([begin, end], axis=1).tolist()))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], CUT.names)

    return texts.mapInArrow(cut, CUT)


CUT = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("n_spans", T.LongType()),
        T.StructField("kept_sha256", T.StringType()),
        T.StructField("spans", T.ArrayType(T.ArrayType(T.LongType()))),
    ]
)


def remove_repeats(docs: DataFrame, threshold: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_removed, n_spans, kept_sha256, spans (removed byte runs, [start, end)).

    A byte goes if a string of ``threshold`` bytes that covers it also starts
    in a document with a smaller id, judged on the input; matches stay within
    documents. ``threshold`` is at least 16.

    Prefix doubling: the rank of a position at length 2h is the pair of the
    ranks at the position and h further, named by a 64-bit hash, so the ranks
    up to half the threshold need no shuffle. Spark then sorts positions by
    rank: first one sampled position for every run of strings (the least rank
    at half length within the string), where ranks of a single document drop
    out as unique and equal runs are settled together; then, at full length,
    the strings still open. Sorting every byte at every length would move some
    hundred times the input.

    Null texts are empty; texts shorter than the threshold lose nothing. Rows
    with equal ids do not shorten each other. A null id counts as the largest.
    Further columns are not read. An empty table gives an empty result.
    """
    if threshold < 16:
        raise ValueError("threshold must be at least 16")
    text = F.coalesce(F.col(text_col), F.lit(""))
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.xxhash64(F.col(id_col), text).alias("row"), text.alias("text"))
    base = staged(texts.select("doc", "row", F.octet_length("text").cast("long").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("sha")), "sizes")
    total = base.agg(F.sum("n_bytes")).first()[0] or 0
    # About two sampled positions for as many bytes as half the threshold.
    buckets = max(1, -(-total * 4 // threshold // BUCKET))
    first = staged(_by_rank(_sample(texts, threshold, buckets), buckets), "ranked")
    opened = texts.join(_by_document(first.where(F.col("kind") == OPEN)), "row")
    second = staged(_by_string(_strings(opened, threshold, buckets), buckets), "strings")
    found = first.where(F.col("kind") == DONE).unionByName(second)
    cut = _cut(texts.join(_by_document(found), "row"), threshold).dropDuplicates(["row"])
    out = base.join(cut, "row", "left")
    zero = F.lit(0).cast("long")
    return out.select(
        F.col("doc").alias(id_col),
        "n_bytes",
        F.coalesce("n_removed", zero).alias("n_removed"),
        F.coalesce("n_spans", zero).alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"),
        F.coalesce("spans", F.array().cast(CUT["spans"].dataType)).alias("spans"),
    )
