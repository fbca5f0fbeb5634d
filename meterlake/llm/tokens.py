"""Token counts by prefix dynamic programming: the exact count at every prefix of a text.

The encoding of a prefix is that of a shorter prefix and one more token: the
only token that ends there and stays apart from the token before it. So one
pass from left to right gives the count at every byte, and what a text costs
when cut anywhere is read off without encoding again.
"""

from __future__ import annotations

import functools
import json
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import slices

VOCABULARY = "byte_bpe_50k.json"
STEP = 1 << 16  # pieces, or stored prefixes, that are in memory as Python objects or in a block at a time
CACHED = 1 << 19  # distinct pieces whose counts a worker keeps
SHORT = 64  # code points of a piece worth keeping


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 is itself, the rest follows from U+0100 on."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xFF and b != 0xAD]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Merges:
    """A byte-level merge vocabulary: which tokens end where, and which two tokens stay apart side by side."""

    def __init__(self, model: dict):
        letters = byte_letters()
        raw = lambda word: bytes([letters[c] for c in word])
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        self.parts: dict[bytes, tuple[bytes, bytes]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = map(raw, pair.split(" ") if isinstance(pair, str) else pair)
            self.ranks.setdefault((a, b), rank)
            self.parts.setdefault(a + b, (a, b))
        self.tokens = set(map(raw, model["vocab"]))
        self.ends: dict[bytes, tuple[list, list] | None] = {}
        # Tokens read from their ends: node and byte before -> node, and the token that a node spells.
        self.steps: dict[int, int] = {}
        self.spelled: list[bytes | None] = [None]
        for token in self.tokens:
            node = 0
            for byte in reversed(token):
                key = node << 8 | byte
                node = self.steps.get(key)
                if node is None:
                    node = self.steps[key] = len(self.spelled)
                    self.spelled.append(None)
            self.spelled[node] = token
        # Of the token of a node, once it was met: whether it stays apart from the token of another; False if the merges never make it.
        self.apart: list[dict[int, bool] | bool | None] = [False if token is None else None for token in self.spelled]
        self.known = 0

    def encode(self, word: bytes) -> list[bytes]:
        """The merges applied to a few bytes, lowest rank first, leftmost first."""
        parts = [word[i : i + 1] for i in range(len(word))]
        while len(parts) > 1:
            ranked = [(self.ranks.get(pair, 1 << 30), i) for i, pair in enumerate(zip(parts, parts[1:]))]  # noqa: B905
            rank, at = min(ranked)
            if rank == 1 << 30:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def edges(self, token: bytes) -> tuple[list, list] | None:
        """What stands at a token's right and left edge while it is being merged, each with the rank of the merge that takes it in.

        None if the bytes are no token, or one that the merges never make.
        """
        if token not in self.ends:
            if token not in self.tokens or self.encode(token) != [token]:
                self.ends[token] = None
            else:
                right, left = [], []
                for side, chain in ((1, right), (0, left)):
                    part, until = token, 1 << 30
                    chain.append((part, until))
                    while len(part) > 1:
                        pair = self.parts[part]
                        part, until = pair[side], self.ranks[pair]
                        chain.append((part, until))
                self.ends[token] = right, left
        return self.ends[token]

    def stay_apart(self, a: bytes, b: bytes) -> bool:
        """Whether no merge ever crosses from a to b: one would, when both its parts stand at the edges before either is taken in.

        A merge of the same rank further left goes first, so the left part must be there longer.
        """
        ranks = self.ranks
        return not any(
            (rank := ranks.get((x, y))) is not None and rank < x_until and rank <= y_until
            for x, x_until in self.edges(a)[0] for y, y_until in self.edges(b)[1]
        )

    def meet(self, node: int) -> dict[int, bool] | bool:
        """The answers known for the token of a node met for the first time; False if the merges never make it."""
        self.apart[node] = {} if self.edges(self.spelled[node]) else False
        return self.apart[node]

    def learn(self, before: int, node: int) -> bool:
        """Whether the tokens of two nodes stay apart, kept for the next time up to a bound."""
        if self.known > 1 << 20:
            for answers in self.apart:
                if answers:
                    answers.clear()
            self.known = 0
        self.known += 1
        fits = self.apart[node][before] = self.stay_apart(self.spelled[before], self.spelled[node])
        return fits

    def prefix_counts(self, piece: bytes) -> list[int]:
        """Tokens of piece[:i] for i from 0 to its length, by dynamic programming.

        Encodings are exactly the token sequences whose neighbours all stay
        apart, and each prefix has one. So of the tokens ending at i, one fits
        the last token of the prefix before it, and the count is one more.
        """
        counts, last = [0], [0]
        step, apart = self.steps.get, self.apart
        for end in range(1, len(piece) + 1):
            node, at = 0, end
            while at:
                at -= 1
                node = step(node << 8 | piece[at])
                if node is None:
                    break
                answers = apart[node]
                if answers is False:
                    continue
                if answers is None and self.meet(node) is False:
                    continue
                if not at:
                    break
                fits = apart[node].get(last[at])
                if fits or fits is None and self.learn(last[at], node):
                    break
            else:
                node = None
            if node is None:
                raise ValueError(f"no token of the vocabulary ends at byte {end} of {piece[:40]!r}")
            counts.append(counts[at] + 1)
            last.append(node)
        return counts


class Counter(dict):
    """Piece of text -> its counts at each of its code points, as packed 32-bit numbers; short ones are kept."""

    # Endings that the pattern takes in one piece when they are complete, and not before.
    CLITICS = ("'re", "'ve", "'ll")

    def __init__(self, path: str):
        import public_tokenizers
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError(f"{path} is no byte-level merge vocabulary with the usual pattern")
        self.merges = Merges(spec["model"])
        self.special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.pieces = regex.compile(public_tokenizers.PATTERN)
        self.gaps = regex.compile(r"\s\s+(?=\S)")
        self.marks = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def __missing__(self, piece: str) -> bytes:
        raw = piece.encode()
        counts = self.merges.prefix_counts(raw)[1:]
        if len(raw) > len(piece):  # counts where a code point ends
            counts = [c for c, after in zip(counts, raw[1:] + b"a", strict=True) if after & 0xC0 != 0x80]
        if piece in self.CLITICS:
            counts[1] = 2  # the quote and a letter are two pieces until the clitic is complete
        packed = array("I", counts).tobytes()
        if len(piece) <= SHORT:
            if len(self) >= CACHED:
                self.clear()
            self[piece] = packed
        return packed

    def split(self, text: str) -> Iterator[list[str]]:
        """The pieces that the pattern finds, some at a time."""
        if len(text) <= STEP:
            yield self.pieces.findall(text)
            return
        found = self.pieces.finditer(text)
        while pieces := [m.group() for m in islice(found, STEP)]:
            yield pieces

    def plain(self, text: str) -> np.ndarray:
        """Tokens of text[:i], i from 1 to its length, for a text without special strings."""
        out, done = [], 0
        for pieces in self.split(text):
            if not pieces:
                continue
            packed = [self[p] for p in pieces]
            sizes = np.fromiter(map(len, packed), np.int64, len(packed)) >> 2
            inside = np.frombuffer(b"".join(packed), np.uint32).astype(np.int64)
            last = inside[np.cumsum(sizes) - 1]
            before = done + np.cumsum(last) - last
            out.append(inside + np.repeat(before, sizes))
            done += int(last.sum())
        counts = np.concatenate(out) if out else np.zeros(0, np.int64)
        # A run of white space is one piece while nothing follows it; the next word then takes its last sign.
        for m in self.gaps.finditer(text):
            alone = int(np.frombuffer(self[m.group()], np.uint32)[-1])
            counts[m.end() - 1] = alone + (counts[m.start() - 1] if m.start() else 0)
        return counts

    def counts(self, text: str) -> np.ndarray:
        """Tokens of text[:i], i from 1 to its length. A complete special string is one token, an incomplete one is text."""
        marks = [m.span() for m in self.marks.finditer(text)] if self.marks and self.special[-1][0] in text else []
        out, at, before = [], 0, 0
        for start, end in marks:
            part = self.plain(text[at : end - 1]) + before
            before = (int(part[start - at - 1]) if start > at else before) + 1
            out += [part, np.array([before])]
            at = end
        out.append(self.plain(text[at:]) + before)
        return np.concatenate(out) if len(out) > 1 else out[0]


@functools.lru_cache(maxsize=4)
def counter(path: str) -> Counter:
    """One vocabulary per worker process."""
    return Counter(path)


def fitting(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens; longer prefixes may again have fewer."""
    fits = np.flatnonzero(counts <= limit)
    return int(fits[-1]) + 1 if len(fits) else 0


def _table(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))


def count_tokens(docs: DataFrame, limit: int, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_chars, n_tokens of the whole text, and fit_chars.

    fit_chars is the length in code points of the longest prefix with at most
    ``limit`` tokens. Both are read from the counts at all prefixes. A null
    text is empty: no bytes, no tokens. Ids may be null or repeated, each row
    is counted on its own; columns other than the two named are not read. A
    text is worked through in steps of 65,536 pieces; its counts take 8 bytes
    a code point meanwhile.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in slices(batches, 512):
            rows = []
            for text in batch.column(1):
                text = text.as_py()
                counts = known.counts(text)
                n = int(counts[-1]) if len(counts) else 0
                rows.append((len(text), n, len(text) if n <= limit else fitting(counts, limit)))
            columns = [pa.array(c, pa.int64()) for c in (zip(*rows, strict=True) if rows else ([], [], []))]
            n_bytes = pa.compute.binary_length(batch.column(1)).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), n_bytes, *columns], ["_id", "n_bytes", "n_chars", "n_tokens", "fit_chars"])

    table = _table(docs, id_col, text_col)
    longs = [T.StructField(c, T.LongType()) for c in ("n_bytes", "n_chars", "n_tokens", "fit_chars")]
    return table.mapInArrow(run, T.StructType([table.schema["_id"], *longs])).withColumnRenamed("_id", id_col)


BLOCK = 1024  # stored prefixes between two anchors


def prefix_table(docs: DataFrame, vocabulary: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The counts at every prefix, stored: id, n_chars, n_tokens, anchors (array of long), steps (binary).

    ``anchors`` has the count before every 1024th prefix, ``steps`` the change
    from prefix to prefix in 16 bits (a change is no larger than the longest
    token). Null texts are empty, with no anchors and no steps.
    """
    path = vocabulary or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counter(path)
        for batch in slices(batches, 256):
            all_counts = [known.counts(t.as_py()) for t in batch.column(1)]
            steps = [np.diff(c, prepend=0).astype("<i2").tobytes() for c in all_counts]
            anchors = [np.concatenate([[0], c[BLOCK - 1 : len(c) - 1 : BLOCK]]).astype(np.int64) if len(c) else c for c in all_counts]
            n = [len(c) for c in all_counts]
            total = [int(c[-1]) if len(c) else 0 for c in all_counts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(total, pa.int64()), pa.array(anchors, pa.list_(pa.int64())), pa.array(steps, pa.binary())],
                ["_id", "n_chars", "n_tokens", "anchors", "steps"],
            )

    table = _table(docs, id_col, text_col)
    fields = [table.schema["_id"], T.StructField("n_chars", T.LongType()), T.StructField("n_tokens", T.LongType())]
    fields += [T.StructField("anchors", T.ArrayType(T.LongType())), T.StructField("steps", T.BinaryType())]
    return table.mapInArrow(run, T.StructType(fields)).withColumnRenamed("_id", id_col)


def answer(stored: DataFrame, lengths: tuple[int, ...] = (), limits: tuple[int, ...] = (), id_col: str = "doc_id") -> DataFrame:
    """Questions to a stored prefix table, without texts or vocabulary.

    Adds ``at_<n>`` for each of ``lengths``, the tokens of the first n code
    points (of all, if fewer), and ``fit_<n>`` for each of ``limits``, the code
    points of the longest prefix of at most n tokens. A length reads one block
    of steps.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list[int]] = [[] for _ in (*lengths, *limits)]
            for n, anchors, steps in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
                moves = np.frombuffer(steps, "<i2")
                for k, length in enumerate(lengths):
                    upto = min(length, n)
                    block = max(0, upto - 1) // BLOCK
                    found[k].append(int(anchors[block] + moves[block * BLOCK : upto].sum(dtype=np.int64)) if upto > 0 else 0)
                if limits:
                    counts = np.cumsum(moves, dtype=np.int64)
                    for k, limit in enumerate(limits, len(lengths)):
                        found[k].append(fitting(counts, limit))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in found]], [id_col, *names])

    names = [*[f"at_{n}" for n in lengths], *[f"fit_{n}" for n in limits]]
    schema = T.StructType([stored.schema[id_col], *[T.StructField(c, T.LongType()) for c in names]])
    return stored.select(id_col, "n_chars", "anchors", "steps").mapInArrow(run, schema)


def budget(counted: DataFrame, tokens: int, id_col: str = "doc_id") -> DataFrame:
    """The documents that a budget of ``tokens`` pays for, in hash order: id, n_tokens, taken (tokens of it within the budget).

    Sums run over hash ranges of about a thousand rows first and then within
    them, so no task holds more than a range. Rows that get nothing are left
    out; nulls in n_tokens count 0.
    """
    from pyspark.sql import Window

    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    rows = counted.select(F.col(id_col), F.coalesce("n_tokens", F.lit(0)).alias("n_tokens"), key.alias("_key"))
    ranges = min(65_536, 1 + rows.count() // 1000)
    rows = rows.withColumn("_range", F.floor(F.conv(F.substring("_key", 1, 7), 16, 10).cast("long") * ranges / (1 << 28)))
    sums = rows.groupBy("_range").agg(F.sum("n_tokens").alias("_sum"))
    sums = sums.select("_range", (F.sum("_sum").over(Window.orderBy("_range")) - F.col("_sum")).alias("_before"))  # at most 65,536 rows
    inside = Window.partitionBy("_range").orderBy("_key", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.join(sums, "_range").withColumn("_before", F.col("_before") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
    taken = F.greatest(F.lit(0), F.least("n_tokens", F.lit(tokens) - F.col("_before"))).cast("long")
    return rows.select(id_col, "n_tokens", taken.alias("taken")).where("taken > 0")
