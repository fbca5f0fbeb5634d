"""Secret scan: fixed patterns, and random strings by their characters per token."""

from __future__ import annotations

import base64
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import mapped, slices

VOCABULARY = os.path.join(os.environ.get("TOKENIZERS", "/opt/tokenizers"), "byte_bpe_50k.tiktoken")

# The patterns, in the order of the kinds.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")

LEAST = 20  # characters of a candidate
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{LEAST},}}")
# Known formats that look random: digests by length, UUIDs, dates and counters, and names joined from words of the vocabulary.
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})", re.IGNORECASE)
IDENTIFIER = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}|[0-9+/_=-]+", re.IGNORECASE)
NAME = re.compile(r"(?:[A-Za-z]+|[0-9]+)(?:[+/_=-]+(?:[A-Za-z]+|[0-9]+))+[+/_=-]*")
WORD = re.compile(r"[A-Za-z]+")

SPANS = T.ArrayType(
    T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
)


def ranks(path: str = VOCABULARY) -> dict[bytes, int]:
    """A tiktoken vocabulary file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoder(vocabulary: dict[bytes, int]):
    import tiktoken

    # Letters, digits and the rest apart, as the vocabulary was made.
    return tiktoken.Encoding("scan", pat_str=r"\p{L}+|\p{N}+|[^\p{L}\p{N}]+", mergeable_ranks=vocabulary, special_tokens={})


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and not overlapping within a kind."""
    found = []
    if ":" in text or "=" in text:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def known_format(run: str, encode) -> bool:
    """Whether a run is a digest, a UUID, a number, or a name whose words are all single tokens."""
    if DIGEST.fullmatch(run) or IDENTIFIER.fullmatch(run):
        return True
    return NAME.fullmatch(run) is not None and all(len(encode(w)) == 1 for w in WORD.findall(run))


def random_spans(text: str, base: list[tuple[int, int, int]], encode, ratio: float) -> list[tuple[int, int, int]]:
    """Strings of few characters per token that no known format explains, outside the spans of the fixed patterns."""
    found = []
    for m in CANDIDATE.finditer(text):
        if not any(s < m.end() and m.start() < e for s, _, e in base):
            pieces = [m.span()]
        elif known_format(m.group(), encode):
            continue
        else:
            pieces = _outside(base, *m.span())
        for start, end in pieces:
            word = text[start:end]
            if len(word) < ratio * len(encode(word)) and not known_format(word, encode):
                found.append((start, 3, end))
    return found


def _outside(base: list[tuple[int, int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """The pieces of a run between the base spans (by start) that are long enough for candidates."""
    pieces, done = [], start
    for s, _, e in base:
        if s < end and done < e:
            pieces.append((done, s))
            done = e
    return [(s, e) for s, e in [*pieces, (done, end)] if e - s >= LEAST]


def scan(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = 2.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, spans of secrets by start, then kind.

    Kinds: ``assign``, ``access`` and ``hex`` are fixed patterns. ``random``
    is the token-efficiency test: runs of 20 and more base64 characters, less
    what fixed patterns take of them, whose length is below ``ratio`` characters per token under the vocabulary at the
    path ``vocabulary`` (read by the driver, a bounded file). Digests by their
    lengths, UUIDs, numbers and names joined from words of the vocabulary are
    left out; other runs of letters are judged by the ratio like any run.

    Null and empty texts have no spans; whole texts are scanned; repeated rows
    each get their row; further columns are not read.
    """
    known = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(known.value).encode_ordinary
        for batch in slices(batches):
            out = []
            for text in batch.column(1).to_pylist():
                base = base_spans(text) if text else []
                more = random_spans(text, base, encode, ratio) if text else []
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in sorted(base + more)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, span_type)], [id_col, "spans"])

    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = T.StructType([docs.select(id_col).schema[0], T.StructField("spans", SPANS)])
    return mapped(docs.select(id_col, text_col), find, schema)


def redact(docs: DataFrame, vocabulary: str = VOCABULARY, ratio: float = 2.0, mark: str = "[SECRET]", text_col: str = "text") -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; overlapping spans are replaced once."""
    known = docs.sparkSession.sparkContext.broadcast(ranks(vocabulary))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(known.value).encode_ordinary
        for batch in slices(batches):
            at = batch.schema.get_field_index(text_col)
            texts = [_without(t, encode, ratio, mark) if t else t for t in batch.column(at).to_pylist()]
            columns = [pa.array(texts, c.type) if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names)

    return mapped(docs, clean, docs.schema)


def _without(text: str, encode, ratio: float, mark: str) -> str:
    base = base_spans(text)
    out, done = [], 0
    for start, _, end in sorted(base + random_spans(text, base, encode, ratio)):
        if start >= done:
            out += [text[done:start], mark]
        done = max(done, end)
    return "".join([*out, text[done:]]) if out else text


def joined(spans):
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
