"""Language identification: known words first, then ever shorter character n-grams."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import mapped, slices, staged

UNKNOWN = "und"
LETTERS = re.compile(r"[^\W\d_]+")
LONGEST = 4  # of the n-grams

COUNTS = T.StructType(
    [
        T.StructField("lang", T.StringType()),
        T.StructField("order", T.IntegerType()),  # 0: word, else the n of an n-gram
        T.StructField("gram", T.StringType()),
        T.StructField("n", T.LongType()),
    ]
)


def words_of(text: str | None) -> list[str]:
    """Runs of letters, lower-cased; none if the text has no letter."""
    if not text or not (re.search("[A-Za-z]", text) or any(c.isalpha() for c in text)):
        return []
    return LETTERS.findall(text.lower())


def grams(word: str, n: int) -> list[str]:
    """n-grams of the word between two boundary marks, which are no 1-grams of their own."""
    marked = f"_{word}_" if n > 1 else word
    return [marked[i : i + n] for i in range(len(marked) - n + 1)]


def counts(examples: DataFrame) -> DataFrame:
    """Occurrences of words and n-grams by language; combined within each task before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen.setdefault(lang, Counter()).update(words_of(text))
            rows: Counter = Counter()
            for lang, words in seen.items():
                for word, k in words.items():
                    rows[lang, 0, word] += k
                    for n in range(1, LONGEST + 1):
                        for gram in grams(word, n):
                            rows[lang, n, gram] += k
            keys = list(rows)
            columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.string(), pa.int32(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(rows.values()), pa.int64())], COUNTS.names)

    return mapped(examples, count, COUNTS).groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))


def train(
    docs: DataFrame,
    sample_rows: int = 5000,
    entries: int = 150_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> dict | None:
    """Per-language log frequencies of words and n-grams from the labelled rows; None if there are none.

    ``sample_rows`` bounds the rows that are learned from: with more, those
    whose hashed id falls under the fitting share are used, whole texts.
    ``entries`` bounds the model whatever the counts are: so many of the most
    frequent words and n-grams stay, of equally frequent ones the first by
    order and code point, each with a number for every language.
    """
    known = docs.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull())
    rows = known.count()
    if not rows:
        return None
    share = F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20))
    if rows > sample_rows:
        known = known.where(share < (1 << 20) * sample_rows // rows)
    table = staged(counts(known.select(F.col(text_col), F.col(lang_col).cast("string"))), "grams")
    by_gram = table.groupBy("order", "gram").agg(F.sum("n").alias("total"))
    most = by_gram.orderBy(F.desc("total"), "order", "gram").limit(entries).select("order", "gram")
    kept = table.join(most, ["order", "gram"]).select("lang", "order", "gram", "n").collect()
    sums = {(r["lang"], r["order"]): r["s"] for r in table.groupBy("lang", "order").agg(F.sum("n").alias("s")).collect()}
    return fitted(kept, sums)


def fitted(kept: list, sums: dict) -> dict:
    """Log frequencies: ``index`` by order and gram into the rows of ``logs``, a column for each language."""
    langs = sorted({lang for lang, _ in sums})
    index: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    size = 0
    for _, order, gram, _ in kept:
        if gram not in index[order]:
            index[order][gram] = size
            size += 1
    logs = np.empty((size, len(langs)), np.float32)
    kinds = [len(i) + 1 for i in index]
    for order, grams_of in enumerate(index):
        rows = list(grams_of.values())
        for j, lang in enumerate(langs):
            logs[rows, j] = math.log(0.5 / (sums.get((lang, order), 0) + 0.5 * kinds[order]))
    at = {lang: j for j, lang in enumerate(langs)}
    for lang, order, gram, n in kept:
        logs[index[order][gram], at[lang]] = math.log((n + 0.5) / (sums[lang, order] + 0.5 * kinds[order]))
    return {"langs": langs, "index": index, "logs": logs}


class Scorer:
    """Sums of log frequencies; rows for words that are not in the model are made once and kept up to a bound."""

    STEP = 50_000

    def __init__(self, model: dict, memo: int = 200_000):
        self.langs, self.index = model["langs"], model["index"]
        self.fixed = len(model["logs"])
        self.logs = np.zeros((self.fixed + memo, len(self.langs)), np.float32)
        self.logs[: self.fixed] = model["logs"]
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = dict(self.index[0])
        self.end = self.fixed

    def row(self, word: str) -> int:
        self.logs[self.end] = self.backoff(word)
        self.rows[word] = self.end
        self.end += 1
        return self.end - 1

    def backoff(self, word: str) -> np.ndarray | float:
        """Mean over the known n-grams of the greatest length that has any."""
        for n in range(LONGEST, 0, -1):
            table = self.index[n]
            found = [table[g] for g in grams(word, n) if g in table]
            if found:
                return self.logs[found].mean(axis=0)
        return 0.0

    def predict(self, text: str | None, strict: bool = False) -> tuple[str, float]:
        """The likeliest language and its posterior under equal priors; ``und`` and 0 without letters, if ``strict`` also without a known n-gram."""
        words = words_of(text)
        if not words:
            return UNKNOWN, 0.0
        total = np.zeros(len(self.langs))
        for at in range(0, len(words), self.STEP):
            if self.end + self.STEP > len(self.logs):
                self.forget()
            get, row, ids = self.rows.get, self.row, []
            for w in words[at : at + self.STEP]:
                i = get(w)
                ids.append(row(w) if i is None else i)
            total += self.logs[ids].sum(axis=0, dtype=np.float64)
        if strict and not total.any():  # log frequencies are below 0
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.langs[best], float(1 / np.exp(total - total[best]).sum())


def identify(
    docs: DataFrame, model: dict | None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (), strict: bool = False
) -> DataFrame:
    """One row per row of ``docs``: the id, lang_pred, score, and with ``keep`` a struct ``kept`` of those columns.

    Every word of the whole text adds its log frequencies; a word the model
    does not know adds the mean of its longest known n-grams. ``score`` is the
    posterior of the chosen language. Null texts, texts without a letter, and
    all texts when there was nothing to learn from: ``und``, 0. Ties go to the
    first language by code point; so does a text of whose words the model knows
    no n-gram (another script), which with ``strict`` is ``und``, 0.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    # What is kept stays apart from the results, whatever its names are; the text travels once.
    beside = [c for c in dict.fromkeys(keep) if c not in (id_col, text_col)]
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(beside)])
    passed = [c for c in rows.columns if c != "_text" or text_col in keep]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(sent.value) if sent.value else None
        for batch in slices(batches):
            found = [scorer.predict(t, strict) if scorer else (UNKNOWN, 0.0) for t in batch.column(1).to_pylist()]
            out = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in passed], *out], schema.names)

    schema = T.StructType([*[rows.schema[c] for c in passed], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    told = mapped(rows, predict, schema)
    place = {text_col: "_text", id_col: "_id", **{c: f"_keep{i}" for i, c in enumerate(beside)}}
    kept = [F.struct(*[F.col(place[c]).alias(c) for c in dict.fromkeys(keep)]).alias("kept")] if keep else []
    return told.select(F.col("_id").alias(id_col), *kept, "lang_pred", "score")


def held_out(id_col: str, folds: int, fold: int):
    """Whether the checksum of the id, as text, falls into the fold; a null id never does."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))
