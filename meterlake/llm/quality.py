"""Quality classifier: naive-Bayes-scaled n-gram indicators under a linear support vector machine."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm.common import U64, mixed, slices, staged

BITS = 18
TOKENS = re.compile(r"\w+|[^\w\s]+")
MEMO = 300_000


def shape(token: str) -> str:
    """Letters become a or A, digits 9, repeated classes one; other characters stay."""
    classes = ("a" if c.islower() else "A" if c.isupper() else "9" if c.isdigit() else "x" if c.isalpha() else c for c in token[:24])
    out = ""
    for c in classes:
        out += c if out[-1:] != c else ""
    return out


class Features:
    """Hashed indicators: words, pairs of words, pairs of word shapes. Equal neighbours have a shape of their own."""

    def __init__(self) -> None:
        self.memo: dict[str, tuple[int, int]] = {}

    def of(self, text: str | None) -> np.ndarray:
        tokens = TOKENS.findall(text) if text else []
        if not tokens:
            return np.zeros(0, np.int32)
        if len(self.memo) > MEMO:
            self.memo.clear()
        get, pairs = self.memo.get, []
        for t in tokens:
            pair = get(t)
            if pair is None:
                pair = self.memo[t] = (xxhash.xxh64_intdigest(t.lower()), xxhash.xxh64_intdigest(shape(t), 1))
            pairs.append(pair)
        both = np.array(pairs, np.uint64)
        word, form = both[:, 0], both[:, 1].copy()
        form[1:][word[1:] == word[:-1]] = U64(7)
        found = np.concatenate([word, mixed(word[:-1] * U64(3) + word[1:]), mixed(form[:-1] * U64(5) + form[1:])])
        return np.unique(mixed(found) >> U64(64 - BITS)).astype(np.int32)


def log_count_ratios(rows: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each indicator among label 1 over that among the rest."""
    share = []
    for label in (1, -1):
        own = [r for r, t in zip(rows, y, strict=True) if t == label]
        n = 1.0 + np.bincount(np.concatenate([np.zeros(0, np.int32), *own]), minlength=1 << BITS)
        share.append(n / n.sum())
    return np.log(share[0] / share[1])


def dual_coordinate_descent(rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, c: float, epochs: int, seed: int = 1) -> tuple[np.ndarray, float]:
    """Hinge-loss support vector machine, L2-regularised; classes weigh the same. Weights and bias (a constant feature)."""
    w, bias = np.zeros(1 << BITS), 0.0
    n = np.array([max(1, (y == t).sum()) for t in (1, -1)])
    upper = np.where(y == 1, c * len(y) / (2 * n[0]), c * len(y) / (2 * n[1]))
    norms = np.array([float(v @ v) + 1 for v in values])
    alpha = np.zeros(len(y))
    random = np.random.default_rng(seed)
    for _ in range(epochs):
        moved = 0.0
        for i in random.permutation(len(y)):
            r, v = rows[i], values[i]
            gradient = y[i] * (w[r] @ v + bias) - 1
            new = min(max(alpha[i] - gradient / norms[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[r] += step * v
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w, bias


def unit(v: np.ndarray) -> np.ndarray:
    return v / max(float(np.sqrt(v @ v)), 1e-12)


def sigmoid(margins: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve from margins to the share of label 1, by Newton steps with smoothed targets."""
    pos, neg = (y == 1).sum(), (y == -1).sum()
    t = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([margins, np.ones_like(margins)], axis=1)
    b = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (p - t) + 1e-3 * b
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, g)
        b -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return max(float(b[0]), 1e-6), float(b[1])


def fit(rows: list[np.ndarray], labels: np.ndarray, c: float = 1.0, epochs: int = 20) -> dict:
    """The model from indicators and labels 0/1; a single class gives a constant score."""
    y = np.where(labels == 1, 1, -1)
    if len(y) == 0 or abs(y.sum()) == len(y):
        p = 0.5 if len(y) == 0 else (len(y) + 1) / (len(y) + 2) if y[0] == 1 else 1 / (len(y) + 2)
        return {"weights": np.zeros(1 << BITS, np.float32), "ratios": np.ones(1 << BITS, np.float32), "bias": 0.0, "slope": 1.0, "offset": float(np.log(p / (1 - p)))}

    def margin_of(part: np.ndarray):
        own, t = [rows[i] for i in part], y[part]
        ratios = log_count_ratios(own, t)
        w, bias = dual_coordinate_descent(own, [unit(ratios[r]) for r in own], t, c, epochs)
        return ratios, w, bias

    margins = np.zeros(len(y))
    halves = np.arange(len(y)) % 2
    for half in (0, 1):  # margins of rows the fit has not seen
        ratios, w, bias = margin_of(np.flatnonzero(halves != half))
        for i in np.flatnonzero(halves == half):
            margins[i] = w[rows[i]] @ unit(ratios[rows[i]]) + bias if len(rows[i]) else bias
    slope, offset = sigmoid(margins, y)
    ratios, w, bias = margin_of(np.arange(len(y)))
    return {"weights": w.astype(np.float32), "ratios": ratios.astype(np.float32), "bias": bias, "slope": slope, "offset": offset}


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = 6000, sample_bytes: int = 256 << 20, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict:
    """A model from the labelled documents.

    ``sample_rows`` bounds the rows the fit sees (it runs on the driver): with
    more labels, those whose hashed id falls under the fitting share are used;
    of these, in hash order, as many as have ``sample_bytes`` of indicators.
    Null labels teach nothing; of repeated labels of a document the larger counts.
    """
    known = labels.where(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max(label_col).cast("int").alias("_label"))
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64(F.col(id_col).cast("string")), F.lit(1 << 20)) < (1 << 20) * sample_rows // n)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = Features()
        for batch in slices(batches):
            packed = [made.of(t).tobytes() for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(id_col), batch.column("_label"), pa.array(packed, pa.binary())], [id_col, "_label", "_features"])

    rows = docs.select(id_col, F.col(text_col).alias("_text")).join(known, id_col)
    schema = T.StructType([rows.schema[id_col], T.StructField("_label", T.IntegerType()), T.StructField("_features", T.BinaryType())])
    made = staged(rows.mapInArrow(features, schema), "features")
    order = Window.orderBy(F.xxhash64(F.col(id_col).cast("string")), F.xxhash64("_features"))  # over at most about sample_rows sizes
    sizes = made.select(id_col, "_label", F.xxhash64("_features").alias("_h"), F.sum(F.length("_features")).over(order).alias("_upto"))
    within = sizes.where(F.col("_upto") <= sample_bytes).select(F.col(id_col).alias("_kid"), F.col("_h").alias("_kh")).distinct()
    fits = made[id_col].eqNullSafe(within["_kid"]) & (F.xxhash64(made["_features"]) == within["_kh"])
    got = made.join(within, fits, "left_semi").collect()  # at most sample_bytes, but for rows that are repeated
    got = sorted(got, key=lambda r: (str(r[id_col]), bytes(r["_features"])))
    return fit([np.frombuffer(r["_features"], np.int32) for r in got], np.array([r["_label"] for r in got], np.int32))


def score(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, score (0 to 1, the estimated chance of label 1).

    Whole texts are read; null and empty ones, without indicators, get the
    score of the bias. Further columns are not read.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, made = sent.value, Features()
        weights, ratios = m["weights"].astype(np.float64), m["ratios"].astype(np.float64)
        for batch in slices(batches):
            margins = np.zeros(batch.num_rows)
            for i, text in enumerate(batch.column(1).to_pylist()):
                r = made.of(text)
                margins[i] = m["bias"] + (weights[r] @ unit(ratios[r]) if len(r) else 0.0)
            p = 1 / (1 + np.exp(-np.clip(m["slope"] * margins + m["offset"], -30, 30)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(p, pa.float64())], [id_col, "score"])

    schema = T.StructType([docs.select(id_col).schema[0], T.StructField("score", T.DoubleType())])
    return docs.select(id_col, text_col).mapInArrow(predict, schema)
