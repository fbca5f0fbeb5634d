import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)


@pytest.fixture()
def docs(spark):
    """A documents table from (id, text) or (id, text, source) rows, with a column that a careless operator could clash with."""

    def make(rows, lang="en"):
        full = [(r[0], r[1], lang, r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS).selectExpr("*", "'x' AS _id", "1 AS _text", "2 AS row", "3 AS size", "4 AS score")

    return make


@pytest.fixture()
def prose():
    """Words of a small vocabulary, so that shingles and strings repeat by chance."""

    def make(seed, n, vocabulary=400):
        rng = random.Random(seed)
        return " ".join("".join(rng.choice(["ka", "to", "mi", "re", "su", "lo", "ne"]) for _ in range(1 + rng.randrange(vocabulary) % 4)) for _ in range(n))

    return make
