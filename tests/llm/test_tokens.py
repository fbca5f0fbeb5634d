"""Counts at every prefix against the public library, which encodes each prefix anew."""

import random

import pytest
from pyspark.sql import functions as F

from meterlake.llm import queries as Q
from meterlake.llm import tokens as K

PARTS = [
    "a", "re", "'", "'re", "'ll", "'v", " ", "  ", "\n", "\r\n", "\t", "don't", "!", "?!", "1", "23", "é", "ß", "日本", "😀", "<|endoftext|>", "<|endof", "|>",
    "the", "ing", " the", " ", "\x1c", "​", "xxxxxx", "====", "Ã\x83Â",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(K.vocabulary_path())
    return lambda text: len(known.encode(text, add_special_tokens=False).ids)


def test_every_prefix(library):
    rng, known = random.Random(5), K.counter(K.vocabulary_path())
    for _ in range(400):
        text = "".join(rng.choice(PARTS) for _ in range(rng.randrange(1, 14)))
        assert known.counts(text).tolist() == [library(text[:i]) for i in range(1, len(text) + 1)], repr(text)


def test_merges_that_reach_back(library):
    """Runs whose encoding changes from the left with each further sign, and a piece of 20,000 signs."""
    known = K.counter(K.vocabulary_path())
    for text in ("=" * 150, "-" * 70, " " * 90, "\n" * 40, "ÃÂ" * 70, "0" * 33, "abc" * 40):
        assert known.counts(text).tolist() == [library(text[:i]) for i in range(1, len(text) + 1)]
    rng = random.Random(1)
    long = "".join(rng.choice("abcdefgh") for _ in range(20_000))
    assert known.counts(long)[-1] == library(long)


def test_steps_do_not_show(library, monkeypatch):
    monkeypatch.setattr(K, "STEP", 7)
    known, text = K.counter(K.vocabulary_path()), "It's a test,  with\n\nlines; we'll see <|endoftext|> what comes out. " * 20
    assert known.counts(text).tolist()[-40:] == [library(text[:i]) for i in range(len(text) - 39, len(text) + 1)]


def test_query_counts_whole_texts(spark, sf_dir, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()}
    got = Q.op13_tokens(spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        n = library(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), n, n > 1024)
        assert library(texts[r.doc_id][: r.chars_within_limit]) <= 1024
        assert r.chars_within_limit == len(texts[r.doc_id]) or n > 1024


def test_rows_as_they_come(docs):
    rows = [(1, None), (2, ""), (3, "a b"), (3, "a b"), (None, "c"), (4, "word " * 3000)]
    out = K.count_tokens(docs(rows).withColumn("n_tokens", F.lit("x")).withColumn("_text", F.lit(0)), limit=2)
    got = sorted(((r.doc_id or 0), r.n_bytes, r.n_chars, r.n_tokens, r.fit_chars) for r in out.collect())
    assert got == [(0, 1, 1, 1, 1), (1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (3, 3, 3, 2, 3), (3, 3, 3, 2, 3), (4, 15000, 15000, 3001, 9)]
    assert K.count_tokens(docs(rows).limit(0), limit=2).count() == 0


def test_stored_prefixes_answer(docs, library):
    text = "We'll store  the counts, then ask: how much fits? 日本 " * 90
    stored = K.prefix_table(docs([(1, text), (2, None), (3, "x")]))
    got = {r.doc_id: r for r in K.answer(stored, lengths=(0, 1, 1024, 1025, 2049, 10**6), limits=(0, 10, 700)).collect()}
    for n in (0, 1, 1024, 1025, 2049, 10**6):
        assert got[1][f"at_{n}"] == library(text[:n])
    counts = [library(text[:i]) for i in range(1, len(text) + 1)]
    for limit in (0, 10, 700):
        assert got[1][f"fit_{limit}"] == max((i for i, c in enumerate(counts, 1) if c <= limit), default=0)
    assert [got[2][c] for c in got[2].asDict() if c != "doc_id"] == [0] * 9
    assert (got[3].at_1, got[3].fit_0, got[3].fit_10) == (1, 0, 1)


def test_budget_is_spent_to_the_token(spark):
    counted = spark.range(5000).selectExpr("id AS doc_id", "id % 7 AS n_tokens").unionByName(spark.sql("SELECT NULL AS doc_id, 3L AS n_tokens UNION ALL SELECT 9, NULL"))
    out = K.budget(counted, 4000).collect()
    assert sum(r.taken for r in out) == 4000 and all(0 < r.taken <= r.n_tokens for r in out)
    assert sum(r.taken < r.n_tokens for r in out) <= 1
    assert K.budget(counted, 10**9).agg(F.sum("taken")).first()[0] == counted.agg(F.sum("n_tokens")).first()[0]
    assert K.budget(counted.limit(0), 10).count() == 0


def test_a_token_is_looked_up_by_its_last_bytes():
    """A step to the left costs one lookup, and what is known of two neighbours is kept up to a bound."""
    merges = K.Counter(K.vocabulary_path()).merges
    piece = " uncharacteristically-größer".encode()
    expected = [0, *[len(merges.encode(piece[:i])) for i in range(1, len(piece) + 1)]]
    asked, steps = [], merges.steps

    class Steps(dict):
        def get(self, key, default=None):
            asked.append(key)
            return steps.get(key, default)

    merges.steps = Steps()
    assert merges.prefix_counts(piece) == expected
    longest = max(map(len, merges.tokens))
    assert len(piece) <= len(asked) <= len(piece) * longest
    merges.known = (1 << 20) + 1
    merges.meet(steps[ord("a")])
    assert merges.learn(steps[ord("q")], steps[ord("a")]) in (True, False) and merges.known == 1
    assert merges.prefix_counts(piece) == expected
