"""The trie against one built in memory, list ranks against a walk."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.llm import prefixes as P
from meterlake.llm.listrank import ranked

TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows, splice):
    told = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            told.setdefault(c, []).append((turn is not None, turn or 0, hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest(), role, text))
    told = {c: [t[3:] for t in sorted(turns)] for c, turns in told.items()}
    if splice:
        told = {c: told.get(c - c % 5, [])[: (h := zlib.crc32(str(c).encode()) % 9)] + turns[h:] for c, turns in told.items()}
    nodes = {}
    for c, turns in told.items():
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        leaves = [k for k in below if not any(o[:-1] == k and o for o in nodes)]
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(map(str, sorted(c for c in members if len(told[c]) == len(key))))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), sum(1 for k in nodes if k and k[:-1] == key), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def built(spark, rows, splice=False, **how):
    table = spark.createDataFrame(rows, TURNS).selectExpr("*", "0 AS conv", "1 AS pos", "'x' AS id", "2 AS digest")
    turns = P.staged(P.ordered_turns(table), "t")
    if splice:
        heads = turns.select("conv").distinct().selectExpr("conv", "conv - conv % 5 AS donor", "crc32(CAST(conv AS STRING)) % 9 AS h")
        turns, lengths = P.spliced(turns, heads, longest=8)
    else:
        lengths = turns.groupBy("conv").agg(F.max("pos").alias("length"))
    out = P.trie(turns, lengths, **how)
    assert out.columns == NAMES
    return sorted((tuple(r) for r in out.collect()), key=str)


def talk(seed, n, turns=6, words=("a", "b", "ä")):
    rng = random.Random(seed)
    return [(c, t, rng.choice(["user", "bot"]), rng.choice(words)) for c in range(n) for t in range(rng.randrange(1, turns))]


@pytest.mark.parametrize("splice", [False, True])
def test_equals_trie_in_memory(spark, splice):
    rows = talk(1, 40, turns=11)
    assert built(spark, rows, splice, every=4, bound=8) == plain(rows, splice)


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, 0, "u", "x"), (1, 0, "u", "x"), (1, 0, "u", "w"), (2, None, "", ""), (2, 0, None, "x"), (None, 1, "u", "x"), (3, -5, "u", "é" * 40_000), (3, -5, "u", "é" * 40_000)]
    rows += [(10**12, t, "u", "x") for t in range(3)]
    assert built(spark, rows) == plain(rows, False)
    assert built(spark, rows, True) == plain(rows, True)
    assert built(spark, []) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    rows = [(c, 0, "u", "x") for c in (6, 7, 8, 9, 11)]  # no donor: their first turns go
    want = plain(rows, True)
    assert built(spark, rows, True) == want
    assert any(r[1] == 0 and r[2] is None and r[3] == 5 for r in want)


def test_one_conversation_and_one_parent_hold_most(spark, monkeypatch):
    monkeypatch.setattr(P, "BLOCK", 16)
    monkeypatch.setattr(P, "RUN", 8)
    monkeypatch.setattr(P, "PART", 32)
    monkeypatch.setattr(P, "PACK", 4)
    rows = [(0, t, "u", str(t % 3)) for t in range(150)] + [(c, 0, "u", f"first {c}") for c in range(1, 60)] + [(c, t, "u", "same") for c in range(100, 140) for t in range(2)]
    assert built(spark, rows, every=4, bound=16) == plain(rows, False)


@pytest.mark.parametrize("n", [1, 2, 3, 500])
def test_ranks_of_a_list(spark, n):
    names = random.Random(n).sample(range(10**6), n + 1)
    links = spark.createDataFrame(list(zip(names, names[1:], strict=False)), "a long, b long")
    got = {r.a: r.far for r in ranked(links, every=4, bound=10).collect()}
    assert got == {a: n - i for i, a in enumerate(names)}


def test_ranks_of_nothing(spark):
    assert ranked(spark.createDataFrame([], "a long, b long")).count() == 0
