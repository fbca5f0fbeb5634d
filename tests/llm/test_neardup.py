import itertools
import math
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from meterlake.llm import common
from meterlake.llm import components as C
from meterlake.llm import neardup as N


def brute(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        sets[i] = {tuple(w[j : j + width]) for j in range(max(1, len(w) - width + 1))} if w else set()
    low = {i: i for i in sets}
    ids = sorted(sets)
    links = [(a, b) for a in ids for b in ids if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    for _ in ids:
        for a, b in links:
            low[a] = low[b] = min(low[a], low[b])
    return {i: (len(sets[i]), low[i]) for i in ids}


def edited(text, n, rng):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.mark.parametrize("width,percent,small", [(3, 85, 64), (5, 80, 64), (3, 85, 4)])
def test_equals_brute_force(docs, prose, width, percent, small):
    """Chains of edits, copies, short texts, a shared passage; long lists through the blocks (small=4)."""
    rng = random.Random(width)
    texts = [None, "", " \t\n", "a", "a", "a b", "A  b", "a b c d e f g", "a b c d e f h"]
    base = prose(1, 120)
    texts += [base, base, base.upper()] + [edited(base, n, rng) for n in range(1, 9) for _ in range(5)]
    chain = prose(2, 200)
    for _ in range(8):
        texts.append(chain)
        chain = edited(chain, 3, rng)
    passage = prose(3, 15)
    texts += [passage + " " + prose(s, 20 + s) for s in range(10, 40)]
    texts += [prose(99, 20000), edited(prose(99, 20000), 200, rng)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    got = N.near_duplicates(docs(rows), width=width, percent=percent, small=small, block=7)
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()}
    assert found == brute(rows, width, percent)


@pytest.mark.parametrize("percent,largest", [(80, 13), (85, 13), (70, 11), (50, 9)])
def test_linked_small_sets_share_a_key(percent, largest):
    """Every way to deal a small union out to two sets."""
    small = N.small_sizes(percent, 40)
    hashes = np.sort(np.random.default_rng(1).integers(0, 2**64, largest, np.uint64))
    for u in range(1, largest + 1):
        for d in range(1, u * (100 - percent) // 100 + 1):
            for lone in itertools.combinations(range(u), d):
                for owners in itertools.product("ab", repeat=d):
                    lacks = dict(zip(lone, owners))
                    sets = [hashes[[i for i in range(u) if lacks.get(i, own) == own]] for own in "ab"]
                    a, b = (set(N.keys_of(s, percent, 40, small).tolist()) for s in sets)
                    assert a & b, (u, lacks)


def test_small_sizes():
    assert list(N.small_sizes(80, 40)) == [4, 5]
    assert not N.small_sizes(85, 32)


def test_short_texts_equal_brute_force(docs):
    """Texts of 9 words, and the 8 first or last of them; all short texts in one long list, too."""
    rows = []
    for i in range(0, 60, 3):
        words = [f"w{i}x{j}" for j in range(9)]
        rows += [(i, " ".join(words)), (i + 1, " ".join(words[:8])), (i + 2, " ".join(words[1:]))]
    rows += [(100 + i, "one two three four five six seven eight " + (f"nine{i}" if i else "")) for i in range(30)]
    for small in (64, 4):
        got = N.near_duplicates(docs(rows), width=5, percent=80, small=small, block=7)
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got.collect()} == brute(rows, 5, 80)


def test_nulls_repeats_and_empty(docs):
    assert N.near_duplicates(docs([])).collect() == []
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in N.near_duplicates(docs([(None, "a b"), (3, "a b"), (3, "a b"), (5, "A b")])).collect())
    assert got == [("3", "3", True), ("3", "3", True), ("5", "3", False), ("None", "None", True)]


def test_components_of_paths_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(1, 300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(2000 + i * 7 % 50, 2000 + (i + 1) * 7 % 50) for i in range(50)] + [(5, 5)]
    got = {r["node"]: r["component"] for r in C.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 301)} | {i: 1000 for i in range(1000, 1200)} | {2000 + i: 2000 for i in range(50)}


def test_values_in_keys_follow_the_threshold():
    assert N.missed(0.85, N.enough_values(0.85, 1e-6)) < 1e-6
    assert N.enough_values(0.8, 1e-6) > N.enough_values(0.85, 1e-6)


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_both_filters_together_stay_below_the_chance(similarity):
    values = N.enough_values(similarity, 1e-6)
    least = N.least_shared(similarity, 64, 1e-6 - N.missed(similarity, values))
    fewer = lambda n: sum(math.comb(64, i) * similarity**i * (1 - similarity) ** (64 - i) for i in range(n))
    assert N.missed(similarity, values) + fewer(least) < 1e-6 <= N.missed(similarity, values) + fewer(least + 1)
    assert fewer(math.ceil(64 * similarity - 5 * (64 * similarity * (1 - similarity)) ** 0.5)) > 1e-6  # five deviations are too few


def plans_since(spark, last):
    runs = spark._jsparkSession.sharedState().statusStore().executionsList()
    found = [runs.apply(i) for i in range(runs.size())]
    return [r.physicalPlanDescription() for r in found if r.executionId() > last], max((r.executionId() for r in found), default=-1)


def test_large_tables_are_not_broadcast(spark):
    """150,000 links are 2 MB as a file, under Spark's 10 MB, and 300,000 rows on the driver."""
    ids = np.random.default_rng(5).choice(2**60, (150_000, 2))
    links = common.staged(spark.createDataFrame(pd.DataFrame(ids, columns=["a", "b"])), "links")
    _, last = plans_since(spark, -1)
    found = C.components(links)
    plans, _ = plans_since(spark, last)
    assert plans and not any("BroadcastExchange" in p for p in plans)
    assert found.count() == 300_000 and found.agg(F.sum((F.col("node") == F.col("component")).cast("int"))).first()[0] == 150_000
    few = spark.range(10).withColumnRenamed("id", "node")
    for side, sent in ((found.select("node"), False), (found.where("node < 0").select("node"), True)):
        assert ("Broadcast" in few.join(common.beside(side), "node", "left_anti")._jdf.queryExecution().executedPlan().toString()) == sent


@pytest.mark.parametrize("own,inside", [("10m", common.BROADCAST_BYTES), ("10485760b", common.BROADCAST_BYTES), ("64k", "64k"), ("-1", "-1")])
def test_the_driver_gets_no_large_side(spark, docs, monkeypatch, own, inside):
    key, seen, staged = common.BROADCASTS[0], set(), N.staged
    usual = spark.conf.get(key)
    monkeypatch.setattr(N, "staged", lambda df, name: (seen.add(spark.conf.get(key)), staged(df, name))[1])
    spark.conf.set(key, own)
    try:
        out = N.near_duplicates(docs([(1, "a b"), (2, "a b"), (3, "c d")]))
        assert seen == {str(inside)} and spark.conf.get(key) == own
        assert {r["doc_id"]: r["kept"] for r in out.collect()} == {1: True, 2: False, 3: True}
        with pytest.raises(ValueError):
            common.narrow_broadcasts(lambda df: int("x"))(out)
        assert spark.conf.get(key) == own
    finally:
        spark.conf.set(key, usual)


def test_a_limit_that_was_not_set_is_not_set_after(spark):
    own = spark.newSession().range(2)
    inside = [common.narrow_broadcasts(lambda df: df.sparkSession.conf.get(k, None))(own) for k in common.BROADCASTS]
    assert inside == [str(common.BROADCAST_BYTES), None] and [own.sparkSession.conf.get(k, None) for k in common.BROADCASTS] == [None, None]
