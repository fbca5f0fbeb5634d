import random

import pytest

from meterlake.llm import mixing as M


def water(sizes, weights=(3, 1, 2), share=1.5, repeats=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, capped = share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        level = (budget - sum(repeats * sizes[s] for s in capped)) / sum(w[s] for s in free) if free else 0
        more = {s for s in free if level * w[s] > repeats * sizes[s]}
        if not more:
            return {s: min(level * w[s], repeats * sizes[s]) if s not in capped else repeats * sizes[s] for s in names}
        capped |= more


@pytest.mark.parametrize("range_rows", [1000, 3])
def test_targets_and_budgets(docs, range_rows):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randrange(30)), rng.choice(["a", "b", "b", "b", "b", "Z", None, "ä", "e"])) for i in range(300)]
    rows += [(400, None, "a"), (401, "", "empty"), (7, "x y", "b"), (None, "x y z", None), (None, "x y z", None), (402, "v " * 5000, "a")]
    got = M.mix(docs(rows), range_rows=range_rows).collect()
    assert len(got) == len(rows)
    sizes = {}
    for _, text, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
    targets = water(sizes)
    for s, total in sizes.items():
        own = [r for r in got if r["source"] == s]
        assert {r["source_size"] for r in own} == {total}
        assert all(r["target"] == pytest.approx(targets[s]) and 0 <= r["taken"] <= 2 * r["size"] for r in own)
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    again = M.mix(docs(rows[::-1]).repartition(5), range_rows=7).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_empty_and_wordless(docs):
    assert M.mix(docs([])).collect() == []
    assert [(r["taken"], r["target"]) for r in M.mix(docs([(1, None), (2, " ")])).collect()] == [(0, 0.0)] * 2
