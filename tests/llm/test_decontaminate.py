import re

import pytest

from meterlake.llm import decontaminate as D


def brute(texts, items, width=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for t in texts:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            v = words(text)
            for i in range(max(1, len(v) - width + 1) if v else 0):
                win = v[i : i + width]
                for j in range(len(w) - len(win) + 1):
                    if w[j : j + len(win)] == win:
                        hit |= set(range(j, j + len(win)))
                        found.add(str(item))
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize("block_bytes", [1 << 20, 700])
def test_equals_brute_force(spark, docs, prose, block_bytes):
    """Short items, one word, umlauts, repeats and several blocks."""
    items = [(i, prose(i, n, 9)) for i, n in enumerate([15, 12, 10, 9, 3, 2, 1])] + [(100, prose(0, 15, 9)), (7, ""), (8, None), (9, "...")]
    long = " ".join([prose(s, 3000, 9) for s in range(3)])
    texts = [None, "", "!?", prose(0, 15, 9), "x " + prose(0, 15, 9).upper() + " y", prose(1, 11, 9) + ", " + prose(1, 12, 9), prose(3, 9, 9), "Ärger " + prose(5, 2, 9), long, long]
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS words", "2 AS block")
    got = D.decontaminate(docs(list(enumerate(texts))), bench, block_bytes=block_bytes)
    rows = {r["doc_id"]: (r["n_words"], sum(b - a for a, b in r["spans"]), r["items"]) for r in got.collect()}
    assert [rows[i] for i in range(len(texts))] == brute(texts, items)


def test_empty_tables_and_repeated_rows(spark, docs):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(docs([]), none).collect() == []
    got = D.decontaminate(docs([(1, "a b"), (1, "a b"), (None, "a b")]), none, keep=("source", "score")).collect()
    assert sorted((str(r["doc_id"]), r["n_words"], r["items"], r["kept"]["score"]) for r in got) == [("1", 2, [], 4), ("1", 2, [], 4), ("None", 2, [], 4)]
