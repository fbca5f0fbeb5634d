import re

import corpus_pipeline as P
from meterlake.llm import common
from test_decontaminate import brute as hit_words
from test_neardup import brute as classes


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = rows_of(docs)
    columns = docs.columns
    for name, stage in P.STAGES:
        docs = P.staged(stage(spark, docs, sf_dir), name)
        if name == "mixing":
            assert {r["doc_id"] for r in docs.collect()} <= set(before)
            break
        assert docs.columns == columns
        after = rows_of(docs)
        if name == "language":
            assert {i for i, t in before.items() if any(c.isalpha() for c in t or "")} == set(after)
        if name == "near_duplicates":
            assert set(after) == {i for i, (_, low) in classes(sorted(before.items()), 5, 80).items() if i == low}
        if name == "decontamination":
            items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
            windows = {w for _, t in items for w in _windows(t)}
            assert set(after) == {i for i, t in before.items() if not windows & set(_windows(t))}
        if name == "secrets":
            assert set(after) == set(before)
            assert all(after[i] == before[i] or "[SECRET]" in after[i] for i in before)
            assert not any(re.search("AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t) for t in after.values())
        before = after


def _windows(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return [tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))] if len(w) >= 10 else []


def test_extra_columns_of_any_name_pass_through(spark, docs, sf_dir):
    """Columns named as the operators' own results, or their helpers, stay as they are until the mix."""
    names = ["score", "lang_pred", "items", "n_words", "spans", "kept", "_id", "_text", "_row", "component_id", "_keep0", "size", "n_shingles"]
    rows = [(1, "the thing is there and here we go"), (2, "another thing of the same kind"), (2, "another thing of the same kind"), (3, "password=hunter22 and more")]
    plain = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    table = plain.selectExpr("*", *[f"CONCAT('{n} ', doc_id) AS {n}" for n in names])
    for name, stage in P.STAGES[:-1]:
        table, before = P.staged(stage(spark, table, sf_dir), name), table.columns
        assert table.columns == before
        assert {r["score"] for r in table.collect()} == {"score 1", "score 2", "score 3"}
    assert sorted(r["doc_id"] for r in P.mix_sources(spark, table, sf_dir).collect()) == [1, 2, 3]


def test_windows_helper_agrees_with_the_operator_test():
    text = "One two, three four five six seven eight nine ten eleven"
    assert hit_words([text], [(1, text)])[0][1] == 11 and len(_windows(text)) == 2


def test_language_stage_rejects_what_the_model_knows_nothing_of(spark, docs, sf_dir):
    rows = [(1, "the thing is there"), (2, "здесь другой язык " * 20), (3, "über the thing"), (4, "12 34"), (5, None), (6, "日本語の文")]
    table = docs(rows[:1] + rows[3:5]).unionByName(docs(rows[1:3] + rows[5:], lang=None)).select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted(rows_of(P.language_id(spark, table, sf_dir))) == [1, 3]
    # Nothing to learn from: every text with a letter stays.
    table = docs(rows, lang=None).select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted(rows_of(P.language_id(spark, table, sf_dir))) == [1, 2, 3, 6]


def test_odd_rows(spark, docs, sf_dir):
    """Nulls, copies and repeated rows through every stage."""
    rows = [(1, "the thing is there and here"), (1, "the thing is there and here"), (2, None), (3, ""), (4, "123"), (None, "of the and that"), (5, "password=hunter22 and the other thing")]
    table = docs(rows).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES:
        table = P.staged(stage(spark, table, sf_dir), "odd")
    assert sorted(str(r["doc_id"]) for r in table.collect()) in (["1", "5", "None"], ["1", "5"])
    none = docs([]).select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in P.STAGES:
        none = P.staged(stage(spark, none, sf_dir), "none")
    assert none.count() == 0


def test_texts_travel_in_batches_bounded_by_bytes(spark):
    import pyarrow as pa

    from meterlake.llm.common import BATCH_BYTES, mapped

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    rows = spark.range(0, 8000, 1, 1).selectExpr("repeat('long text ', 500) AS text")
    found = [r["n"] for r in mapped(rows, sizes, "n long").collect()]
    assert sum(found) > 40_000_000 and max(found) < 1.1 * BATCH_BYTES


def test_many_dropped_or_repeated_ids_are_not_broadcast(spark, docs, sf_dir, monkeypatch):
    """Two dropped ids and one kept twice stand for more than 100,000 of each."""
    rows = [(1, "a b c"), (2, "a b c"), (3, "a b c"), (4, "d e f"), (4, "d e f"), (5, "g h i"), (None, "a b c")]
    table, plans = docs(rows).select("doc_id", "text", "lang", "source", "n_chars"), []
    for most in (common.BROADCAST_ROWS, 0):
        monkeypatch.setattr(common, "BROADCAST_ROWS", most)
        out = P.near_duplicates(spark, table, sf_dir)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        assert sorted((r["doc_id"] or 0, r["text"]) for r in out.collect()) == [(0, "a b c"), (1, "a b c"), (4, "d e f"), (5, "g h i")]
    assert "BroadcastHashJoin" in plans[0] and "Broadcast" not in plans[1]
