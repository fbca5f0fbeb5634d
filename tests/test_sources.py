"""Readers on synthetic files with the landed shapes."""

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from meterlake.functions.text import literal_to_json, parse_literal
from meterlake.sources import csv_exports as X
from meterlake.sources import json_reports as R
from meterlake.sources import text_files as T
from meterlake.sources.tables import columns_of, read_parquet, read_table

D = dt.date


def page(path, name, obj):
    (path / name).write_text(json.dumps(obj, indent=2))


def test_cost_report_pages(spark, tmp_path, rows):
    bucket = lambda day, *results: {"starting_at": f"{day}T00:00:00Z", "ending_at": f"{day}T23:59:59Z", "results": list(results)}
    full = {
        "currency": "USD", "amount": "227163.99123", "workspace_id": "w1", "description": "Usage - Input Tokens, Cache Hit",
        "cost_type": "tokens", "context_window": "0-200k", "model": "m", "service_tier": "standard", "token_type": "output_tokens",
    }
    blank = {k: None for k in full} | {"amount": "1", "model": "", "workspace_id": ""}
    page(tmp_path, "p1.json", {"data": [bucket("2025-09-17", full, blank), bucket("2025-09-18")], "has_more": True, "next_page": "p2"})
    page(tmp_path, "p2.json", {"data": [bucket("2025-09-18", {"amount": "50"})], "has_more": False, "next_page": None})
    page(tmp_path, "p3.json", {"data": [], "has_more": False})
    got = rows(R.read_cost_report(spark, str(tmp_path), "org"), "activity_date", "amount_usd")
    assert [(r[0], r[2], r[3], r[5], r[6], r[7]) for r in got] == [
        (D(2025, 9, 17), None, None, "tokens", Decimal("0.010000"), "USD"),
        (D(2025, 9, 17), "w1", "m", "tokens", Decimal("2271.639912"), "USD"),
        (D(2025, 9, 18), None, None, "tokens", Decimal("0.500000"), "USD"),
    ]
    check = R.page_gaps(spark, str(tmp_path)).first()
    assert (check.pages, check.repeated_pages, check.last_pages) == (3, 0, 2)


def test_malformed_page_fails_instead_of_vanishing(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"data": [{"starting_at": ')
    with pytest.raises(Exception):
        R.read_cost_report(spark, str(tmp_path), "org").collect()


def test_usage_report_defaults(spark, tmp_path, rows):
    results = [
        {"uncached_input_tokens": 5, "cache_creation": {"ephemeral_1h_input_tokens": 1, "ephemeral_5m_input_tokens": 2},
         "cache_read_input_tokens": 3, "output_tokens": 4, "server_tool_use": {"web_search_requests": 6}, "api_key_id": "k",
         "workspace_id": None, "model": "m"},
        {"api_key_id": None, "cache_creation": None},
    ]
    page(tmp_path, "p.json", {"data": [{"starting_at": "2025-09-17T00:00:00Z", "results": results}]})
    got = rows(R.read_usage_report(spark, str(tmp_path), "org"), "output_tokens")
    assert got[0][2:] == (None, None, None, 0, 0, 0, 0, 0, 0)
    assert got[1][2:] == ("k", None, "m", 5, 4, 3, 2, 1, 6)


def test_productivity_ignores_breakdown(spark, tmp_path):
    rec = {
        "date": "2025-10-15T00:00:00Z", "actor": {"type": "user_actor", "email_address": "user1@example.com"}, "organization_id": "o",
        "terminal_type": "vscode", "core_metrics": {"num_sessions": 2, "lines_of_code": {"added": 10}},
        "tool_actions": {"edit_tool": {"accepted": 3, "rejected": 1}}, "model_breakdown": [{"estimated_cost": {"amount": 9}}],
    }
    page(tmp_path, "p.json", {"data": [rec, {"date": "2025-10-15T00:00:00Z", "actor": {"type": "api_actor", "api_key_name": "k"}}]})
    df = R.read_productivity(spark, str(tmp_path))
    assert columns_of(spark, df, ["%cost%", "%token%", "%amount%"]).count() == 0
    a, b = sorted(df.collect(), key=lambda r: r.actor_type)
    assert (a.user_email, a.api_key_name, a.num_sessions) == (None, "k", 0)
    assert (b.lines_added, b.lines_removed, b.edit_tool_accepted, b.notebook_edit_tool_rejected) == (10, 0, 3, 0)


@pytest.mark.parametrize("enveloped", [True, False])
def test_team_usage_filters_day(spark, tmp_path, enveloped):
    recs = [
        {"date": 1758133588288, "day": "2025-09-17", "userId": "u1", "email": "user1@example.com", "isActive": True, "totalAccepts": 5},
        {"date": 1758233588288, "day": "2025-09-18", "userId": "u2", "email": "user2@example.com"},
    ]
    page(tmp_path, "p.json", {"data": recs} if enveloped else recs)
    (r,) = R.read_team_usage(spark, str(tmp_path), "2025-09-17").collect()
    assert (r.user_id, r.is_active, r.total_accepts, r.chat_requests, r.most_used_model) == ("u1", True, 5, 0, "")
    assert R.read_team_usage(spark, str(tmp_path)).count() == 2


def test_spend_pages(spark, tmp_path):
    members = [
        {"email": "user1@example.com", "spendCents": 150, "includedSpendCents": 50, "name": "U", "role": "member"},
        {"email": None, "spendCents": 7}, {"email": "", "spendCents": 7}, {"email": "user2@example.com"},
    ]
    page(tmp_path, "p.json", {"teamMemberSpend": members, "subscriptionCycleStart": 1759523607000, "totalMembers": 4, "totalPages": 1})
    got = sorted(R.read_spend(spark, str(tmp_path), "2025-10-18").collect(), key=lambda r: r.user_email)
    assert [r.total_spend_cents for r in got] == [200, 0]
    assert got[0].billing_cycle_start == dt.datetime(2025, 10, 3, 20, 33, 27)


LITERALS = [
    ("""{'name': 'A', 'metadata': {'email_address': 'user1@example.com'}}""", "A", "user1@example.com"),
    ("""{'name': "O'Neil, None", 'metadata': {'email_address': None}}""", "O'Neil, None", None),
    (r"""{'name': 'it\'s "x" \\', 'ok': True, 'metadata': {}}""", 'it\'s "x" \\', None),
    (r"""{'name': 'caf\xe9 é', 'tags': (1, 2,), 'metadata': {'email_address': 'a@b.c',}}""", "café é", "a@b.c"),
    ("""{'name': __import__('os')}""", None, None),
    ("{broken", None, None),
    ("", None, None),
    ("{}", None, None),
]


def test_literals(spark):
    df = spark.createDataFrame([(i, t) for i, (t, *_) in enumerate(LITERALS)], "i int, t string")
    got = df.select("i", parse_literal("t", "name string, metadata struct<email_address: string>").alias("p")).orderBy("i").collect()
    for r, (text, name, email) in zip(got, LITERALS):
        p = r.p
        assert (p and p.name, p and p.metadata and p.metadata.email_address) == (name, email), text


def test_long_literal_is_parsed_whole(spark):
    body = ", ".join(f"'k{i}': 'it\\'s {i}'" for i in range(20000))
    df = spark.createDataFrame([("{" + body + ", 'last': None}",)], "t string")
    out = json.loads(df.select(literal_to_json("t")).first()[0])
    assert len(out) == 20001 and out["k19999"] == "it's 19999" and out["last"] is None


def test_activity_csv(spark, tmp_path):
    q = lambda s: '"' + s.replace('"', '""') + '"'
    actor = "{'name': \"O'Neil\", 'uuid': 'u', 'metadata': {'email_address': 'user1@example.com'}}"
    chat = "{'type': 'chat_conversation', 'uuid': 'c1', 'metadata': {'project_uuid': 'p1'}}"
    other = "{'type': 'file', 'uuid': 'f1', 'metadata': {}}"
    lines = ["created_at,event,actor_info,entity_info,event_info,client_platform,device_id,user_agent,ip_address"]
    lines.append(",".join(["2025-10-01T23:59:00Z", "conversation_created", q(actor), q(chat), q("{'a': True,\n 'b': None}"), "ios", "", q("agent, v1"), ""]))
    lines.append(",".join(["2025-10-02T01:00:00+02:00", "file_uploaded", q(actor), q(other), q("{}"), "", "d", "", "1.2.3.4"]))
    lines.append(",".join(["2025-10-02T01:00:00Z", "file_uploaded", q("{'name': 'x', 'metadata': {}}"), q(other), q("{}"), "", "", "", ""]))
    (tmp_path / "log.csv").write_text("\n".join(lines) + "\n")
    raw = X.read_activity_csv(spark, str(tmp_path))
    b, a = X.app_usage_rows(raw).orderBy("activity_timestamp").collect()
    assert tuple(X.skipped_rows(raw).first()) == (2, 1)
    assert (a.conversation_uuid, a.project_uuid, a.event_info, a.device_id, a.user_agent) == ("c1", "p1", '{"a":true,"b":null}', None, "agent, v1")
    assert (b.conversation_uuid, b.entity_uuid, b.event_info, b.client_platform) == (None, "f1", None, None)
    # The day is the one of the text's own offset, the instant is UTC.
    assert (b.activity_date, b.activity_timestamp) == (D(2025, 10, 2), dt.datetime(2025, 10, 1, 23, 0))


def test_key_mapping(spark, tmp_path):
    (tmp_path / "keys.csv").write_text(
        "api_key_name,email,description\ncursor-dev,USER1@Example.com,x\nk2,user2@example.com,Team Cursor key\n"
        "claude-x,user3@example.com,\nplain,user4@example.com,other\n"
    )
    got = [(r.user_email, r.platform) for r in X.read_key_mapping(spark, str(tmp_path)).orderBy("user_email").collect()]
    assert got == [("user1@example.com", "cursor"), ("user2@example.com", "cursor"), ("user3@example.com", "anthropic"), ("user4@example.com", "anthropic")]


def test_team_csv_with_and_without_spend(spark, tmp_path):
    full, short = tmp_path / "full.csv", tmp_path / "short.csv"
    full.write_text('User,Spend this Month (USD),Lines this Month\nuser1@example.com,"$9,876.50","12,345"\nsome-key [API key],$1.25,7\n')
    short.write_text('User,Lines this Month\nuser1@example.com,"3,210"\n')
    a, b = X.read_team_csv(spark, str(full)).orderBy("lines").collect()
    assert tuple(a) == ("api_key", None, "some-key", Decimal("1.25"), 7)
    assert tuple(b) == ("user", "user1@example.com", None, Decimal("9876.50"), 12345)
    assert tuple(X.read_team_csv(spark, str(short)).first()) == ("user", "user1@example.com", None, None, 3210)


def test_logs_and_lists(spark, tmp_path):
    log, lst = tmp_path / "run.log", tmp_path / "dates.txt"
    log.write_text("ok\n❌ FAILED: 2025-03-27 - boom\n❌ FAILED: 2025-01-02 - x\n❌ FAILED: 2025-03-27 - again\nFAILED: soon\n")
    lst.write_text("2025-03-27\n\n  \n 2025-03-28 \n")
    assert [r[0] for r in T.read_failed_dates(spark, str(log)).collect()] == [D(2025, 1, 2), D(2025, 3, 27)]
    assert [r[0] for r in T.read_dates(spark, str(lst)).orderBy("date").collect()] == [D(2025, 3, 27), D(2025, 3, 28)]


def test_table_scan_prunes_partitions(spark):
    from meterlake.sinks.tables import append, create_table

    spark.sql("CREATE DATABASE IF NOT EXISTS scan_db")
    t = create_table(spark, "cursor_daily_metrics", "scan_db.cursor_daily_metrics")
    append(spark.sql("SELECT DATE'2025-10-01' + CAST(id AS INT) AS activity_date, 'u' AS user_email FROM range(5)"), t)
    df = read_table(spark, t, "2025-10-02", "2025-10-03")
    assert df.count() == 2
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(activity_date" in plan
    assert set(columns_of(spark, t, "%spend%").toPandas().column_name) == {"daily_spend_usd"}


def test_read_parquet_fills_columns_added_later(spark, tmp_path):
    spark.sql("SELECT DATE'2025-10-01' AS cost_date, 'cursor' AS provider, 1.5BD AS amount_usd").selectExpr(
        "cost_date", "provider", "CAST(amount_usd AS DECIMAL(18,6)) AS amount_usd"
    ).write.parquet(str(tmp_path / "c"))
    (r,) = read_parquet(spark, str(tmp_path / "c"), "vw_combined_daily_costs", "2025-10-01", "2025-10-01").collect()
    assert (r.provider, r.model) == ("cursor", None)


def test_literals_without_escapes(spark, monkeypatch):
    """Whole-text patterns give what the tokens give, whatever stands inside and outside of strings."""
    import random

    from meterlake.functions import text as TX

    rng = random.Random(5)
    parts = ["'", "'", '"', '"', "None", "True", "False", "N", "T", "x", "_", "é", "(", ")", "[", "]", "{", "}", ", ", ",", ":", " ", "\n", "\\", "\\'", "1"]
    strings = ["'a'", "'None'", '"it\'s (None, )"', "'(True,)'", "''", '""', "'é,]'", "'a\"b'", "'a\\'b'"]
    texts = ["".join(rng.choices(parts + 3 * strings, k=rng.randrange(1, 14))) for _ in range(6000)] + [None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(TX.python_literal_to_json("t")).collect()]
    plain = df.where(F.col("t").rlike(TX._PLAIN)).count()
    monkeypatch.setattr(TX, "_PLAIN", "(?!)")
    assert got == [r[0] for r in df.select(TX.python_literal_to_json("t")).collect()]
    assert 1500 < plain < 5500


def test_activity_parses_each_literal_once(spark, sf_dir):
    """The filter on the parsed e-mail and the test for empty JSON used to parse again."""
    from meterlake.queries.sources import app_log_transform

    plan = app_log_transform(spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 3 and plan.count("from_json(") == 2
