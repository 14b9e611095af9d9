"""Statement checks, scope rules, names, hashes and redaction on hand-made cases."""

import base64
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from lakeaudit.functions import formats, names, redaction, sqltext
from lakeaudit.operators import filters, guard
from lakeaudit.sources import sinks, tables


def one(spark, text, build):
    return spark.createDataFrame([(text,)], "s string").select(build(F.col("s")).alias("v")).first()["v"]


def refs(spark, sql):
    rows = sqltext.referenced_tables(spark.createDataFrame([(1, sql)], "stmt_id long, sql_text string")).collect()
    return [(r["schema_name"], r["table_name"]) for r in sorted(rows, key=lambda r: r["position"])]


@pytest.mark.parametrize("sql, code", [
    ("a /* x\ny */ b", "a   b"),
    ("a -- x\nb", "a  b"),
    ("a -- x\r\nb", "a  b"),
    ("a 'it''s' b", "a   b"),
    ('a "q""q" b', "a   b"),
    ("a '-- b", "a ' "),
    ("'a''", " '"),
    ("/* open", "/* open"),
])
def test_strip_sql_text(spark, sql, code):
    assert one(spark, sql, sqltext.strip_sql_text) == code


@pytest.mark.parametrize("sql, readonly", [
    ("SELECT 1", True),
    ("update depot.crates set weight = 3", False),
    ("delete from depot.crates", False),
    ("  ", False),
    ("-- only a comment", False),
    ("SELECT 'drop table x'", True),
    ("SELECT updated FROM t", True),
    ("WITH a AS (SELECT 1) SELECT * FROM a", True),
    ("SELECT '--' ; DROP TABLE t", False),
    ("EXEC p", False),
    ("VALUES (1)", False),
])
def test_readonly(spark, sql, readonly):
    row = sqltext.classify(spark.createDataFrame([(sql,)], "sql_text string")).first()
    assert row["is_readonly"] is readonly


def test_select_into_writes_a_table(spark):
    row = sqltext.classify(spark.createDataFrame([("SELECT a INTO b FROM c",)], "sql_text string")).first()
    assert row["writes_table"]


def test_missing_statement_is_not_readonly(spark):
    row = sqltext.classify(spark.createDataFrame([(None,)], "sql_text string")).first()
    assert row["is_readonly"] is False and row["write_words"] == []


def test_require_readonly(spark):
    sqltext.require_readonly(spark, "SELECT 1")
    with pytest.raises(ValueError):
        sqltext.require_readonly(spark, "TRUNCATE TABLE depot.crates")


def test_references_of_writes(spark):
    sql = (
        "insert depot.crates (id) select id from yard.arrivals; update pallets set row_no = 2; "
        "delete from [old yard].[moves] where id < 5; "
        "merge into depot.stock x using yard.counts y on x.id = y.id when matched then update set x.n = y.n "
        "when not matched then insert (id) values (y.id)"
    )
    assert set(refs(spark, sql)) == {
        ("depot", "crates"), ("yard", "arrivals"), ("dbo", "pallets"), ("old yard", "moves"), ("depot", "stock"), ("yard", "counts"),
    }


def test_references_skip_cte_names(spark):
    sql = "with late as (select id from yard.arrivals), heavy(id, w) as (select id, w from bins) select 1 from late, heavy, late l2"
    assert refs(spark, sql) == [("yard", "arrivals"), ("dbo", "bins")]


@pytest.mark.parametrize("sql, tables, readable", [
    ("select 1 from depot.a x, secret.b", [("depot", "a"), ("secret", "b")], True),
    ("select 1 from (select 1 from p.q where i in (select j from r.s)) d, e.f", [("p", "q"), ("r", "s"), ("e", "f")], True),
    ("select 1 from (g.h join i.j on h.x = j.x), k.l", [("g", "h"), ("i", "j"), ("k", "l")], True),
    ("select 1 from a join b using (id), c where extract(year from d) = 1", [("dbo", "a"), ("dbo", "b"), ("dbo", "c")], True),
    ("select 1 from a where x is distinct from y", [("dbo", "a")], True),
    ("update x set v = 1 from depot.crates x", [("depot", "crates")], True),
    ("delete x from yard.moves as x join yard.days d on d.i = x.i", [("yard", "moves"), ("yard", "days")], True),
    ("update top (5) depot.crates set v = 1", [("depot", "crates")], True),
    ("select 1 from t with (nolock), u", [("dbo", "t"), ("dbo", "u")], True),
    ("select a into new.b from c", [("dbo", "c"), ("new", "b")], True),
    ("select 1 from", [], False),
    ("select (1 from t", [], False),
    ("select 'open from t", [("dbo", "t")], False),
    ("select 1 from t /* open", [("dbo", "t")], False),
])
def test_lists_aliases_and_unreadable_ends(spark, sql, tables, readable):
    row = sqltext.statement_references(spark.createDataFrame([(sql,)], "sql_text string")).first()
    assert list(dict.fromkeys((r["schema_name"], r["table_name"]) for r in row["references"])) == tables
    assert row["readable"] is readable


def test_references_keep_quoted_names_and_last_two_parts(spark):
    assert refs(spark, 'SELECT * FROM "Sales"."Big Orders" JOIN srv.db.hr.staff ON 1=1 JOIN [it\'s] ON 2=2') == [
        ("sales", "big orders"), ("hr", "staff"), ("dbo", "it's"),
    ]


LONG = "SELECT '" + "x" * 200_000 + "''" * 200_000 + "' FROM a.b /*" + "y" * 200_000 + "*/ WHERE \"" + '""' * 200_000 + "\" = 1"


def test_long_literals_do_not_exhaust_the_stack(spark):
    assert refs(spark, LONG) == [("a", "b")]
    assert one(spark, LONG, sqltext.strip_sql_text).split() == ["SELECT", "FROM", "a.b", "WHERE", "=", "1"]
    assert sqltext.classify(spark.createDataFrame([(LONG,)], "sql_text string")).first()["is_readonly"]


def test_long_literals_in_verdicts_and_lineage(spark):
    from lakeaudit.operators import lineage

    df = spark.createDataFrame([(1, LONG), (2, LONG.replace("a.b", "a.b, c.d"))], "stmt_id long, sql_text string")
    assert {r["stmt_id"]: r["allowed"] for r in guard.scope_verdict(df, "a.*").collect()} == {1: True, 2: False}
    assert lineage.table_edges(df).count() == 1 and lineage.dependency_degrees(df).count() == 2
    assert lineage.ordered_distinct(sqltext.referenced_tables(df)).count() == 2
    with pytest.raises(ValueError):
        tables.param_query(spark, LONG.replace("SELECT", "DELETE FROM z.z; SELECT", 1))


def test_reads_are_guarded_and_audited(spark, tmp_path):
    df = spark.range(700)
    every = tables.param_query(spark, "SELECT * FROM {own} WHERE id >= ?", "[10]", {"own": df})
    assert every.count() == 690 and "own" not in [t.name for t in spark.catalog.listTables()]
    assert tables.param_query(spark, "SELECT * FROM {own}", None, {"own": df}, max_rows=5).count() == 5
    log = str(tmp_path / "log")
    asked = tables.ReadGuard(scope="dbo.own", audit_path=log, caller=" me ")
    assert tables.param_query(spark, "SELECT * FROM {own}", None, {"own": df}, guarded=asked).count() == 700
    with pytest.raises(ValueError, match="dbo.other"):
        tables.param_query(spark, "SELECT * FROM {own}, {other}", None, {"own": df, "other": df}, guarded=asked)
    row = spark.read.json(log).collect()
    assert len(row) == 1 and row[0]["api_caller"] == "me" and row[0]["sql_sha256"] == hashlib.sha256(b"SELECT * FROM own").hexdigest()


@pytest.mark.parametrize("bad", ["orders", "sales.or-ders", "1a.*", "a.b.c"])
def test_bad_scope_patterns(bad):
    with pytest.raises(ValueError):
        filters.parse_scope(bad)


def test_scope_verdicts(spark):
    allowed = lambda sql, scope: guard.scope_verdict(
        spark.createDataFrame([(1, sql)], "stmt_id long, sql_text string"), scope
    ).first()["allowed"]
    assert not allowed("SELECT TOP 2 id FROM vault.keys", "dbo.*")
    assert allowed("WITH q AS (SELECT * FROM depot.crates) SELECT * FROM q", "depot.*")
    assert allowed("SELECT 1", "dbo.x")
    assert not allowed("SELECT * FROM a.b", "")
    assert allowed("SELECT * FROM a.b", "*.*")
    with pytest.raises(ValueError, match="vault.keys"):
        guard.require_scope(spark, "SELECT * FROM vault.keys", "dbo.*")


def test_scope_filter_defaults(spark):
    rows = spark.createDataFrame([("", "T"), (None, "t"), ("dbo", ""), ("DBO", " t ")], "s string, t string")
    assert filters.scope_filter(rows, "dbo.t", "s", "t").count() == 3


def test_sql_like_classes(spark):
    df = spark.createDataFrame([("abc",), ("Bbc",), ("zbc",), ("a.c",), ("b\nc",)], "n string")
    keep = lambda p: {r["n"] for r in df.where(filters.sql_like(F.col("n"), p)).collect()}
    assert keep("[a-b]_c") == {"abc", "Bbc", "a.c", "b\nc"}  # any one character, a line break too
    assert keep("[^a]%") == {"Bbc", "zbc", "b\nc"}
    assert keep("A%") == {"abc", "a.c"}


@pytest.mark.parametrize("name, expected", [
    ("sales.Customers", ("sales", "Customers", None)),
    ("[reporting].[DailySummary]", ("reporting", "DailySummary", None)),
    ("Customers", ("dbo", "Customers", None)),
    ("[My Table]", ("dbo", "My Table", None)),
    (" a . b ", ("a", "b", None)),
])
def test_parse_name(spark, name, expected):
    assert tuple(one(spark, name, names.parse_name)) == expected


@pytest.mark.parametrize("name", ["", "  ", "[ ].x", None])
def test_parse_name_errors(spark, name):
    assert one(spark, name, names.parse_name)["error"] is not None


def test_labels_and_quotes(spark):
    assert one(spark, "FK bad-label <script>alert(1)</script>", names.label) == "FKbadlabelscriptalert1script"
    assert one(spark, "a]b", names.quoted) == "[a]]b]"
    assert one(spark, "a b", names.is_identifier) is False


def token(payload: bytes) -> str:
    return "h." + base64.urlsafe_b64encode(payload).decode().rstrip("=") + ".s"


@pytest.mark.parametrize("text, subject", [
    (token(b'{"sub":" user-1 "}'), "user-1"),
    (token('{"sub":"usér>?"}'.encode()), "usér>?"),
    (token(b'{"sub":5}'), None),
    (token(b'{"sub":" "}'), None),
    (token(b'{"x":"y"}'), None),
    (token(b"no json"), None),
    (token(b"\xff\xfe"), None),
    ("a.b", None),
    ("a.!!.c", None),
    (None, None),
])
def test_token_subject(spark, text, subject):
    assert one(spark, text, redaction.token_subject) == subject


@pytest.mark.parametrize("caller, known", [(" me ", "me"), ("", "system:local"), ("Unknown", "system:local"), (None, "system:local")])
def test_caller(spark, caller, known):
    assert one(spark, caller, redaction.caller_identity) == known


SECRETS = {
    "database": "master",
    "config": {"password": "secret-pass", "token": "abc123", "nested": {"Authorization": "Bearer xyz", "safe": "ok"}},
    "items": [{"api_key": "k1", "name": "first"}, {"prompt_context": "raw", "meta": {"secret": {"deep": 1}}}, "plain"],
}


def test_redact_json(spark):
    clean = json.loads(one(spark, json.dumps(SECRETS), redaction.redact_json))
    assert clean["database"] == "master" and clean["items"][2] == "plain" and clean["items"][0]["name"] == "first"
    assert clean["config"] == {"password": "[redacted]", "token": "[redacted]", "nested": {"Authorization": "[redacted]", "safe": "ok"}}
    assert clean["items"][0]["api_key"] == clean["items"][1]["prompt_context"] == clean["items"][1]["meta"]["secret"] == "[redacted]"


@pytest.mark.parametrize("text", ['{"count":3,"none":null}', "no json at all", '{"token": broken', None])
def test_redact_json_leaves_others(spark, text):
    assert one(spark, text, redaction.redact_json) == text


@pytest.mark.parametrize("text, clean", [
    ('{"tok\\u0065n":"k1"}', '{"tok\\u0065n":"[redacted]"}'),
    ('{"token":"k1", "token" : 2}', '{"token":"[redacted]", "token" : "[redacted]"}'),
    ('{"a":1e400,"b":12345678901234567890.123456789,"token":null}', '{"a":1e400,"b":12345678901234567890.123456789,"token":"[redacted]"}'),
    ('{"headers":{"token":["x",{}]},"k":[{"secret":{}}]}', '{"headers":"[redacted]","k":[{"secret":"[redacted]"}]}'),
    ('{"token":1,}', '{"token":1,}'),
    ('{"token":1} x', '{"token":1} x'),
])
def test_redact_json_changes_nothing_else(spark, text, clean):
    assert one(spark, text, redaction.redact_json) == clean


def test_redact_json_at_any_depth(spark):
    deep = '{"a":[' * 20_000 + '{"token":"z"}' + "]}" * 20_000
    assert one(spark, deep, redaction.redact_json) == deep.replace('"z"', '"[redacted]"')


def test_compact_text(spark):
    assert one(spark, "  a \t b\n", formats.compact_text) == "a b"
    assert one(spark, "x" * 240, formats.compact_text) == "x" * 240
    assert one(spark, "x" * 241, formats.compact_text) == "x" * 240 + "…"


def audit(spark, **options):
    df = spark.createDataFrame([("SELECT TOP 1 * FROM dbo.Customers", "User asked")], "q string, p string")
    return sinks.audit_records(
        df, tool="run_query", database="TEST_DB", sql=F.col("q"), prompt=F.col("p"), caller=F.lit("unknown"),
        at=F.lit("2026-01-01T00:00:00"), **options,
    )


def test_audit_is_hashed_by_default(spark):
    row = audit(spark).first().asDict()
    sha = hashlib.sha256(b"SELECT TOP 1 * FROM dbo.Customers").hexdigest()
    assert row["sql_sha256"] == sha and row["redacted_sql"] == f"[REDACTED_SQL:{sha[:12]}]"
    assert row["sql_anonymized_hash"] == f"sha256:{sha}" and row["prompt_storage_mode"] == "hashed_redacted"
    assert row["api_caller"] == "system:local" and row["prompt_redaction_token"].startswith("[REDACTED_PROMPT:")
    assert "prompt" not in row and not any(v and "Customers" in str(v) for v in row.values())


def test_audit_keeps_prompt_on_opt_in_and_params_when_given(spark):
    row = audit(spark, allow_raw=True, params=F.lit("[1]")).first().asDict()
    assert row["prompt"] == "User asked" and row["raw_prompt_storage_enabled"] and row["params_json"] == "[1]"
    assert row["prompt_storage_mode"] == "raw_opt_in"


def test_params(spark):
    assert tables.parse_params(None) == [] and tables.parse_params("[1]") == [1] and tables.parse_params('{"a":1}') == {"a": 1}
    with pytest.raises(ValueError):
        tables.parse_params("5")
    with pytest.raises(ValueError):
        tables.param_query(spark, "DROP TABLE x")


def test_sources_need_bounds_and_schemas(spark, tmp_path):
    with pytest.raises(ValueError, match="partitionColumn"):
        tables.read_source(spark, "jdbc", url="jdbc:x", dbtable="t")
    with pytest.raises(ValueError, match="schema"):
        tables.read_source(spark, "csv", str(tmp_path))
    for fmt in ("parquet", "orc", "json", "csv"):
        path = str(tmp_path / fmt)
        spark.range(5).write.format(fmt).save(path)
        options = {"schema": "id long"} if fmt in ("json", "csv") else {}
        assert tables.read_source(spark, fmt, path, **options).count() == 5
