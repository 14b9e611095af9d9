"""Statements, names, hashes, redaction and audit records."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeaudit import fixtures as fx
from lakeaudit import session
from lakeaudit.functions import formats, names, redaction, sqltext
from lakeaudit.operators import filters, guard, lineage
from lakeaudit.sources import sinks
from lakeaudit.suite.registry import query

STMTS = fx.duck(fx.STMTS, "events")


def _q(text: str) -> str:
    """SQL literal."""
    return "'" + text.replace("'", "''") + "'"


# What each of the eight statement forms names, written down by hand.
EXPECTED_REFS = """
    SELECT * FROM (VALUES
      (0, 1, 'sales', 'orders'), (1, 1, 'dbo', 'customer'), (1, 2, 'sales', 'orders'), (2, 1, 'sales', 'customers'),
      (3, 1, 'sales', 'orders'), (3, 2, 'dbo', 'regions'), (4, 1, 'dbo', 'target'), (4, 2, 'dbo', 'other'),
      (5, 1, 'sales', 'orders'), (6, 1, 'dbo', 'nation'), (7, 1, 'dbo', 'src'), (7, 2, 'dbo', 'inventory')
    ) AS v(form, position, schema_name, table_name)
"""
REFS = f"""
    WITH refs AS (SELECT event_id AS stmt_id, position, schema_name, table_name
                  FROM events JOIN ({EXPECTED_REFS}) ON form = event_id % 8)
"""
ALLOWED = "(schema_name = 'sales' OR (schema_name = 'dbo' AND table_name = 'regions') OR table_name = 'nation')"


# Each statement form without comments and literals, written down by hand.
STRIPPED_FORMS = """
    CASE event_id % 8
      WHEN 0 THEN 'SELECT * FROM sales.orders WHERE o_orderkey = ' || event_id
      WHEN 1 THEN '  SELECT 1   FROM [dbo].[customer] c JOIN sales.orders o ON 1 = 1'
      WHEN 2 THEN 'UPDATE sales.customers SET city =   WHERE id = ' || user_id
      WHEN 3 THEN 'WITH a AS (SELECT * FROM sales.orders), b(x) AS (SELECT 1 FROM dbo.regions) SELECT * FROM a JOIN b ON 1 = 1'
      WHEN 4 THEN 'DELETE t FROM dbo.target t JOIN dbo.other o ON o.id = t.id'
      WHEN 5 THEN 'INSERT INTO sales.orders (id) VALUES (' || event_id || ')'
      WHEN 6 THEN 'SELECT   AS s FROM nation'
      ELSE 'MERGE INTO dbo.inventory AS t USING dbo.src AS s ON t.id = s.id WHEN MATCHED THEN UPDATE SET t.q = s.q'
    END
"""


@query("strip_sql_text", f"SELECT event_id AS stmt_id, {STRIPPED_FORMS} AS code FROM events")
def strip_sql_text(lake):
    return fx.stmts(lake).select("stmt_id", sqltext.strip_sql_text(F.col("sql_text")).alias("code"))


FORM_VERDICTS = """
    SELECT * FROM (VALUES (0, true, NULL), (1, true, NULL), (2, false, 'update'), (3, true, NULL),
      (4, false, 'delete'), (5, false, 'insert'), (6, true, NULL), (7, false, 'merge'), (7, false, 'update')
    ) AS v(form, is_readonly, word)
"""


@query("readonly_classify", f"""
    SELECT event_id AS stmt_id, is_readonly, coalesce(string_agg(word, ',' ORDER BY word), '') AS write_words,
           false AS writes_table
    FROM events JOIN ({FORM_VERDICTS}) ON form = event_id % 8 GROUP BY event_id, is_readonly
""")
def readonly_classify(lake):
    verdicts = sqltext.classify(fx.stmts(lake).select("stmt_id", "sql_text"))
    return verdicts.withColumn("write_words", F.array_join("write_words", ",")).drop("sql_text")


@query("readonly_report", f"""
    SELECT is_readonly, false AS writes_table, word, count(*) AS statements
    FROM events JOIN ({FORM_VERDICTS}) ON form = event_id % 8 GROUP BY is_readonly, word
""")
def readonly_report(lake):
    return sqltext.readonly_report(fx.stmts(lake))


@query("referenced_tables", REFS + "SELECT * FROM refs")
def referenced_tables(lake):
    return sqltext.referenced_tables(fx.stmts(lake))


@query("ordered_distinct", REFS + """
    SELECT schema_name, table_name, arg_min(stmt_id, (stmt_id, position)) AS first_stmt,
           arg_min(position, (stmt_id, position)) AS first_position FROM refs GROUP BY ALL
""")
def ordered_distinct(lake):
    return lineage.ordered_distinct(sqltext.referenced_tables(fx.stmts(lake)))


@query("scope_filter", REFS + f"SELECT * FROM refs WHERE {ALLOWED}")
def scope_filter(lake):
    return filters.scope_filter(sqltext.referenced_tables(fx.stmts(lake)), fx.SCOPE, "schema_name", "table_name")


@query("scope_verdict", REFS + f"""
    , d AS (SELECT stmt_id, string_agg(schema_name || '.' || table_name, ', ' ORDER BY schema_name, table_name) AS denied_tables
            FROM refs WHERE NOT {ALLOWED} GROUP BY stmt_id)
    SELECT event_id AS stmt_id, denied_tables IS NULL AS allowed, denied_tables
    FROM events LEFT JOIN d ON d.stmt_id = event_id
""")
def scope_verdict(lake):
    return guard.scope_verdict(fx.stmts(lake), fx.SCOPE)


# Statements with comma joins, aliases as targets and unreadable ends; verdicts written down by hand.
TRICKY = (
    ("SELECT * FROM sales.a x, secret.b y WHERE x.i = y.i", False, "secret.b"),
    ("UPDATE t SET q = 1 FROM sales.stock t", True, None),
    ("DELETE t FROM hr.staff AS t, sales.gone g WHERE t.i = g.i", False, "hr.staff"),
    ("SELECT * FROM (SELECT i FROM sales.a, nation n) d, (sales.b JOIN secret.c ON 1 = 1)", False, "secret.c"),
    ("SELECT * FROM sales.a JOIN sales.b USING (i), dbo.regions", True, None),
    ("SELECT EXTRACT(YEAR FROM sold), 'it''s' FROM sales.a", True, None),
    ("SELECT * FROM sales.a WHERE note = 'open", False, "(unreadable statement)"),
    ("WITH c(i) AS (SELECT i FROM sales.a) SELECT * FROM c, secret.d", False, "secret.d"),
)


@query("scope_verdict_lists", f"""
    WITH v AS (SELECT * FROM (VALUES {", ".join(f"({i}, {str(ok).lower()}, {'NULL' if no is None else _q(no)})" for i, (_, ok, no) in enumerate(TRICKY))})
               AS v(form, allowed, denied_tables))
    SELECT event_id AS stmt_id, allowed, denied_tables FROM events JOIN v ON form = event_id % 8
""")
def scope_verdict_lists(lake):
    texts = F.element_at(F.array(*[F.lit(text) for text, _, _ in TRICKY]), (F.col("event_id") % 8 + 1).cast("int"))
    statements = lake.table("events").select(F.col("event_id").alias("stmt_id"), texts.alias("sql_text"))
    return guard.scope_verdict(statements, fx.SCOPE)


EDGES = """
    WITH e AS (SELECT * FROM (VALUES (1, 'read_with', 'dbo.customer', 'sales.orders'),
        (3, 'read_with', 'sales.orders', 'dbo.regions'), (4, 'writes_from', 'dbo.target', 'dbo.other'),
        (7, 'writes_from', 'dbo.inventory', 'dbo.src')) AS v(form, edge, from_table, to_table)),
    edges AS (SELECT edge, from_table, to_table, count(*) AS statements
              FROM events JOIN e ON form = event_id % 8 GROUP BY ALL)
"""


@query("dependency_edges", EDGES + "SELECT * FROM edges")
def dependency_edges(lake):
    return lineage.table_edges(fx.stmts(lake))


# Statements of several writes and reads; pairs written down by hand.
PAIRED = (
    ("INSERT INTO dbo.a SELECT * FROM dbo.b; INSERT INTO dbo.c SELECT * FROM dbo.d", (("writes_from", "dbo.a", "dbo.b"), ("writes_from", "dbo.c", "dbo.d"))),
    ("SELECT * FROM dbo.x JOIN dbo.y ON 1 = 1 JOIN dbo.z ON 1 = 1", (("read_with", "dbo.x", "dbo.y"), ("read_with", "dbo.x", "dbo.z"), ("read_with", "dbo.y", "dbo.z"))),
    ("WITH q AS (SELECT * FROM dbo.s) INSERT INTO dbo.t SELECT * FROM q JOIN dbo.u ON 1 = 1", (("writes_from", "dbo.t", "dbo.s"), ("writes_from", "dbo.t", "dbo.u"))),
    ("INSERT INTO dbo.a SELECT * FROM dbo.a JOIN dbo.b ON 1 = 1", (("writes_from", "dbo.a", "dbo.b"),)),
    ("SELECT * FROM dbo.x l JOIN dbo.x r ON 1 = 1", ()),
)


@query("dependency_pairs", f"""
    WITH e AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{e}', '{a}', '{b}')" for i, (_, edges) in enumerate(PAIRED) for e, a, b in edges)})
               AS v(form, edge, from_table, to_table))
    SELECT edge, from_table, to_table, count(*) AS statements FROM events JOIN e ON form = event_id % {len(PAIRED)} GROUP BY ALL
""")
def dependency_pairs(lake):
    texts = F.element_at(F.array(*[F.lit(text) for text, _ in PAIRED]), (F.col("event_id") % len(PAIRED) + 1).cast("int"))
    return lineage.table_edges(lake.table("events").select(F.col("event_id").alias("stmt_id"), texts.alias("sql_text")))


@query("dependency_graph", EDGES + f"""
    , refs AS (SELECT schema_name || '.' || table_name AS table_name, count(*) AS statements
               FROM events JOIN ({EXPECTED_REFS}) ON form = event_id % 8 GROUP BY 1)
    SELECT table_name, statements, (SELECT count(*) FROM edges WHERE from_table = table_name) AS depends_on,
           (SELECT count(*) FROM edges WHERE to_table = table_name) AS used_by FROM refs
""")
def dependency_graph(lake):
    return lineage.dependency_degrees(fx.stmts(lake))


@query("dependency_union", EDGES + """
    SELECT 'referencing' AS direction, from_table AS entity, statements, NULL::VARCHAR AS kind
    FROM edges WHERE to_table = 'sales.orders'
    UNION ALL SELECT 'referenced', to_table, statements, edge FROM edges WHERE from_table = 'sales.orders'
""")
def dependency_union(lake):
    return lineage.dependency_union(lineage.table_edges(fx.stmts(lake)), "sales.orders")


@query("name_parse", """
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN 'sales' WHEN 1 THEN 'reporting' WHEN 2 THEN 'dbo' WHEN 4 THEN 'dbo' END AS schema_name,
      CASE event_id % 6 WHEN 0 THEN 'T' || user_id WHEN 1 THEN 'Daily ' || user_id WHEN 2 THEN 'T' || user_id
                        WHEN 4 THEN 'T' || user_id END AS table_name,
      CASE event_id % 6 WHEN 3 THEN 'half of the name is blank' WHEN 5 THEN 'name is required' END AS error
    FROM events
""")
def name_parse(lake):
    user = F.col("user_id").cast("string")
    form = F.col("event_id") % 6
    text = (
        F.when(form == 0, F.concat(F.lit("sales.T"), user))
        .when(form == 1, F.concat(F.lit(" [reporting] . [Daily "), user, F.lit("]")))
        .when(form == 2, F.concat(F.lit("T"), user))
        .when(form == 3, F.concat(F.lit("[ ].T"), user))
        .when(form == 4, F.concat(F.lit("[T"), user, F.lit("]")))
        .otherwise(F.lit("  "))
    )
    return lake.table("events").select("event_id", names.parse_name(text).alias("n")).select("event_id", "n.*")


NAMES = """
    WITH n AS ({rows}),
    h AS (SELECT name, count(*) AS uses, regexp_matches(name, '^[A-Za-z_][A-Za-z0-9_]*$') AS valid,
                 '[' || replace(name, ']', ']]') || ']' AS quoted_name,
                 regexp_replace(name, '[^A-Za-z0-9_]', '', 'g') AS label FROM n GROUP BY name)
"""
ALL_NAMES = """SELECT p_name AS name FROM part UNION ALL SELECT url FROM pages UNION ALL SELECT event_type FROM events"""


def _names(lake):
    return (
        lake.table("part").select(F.col("p_name").alias("name"))
        .unionAll(lake.table("pages").select("url"))
        .unionAll(lake.table("events").select("event_type"))
    )


@query("name_hygiene", NAMES.format(rows=ALL_NAMES) + "SELECT * FROM h")
def name_hygiene(lake):
    return names.name_hygiene(_names(lake), "name")


@query("name_hygiene_summary", NAMES.format(rows=ALL_NAMES) + """
    SELECT count(*) AS names, count(*) FILTER (WHERE NOT valid) AS invalid_names,
           count(*) FILTER (WHERE label IN (SELECT label FROM h GROUP BY label HAVING count(*) > 1)) AS colliding_names
    FROM h
""")
def name_hygiene_summary(lake):
    return names.hygiene_summary(names.name_hygiene(_names(lake), "name"))


@query("compact_text", f"""
    WITH c AS (SELECT doc_id, trim(regexp_replace(text, {_q(formats.WHITE_SPACE)}, ' ', 'g')) AS one, text FROM documents)
    SELECT doc_id, CASE WHEN length(one) > 240 THEN left(one, 240) || '…' ELSE one END AS compact,
           left(replace(replace(text, chr(13), ' '), chr(10), ' '), 220) AS one_line FROM c
""")
def compact_text(lake):
    text = F.col("text")
    return lake.table("documents").select(
        "doc_id", formats.compact_text(text).alias("compact"), formats.one_line(text).alias("one_line")
    )


@query("redaction_tokens", """
    SELECT conv_id, turn, '[REDACTED_PROMPT:' || left(sha256(text), 12) || ']' AS prompt_token,
           '[REDACTED_SQL:' || left(sha256(text), 12) || ']' AS sql_token, 'sha256:' || sha256(text) AS anonymous_hash
    FROM conversations
""")
def redaction_tokens(lake):
    text = F.col("text")
    return lake.table("conversations").select(
        "conv_id", "turn",
        redaction.mark("PROMPT", text).alias("prompt_token"),
        redaction.mark("SQL", text).alias("sql_token"),
        redaction.anonymous_hash(text).alias("anonymous_hash"),
    )


@query("storage_mode", """
    SELECT conv_id, turn, CASE WHEN role = 'user' THEN 'raw_opt_in' ELSE 'hashed_redacted' END AS prompt_storage_mode,
           CASE WHEN role = 'user' THEN text END AS prompt, sha256(text) AS prompt_sha256 FROM conversations
""")
def storage_mode(lake):
    opted_in = F.col("role") == "user"
    return lake.table("conversations").select(
        "conv_id", "turn",
        redaction.storage_mode(opted_in).alias("prompt_storage_mode"),
        F.when(opted_in, F.col("text")).alias("prompt"),
        redaction.digest(F.col("text")).alias("prompt_sha256"),
    )


@query("caller_identity", """
    SELECT DISTINCT user_id, 'user-' || user_id AS subject, 'user-' || user_id AS api_caller FROM events
    UNION ALL SELECT DISTINCT -user_id - 1, NULL, 'system:local' FROM events
""")
def caller_identity(lake):
    good = fx.tokens(lake)
    # The same tokens without their last part, cut inside the payload.
    bad = good.select(
        (-F.col("user_id") - 1).alias("user_id"),
        F.when(F.col("user_id") % 2 == 0, F.substring_index("token", ".", 2))
        .otherwise(F.regexp_replace("token", r"\.[^.]{6}", ".!")).alias("token"),
    )
    subject = redaction.token_subject(F.col("token"))
    return good.unionByName(bad).select(
        "user_id", subject.alias("subject"), redaction.caller_identity(subject).alias("api_caller")
    )


@query("redact_sensitive_keys", """
    SELECT event_id, '{"user":' || user_id || ',"cfg":{"Password":"[redacted]","items":[{"api_key":"[redacted]","n":1},"plain"]}}' AS body
    FROM events
""")
def redact_sensitive_keys(lake):
    return fx.deep_json(lake).select("event_id", redaction.redact_json(F.col("body")).alias("body"))


@query("redact_typed_keys", """
    SELECT c_custkey, '[redacted]' AS token, c_name AS owner, '[redacted]' AS api_key, c_mktsegment AS segment FROM customer
""")
def redact_typed_keys(lake):
    holder = F.struct(
        F.col("c_name").alias("Token"),
        F.struct(F.col("c_name").alias("owner")).alias("inner"),
        F.create_map(F.lit("API_KEY"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment")).alias("attrs"),
    )
    rows = lake.table("customer").select("c_custkey", holder.alias("h"))
    clean = rows.select("c_custkey", redaction.redact_struct(F.col("h"), rows.schema["h"].dataType).alias("h"))
    return clean.select(
        "c_custkey", F.col("h.Token").alias("token"), F.col("h.inner.owner").alias("owner"),
        F.col("h.attrs")["API_KEY"].alias("api_key"), F.col("h.attrs")["segment"].alias("segment"),
    )


@query("redact_text", f"""
    SELECT doc_id, regexp_replace(text, '(?i)\\b({"|".join(redaction.SENSITIVE_KEYS)})(\\s*[=:]\\s*)"[^"]*"',
           '\\1\\2"[redacted]"', 'g') AS text FROM documents
""")
def redact_text(lake):
    return lake.table("documents").select("doc_id", redaction.redact_text(F.col("text")).alias("text"))


AUDIT_SQL = f"""
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS timestamp,
      'query_execution' AS event, 'run_query' AS tool, 'lake' AS database,
      CASE WHEN user_id % 10 = 0 THEN 'system:local' ELSE 'user-' || user_id END AS api_caller,
      '[REDACTED_SQL:' || left(sha256(sql_text), 12) || ']' AS redacted_sql, sha256(sql_text) AS sql_sha256,
      'sha256:' || sha256(sql_text) AS sql_anonymized_hash, sha256(text) AS prompt_sha256,
      '[REDACTED_PROMPT:' || left(sha256(text), 12) || ']' AS prompt_redaction_token,
      'hashed_redacted' AS prompt_storage_mode, 'reader' AS db_user
    FROM ({STMTS}) s LEFT JOIN conversations ON conv_id = stmt_id AND turn = 0
"""


def audited(lake):
    """Statements as executed queries; the first turn of a conversation is the prompt."""
    prompts = lake.table("conversations").where("turn = 0").select(F.col("conv_id").alias("stmt_id"), "text")
    rows = fx.stmts(lake).join(prompts, "stmt_id", "left")
    caller = F.when(F.col("user_id") % 10 == 0, "unknown").otherwise(F.concat(F.lit(" user-"), F.col("user_id")))
    return sinks.audit_records(
        rows, tool="run_query", database="lake", sql=F.col("sql_text"), prompt=F.col("text"), caller=caller,
        at=formats.iso_text(F.col("ts")), db_user="reader",
    )


@query("audit_sink", AUDIT_SQL)
def audit_sink(lake):
    records = audited(lake)
    path = session.work_path(lake.spark, "audit")
    sinks.append_audit(records, path)
    return sinks.read_audit(lake.spark, path, records.schema)
