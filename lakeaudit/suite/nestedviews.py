"""Nested rows: projection, cuts, budgets, pages and views; plan documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeaudit import fixtures as fx
from lakeaudit.operators import documents, layout, nested, profile, workload
from lakeaudit.operators.small import settle
from lakeaudit.plans import documents as plans
from lakeaudit.suite import health
from lakeaudit.suite.registry import query
from lakeaudit.functions import formats
from lakeaudit.functions.numbers import half_up_sql as hu
from lakeaudit.functions.numbers import mean_sql
from lakeaudit.suite.texts import _q

DOCS = fx.ORDER_DOCUMENTS.strip()
# Lists and structs are compared as text or counts, which every engine prints alike.
KEYS_TEXT = "array_to_string(list_transform({0}, lambda x: CAST(x.l_partkey AS VARCHAR)), ',')"


def _keys_text(column: str):
    return F.array_join(F.transform(F.col(column), lambda x: x["l_partkey"].cast("string")), ",")


@query("field_projection", f"""
    SELECT orderkey, summary.segment AS segment, CASE WHEN len(lines) > 0 THEN {KEYS_TEXT.format('lines')} END AS part_keys, 1 AS line_fields, 1 AS summary_fields
    FROM ({DOCS})
""")
def field_projection(lake):
    rows = nested.field_projection(fx.order_documents(lake), "orderkey, summary.segment, lines.l_partkey, no.such.path")
    width = len(rows.schema["lines"].dataType.elementType.names)
    return rows.select(
        "orderkey", F.col("summary.segment").alias("segment"), _keys_text("lines").alias("part_keys"),
        F.lit(width).alias("line_fields"), F.lit(len(rows.schema["summary"].dataType.names)).alias("summary_fields"),
    )


@query("token_estimate", """
    SELECT 'nation' AS t, n_nationkey AS k, greatest(1, length('{"n_nationkey": ' || n_nationkey || ', "n_name": "' || n_name
        || '", "n_regionkey": ' || n_regionkey || '}') // 4) AS tokens FROM nation
    UNION ALL SELECT 'part', p_partkey, greatest(1, length('{"p_partkey": ' || p_partkey || ', "p_name": "' || p_name
        || '", "p_size": ' || p_size || '}') // 4) FROM part
""")
def token_estimate(lake):
    nation = nested.token_estimate(lake.table("nation"))
    part = nested.token_estimate(lake.table("part").select("p_partkey", "p_name", "p_size"))
    return nation.select(F.lit("nation").alias("t"), F.col("n_nationkey").cast("long").alias("k"), "tokens").unionAll(
        part.select(F.lit("part"), "p_partkey", "tokens")
    )


@query("shrink_lists", f"""
    SELECT orderkey, {KEYS_TEXT.format('lines[1:3]')} AS part_keys FROM ({DOCS})
""")
def shrink_lists(lake):
    return nested.shrink_lists(fx.order_documents(lake), 3).select("orderkey", _keys_text("lines").alias("part_keys"))


BUDGET = 60


def _doc_tokens(n: str) -> str:
    """Tokens of a document with its first n lines, from the text it would have."""
    items = f"lines[1:{n}]"
    return f"""greatest(1, (length('{{"orderkey": ' || orderkey || ', "summary": {{"name": "'
      || summary.name || '", "segment": "' || summary.segment || '"}}, "lines": [' || array_to_string(list_transform({items},
      lambda x: '{{"l_partkey": ' || x.l_partkey || ', "l_returnflag": "' || x.l_returnflag || '"}}'), ', ') || ']}}')) // 4)"""


STEPS = ", ".join(f"{_doc_tokens(str(n))} AS t{n}" for n in nested.LADDER)
STEP_CASE = " ".join(f"WHEN t{n} <= {BUDGET} THEN {n}" for n in nested.LADDER)
SIZE_CASE = " ".join(f"WHEN t{n} <= {BUDGET} THEN t{n}" for n in nested.LADDER)


def _budget_sql(budget: int) -> str:
    step = STEP_CASE.replace(f"<= {BUDGET}", f"<= {budget}")
    size = SIZE_CASE.replace(f"<= {BUDGET}", f"<= {budget}")
    return f"""
    WITH d AS (SELECT *, {_doc_tokens('1000000')} AS full_size, {STEPS} FROM ({DOCS})),
    s AS (SELECT *, CASE WHEN full_size <= {budget} THEN -1 {step} ELSE 0 END AS most,
                 CASE WHEN full_size <= {budget} THEN full_size {size} ELSE full_size END AS size FROM d)
    SELECT orderkey AS doc_key, CASE WHEN most <> 0 THEN {KEYS_TEXT.format('lines[1:CASE WHEN most = -1 THEN 1000000 ELSE most END]')} END AS part_keys,
      CASE WHEN most <> 0 THEN summary.name END AS name, CASE WHEN most = 0 THEN summary.name END AS original_name,
      CASE WHEN most <> -1 THEN size END AS estimated_tokens, CASE WHEN most <> -1 THEN CAST(most AS BIGINT) END AS list_max_items
    FROM s"""


def _budgeted(lake, budget):
    docs = fx.order_documents(lake)
    keyed = nested.token_budget(docs, budget)
    return keyed.select(
        F.coalesce("orderkey", F.regexp_extract("original_summary.name", r"(\d+)$", 1).cast("long")).alias("doc_key"),
        _keys_text("lines").alias("part_keys"),
        F.col("summary.name").alias("name"),
        F.col("original_summary.name").alias("original_name"),
        F.col("_truncation.estimated_tokens").alias("estimated_tokens"),
        F.col("_truncation.list_max_items").alias("list_max_items"),
    )


@query("token_budget", _budget_sql(BUDGET))
def token_budget(lake):
    return _budgeted(lake, BUDGET)


@query("token_budget_tight", _budget_sql(36))
def token_budget_tight(lake):
    return _budgeted(lake, 36)


@query("context_pack", """
    WITH t AS (SELECT conv_id, turn, greatest(1, length(CAST(to_json(text) AS VARCHAR)) // 4) AS tokens FROM conversations),
    r AS (SELECT *, CAST(sum(tokens) OVER (PARTITION BY conv_id ORDER BY turn) AS BIGINT) AS running_tokens FROM t)
    SELECT *, running_tokens <= 400 AS fits FROM r
""")
def context_pack(lake):
    return nested.context_pack(lake.table("conversations"), "conv_id", "turn", "text", 400)


@query("paged_nested_lists", f"""
    WITH d AS (SELECT *, len(lines) AS total, greatest(1, CAST(ceil(len(lines) / 4.0) AS BIGINT)) AS pages FROM ({DOCS})),
    p AS (SELECT *, least(3, pages) AS page FROM d)
    SELECT orderkey, {KEYS_TEXT.format('lines[(page - 1) * 4 + 1 : page * 4]')} AS part_keys, 3 AS asked_page,
      page, 4 AS page_size, total AS total_items, pages AS total_pages FROM p
""")
def paged_nested_lists(lake):
    rows = nested.page_lists(fx.order_documents(lake), 3, 4)
    block = F.col("_pagination.lists")["root.lines"]
    return rows.select(
        "orderkey", _keys_text("lines").alias("part_keys"), F.col("_pagination.page").alias("asked_page"),
        *[block[c].alias(c) for c in ("page", "page_size", "total_items", "total_pages")],
    )


@query("shaped_result", f"""
    WITH d AS (SELECT *, {_doc_tokens('1000000')} AS full_size, {STEPS} FROM ({DOCS})),
    s AS (SELECT *, CASE WHEN full_size <= {BUDGET} THEN 1000000 {STEP_CASE} ELSE 0 END AS most FROM d),
    c AS (SELECT *, lines[1:most] AS cut FROM s)
    SELECT CASE WHEN most > 0 THEN orderkey END AS orderkey, CASE WHEN len(cut) > 0 THEN {KEYS_TEXT.format('cut[1:2]')} END AS part_keys,
      nullif(len(cut), 0) AS total_items FROM c
""")
def shaped_result(lake):
    """Budget, projection and page in this order: the page counts what the budget left."""
    rows = nested.shape_result(fx.order_documents(lake), BUDGET, "orderkey,lines.l_partkey", 1, 2)
    return rows.select(
        "orderkey", _keys_text("lines").alias("part_keys"),
        F.col("_pagination.lists")["root.lines"]["total_items"].alias("total_items"),
    )


STMTS = fx.duck(fx.STMTS, "events")
TEXT_LOG = f"""
    WITH l AS (SELECT event_type || '#' || CAST(events.user_id % 20 AS VARCHAR) AS query_id, value,
                      s.sql_text, event_id FROM events JOIN ({STMTS}) s ON stmt_id = event_id),
    top AS (SELECT query_id, {hu(mean_sql('value'), 4)} AS metric_value, count(*) AS count_executions,
                   arg_min(sql_text, event_id) AS query_sql_text FROM l GROUP BY query_id
            ORDER BY metric_value DESC, query_id LIMIT 10)
"""


def _top_with_text(lake):
    log = fx.workload(lake)
    first = log.join(fx.stmts(lake).select(F.col("stmt_id").alias("event_id"), "sql_text"), "event_id").groupBy("query_id").agg(
        F.min_by("sql_text", "event_id").alias("query_sql_text")
    )
    return workload.top_queries(log, "duration").join(first, "query_id").drop("last_execution_time")


@query("result_views_top_queries", TEXT_LOG + f"""
    SELECT query_id, metric_value, count_executions, CASE WHEN length(one) > 240 THEN left(one, 240) || '…' ELSE one END AS query_sql_text
    FROM (SELECT *, trim(regexp_replace(query_sql_text, {_q(formats.WHITE_SPACE)}, ' ', 'g')) AS one FROM top)
""")
def result_views_top_queries(lake):
    return nested.top_queries_view(_top_with_text(lake), "standard")


@query("result_views_top_summary", TEXT_LOG + """
    SELECT count(*) AS queries, max(metric_value) AS highest_metric, CAST(sum(count_executions) AS BIGINT) AS count_executions FROM top
""")
def result_views_top_summary(lake):
    return nested.top_queries_view(_top_with_text(lake), "summary")


HEALTH = ("orders", "lineitem", "part", "events")


def health_documents(lake):
    specs = [s for s in health.SPECS if s.table in HEALTH]
    profiled = settle(health._profiles(lake, HEALTH, profile.RANGE))
    fragmentation = settle(layout.fragmentation({s.table: lake.table(s.table) for s in specs}, specs))
    rels = settle(health._named(lake).where(F.col("parent_table").isin(*HEALTH)))
    issues = layout.access_path_advice(rels, fragmentation).where("issue IS NOT NULL")
    return documents.table_health(profiled, fragmentation, rels, profile.column_advice(profiled), issues)


HEALTH_LIST = "('" + "', '".join(HEALTH) + "')"


@query("result_views_health_summary", health.RELS + f"""
    , frag AS ({health.FRAG} SELECT * FROM frag), p AS ({health.profile_sql(HEALTH, False)}),
    s AS (SELECT *, {health.SMALLEST} AS small FROM p),
    own AS (SELECT * FROM rels WHERE same_name)
    SELECT t AS table_name, (SELECT max(row_count) FROM p WHERE table_name = t) AS row_count,
      (SELECT count(*) FROM p WHERE table_name = t) AS columns,
      (SELECT count(*) FROM frag WHERE table_name = t) AS indexes_count,
      (SELECT count(*) FROM own WHERE parent_table = t) AS foreign_keys_count,
      (SELECT count(*) FROM p WHERE table_name = t) AS statistics_count,
      (SELECT count(*) FROM own LEFT JOIN frag ON table_name = parent_table AND column_name = parent_column
        WHERE parent_table = t AND coalesce(avg_fragmentation_in_percent, 100) > 10) AS constraint_issues_count,
      (SELECT count(*) FROM s WHERE table_name = t AND ((data_type = 'string' AND max_length > 255) OR (null_count = 0 AND
        ((data_type = 'int' AND small IN ('TINYINT', 'SMALLINT')) OR (data_type = 'bigint' AND small <> 'BIGINT'))))) AS recommendations_count
    FROM (SELECT unnest({list(HEALTH)}) AS t)
""")
def result_views_health_summary(lake):
    docs = nested.table_health_view(health_documents(lake), "summary")
    return docs.select("table_name", "table_info.*", "health_summary.*")


@query("result_views_health_standard", f"""
    WITH frag AS ({health.FRAG} SELECT * FROM frag WHERE table_name IN {HEALTH_LIST})
    SELECT table_name, (SELECT string_agg(index_name, ',' ORDER BY index_name) FROM frag f WHERE f.table_name = c.table_name) AS indexes,
      string_agg(column_name, ',' ORDER BY ordinal) FILTER (WHERE ordinal <= 10) AS statistics
    FROM ({health.profile_sql(HEALTH, False)}) c GROUP BY table_name
""")
def result_views_health_standard(lake):
    docs = nested.table_health_view(health_documents(lake), "standard")
    return docs.select(
        "table_name", F.array_join(F.col("indexes.index_name"), ",").alias("indexes"),
        F.array_join(F.col("statistics_sample.column_name"), ",").alias("statistics"),
    )


@query("result_views_model_summary", health.RELS + health.ISSUES + f"""
    , own AS (SELECT * FROM rels WHERE same_name)
    SELECT {len(health.ENTITIES)} AS entities, (SELECT count(*) FROM own) AS relationships, (SELECT count(*) FROM issues) AS issues,
      (SELECT string_agg(constraint_name, ',' ORDER BY constraint_name) FROM (SELECT * FROM own ORDER BY constraint_name LIMIT 10)) AS sample,
      (SELECT least(count(*), 5) FROM issues WHERE category = 'relationships') AS relationship_notes
""")
def result_views_model_summary(lake):
    view = nested.logical_model_view(documents.model_document(*health._model(lake)), "summary")
    return view.select(
        *[F.col(f"summary.{c}").cast("long").alias(c) for c in ("entities", "relationships", "issues")],
        F.array_join(F.col("sample_relationships.constraint_name"), ",").alias("sample"),
        F.size(F.col("recommendations")["relationships"]).cast("long").alias("relationship_notes"),
    )


@query("result_views_model_standard", health.RELS + health.ISSUES + f"""
    , a AS (SELECT table_name, ordinal, column_name FROM ({health.profile_sql(health.ENTITIES, False)}) WHERE ordinal <= 12)
    SELECT table_name AS entity, string_agg(column_name, ',' ORDER BY ordinal) AS attributes,
      (SELECT least(count(*), 12) FROM issues WHERE category = 'relationships') AS relationship_issues
    FROM a GROUP BY table_name
""")
def result_views_model_standard(lake):
    view = nested.logical_model_view(documents.model_document(*health._model(lake)), "standard")
    issues = F.size(F.col("issues")["relationships"]).cast("long")
    return view.select(F.explode("entities").alias("e"), issues.alias("relationship_issues")).select(
        F.col("e.entity_name").alias("entity"), F.array_join(F.col("e.attributes.column_name"), ",").alias("attributes"),
        "relationship_issues",
    )


@query("table_health_result", f"""
    WITH frag AS ({health.FRAG} SELECT * FROM frag WHERE table_name IN {HEALTH_LIST}),
    r AS (SELECT *, row_number() OVER (PARTITION BY table_name ORDER BY index_name) AS rn, count(*) OVER (PARTITION BY table_name) AS n FROM frag)
    SELECT table_name, string_agg(index_name, ',' ORDER BY index_name) FILTER (WHERE rn <= 2) AS indexes,
      2 AS page_size, max(n) AS total_items, CAST(ceil(max(n) / 2.0) AS BIGINT) AS total_pages FROM r GROUP BY table_name
""")
def table_health_result(lake):
    """The whole way of a health request: view, budget, projection, then the first page."""
    docs = nested.table_health_view(health_documents(lake), "standard")
    page = nested.shape_result(docs, 100_000, "table_name,indexes.index_name", 1, 2)
    block = F.col("_pagination.lists")["root.indexes"]
    return page.select(
        "table_name", F.array_join(F.col("indexes.index_name"), ",").alias("indexes"),
        *[block[c].alias(c) for c in ("page_size", "total_items", "total_pages")],
    )


# The oracle takes the nodes from the part columns and reads no document.
NODES = """
    WITH nodes AS (
      SELECT p_partkey AS plan_id, CAST(1 AS BIGINT) AS node_id, NULL::BIGINT AS parent_id, 'Sort' AS physical_op, 'Sort' AS logical_op,
        'dbo.' || p_type AS object_name, CAST('0.' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS DOUBLE) AS cost FROM part
      UNION ALL SELECT p_partkey, 2, 1, 'Clustered Index Scan', 'Scan', 'dbo.' || p_type,
        CAST('0.0' || (p_size % 10) AS DOUBLE) FROM part)
"""


@query("plan_nodes", NODES + "SELECT *, NULL::VARCHAR AS predicate, 'ok' AS status FROM nodes")
def plan_nodes(lake):
    nodes = plans.plan_nodes(fx.plans(lake))
    return nodes.select("plan_id", "status", "node_id", "parent_id", "physical_op", "logical_op", "object_name", "cost", "predicate")


BAND = "CASE WHEN cost > 0.5 THEN 'red' WHEN cost > 0.1 THEN 'amber' ELSE 'none' END"


@query("plan_cost_bands", NODES + f"SELECT plan_id, node_id, cost, {BAND} AS band FROM nodes")
def plan_cost_bands(lake):
    return plans.cost_bands(plans.plan_nodes(fx.plans(lake))).select("plan_id", "node_id", "cost", "band")


@query("plan_operator_costs", NODES + f"""
    SELECT physical_op, count(*) AS nodes, sum(CAST(cost AS DECIMAL(28,6))) AS total_cost,
      count(*) FILTER (WHERE {BAND} = 'red') AS red_nodes, count(*) FILTER (WHERE {BAND} = 'amber') AS amber_nodes
    FROM nodes GROUP BY physical_op ORDER BY total_cost DESC, physical_op LIMIT 10
""")
def plan_operator_costs(lake):
    return plans.operator_costs(plans.plan_nodes(fx.plans(lake)))
