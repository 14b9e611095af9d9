"""Tables derived from the base tables: the inputs the analyses need.

The texts run unchanged in Spark and in DuckDB once the placeholder tables are
filled in; the oracle queries use them as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.sources.tables import Lake

STMTS = """
SELECT event_id AS stmt_id, ts, user_id,
  CASE event_id % 8
    WHEN 0 THEN concat('SELECT * FROM sales.orders WHERE o_orderkey = ', CAST(event_id AS VARCHAR(20)))
    WHEN 1 THEN concat('/* drop table x */ SELECT 1 -- delete', chr(10), ' FROM [dbo].[customer] c JOIN sales.orders o ON 1 = 1')
    WHEN 2 THEN concat('UPDATE sales.customers SET city = ', chr(39), 'X', chr(39), ' WHERE id = ', CAST(user_id AS VARCHAR(20)))
    WHEN 3 THEN 'WITH a AS (SELECT * FROM sales.orders), b(x) AS (SELECT 1 FROM dbo.regions) SELECT * FROM a JOIN b ON 1 = 1'
    WHEN 4 THEN 'DELETE t FROM dbo.target t JOIN dbo.other o ON o.id = t.id'
    WHEN 5 THEN concat('INSERT INTO sales.orders (id) VALUES (', CAST(event_id AS VARCHAR(20)), ')')
    WHEN 6 THEN concat('SELECT ', chr(39), 'drop table y', chr(39), ' AS s FROM nation')
    ELSE 'MERGE INTO dbo.inventory AS t USING dbo.src AS s ON t.id = s.id WHEN MATCHED THEN UPDATE SET t.q = s.q'
  END AS sql_text
FROM {events}
"""

SCOPE = ("sales.*", "dbo.regions", "*.nation")

WORKLOAD = """
SELECT concat(event_type, '#', CAST(user_id % 20 AS VARCHAR(9))) AS query_id, event_id, ts,
       value AS duration_ms, CAST(round(value) AS BIGINT) AS logical_reads, value * 0.5 AS cpu_ms
FROM {events}
"""

TOOLLOG = """
SELECT event_id AS invocation_id, concat('tool_', event_type) AS tool, ts, 'tool.start' AS phase,
       CAST(NULL AS BIGINT) AS elapsed_ms, CAST(NULL AS VARCHAR(99)) AS error_text, CAST(NULL AS BIGINT) AS result_rows
FROM {events}
UNION ALL
SELECT event_id, concat('tool_', event_type), ts,
       CASE WHEN event_type = 'error' THEN 'tool.error' ELSE 'tool.success' END, CAST(round(value * 10) AS BIGINT),
       CASE WHEN event_type = 'error' THEN concat('no answer to call ', CAST(event_id AS VARCHAR(20))) END,
       CASE WHEN event_type <> 'error' THEN event_id % 100 END
FROM {events} WHERE event_id % 13 <> 0
"""

PLANS = """
SELECT p_partkey AS plan_id, concat('<ShowPlanXML><RelOp PhysicalOp="Sort" LogicalOp="Sort" EstimatedTotalSubtreeCost="0.',
  lpad(CAST(p_size AS VARCHAR(9)), 2, '0'),
  '"><RelOp PhysicalOp="Clustered Index Scan" LogicalOp="Scan" EstimatedTotalSubtreeCost="0.0',
  CAST(p_size % 10 AS VARCHAR(9)),
  '"><Object Schema="[dbo]" Table="[', p_type, ']"/></RelOp></RelOp></ShowPlanXML>') AS plan_xml
FROM {part}
"""

SOURCES = """
SELECT 1 AS instance, o_orderkey, o_custkey, o_totalprice FROM {orders} WHERE o_orderkey % 10 <> 3
UNION ALL
SELECT 2, o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END
FROM {orders} WHERE o_orderkey % 10 <> 4
"""

TOKENS_SPARK = """
SELECT user_id, concat('eyJhbGciOiJub25lIn0.', translate(rtrim('=', base64(CAST(
  concat('{{"sub":"user-', CAST(user_id AS STRING), '"}}') AS BINARY))), '+/', '-_'), '.sig') AS token
FROM (SELECT DISTINCT user_id FROM {events})
"""

TOKENS_DUCKDB = """
SELECT user_id, concat('eyJhbGciOiJub25lIn0.', translate(rtrim(base64(encode(
  concat('{{"sub":"user-', CAST(user_id AS VARCHAR), '"}}'))), '='), '+/', '-_'), '.sig') AS token
FROM (SELECT DISTINCT user_id FROM {events})
"""

DEEP_JSON = """
SELECT event_id, concat('{{"user":', CAST(user_id AS VARCHAR(20)), ',"cfg":{{"Password":"p',
  CAST(event_id AS VARCHAR(20)), '","items":[{{"api_key":"k","n":1}},"plain"]}}}}') AS body
FROM {events}
"""

def duck(text: str, *names: str) -> str:
    """A fixture text with DuckDB's view names in place of the placeholders."""
    return text.format(**{n: n for n in names}).strip()


def stmts(lake: Lake) -> DataFrame:
    return lake.sql(STMTS, "events")


def workload(lake: Lake) -> DataFrame:
    return lake.sql(WORKLOAD, "events")


def toollog(lake: Lake) -> DataFrame:
    return lake.sql(TOOLLOG, "events")


def plans(lake: Lake) -> DataFrame:
    return lake.sql(PLANS, "part")


def sources(lake: Lake) -> DataFrame:
    return lake.sql(SOURCES, "orders")


def tokens(lake: Lake) -> DataFrame:
    return lake.sql(TOKENS_SPARK, "events")


def deep_json(lake: Lake) -> DataFrame:
    return lake.sql(DEEP_JSON, "events")


def order_documents(lake: Lake) -> DataFrame:
    """A document per order with its lines, which are few by nature; an order without lines has none."""
    entry = F.struct("l_partkey", "l_returnflag")
    lines = lake.table("lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(F.sort_array(F.collect_list(entry)).alias("lines"))
    orders = lake.table("orders").select(
        F.col("o_orderkey").alias("orderkey"),
        F.struct(F.concat(F.lit("Order "), F.col("o_orderkey")).alias("name"), F.col("o_orderpriority").alias("segment")).alias("summary"),
    )
    none = F.array().cast("array<struct<l_partkey:bigint,l_returnflag:string>>")
    return orders.join(lines, "orderkey", "left").select("orderkey", "summary", F.coalesce("lines", none).alias("lines"))


ORDER_DOCUMENTS = """
SELECT o_orderkey AS orderkey, {'name': 'Order ' || o_orderkey, 'segment': o_orderpriority} AS summary, coalesce(lines, []) AS lines
FROM orders LEFT JOIN (
  SELECT l_orderkey, list({'l_partkey': l_partkey, 'l_returnflag': l_returnflag} ORDER BY l_partkey, l_returnflag) AS lines
  FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""
