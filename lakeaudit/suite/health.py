"""Profiles, layout, file health, keys, relationships and the logical model."""

from __future__ import annotations

from itertools import combinations, permutations

from pyspark.sql import functions as F

from lakeaudit import fixtures as fx
from lakeaudit import session
from lakeaudit.functions.numbers import half_up_sql as hu
from lakeaudit.functions.numbers import mean_sql
from lakeaudit.operators import aggregates, filters, inclusion, keysearch, layout, model, overlap, profile, sketchprofile, workload
from lakeaudit.operators.layout import LayoutSpec
from lakeaudit.operators.profile import Constraint
from lakeaudit.operators.small import settle
from lakeaudit.sources import footers, inventory, sinks
from lakeaudit.sources.tables import TABLES
from lakeaudit.suite.registry import query

# Columns of the base tables with their types, as the column dictionary lists them.
COLUMNS = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                 "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int", "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_type": "string", "p_size": "int",
             "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
               "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint", "l_linenumber": "int",
                 "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_tax": "double",
                 "l_returnflag": "string", "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}


def _cells(table: str, column: str, ordinal: int, kind: str, distinct: bool) -> str:
    number = kind in ("int", "bigint", "double")
    stamp = kind == "timestamp_ntz"
    shown = f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')" if stamp else column
    num = lambda f: f"CAST({f}({column}) AS DOUBLE)" if number else "NULL::DOUBLE"
    txt = lambda f: f"{f}({shown})" if stamp or kind == "string" else "NULL::VARCHAR"
    mean = hu(f"avg(CAST({column} AS DOUBLE))", 4) if number else "NULL::DOUBLE"
    length = f"max(length({column}))" if kind == "string" else f"max(len({column}))" if "array" in kind else "NULL"
    return f"""SELECT '{table}' AS table_name, {ordinal} AS ordinal, '{column}' AS column_name, '{kind}' AS data_type,
      count(*) AS row_count, count(*) - count({column}) AS null_count,
      {f'count(DISTINCT {column})' if distinct else 'NULL::BIGINT'} AS distinct_count,
      {num('min')} AS min_number, {num('max')} AS max_number, {mean} AS mean_number,
      {txt('min')} AS min_text, {txt('max')} AS max_text, CAST({length} AS INTEGER) AS max_length FROM {table}"""


def profile_sql(tables, distinct: bool) -> str:
    return "\nUNION ALL ".join(
        _cells(t, c, i, k, distinct) for t in tables for i, (c, k) in enumerate(COLUMNS[t].items(), 1)
    )


def _profiles(lake, tables, measures=profile.MEASURES, distinct="approx"):
    return profile.profiles({t: lake.table(t) for t in tables}, measures, distinct)


@query("table_profile", profile_sql(("customer", "orders", "documents"), True))
def table_profile(lake):
    return _profiles(lake, ("customer", "orders", "documents"), distinct="exact")


DICTIONARY = """
    SELECT table_name, ordinal, column_name, data_type, CASE WHEN null_count > 0 THEN 'YES' ELSE 'NO' END AS is_nullable,
      max_length, CASE data_type WHEN 'int' THEN 10 WHEN 'bigint' THEN 19 WHEN 'double' THEN 53 END AS numeric_precision,
      CASE WHEN data_type IN ('int', 'bigint') THEN 0 END AS numeric_scale, NULL::VARCHAR AS column_default FROM p
"""


@query("column_dictionary", f"WITH p AS ({profile_sql(TABLES, False)}) {DICTIONARY}")
def column_dictionary(lake):
    return profile.column_dictionary(_profiles(lake, TABLES, profile.SHAPE))


SMALLEST = """CASE WHEN min_number >= -128 AND max_number <= 127 THEN 'TINYINT'
  WHEN min_number >= -32768 AND max_number <= 32767 THEN 'SMALLINT'
  WHEN min_number >= -2147483648 AND max_number <= 2147483647 THEN 'INT' ELSE 'BIGINT' END"""


@query("column_advice", f"""
    WITH p AS ({profile_sql(TABLES, False)}), s AS (SELECT *, {SMALLEST} AS small FROM p)
    SELECT table_name, column_name, 'Low' AS severity,
      format('{{}}.{{}} holds texts of up to {{}} characters', table_name, column_name, max_length) AS recommendation
    FROM s WHERE data_type = 'string' AND max_length > 255
    UNION ALL SELECT table_name, column_name, 'Info', format('{{}}.{{}} fits {{}}', table_name, column_name, small)
    FROM s WHERE null_count = 0 AND row_count > 0 AND ((data_type = 'int' AND small IN ('TINYINT', 'SMALLINT'))
      OR (data_type = 'bigint' AND small <> 'BIGINT'))
""")
def column_advice(lake):
    return profile.column_advice(_profiles(lake, TABLES, profile.RANGE))


@query("inferred_ddl", f"""
    WITH p AS ({profile_sql(TABLES, False)}), t AS (
      SELECT table_name, ordinal, '    [' || column_name || '] ' || CASE
        WHEN data_type = 'string' AND max_length BETWEEN 1 AND 8000 THEN 'VARCHAR(' || max_length || ')'
        WHEN data_type = 'string' THEN 'VARCHAR(MAX)' WHEN data_type IN ('int', 'bigint') THEN {SMALLEST}
        WHEN data_type = 'double' THEN 'FLOAT' WHEN data_type = 'timestamp_ntz' THEN 'DATETIME2'
        ELSE 'NVARCHAR(MAX)' END || CASE WHEN null_count > 0 THEN ' NULL' ELSE ' NOT NULL' END AS line FROM p)
    SELECT table_name, 'CREATE TABLE [dbo].[' || table_name || '] (' || chr(10)
      || string_agg(line, ',' || chr(10) ORDER BY ordinal) || chr(10) || ');' AS ddl FROM t GROUP BY table_name
""")
def inferred_ddl(lake):
    return profile.inferred_ddl(_profiles(lake, TABLES, profile.RANGE))


SPECS = (
    LayoutSpec("orders", "o_orderkey", ("o_orderkey", "o_custkey", "o_orderdate")),
    LayoutSpec("events", "event_id", ("event_id", "user_id", "ts")),
    LayoutSpec("part", "p_partkey", ("p_partkey", "p_size")),
    LayoutSpec("lineitem", "l_orderkey", ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")),
    LayoutSpec("customer", "c_custkey", ("c_custkey", "c_nationkey")),
    LayoutSpec("labels", "doc_id", ("doc_id",)),
)


def _frag_sql(spec: LayoutSpec, column: str) -> str:
    kind = "CLUSTERED" if column == spec.position else "NONCLUSTERED"
    return f"""SELECT 'dbo' AS schema_name, '{spec.table}' AS table_name, 'ix_{spec.table}_{column}' AS index_name,
      '{column}' AS column_name, '{kind}' AS index_type,
      {hu("100 * CAST(broken AS DOUBLE) / page_count", 4)} AS avg_fragmentation_in_percent,
      page_count
      FROM (SELECT count(*) AS page_count, count(*) FILTER (WHERE lo < (SELECT max({column}) FROM {spec.table} b
              WHERE b.{spec.position} // {spec.page_rows} = page - 1)) AS broken
            FROM (SELECT {spec.position} // {spec.page_rows} AS page, min({column}) AS lo FROM {spec.table} GROUP BY 1))"""


FRAG = "WITH frag AS (" + "\nUNION ALL ".join(_frag_sql(s, c) for s in SPECS for c in s.columns) + ")\n"


def _fragmentation(lake):
    return layout.fragmentation({s.table: lake.table(s.table) for s in SPECS}, SPECS)


@query("layout_fragmentation", FRAG + "SELECT * FROM frag")
def layout_fragmentation(lake):
    return _fragmentation(lake)


STORED = (
    LayoutSpec("orders", None, ("o_orderkey", "o_custkey", "o_orderdate")),
    LayoutSpec("lineitem", None, ("l_orderkey", "l_shipdate"), 500),
    LayoutSpec("events", None, ("ts", "user_id")),
)


def _stored_sql(spec: LayoutSpec, column: str) -> str:
    """The test tables are one file each, which DuckDB reads in its own order."""
    return f"""SELECT 'dbo' AS schema_name, '{spec.table}' AS table_name, 'ix_{spec.table}_{column}' AS index_name,
      '{column}' AS column_name, 'NONCLUSTERED' AS index_type,
      {hu("100 * CAST(count(*) FILTER (WHERE lo < before) AS DOUBLE) / count(*)", 4)} AS avg_fragmentation_in_percent, count(*) AS page_count
      FROM (SELECT lo, lag(hi) OVER (ORDER BY page) AS before FROM (
        SELECT n // {spec.page_rows} AS page, min({column}) AS lo, max({column}) AS hi
        FROM (SELECT {column}, row_number() OVER () - 1 AS n FROM {spec.table}) GROUP BY 1))"""


@query("layout_stored_order", "\nUNION ALL ".join(_stored_sql(s, c) for s in STORED for c in s.columns))
def layout_stored_order(lake):
    return layout.fragmentation({s.table: lake.table(s.table) for s in STORED}, STORED)


@query("prev_page_compare", """
    WITH p AS (SELECT CAST(o_orderkey // 100 AS BIGINT) AS page, count(*) AS rows, min(o_orderdate) AS min_o_orderdate,
                      max(o_orderdate) AS max_o_orderdate FROM orders GROUP BY 1)
    SELECT *, lag(max_o_orderdate) OVER (ORDER BY page) AS prev_max_o_orderdate FROM p
""")
def prev_page_compare(lake):
    pages = layout.page_ranges(lake.table("orders"), "o_orderkey", ["o_orderdate"], 100)
    return layout.with_previous_page(pages, ["o_orderdate"])


@query("threshold_filter", FRAG + """
    SELECT * FROM frag WHERE page_count >= 100 AND avg_fragmentation_in_percent >= 10.0
""")
def threshold_filter(lake):
    return filters.fragmented(_fragmentation(lake))


@query("threshold_filter_schema", FRAG + """
    SELECT * FROM frag WHERE page_count >= 20 AND avg_fragmentation_in_percent >= 50.0 AND schema_name = 'dbo'
""")
def threshold_filter_schema(lake):
    return filters.fragmented(_fragmentation(lake), 20, 50.0, "DBO")


@query("top_fragmented", FRAG + """
    SELECT * FROM frag ORDER BY avg_fragmentation_in_percent DESC, table_name, index_name LIMIT 10
""")
def top_fragmented(lake):
    return layout.top_fragmented(_fragmentation(lake))


@query("severity_bands", FRAG + """
    SELECT count(*) FILTER (WHERE avg_fragmentation_in_percent >= 30) AS severe,
      count(*) FILTER (WHERE avg_fragmentation_in_percent >= 10 AND avg_fragmentation_in_percent < 30) AS medium,
      count(*) AS total FROM frag
""")
def severity_bands(lake):
    return aggregates.severity_bands(_fragmentation(lake))


@query("index_health", FRAG + """
    SELECT *, CASE WHEN avg_fragmentation_in_percent >= 30 THEN 'severe' WHEN avg_fragmentation_in_percent >= 10
        THEN 'medium' ELSE 'low' END AS severity,
      count(*) FILTER (WHERE avg_fragmentation_in_percent >= 30) OVER () AS severe,
      count(*) FILTER (WHERE avg_fragmentation_in_percent >= 10 AND avg_fragmentation_in_percent < 30) OVER () AS medium,
      count(*) OVER () AS total FROM frag
""")
def index_health(lake):
    return layout.index_health(_fragmentation(lake))


TOP_TABLES = """SELECT schema_name, table_name, max(avg_fragmentation_in_percent) AS max_fragmentation,
      CAST(sum(page_count) AS BIGINT) AS total_pages FROM frag GROUP BY schema_name, table_name
      ORDER BY max_fragmentation DESC, schema_name, table_name LIMIT 5"""


@query("fragmentation_by_table", FRAG + TOP_TABLES)
def fragmentation_by_table(lake):
    return layout.by_table(_fragmentation(lake))


WORKLOAD = fx.duck(fx.WORKLOAD, "events")
SLOW = f"""slow AS (SELECT query_id, {hu(mean_sql('duration_ms'), 4)} AS metric_value FROM ({WORKLOAD}) w GROUP BY query_id
      ORDER BY metric_value DESC, query_id LIMIT 10)"""


def _top_sql(value: str) -> str:
    return f"""SELECT query_id, {value} AS metric_value, count(*) AS count_executions,
      CAST(max(ts) AS VARCHAR) AS last_execution_time FROM ({WORKLOAD}) w GROUP BY query_id
      ORDER BY metric_value DESC, query_id LIMIT 10"""


def _register_top(metric: str, value: str, whole: str):
    query(f"top_queries_{metric}", _top_sql(value))(lambda lake: workload.top_queries(fx.workload(lake), metric))
    query(f"top_queries_{metric}_fallback", _top_sql(whole))(
        lambda lake: workload.top_queries(fx.workload(lake), metric, history=False)
    )


for _metric, _column in workload.METRICS.items():
    _total = f"CAST(floor(sum(CAST(CAST({_column} AS VARCHAR) AS DECIMAL(38,12)))) AS BIGINT) // count(*)"
    _register_top(
        _metric,
        "CAST(count(*) AS DOUBLE)" if _column is None else hu(mean_sql(_column), 4),
        "count(*)" if _column is None else _total,
    )


@query("kpi_summary", f"""
    WITH {SLOW}, f AS ({FRAG} SELECT avg_fragmentation_in_percent AS a FROM frag)
    SELECT (SELECT {hu(mean_sql('metric_value'), 2)} FROM slow) AS avg_duration_ms,
      (SELECT max(metric_value) FROM slow) AS max_duration_ms, (SELECT coalesce({hu(mean_sql('a'), 2)}, 0.0) FROM f) AS avg_fragmentation,
      (SELECT coalesce(max(a), 0.0) FROM f) AS max_fragmentation
""")
def kpi_summary(lake):
    slow = workload.top_queries(fx.workload(lake), "duration")
    durations = aggregates.metric_kpis(slow, "metric_value", "duration_ms")
    shares = aggregates.metric_kpis(_fragmentation(lake), "avg_fragmentation_in_percent", "fragmentation", empty=0.0)
    return durations.join(F.broadcast(shares))  # one row each


@query("kpi_summary_log", f"""
    SELECT {hu(mean_sql('duration_ms'), 2)} AS avg_duration_ms, max(duration_ms) AS max_duration_ms FROM ({WORKLOAD}) w
""")
def kpi_summary_log(lake):
    return aggregates.metric_kpis(fx.workload(lake), "duration_ms", "duration_ms")


REPORT = f"""
    WITH {SLOW}, frag AS ({FRAG} SELECT * FROM frag), tt AS ({TOP_TABLES}),
    ti AS (SELECT * FROM frag ORDER BY avg_fragmentation_in_percent DESC, table_name, index_name LIMIT 5)
    SELECT 'kpi' AS section, CAST(0 AS BIGINT) AS rank, 'avg_duration_ms' AS name, (SELECT {hu(mean_sql('metric_value'), 2)} FROM slow) AS metric
    UNION ALL SELECT 'kpi', 0, 'max_duration_ms', (SELECT max(metric_value) FROM slow)
    UNION ALL SELECT 'kpi', 0, 'avg_fragmentation', (SELECT {hu(mean_sql('avg_fragmentation_in_percent'), 2)} FROM frag)
    UNION ALL SELECT 'kpi', 0, 'severe', (SELECT count(*) FROM frag WHERE avg_fragmentation_in_percent >= 30)
    UNION ALL SELECT 'kpi', 0, 'medium', (SELECT count(*) FROM frag WHERE avg_fragmentation_in_percent >= 10 AND avg_fragmentation_in_percent < 30)
    UNION ALL SELECT 'kpi', 0, 'total', (SELECT count(*) FROM frag)
    UNION ALL SELECT 'queries', row_number() OVER (ORDER BY metric_value DESC, query_id), query_id, metric_value
      FROM (SELECT * FROM slow ORDER BY metric_value DESC, query_id LIMIT 5)
    UNION ALL SELECT 'indexes', row_number() OVER (ORDER BY avg_fragmentation_in_percent DESC, index_name), index_name,
      avg_fragmentation_in_percent FROM ti
    UNION ALL SELECT 'tables', row_number() OVER (ORDER BY max_fragmentation DESC, table_name), table_name, max_fragmentation FROM tt
"""


@query("performance_report", REPORT)
def performance_report(lake):
    return workload.performance_report(fx.workload(lake), _fragmentation(lake))


@query("report_table", f"SELECT '{sinks.report_id('performance', {'limit': 5})}' AS report_id, r.* FROM ({REPORT}) r")
def report_table(lake):
    report = sinks.report_id("performance", {"limit": 5})
    path = session.work_path(lake.spark, "reports")
    sinks.save_report(performance_report(lake), path, report)
    return sinks.load_report(lake.spark, path, report)


@query("lake_inventory", " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, CAST(1 AS BIGINT) AS files, count(*) AS row_count FROM {t}" for t in TABLES))
def lake_inventory(lake):
    # Bytes and times of files are no matter of SQL.
    return inventory.lake_inventory(lake, TABLES).select("table_name", "files", "row_count")


SMALL = 100_000


@query("small_file_health", f"""
    WITH f AS (SELECT regexp_extract(file_name, '([a-z]+)\\.parquet$', 1) AS table_name, num_rows AS row_count,
                      file_size_bytes AS file_bytes FROM parquet_file_metadata('/root/testdata/sf0.01/*.parquet')),
    g AS (SELECT table_name, count(*) AS files, CAST(sum(file_bytes) AS BIGINT) AS bytes,
                 CAST(sum(row_count) AS BIGINT) AS row_count, count(*) FILTER (WHERE file_bytes < {SMALL}) AS small_files
          FROM f GROUP BY table_name)
    SELECT *, bytes // row_count AS bytes_per_row, row_count // files AS rows_per_file,
      {hu('small_files / files', 4)} AS small_file_share,
      CASE WHEN small_files / files > 0.5 THEN 'Medium' ELSE 'Info' END AS severity,
      CASE WHEN small_files / files > 0.5 THEN 'Compact the small files of this table' END AS recommendation FROM g
""")
def small_file_health(lake):
    return inventory.small_file_health(inventory.file_rows(lake, TABLES), SMALL)


STAMPED = "strftime(CAST({0} AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f')"
_bound = lambda side, kind: {
    "number": f"CASE WHEN type IN ('INT32', 'INT64', 'DOUBLE') AND NOT stamp AND NOT nested THEN CAST(stats_{side}_value AS DOUBLE) END",
    "text": f"CASE WHEN nested OR greatest(len(stats_min_value), len(stats_max_value)) > {footers.LONGEST_BOUND} OR stats_min_value IS NULL OR stats_max_value IS NULL THEN NULL WHEN stamp THEN {STAMPED.format(f'stats_{side}_value')} WHEN type = 'BYTE_ARRAY' THEN stats_{side}_value END",
}[kind]


@query("column_storage", f"""
    WITH m AS (SELECT *, regexp_extract(file_name, '([a-z]+)\\.parquet$', 1) AS table_name, split_part(path_in_schema, ', ', 1) AS column_name,
        contains(path_in_schema, ', ') AS nested, split_part(path_in_schema, ', ', 1) IN ('ts', 'o_orderdate', 'l_shipdate') AS stamp
      FROM parquet_metadata('/root/testdata/sf0.01/*.parquet')),
    c AS (SELECT *, {_bound('min', 'number')} AS lo_n, {_bound('max', 'number')} AS hi_n, {_bound('min', 'text')} AS lo_t, {_bound('max', 'text')} AS hi_t FROM m),
    g AS (SELECT table_name, column_name, count(DISTINCT file_name) AS files, count(*) AS chunks, CAST(sum(num_values) AS BIGINT) AS "values",
        CAST(sum(stats_null_count) AS BIGINT) AS null_count, CAST(sum(total_compressed_size) AS BIGINT) AS compressed_bytes,
        CAST(sum(total_uncompressed_size) AS BIGINT) AS plain_bytes, min(lo_n) AS min_number, max(hi_n) AS max_number, min(lo_t) AS min_text, max(hi_t) AS max_text
      FROM c GROUP BY table_name, column_name)
    SELECT *, {hu('compressed_bytes / sum(compressed_bytes) OVER (PARTITION BY table_name)', 4)} AS share, {hu('plain_bytes / compressed_bytes', 4)} AS ratio FROM g
""")
def column_storage(lake):
    return footers.column_storage(footers.column_chunks(lake, TABLES))


SKETCHED = {"l_orderkey": "bigint", "l_quantity": "double", "l_extendedprice": "double", "l_discount": "double", "l_linenumber": "int", "l_returnflag": "string", "l_shipdate": "stamp"}
_sketched_sql = lambda c, kind: f"""SELECT '{c}' AS column_name, count(*) AS row_count, count(*) - count({c}) AS null_count,
      {f'CAST(min({c}) AS DOUBLE)' if kind in ('int', 'bigint', 'double') else 'NULL::DOUBLE'} AS min_number,
      {f'CAST(max({c}) AS DOUBLE)' if kind in ('int', 'bigint', 'double') else 'NULL::DOUBLE'} AS max_number,
      true AS distinct_close, {'true' if kind in ('int', 'bigint', 'double') else 'NULL::BOOLEAN'} AS median_close FROM lineitem"""  # noqa: E731


@query("sketch_profile", " UNION ALL ".join(_sketched_sql(c, kind) for c, kind in SKETCHED.items()))
def sketch_profile(lake):
    """Figures from merged sketches, and whether their estimates lie within 6 per cent of the distinct count and 3 of the median's rank."""
    sketches, _ = sketchprofile.refreshed(lake, "lineitem", columns=tuple(SKETCHED))
    found = sketchprofile.merged(sketches)
    lines = lake.table("lineitem")
    exact = None
    for c, kind in SKETCHED.items():
        one = lines.agg(F.count_distinct(c).alias("exact")).select(F.lit(c).alias("column_name"), "exact")
        exact = one if exact is None else exact.unionByName(one)
    # A row per column on both sides; ranks are shares of rows below and up to the estimate.
    medians = {r["column_name"]: r["q50"] for r in found.collect() if r["q50"] is not None}
    ranks = lines.agg(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.avg((F.col(c) < m).cast("double")).alias("below"), F.avg((F.col(c) <= m).cast("double")).alias("up_to")) for c, m in medians.items()
    ]).alias("x")).select(F.inline("x"))
    return found.join(exact, "column_name").join(ranks, "column_name", "left").select(
        "column_name", "row_count", "null_count", "min_number", "max_number",
        (F.abs(F.col("distinct_count") - F.col("exact")) <= 0.06 * F.col("exact")).alias("distinct_close"),
        ((F.col("below") <= 0.53) & (F.col("up_to") >= 0.47)).alias("median_close"),
    )


# Orders stored by key, and by month: groups of rows with the bounds of three columns.
LAYOUTS = ("by_key", "o_orderkey // 500", "o_orderkey div 500"), ("by_month", "year(o_orderdate) * 12 + month(o_orderdate)", "year(o_orderdate) * 12 + month(o_orderdate)")
BOUNDED = ("o_orderkey", "o_custkey", "o_totalprice")
INTERVALS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS low, CAST(max({c}) AS DOUBLE) AS high FROM orders GROUP BY {group}"
    for name, group, _ in LAYOUTS for c in BOUNDED
)


@query("overlap_depth", f"""
    WITH i AS ({INTERVALS}), b AS (SELECT table_name, column_name, low AS v FROM i UNION SELECT table_name, column_name, high FROM i),
    d AS (SELECT b.table_name, b.column_name, v, count(*) AS depth FROM b JOIN i ON i.table_name = b.table_name AND i.column_name = b.column_name
            AND low <= v AND v <= high GROUP BY ALL),
    n AS (SELECT table_name, column_name, count(*) AS groups FROM i GROUP BY ALL)
    SELECT table_name, column_name, groups, count(*) AS bounds, max(depth) AS max_depth, {hu('avg(depth)', 4)} AS mean_depth
    FROM d JOIN n USING (table_name, column_name) GROUP BY ALL
""")
def overlap_depth(lake):
    parts = None
    for name, _, group in LAYOUTS:
        sides = [F.struct(F.lit(c).alias("column_name"), F.min(c).cast("double").alias("low"), F.max(c).cast("double").alias("high")) for c in BOUNDED]
        one = lake.table("orders").groupBy(F.expr(group)).agg(F.array(*sides).alias("x")).select(F.lit(name).alias("table_name"), F.inline("x"))
        parts = one if parts is None else parts.unionByName(one)
    return overlap.overlap_depth(parts)


COMPOSITES = (
    ("lineitem", ("l_orderkey", "l_linenumber")),
    ("lineitem", ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")),
    ("conversations", ("conv_id", "turn")),
)


def _key_sql(table: str, columns) -> str:
    names = ", ".join(columns)
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"""SELECT '{table}' AS table_name, '{",".join(columns)}' AS key_columns, count(*) AS row_count,
      count(DISTINCT ({names})) AS distinct_count, count(*) FILTER (WHERE {nulls}) AS null_rows FROM {table}"""


KEYS = "WITH k AS (" + "\nUNION ALL ".join(
    [_key_sql(t, (c,)) for t in TABLES for c, kind in COLUMNS[t].items() if kind in ("int", "bigint", "string", "timestamp_ntz")]
    + [_key_sql(t, cs) for t, cs in COMPOSITES]
) + "),\nkeys AS (SELECT * FROM k WHERE row_count = distinct_count AND null_rows = 0 AND row_count > 0)\n"


def _tables(lake, names=TABLES):
    return {t: lake.table(t) for t in names}


def _keys(lake):
    return model.find_keys(_tables(lake), COMPOSITES)


@query("key_discovery", KEYS + "SELECT table_name, key_columns, row_count FROM keys")
def key_discovery(lake):
    return _keys(lake)


KEY_COLUMNS = {t: [c for c, kind in cs.items() if kind in ("int", "bigint", "string", "timestamp_ntz")] for t, cs in COLUMNS.items()}


def _set_sql(table: str, columns) -> str:
    nulls = " OR ".join(f"{c} IS NULL" for c in columns)
    return f"""SELECT '{table}' AS table_name, '{",".join(columns)}' AS key_columns, {len(columns)} AS width, {list(columns)} AS parts, count(*) AS row_count,
      count(DISTINCT ({", ".join(columns)})) AS distinct_count, count(*) FILTER (WHERE {nulls}) AS null_rows FROM {table}"""


# All sets of up to three columns, and of those that are keys the ones without a smaller one inside.
MINIMAL = "WITH sets AS (" + "\nUNION ALL ".join(
    _set_sql(t, columns) for t in TABLES for n in range(1, keysearch.WIDTH + 1) for columns in combinations(KEY_COLUMNS[t], n)
) + """), keys AS (SELECT * FROM sets WHERE row_count = distinct_count AND null_rows = 0 AND row_count > 0)
SELECT table_name, key_columns, CAST(width AS INTEGER) AS width, row_count FROM keys a
WHERE NOT EXISTS (SELECT 1 FROM keys b WHERE b.table_name = a.table_name AND b.width < a.width AND list_has_all(a.parts, b.parts))
"""


@query("minimal_keys", MINIMAL)
def minimal_keys(lake):
    return keysearch.minimal_keys(_tables(lake))


# Answers refer to turns of conversations, lines to what a supplier has of a part.
DERIVED = {
    "supply": ("SELECT l_partkey AS ps_partkey, l_suppkey AS ps_suppkey, count(*) AS ps_lines FROM {lineitem} GROUP BY l_partkey, l_suppkey", "lineitem"),
    "answers": ("SELECT conv_id AS a_conv, turn AS a_turn, length(text) AS a_size FROM {conversations} WHERE role = 'assistant'", "conversations"),
}
SIDES = {
    "supply": ("ps_partkey", "ps_suppkey", "ps_lines"), "answers": ("a_conv", "a_turn", "a_size"), "lineitem": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"),
    "conversations": ("conv_id", "turn"), "part": ("p_partkey", "p_size"), "supplier": ("s_suppkey", "s_nationkey"), "orders": ("o_orderkey", "o_custkey"),
}
REFERRED = (
    ("supply", ("ps_partkey", "ps_suppkey")), ("conversations", ("conv_id", "turn")), ("part", ("p_partkey",)), ("supplier", ("s_suppkey",)), ("orders", ("o_orderkey",)),
)


def _reference_sql(child: str, own, parent: str, key) -> str:
    same = " AND ".join(f"a.{x} = b.{y}" for x, y in zip(own, key, strict=True))
    whole = lambda columns: " AND ".join(f"{c} IS NOT NULL" for c in columns)
    return f"""SELECT 'fk_{"_".join([child, *own, parent])}' AS constraint_name, '{child}' AS parent_table, '{",".join(own)}' AS parent_columns,
      '{parent}' AS referenced_table, '{",".join(key)}' AS referenced_columns,
      (SELECT count(*) FROM (SELECT DISTINCT {", ".join(own)} FROM {child} WHERE {whole(own)})) AS child_values,
      (SELECT count(*) FROM (SELECT DISTINCT {", ".join(key)} FROM {parent} WHERE {whole(key)})) AS key_values,
      (SELECT count(*) FROM (SELECT DISTINCT {", ".join(own)} FROM {child} WHERE {whole(own)}) a
        WHERE NOT EXISTS (SELECT 1 FROM {parent} b WHERE {same})) AS lost"""


REFERENCES = "WITH " + ", ".join(f"{name} AS ({fx.duck(text, table)})" for name, (text, table) in DERIVED.items()) + ", sums AS (" + "\nUNION ALL ".join(
    _reference_sql(child, own, parent, key) for parent, key in REFERRED for child, cs in SIDES.items() if child != parent for own in permutations(cs, len(key))
) + f""")
SELECT constraint_name, parent_table, parent_columns, referenced_table, referenced_columns, child_values, key_values,
  {hu('child_values / key_values', 4)} AS parent_coverage FROM sums WHERE lost = 0 AND child_values > 0
"""


@query("composite_relationships", REFERENCES)
def composite_relationships(lake):
    tables = {t: (lake.sql(*DERIVED[t]) if t in DERIVED else lake.table(t)).select(*cs) for t, cs in SIDES.items()}
    keys = lake.spark.createDataFrame([(t, ",".join(key)) for t, key in REFERRED], "table_name string, key_columns string")
    return inclusion.composite_relationships(tables, keys)


@query("missing_primary_key", KEYS + f"""
    SELECT 'identifiers' AS category, t AS entity, 'No unique column or key found' AS issue, 'High' AS severity
    FROM (SELECT unnest({list(TABLES)}) AS t) WHERE t NOT IN (SELECT table_name FROM keys WHERE key_columns NOT LIKE '%,%')
""")
def missing_primary_key(lake):
    return model.missing_primary_key(lake.spark, TABLES, model.find_keys(_tables(lake)))


COUNTS = " UNION ALL ".join(f"SELECT '{t}' AS entity, {len(cs)} AS n" for t, cs in COLUMNS.items())


@query("wide_entity", f"""
    SELECT 'normalization' AS category, entity, n || ' columns in one table' AS issue, 'Medium' AS severity
    FROM ({COUNTS}) WHERE n > 5
""")
def wide_entity(lake):
    return model.wide_entities(profile.column_dictionary(_profiles(lake, TABLES, profile.SHAPE)), 5)


KINDS = {"int": "whole", "bigint": "whole", "string": "text", "timestamp_ntz": "time"}
VALUES = "\nUNION ALL ".join(
    f"SELECT '{t}' AS t, '{c}' AS c, '{KINDS[kind]} ' || CAST({c} AS VARCHAR) AS v FROM {t}"
    for t in TABLES for c, kind in COLUMNS[t].items() if kind in KINDS
)
RELS = f"""
    WITH vals AS ({VALUES}),
    stats AS (SELECT t, c, count(*) AS n, count(DISTINCT v) AS d FROM vals GROUP BY t, c),
    dv AS (SELECT DISTINCT t, c, v FROM vals WHERE v IS NOT NULL),
    m AS (SELECT a.t AS parent_table, a.c AS parent_column, b.t AS referenced_table, b.c AS referenced_column, count(*) AS matched_values
          FROM dv a JOIN dv b ON a.v = b.v AND a.t <> b.t JOIN stats k ON k.t = b.t AND k.c = b.c AND k.n = k.d GROUP BY ALL),
    rels AS (SELECT 'fk_' || parent_table || '_' || parent_column || '_' || referenced_table AS constraint_name,
        parent_table, parent_column, referenced_table, referenced_column, s.d AS child_values, matched_values,
        {hu('matched_values / s.d', 4)} AS coverage, {hu('matched_values / k.d', 4)} AS parent_coverage,
        regexp_replace(parent_column, '^[a-z]{{1,2}}_', '') = regexp_replace(referenced_column, '^[a-z]{{1,2}}_', '') AS same_name
      FROM m JOIN stats s ON s.t = parent_table AND s.c = parent_column
      JOIN stats k ON k.t = referenced_table AND k.c = referenced_column WHERE matched_values = s.d)
"""


@query("relationships", RELS + "SELECT * FROM rels")
def relationships(lake):
    return model.relationships(_tables(lake))


def _named(lake):
    """Inclusions whose two columns share their name."""
    return relationships(lake).where("same_name")


ENTITIES = ("orders", "lineitem", "customer", "labels", "events")
ENTITY_LIST = "('" + "', '".join(ENTITIES) + "')"
EXTERNAL = f"""SELECT 'relationships' AS category, parent_table AS entity,
      parent_column || ' refers to ' || referenced_table || ' outside the model' AS issue, 'Low' AS severity
    FROM rels WHERE same_name AND parent_table IN {ENTITY_LIST} AND referenced_table NOT IN {ENTITY_LIST}"""


@query("external_references", RELS + EXTERNAL)
def external_references(lake):
    return model.external_references(_named(lake), ENTITIES)


@query("orphan_rows", """
    SELECT count(DISTINCT o_custkey) AS orphan_values, count(*) AS orphan_rows FROM orders
    WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def orphan_rows(lake):
    building = lake.table("customer").where(F.col("c_mktsegment") == "BUILDING")
    return model.orphan_rows(lake.table("orders"), building, "o_custkey", "c_custkey")


@query("fk_access_path", RELS + f"""
    , frag AS ({FRAG} SELECT * FROM frag)
    SELECT constraint_name, parent_table, parent_column, referenced_table, avg_fragmentation_in_percent AS fragmentation,
      CASE WHEN coalesce(avg_fragmentation_in_percent, 100) > 10 THEN 'Unindexed Foreign Key' END AS issue,
      CASE WHEN coalesce(avg_fragmentation_in_percent, 100) > 10 THEN 'Medium' END AS severity,
      CASE WHEN coalesce(avg_fragmentation_in_percent, 100) > 10 THEN 'Cluster ' || parent_table || ' by ' || parent_column
        || ': joins to ' || referenced_table || ' cannot skip data' END AS recommendation
    FROM rels LEFT JOIN frag ON table_name = parent_table AND column_name = parent_column WHERE same_name
""")
def fk_access_path(lake):
    return layout.access_path_advice(_named(lake), _fragmentation(lake))


ISSUES = f"""
    , k AS ({KEYS} SELECT * FROM keys),
    issues AS (SELECT 'identifiers' AS category, t AS entity, 'No unique column or key found' AS issue, 'High' AS severity
        FROM (SELECT unnest({list(ENTITIES)}) AS t) WHERE t NOT IN (SELECT table_name FROM k)
      UNION ALL SELECT 'normalization', entity, n || ' columns in one table', 'Medium' FROM ({COUNTS})
        WHERE n > 8 AND entity IN {ENTITY_LIST}
      UNION ALL {EXTERNAL})
"""


def _model(lake):
    """The model's parts. They hold a few rows per column, so each is computed once."""
    tables = _tables(lake)
    keys = settle(model.find_keys(tables, COMPOSITES[:1]))
    named = settle(model.relationships(tables, keys).where("same_name"))
    columns = profile.schema_columns(_tables(lake, ENTITIES))
    return columns, named, settle(model.model_issues(columns, keys, named, ENTITIES, 8))


# The model looks for single keys and one composite that is not unique.
ISSUES = ISSUES.replace("SELECT * FROM keys)", "SELECT * FROM keys WHERE key_columns NOT LIKE '%,%')")


@query("issue_counts", RELS + ISSUES + """
    SELECT category, (SELECT count(*) FROM issues i WHERE i.category = c.category) AS issues
    FROM (SELECT unnest(['entities', 'attributes', 'relationships', 'identifiers', 'normalization']) AS category) c
""")
def issue_counts(lake):
    return model.issue_counts(_model(lake)[2])


@query("logical_model", RELS + ISSUES + f"""
    , own AS (SELECT * FROM rels WHERE same_name AND parent_table IN {ENTITY_LIST})
    SELECT 'entity' AS section, entity AS name, CAST(n AS VARCHAR) AS detail FROM ({COUNTS}) WHERE entity IN {ENTITY_LIST}
    UNION ALL SELECT 'relationship', parent_table || '.' || parent_column, referenced_table || '.' || referenced_column FROM own
    UNION ALL SELECT 'issue', category || ': ' || entity, severity || ': ' || issue FROM issues
    UNION ALL SELECT 'summary', 'entities', '{len(ENTITIES)}'
    UNION ALL SELECT 'summary', 'relationships', CAST(count(*) AS VARCHAR) FROM own
    UNION ALL SELECT 'summary', 'issues', CAST(count(*) AS VARCHAR) FROM issues
""")
def logical_model(lake):
    return model.logical_model(ENTITIES, *_model(lake))


CONSTRAINTS = (
    Constraint("pk_orders", "orders", "unique", ("o_orderkey",)),
    Constraint("uq_orders_customer", "orders", "unique", ("o_custkey",)),
    Constraint("nn_orders", "orders", "not_null", ("o_custkey", "o_orderdate")),
    Constraint("ck_orders_status", "orders", "domain", rule="o_orderstatus IN ('O', 'F')"),
    Constraint("ck_orders_price", "orders", "range", rule="o_totalprice BETWEEN 1000 AND 400000"),
    Constraint("uq_lineitem_line", "lineitem", "unique", ("l_orderkey", "l_linenumber")),
    Constraint("ck_lineitem_tax", "lineitem", "range", rule="l_tax <= 0.05 AND l_discount < 0.1"),
    Constraint("pk_labels", "labels", "unique", ("doc_id",)),
    Constraint("ck_labels_quality", "labels", "domain", rule="quality IN (0, 1)"),
)


def _constraint_sql(c: Constraint) -> str:
    if c.kind == "unique":
        broken = f"count(*) - count(DISTINCT ({', '.join(c.columns)}))"
    elif c.kind == "not_null":
        broken = f"count(*) FILTER (WHERE {' OR '.join(f'{x} IS NULL' for x in c.columns)})"
    else:
        broken = f"count(*) FILTER (WHERE NOT ({c.rule}))"
    return f"""SELECT '{c.table}' AS table_name, '{c.name}' AS constraint_name, '{c.kind}' AS kind,
      count(*) AS rows_checked, {broken} AS violations FROM {c.table}"""


@query("constraint_audit", "\nUNION ALL ".join(_constraint_sql(c) for c in CONSTRAINTS))
def constraint_audit(lake):
    return profile.constraint_audit(_tables(lake, ("orders", "lineitem", "labels")), CONSTRAINTS)


@query("usage_metrics", """
    SELECT (SELECT count(DISTINCT user_id) FROM events WHERE event_type IN ('signup', 'purchase', 'error')) AS user_count,
      (SELECT count(*) FROM (SELECT arg_max(role, turn) AS role FROM conversations GROUP BY conv_id) WHERE role = 'user') AS open_conversations,
      (SELECT CAST(sum(strlen(text)) // 1048576 AS BIGINT) FROM documents) AS text_mb
""")
def usage_metrics(lake):
    t = lake.table
    return model.usage_metrics(t("events"), t("conversations"), t("documents"), ("signup", "purchase", "error"))
