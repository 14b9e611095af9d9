"""Heaviest queries and sessions of a workload log, and the report over both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeaudit.functions.numbers import half_up, mean, money
from lakeaudit.operators import aggregates, layout
from lakeaudit.operators.small import settle

# Metrics of a query ranking with the log column behind each, the
# metric for an unknown name, and the sizes of the lists.
METRICS = {"cpu": "cpu_ms", "io": "logical_reads", "execution_count": None, "duration": "duration_ms"}
DEFAULT_METRIC = "cpu"
TOP_QUERIES = 10
TOP_SESSIONS = 15
REPORT_ROWS = 5


def query_stats(log: DataFrame, metric: str) -> DataFrame:
    """One row per query: executions, last run, and the average of the metric."""
    column = METRICS[metric]
    value = F.count(F.lit(1)).cast("double") if column is None else half_up(mean(F.col(column)), 4)
    return log.groupBy("query_id").agg(
        value.alias("metric_value"),
        F.count(F.lit(1)).alias("count_executions"),
        F.max("ts").alias("last_execution_time"),
    )


def whole_number_stats(log: DataFrame, metric: str) -> DataFrame:
    """The same from totals only: whole total divided by executions, without rest."""
    column = METRICS[metric]
    total = F.lit(0) if column is None else money(F.col(column))
    grouped = log.groupBy("query_id").agg(
        F.floor(F.sum(total)).cast("long").alias("total"),
        F.count(F.lit(1)).alias("count_executions"),
        F.max("ts").alias("last_execution_time"),
    )
    measure = "count_executions" if column is None else "total div count_executions"
    return grouped.selectExpr("query_id", f"{measure} AS metric_value", "count_executions", "last_execution_time")


def top_queries(log: DataFrame, metric: str = DEFAULT_METRIC, limit: int = TOP_QUERIES, history: bool = True) -> DataFrame:
    """The heaviest queries by a metric; an unknown metric ranks by cpu."""
    name = metric if metric in METRICS else DEFAULT_METRIC
    stats = (query_stats if history else whole_number_stats)(log, name)
    ranked = stats.orderBy(F.col("metric_value").desc(), "query_id").limit(limit)
    return ranked.withColumn("last_execution_time", F.col("last_execution_time").cast("string"))


def top_sessions(sessions: DataFrame, requests: DataFrame, key: str, limit: int = TOP_SESSIONS) -> DataFrame:
    """Sessions with a request first, then by elapsed time and cpu.

    ``sessions`` has key and ``session_cpu``; ``requests`` has key, ``request_id``,
    ``elapsed``, ``cpu`` and ``command``. Rows with and without a request are ranked
    apart: the inner join can be split at a hot session, which an outer join cannot.
    """
    order = [F.col("has_request").desc(), F.col("elapsed").desc(), F.col("cpu").desc(), key, "request_id"]
    busy = sessions.join(requests, key, "inner").select(
        key, "request_id", F.lit(1).alias("has_request"), "elapsed",
        F.coalesce("cpu", "session_cpu", F.lit(0.0)).alias("cpu"),
        F.coalesce("command", F.lit("")).alias("command"),
    )
    idle = sessions.join(requests.select(key).distinct(), key, "left_anti").select(
        key, F.lit(None).cast("long").alias("request_id"), F.lit(0).alias("has_request"),
        F.lit(0.0).alias("elapsed"), F.coalesce("session_cpu", F.lit(0.0)).alias("cpu"),
        F.lit("").alias("command"),
    )
    top = busy.orderBy(*order).limit(limit).unionByName(idle.orderBy(*order).limit(limit))
    return top.orderBy(*order).limit(limit)


def performance_report(log: DataFrame, fragmentation_rows: DataFrame) -> DataFrame:
    """Key figures and top lists as rows of section, rank, name and metric.

    The figures describe the lists the report is made from: the slowest queries and
    the fragmentation rows.
    """
    slow = settle(top_queries(log, "duration", TOP_QUERIES))
    frag = settle(fragmentation_rows)
    query_kpi = aggregates.metric_kpis(slow, "metric_value", "duration_ms")
    frag_kpi = aggregates.metric_kpis(frag, "avg_fragmentation_in_percent", "fragmentation", empty=0.0)
    bands = aggregates.severity_bands(frag)

    def figures(df: DataFrame) -> DataFrame:
        cells = ", ".join(f"'{c}', CAST({c} AS DOUBLE)" for c in df.columns)
        return df.selectExpr(f"stack({len(df.columns)}, {cells}) AS (name, metric)").select(
            F.lit("kpi").alias("section"), F.lit(0).cast("long").alias("rank"), "name", "metric"
        )

    def ranked(df: DataFrame, section: str, name, metric) -> DataFrame:
        # The list has a fixed small size, so ranking it needs no partition key.
        rows = df.select(name.alias("name"), metric.cast("double").alias("metric"))
        rank = F.row_number().over(Window.orderBy(F.col("metric").desc(), "name")).cast("long")
        return rows.select(F.lit(section).alias("section"), rank.alias("rank"), "name", "metric")

    parts = [
        figures(query_kpi),
        figures(frag_kpi.select("avg_fragmentation")),
        figures(bands),
        ranked(slow.orderBy(F.col("metric_value").desc(), "query_id").limit(REPORT_ROWS), "queries",
               F.col("query_id"), F.col("metric_value")),
        ranked(layout.top_fragmented(frag, REPORT_ROWS), "indexes",
               F.col("index_name"), F.col("avg_fragmentation_in_percent")),
        ranked(layout.by_table(frag, REPORT_ROWS), "tables", F.col("table_name"), F.col("max_fragmentation")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
