"""The limiter, sessions, windowed figures and execution logs, in batch and as streams.

A stream's oracle describes what has come out when all files are processed: windows
the watermark has closed.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import functions as F

from lakeaudit import fixtures as fx
from lakeaudit import session
from lakeaudit.functions.numbers import half_up_sql as hu
from lakeaudit.functions.numbers import mean_sql
from lakeaudit.sources import sinks
from lakeaudit.streaming import limiter, livetop, monitor, run
from lakeaudit.streaming.limits import Limits
from lakeaudit.suite.registry import query

LIMITS = Limits(window=86_400, max_requests=5, breaker=21_600, violations=2)

# The rules as a recursive query: the state after each request of each user in order.
DECISIONS = f"""
    WITH RECURSIVE e AS (
      SELECT user_id, event_id, ts, epoch_us(ts) AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    sim AS (
      SELECT user_id, event_id, ts, rn, [t] AS times, CAST(0 AS BIGINT) AS v, CAST(0 AS BIGINT) AS blocked, true AS allowed, NULL::BIGINT AS retry
      FROM e WHERE rn = 1
      UNION ALL
      SELECT user_id, event_id, ts, rn,
        CASE WHEN b > t THEN times WHEN len(kept) >= {LIMITS.max_requests} THEN kept ELSE list_append(kept, t) END,
        CASE WHEN b > t THEN v WHEN len(kept) >= {LIMITS.max_requests} THEN v + 1
             WHEN v > 0 AND len(kept) + 1 < {LIMITS.max_requests // 2} THEN v - 1 ELSE v END,
        CASE WHEN b <= t AND len(kept) >= {LIMITS.max_requests} AND v + 1 >= {LIMITS.violations} THEN t + {LIMITS.breaker_us} ELSE b END,
        b <= t AND len(kept) < {LIMITS.max_requests},
        CASE WHEN b > t THEN greatest(1, (b - t) // 1000000)
             WHEN len(kept) < {LIMITS.max_requests} THEN NULL
             WHEN v + 1 >= {LIMITS.violations} THEN {LIMITS.breaker}
             ELSE greatest(1, (kept[1] + {LIMITS.window_us} - t) // 1000000) END
      FROM (SELECT e.user_id, e.event_id, e.ts, e.t, e.rn, s.times, s.v, s.blocked AS b,
                   list_filter(s.times, lambda x: x >= e.t - {LIMITS.window_us}) AS kept
            FROM sim s JOIN e ON e.user_id = s.user_id AND e.rn = s.rn + 1))
"""


def _requests(lake):
    return lake.table("events").select("event_id", "user_id", "ts")


def _limited(lake):
    return limiter.rate_limit(_requests(lake), "user_id", "ts", "event_id", LIMITS)


@query("rate_limit", DECISIONS + "SELECT event_id, user_id, ts, allowed, retry AS retry_after FROM sim")
def rate_limit(lake):
    return _limited(lake)


SLICES = 6
# What a slice may be behind the slices before it.
DISORDER = 3600


def _arrivals(lake):
    """The requests as a stream of slices in the order of time, two per trigger, and a closing mark.

    Inside a slice, and between the slices of one trigger, requests are in any order. The
    mark, far behind the last request, moves the watermark past all of them.
    """
    folder = session.work_path(lake.spark, "arrivals")
    rows = _requests(lake).withColumn("ts", F.col("ts").cast("timestamp"))
    files = run.deal(rows, "ts", rows.count(), SLICES, folder)
    mark = rows.agg((F.max("ts") + F.make_dt_interval(secs=F.lit(2 * (DISORDER + LIMITS.window + LIMITS.breaker)))).alias("ts")).select(
        F.lit(-1).cast("long").alias("event_id"), F.lit(-1).cast("long").alias("user_id"), "ts"
    )
    mark.coalesce(1).write.mode("append").parquet(folder)
    stream = lake.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2 * files).parquet(folder)
    return stream.withWatermark("ts", f"{DISORDER} seconds")


def _limited_stream(lake, expire):
    with run.bounded_state(lake.spark):
        decided = limiter.rate_limit_stream(_arrivals(lake), "user_id", "ts", "event_id", LIMITS, expire)
        return run.run_to_table(decided, "limiter").where("event_id >= 0").drop("ts")


@query("rate_limit_stream", DECISIONS + "SELECT event_id, user_id, allowed, retry AS retry_after FROM sim")
def rate_limit_stream(lake):
    return _limited_stream(lake, expire=False)


# A client that was quiet for window and breaker starts anew, so its violations are gone.
FORGETFUL = DECISIONS.replace(
    "s.times, s.v, s.blocked AS b,", f"s.times, CASE WHEN e.t > s.last_t + {LIMITS.quiet_us} THEN 0 ELSE s.v END AS v, s.blocked AS b,"
).replace("ts, rn, [t] AS times", "ts, rn, t AS last_t, [t] AS times").replace("SELECT user_id, event_id, ts, rn,\n        CASE WHEN b > t THEN times", "SELECT user_id, event_id, ts, rn, t,\n        CASE WHEN b > t THEN times")


@query("rate_limit_expiring_stream", FORGETFUL + "SELECT event_id, user_id, allowed, retry AS retry_after FROM sim")
def rate_limit_expiring_stream(lake):
    return _limited_stream(lake, expire=True)


@query("state_expiry", DECISIONS + f"""
    SELECT user_id, max(ts) FILTER (WHERE allowed) AS newest,
      max(ts) FILTER (WHERE allowed) < (SELECT max(ts) FROM events) - INTERVAL {LIMITS.window + LIMITS.breaker} SECOND AS expired
    FROM sim GROUP BY user_id
""")
def state_expiry(lake):
    return limiter.state_expiry(_limited(lake), _requests(lake), "user_id", "ts", LIMITS)


@query("audit_stream", """
    SELECT 'turn-' || turn AS timestamp, 'query_execution' AS event, 'chat' AS tool, 'lake' AS database, role AS api_caller,
      '[REDACTED_SQL:' || left(sha256(text), 12) || ']' AS redacted_sql, sha256(text) AS sql_sha256,
      'sha256:' || sha256(text) AS sql_anonymized_hash, sha256(text) AS prompt_sha256,
      '[REDACTED_PROMPT:' || left(sha256(text), 12) || ']' AS prompt_redaction_token,
      'raw_opt_in' AS prompt_storage_mode, 'reader' AS db_user, text AS prompt, true AS raw_prompt_storage_enabled
    FROM conversations
""")
def audit_stream(lake):
    turns = run.stream_table(lake, "conversations")
    records = sinks.audit_records(
        turns, tool="chat", database="lake", sql=F.col("text"), prompt=F.col("text"), caller=F.col("role"),
        at=F.concat(F.lit("turn-"), F.col("turn")), db_user="reader", allow_raw=True,
    )
    path = run.run_to_files(records, "audit-stream", "json")
    return sinks.read_audit(lake.spark, path, records.schema)


GAP = 1800
SESSIONS = f"""
    WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w >= INTERVAL {GAP} SECOND THEN 1 ELSE 0 END AS new
               FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    n AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS run FROM g),
    s AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL {GAP} SECOND AS session_end, count(*) AS events
          FROM n GROUP BY user_id, run)
"""


@query("session_monitor", SESSIONS + "SELECT * FROM s")
def session_monitor(lake):
    return monitor.sessions(lake.table("events"), "user_id", "ts", GAP)


@query("session_monitor_stream", SESSIONS + "SELECT * FROM s WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR")
def session_monitor_stream(lake):
    events = run.stream_table(lake, "events", "ts")
    closed = run.run_to_table(monitor.sessions_stream(events, "user_id", "ts", GAP, "1 hour"), "sessions")
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})


STATUS = """SELECT date_trunc('day', ts) AS window_start, count(*) FILTER (WHERE event_type IN ('click', 'view')) AS active,
      count(*) FILTER (WHERE event_type = 'signup') AS idle, count(*) AS total FROM events GROUP BY 1"""


def _status(events, delay=None):
    kind = F.col("event_type")
    return monitor.status_windows(events, "ts", kind.isin("click", "view"), kind == "signup", "1 day", delay)


@query("session_status", STATUS)
def session_status(lake):
    return _status(lake.table("events"))


@query("session_status_stream", f"""
    SELECT * FROM ({STATUS}) WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def session_status_stream(lake):
    rows = run.run_to_table(_status(run.stream_table(lake, "events", "ts"), "1 hour"), "status")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


TOP_ORDER = (("elapsed", True), ("cpu", True), ("user_id", False), ("request_id", False))
TOP_SESSIONS = f"""
    SELECT * FROM (
      SELECT *, CAST(row_number() OVER (PARTITION BY window_start ORDER BY elapsed DESC NULLS LAST, cpu DESC NULLS LAST, user_id, request_id) AS INTEGER) AS rank
      FROM (SELECT date_trunc('day', ts) AS window_start, user_id, event_id AS request_id, value AS elapsed,
              CASE WHEN event_type = 'click' THEN value * 0.5 END AS cpu, event_type AS command FROM events))
    WHERE rank <= {livetop.TOP}
"""


def _session_requests(events):
    cpu = F.when(F.col("event_type") == "click", F.col("value") * 0.5)
    return events.select(
        "ts", "user_id", F.col("event_id").alias("request_id"), F.col("value").alias("elapsed"), cpu.alias("cpu"), F.col("event_type").alias("command")
    )


@query("top_sessions_windows", TOP_SESSIONS)
def top_sessions_windows(lake):
    return livetop.top_per_window(_session_requests(lake.table("events")), "ts", "1 day", TOP_ORDER).drop("ts")


@query("top_sessions_stream", TOP_SESSIONS)
def top_sessions_stream(lake):
    """The live list of each day, as it stands when all requests have come."""
    requests = _session_requests(run.stream_table(lake, "events", "ts"))
    rows = livetop.run_live_top(lake.spark, requests, "ts", "1 day", TOP_ORDER, "request_id")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


KPI = f"count(*) AS rows, {hu(mean_sql('value'), 4)} AS avg_value, max(value) AS max_value"


@query("windowed_kpis", f"""
    SELECT date_trunc('day', ts) AS window_start, date_trunc('day', ts) + INTERVAL 1 DAY AS window_end, event_type, {KPI}
    FROM events GROUP BY ALL
""")
def windowed_kpis(lake):
    return monitor.windowed_kpis(lake.table("events"), "ts", "event_type", "value", "1 day")


SLIDING = f"""
    SELECT p - to_hours(CAST(n * 6 AS INTEGER)) AS window_start, p - to_hours(CAST(n * 6 AS INTEGER)) + INTERVAL 1 DAY AS window_end, event_type, {KPI}
    FROM (SELECT time_bucket(INTERVAL 6 HOURS, ts) AS p, * FROM events), (SELECT unnest([0, 1, 2, 3]) AS n) GROUP BY ALL
"""


@query("sliding_kpis", SLIDING)
def sliding_kpis(lake):
    return monitor.sliding_kpis(lake.table("events"), "ts", "event_type", "value", 4, 6 * 3600)


@query("windowed_kpis_stream", f"""
    SELECT * FROM ({SLIDING}) WHERE window_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def windowed_kpis_stream(lake):
    events = run.stream_table(lake, "events", "ts")
    rows = run.run_to_table(
        monitor.kpis_stream(events, "ts", "event_type", "value", "24 hours", "6 hours", "1 hour"), "kpis"
    )
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("windowed_kpis_updates", SLIDING)
def windowed_kpis_updates(lake):
    """Update mode: every window is there, also those the watermark has not closed."""
    stream = monitor.kpis_stream(
        run.stream_table(lake, "events", "ts"), "ts", "event_type", "value", "24 hours", "6 hours", "1 hour"
    )
    rows = run.run_updates(stream, ["window_start", "event_type"], "kpi-updates")
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query("late_rows", """
    WITH m AS (SELECT o_orderdate, max(o_orderdate) OVER (ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS top FROM orders)
    SELECT count(*) AS rows, count(*) FILTER (WHERE o_orderdate < top - INTERVAL 90 DAY) AS late_rows FROM m
""")
def late_rows(lake):
    return monitor.late_rows(lake.table("orders"), "o_orderkey", "o_orderdate", 90 * 86_400)


TOOLLOG = fx.duck(fx.TOOLLOG, "events")
CALLS = f"""
    WITH calls AS (SELECT invocation_id, any_value(tool) AS tool, min(ts) FILTER (WHERE phase = 'tool.start') AS started,
        max(phase) FILTER (WHERE phase <> 'tool.start') AS outcome, max(elapsed_ms) AS elapsed_ms,
        max(result_rows) AS result_rows, max(error_text) AS error_text
      FROM ({TOOLLOG}) GROUP BY invocation_id)
"""


@query("tool_log_pairing", CALLS + "SELECT * FROM calls")
def tool_log_pairing(lake):
    return monitor.paired_calls(fx.toollog(lake))


@query("tool_log_figures", CALLS + f"""
    SELECT tool, count(*) AS calls, count(*) FILTER (WHERE outcome = 'tool.success') AS succeeded,
      count(*) FILTER (WHERE outcome = 'tool.error') AS failed, count(*) FILTER (WHERE outcome IS NULL) AS never_finished,
      {hu("count(*) FILTER (WHERE outcome = 'tool.success') / nullif(count(outcome), 0)", 4)} AS success_rate,
      {hu('quantile_cont(elapsed_ms, 0.5)', 4)} AS p50_ms, {hu('quantile_cont(elapsed_ms, 0.95)', 4)} AS p95_ms
    FROM calls GROUP BY tool
""")
def tool_log_figures(lake):
    return monitor.call_figures(monitor.paired_calls(fx.toollog(lake)))


CALL_WINDOWS = CALLS + f"""
    SELECT time_bucket(INTERVAL 6 HOURS, started) AS window_start, tool, count(*) AS calls, count(*) FILTER (WHERE outcome = 'tool.success') AS succeeded,
      count(*) FILTER (WHERE outcome = 'tool.error') AS failed, count(*) FILTER (WHERE outcome IS NULL) AS never_finished,
      {hu("count(*) FILTER (WHERE outcome = 'tool.success') / nullif(count(outcome), 0)", 4)} AS success_rate,
      quantile_disc(elapsed_ms, 0.5) AS p50_ms, quantile_disc(elapsed_ms, 0.95) AS p95_ms
    FROM calls WHERE time_bucket(INTERVAL 6 HOURS, started) + INTERVAL 6 HOURS <= (SELECT max(ts) FROM events) - INTERVAL 2 HOUR GROUP BY ALL
"""


@query("tool_log_stream", f"""
    SELECT event_id AS invocation_id, 'tool_' || event_type AS tool, ts AS started,
      CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_type = 'error' THEN 'tool.error' ELSE 'tool.success' END AS outcome,
      CASE WHEN event_id % 13 <> 0 THEN CAST(round(value * 10) AS BIGINT) END AS elapsed_ms
    FROM events WHERE event_id % 13 <> 0 OR ts + INTERVAL 1 HOUR < (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def tool_log_stream(lake):
    """Finished calls, and those that can no longer finish within an hour."""
    rows = run.run_to_table(_paired_stream(run.stream_table(lake, "events", "ts")), "calls")
    return rows.withColumn("started", F.col("started").cast("timestamp_ntz"))


def _paired_stream(events):
    starts = events.select(
        F.col("event_id").alias("invocation_id"), F.concat(F.lit("tool_"), "event_type").alias("tool"), F.col("ts").alias("started")
    )
    elapsed = F.round(F.col("value") * 10).cast("long")
    ends = events.where("event_id % 13 <> 0").select(
        F.col("event_id").alias("end_id"),
        (F.col("ts") + F.make_dt_interval(secs=elapsed / F.lit(1000))).alias("ended"),
        F.when(F.col("event_type") == "error", monitor.ERROR).otherwise(monitor.SUCCESS).alias("outcome"),
        elapsed.alias("elapsed_ms"),
    )
    return monitor.paired_calls_stream(starts, ends, "1 hour", "1 HOUR")


# Events of a trigger for each core, so that the heap holds their state.
CORE_EVENTS = 150_000


def _events_by_time(lake):
    """The events as a stream, and a store for the state of calls.

    A long log comes in the order of time, so a trigger's state is that of its slice and of the two
    hours before, in which a call's end may follow. If these are many events, the state is on disk.
    """
    rows = lake.table("events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type", "value")
    count, most = rows.count(), CORE_EVENTS * lake.spark.sparkContext.defaultParallelism
    if count <= most:
        return run.stream_table(lake, "events", "ts"), run.ON_HEAP
    # Any three hours are in two of these windows; rows without time stay in the state.
    dense, timed = rows.groupBy(F.window("ts", "3 hours")).count().agg(F.max("count"), F.sum("count")).first()
    store = run.ON_HEAP if 2 * (dense or 0) + count - (timed or 0) <= most else run.ROCKSDB
    folder = session.work_path(lake.spark, "events-by-time")
    files = run.deal(rows, "ts", count, ceil(count / most), folder)
    return lake.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(folder), store


@query("tool_log_figures_stream", CALL_WINDOWS)
def tool_log_figures_stream(lake):
    """Six hours' figures of each tool, of the windows whose calls have all been paired."""
    events, store = _events_by_time(lake)
    with run.bounded_state(lake.spark, store):
        rows = run.run_to_table(monitor.call_figures_stream(_paired_stream(events), "started", "6 hours"), "call-figures")
    return rows.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
