"""Sessions, windowed figures and paired execution logs, in batch and on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeaudit.functions.numbers import half_up, money
from lakeaudit.operators import paging

# Kinds of rows in an execution log.
START, SUCCESS, ERROR = "tool.start", "tool.success", "tool.error"


# --- sessions -----------------------------------------------------------------

def _numbered_runs(df: DataFrame, keys: list[str], start: str, end: str, gap_us: int) -> DataFrame:
    """Number the runs of a key's rows that are less than a gap apart."""
    order = Window.partitionBy(*keys).orderBy(start)
    pause = F.col(start) - F.lag(end).over(order) >= gap_us
    return df.withColumn("_new", F.coalesce(pause, F.lit(False)).cast("int")).withColumn("_run", F.sum("_new").over(order)).drop("_new")


def sessions(df: DataFrame, key: str, ts: str, gap_seconds: int, slice_seconds: int = 86_400) -> DataFrame:
    """Sessions of a key, closed by a pause of the gap length.

    Sessions are first built inside time slices, which spreads a hot key over tasks, and
    then joined across slices, where a key has few rows left.
    """
    gap_us = gap_seconds * 1_000_000
    rows = df.select(key, F.unix_micros(F.col(ts).cast("timestamp")).alias("_from"))
    sliced = rows.withColumns({"_to": F.col("_from"), "_slice": F.floor(F.col("_from") / F.lit(slice_seconds * 1_000_000))})
    parts = _numbered_runs(sliced, [key, "_slice"], "_from", "_to", gap_us).groupBy(key, "_slice", "_run").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.count(F.lit(1)).alias("_n")
    )
    joined = _numbered_runs(parts.drop("_run"), [key], "_from", "_to", gap_us).groupBy(key, "_run").agg(
        F.min("_from").alias("_from"), F.max("_to").alias("_to"), F.sum("_n").alias("events")
    )
    at = lambda c: F.timestamp_micros(F.col(c)).cast("timestamp_ntz")
    return joined.select(
        key, at("_from").alias("session_start"),
        (at("_to") + F.make_dt_interval(secs=F.lit(gap_seconds))).alias("session_end"), "events",
    )


def sessions_stream(stream: DataFrame, key: str, ts: str, gap_seconds: int, delay: str) -> DataFrame:
    """The same sessions on a stream; each comes out once the watermark has passed its end."""
    grouped = stream.withWatermark(ts, delay).groupBy(key, F.session_window(ts, f"{gap_seconds} seconds").alias("w"))
    return grouped.agg(F.count(F.lit(1)).alias("events")).select(
        key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "events"
    )


# --- windowed counts and figures ----------------------------------------------

def _status_counts(active: Column, idle: Column) -> list[Column]:
    return [F.count_if(active).alias("active"), F.count_if(idle).alias("idle"), F.count(F.lit(1)).alias("total")]


def status_windows(df: DataFrame, ts: str, active: Column, idle: Column, width: str, delay: str | None = None) -> DataFrame:
    """Active, idle and all rows per time window; with a delay for streams."""
    timed = df.withWatermark(ts, delay) if delay else df
    counted = timed.groupBy(F.window(ts, width).alias("w")).agg(*_status_counts(active, idle))
    return counted.select(F.col("w.start").alias("window_start"), "active", "idle", "total")


def _figures(value: Column) -> list[Column]:
    return [F.count(F.lit(1)).alias("rows"), F.sum(money(value)).alias("_sum"), F.max(value).alias("max_value")]


def _finished(df: DataFrame, key: str) -> DataFrame:
    average = half_up(F.col("_sum").cast("double") / F.col("rows"), 4)
    return df.select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "rows", average.alias("avg_value"), "max_value"
    )


def windowed_kpis(df: DataFrame, ts: str, key: str, value: str, width: str) -> DataFrame:
    """Rows, average and maximum per window and key."""
    return _finished(df.groupBy(F.window(ts, width).alias("w"), key).agg(*_figures(F.col(value))), key)


def sliding_kpis(df: DataFrame, ts: str, key: str, value: str, panes: int, pane_seconds: int) -> DataFrame:
    """The same for windows of several panes, moved by one pane.

    Rows are aggregated once into panes; only pane rows are copied into their windows.
    """
    grouped = df.groupBy(F.window(ts, f"{pane_seconds} seconds").alias("p"), key).agg(*_figures(F.col(value)))
    shift = lambda c, n: c + F.make_dt_interval(secs=n * F.lit(pane_seconds))
    copies = grouped.withColumn("_n", F.explode(F.sequence(F.lit(0), F.lit(panes - 1))))
    windows = copies.withColumn("w", F.struct(
        shift(F.col("p.start"), F.col("_n") - (panes - 1)).alias("start"), shift(F.col("p.end"), F.col("_n")).alias("end"),
    ))
    return _finished(windows.groupBy("w", key).agg(
        F.sum("rows").alias("rows"), F.sum("_sum").alias("_sum"), F.max("max_value").alias("max_value")
    ), key)


def kpis_stream(stream: DataFrame, ts: str, key: str, value: str, width: str, slide: str, delay: str) -> DataFrame:
    windows = F.window(ts, width, slide).alias("w")
    return _finished(stream.withWatermark(ts, delay).groupBy(windows, key).agg(*_figures(F.col(value))), key)


def late_rows(df: DataFrame, order: str, ts: str, delay_seconds: int, ranges: int | None = None) -> DataFrame:
    """Rows a watermark of this delay could drop, when rows arrive in ``order``.

    A row is late when it lies more than the delay before the highest time seen. The
    highest time up to a row is the one of the ranges before it or inside its range.
    """
    rows = paging.in_ranges(df.select(order, F.unix_micros(F.col(ts).cast("timestamp")).alias("_us")), [order], ranges)
    tops = rows.groupBy("_range").agg(F.max("_us").alias("_top"))
    # One row per range.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(tops.select("_range", F.max("_top").over(before).alias("_before")))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    seen = rows.withColumn("_inside", F.max("_us").over(inside)).join(starts, "_range")
    highest = F.greatest("_inside", "_before")
    late = F.coalesce(F.col("_us") < highest - F.lit(delay_seconds * 1_000_000), F.lit(False))
    return seen.agg(F.count(F.lit(1)).alias("rows"), F.count_if(late).alias("late_rows"))


# --- execution log ------------------------------------------------------------

def paired_calls(log: DataFrame) -> DataFrame:
    """One row per invocation with its outcome, the rows of its result, or its error text.

    An unfinished call has none of them. The outcome is aggregated as a number and the tool is
    part of the key, as texts among the aggregates would turn the hash aggregation into a
    sort; for the same reason error texts, which are few, are joined.
    """
    phase = F.col("phase")
    ended = F.max(F.when(phase == SUCCESS, 2).when(phase == ERROR, 1))
    grouped = log.groupBy("invocation_id", "tool").agg(
        F.min(F.when(phase == START, F.col("ts"))).alias("started"),
        ended.alias("_ended"),
        F.max("elapsed_ms").alias("elapsed_ms"),
        F.max("result_rows").alias("result_rows"),
    )
    errors = log.where(phase == ERROR).select("invocation_id", "tool", "error_text").dropDuplicates(["invocation_id", "tool"])
    outcome = F.when(F.col("_ended") == 2, SUCCESS).when(F.col("_ended") == 1, ERROR)
    return grouped.join(errors, ["invocation_id", "tool"], "left").select(
        "invocation_id", "tool", "started", outcome.alias("outcome"), "elapsed_ms", "result_rows",
        F.when(F.col("_ended") == 1, F.col("error_text")).alias("error_text"),
    )


def call_figures(calls: DataFrame) -> DataFrame:
    """Success rate, never finished calls, and elapsed median and 95th percentile by tool.

    Percentiles are exact: they come from counts per elapsed millisecond, whose number
    is bounded by the longest call and not by the number of calls.
    """
    counted = calls.groupBy("tool", "elapsed_ms").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("outcome") == SUCCESS).alias("ok"),
        F.count_if(F.col("outcome") == ERROR).alias("bad"),
    )
    part = lambda p: half_up(F.percentile("elapsed_ms", F.lit(p), F.col("n")), 4)
    return counted.groupBy("tool").agg(
        F.sum("n").alias("calls"),
        F.sum("ok").alias("succeeded"),
        F.sum("bad").alias("failed"),
        (F.sum("n") - F.sum("ok") - F.sum("bad")).alias("never_finished"),
        half_up(F.try_divide(F.sum("ok"), F.sum("ok") + F.sum("bad")), 4).alias("success_rate"),
        part(0.5).alias("p50_ms"),
        part(0.95).alias("p95_ms"),
    )


def paired_calls_stream(starts: DataFrame, ends: DataFrame, delay: str, longest: str) -> DataFrame:
    """Starts joined with their end, if it comes within the longest call.

    An unfinished call comes out once the watermark shows that no end can follow.
    ``starts`` has invocation_id, tool, started; ``ends`` has end_id, ended, outcome, elapsed_ms.
    """
    left, right = starts.withWatermark("started", delay), ends.withWatermark("ended", delay)
    match = F.expr(f"invocation_id = end_id AND ended >= started AND ended <= started + INTERVAL {longest}")
    return left.join(right, match, "left_outer").drop("end_id", "ended")


# A quantile sketch of so many values or fewer is exact.
SKETCH_SIZE = 200


def call_figures_stream(calls: DataFrame, started: str, width: str) -> DataFrame:
    """Figures of each tool and window of starts, in append mode, over what ``paired_calls_stream`` gives.

    Each group holds two counts and a quantile sketch, however many calls it has; a group comes out
    once when the watermark shows that all its calls have been paired. Quantiles are values that
    occur: exact up to ``SKETCH_SIZE`` finished calls of a group, beyond within about 1.3 per cent of rank.
    """
    grouped = calls.groupBy(F.window(started, width).alias("w"), "tool").agg(
        F.count(F.lit(1)).alias("calls"), F.count_if(F.col("outcome") == SUCCESS).alias("succeeded"), F.count_if(F.col("outcome") == ERROR).alias("failed"),
        F.kll_sketch_agg_bigint("elapsed_ms", SKETCH_SIZE).alias("_sketch"),
    )
    finished = F.col("succeeded") + F.col("failed")
    part = lambda q: F.when(finished > 0, F.kll_sketch_get_quantile_bigint("_sketch", F.lit(q)))
    return grouped.select(
        F.col("w.start").alias("window_start"), "tool", "calls", "succeeded", "failed", (F.col("calls") - finished).alias("never_finished"),
        half_up(F.try_divide("succeeded", finished), 4).alias("success_rate"), part(0.5).alias("p50_ms"), part(0.95).alias("p95_ms"),
    )
