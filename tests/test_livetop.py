"""The live list: batch and stream over several triggers, restarts and late rows, and the bound of its state."""

import random

from pyspark.sql import functions as F

from lakeaudit.streaming import livetop, run

ORDER = (("elapsed", True), ("id", False))
SCHEMA = "id long, at long, elapsed double, note string"
K, BUCKETS = 4, 3


def requests(seed=1, count=600):
    """Most rows in one window, ties, and missing values, in order of time."""
    rng = random.Random(seed)
    at = sorted(rng.choice([rng.randint(0, 3599), rng.randint(3600, 20_000)]) for _ in range(count))
    return [(n, t, rng.choice([None, float(rng.randint(0, 40))]), rng.choice([None, "a", "b"])) for n, t in enumerate(at)]


def plain(rows):
    out = set()
    for hour in {r[1] // 3600 for r in rows}:
        own = sorted((r for r in rows if r[1] // 3600 == hour), key=lambda r: (r[2] is None, -(r[2] or 0), r[0]))
        out |= {(hour, rank, r[0], r[2], r[3]) for rank, r in enumerate(own[:K], 1)}
    return out


def timed(df):
    return df.select("id", "elapsed", "note", F.timestamp_seconds("at").alias("ts"))


def listed(df):
    return {(r["hour"], r["rank"], r["id"], r["elapsed"], r["note"]) for r in df.withColumn("hour", F.unix_seconds("window_start") / 3600).collect()}


def write(spark, rows, folder):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))


def live(spark, tmp_path, delay="10 minutes"):
    stream = timed(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in")))
    return livetop.run_live_top(spark, stream, "ts", "1 hour", ORDER, "id", K, BUCKETS, delay, str(tmp_path / "out"))


def test_batch_list(spark):
    rows = requests() + [(9999, None, 50.0, "no time")]
    df = timed(spark.createDataFrame(rows, SCHEMA))
    assert listed(livetop.top_per_window(df, "ts", "1 hour", ORDER, K)) == plain(rows[:-1])
    plan = livetop.top_per_window(df, "ts", "1 hour", ORDER, K)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan


def test_stream_equals_batch_after_each_restart(spark, tmp_path):
    """Run, stopped and run again over new files: each time the list of all that came so far."""
    rows = requests()
    for end in (200, 230, 600):
        start = {200: 0, 230: 200, 600: 230}[end]
        for k in range(start, end, 130):
            write(spark, rows[k : min(k + 130, end)], tmp_path / "in")
        assert listed(live(spark, tmp_path)) == plain(rows[:end])
    assert listed(live(spark, tmp_path)) == plain(rows)
    with run.state_store(spark):
        state = spark.read.format("statestore").option("stateVarName", "best").load(str(tmp_path / "out" / "checkpoint"))
        held = state.count()
    windows = len({r[1] // 3600 for r in rows})
    # Windows that the watermark has passed hold nothing any more.
    assert 0 < held <= 2 * BUCKETS * K < windows * BUCKETS * K


def test_late_rows_are_dropped_and_lists_stay(spark, tmp_path):
    write(spark, [(1, 100, 5.0, "a")], tmp_path / "in")
    write(spark, [(2, 50_000, 1.0, "a")], tmp_path / "in")
    write(spark, [(3, 50_001, 2.0, "a")], tmp_path / "in")
    first = listed(live(spark, tmp_path))
    write(spark, [(4, 200, 99.0, "late")], tmp_path / "in")
    assert listed(live(spark, tmp_path)) == first == {(0, 1, 1, 5.0, "a"), (13, 1, 3, 2.0, "a"), (13, 2, 2, 1.0, "a")}


def test_no_rows(spark, tmp_path):
    write(spark, [(1, None, 1.0, "a")], tmp_path / "in")
    assert listed(live(spark, tmp_path)) == set()
