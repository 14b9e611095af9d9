"""Logs dealt by time, and the streams over them."""

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lakeaudit import session
from lakeaudit.streaming import run
from lakeaudit.suite import QUERIES, streams


def times_of(spark, folder):
    """(times, files) of the log's files, the oldest file first."""
    files = sorted(Path(folder).glob("*.parquet"), key=lambda f: f.stat().st_mtime_ns)
    return [[r[0] for r in spark.read.parquet(str(f)).select(F.unix_seconds("ts")).collect()] for f in files]


@pytest.mark.parametrize("slices, file_rows", [(1, 100), (4, 100), (5, 7), (40, 1)])
def test_a_log_is_dealt_into_whole_slices_in_the_order_of_time(spark, tmp_path, monkeypatch, slices, file_rows):
    monkeypatch.setattr(run, "FILE_ROWS", file_rows)
    # Half of the rows have one time, and one is far from all others.
    seconds = [*range(100), *[50] * 100, -10**9, None, None]
    random.Random(slices).shuffle(seconds)
    rows = spark.createDataFrame([(t,) for t in seconds], "t long").select(F.timestamp_seconds("t").alias("ts"))
    files = run.deal(rows, "ts", len(seconds), slices, str(tmp_path / "log"))
    times = times_of(spark, tmp_path / "log")
    assert len(times) % files == 0
    whole = [sum(times[k : k + files], []) for k in range(0, len(times), files)]
    assert sorted(map(str, sum(whole, []))) == sorted(map(str, seconds))
    assert None not in sum(whole[:-1], [])
    known = [[t for t in part if t is not None] for part in whole]
    known = [part for part in known if part]
    assert all(max(a) < min(b) for a, b in zip(known, known[1:]))
    assert slices == 1 or len(known) > 1


def test_call_figures_hold_a_part_of_the_log_at_a_time(spark, tmp_path, monkeypatch):
    rng, kinds = random.Random(6), ("view", "click", "error")
    rows = [(n, rng.randrange(5 * 86_400), rng.choice(kinds), rng.choice([0.0, 7.5, 40.25, 250.0])) for n in range(3000)]
    # Ids and kinds that are missing, calls without time, and ids that come again.
    rows += [(None, 90_000, "view", 1.0), (3001, None, "view", 1.0), (3002, 100_000, None, 1.0), (3003, 100_001, "click", None), *rows[:50]]
    rows += [(n, rng.randrange(5 * 86_400), "view", 2.0) for n in range(40)]
    events = spark.createDataFrame(rows, "event_id long, t long, event_type string, value double")
    events.withColumn("ts", F.timestamp_seconds(F.col("t") + 10**9).cast("timestamp_ntz")).drop("t").write.parquet(str(tmp_path / "events.parquet"))
    shared, found = Path(session.shared_folder(spark).removeprefix("file:")), []
    # In one trigger; in slices with the state on the heap; and in slices that are shorter than the hours of a call.
    for events_for_core in (10**6, 150, 40):
        monkeypatch.setattr(streams, "CORE_EVENTS", events_for_core, raising=False)
        before = set(shared.glob("call-figures-*"))
        got = sorted(map(str, QUERIES["tool_log_figures_stream"](spark, str(tmp_path)).collect()))
        (made,) = set(shared.glob("call-figures-*")) - before
        found.append((got, len(list((made / "checkpoint" / "offsets").glob("[0-9]*"))), list((made / "checkpoint" / "state").rglob("*.changelog"))))
    (whole, few, first), (parts, some, heap), (small, many, disk) = found
    assert whole and parts == whole and small == whole
    assert few == 2 and some >= 5 and many >= 18
    assert disk and not first and not heap
