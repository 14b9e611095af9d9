"""The limiter's rules, their parallel form, and the stream over several triggers."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeaudit.streaming import limiter, run
from lakeaudit.streaming.limits import SECOND, Client, Effect, Limits
from lakeaudit.suite import QUERIES, streams


def simulate(seconds, limits, start=0):
    client = Client(violations=start)
    return [client.check(s * SECOND, limits) for s in seconds], client


def test_breaker_trips():
    answers, _ = simulate([0, 0, 0], Limits(60, 2, 5, 1))
    assert answers == [(True, None), (True, None), (False, 5)]


def test_wait_until_the_oldest_leaves_the_window():
    answers, client = simulate([100, 104, 105], Limits(10, 2, 60, 3))
    assert answers[-1] == (False, 5) and client.violations == 1 and client.blocked_until == 0


def test_limits_must_be_positive():
    with pytest.raises(ValueError):
        Limits(window=0)


LIMITS = st.builds(Limits, st.integers(1, 8), st.integers(1, 6), st.integers(1, 8), st.integers(1, 4))
TIMES = st.lists(st.integers(0, 60), min_size=1, max_size=80).map(sorted)


@settings(max_examples=300, deadline=None)
@given(LIMITS, TIMES)
def test_fast_run_equals_single_checks(limits, times):
    allowed, retry = Client().run(np.array(times) * SECOND, limits)
    answers, _ = simulate(times, limits)
    assert [(bool(a), int(r) or None) for a, r in zip(allowed, retry)] == answers


@settings(max_examples=300, deadline=None)
@given(LIMITS, TIMES, st.integers(0, 12))
def test_effect_covers_every_start(limits, times, start):
    effect = Effect()
    for t in times:
        effect.check(t * SECOND, limits)
    fitting = [p for p in effect.rows() if p[0] <= start and (p[1] is None or start <= p[1])]
    assert len(fitting) == 1
    _, _, count, shift = fitting[0]
    _, client = simulate(times, limits, start)
    assert client.violations == (start + shift if count is None else count)


@settings(max_examples=100, deadline=None)
@given(LIMITS, TIMES)
def test_accepted_never_exceed_the_limit(limits, times):
    answers, _ = simulate(times, limits)
    accepted = [t for t, (ok, _) in zip(times, answers) if ok]
    assert all(sum(t - limits.window <= a <= t for a in accepted) <= limits.max_requests for t in accepted)


def request_rows(seed=3):
    """One client has most of the rows, in bursts with long and short pauses."""
    rng = np.random.default_rng(seed)
    rows, n = [], 0
    for client, count in (("hot", 1500), ("a", 200), ("b", 40), ("c", 3)):
        pauses = rng.choice([0, 1, 2, 7, 40], size=count, p=[0.3, 0.4, 0.2, 0.07, 0.03])
        for t in np.cumsum(pauses):
            rows.append((n, client, int(t)))
            n += 1
    return rows


@pytest.mark.parametrize("limits", [Limits(10, 5, 8, 2), Limits(10, 8, 12, 3), Limits(5, 2, 3, 1)])
def test_batch_equals_simulation(spark, limits):
    rows = request_rows()
    df = spark.createDataFrame(rows, "id long, client string, t long").select(
        "id", "client", F.timestamp_seconds("t").alias("ts")
    )
    got = {r["id"]: (r["allowed"], r["retry_after"]) for r in limiter.rate_limit(df, "client", "ts", "id", limits).collect()}
    assert len(got) == len(rows)
    for client in ("hot", "a", "b", "c"):
        own = sorted((t, i) for i, c, t in rows if c == client)
        answers, _ = simulate([t for t, _ in own], limits)
        assert [got[i] for _, i in own] == answers


@pytest.mark.parametrize("seed", range(3))
def test_clients_that_never_pause_stay_in_spark(spark, seed):
    """Mostly compliant, never quiet for window and breaker, with a few bursts: only those are walked through."""
    limits, rng, rows = Limits(20, 6, 15, 3), np.random.default_rng(seed), []
    for client in ("busy", "calm"):
        pauses = rng.choice([4, 5, 9], size=1500)
        if client == "busy":
            for at in rng.integers(0, 1500, 12):
                pauses[at : at + 12] = rng.choice([0, 1])
        rows += [(len(rows) + n, client, int(t)) for n, t in enumerate(np.cumsum(pauses))]
    df = spark.createDataFrame(rows, "id long, client string, t long").select("id", "client", F.timestamp_seconds("t").alias("ts"))
    got = {r["id"]: (r["allowed"], r["retry_after"]) for r in limiter.rate_limit(df, "client", "ts", "id", limits).collect()}
    for client in ("busy", "calm"):
        own = sorted((t, i) for i, c, t in rows if c == client)
        assert max(b[0] - a[0] for a, b in zip(own, own[1:])) <= limits.window + limits.breaker
        answers, _ = simulate([t for t, _ in own], limits)
        assert [got[i] for _, i in own] == answers
    keyed = df.withColumns({"_client": F.col("client"), "_us": F.unix_micros("ts")})
    walked = limiter._placed(keyed, df.columns, "id", limits).where("NOT _settled").groupBy("client").count().collect()
    assert {r["client"] for r in walked} == {"busy"} and walked[0]["count"] < 600


@pytest.mark.parametrize("files, per_trigger", [(6, 1), (5, 3), (1, 1)])
def test_stream_in_any_order_equals_batch(spark, tmp_path, files, per_trigger):
    limits, rows = Limits(10, 5, 8, 2), request_rows()
    shuffled = list(rows)
    random.Random(files).shuffle(shuffled)
    schema = "id long, client string, t long"
    parts = [shuffled[i::files] for i in range(files)] + [[(-1, "mark", 10**6)]]
    for part in parts:
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(str(tmp_path / "in"))
    timed = stream.select("id", "client", F.timestamp_seconds(F.col("t") + 10**7).alias("ts")).withWatermark("ts", "100000 seconds")
    with run.state_store(spark):
        decided = limiter.rate_limit_stream(timed, "client", "ts", "id", limits)
        out = run.run_to_table(decided, "limiter", path=str(tmp_path / "out"))
    got = {r["id"]: (r["allowed"], r["retry_after"]) for r in out.collect()}
    assert len(got) == len(rows)
    for client in ("hot", "a", "b", "c"):
        own = sorted((t, i) for i, c, t in rows if c == client)
        answers, _ = simulate([t for t, _ in own], limits)
        assert [got[i] for _, i in own] == answers


def test_registered_streams_decide_a_log_of_a_year(spark, tmp_path):
    rng, limits, rows = np.random.default_rng(4), streams.LIMITS, []
    for user in (1, 2, 3):
        # Bursts, pauses of hours, and some longer than window and breaker.
        pauses = rng.choice([600, 14_400, 100_000, 1_000_000], size=300, p=[0.6, 0.2, 0.1, 0.1])
        rows += [(1000 * user + n, user, int(t)) for n, t in enumerate(np.cumsum(pauses))]
    assert max(t for _, _, t in rows) > 300 * 86_400
    events = spark.createDataFrame(rows, "event_id long, user_id long, t long")
    events.select("event_id", "user_id", F.timestamp_seconds(F.col("t") + 10**9).alias("ts")).write.parquet(str(tmp_path / "events.parquet"))
    for name, expire in (("rate_limit_stream", False), ("rate_limit_expiring_stream", True)):
        got = {r["event_id"]: (r["allowed"], r["retry_after"]) for r in QUERIES[name](spark, str(tmp_path)).collect()}
        assert len(got) == len(rows)
        for user in (1, 2, 3):
            own, client, before = sorted((t, n) for n, u, t in rows if u == user), Client(), None
            for t, n in own:
                if expire and before is not None and t - before > limits.window + limits.breaker:
                    client = Client()
                assert got[n] == client.check((t + 10**9) * SECOND, limits)
                before = t


def test_stream_forgets_old_clients(spark, tmp_path):
    limits = Limits(10, 1, 10, 9)
    schema = "id long, client string, t long"
    # Two violations of "a" are forgotten when it asks again after a long pause.
    for part in ([(1, "a", 100), (2, "a", 101)], [(3, "b", 500)], [(4, "b", 1000), (5, "a", 1000), (6, "a", 1001)], [(-1, "mark", 10**6)]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    timed = stream.select("id", "client", F.timestamp_seconds("t").alias("ts")).withWatermark("ts", "0 seconds")
    with run.state_store(spark):
        decided = limiter.rate_limit_stream(timed, "client", "ts", "id", limits, expire=True)
        out = run.run_to_table(decided, "limiter", path=str(tmp_path / "out"))
    got = {r["id"]: r["allowed"] for r in out.collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: False}


def test_state_expiry(spark):
    df = spark.createDataFrame(
        [("stale", 9000, True), ("empty", 9990, False), ("fresh", 9999, True), ("fresh", 10000, False)], "c string, t long, allowed boolean"
    ).select("c", F.timestamp_seconds("t").alias("ts"), "allowed")
    rows = {r["c"]: r["expired"] for r in limiter.state_expiry(df, df, "c", "ts", Limits(60, 1, 10, 1)).collect()}
    assert rows == {"stale": True, "empty": True, "fresh": False}


@pytest.mark.parametrize("expire", [False, True])
def test_clients_share_rows_of_state(spark, tmp_path, expire):
    """Many clients, one of them missing, with ids that come again and times that tie, over several triggers."""
    limits, rng, rows = Limits(10, 5, 8, 2), random.Random(5), []
    for client in [None, *(f"c{n}" for n in range(60))]:
        t = 0
        for _ in range(30):
            t += rng.choice([0, 0, 1, 2, 7, 40])
            rows.append((rng.randrange(10**6) + 2**60, client, t, rng.random()))
    schema, span = "id long, client string, t long, load double", max(r[2] for r in rows) + 1
    for k in range(5):
        part = [r for r in rows if r[2] * 5 // span == k] or [(-1, "mark", 0, 0.0)]
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    spark.createDataFrame([(-1, "mark", 10**6, None)], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    timed = stream.select("id", "client", F.timestamp_seconds(F.col("t") + 10**7).alias("ts"), "load").withWatermark("ts", "3 seconds")
    with run.state_store(spark):
        decided = limiter.rate_limit_stream(timed, "client", "ts", "id", limits, expire)
        query = (
            decided.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "checkpoint"))
            .trigger(availableNow=True).start(str(tmp_path / "out"))
        )
        query.awaitTermination()
    got = {}
    for r in spark.read.schema(decided.schema).parquet(str(tmp_path / "out")).where("id >= 0").collect():
        got.setdefault(r["client"], []).append((int(r["ts"].timestamp()) - 10**7, r["id"], r["load"], r["allowed"], r["retry_after"]))
    for key in {r[1] for r in rows}:
        own, client, before, want = sorted((t, i, load) for i, c, t, load in rows if c == key), Client(), None, []
        for t, i, load in own:
            if expire and before is not None and t - before > limits.window + limits.breaker:
                client = Client()
            want.append((t, i, load, *client.check((t + 10**7) * SECOND, limits)))
            before = t
        assert sorted(got.pop(key)) == want
    assert not got
    # As many clients in fewer rows of state.
    with run.bounded_state(spark):
        few = limiter.rate_limit_stream(timed, "client", "ts", "id", limits, expire, buckets=8)
        query = few.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "few")).trigger(availableNow=True).start()
        query.awaitTermination()
    assert max(o["numRowsUpdated"] for p in query.recentProgress for o in p["stateOperators"]) <= 9
