"""Column storage and overlap depth over several files and row groups, against the writer's own metadata and brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lakeaudit.operators import overlap
from lakeaudit.sources import footers
from lakeaudit.sources.tables import Lake
from lakeaudit.streaming import monitor, run


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("lake")
    rng = random.Random(1)
    rows = [(k, rng.randint(0, 999), rng.choice(["a", "b", None]), "x" * 200, [k]) for k in range(3000)]
    df = spark.createDataFrame(rows, "k long, r int, s string, wide string, xs array<long>")
    df.repartitionByRange(5, "k").sortWithinPartitions("k").write.option("parquet.block.size", 4096).parquet(str(folder / "t.parquet"))
    df.limit(0).write.parquet(str(folder / "none.parquet"))
    return Lake(spark, str(folder))


def test_chunks_equal_the_footers(lake, tmp_path):
    chunks = footers.column_chunks(lake, ["t", "none"])
    con = duckdb.connect()
    want = con.execute(f"""
        SELECT split_part(path_in_schema, ', ', 1), count(*), sum(num_values), sum(total_compressed_size), sum(total_uncompressed_size)
        FROM parquet_metadata('{lake.path("t")}/*.parquet') GROUP BY 1""").fetchall()
    got = {r.column_name: r for r in footers.column_storage(chunks).collect() if r.table_name == "t"}
    assert {(c, n, v, b, p) for c, n, v, b, p in want} == {(r.column_name, r.chunks, r["values"], r.compressed_bytes, r.plain_bytes) for r in got.values()}
    assert (got["k"].min_number, got["k"].max_number, got["k"].files, got["k"].null_count) == (0.0, 2999.0, 5, 0)
    assert (got["s"].min_text, got["s"].max_text) == ("a", "b") and got["s"].null_count == lake.table("t").where("s IS NULL").count()
    # Long texts and nested columns have no bounds.
    assert got["wide"].min_text is None and got["xs"].min_number is None
    assert abs(sum(r.share for r in got.values()) - 1) < 0.001


def test_no_data_is_read(lake):
    """The scan behind the footers lists files; it reads no column of the table."""
    plan = footers.column_chunks(lake, ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "binaryFile" in plan and "content" not in plan.split("ReadSchema")[-1]


def plain_depths(intervals):
    points = sorted({x for pair in intervals for x in pair})
    return [sum(low <= p <= high for low, high in intervals) for p in points]


@pytest.mark.parametrize("ranges", [1, 3, 8])
def test_depths_equal_brute_force(spark, ranges):
    rng = random.Random(ranges)
    sides = {"a": [(float(x), float(x + rng.randint(0, 40))) for x in (rng.randint(0, 100) for _ in range(60))], "b": [(float(k), k + 0.5) for k in range(20)], "c": [(5.0, 5.0)] * 7}
    rows = [("t", c, low, high) for c, own in sides.items() for low, high in own] + [("t", "none", None, None)]
    df = spark.createDataFrame(rows, "table_name string, column_name string, low double, high double")
    got = {r.column_name: r for r in overlap.overlap_depth(df, ranges).collect()}
    assert got.keys() == sides.keys()
    for c, own in sides.items():
        depths = plain_depths(own)
        assert (got[c].groups, got[c].bounds, got[c].max_depth) == (len(own), len(depths), max(depths))
        assert got[c].mean_depth == pytest.approx(sum(depths) / len(depths), abs=1e-4)


def test_depth_from_footers(lake):
    chunks = footers.column_chunks(lake, ["t"])
    got = {r.column_name: r for r in overlap.overlap_depth(overlap.chunk_intervals(chunks)).collect()}
    # Sorted by k, so a lookup of k reads one group; the random column's bounds prune little, if groups have some rows.
    bounds = {c: [(r.low, r.high) for r in overlap.chunk_intervals(chunks).where(F.col("column_name") == c).collect()] for c in ("k", "r")}
    for c, own in bounds.items():
        assert (got[c].groups, got[c].max_depth) == (len(own), max(plain_depths(own)))
    assert got["k"].max_depth == 1 and got["r"].max_depth > got["r"].groups / 2


def test_stream_figures_over_several_triggers(spark, tmp_path):
    rng = random.Random(2)
    schema = "id long, tool string, at long, ms long, good boolean"
    rows = [(k, rng.choice("ab"), 3_600_000 + 60 * k, rng.choice([None, rng.randint(1, 90_000)]), rng.random() < 0.8) for k in range(900)]
    for k in range(0, 900, 300):
        spark.createDataFrame(rows[k : k + 300], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    calls = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    starts = calls.select(F.col("id").alias("invocation_id"), "tool", F.timestamp_seconds("at").alias("started"))
    ends = calls.where("ms IS NOT NULL").select(
        F.col("id").alias("end_id"), F.timestamp_millis(F.col("at") * 1000 + F.col("ms")).alias("ended"),
        F.when(F.col("good"), monitor.SUCCESS).otherwise(monitor.ERROR).alias("outcome"), F.col("ms").alias("elapsed_ms"),
    )
    figures = monitor.call_figures_stream(monitor.paired_calls_stream(starts, ends, "10 minutes", "10 MINUTES"), "started", "1 hour")
    got = run.run_to_table(figures, "figures", path=str(tmp_path / "out")).withColumn("hour", F.unix_seconds("window_start") / 3600).collect()
    assert len(got) == len({(r.hour, r.tool) for r in got}) >= 20
    for r in got:
        own = [x for x in rows if x[1] == r.tool and x[2] // 3600 == r.hour]
        done = sorted(x[3] for x in own if x[3] is not None)
        assert (r.calls, r.succeeded, r.never_finished) == (len(own), sum(x[3] is not None and x[4] for x in own), len(own) - len(done))
        assert (r.p50_ms, r.p95_ms) == (done[-(-len(done) // 2) - 1], done[-(-len(done) * 95 // 100) - 1])
