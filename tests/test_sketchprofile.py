"""Profiles from sketches per file: bounds of their error, and what an appended, changed or removed file costs."""

import os

import pytest
from pyspark.sql import functions as F

from lakeaudit.operators import sketchprofile
from lakeaudit.sources.tables import Lake


@pytest.fixture()
def lake(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id", "id % 700 AS few", "if(id % 10 = 0, NULL, cast(pow(id, 1.5) AS double)) AS x", "concat('t', id % 3000) AS s", "array(id) AS xs")
    rows.repartition(4, "id").write.parquet(str(tmp_path / "t.parquet"))
    return Lake(spark, str(tmp_path))


def check(lake, sketches):
    table, got = lake.table("t"), {r.column_name: r for r in sketchprofile.merged(sketches).collect()}
    assert set(got) == set(table.columns)
    for c, r in got.items():
        exact = table.agg(F.count(F.lit(1)), F.count_if(F.col(c).isNull()), F.count_distinct(c)).first()
        assert (r.row_count, r.null_count) == exact[:2] and abs(r.distinct_count - exact[2]) <= 0.06 * exact[2]
    values = sorted(r[0] for r in table.where("x IS NOT NULL").select("x").collect())
    for q in (5, 50, 95):
        rank = sum(v <= got["x"][f"q{q:02}"] for v in values) / len(values)
        assert abs(rank - q / 100) <= 0.03
    assert (got["x"].min_number, got["x"].max_number) == (values[0], values[-1]) and got["s"].q50 is None


def test_only_new_and_changed_files_are_scanned(spark, lake, tmp_path):
    first, scanned = sketchprofile.refreshed(lake, "t")
    assert scanned == 4
    check(lake, first)
    same, scanned = sketchprofile.refreshed(lake, "t", first)
    assert scanned == 0 and same.count() == first.count()
    lake.table("t").limit(500).withColumn("id", F.col("id") + 10**6).coalesce(1).write.mode("append").parquet(str(tmp_path / "t.parquet"))
    lake = Lake(spark, str(tmp_path))
    more, scanned = sketchprofile.refreshed(lake, "t", same)
    assert scanned == 1
    check(lake, more)
    gone = sorted(p for p in (tmp_path / "t.parquet").iterdir() if p.suffix == ".parquet")[0]
    os.remove(gone)
    spark.catalog.refreshByPath(str(tmp_path / "t.parquet"))
    lake = Lake(spark, str(tmp_path))
    less, scanned = sketchprofile.refreshed(lake, "t", more)
    assert scanned == 0 and less.select("file_path").distinct().count() == 4
    check(lake, less)


def test_table_without_rows(spark, tmp_path):
    spark.createDataFrame([], "a int, b string").write.parquet(str(tmp_path / "none.parquet"))
    sketches, _ = sketchprofile.refreshed(Lake(spark, str(tmp_path)), "none")
    assert sketchprofile.merged(sketches).collect() == []
