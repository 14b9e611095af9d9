"""How many row groups a point lookup must read, from the bounds of row groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.functions.numbers import half_up
from lakeaudit.operators.paging import in_ranges

KEY = ["table_name", "column_name"]


def chunk_intervals(chunks: DataFrame) -> DataFrame:
    """(table_name, column_name, low, high) of the chunks with numbers as bounds."""
    return chunks.where("min_number IS NOT NULL").select(*KEY, F.col("min_number").alias("low"), F.col("max_number").alias("high"))


def depths(intervals: DataFrame, ranges: int | None = None) -> DataFrame:
    """(table_name, column_name, at, depth): at each bound how many intervals hold it.

    A sweep: an interval opens at its low bound and closes behind its high one, and the depth is what
    opened up to here less what closed before. Bounds lie in ranges of their order, each
    summed by a task of its own and moved up by the ranges before it, so no column's
    bounds meet in one task. Intervals without bounds are left out.
    """
    ends = F.array(F.struct(F.col("low").alias("at"), F.lit(1).alias("opens"), F.lit(0).alias("closes")), F.struct(F.col("high").alias("at"), F.lit(0).alias("opens"), F.lit(1).alias("closes")))
    bounded = intervals.where("low IS NOT NULL AND high IS NOT NULL")
    bounds = bounded.select(*KEY, F.explode(ends).alias("e")).select(*KEY, "e.*").groupBy(*KEY, "at").agg(F.sum("opens").alias("opens"), F.sum("closes").alias("closes"))
    dealt = in_ranges(bounds, [*KEY, "at"], ranges)
    sums = dealt.groupBy(*KEY, "_range").agg(F.sum("opens").alias("o"), F.sum("closes").alias("c"))
    # One row per column and range that it lies in.
    earlier = Window.partitionBy(*KEY).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*KEY, "_range", (F.coalesce(F.sum("o").over(earlier), F.lit(0)) - F.coalesce(F.sum("c").over(earlier), F.lit(0))).alias("_open"))
    inside = Window.partitionBy(*KEY, "_range").orderBy("at")
    closed = F.coalesce(F.sum("closes").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    swept = dealt.withColumn("_here", F.sum("opens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - closed)
    return swept.join(before, [*KEY, "_range"]).select(*KEY, "at", (F.col("_open") + F.col("_here")).alias("depth"))


def overlap_depth(intervals: DataFrame, ranges: int | None = None) -> DataFrame:
    """Per column the row groups, the distinct bounds, and the largest and mean number of groups that hold a bound.

    A depth of 1 is a clustered column: a lookup reads one group. A depth near the number of groups is
    a column whose bounds prune nothing.
    """
    found = depths(intervals, ranges).groupBy(*KEY).agg(F.max("depth").alias("max_depth"), F.avg("depth").alias("_mean"), F.count(F.lit(1)).alias("bounds"))
    groups = intervals.where("low IS NOT NULL AND high IS NOT NULL").groupBy(*KEY).agg(F.count(F.lit(1)).alias("groups"))
    return groups.join(found, KEY).select(*KEY, "groups", "bounds", "max_depth", half_up(F.col("_mean"), 4).alias("mean_depth"))
