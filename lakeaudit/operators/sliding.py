"""Counts and sums along time or order that stay spread over tasks for hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def sliding_counts(
    df: DataFrame, client: str, ts: str, window_seconds: int, out: str = "requests", slices: int = 4
) -> DataFrame:
    """Rows of the same client in the window ending at each row, both ends included.

    A client's timeline is cut into slices of a few windows. The rows of a slice's
    last window are copied into the next one as context, so a hot client becomes many
    small groups and every count stays exact.
    """
    width = int(window_seconds * 1_000_000)
    span = width * slices
    # Whole-number division rounding down, also before 1970.
    home = F.expr(f"(_us - pmod(_us, {span}L)) div {span}L")
    in_last_window = F.pmod("_us", F.lit(span)) >= span - width
    copies = F.when(in_last_window, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
    spread = (
        df.withColumn("_us", F.unix_micros(F.col(ts).cast("timestamp")))
        .withColumn("_home", home)
        .withColumn("_slice", F.explode(copies))
    )
    frame = Window.partitionBy(client, "_slice").orderBy("_us").rangeBetween(-width, 0)
    counted = spread.withColumn(out, F.count(F.lit(1)).over(frame))
    return counted.where(F.col("_slice") == F.col("_home")).drop("_us", "_home", "_slice")


def running_sum(df: DataFrame, key: str, order: str, value: str, out: str, chunk: int = 10_000) -> DataFrame:
    """Sum of ``value`` up to each row of its key, by a whole-number order column.

    Each key is cut into chunks of the order column: sums inside the chunks, plus the
    totals of the chunks before, which are one row per chunk.
    """
    cut = df.withColumn("_chunk", F.expr(f"{order} div {int(chunk)}"))
    totals = cut.groupBy(key, "_chunk").agg(F.sum(value).alias("_total"))
    before = Window.partitionBy(key).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(key, "_chunk", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_chunk").orderBy(order)
    return (
        cut.withColumn("_part", F.sum(value).over(inside))
        .join(starts, [key, "_chunk"])
        .withColumn(out, F.col("_start") + F.col("_part"))
        .drop("_chunk", "_part", "_start")
    )
