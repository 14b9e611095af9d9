"""Grouped sums, conditional counts and bands."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.numbers import half_up, mean

# Lower bounds of the two fragmentation bands.
SEVERE_FROM = 30.0
MEDIUM_FROM = 10.0
# Unit of a storage page in KB, and digits of a size in MB.
PAGE_KB = 8
SIZE_TYPE = "decimal(18,4)"


def space_by_group(df: DataFrame, keys: Sequence[str], total: Column, used: Column) -> DataFrame:
    """Rows, and total, used and unused space in KB by group, from page numbers."""
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        (F.sum(total) * PAGE_KB).cast("long").alias("total_kb"),
        (F.sum(used) * PAGE_KB).cast("long").alias("used_kb"),
        ((F.sum(total) - F.sum(used)) * PAGE_KB).cast("long").alias("unused_kb"),
    )


def size_by_group(df: DataFrame, keys: Sequence[str], pages: Column) -> DataFrame:
    """Size in MB with four digits by group."""
    mb = F.sum(pages).cast("decimal(20,0)") * F.lit(PAGE_KB) / F.lit(1024)
    return df.groupBy(*keys).agg(mb.cast(SIZE_TYPE).alias("size_mb"))


def conditional_counts(df: DataFrame, conditions: Mapping[str, Column], total: str | None = "total") -> DataFrame:
    """One row of counts in one pass; a condition that is NULL does not count."""
    counts = [F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conditions.items()]
    return df.agg(*counts, *([F.count(F.lit(1)).alias(total)] if total else []))


def table_counts(inventory: DataFrame, names: Sequence[str]) -> DataFrame:
    """Row count of every table side by side; ``inventory`` has table_name and row_count."""
    count = lambda n: F.sum(F.when(F.col("table_name") == n, F.col("row_count")))
    return inventory.agg(*[F.coalesce(count(n), F.lit(0)).alias(f"{n}_rows") for n in names])


def severity_bands(rows: DataFrame, metric: str = "avg_fragmentation_in_percent") -> DataFrame:
    """Severe and medium rows and all rows; a missing metric counts as zero."""
    value = F.coalesce(F.col(metric), F.lit(0.0))
    return conditional_counts(
        rows,
        {"severe": value >= SEVERE_FROM, "medium": (value >= MEDIUM_FROM) & (value < SEVERE_FROM)},
        "total",
    )


def metric_kpis(df: DataFrame, metric: str, prefix: str, empty: float | None = None) -> DataFrame:
    """Average (two digits) and maximum; ``empty`` is the value for no rows."""
    average = half_up(mean(F.col(metric)), 2)
    highest = F.max(metric)
    if empty is not None:
        average, highest = F.coalesce(average, F.lit(empty)), F.coalesce(highest, F.lit(empty))
    return df.agg(average.alias(f"avg_{prefix}"), highest.alias(f"max_{prefix}"))


def zero_filled_counts(df: DataFrame, column: str, categories: Sequence[str], out: str = "issues") -> DataFrame:
    """Count of every listed category, also of those without rows."""
    spark = df.sparkSession
    listed = spark.createDataFrame([(i, c) for i, c in enumerate(categories)], f"ord int, {column} string")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias(out))
    return listed.join(counts, column, "left").select(
        column, F.coalesce(F.col(out), F.lit(0)).cast("long").alias(out)
    )
