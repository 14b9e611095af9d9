"""Join shapes the analyses use.

No side is broadcast by hint: Catalyst does it when the measured size is below
``spark.sql.autoBroadcastJoinThreshold``, and AQE splits skewed shuffle partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def chain_join(base: DataFrame, steps: Sequence[tuple[DataFrame, Column]]) -> DataFrame:
    """Inner equi-joins along a chain of relations."""
    for other, condition in steps:
        base = base.join(other, condition, "inner")
    return base


def group_share(df: DataFrame, keys: Sequence[str], measure: str, total: str) -> DataFrame:
    """Each row with the total of its group, joined back on all group keys."""
    totals = df.groupBy(*keys).agg(F.sum(measure).alias(total))
    return df.join(totals, list(keys), "inner")


def left_with_defaults(
    left: DataFrame, right: DataFrame, on: Column, defaults: dict[str, object]
) -> DataFrame:
    """Left join; missing values of the named columns become defaults."""
    joined = left.join(right, on, "left")
    return joined.withColumns({n: F.coalesce(F.col(n), F.lit(v)) for n, v in defaults.items()})


def missing_flag(left: DataFrame, right: DataFrame, left_key: str, right_key: str, flag: str) -> DataFrame:
    """Flag 1 for rows without a partner.

    Only distinct keys of the right side are joined, so a hot key there neither
    moves nor multiplies rows.
    """
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    joined = left.join(keys, F.col(left_key) == F.col("_key"), "left")
    return joined.withColumn(flag, F.when(F.col("_key").isNull(), 1).otherwise(0)).drop("_key")


def best_per_key(df: DataFrame, key: str, order: Sequence[Column], keep: Sequence[str]) -> DataFrame:
    """The top row of every key as one partial aggregate: no group is gathered.

    A struct can't be an entry of Spark's hash aggregation, so each task sorts its rows by key.
    """
    best = F.max_by(F.struct(*keep), F.struct(*order)).alias("_best")
    return df.groupBy(key).agg(best).select(key, "_best.*")


def outer_apply_best(
    left: DataFrame, right: DataFrame, left_key: str, right_key: str, order: Sequence[Column], keep: Sequence[str]
) -> DataFrame:
    """Every left row with the top right row of its key, or NULLs."""
    best = best_per_key(right, right_key, order, keep)
    return left.join(best, F.col(left_key) == F.col(right_key), "left").drop(right_key)


def cross_apply_counts(left: DataFrame, right: DataFrame, left_key: str, right_key: str, out: str) -> DataFrame:
    """Left rows that have right rows, with their number."""
    counts = right.groupBy(right_key).agg(F.count(F.lit(1)).alias(out))
    return left.join(counts, F.col(left_key) == F.col(right_key), "inner").drop(right_key)


def not_in_set(left: DataFrame, right: DataFrame, left_key: str, right_key: str) -> DataFrame:
    """Rows whose key is not among the other side's keys (a row without key is kept)."""
    keys = right.select(F.col(right_key).alias("_key")).distinct()
    return left.join(keys, F.col(left_key) == F.col("_key"), "left_anti")


def set_minus(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of the left side that the right side lacks."""
    return left.subtract(right)
