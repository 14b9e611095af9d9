"""Differences between two sources or two snapshots of one table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions import names
from lakeaudit.functions.numbers import half_up
from lakeaudit.session import stored

# The digest tree: bits of the key's hash per level, its levels, and the most buckets followed down.
LEVEL_BITS, LEVELS, FOLLOWED = 8, 3, 10_000


def keyed_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Status of every key: only_left, only_right, changed, same or duplicate.

    Both sides are stacked and grouped by key. Unlike a full outer join this combines
    rows before the shuffle and never multiplies a key that one side repeats. Of the values
    only 128 bits per side move, and numbers are hashed where structs would be sorted.
    """
    def side(df: DataFrame, n: int) -> DataFrame:
        own = [names.column(v) for v in values]
        digests = [F.xxhash64(F.lit(seed), *own, *[v.isNull() for v in own]).alias(f"_v{seed}") for seed in (1, 2)]
        return df.select(*keys, *digests, F.lit(n).alias("_side"))

    on_left, on_right = F.col("_side") == 1, F.col("_side") == 2
    grouped = side(left, 1).unionByName(side(right, 2)).groupBy(*keys).agg(
        F.count_if(on_left).alias("left_rows"),
        F.count_if(on_right).alias("right_rows"),
        *[F.max(F.when(on, F.col(f"_v{seed}"))).alias(f"_{name}{seed}") for on, name in ((on_left, "l"), (on_right, "r")) for seed in (1, 2)],
    )
    status = (
        F.when((F.col("left_rows") > 1) | (F.col("right_rows") > 1), "duplicate")
        .when(F.col("right_rows") == 0, "only_left")
        .when(F.col("left_rows") == 0, "only_right")
        .when((F.col("_l1") == F.col("_r1")) & (F.col("_l2") == F.col("_r2")), "same")
        .otherwise("changed")
    )
    return grouped.select(*keys, status.alias("status"), "left_rows", "right_rows")


def diff_summary(diff: DataFrame) -> DataFrame:
    return diff.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))


def snapshot_drift(
    base: DataFrame, current: DataFrame, keys: Sequence[str], values: Sequence[str], stale_ratio: float = 0.2
) -> DataFrame:
    """Changes since the base snapshot, their share of its rows, and a stale flag."""
    status = F.col("status")
    counts = keyed_diff(base, current, keys, values).agg(
        F.count_if(status == "only_right").alias("inserts"),
        F.count_if(status == "changed").alias("updates"),
        F.count_if(status == "only_left").alias("deletes"),
        F.count_if(status == "same").alias("unchanged"),
        F.coalesce(F.sum("left_rows"), F.lit(0)).alias("base_rows"),
        F.coalesce(F.sum("right_rows"), F.lit(0)).alias("current_rows"),
    )
    changes = F.col("inserts") + F.col("updates") + F.col("deletes")
    ratio = F.try_divide(changes, F.col("base_rows"))
    return counts.select(
        "*",
        changes.alias("modification_counter"),
        half_up(ratio, 4).alias("change_ratio"),
        F.coalesce(ratio > stale_ratio, changes > 0).alias("stale"),
    )


# --- digest tree --------------------------------------------------------------

def _bucket(keys: Sequence[str], level: int) -> Column:
    """The first bits of the key's hash: a bucket of one level is a part of one of the level above."""
    return F.shiftrightunsigned(F.xxhash64(*[names.column(k) for k in keys]), 64 - LEVEL_BITS * level)


def _sums(df: DataFrame, keys: Sequence[str], values: Sequence[str], bucket: Column, side: int) -> DataFrame:
    """Per bucket what doesn't depend on the order of its rows: their number, and sums of their digests."""
    cells = [names.column(c) for c in (*keys, *values)]
    digests = df.select(bucket.alias("bucket"), *[F.xxhash64(F.lit(seed), *cells, *[c.isNull() for c in cells]).alias(f"d{seed}") for seed in (1, 2)])
    # Of each digest the upper 30 bits are added, which stays in a long for 2^33 rows a bucket.
    return digests.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), *[F.bit_xor(f"d{k}").alias(f"x{k}") for k in (1, 2)], *[F.sum(F.shiftrightunsigned(f"d{k}", 34)).alias(f"s{k}") for k in (1, 2)],
    ).withColumn("side", F.lit(side))


def suspect_buckets(
    left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], levels: int = LEVELS, followed: int = FOLLOWED
) -> tuple[DataFrame | None, int]:
    """(buckets whose sums differ, their level), as far down as ``followed`` buckets reach; none at level 0 if all differ.

    Each level scans the sides once more, drops rows of buckets that agree before anything is
    grouped, and shuffles a few sums per task and bucket, never rows.
    """
    found, level = None, 0
    while level < levels:
        sides = []
        for n, df in ((1, left), (2, right)):
            if found is not None:
                df = _within(df, keys, found, level)
            sides.append(_sums(df, keys, values, _bucket(keys, level + 1), n))
        figures = ["n", "x1", "x2", "s1", "s2"]
        both = sides[0].unionByName(sides[1]).groupBy("bucket").agg(F.count(F.lit(1)).alias("sides"), *[F.min(c).alias(c) for c in figures], *[F.max(c).alias(f"{c}_most") for c in figures])
        differ = (F.col("sides") == 1) | ~F.struct(*figures).eqNullSafe(F.struct(*[F.col(f"{c}_most").alias(c) for c in figures]))
        below = stored(both.where(differ).select("bucket"), "suspects")
        if below.limit(followed + 1).count() > followed:
            break
        found, level = below, level + 1
    return found, level


def _within(df: DataFrame, keys: Sequence[str], buckets: DataFrame, level: int) -> DataFrame:
    """Rows of the listed buckets, of which there are at most ``FOLLOWED``."""
    marked = df.withColumn("_bucket", _bucket(keys, level))
    return marked.join(F.broadcast(buckets.withColumnRenamed("bucket", "_bucket")), "_bucket", "left_semi").drop("_bucket")


def tree_diff(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str], levels: int = LEVELS, followed: int = FOLLOWED) -> DataFrame:
    """The keys whose rows differ: only_left, only_right, changed or duplicate, without those that are the same.

    Sums over buckets of key hashes tell where the sides differ, and only rows of those buckets are
    grouped by key. So what is shuffled grows with the changes, not with the tables. Keys with equal
    rows on both sides, repeated or not, are no difference, unless their bucket holds one.
    """
    left, right = (df.select(*keys, *values) for df in (left, right))
    found, level = suspect_buckets(left, right, keys, values, levels, followed)
    if found is not None:
        left, right = _within(left, keys, found, level), _within(right, keys, found, level)
    return keyed_diff(left, right, keys, values).where(F.col("status") != "same")


def tree_summary(left: DataFrame, right: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys per status, where all that the tree shows no difference for is the same."""
    diff = stored(tree_diff(left, right, keys, values), "differences")
    differing = diff.agg(F.coalesce(F.sum("left_rows"), F.lit(0)).alias("gone"))
    same = left.agg(F.count(F.lit(1)).alias("rows")).join(F.broadcast(differing))  # one row each
    rest = same.select(F.lit("same").alias("status"), (F.col("rows") - F.col("gone")).alias("keys")).where("keys > 0")
    return diff_summary(diff).unionByName(rest)
