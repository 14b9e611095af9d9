"""Caps, pages and page numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeaudit.session import stored

# Page size when none or a bad one is given, and the largest one unless told otherwise.
DEFAULT_PAGE_SIZE = 10
MAX_PAGE_SIZE = 200


def normalise(page: object, page_size: object, most: int = MAX_PAGE_SIZE) -> tuple[int, int]:
    """Usable page number and size from whatever the caller gave; results report the size used."""
    ok = lambda n: isinstance(n, int) and not isinstance(n, bool) and n > 0
    size = min(page_size, most) if ok(page_size) else DEFAULT_PAGE_SIZE
    return (page if ok(page) else 1), size


def row_cap(df: DataFrame, max_rows: int) -> DataFrame:
    """At most ``max_rows`` rows; none when the cap is not positive."""
    return df.limit(max(0, max_rows))


def page_numbers(total: int, page: int, page_size: int) -> dict[str, int]:
    pages = max(1, math.ceil(total / page_size))
    return {"page": min(page, pages), "page_size": page_size, "total_items": total, "total_pages": pages}


def with_page_numbers(df: DataFrame, info: dict[str, int]) -> DataFrame:
    return df.select("*", *[F.lit(v).cast("long").alias(k) for k, v in info.items()])


def result_page(rows: DataFrame, page: object, page_size: object, order_by: Sequence[str] = (), most: int = MAX_PAGE_SIZE) -> DataFrame:
    """One page of a result, in its own order or by ``order_by``, with the page block."""
    number, size = normalise(page, page_size, most)
    info = page_numbers(rows.count(), number, size)
    ordered = rows.orderBy(*order_by) if order_by else rows
    return with_page_numbers(ordered.offset((info["page"] - 1) * size).limit(size), info)


def offset_page(
    df: DataFrame, order_by: Sequence[str], page: object, page_size: object, limit: int, most: int = MAX_PAGE_SIZE
) -> DataFrame:
    """One page of a list whose length is first capped at ``limit``, in the order of the list.

    Early and deep pages are the same expression; ``topKSortFallbackThreshold`` of the
    session says when Spark sorts instead of holding the rows before the page.
    """
    number, size = normalise(page, page_size, most)
    info = page_numbers(min(df.count(), max(1, limit)), number, size)
    start = (info["page"] - 1) * size
    return with_page_numbers(df.orderBy(*order_by).offset(start).limit(min(size, info["total_items"] - start)), info)


def page_info(df: DataFrame, page: object, page_size: object) -> DataFrame:
    """One row with the page block of ``df``, computed where the data is."""
    number, size = normalise(page, page_size)
    pages = F.greatest(F.lit(1), F.ceil(F.col("total_items") / F.lit(size))).cast("long")
    return df.agg(F.count(F.lit(1)).alias("total_items")).select(
        F.least(F.lit(number).cast("long"), pages).alias("page"),
        F.lit(size).cast("long").alias("page_size"),
        "total_items",
        pages.alias("total_pages"),
    )


def in_ranges(df: DataFrame, order_by: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Rows dealt into consecutive ranges of their order, with the range's number, and written once."""
    buckets = buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return stored(df.repartitionByRange(buckets, *order_by).withColumn("_range", F.spark_partition_id()), "ranges")


def number_rows(df: DataFrame, order_by: Sequence[str], buckets: int | None = None) -> DataFrame:
    """Add ``row_no`` (from 1) in the order of any columns; NULL keys come first.

    Rows are dealt into key ranges and written once, numbered inside their range; then
    each range is moved up by the rows of the ranges before it. So no task holds more than a
    range, no bounds reach the driver, and the numbers stay the same when a task is repeated.
    """
    ranged = in_ranges(df, order_by, buckets)
    sizes = ranged.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # One row per range, so this window holds at most `buckets` rows.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(*order_by)
    return (
        ranged.withColumn("_pos", F.row_number().over(inside))
        .join(F.broadcast(starts), "_range")
        .withColumn("row_no", F.col("_start") + F.col("_pos"))
        .drop("_range", "_pos", "_start")
    )


def assign_pages(df: DataFrame, order_by: Sequence[str], page_size: object) -> DataFrame:
    """Number every row and give the page it is on."""
    _, size = normalise(1, page_size)
    numbered = number_rows(df, order_by)
    return numbered.withColumn("page", F.expr(f"(row_no - 1) div {size} + 1"))
