"""Tables, files, rows and bytes of a lake folder."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.numbers import half_up
from lakeaudit.sources.tables import Lake

# Fixed value: a file below this size counts as small.
SMALL_FILE_BYTES = 128 * 1024 * 1024


def _table_of(path: Column, lake: Lake) -> Column:
    return F.regexp_extract(path, rf"/([^/]+)\.{lake.fmt}(?:/[^/]*)*$", 1)


def listed_files(lake: Lake, names: Sequence[str]) -> DataFrame:
    """Every file of the tables with its bytes and time of change, from the listing alone."""
    found = lake.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([lake.path(n) for n in names])
    return found.select(
        _table_of(F.col("path"), lake).alias("table_name"), F.url_decode(F.col("path")).alias("file_path"),
        F.col("length").alias("file_bytes"), F.col("modificationTime").alias("modified"),
    )


def file_rows(lake: Lake, names: Sequence[str]) -> DataFrame:
    """One row per file: its table, rows, bytes and time of change; a file without rows has none.

    All tables are one scan that reads no column; row counts come from the file footers, and
    files that show no row come from the listing.
    """
    files = lake.spark.read.format(lake.fmt).schema("_none string").option("recursiveFileLookup", "true").load([lake.path(n) for n in names])
    counts = files.groupBy(F.url_decode(F.col("_metadata.file_path")).alias("file_path")).agg(F.count(F.lit(1)).alias("row_count"))
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    counted = counts.select(plain("file_path").alias("_path"), "row_count")
    return listed_files(lake, names).join(counted, plain("file_path") == F.col("_path"), "left").select(
        "table_name", "file_path", "file_bytes", "modified", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )


def lake_inventory(lake: Lake, names: Sequence[str]) -> DataFrame:
    """Files, rows, bytes and last change of every table, by name; a table without files has none of them."""
    every = lake.spark.createDataFrame([(n,) for n in names], "table_name string")
    found = file_rows(lake, names).groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"), F.sum("row_count").alias("row_count"), F.sum("file_bytes").alias("bytes"), F.max("modified").alias("modified")
    )
    count = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return every.join(found, "table_name", "left").select("table_name", count("files"), count("row_count"), count("bytes"), "modified").orderBy("table_name")


def small_file_health(files: DataFrame, small_bytes: int = SMALL_FILE_BYTES) -> DataFrame:
    """Size figures of every table, and advice where most files are small."""
    small = F.count_if(F.col("file_bytes") < small_bytes)
    grouped = files.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("file_bytes").alias("bytes"),
        F.sum("row_count").alias("row_count"),
        small.alias("small_files"),
    )
    share = F.col("small_files") / F.col("files")
    return grouped.select(
        "*",
        F.expr("bytes div nullif(row_count, 0)").alias("bytes_per_row"),
        F.expr("row_count div files").alias("rows_per_file"),
        half_up(share, 4).alias("small_file_share"),
        F.when(share > 0.5, "Medium").otherwise("Info").alias("severity"),
        F.when(share > 0.5, "Compact the small files of this table").alias("recommendation"),
    )
