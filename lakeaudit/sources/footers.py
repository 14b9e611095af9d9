"""Space and values of column chunks, from Parquet footers alone."""

from __future__ import annotations

import datetime as dt
import decimal
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeaudit.functions.numbers import half_up
from lakeaudit.sources.inventory import listed_files
from lakeaudit.sources.tables import Lake

# Texts longer than this are no bounds of use.
LONGEST_BOUND = 64

CHUNKS = (
    "table_name string, file_path string, row_group int, row_count long, column_name string, values long, null_count long, compressed_bytes long, "
    "plain_bytes long, min_number double, max_number double, min_text string, max_text string"
)


def _shown(value) -> tuple[float | None, str | None]:
    """A bound as a number or as text; types that have neither give nothing."""
    if isinstance(value, bool) or value is None:
        return None, None
    if isinstance(value, (int, float, decimal.Decimal)):
        return float(value), None
    if isinstance(value, dt.datetime):
        return None, value.replace(tzinfo=None).isoformat(" ", "microseconds")
    if isinstance(value, dt.date):
        return None, value.isoformat()
    return None, value if isinstance(value, str) and len(value) <= LONGEST_BOUND else None


def _chunk_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyarrow.fs import FileSystem

    names = [c.split()[0] for c in CHUNKS.split(", ")]
    for batch in batches:
        for table, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            system, inside = FileSystem.from_uri(path.replace("file:/", "file:///", 1) if path.startswith("file:/") and not path.startswith("file://") else path)
            with system.open_input_file(inside) as file:
                footer = pq.ParquetFile(file).metadata
            rows = []
            for g in range(footer.num_row_groups):
                group = footer.row_group(g)
                for c in range(group.num_columns):
                    chunk = group.column(c)
                    name, _, below = chunk.path_in_schema.partition(".")
                    stats = chunk.statistics
                    bounded = stats is not None and stats.has_min_max and not below
                    low, high = (_shown(stats.min), _shown(stats.max)) if bounded else ((None, None), (None, None))
                    if (low[1] is None) != (high[1] is None):
                        low, high = (None, None), (None, None)
                    nulls = stats.null_count if stats is not None and stats.has_null_count else None
                    rows.append((
                        table, path, g, group.num_rows, name, chunk.num_values, nulls, chunk.total_compressed_size, chunk.total_uncompressed_size,
                        low[0], high[0], low[1], high[1],
                    ))
            if rows:
                kinds = [pa.string(), pa.string(), pa.int32(), pa.int64(), pa.string(), *[pa.int64()] * 4, pa.float64(), pa.float64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)


def column_chunks(lake: Lake, names: Sequence[str], readers: int | None = None) -> DataFrame:
    """One row per column chunk of the tables' Parquet files.

    Files are listed, dealt evenly to ``readers`` tasks, and only the end of each is read, where its
    footer is; no data page is. Nested columns have a row per leaf, without bounds. A bound is a number
    or a short text, and null where the writer stored none. Workers open the files with Arrow's file systems.
    """
    readers = readers or int(lake.spark.conf.get("spark.sql.shuffle.partitions"))
    files = listed_files(lake, names).select("table_name", "file_path").repartition(readers, "file_path")
    return files.mapInArrow(_chunk_batches, CHUNKS)


def column_storage(chunks: DataFrame) -> DataFrame:
    """Space of every column: its chunks, values, NULLs, bytes stored and before compression, share of the table, and bounds."""
    by_column = chunks.groupBy("table_name", "column_name").agg(
        F.count_distinct("file_path").alias("files"), F.count(F.lit(1)).alias("chunks"), F.sum("values").alias("values"), F.sum("null_count").alias("null_count"),
        F.sum("compressed_bytes").alias("compressed_bytes"), F.sum("plain_bytes").alias("plain_bytes"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"), F.min("min_text").alias("min_text"), F.max("max_text").alias("max_text"),
    )
    # A row per column.
    whole = F.sum("compressed_bytes").over(Window.partitionBy("table_name"))
    return by_column.withColumn("share", half_up(F.try_divide("compressed_bytes", whole), 4)).withColumn(
        "ratio", half_up(F.try_divide("plain_bytes", "compressed_bytes"), 4)
    )
