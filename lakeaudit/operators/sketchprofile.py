"""Profiles that add up: a sketch per file and column, kept as a table and merged.

Only new or changed files are scanned again; files that are gone leave the table. Row, NULL and
bound figures are exact; distinct counts and quantiles come from sketches that merge without
further loss: distinct counts are within about 1.6 per cent (one standard error), quantiles
within about 1.3 per cent of rank.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit import session
from lakeaudit.functions import names
from lakeaudit.operators.profile import NUMBERS
from lakeaudit.sources.inventory import listed_files
from lakeaudit.sources.tables import Lake

# Log2 of the registers of a distinct count, and the size of a quantile sketch.
DISTINCT_BITS, QUANTILE_SIZE = 12, 200

SCHEMA = (
    "file_path string, file_bytes long, modified timestamp, column_name string, row_count long, null_count long, "
    "min_number double, max_number double, distinct_sketch binary, quantile_sketch binary"
)


def _plain(path: Column) -> Column:
    """A file's path in one form, however it was listed."""
    return F.regexp_replace(F.url_decode(path), "^file:/+", "file:/")


def file_sketches(table: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per file and column of a table read from files; one scan, and a few rows per file are shuffled.

    Numbers have bounds and a quantile sketch; a NaN counts as a value without being in either. Maps are left out.
    """
    fields = [f for f in table.schema.fields if (columns is None or f.name in columns) and not isinstance(f.dataType, T.MapType)]
    measures = []
    for i, f in enumerate(fields):
        value = names.column(f.name)
        number = value.cast("double") if isinstance(f.dataType, NUMBERS) else F.lit(None).cast("double")
        number = F.when(~F.isnan(number), number)
        measures += [
            F.count_if(value.isNull()).alias(f"n{i}"), F.min(number).alias(f"a{i}"), F.max(number).alias(f"b{i}"),
            F.hll_sketch_agg(F.when(value.isNotNull(), F.xxhash64(value)), DISTINCT_BITS).alias(f"d{i}"), F.kll_sketch_agg_double(number, QUANTILE_SIZE).alias(f"q{i}"),
        ]
    file = [_plain(F.col("_metadata.file_path")).alias("file_path"), F.col("_metadata.file_size").alias("file_bytes"), F.col("_metadata.file_modification_time").alias("modified")]
    grouped = table.select("*", F.struct(*file).alias("_file")).groupBy("_file").agg(F.count(F.lit(1)).alias("rows"), *measures)
    rows = F.array(*[
        F.struct(
            F.lit(f.name).alias("column_name"), F.col("rows").alias("row_count"), F.col(f"n{i}").alias("null_count"), F.col(f"a{i}").alias("min_number"),
            F.col(f"b{i}").alias("max_number"), F.col(f"d{i}").alias("distinct_sketch"), F.col(f"q{i}").alias("quantile_sketch"),
        )
        for i, f in enumerate(fields)
    ])
    return grouped.select("_file.*", F.explode(rows).alias("x")).select("file_path", "file_bytes", "modified", "x.*")


def refreshed(lake: Lake, name: str, known: DataFrame | None = None, columns: Sequence[str] | None = None) -> tuple[DataFrame, int]:
    """(sketches of all files of a table, files scanned for it), written to the shared folder.

    ``known`` is what an earlier call returned: of files listed as they were then, by path, bytes and time of
    change, nothing is read. The paths of the others go to the driver, as any listing does.
    """
    if known is None:
        fresh = file_sketches(lake.table(name), columns)
        scanned = listed_files(lake, [name]).count()
        return session.stored(fresh, f"sketches-{name}"), scanned
    listing = listed_files(lake, [name]).select(_plain(F.col("file_path")).alias("file_path"), "file_bytes", "modified", F.col("file_path").alias("_open"))
    same = ["file_path", "file_bytes", "modified"]
    changed = [r["_open"] for r in listing.join(known.select(*same).distinct(), same, "left_anti").collect()]
    kept = known.join(listing.select(*same), same, "left_semi")
    if changed:
        table = lake.spark.read.format(lake.fmt).schema(lake.table(name).schema).load(changed)
        kept = kept.unionByName(file_sketches(table, columns))
    return session.stored(kept.select(*[c.split()[0] for c in SCHEMA.split(", ")]), f"sketches-{name}"), len(changed)


def merged(sketches: DataFrame, quantiles: Sequence[float] = (0.05, 0.5, 0.95)) -> DataFrame:
    """Per column rows, NULLs, bounds, about how many distinct values, and quantiles: files are added up, rows aren't read."""
    summed = sketches.groupBy("column_name").agg(
        F.count_distinct("file_path").alias("files"), F.sum("row_count").alias("row_count"), F.sum("null_count").alias("null_count"),
        F.min("min_number").alias("min_number"), F.max("max_number").alias("max_number"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_sketch")).alias("distinct_count"), F.kll_merge_agg_double("quantile_sketch").alias("_q"),
    )
    parts = [F.when(F.col("min_number").isNotNull(), F.kll_sketch_get_quantile_double("_q", F.lit(q))).alias(f"q{round(100 * q):02}") for q in quantiles]
    return summed.select("column_name", "files", "row_count", "null_count", "min_number", "max_number", "distinct_count", *parts)
