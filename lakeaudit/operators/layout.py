"""How well a table's stored order serves its columns, and how its files look."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakeaudit.functions import names
from lakeaudit.functions.numbers import half_up
from lakeaudit.operators import aggregates, paging

# Fixed value: rows of a fragmentation list when the caller gives no limit.
TOP_FRAGMENTED = 10


@dataclass(frozen=True)
class LayoutSpec:
    """A table, the column giving its pages, and the columns to look at.

    Without a position pages are the stored rows of each file, in the order in which they lie.
    """

    table: str
    position: str | None
    columns: tuple[str, ...]
    page_rows: int = 100
    schema: str = "dbo"


def page_ranges(df: DataFrame, position: str, columns: Sequence[str], page_rows: int) -> DataFrame:
    """Smallest and largest value of each column on every page of the position column."""
    spans = [f(names.column(c)).alias(f"{p}_{c}") for c in columns for f, p in ((F.min, "min"), (F.max, "max"))]
    at = names.column(position)
    page = F.floor((at - F.pmod(at, F.lit(int(page_rows)))) / F.lit(int(page_rows))).cast("long").alias("page")
    return df.groupBy(page).agg(F.count(F.lit(1)).alias("rows"), *spans)


def stored_pages(df: DataFrame, columns: Sequence[str], page_rows: int) -> DataFrame:
    """The same for stretches of stored rows: a page is a file and a number within it."""
    spans = [f(names.column(c)).alias(f"{p}_{c}") for c in columns for f, p in ((F.min, "min"), (F.max, "max"))]
    at = F.floor(F.col("_metadata.row_index") / int(page_rows)).cast("long")
    page = F.struct(F.col("_metadata.file_path").alias("file"), at.alias("number"))
    return df.select(page.alias("page"), *[names.column(c) for c in columns]).groupBy("page").agg(F.count(F.lit(1)).alias("rows"), *spans)


def with_previous_page(pages: DataFrame, columns: Sequence[str], within: str | None = None) -> DataFrame:
    """Each page next to the last one before it (of its own ``within``), whatever page numbers are missing.

    Pages lie in ranges; inside a range the page before is the neighbour, and the first
    page of a range takes the last one of the ranges before, of which there are few.
    """
    order = [within, "page"] if within else ["page"]
    ranged = paging.in_ranges(pages, order)
    shown = F.struct(*[names.column(c) for c in ([within] if within else [])], *[names.column(f"max_{c}") for c in columns])
    inside = Window.partitionBy("_range").orderBy(*order)
    numbered = ranged.withColumns({"_near": F.lag(shown).over(inside), "_first": F.row_number().over(inside) == 1})
    # One row per range.
    last = ranged.groupBy("_range").agg(F.max_by(shown, F.struct(*order)).alias("_last"))
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    handed = last.select("_range", F.last("_last").over(earlier).alias("_handed"))
    near = numbered.join(F.broadcast(handed), "_range").withColumn("_before", F.when(F.col("_first"), F.col("_handed")).otherwise(F.col("_near")))
    own = F.col("_before").getField(within) == names.column(within) if within else F.lit(True)
    found = [F.when(own, F.col("_before").getField(f"max_{c}")).alias(f"prev_max_{c}") for c in columns]
    return near.select(*[names.column(c) for c in pages.columns], *found)


def fragmentation(tables: dict[str, DataFrame], specs: Sequence[LayoutSpec]) -> DataFrame:
    """Share of pages that start below the end of the page before, per table and column.

    Each table is scanned once for all its columns, and the pages of all tables are
    compared in one pass.
    """
    pages: DataFrame | None = None
    cells = []
    for i, spec in enumerate(specs):
        if spec.position is None:
            one = stored_pages(tables[spec.table], spec.columns, spec.page_rows)
        else:
            one = page_ranges(tables[spec.table], spec.position, spec.columns, spec.page_rows)
            one = one.withColumn("page", F.struct(F.lit("").alias("file"), F.col("page").alias("number")))
        spans = [names.column(f"{p}_{c}").alias(f"{p}_{i}_{c}") for c in spec.columns for p in ("min", "max")]
        one = one.select(F.lit(i).alias("spec"), "page", *spans)
        pages = one if pages is None else pages.unionByName(one, allowMissingColumns=True)
        cells += [(i, spec, c, f"{i}_{c}") for c in spec.columns]
    compared = with_previous_page(pages, [key for _, _, _, key in cells], "spec")
    broken = [F.count_if(names.column(f"min_{key}") < names.column(f"prev_max_{key}")).alias(f"b_{k}") for k, (_, _, _, key) in enumerate(cells)]
    totals = compared.groupBy("spec").agg(F.count(F.lit(1)).alias("page_count"), *broken)
    listed = [
        F.struct(
            F.lit(i).alias("of"), F.lit(spec.schema).alias("schema_name"), F.lit(spec.table).alias("table_name"),
            F.lit(f"ix_{spec.table}_{c}").alias("index_name"), F.lit(c).alias("column_name"),
            F.lit("CLUSTERED" if c == spec.position else "NONCLUSTERED").alias("index_type"), F.col(f"b_{k}").alias("broken"),
        )
        for k, (i, spec, c, _) in enumerate(cells)
    ]
    # A table without rows has no pages, and its share is zero.
    all_specs = totals.sparkSession.createDataFrame([(i,) for i in range(len(specs))], "spec int")
    counted = all_specs.join(totals, "spec", "left").fillna(0)
    every = counted.select("spec", "page_count", F.explode(F.array(*listed)).alias("x")).where("x.of = spec").select("page_count", "x.*")
    share = F.coalesce(F.try_divide(F.col("broken") * F.lit(100.0), F.col("page_count")), F.lit(0.0))
    return every.select(
        "schema_name", "table_name", "index_name", "column_name", "index_type",
        half_up(share, 4).alias("avg_fragmentation_in_percent"), "page_count",
    )


def layout_fragmentation(df: DataFrame, spec: LayoutSpec) -> DataFrame:
    """The same for one table."""
    return fragmentation({spec.table: df}, [spec])


def top_fragmented(rows: DataFrame, limit: int = TOP_FRAGMENTED) -> DataFrame:
    """The most fragmented rows; a limit below one counts as one."""
    order = [F.col("avg_fragmentation_in_percent").desc(), F.col("table_name"), F.col("index_name")]
    return rows.orderBy(*order).limit(max(1, limit))


def by_table(rows: DataFrame, limit: int = 5) -> DataFrame:
    """Worst tables by their highest fragmentation, with all their pages."""
    grouped = rows.groupBy("schema_name", "table_name").agg(
        F.max("avg_fragmentation_in_percent").alias("max_fragmentation"),
        F.sum("page_count").alias("total_pages"),
    )
    return grouped.orderBy(F.col("max_fragmentation").desc(), "schema_name", "table_name").limit(limit)


def index_health(rows: DataFrame) -> DataFrame:
    """Fragmentation rows with their severity and the counts of all rows.

    There are a few rows per table, so the counts are a window over all of them and the
    tables are scanned once.
    """
    value = F.coalesce(F.col("avg_fragmentation_in_percent"), F.lit(0.0))
    severity = (
        F.when(value >= aggregates.SEVERE_FROM, "severe")
        .when(value >= aggregates.MEDIUM_FROM, "medium")
        .otherwise("low")
    )
    everything = Window.partitionBy()
    return rows.withColumn("severity", severity).select(
        "*",
        F.count_if(F.col("severity") == "severe").over(everything).alias("severe"),
        F.count_if(F.col("severity") == "medium").over(everything).alias("medium"),
        F.count(F.lit(1)).over(everything).alias("total"),
    )


def access_path_advice(foreign_keys: DataFrame, rows: DataFrame, limit: float = 10.0) -> DataFrame:
    """Foreign key columns a join cannot skip data on, with advice.

    ``foreign_keys`` has the relationship columns; ``rows`` are fragmentation rows.
    """
    measured = rows.select(
        F.col("table_name").alias("parent_table"),
        F.col("column_name").alias("parent_column"),
        F.col("avg_fragmentation_in_percent").alias("fragmentation"),
    )
    scattered: Column = F.col("fragmentation").isNull() | (F.col("fragmentation") > limit)
    text = F.format_string("Cluster %s by %s: joins to %s cannot skip data", "parent_table", "parent_column", "referenced_table")
    return foreign_keys.join(measured, ["parent_table", "parent_column"], "left").select(
        "constraint_name",
        "parent_table",
        "parent_column",
        "referenced_table",
        "fragmentation",
        F.when(scattered, "Unindexed Foreign Key").alias("issue"),
        F.when(scattered, "Medium").alias("severity"),
        F.when(scattered, text).alias("recommendation"),
    )
