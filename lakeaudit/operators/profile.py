"""What a table's columns hold, measured in one scan, and advice drawn from it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions import names
from lakeaudit.functions.numbers import half_up_sql

# Fixed values -----------------------------------------------------------------
# A text column longer than this is worth a note; the longest VARCHAR with a length.
WIDE_TEXT = 255
LONGEST_VARCHAR = 8000
# Digits a whole or floating number of each type can hold.
PRECISION = {"tinyint": 3, "smallint": 5, "int": 10, "bigint": 19, "float": 24, "double": 53}
# ------------------------------------------------------------------------------

WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
NUMBERS = WHOLE + (T.FloatType, T.DoubleType, T.DecimalType)
STAMPS = (T.TimestampType, T.TimestampNTZType)

PROFILE_TYPES = {
    "row_count": "bigint", "null_count": "bigint", "distinct_count": "bigint", "min_number": "double", "max_number": "double",
    "mean_number": "double", "min_text": "string", "max_text": "string", "max_length": "int",
}
PROFILE_COLUMNS = tuple(PROFILE_TYPES)

# Measures by use: all, those of a column dictionary, and those type advice needs.
MEASURES = frozenset(PROFILE_COLUMNS)
SHAPE = frozenset({"row_count", "null_count", "max_length"})
RANGE = SHAPE | {"min_number", "max_number"}


def compact_key(column: str) -> str:
    """A text as grouping key: long ones by digest, so whole documents are not moved."""
    return f"CASE WHEN length({column}) > 32 THEN unhex(sha2({column}, 256)) ELSE CAST({column} AS BINARY) END"


def _measures(field: T.StructField, distinct: str) -> dict[str, str]:
    """The aggregates that exist for a column's type."""
    col, kind = f"`{field.name}`", field.dataType
    number, text = isinstance(kind, NUMBERS), isinstance(kind, T.StringType)
    stamp = isinstance(kind, STAMPS + (T.DateType,))
    shown = f"date_format({col}, 'yyyy-MM-dd HH:mm:ss.SSSSSS')" if stamp else col
    found = {"row_count": "count(1)", "null_count": f"count_if({col} IS NULL)"}
    if not isinstance(kind, T.MapType):
        exact = f"count(DISTINCT {compact_key(col) if text else col})"
        found["distinct_count"] = exact if distinct == "exact" else f"approx_count_distinct({col})"
    if number:
        found["min_number"] = f"CAST(min({col}) AS DOUBLE)"
        found["max_number"] = f"CAST(max({col}) AS DOUBLE)"
        found["mean_number"] = half_up_sql(f"avg(CAST({col} AS DOUBLE))", 4)
    if text or stamp:
        found["min_text"], found["max_text"] = f"min({shown})", f"max({shown})"
    if text:
        found["max_length"] = f"max(length({col}))"
    if isinstance(kind, T.ArrayType):
        found["max_length"] = f"max(size({col}))"
    return found


def profile(df: DataFrame, table: str, measures: frozenset = MEASURES, distinct: str = "approx") -> DataFrame:
    """One row per column from one aggregation over the table.

    Only the wanted measures are computed. ``distinct`` is ``approx`` (a fixed-size
    sketch per column) or ``exact`` (which moves every column's distinct values).
    """
    wide, apart, cells = [], [], []
    for i, field in enumerate(df.schema.fields):
        found = _measures(field, distinct)
        cell = [str(i + 1), f"'{field.name}'", f"'{field.dataType.simpleString()}'"]
        for name, kind in PROFILE_TYPES.items():
            if name in found and name in measures:
                exact = name == "distinct_count" and distinct == "exact"
                (apart if exact else wide).append(F.expr(f"{found[name]} AS {name}_{i}"))
                cell.append(f"{name}_{i}")
            else:
                cell.append(f"CAST(NULL AS {kind})")
        cells += cell
    titles = ", ".join(("ordinal", "column_name", "data_type") + PROFILE_COLUMNS)
    rows = f"stack({len(df.schema.fields)}, {', '.join(cells)}) AS ({titles})"
    measured = df.agg(*wide)
    if apart:
        # Exact counts have an aggregation of their own: next to smallest and largest texts
        # they would be sorted instead of hashed. One row on either side.
        measured = measured.join(F.broadcast(df.agg(*apart)))
    return measured.selectExpr(f"'{table}' AS table_name", rows)


def profiles(tables: Mapping[str, DataFrame], measures: frozenset = MEASURES, distinct: str = "approx") -> DataFrame:
    """Profiles of several tables in one result."""
    out: DataFrame | None = None
    for name, df in tables.items():
        one = profile(df, name, measures, distinct)
        out = one if out is None else out.unionByName(one)
    return out


def schema_columns(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table, ordinal, name and type of every column, from the schemas alone."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(t, i, f.name, f.dataType.simpleString()) for t, df in tables.items() for i, f in enumerate(df.schema.fields, 1)]
    return spark.createDataFrame(rows, "table_name string, ordinal int, column_name string, data_type string")


def column_dictionary(profiled: DataFrame) -> DataFrame:
    """Name, type, nullability, length, precision and scale by ordinal."""
    kind = F.col("data_type")
    known = F.create_map(*[F.lit(x) for pair in PRECISION.items() for x in pair])
    decimal = lambda i: F.regexp_extract(kind, r"decimal\((\d+),(\d+)\)", i).try_cast("int")
    whole = kind.isin("tinyint", "smallint", "int", "bigint")
    return profiled.select(
        "table_name",
        "ordinal",
        "column_name",
        "data_type",
        F.when(F.col("null_count") > 0, "YES").otherwise("NO").alias("is_nullable"),
        "max_length",
        F.coalesce(decimal(1), known[kind]).alias("numeric_precision"),
        F.coalesce(decimal(2), F.when(whole, F.lit(0))).alias("numeric_scale"),
        F.lit(None).cast("string").alias("column_default"),
    ).orderBy("table_name", "ordinal")


def smallest_whole_type(low: Column, high: Column) -> Column:
    """The narrowest whole-number type holding a measured range."""
    fits = lambda bits: (low >= -(2 ** (bits - 1))) & (high <= 2 ** (bits - 1) - 1)
    return F.when(fits(8), "TINYINT").when(fits(16), "SMALLINT").when(fits(32), "INT").otherwise("BIGINT")


def column_advice(profiled: DataFrame) -> DataFrame:
    """Notes on very wide texts and on whole numbers stored too wide."""
    small = smallest_whole_type(F.col("min_number"), F.col("max_number"))
    rank = F.create_map(*[F.lit(x) for t, n in (("TINYINT", 1), ("SMALLINT", 2), ("INT", 3), ("BIGINT", 4)) for x in (t, n)])
    own = F.upper("data_type")
    wide = (F.col("data_type") == "string") & (F.col("max_length") > WIDE_TEXT)
    narrow = (
        F.col("data_type").isin("smallint", "int", "bigint")
        & (F.col("null_count") == 0) & (F.col("row_count") > 0) & (rank[small] < rank[own])
    )
    noted = profiled.where(wide | narrow)
    return noted.select(
        "table_name",
        "column_name",
        F.when(wide, "Low").otherwise("Info").alias("severity"),
        F.when(wide, F.format_string("%s.%s holds texts of up to %d characters", "table_name", "column_name", "max_length"))
        .otherwise(F.format_string("%s.%s fits %s", "table_name", "column_name", small))
        .alias("recommendation"),
    )


def sql_type() -> Column:
    """The tightest SQL type of a profiled column."""
    kind, length = F.col("data_type"), F.col("max_length")
    sized = F.when((length > 0) & (length <= LONGEST_VARCHAR), F.concat(F.lit("VARCHAR("), length, F.lit(")")))
    filled = F.col("row_count") > F.col("null_count")
    return (
        F.when(kind == "string", F.coalesce(sized, F.lit("VARCHAR(MAX)")))
        .when(kind == "binary", "VARBINARY(MAX)")
        .when(kind.isin("tinyint", "smallint", "int", "bigint"),
              F.when(filled, smallest_whole_type(F.col("min_number"), F.col("max_number"))).otherwise(F.upper(kind)))
        .when(kind == "double", "FLOAT")
        .when(kind == "float", "REAL")
        .when(kind == "boolean", "BIT")
        .when(kind == "date", "DATE")
        .when(kind.startswith("timestamp"), "DATETIME2")
        .when(kind.startswith("decimal"), F.upper(F.regexp_replace(kind, ",", ", ")))
        .otherwise("NVARCHAR(MAX)")
    )


def inferred_ddl(profiled: DataFrame, schema: str = "dbo") -> DataFrame:
    """``CREATE TABLE`` text of every profiled table; its lines are one per column."""
    null = F.when(F.col("null_count") > 0, " NULL").otherwise(" NOT NULL")
    line = F.concat(F.lit("    "), names.quoted(F.col("column_name")), F.lit(" "), sql_type(), null)
    lines = F.sort_array(F.collect_list(F.struct("ordinal", line.alias("line"))))["line"]
    full_name = F.concat(names.quoted(F.lit(schema)), F.lit("."), names.quoted(F.col("table_name")))
    return profiled.groupBy("table_name").agg(lines.alias("_lines")).select(
        "table_name",
        F.concat(F.lit("CREATE TABLE "), full_name, F.lit(" (\n"), F.array_join("_lines", ",\n"), F.lit("\n);")).alias("ddl"),
    )


@dataclass(frozen=True)
class Constraint:
    """A rule on a table: ``unique`` columns, or a row condition that must hold."""

    name: str
    table: str
    kind: str
    columns: tuple[str, ...] = ()
    rule: str | None = None


def constraint_audit(tables: Mapping[str, DataFrame], constraints: Sequence[Constraint]) -> DataFrame:
    """Rows checked and violations per constraint.

    Row rules of a table share one scan; a rule that is NULL for a row is not broken,
    as in SQL checks. A key's violations are the rows beyond the first of each value.
    """
    parts: list[DataFrame] = []
    for table, df in tables.items():
        rules = [c for c in constraints if c.table == table and c.kind != "unique"]
        if rules:
            broken = [F.count_if(~F.expr(_row_rule(c))).alias(f"v{i}") for i, c in enumerate(rules)]
            cells = ", ".join(f"'{c.name}', '{c.kind}', v{i}" for i, c in enumerate(rules))
            counted = df.agg(F.count(F.lit(1)).alias("rows_checked"), *broken)
            parts.append(counted.selectExpr(
                f"'{table}' AS table_name", "rows_checked",
                f"stack({len(rules)}, {cells}) AS (constraint_name, kind, violations)",
            ))
        for c in (c for c in constraints if c.table == table and c.kind == "unique"):
            sizes = df.groupBy(*c.columns).agg(F.count(F.lit(1)).alias("n"))
            parts.append(sizes.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("rows_checked"),
                F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("violations"),
            ).select(
                F.lit(table).alias("table_name"), "rows_checked", F.lit(c.name).alias("constraint_name"),
                F.lit(c.kind).alias("kind"), "violations",
            ))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _row_rule(c: Constraint) -> str:
    return " AND ".join(f"{col} IS NOT NULL" for col in c.columns) if c.kind == "not_null" else c.rule
