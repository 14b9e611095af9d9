"""Size of a value as JSON text, computed from its type without writing the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: characters counted as one token.
CHARS_PER_TOKEN = 4


def _text_chars(column: Column) -> Column:
    """Characters of a quoted JSON string: short escapes count 2, other controls 6."""
    short = F.regexp_count(column, F.lit(r'["\\\x08\x09\x0A\x0C\x0D]'))
    long = F.regexp_count(column, F.lit(r"[\x00-\x07\x0B\x0E-\x1F]"))
    return F.length(column) + short + long * F.lit(5) + F.lit(2)


def json_chars(column: Column, dtype: T.DataType) -> Column:
    """Length of the value's JSON text with ``", "`` and ``": "`` separators, NULL as null."""
    null_chars = F.lit(4)
    if isinstance(dtype, T.StructType):
        parts = [json_chars(column[f.name], f.dataType) + F.lit(len(f.name) + 4) for f in dtype.fields]
        total = sum(parts[1:], parts[0]) + F.lit(2 * (len(parts) - 1) + 2) if parts else F.lit(2)
        return F.when(column.isNull(), null_chars).otherwise(total)
    if isinstance(dtype, T.ArrayType):
        sizes = F.transform(column, lambda x: json_chars(x, dtype.elementType).cast("long"))
        inside = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
        gaps = F.greatest(F.size(column) - 1, F.lit(0)) * F.lit(2)
        return F.coalesce(inside + gaps + F.lit(2), null_chars)
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(F.when(column, F.lit(4)).otherwise(F.when(~column, F.lit(5))), null_chars)
    if isinstance(dtype, (T.StringType, T.DateType)):
        return F.coalesce(_text_chars(column.cast("string")), null_chars)
    if isinstance(dtype, T.MapType):
        entries = F.map_entries(column)
        sizes = F.transform(
            entries,
            lambda e: (json_chars(e["key"], T.StringType()) + json_chars(e["value"], dtype.valueType) + 2).cast("long"),
        )
        inside = F.aggregate(sizes, F.lit(0).cast("long"), lambda a, x: a + x)
        gaps = F.greatest(F.size(entries) - 1, F.lit(0)) * F.lit(2)
        return F.coalesce(inside + gaps + F.lit(2), null_chars)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DecimalType)):
        return F.coalesce(F.length(column.cast("string")) + 2, null_chars)
    return F.coalesce(F.length(column.cast("string")), null_chars)


def row_chars(df: DataFrame) -> Column:
    """JSON length of a whole row."""
    parts = [json_chars(F.col(f"`{f.name}`"), f.dataType) + F.lit(len(f.name) + 4) for f in df.schema.fields]
    return sum(parts[1:], parts[0]) + F.lit(2 * (len(parts) - 1) + 2)


def tokens(chars: Column) -> Column:
    """Estimated tokens for a number of characters, at least one."""
    return F.greatest(F.lit(1).cast("long"), F.floor(chars / F.lit(CHARS_PER_TOKEN)).cast("long"))
