"""Optional, pattern, threshold and scope filters."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.sqltext import DEFAULT_SCHEMA

# Smallest page count and fragmentation worth a report, object type codes.
MIN_PAGE_COUNT = 100
MIN_FRAGMENTATION = 10.0
TYPE_CODES = {"function": "FN", "procedure": "P", "trigger": "TR"}
SCOPE_PART = re.compile(r"\*|[a-z_][a-z0-9_]*")


def sql_like(column: Column, pattern: str) -> Column:
    """LIKE without regard to case, with ``[a-z]`` and ``[^a-z]`` classes; a backslash is a character."""
    return column.rlike("(?is)^" + "".join(_like_piece(p) for p in re.findall(r"\[\^?[^\]]+\]|.", pattern, flags=re.S)) + r"\z")


def _like_piece(piece: str) -> str:
    if len(piece) == 1:
        return {"%": ".*", "_": "."}.get(piece) or re.escape(piece)
    negated = piece[1] == "^"
    inside = piece[2:-1] if negated else piece[1:-1]
    # Only a hyphen between two characters means a range; all else stands for itself.
    ranges = re.findall(r".-.|.", inside, flags=re.S)
    escape = lambda c: c if c.isalnum() else "\\" + c
    return f"[{'^' if negated else ''}{''.join(escape(r[0]) + ('-' + escape(r[2]) if len(r) == 3 else '') for r in ranges)}]"


def where_given(
    df: DataFrame, equal: Mapping[str, str | None] | None = None, like: Mapping[str, str | None] | None = None
) -> DataFrame:
    """Apply only the conditions that have a value; names compare without case."""
    for name, value in (equal or {}).items():
        if value is not None:
            df = df.where(F.lower(name) == value.lower())
    for name, pattern in (like or {}).items():
        if pattern is not None:
            df = df.where(sql_like(F.col(name), pattern))
    return df


def fragmented(
    rows: DataFrame,
    min_pages: int = MIN_PAGE_COUNT,
    min_fragmentation: float = MIN_FRAGMENTATION,
    schema: str | None = None,
) -> DataFrame:
    """Fragmentation rows of named indexes worth a report."""
    kept = rows.where(
        (F.col("page_count") >= min_pages)
        & (F.col("avg_fragmentation_in_percent") >= min_fragmentation)
        & F.col("index_name").isNotNull()
    )
    return where_given(kept, {"schema_name": schema})


def parse_scope(patterns: str | Iterable[str]) -> list[tuple[str, str]]:
    """``schema.table`` patterns, ``*`` for any; a bad one raises before any job."""
    items = patterns.split(",") if isinstance(patterns, str) else patterns
    scope = set()
    for item in items:
        text = item.strip().lower()
        if not text:
            continue
        schema, dot, table = text.partition(".")
        if not dot or not SCOPE_PART.fullmatch(schema) or not SCOPE_PART.fullmatch(table):
            raise ValueError(f"bad scope pattern {item!r}: write schema.table, * for any")
        scope.add((schema, table))
    return sorted(scope)


def in_scope(schema: Column, table: Column, scope: Iterable[tuple[str, str]]) -> Column:
    """Whether a table is on the allow-list, by plain comparisons of trimmed names."""
    schema = F.coalesce(F.nullif(F.lower(F.trim(schema)), F.lit("")), F.lit(DEFAULT_SCHEMA))
    table = F.coalesce(F.lower(F.trim(table)), F.lit(""))

    def one(pattern: tuple[str, str]) -> Column:
        tests = [col == part for col, part in zip((schema, table), pattern) if part != "*"]
        return reduce(lambda a, b: a & b, tests, F.lit(True))

    return (table != "") & reduce(lambda a, b: a | b, map(one, scope), F.lit(False))


def scope_filter(df: DataFrame, patterns: str | Iterable[str], schema: str, table: str) -> DataFrame:
    return df.where(in_scope(F.col(schema), F.col(table), parse_scope(patterns)))


def type_code(kind: Column) -> Column:
    """Short code of an object type name; NULL for any other name."""
    codes = F.create_map(*[F.lit(x) for pair in TYPE_CODES.items() for x in pair])
    return codes[F.lower(kind)]
