"""Which statements may run: scope verdicts over a table of statements."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.functions import sqltext
from lakeaudit.operators import filters

UNREADABLE = "(unreadable statement)"


def scope_verdict(
    df: DataFrame, patterns: str | Iterable[str], key: str = "stmt_id", sql: str = "sql_text"
) -> DataFrame:
    """Allow a statement if every table it names is on the allow-list.

    A statement that can't be read to its end is denied. A statement names few tables, so
    they are tested inside its row: no shuffle.
    """
    scope = filters.parse_scope(patterns)
    refs = sqltext.statement_references(df.select(key, sql), sql)
    outside = F.filter("references", lambda r: ~filters.in_scope(r["schema_name"], r["table_name"], scope))
    denied = refs.select(key, "readable", outside.alias("_outside"))
    names = F.array_distinct(F.transform("_outside", lambda r: F.concat_ws(".", r["schema_name"], r["table_name"])))
    unread = F.when(F.col("readable"), F.array().cast("array<string>")).otherwise(F.array(F.lit(UNREADABLE)))
    return denied.select(
        key,
        (F.col("readable") & (F.size("_outside") == 0)).alias("allowed"),
        F.nullif(F.array_join(F.concat(F.array_sort(names), unread), ", "), F.lit("")).alias("denied_tables"),
    )


def require_scope(spark: SparkSession, sql: str, patterns: str | Iterable[str]) -> None:
    """Raise if the one statement about to run names a table outside the allow-list."""
    verdict = scope_verdict(spark.createDataFrame([(1, sql)], "stmt_id int, sql_text string"), patterns).first()
    if not verdict["allowed"]:
        raise ValueError(f"access denied by table scope: {verdict['denied_tables']}")
