"""Checks on SQL texts as column expressions: read-only verdict and table references."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions.clauses import DEFAULT_SCHEMA, read_references

__all__ = ["DEFAULT_SCHEMA", "classify", "code_only", "readonly_report", "referenced_tables", "require_readonly", "statement_references", "strip_sql_text"]

# Fixed values -----------------------------------------------------------------
# Words that make a statement a write, and words one of which a read must have.
WRITE_WORDS = (
    "insert", "update", "delete", "merge", "drop", "create", "alter", "truncate",
    "grant", "revoke", "deny", "exec", "execute", "backup", "restore", "dbcc",
)
READ_WORDS = ("select", "with")
# Pieces of SQL text. A quote inside a text is doubled, which makes it two texts in a row.
# Possessive groups: the matcher loops over them and never steps back into one.
BLOCK_COMMENT = r"(?s)/\*.*?\*/"
LINE_COMMENT = r"--[^\r\n]*+(?:\r\n|\r|\n|\z)"
TEXT_LITERAL = r"(?:'[^']*+')++"
QUOTED_NAME = r'(?:"[^"]*+")++'
BRACKET_NAME = r"\[[^\]]++\]"
# ------------------------------------------------------------------------------

WRITE_PATTERN = r"(?i)\b(" + "|".join(WRITE_WORDS) + r")\b"
READ_PATTERN = r"(?i)\b(" + "|".join(READ_WORDS) + r")\b"
INTO_PATTERN = r"(?is)\bselect\b.*\binto\b"

# One scan over the text: whichever piece starts first wins. Group 1 is kept.
_CODE_ONLY = rf"(?s)({BRACKET_NAME})|/\*.*?\*/|{LINE_COMMENT}|{TEXT_LITERAL}|{QUOTED_NAME}"


def strip_sql_text(sql: Column) -> Column:
    """Comments, then literals, each replaced by a blank, in that order."""
    out = sql
    for piece in (BLOCK_COMMENT, LINE_COMMENT, TEXT_LITERAL, QUOTED_NAME):
        out = F.regexp_replace(out, piece, " ")
    return out


def code_only(sql: Column) -> Column:
    """The statement without comments, text literals and quoted names, in one scan."""
    return F.regexp_replace(sql, _CODE_ONLY, "$1 ")


def write_words(code: Column) -> Column:
    """Distinct write words of a cleaned statement, lower-cased."""
    found = F.regexp_extract_all(code, F.lit(WRITE_PATTERN), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, F.lower)))


def is_readonly(code: Column) -> Column:
    return ~code.rlike(WRITE_PATTERN) & code.rlike(READ_PATTERN)


def classify(df: DataFrame, sql: str = "sql_text") -> DataFrame:
    """Add ``is_readonly``, ``write_words`` and ``writes_table`` (a SELECT … INTO)."""
    code = F.coalesce(code_only(F.col(sql)), F.lit(""))
    return df.withColumn("_code", code).select(
        *df.columns,
        is_readonly(F.col("_code")).alias("is_readonly"),
        write_words(F.col("_code")).alias("write_words"),
        F.col("_code").rlike(INTO_PATTERN).alias("writes_table"),
    )


def readonly_report(df: DataFrame, sql: str = "sql_text") -> DataFrame:
    """Statements by verdict and write word; read-only ones have no word."""
    verdicts = classify(df, sql).select("is_readonly", "writes_table", F.explode_outer("write_words").alias("word"))
    return verdicts.groupBy("is_readonly", "writes_table", "word").agg(F.count(F.lit(1)).alias("statements"))


def require_readonly(spark: SparkSession, sql: str) -> None:
    """Raise unless the one statement about to run is a read."""
    checked = classify(spark.createDataFrame([(sql,)], "sql_text string"))
    if not checked.select("is_readonly").first()[0]:
        raise ValueError("only read-only statements may run")


_REFERENCE = T.StructType([T.StructField(n, T.StringType()) for n in ("schema_name", "table_name", "kind")])


@F.pandas_udf(T.StructType([T.StructField("references", T.ArrayType(_REFERENCE)), T.StructField("readable", T.BooleanType())]))
def _read_clauses(statements: pd.Series) -> pd.DataFrame:
    known = {text: read_references(text) for text in statements.dropna().unique()}
    found = [known.get(text, ([], True)) for text in statements]
    names = ("schema_name", "table_name", "kind")
    return pd.DataFrame({
        "references": [[dict(zip(names, ref, strict=True)) for ref in refs] for refs, _ in found], "readable": [clear for _, clear in found],
    })


def statement_references(df: DataFrame, sql: str = "sql_text") -> DataFrame:
    """Add ``references``, the tables a statement names, and ``readable``.

    Tables read come first, in reading order, then tables written; a table read and written
    by one statement has one entry per use. Names of common table expressions are no
    tables, and the target of an UPDATE or DELETE may be an alias of a table that it lists. A
    statement that can't be read to its end is not ``readable``.
    """
    read = df.withColumn("_read", _read_clauses(F.col(sql)))
    return read.select(*df.columns, F.col("_read.references").alias("references"), F.col("_read.readable").alias("readable"))


def referenced_tables(df: DataFrame, key: str = "stmt_id", sql: str = "sql_text") -> DataFrame:
    """One row per statement and table it names, with the position of first use."""
    pairs = F.array_distinct(
        F.transform(F.col("references"), lambda r: F.struct(r["schema_name"], r["table_name"]))
    )
    # The outer form: the inner one would add a filter that reads all statements twice.
    listed = statement_references(df.select(key, sql), sql).select(key, F.posexplode_outer(pairs))
    return listed.where(F.col("pos").isNotNull()).select(key, (F.col("pos") + 1).alias("position"), "col.schema_name", "col.table_name")
