"""Names of tables and columns: parsing, quoting, cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions.sqltext import DEFAULT_SCHEMA

# Fixed value: a plain identifier.
IDENTIFIER = r"^[A-Za-z_][A-Za-z0-9_]*$"
# What a written name is made of: a bracketed piece, a dot, or anything between those.
PIECE = r"\[[^\]]*+\]|\.|[^\[\].]++"


def parse_name(name: Column, default_schema: str = DEFAULT_SCHEMA) -> Column:
    """Struct of schema, table and error for ``schema.table``, bracketed or bare names.

    The name is cut into pieces; with one dot among them, and at most one piece that isn't
    blank on either side, the sides are schema and table. Anything else is a table's name.
    """
    pieces = F.filter(F.regexp_extract_all(name, F.lit(PIECE), F.lit(0)), lambda p: F.trim(p) != "")
    dot = F.array_position(pieces, F.lit("."))
    sides = F.size(F.filter(pieces, lambda p: p != "."))
    halves = (F.size(pieces) - sides == 1) & (sides <= 2) & (dot <= 2) & (F.size(pieces) - dot <= 1)
    whole = F.regexp_replace(name, r"\[[^\]]*+\]|[^\[\]]++", "") == ""

    def plain(piece: Column) -> Column:
        bracketed = piece.startswith("[") & piece.endswith("]")
        return F.trim(F.when(bracketed, F.substring(piece, F.lit(2), F.length(piece) - 2)).otherwise(piece))

    two_part = halves & whole
    schema = plain(F.coalesce(F.when(dot == 2, F.trim(F.get(pieces, F.lit(0)))), F.lit("")))
    table = plain(F.coalesce(F.trim(F.get(pieces, dot.cast("int"))), F.lit("")))
    bare = plain(F.trim(name))
    blank = F.coalesce(F.trim(name), F.lit("")) == ""
    error = (
        F.when(blank, F.lit("name is required"))
        .when(two_part & ((schema == "") | (table == "")), F.lit("half of the name is blank"))
        .when(~two_part & (bare == ""), F.lit("name is blank"))
    )
    return F.struct(
        F.when(error.isNull(), F.when(two_part, schema).otherwise(F.lit(default_schema))).alias("schema_name"),
        F.when(error.isNull(), F.when(two_part, table).otherwise(bare)).alias("table_name"),
        error.alias("error"),
    )


def column(name: str) -> Column:
    """The column of exactly this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_identifier(name: Column) -> Column:
    return F.coalesce(name.rlike(IDENTIFIER), F.lit(False))


def quoted(name: Column) -> Column:
    """The name in brackets, with closing brackets doubled."""
    return F.concat(F.lit("["), F.replace(name, F.lit("]"), F.lit("]]")), F.lit("]"))


def label(name: Column) -> Column:
    """Letters, digits and underscores of the name only."""
    return F.regexp_replace(name, "[^A-Za-z0-9_]", "")


def name_hygiene(df: DataFrame, name: str) -> DataFrame:
    """Distinct names with their use count, validity, quoted form and label."""
    return df.groupBy(F.col(name).alias("name")).agg(F.count(F.lit(1)).alias("uses")).select(
        "name",
        "uses",
        is_identifier(F.col("name")).alias("valid"),
        quoted(F.col("name")).alias("quoted_name"),
        label(F.col("name")).alias("label"),
    )


def hygiene_summary(hygiene: DataFrame) -> DataFrame:
    """Names, invalid names, and names sharing a label with another name."""
    by_label = hygiene.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(~F.col("valid")).alias("bad")
    )
    return by_label.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("names"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("invalid_names"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("colliding_names"),
    )
