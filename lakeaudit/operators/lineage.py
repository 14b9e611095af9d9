"""Which tables statements use, and which tables depend on each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.functions import sqltext


# More than a statement can have tables.
POSITIONS = 1 << 31


def _full_name(ref):
    return F.concat_ws(".", ref["schema_name"], ref["table_name"])


def ordered_distinct(refs: DataFrame, key: str = "stmt_id") -> DataFrame:
    """Every table once, in the order of its first use; statements are numbered.

    Statement and position are one decimal number, which is hashed where a struct would be sorted.
    """
    place = F.col(key).cast("decimal(20,0)") * F.lit(POSITIONS).cast("decimal(11,0)") + F.col("position")
    first = refs.groupBy("schema_name", "table_name").agg(F.min(place.cast("decimal(32,0)")).alias("_first"))
    position = F.pmod(F.col("_first"), F.lit(POSITIONS).cast("decimal(11,0)"))
    return first.select(
        "schema_name", "table_name",
        ((F.col("_first") - position) / F.lit(POSITIONS)).cast("long").alias("first_stmt"), position.cast("int").alias("first_position"),
    ).orderBy("first_stmt", "first_position")


def _uses_and_pairs(stmts: DataFrame, key: str, sql: str) -> DataFrame:
    """Statements per table (edge ``names``) and per table pair, in one pass over the texts.

    A statement's references are its reads and then its writes; a text of several statements has one such
    block after the other. A written table is paired with each table read in its block; tables of
    reads without a write are paired with all that follow. The list of a text is short.
    """
    refs = sqltext.statement_references(stmts.select(key, sql), sql)
    wrote = lambda x: x["kind"] == "write"
    turns = lambda i: F.zip_with(F.slice("references", F.lit(1), i), F.slice("references", F.lit(2), i), lambda a, b: wrote(a) & ~wrote(b))
    block = lambda i: F.size(F.filter(turns(i), lambda turn: turn))
    named = F.transform("references", lambda x, i: F.struct(_full_name(x).alias("name"), x["kind"].alias("kind"), block(i).alias("block")))
    entry = lambda edge, a, b: F.struct(F.lit(edge).alias("edge"), a.alias("from_table"), b.alias("to_table"))
    used = refs.select(named.alias("refs")).withColumn("tables", F.array_distinct(F.col("refs.name")))
    used = used.withColumn("alone", F.array_distinct(F.transform(
        F.filter("refs", lambda r: ~F.exists("refs", lambda w: wrote(w) & (w["block"] == r["block"]))), lambda r: r["name"]
    )))
    reads = lambda w: F.filter("refs", lambda r: ~wrote(r) & (r["block"] == w["block"]) & (r["name"] != w["name"]))
    written = F.flatten(F.transform(F.filter("refs", wrote), lambda w: F.transform(reads(w), lambda r: entry("writes_from", w["name"], r["name"]))))
    later = lambda i: F.slice("alone", i + 2, F.size("alone"))
    together = F.flatten(F.transform("alone", lambda a, i: F.transform(later(i), lambda b: entry("read_with", a, b))))
    named = F.transform("tables", lambda t: entry("names", t, t))
    used = used.select(named.alias("named"), F.array_distinct(F.concat(written, together)).alias("pairs"))
    # The outer form: the inner one would add a filter that finds all references twice.
    entries = used.select(F.explode_outer(F.concat("named", "pairs")).alias("e")).where(F.col("e").isNotNull())
    return entries.groupBy("e.edge", "e.from_table", "e.to_table").agg(F.count(F.lit(1)).alias("statements"))


def table_edges(stmts: DataFrame, key: str = "stmt_id", sql: str = "sql_text") -> DataFrame:
    """Table pairs (``writes_from`` or ``read_with``) with the statements behind them."""
    return _uses_and_pairs(stmts, key, sql).where(F.col("edge") != "names")


def dependency_union(edges: DataFrame, table: str) -> DataFrame:
    """What a table is used by, stacked on what it uses; only the latter has a kind.

    Both lists come from one pass over the edges.
    """
    entry = lambda direction, entity, kind: F.struct(
        F.lit(direction).alias("direction"), F.col(entity).alias("entity"), F.col("statements"), kind.alias("kind")
    )
    used_by = F.when(F.col("to_table") == table, entry("referencing", "from_table", F.lit(None).cast("string")))
    uses = F.when(F.col("from_table") == table, entry("referenced", "to_table", F.col("edge")))
    return edges.select(F.explode(F.array(used_by, uses)).alias("e")).where(F.col("e").isNotNull()).select("e.*")


def dependency_degrees(stmts: DataFrame, key: str = "stmt_id", sql: str = "sql_text") -> DataFrame:
    """Statements naming each table, and how many tables it depends on and serves."""
    end = lambda table, statements, depends_on, used_by: F.struct(
        table.alias("table_name"), statements.alias("statements"),
        F.lit(depends_on).alias("depends_on"), F.lit(used_by).alias("used_by"),
    )
    no_count = F.lit(0).cast("long")
    ends = F.when(
        F.col("edge") == "names", F.array(end(F.col("from_table"), F.col("statements"), 0, 0))
    ).otherwise(F.array(end(F.col("from_table"), no_count, 1, 0), end(F.col("to_table"), no_count, 0, 1)))
    return _uses_and_pairs(stmts, key, sql).select(F.explode(ends).alias("e")).groupBy("e.table_name").agg(
        F.sum("e.statements").alias("statements"), F.sum("e.depends_on").alias("depends_on"), F.sum("e.used_by").alias("used_by")
    )
