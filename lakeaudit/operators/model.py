"""The logical model found in the data: keys, relationships and issues."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions import names
from lakeaudit.functions.numbers import half_up
from lakeaudit.operators import aggregates, profile
from lakeaudit.session import stored

# Issue categories, and the most columns of a table without an issue.
CATEGORIES = ("entities", "attributes", "relationships", "identifiers", "normalization")
WIDE_COLUMNS = 30

# Types whose values can be compared across tables; floating numbers make no keys.
KEY_TYPES = profile.WHOLE + (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.DecimalType)
# Columns marked in one whole number.
WORD_BITS = 60


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def _no_rows(tables: Mapping[str, DataFrame], schema: str) -> DataFrame:
    spark = next(iter(tables.values())).sparkSession if tables else SparkSession.getActiveSession()
    return spark.createDataFrame([], schema)


def _digest(columns: Sequence[Column]) -> list[Column]:
    """128 bits that stand for the values; a NULL differs from any value and from its place."""
    flags = [c.isNull() for c in columns]
    return [F.xxhash64(F.lit(seed), *columns, *flags).alias(f"h{seed}") for seed in (1, 2)]


def key_candidates(tables: Mapping[str, DataFrame], kinds: tuple = KEY_TYPES) -> list[tuple[str, tuple[str, ...]]]:
    """All single columns of the given kinds."""
    return [(t, (f.name,)) for t, df in tables.items() for f in df.schema.fields if isinstance(f.dataType, kinds)]


def check_keys(tables: Mapping[str, DataFrame], candidates: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Exact check of each candidate: rows, rows with a NULL, and whether it is a key.

    Each table is scanned once; a row becomes one short digest per candidate, and all
    candidates are one grouped pass. Values that repeat combine before the shuffle.
    """
    parts = []
    for table, df in tables.items():
        own = [
            F.struct(F.lit(i).alias("k"), *_digest([names.column(c) for c in columns]), reduce(or_, [names.column(c).isNull() for c in columns]).alias("missing"))
            for i, (t, columns) in enumerate(candidates) if t == table
        ]
        if own:
            parts.append(df.select(F.explode(F.array(*own)).alias("x")).select("x.*"))
    schema = "table_name string, key_columns string, row_count long, distinct_count long, null_rows long, is_key boolean"
    if not parts:
        return _no_rows(tables, schema)
    sizes = _union(parts).groupBy("k", "h1", "h2", "missing").agg(F.count(F.lit(1)).alias("n"))
    checked = sizes.groupBy("k").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_count"), F.sum(F.when(F.col("missing"), F.col("n")).otherwise(0)).alias("null_rows"),
    )
    # One row per candidate of the catalog.
    listed = [(i, t, ",".join(columns)) for i, (t, columns) in enumerate(candidates)]
    catalog = checked.sparkSession.createDataFrame(listed, "k int, table_name string, key_columns string")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    found = catalog.join(checked, "k", "left").select("table_name", "key_columns", count("row_count"), count("distinct_count"), count("null_rows"))
    is_key = (F.col("row_count") == F.col("distinct_count")) & (F.col("null_rows") == 0) & (F.col("row_count") > 0)
    return found.withColumn("is_key", is_key)


def find_keys(
    tables: Mapping[str, DataFrame],
    composites: Sequence[tuple[str, Sequence[str]]] = (),
    kinds: tuple = KEY_TYPES,
) -> DataFrame:
    """Keys among all single columns of the given kinds and the given composites."""
    checked = check_keys(tables, [*key_candidates(tables, kinds), *composites])
    return checked.where("is_key").select("table_name", "key_columns", "row_count")


def missing_primary_key(spark, entities: Sequence[str], keys: DataFrame) -> DataFrame:
    """Entities without any key."""
    listed = spark.createDataFrame([(e,) for e in entities], "table_name string")
    missing = listed.join(keys.select("table_name").distinct(), "table_name", "left_anti")
    return _issue(missing.withColumnRenamed("table_name", "entity"), "identifiers", "No unique column or key found", "High")


def _issue(df: DataFrame, category: str, issue, severity: str) -> DataFrame:
    text = F.lit(issue) if isinstance(issue, str) else issue
    return df.select(
        F.lit(category).alias("category"), "entity", text.alias("issue"), F.lit(severity).alias("severity")
    )


def wide_entities(columns: DataFrame, most: int = WIDE_COLUMNS) -> DataFrame:
    """Entities with more columns than ``most``, from the column dictionary."""
    counts = columns.groupBy(F.col("table_name").alias("entity")).agg(F.count(F.lit(1)).alias("n"))
    text = F.format_string("%d columns in one table", "n")
    return _issue(counts.where(F.col("n") > most), "normalization", text, "Medium")


RELATIONSHIP_SCHEMA = (
    "constraint_name string, parent_table string, parent_column string, referenced_table string, referenced_column string, "
    "child_values long, matched_values long, coverage double, parent_coverage double, same_name boolean"
)


def _value_kind(dtype: T.DataType) -> str:
    """Values are compared within a kind; decimals with those of the same scale."""
    if isinstance(dtype, profile.WHOLE):
        return "whole"
    return f"decimal {dtype.scale}" if isinstance(dtype, T.DecimalType) else dtype.simpleString()


def _holders(tables: Mapping[str, DataFrame], number: Mapping[tuple[str, str], int]) -> DataFrame:
    """(n, held_by): how many distinct values are held by exactly these columns.

    Each table is scanned once. A column has a bit, so the columns that hold a value are a
    few whole numbers, which combine before the only shuffle of values.
    """
    words = len(number) // WORD_BITS + 1
    parts = []
    for table, df in tables.items():
        cells = []
        for field in df.schema.fields:
            i = number.get((table, field.name))
            if i is not None:
                value = names.column(field.name)
                value = value.cast("long") if isinstance(field.dataType, profile.WHOLE) else value
                kind = F.lit(_value_kind(field.dataType))
                marks = [F.lit(1 << (i % WORD_BITS) if i // WORD_BITS == w else 0).cast("long").alias(f"w{w}") for w in range(words)]
                digest = F.struct(*[F.xxhash64(F.lit(seed), kind, value).alias(f"h{seed}") for seed in (1, 2)], *marks)
                cells.append(F.when(value.isNotNull(), digest))
        if cells:
            parts.append(df.select(F.explode(F.array(*cells)).alias("x")).where("x IS NOT NULL").select("x.*"))
    marks = [f"w{w}" for w in range(words)]
    values = _union(parts).groupBy("h1", "h2").agg(*[F.bit_or(m).alias(m) for m in marks])
    alike = values.groupBy(*marks).agg(F.count(F.lit(1)).alias("n"))
    word = F.array(*[F.col(m) for m in marks])
    held = F.filter(
        F.sequence(F.lit(0), F.lit(len(number) - 1)),
        lambda i: F.call_function("shiftright", F.get(word, F.floor(i / WORD_BITS).cast("int")), i % WORD_BITS).bitwiseAND(F.lit(1)) == 1,
    )
    return alike.select("n", held.alias("held_by"))


def relationships(
    tables: Mapping[str, DataFrame], keys: DataFrame | None = None, min_coverage: float = 1.0, kinds: tuple = KEY_TYPES
) -> DataFrame:
    """Columns whose values are contained in a key of another table.

    Distinct values of all columns are grouped by value in one pass; columns held together
    become pairs, which are rows, so the plan doesn't grow with their number.
    ``parent_coverage`` tells a real reference from a chance inclusion of small numbers.
    """
    keys = find_keys(tables, kinds=kinds) if keys is None else keys
    columns = [(t, f.name) for t, df in tables.items() for f in df.schema.fields if isinstance(f.dataType, kinds)]
    if not columns:
        return _no_rows(tables, RELATIONSHIP_SCHEMA)
    number = {c: i for i, c in enumerate(columns)}
    holders = _holders(tables, number)
    children = holders.select("n", "held_by", F.explode("held_by").alias("child"))
    pairs = children.select("child", F.explode("held_by").alias("parent"), "n").groupBy("child", "parent").agg(F.sum("n").alias("n"))
    pairs = stored(pairs, "pairs")
    # The catalog has a row per column, the sizes too.
    catalog = pairs.sparkSession.createDataFrame([(i, t, c) for (t, c), i in number.items()], "i int, t string, c string")
    sizes = pairs.where("child = parent").select(F.col("child").alias("i"), F.col("n").alias("size"))
    key_columns = keys.select(F.col("table_name").alias("t"), F.col("key_columns").alias("c")).distinct()
    side = catalog.join(sizes, "i")
    child = side.select(F.col("i").alias("child"), F.col("t").alias("parent_table"), F.col("c").alias("parent_column"), F.col("size").alias("child_values"))
    parent = side.join(key_columns, ["t", "c"], "left_semi").select(
        F.col("i").alias("parent"), F.col("t").alias("referenced_table"), F.col("c").alias("referenced_column"), F.col("size").alias("key_values")
    )
    rows = pairs.withColumnRenamed("n", "matched_values").join(child, "child").join(parent, "parent").where("parent_table <> referenced_table")
    plain = lambda c: F.regexp_replace(c, "^[a-z]{1,2}_", "")
    return rows.where(F.col("matched_values") >= min_coverage * F.col("child_values")).select(
        F.concat_ws("_", F.lit("fk"), "parent_table", "parent_column", "referenced_table").alias("constraint_name"),
        "parent_table", "parent_column", "referenced_table", "referenced_column", "child_values", "matched_values",
        half_up(F.try_divide("matched_values", "child_values"), 4).alias("coverage"),
        half_up(F.try_divide("matched_values", "key_values"), 4).alias("parent_coverage"),
        (plain("parent_column") == plain("referenced_column")).alias("same_name"),
    )


def external_references(rels: DataFrame, entities: Sequence[str]) -> DataFrame:
    """References from the model's entities to tables outside it."""
    inside = F.col("parent_table").isin(*entities)
    outside = ~F.col("referenced_table").isin(*entities)
    found = rels.where(inside & outside).select(F.col("parent_table").alias("entity"), "parent_column", "referenced_table")
    text = F.format_string("%s refers to %s outside the model", "parent_column", "referenced_table")
    return _issue(found, "relationships", text, "Low")


def orphan_rows(child: DataFrame, parent: DataFrame, child_column: str, parent_column: str) -> DataFrame:
    """Child values without a parent, with their rows, hot values counted before the join."""
    counts = child.where(F.col(child_column).isNotNull()).groupBy(F.col(child_column).alias("value")).agg(
        F.count(F.lit(1)).alias("row_count")
    )
    keys = parent.select(F.col(parent_column).alias("value")).distinct()
    return counts.join(keys, "value", "left_anti").agg(
        F.count(F.lit(1)).alias("orphan_values"), F.coalesce(F.sum("row_count"), F.lit(0)).alias("orphan_rows")
    )


def model_issues(
    columns: DataFrame,
    keys: DataFrame,
    rels: DataFrame,
    entities: Sequence[str],
    most_columns: int = WIDE_COLUMNS,
) -> DataFrame:
    """All issues of the chosen entities as one table."""
    spark = columns.sparkSession
    own = F.col("table_name").isin(*entities)
    return _union([
        missing_primary_key(spark, entities, keys.where(own)),
        wide_entities(columns.where(own), most_columns),
        external_references(rels, entities),
    ])


def issue_counts(issues: DataFrame) -> DataFrame:
    """Issues per category, zero for a category without any."""
    return aggregates.zero_filled_counts(issues, "category", CATEGORIES)


def logical_model(entities: Sequence[str], columns: DataFrame, rels: DataFrame, issues: DataFrame) -> DataFrame:
    """Entities, relationships, issues and summary as rows of section, name and detail."""
    own = columns.where(F.col("table_name").isin(*entities))
    row = lambda df, section, name, detail: df.select(
        F.lit(section).alias("section"), name.alias("name"), detail.cast("string").alias("detail")
    )
    entity_rows = own.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))
    rel_rows = rels.where(F.col("parent_table").isin(*entities))
    target = F.concat_ws(".", "referenced_table", "referenced_column")
    counts = lambda df, name: df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    totals = _union([counts(entity_rows, "entities"), counts(rel_rows, "relationships"), counts(issues, "issues")])
    return _union([
        row(entity_rows, "entity", F.col("table_name"), F.col("n")),
        row(rel_rows, "relationship", F.concat_ws(".", "parent_table", "parent_column"), target),
        row(issues, "issue", F.concat_ws(": ", "category", "entity"), F.concat_ws(": ", "severity", "issue")),
        row(totals, "summary", F.col("name"), F.col("n")),
    ])


def usage_metrics(events: DataFrame, conversations: DataFrame, documents: DataFrame, kinds: Sequence[str]) -> DataFrame:
    """Users of some event types, conversations waiting for an answer, and text size in MB."""
    users = events.where(F.col("event_type").isin(*kinds)).agg(F.count_distinct("user_id").alias("user_count"))
    # A flag and a number: texts among the aggregates would be sorted instead of hashed.
    last = conversations.groupBy("conv_id").agg(F.max_by(F.col("role") == "user", F.col("turn")).alias("waits"))
    waiting = last.agg(F.count_if("waits").alias("open_conversations"))
    size = documents.agg(F.expr("sum(octet_length(text)) div 1048576").alias("text_mb"))
    # Three single rows, so these joins only put columns side by side.
    return users.join(F.broadcast(waiting)).join(F.broadcast(size))
