"""Nested result documents built from flat analysis rows.

Lists hold one entry per column, index or relationship of a table, so their length is
bounded by the schema and not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeaudit.operators import model


def _listed(df: DataFrame, key: str, out: str, order: str, *columns: str) -> DataFrame:
    """Rows of a key as one list of structs, sorted by their first field."""
    entry = F.struct(F.col(order), *[F.col(c) for c in columns if c != order])
    return df.groupBy(F.col(key).alias("table_name")).agg(F.sort_array(F.collect_list(entry)).alias(out))


def table_health(profiled: DataFrame, fragmentation: DataFrame, rels: DataFrame, advice: DataFrame, issues: DataFrame) -> DataFrame:
    """One health document per profiled table."""
    info = profiled.groupBy("table_name").agg(
        F.struct(F.max("row_count").alias("row_count"), F.count(F.lit(1)).alias("columns")).alias("table_info")
    )
    parts = (
        _listed(fragmentation, "table_name", "indexes", "index_name", "avg_fragmentation_in_percent", "page_count"),
        _listed(rels, "parent_table", "foreign_keys", "constraint_name", "parent_column", "referenced_table"),
        _listed(profiled, "table_name", "statistics_sample", "ordinal", "column_name", "null_count"),
        _listed(issues, "parent_table", "constraint_issues", "constraint_name", "issue", "severity"),
        _listed(advice, "table_name", "recommendations", "column_name", "severity", "recommendation"),
    )
    docs = info
    for part in parts:
        docs = docs.join(part, "table_name", "left")
    return docs


def model_document(columns: DataFrame, rels: DataFrame, issues: DataFrame) -> DataFrame:
    """The whole logical model as one document."""
    entities = columns.groupBy("table_name").agg(
        F.sort_array(F.collect_list(F.struct("ordinal", "column_name", "data_type"))).alias("attributes")
    ).agg(F.sort_array(F.collect_list(F.struct(F.col("table_name").alias("entity_name"), "attributes"))).alias("entities"))
    relations = rels.agg(F.sort_array(F.collect_list(F.struct("constraint_name", "parent_table", "referenced_table"))).alias("relationships"))
    notes = issues.agg(F.sort_array(F.collect_list(F.struct("category", "entity", "issue", "severity"))).alias("_issues"))
    of = lambda c: F.filter("_issues", lambda i: i["category"] == c)
    by_category: Column = F.create_map(*[x for c in model.CATEGORIES for x in (F.lit(c), of(c))])
    # Three single rows side by side.
    doc = entities.join(F.broadcast(relations)).join(F.broadcast(notes))
    return doc.select(
        F.struct(F.size("entities").alias("entities"), F.size("relationships").alias("relationships"),
                 F.size("_issues").alias("issues")).alias("summary"),
        "entities",
        "relationships",
        by_category.alias("issues"),
        F.transform_values(by_category, lambda _, v: F.transform(v, lambda i: F.concat_ws(": ", i["entity"], i["issue"]))).alias("recommendations"),
    )
