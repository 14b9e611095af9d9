"""Whole rows carried beside an operator's own columns, so that names can't clash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeaudit.llm.common import text_key

HELD = "held"


def held(documents: DataFrame) -> DataFrame:
    """(held, doc, doc_key): the row as a struct, its id, and what stands for its text."""
    return documents.select(F.struct("*").alias(HELD), F.col("doc_id").cast("long").alias("doc"), text_key().alias("doc_key"))


def released(rows: DataFrame) -> DataFrame:
    return rows.select(f"{HELD}.*")
