"""Where audit records and reports are kept."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeaudit.functions import redaction

# Fixed value: the event name of an audit record.
AUDIT_EVENT = "query_execution"
# Rows per audit file, in place of rolling a log file by size.
AUDIT_FILE_ROWS = 1_000_000


def audit_records(
    df: DataFrame,
    *,
    tool: str,
    database: str,
    sql: Column,
    prompt: Column,
    caller: Column,
    at: Column,
    db_user: str = "",
    allow_raw: bool = False,
    params: Column | None = None,
) -> DataFrame:
    """Audit columns of executed queries: hashes and marks, never the SQL text.

    The prompt itself is kept only with ``allow_raw``, parameters only when given.
    """
    asked = F.nullif(prompt, F.lit(""))
    columns = [
        at.alias("timestamp"),
        F.lit(AUDIT_EVENT).alias("event"),
        F.lit(tool).alias("tool"),
        F.lit(database).alias("database"),
        redaction.caller_identity(caller).alias("api_caller"),
        redaction.mark("SQL", sql).alias("redacted_sql"),
        redaction.digest(sql).alias("sql_sha256"),
        redaction.anonymous_hash(sql).alias("sql_anonymized_hash"),
        redaction.digest(asked).alias("prompt_sha256"),
        redaction.mark("PROMPT", asked).alias("prompt_redaction_token"),
        redaction.storage_mode(F.lit(allow_raw)).alias("prompt_storage_mode"),
        F.lit(db_user).alias("db_user"),
    ]
    if allow_raw:
        columns += [asked.alias("prompt"), F.when(asked.isNotNull(), F.lit(True)).alias("raw_prompt_storage_enabled")]
    if params is not None:
        columns.append(params.alias("params_json"))
    return df.select(*columns)


def append_audit(records: DataFrame, path: str) -> None:
    """Append the records as JSON lines."""
    records.write.mode("append").option("maxRecordsPerFile", AUDIT_FILE_ROWS).json(path)


def read_audit(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def report_id(name: str, params: dict) -> str:
    """The same report and parameters always have the same id."""
    return hashlib.sha256(json.dumps([name, params], sort_keys=True).encode()).hexdigest()[:32]


def save_report(rows: DataFrame, path: str, report: str) -> None:
    """Replace one report's rows; other reports of the table stay."""
    (
        rows.withColumn("report_id", F.lit(report))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("report_id")
        .parquet(path)
    )


def load_report(spark: SparkSession, path: str, report: str) -> DataFrame:
    """One report; the filter reads only its folder."""
    return spark.read.parquet(path).where(F.col("report_id") == report)
