"""Reading sources and running parameterised queries over them."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeaudit.functions import formats, sqltext
from lakeaudit.operators import guard, paging
from lakeaudit.sources import sinks

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Fixed value: rows of a preview.
PREVIEW_ROWS = 500


class Lake:
    """A folder of tables; every table is read lazily with its own schema."""

    def __init__(self, spark: SparkSession, root: str, fmt: str = "parquet"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.fmt = fmt
        self._tables: dict[str, DataFrame] = {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.{self.fmt}"

    def table(self, name: str) -> DataFrame:
        """The table; its files are listed and its schema read once per lake."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.format(self.fmt).load(self.path(name))
        return self._tables[name]

    def sql(self, text: str, *names: str) -> DataFrame:
        """Run SQL text that names tables as ``{orders}`` placeholders."""
        return self.spark.sql(text, **{n: self.table(n) for n in names})


def read_source(spark: SparkSession, fmt: str, location: str | None = None, **options: Any) -> DataFrame:
    """One source by format: parquet, orc, csv, json or jdbc.

    A JDBC source must name a partition column with its bounds, so that the read is
    split over executors instead of running through one connection.
    """
    if fmt == "jdbc":
        missing = {"partitionColumn", "lowerBound", "upperBound", "numPartitions"} - set(options)
        if missing:
            raise ValueError(f"a jdbc source needs {sorted(missing)}")
        return spark.read.format("jdbc").options(**options).load()
    if fmt in ("csv", "json") and "schema" not in options:
        raise ValueError(f"a {fmt} source needs a schema; inferring one reads the data twice")
    reader = spark.read.format(fmt)
    if "schema" in options:
        reader = reader.schema(options.pop("schema"))
    return reader.options(**options).load(location)


def union_sources(sources: Mapping[Any, DataFrame], label: str = "instance") -> DataFrame:
    """The same table from several sources, tagged with the source it came from."""
    out: DataFrame | None = None
    for name, df in sources.items():
        tagged = df.withColumn(label, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("at least one source is needed")
    return out


def parse_params(params_json: str | None) -> list[Any] | dict[str, Any]:
    """JSON parameters: a list is positional, an object is named."""
    if not params_json:
        return []
    params = json.loads(params_json)
    if not isinstance(params, (list, dict)):
        raise ValueError("params_json must be a JSON list or object")
    return params


@dataclass(frozen=True)
class ReadGuard:
    """What a read must pass and leave behind: an allow-list of tables and an audit log."""

    scope: str | Sequence[str] | None = None
    audit_path: str | None = None
    caller: str = ""
    database: str = "lake"


def param_query(
    spark: SparkSession,
    sql: str,
    params_json: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    max_rows: int = 0,
    guarded: ReadGuard | None = None,
) -> DataFrame:
    """Guarded parameterised read: read-only, in scope, and audited before it runs.

    Tables are named in braces, ``{orders}``, and are known to this query only. A positive
    ``max_rows`` caps the rows; otherwise all come back.
    """
    guarded = guarded or ReadGuard()
    plain = sql.format(**{name: name for name in tables or {}})
    sqltext.require_readonly(spark, plain)
    if guarded.scope is not None:
        guard.require_scope(spark, plain, guarded.scope)
    params = parse_params(params_json)
    if guarded.audit_path:
        asked = spark.createDataFrame([(plain, guarded.caller, params_json or "")], "q string, caller string, params string")
        sinks.append_audit(sinks.audit_records(
            asked, tool="param_query", database=guarded.database, sql=F.col("q"), prompt=F.lit(""), caller=F.col("caller"),
            at=formats.iso_text(F.current_timestamp()), params=F.sha2("params", 256),
        ), guarded.audit_path)
    rows = spark.sql(sql, args=params or None, **(tables or {}))
    return paging.row_cap(rows, max_rows) if max_rows > 0 else rows


def run_query(
    spark: SparkSession,
    sql: str,
    params_json: str | None = None,
    tables: Mapping[str, DataFrame] | None = None,
    max_rows: int = 0,
    page: int = 1,
    page_size: int = paging.DEFAULT_PAGE_SIZE,
    order_by: Sequence[str] = (),
    guarded: ReadGuard | None = None,
) -> DataFrame:
    """``param_query`` followed by one page of its rows with the page numbers."""
    rows = param_query(spark, sql, params_json, tables, max_rows, guarded)
    return paging.result_page(rows, page, page_size, order_by)
