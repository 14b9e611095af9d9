"""Where queries and their oracle SQL are collected."""

from __future__ import annotations

import textwrap
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeaudit.session import apply_defaults
from lakeaudit.sources.tables import Lake

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``build(lake) -> DataFrame`` under ``name``."""

    def wrap(build: Callable[[Lake], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Lake(apply_defaults(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = textwrap.dedent(oracle).strip()
        return build

    return wrap
