"""Results that are small by nature."""

from __future__ import annotations

from pyspark.sql import DataFrame


def settle(df: DataFrame) -> DataFrame:
    """The same rows as local data, so that what is built on them does not run them again.

    Only for results with a few rows per table or column, or a list of fixed length.
    """
    return df.sparkSession.createDataFrame(df.collect(), df.schema)
