"""The stored tables over JDBC, read in parallel slices of a key column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    slice_by: str,
    lower: str,
    upper: str,
    slices: int,
    rows_per_fetch: int = 10_000,
) -> dict[str, str]:
    """``slice_by`` is a number or time column; each slice is one task with its own query."""
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": slice_by,
        "lowerBound": lower,
        "upperBound": upper,
        "numPartitions": str(slices),
        "fetchsize": str(rows_per_fetch),
    }


def read_table(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """Filters and column lists of the operators reach the database."""
    return spark.read.format("jdbc").options(**options).load()
