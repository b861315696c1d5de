"""Evaluate a costly column one time per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``value`` as the output of a one-element ``explode``.

    The optimizer copies a projected expression into every later filter that uses it, so a
    parsed column would be parsed again for each filter. It does not move filters below
    ``explode``; the value is computed once and then read.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))
