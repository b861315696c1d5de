"""Small helpers the corpus operators share."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

# Words are runs of anything but ASCII white space.
SPACE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    """The text, with null read as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words_of(text: Column) -> Column:
    """The words of a text in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def content_key(*parts: Column) -> list[Column]:
    """Two chained 64-bit hashes: a 128-bit key of the content, without its bytes."""
    return [F.xxhash64(*parts).alias("key_a"), F.xxhash64(F.lit("b"), *parts).alias("key_b")]


def text_bytes(docs: DataFrame, name: str = "text") -> int:
    """Bytes of a text column over the whole table; sizes shards and buckets."""
    row = docs.agg(F.sum(F.octet_length(name)).alias("n")).first()
    return int(row.n or 0)


def shares(total: int, each: int, least: int = 1) -> int:
    """How many parts of at most about ``each`` the total makes."""
    return max(least, math.ceil(total / each))


# Rows of a narrow table (ids or keys) that a broadcast may hold: some 32 MB.
BROADCAST_ROWS = 1_000_000


def small(rows: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """The rows, to be broadcast if a count shows that they are few; else joined by shuffle.

    Give it a written table of narrow rows.
    """
    return F.broadcast(rows) if rows.count() <= most else rows


def slices(batch, rows: int):
    """An Arrow batch in runs of at most ``rows`` rows, so that outputs stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


def with_longs(schema: StructType, *names: str) -> StructType:
    """The schema with long columns added; the given one stays as it is."""
    return StructType([*schema.fields, *(StructField(name, LongType()) for name in names)])
