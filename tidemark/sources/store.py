"""Stored tables laid out by a key, so that joins and lookups by it do not move them.

A bucketed table is a folder below the shared one and a name in the session's catalog. All
rows of a key are in one bucket, sorted: a join on the key reads bucket by bucket and shuffles
only the other side, or nothing if that has the same layout. A bucket is read by one task, so
choose their number by the size of the table; a hot key makes its bucket large, so lay out by
keys with few rows each (order codes and ids, not customers).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_folder


def bucketed(rows: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """``rows`` written in buckets of ``key``, and read back from there.

    One file per bucket, as the rows are dealt out by the same hash first. By default there
    are as many buckets as ``spark.sql.shuffle.partitions``: with fewer, Spark may shuffle the
    table again to work with more tasks. Null keys share a bucket.
    """
    spark = rows.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    (
        rows.repartition(number, key)
        .write.bucketBy(number, key)
        .sortBy(key)
        .option("path", new_folder(spark, table))
        .saveAsTable(table)
    )
    return spark.table(table)


def find(stored: DataFrame, key: str, values: Iterable) -> DataFrame:
    """The rows of a few keys; of a bucketed table only their buckets are read."""
    return stored.where(F.col(key).isin(list(values)))
