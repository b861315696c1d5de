"""Dead letters: the original message plus why, where and when it failed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers

SERVICE_TOPICS = {
    "fulfillment-service": C.TOPIC_FULFILLMENT_DLQ,
    "order-service": C.TOPIC_ORDER_DLQ,
}


def dead_letters(
    failed: DataFrame,
    service: str,
    original_topic: str,
    failed_at: Column,
    key: str = "key",
    value: str = "value",
    own_headers: Column | None = None,
) -> DataFrame:
    """Messages for the service's dead-letter topic, with the failure also as columns.

    ``failed`` has the key, the value, ``partition, offset, error_type, error_message``. A
    message without headers (null) gets the failure headers alone.
    """
    failure = headers.dead_letter_headers(
        F.lit(original_topic),
        F.col("partition"),
        F.col("offset"),
        failed_at,
        F.col("error_type"),
        F.col("error_message"),
    )
    all_headers = failure
    if own_headers is not None:
        none = F.array().cast("array<struct<key:string,value:binary>>")
        all_headers = F.concat(F.coalesce(own_headers, none), failure)
    return failed.select(
        F.lit(service).alias("service"),
        F.lit(SERVICE_TOPICS[service]).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.col(value).alias("value"),
        all_headers.alias("headers"),
        F.lit(original_topic).alias("original_topic"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "error_type",
        "error_message",
        failed_at.alias("failed_at"),
    )


def merge(*tables: DataFrame) -> DataFrame:
    """The dead letters of all services; (service, original_topic, partition, offset) is the key."""
    result = tables[0]
    for table in tables[1:]:
        result = result.unionByName(table, allowMissingColumns=True)
    return result
