"""Topics as sources and sinks. The broker package is optional; the frames are not."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import StreamPolicy

# Takes a frame of messages and delivers it.
Send = Callable[[DataFrame], None]


def messages(
    df: DataFrame,
    topic: str,
    value: Column,
    key: Column | None = None,
    headers: Column | None = None,
) -> DataFrame:
    """``key, value, headers, topic`` as the topic sink takes them.

    ``value`` is bytes or text. Without ``key`` the message has none (metric messages).
    """
    columns = [] if key is None else [key.cast("string").alias("key")]
    columns.append(value.alias("value"))
    if headers is not None:
        columns.append(headers.alias("headers"))
    return df.select(*columns, F.lit(topic).alias("topic"))


def source_options(
    servers: str,
    topic: str,
    starting: str = StreamPolicy.starting_offsets,
    rows_per_batch: int | None = None,
) -> dict[str, str]:
    """``latest`` for a live metrics query, ``earliest`` where no event may be missed."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
        "includeHeaders": "true",
    }
    if rows_per_batch:
        options["maxOffsetsPerTrigger"] = str(rows_per_batch)
    return options


def sink_options(servers: str, acks: str = "all", timeout_ms: int = 30_000) -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "kafka.acks": acks,
        "kafka.delivery.timeout.ms": str(timeout_ms),
        "kafka.request.timeout.ms": str(timeout_ms // 2),
        "includeHeaders": "true",
    }


def read_topic(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return _needs_broker(lambda: spark.readStream.format("kafka").options(**options).load())


def write_topic(frame: DataFrame, options: Mapping[str, str]) -> None:
    """Append a batch of messages; call it from ``foreachBatch``."""
    _needs_broker(lambda: frame.write.format("kafka").options(**options).save())


def sender(options: Mapping[str, str]) -> Send:
    """``send`` for the live queries: every frame goes to the topic in its ``topic`` column."""
    return partial(write_topic, options=options)


def _needs_broker(action):
    try:
        return action()
    except AnalysisException as error:
        if "kafka" not in str(error):
            raise
        raise RuntimeError(
            "topics need the Kafka package (spark.jars.packages="
            "org.apache.spark:spark-sql-kafka-0-10_2.13:<spark version>)"
        ) from error
