"""Message headers: an array of (key, binary value) pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import ids, times
from tidemark.functions.once import once


def pair(key: str, text: Column) -> Column:
    return F.struct(F.lit(key).alias("key"), F.encode(text, "UTF-8").alias("value"))


def first_value(headers: Column, key: str) -> Column:
    """Text of the first header with this key, null when there is none."""
    # The place comes from the array of keys, by compiled code and without a function per pair.
    place = F.nullif(F.array_position(headers["key"], key), F.lit(0)).cast("int")
    return F.decode(F.try_element_at(headers["value"], place), "UTF-8")


def last_value(headers: Column, key: str) -> Column:
    """Text of the last header with this key, empty when there is none."""
    return F.coalesce(first_value(F.reverse(headers), key), F.lit(""))


def metadata_headers(
    event_id: Column,
    event_version: Column,
    occurred_at: Column,
    entity_type: Column,
    entity_id: Column,
) -> Column:
    """The five metadata headers of an event."""
    return F.array(
        pair(C.HEADER_EVENT_ID, event_id),
        pair(C.HEADER_EVENT_VERSION, event_version.cast("string")),
        pair(C.HEADER_OCCURRED_AT, times.iso_text(occurred_at)),
        pair(C.HEADER_ENTITY_TYPE, entity_type),
        pair(C.HEADER_ENTITY_ID, entity_id),
    )


def headers_of(metadata: Column) -> Column:
    """The five headers of a metadata struct."""
    return metadata_headers(
        metadata["event_id"],
        metadata["event_version"],
        metadata["occurred_at"],
        metadata["entity_type"],
        metadata["entity_id"],
    )


def metadata_texts(headers: Column) -> Column:
    """The five metadata headers as texts, null where one is missing."""
    return F.struct(
        first_value(headers, C.HEADER_EVENT_ID).alias("event_id"),
        first_value(headers, C.HEADER_EVENT_VERSION).alias("event_version"),
        first_value(headers, C.HEADER_OCCURRED_AT).alias("occurred_at"),
        first_value(headers, C.HEADER_ENTITY_TYPE).alias("entity_type"),
        first_value(headers, C.HEADER_ENTITY_ID).alias("entity_id"),
    )


def metadata_of(texts: Column, default_id: Column, now: Column) -> Column:
    """Texts -> struct(event_id, event_version, occurred_at, entity_type, entity_id, state).

    ``state`` is ``ok``, ``default`` (a header is missing, so the whole record is the
    default one) or ``malformed`` (all are there but one does not parse).
    """
    event_id = ids.parse_uuid(texts["event_id"])
    version = texts["event_version"].try_cast("int")
    occurred = times.parse_iso(texts["occurred_at"])
    complete = (
        texts["event_id"].isNotNull()
        & texts["event_version"].isNotNull()
        & texts["occurred_at"].isNotNull()
        & texts["entity_type"].isNotNull()
        & texts["entity_id"].isNotNull()
    )
    parsed = event_id.isNotNull() & version.isNotNull() & occurred.isNotNull()

    def choose(found: Column, default: Column) -> Column:
        return F.when(complete, found).otherwise(default)

    return F.struct(
        choose(event_id, default_id).alias("event_id"),
        choose(version, F.lit(C.EVENT_VERSION)).alias("event_version"),
        choose(occurred, now).alias("occurred_at"),
        choose(texts["entity_type"], F.lit(C.ENTITY_DEFAULT)).alias("entity_type"),
        choose(texts["entity_id"], F.lit("")).alias("entity_id"),
        F.when(~complete, "default").when(parsed, "ok").otherwise("malformed").alias("state"),
    )


def read_metadata(
    messages: DataFrame, default_id: Column, now: Column, headers: str = "headers"
) -> DataFrame:
    """Adds ``metadata``. Each header is looked up once per row."""
    looked_up = once(messages, "_texts", metadata_texts(F.col(headers)))
    return looked_up.withColumn("metadata", metadata_of(F.col("_texts"), default_id, now)).drop(
        "_texts"
    )


def dead_letter_headers(
    topic: Column,
    partition: Column,
    offset: Column,
    failed_at: Column,
    error_type: Column,
    error_message: Column,
) -> Column:
    """Failure headers. The two exception headers are there only for a known error."""
    return F.array_compact(
        F.array(
            pair(C.HEADER_ORIGINAL_TOPIC, topic),
            pair(C.HEADER_FAILURE_TIMESTAMP, times.iso_text(failed_at)),
            pair(C.HEADER_PARTITION, partition.cast("string")),
            pair(C.HEADER_OFFSET, offset.cast("string")),
            F.when(error_type.isNotNull(), pair(C.HEADER_EXCEPTION_TYPE, error_type)),
            F.when(error_type.isNotNull(), pair(C.HEADER_EXCEPTION_MESSAGE, error_message)),
        )
    )


def original_topic(headers: Column) -> Column:
    return last_value(headers, C.HEADER_ORIGINAL_TOPIC)


def failure_timestamp(headers: Column) -> Column:
    return last_value(headers, C.HEADER_FAILURE_TIMESTAMP)
