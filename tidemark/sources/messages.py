"""Events as messages and messages as events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers, ids, items, times
from tidemark.functions.once import once
from tidemark.operators import metrics, outbox
from tidemark.schemas import ORDER_FULFILLED, ORDER_PLACED
from tidemark.sources import topics


def decode_placed(messages: DataFrame, now: Column) -> DataFrame:
    """Adds ``placed``, its fields and ``metadata`` to messages of the placed topic.

    Values that do not decode are kept with a null event, to be counted and skipped.
    """
    decoded = once(messages, "_event", F.from_json(F.col("value").cast("string"), ORDER_PLACED))
    event = F.col("_event")
    return headers.read_metadata(
        decoded.withColumns(
            {
                "placed": F.when(event["orderShortCode"].isNotNull(), event),
                "order_short_code": event["orderShortCode"],
                "customer_id": event["customerId"],
                "items": event["items"],
            }
        ).drop("_event"),
        _position_id(),
        now,
    )


def disposition() -> Column:
    """What a decoded placed message is good for: ``ok``, ``undecodable``, ``default`` (its
    metadata is the default one, so its time is not known) or ``malformed``."""
    return F.when(F.col("placed").isNull(), "undecodable").otherwise(F.col("metadata.state"))


def placed_events(messages: DataFrame, now: Column) -> DataFrame:
    """Decoded events with ``event_time`` from the occurred-at header and ``item_lines``."""
    return timed(decode_placed(messages, now).where(F.col("placed").isNotNull()))


def timed(decoded: DataFrame) -> DataFrame:
    return decoded.withColumns(
        {
            "event_time": F.col("metadata.occurred_at"),
            "item_lines": items.line_count(F.col("items")),
        }
    )


def decode_fulfilled(messages: DataFrame, now: Column) -> DataFrame:
    """Adds ``order_short_code, customer_id, fulfilled_at`` and ``metadata`` to messages of the
    fulfilled topic.

    Values that do not decode are kept with a null code, to be set aside.
    """
    decoded = once(messages, "_event", F.from_json(F.col("value").cast("string"), ORDER_FULFILLED))
    event = F.col("_event")
    return headers.read_metadata(
        decoded.withColumns(
            {
                "order_short_code": event["orderShortCode"],
                "customer_id": event["customerId"],
                "fulfilled_at": times.from_millis(event["fulfillmentTimestamp"]),
            }
        ).drop("_event"),
        _position_id(),
        now,
    )


def _position_id() -> Column:
    """Stands in for a missing event id: a UUID of the place of the message, which never changes."""
    place = F.concat_ws("-", F.col("partition"), F.col("offset"))
    return ids.stable_uuid("default", place)


def placed_messages(events: DataFrame) -> DataFrame:
    """Published outbox events: keyed by order code, in key order."""
    return topics.messages(
        outbox.in_key_order(events, "entity_id", ["occurred_at", "id"]),
        C.TOPIC_ORDER_PLACED,
        value=F.to_json("placed"),
        key=F.col("entity_id"),
        headers=outbox.event_headers(),
    )


def fulfilled_messages(events: DataFrame, occurred_at: Column) -> DataFrame:
    message = fulfilled_message(F.struct(*events.columns), occurred_at)
    return events.select(message.alias("_message")).select("_message.*")


def fulfilled_message(event: Column, occurred_at: Column) -> Column:
    """A fulfilled event (a struct) as the struct of its message."""
    value = F.struct(
        event["order_short_code"].alias("orderShortCode"),
        event["customer_id"].alias("customerId"),
        event["fulfillment_timestamp"].alias("fulfillmentTimestamp"),
    )
    own = headers.metadata_headers(
        event["event_id"],
        event["event_version"],
        occurred_at,
        event["entity_type"],
        event["entity_id"],
    )
    return F.struct(
        event["order_short_code"].cast("string").alias("key"),
        F.to_json(value).alias("value"),
        own.alias("headers"),
        F.lit(C.TOPIC_ORDER_FULFILLED).alias("topic"),
    )


def placed_message() -> Column:
    """A decoded outbox row as the struct of its message; null without an event."""
    return F.when(
        F.col("placed").isNotNull(),
        F.struct(
            F.col("entity_id").cast("string").alias("key"),
            F.to_json("placed").alias("value"),
            outbox.event_headers().alias("headers"),
            F.lit(C.TOPIC_ORDER_PLACED).alias("topic"),
        ),
    )


def letter_messages(letters: DataFrame) -> DataFrame:
    """Dead letters as messages of their service's topic."""
    return letters.select(
        "key", F.col("value").cast("string").alias("value"), "headers", "topic"
    )


def metric_messages(rows: DataFrame, processed_at: Column) -> DataFrame:
    """Metric records; the value holds everything, there is no key."""
    records = metrics.metric_records(rows, processed_at)
    return topics.messages(
        records, C.TOPIC_ORDER_ANALYTICS, value=F.to_json(F.struct(*records.columns))
    )
