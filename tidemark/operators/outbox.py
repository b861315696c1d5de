"""The outbox table: building events, choosing them, and moving them through their states.

A mutation is a pure function: table and changes in, new table (or changed rows) out.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers, items, retry
from tidemark.functions.once import once
from tidemark.schemas import ORDER_PAYLOAD

POLICY = C.OutboxPolicy()

# Stored column -> model name.
MODEL_NAMES = {
    "id": "Id",
    "entity_type": "EntityName",
    "entity_id": "EntityId",
    "event_type": "EventType",
    "event_version": "EventVersion",
    "payload": "Payload",
    "occurred_at": "OccurredAt",
    "status": "Status",
    "retry_count": "RetryCount",
    "last_error": "LastError",
    "published_at": "PublishedAt",
}


def outbox_events(
    orders: DataFrame, occurred_at: Column, event_id: Column, keep: Sequence[str] = ()
) -> DataFrame:
    """One ORDER_PLACED event per order, the order itself as JSON payload."""
    status_number = F.array_position(
        F.array(*[F.lit(s) for s in C.ORDER_STATUSES]), F.col("status")
    )
    payload = F.struct(
        F.col("order_short_code").alias("OrderShortCode"),
        F.col("customer_id").alias("CustomerId"),
        F.coalesce(items.to_payload_items(F.col("items")), F.array()).alias("Items"),
        (status_number - 1).cast("int").alias("Status"),
    )
    return orders.select(
        event_id.alias("id"),
        F.lit(C.ENTITY_ORDER).alias("entity_type"),
        F.col("order_short_code").alias("entity_id"),
        F.lit(C.EVENT_ORDER_PLACED).alias("event_type"),
        F.lit(C.EVENT_VERSION).alias("event_version"),
        F.to_json(payload).alias("payload"),
        occurred_at.alias("occurred_at"),
        F.lit(C.OUTBOX_STATUSES[0]).alias("status"),
        F.lit(0).alias("retry_count"),
        F.lit(None).cast("string").alias("last_error"),
        F.lit(None).cast("timestamp").alias("published_at"),
        *keep,
    )


def order_placed(events: DataFrame) -> DataFrame:
    """Adds ``placed``, the event decoded from the payload; null for a null payload."""
    order = F.from_json(F.col("payload"), ORDER_PAYLOAD)
    return (
        once(events, "_order", order)
        .withColumn(
            "placed",
            F.when(
                F.col("_order.OrderShortCode").isNotNull(),
                F.struct(
                    F.col("_order.OrderShortCode").alias("orderShortCode"),
                    F.col("_order.CustomerId").alias("customerId"),
                    items.to_event_items(F.col("_order.Items")).alias("items"),
                ),
            ),
        )
        .drop("_order")
    )


def model_names(events: DataFrame) -> DataFrame:
    return events.withColumnsRenamed(MODEL_NAMES)


def is_eligible(limit: int = POLICY.retry_limit) -> Column:
    status = F.col("status")
    return (status == "PENDING") | ((status == "FAILED") & (F.col("retry_count") < limit))


def is_exhausted(limit: int = POLICY.retry_limit) -> Column:
    return (F.col("status") == "FAILED") & (F.col("retry_count") >= limit)


def eligible(
    events: DataFrame, event_type: str = C.EVENT_ORDER_PLACED, limit: int = POLICY.retry_limit
) -> DataFrame:
    return events.where(is_eligible(limit) & (F.col("event_type") == event_type))


def oldest(events: DataFrame, size: int = POLICY.batch_size) -> DataFrame:
    """The first ``size`` events by time: the batch one tick takes."""
    return events.orderBy("occurred_at", "id").limit(size)


def as_claimed() -> dict[str, Column]:
    """Column changes of a claim."""
    return {
        "status": F.lit("PROCESSING"),
        "retry_count": retry.claimed_retry_count(F.col("status"), F.col("retry_count")),
    }


def _mark(events: DataFrame, changes: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """``columns`` where the id is in ``changes``, the old values elsewhere.

    ``changes`` has one row per id, so no row of the table can come twice.
    """
    touched = F.col("_touched").isNotNull()
    marked = events.join(changes.withColumn("_touched", F.lit(1)), "id", "left")
    return marked.select(
        *[
            F.when(touched, columns[name]).otherwise(F.col(name)).alias(name)
            if name in columns
            else F.col(name)
            for name in events.columns
        ]
    )


def claim(events: DataFrame, ids: DataFrame) -> DataFrame:
    return _mark(events, ids.select("id").distinct(), as_claimed())


def mark_published(events: DataFrame, ids: DataFrame) -> DataFrame:
    """Only the status changes: the publishing time is never stored."""
    return _mark(events, ids.select("id").distinct(), {"status": F.lit("PUBLISHED")})


def mark_failed(events: DataFrame, errors: DataFrame) -> DataFrame:
    """``errors`` has ``id, error``; of several errors of an event the greatest text stays."""
    changes = errors.groupBy("id").agg(F.max("error").alias("_error"))
    return _mark(events, changes, {"status": F.lit("FAILED"), "last_error": F.col("_error")})


def stuck(events: DataFrame, now: Column, older_than: str = "5 minutes") -> DataFrame:
    """Claimed events that were never marked, e.g. after a crash."""
    return events.where(
        (F.col("status") == "PROCESSING")
        & (F.col("occurred_at") < now - F.expr(f"interval {older_than}"))
    )


def of_entity(orders: DataFrame, events: DataFrame) -> DataFrame:
    """Orders with their events."""
    own = events.where(F.upper("entity_type") == C.ENTITY_ORDER)
    return orders.join(
        own.select(
            F.col("entity_id").alias("order_short_code"),
            F.col("id").alias("event_id"),
            "event_type",
            F.col("status").alias("event_status"),
        ),
        "order_short_code",
    )


def attempt(
    events: DataFrame, publish: Callable[[DataFrame], DataFrame], limit: int = POLICY.retry_limit
) -> DataFrame:
    """Claim, decode, publish and mark, in one pass over ``events``.

    ``publish`` adds a nullable ``error`` column. An event whose payload decodes to nothing
    is not published and stays PROCESSING. ``exhausted`` marks events that failed for good.
    """
    decoded = order_placed(events.withColumns(as_claimed()))
    tried = publish(decoded)
    sent = F.col("placed").isNotNull()
    status = (
        F.when(~sent, F.col("status"))
        .when(F.col("error").isNull(), "PUBLISHED")
        .otherwise("FAILED")
    )
    return (
        tried.withColumn("last_error", F.when(sent, F.col("error")).otherwise(F.col("last_error")))
        .withColumn("status", status)
        .withColumn("exhausted", is_exhausted(limit))
        .drop("error")
    )


def outcome_counts(attempts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Events received, published and failed."""
    return attempts.groupBy(*by).agg(
        F.count("*").alias("received"),
        F.count_if(F.col("status") == "PUBLISHED").alias("published"),
        F.count_if(F.col("status") == "FAILED").alias("failed"),
    )


def event_headers() -> Column:
    """Metadata headers of an outbox row."""
    return headers.metadata_headers(
        F.col("id"),
        F.col("event_version"),
        F.col("occurred_at"),
        F.col("entity_type"),
        F.col("entity_id"),
    )


def in_key_order(messages: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """For the write to a topic: each key in one task, its messages in order.

    Tasks send at the same time, so a key must not span two of them; a busy key therefore
    is one task.
    """
    return messages.repartition(key).sortWithinPartitions(key, *order)
