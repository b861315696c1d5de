"""Names and default settings shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# Topic names.
TOPIC_ORDER_PLACED = "order.placed"
TOPIC_ORDER_FULFILLED = "order.fulfilled"
TOPIC_ORDER_ANALYTICS = "order.analytics"
TOPIC_FULFILLMENT_DLQ = "fulfillment-service.dlq"
TOPIC_ORDER_DLQ = "order-service.dlq"

# Metadata header names.
HEADER_EVENT_ID = "event-id"
HEADER_EVENT_VERSION = "event-version"
HEADER_OCCURRED_AT = "occurred-at"
HEADER_ENTITY_TYPE = "entity-type"
HEADER_ENTITY_ID = "entity-id"

# Dead-letter header names.
HEADER_ORIGINAL_TOPIC = "x-original-topic"
HEADER_EXCEPTION_TYPE = "x-exception-type"
HEADER_EXCEPTION_MESSAGE = "x-exception-message"
HEADER_FAILURE_TIMESTAMP = "x-failure-timestamp"
HEADER_PARTITION = "x-partition"
HEADER_OFFSET = "x-offset"

# Status names, in the order an order or outbox event moves through them.
ORDER_STATUSES = ("PENDING", "FULFILLED", "SHIPPED")
OUTBOX_STATUSES = ("PENDING", "PROCESSING", "PUBLISHED", "FAILED")

# Entity and event names.
ENTITY_ORDER = "ORDER"
ENTITY_DEFAULT = "Order"
EVENT_ORDER_PLACED = "ORDER_PLACED"
EVENT_VERSION = 1

# Producer error codes that are worth another try.
TRANSIENT_ERROR_CODES = ("Local_Transport", "Local_AllBrokersDown", "UnknownTopicOrPart")

# Window label -> Spark interval.
WINDOW_SIZES = {"1m": "1 minute", "1h": "1 hour", "24h": "24 hours"}

# Window label -> calendar unit it is aligned to (UTC).
WINDOW_UNITS = {"1m": "minute", "1h": "hour", "24h": "day"}

ZERO_UUID = "00000000-0000-0000-0000-000000000000"


@dataclass(frozen=True)
class RetryPolicy:
    """Exponential backoff in milliseconds with a ceiling."""

    max_attempts: int = 3
    initial_delay_ms: int = 100
    max_delay_ms: int = 10_000
    multiplier: float = 2.0


@dataclass(frozen=True)
class OutboxPolicy:
    """How many times a failed event is tried again, and how much one tick takes."""

    retry_limit: int = 3
    batch_size: int = 100
    polling_interval: str = "500 milliseconds"


@dataclass(frozen=True)
class StreamPolicy:
    """Trigger, watermark and starting point of the live queries."""

    checkpoint_interval: str = "60 seconds"
    watermark: str = "60 seconds"
    starting_offsets: str = "latest"
