"""Declared schemas. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

ITEM = T.StructType(
    [T.StructField("productId", T.StringType()), T.StructField("count", T.IntegerType())]
)

ORDER_PLACED = T.StructType(
    [
        T.StructField("orderShortCode", T.StringType()),
        T.StructField("customerId", T.StringType()),
        T.StructField("items", T.ArrayType(ITEM)),
    ]
)

ORDER_FULFILLED = T.StructType(
    [
        T.StructField("orderShortCode", T.StringType()),
        T.StructField("customerId", T.StringType()),
        T.StructField("fulfillmentTimestamp", T.LongType()),
    ]
)

WINDOWED_METRIC = T.StructType(
    [
        T.StructField("windowStart", T.LongType()),
        T.StructField("windowEnd", T.LongType()),
        T.StructField("windowSize", T.StringType()),
        T.StructField("orderCount", T.LongType()),
        T.StructField("totalRevenue", T.StringType()),
        T.StructField("avgOrderValue", T.StringType()),
        T.StructField("processedAt", T.LongType()),
    ]
)

ORDER_REQUEST = T.StructType(
    [T.StructField("customerId", T.StringType()), T.StructField("items", T.ArrayType(ITEM))]
)

# The stored outbox payload: property names in Pascal case, status as its number.
ORDER_PAYLOAD = T.StructType(
    [
        T.StructField("OrderShortCode", T.StringType()),
        T.StructField("CustomerId", T.StringType()),
        T.StructField(
            "Items",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("ProductId", T.StringType()),
                        T.StructField("Count", T.IntegerType()),
                    ]
                )
            ),
        ),
        T.StructField("Status", T.IntegerType()),
    ]
)

HEADERS = T.ArrayType(
    T.StructType([T.StructField("key", T.StringType()), T.StructField("value", T.BinaryType())])
)

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("headers", HEADERS),
    ]
)

ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("created_at", T.TimestampType()),
        T.StructField("updated_at", T.TimestampType()),
        T.StructField("order_short_code", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("status", T.StringType()),
    ]
)

ORDER_ITEMS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("count", T.IntegerType()),
    ]
)

OUTBOX_EVENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("entity_type", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_version", T.IntegerType()),
        T.StructField("payload", T.StringType()),
        T.StructField("occurred_at", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("last_error", T.StringType()),
        T.StructField("published_at", T.TimestampType()),
    ]
)
