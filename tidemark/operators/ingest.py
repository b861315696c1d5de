"""Order requests to the three stored tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import ids, items
from tidemark.functions.once import once
from tidemark.operators import outbox, rules
from tidemark.schemas import ORDER_REQUEST

_CORRUPT = "_corrupt_record"
_REQUEST = T.StructType([*ORDER_REQUEST.fields, T.StructField(_CORRUPT, T.StringType())])


def parse_requests(requests: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``customer_id, items`` and ``malformed`` from the JSON body."""
    parsed = F.from_json(
        F.col(body), _REQUEST, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    return (
        once(requests, "_request", parsed)
        .withColumn("customer_id", F.col("_request.customerId"))
        .withColumn("items", F.col("_request.items"))
        .withColumn(
            "malformed", F.col("_request").isNull() | F.col(f"_request.{_CORRUPT}").isNotNull()
        )
        .drop("_request", body)
    )


def _absent_or_uuid(text: Column) -> Column:
    return text.isNull() | ids.parse_uuid(text).isNotNull()


def request_rules() -> dict[str, Column]:
    """What the store takes: a readable body, a list of items (it may be empty), counts above
    0, and ids that are absent (the default is taken) or UUIDs."""
    lines = F.col("items")
    return {
        "body_readable": ~F.col("malformed"),
        "items_listed": F.col("malformed") | lines.isNotNull(),
        "counts_positive": lines.isNull() | F.forall(lines, lambda i: i["count"] > 0),
        "customer_id_valid": _absent_or_uuid(F.col("customer_id")),
        "product_ids_valid": lines.isNull()
        | F.forall(lines, lambda i: _absent_or_uuid(i["productId"])),
    }


def accepted(parsed: DataFrame) -> DataFrame:
    return rules.split(rules.check(parsed, request_rules()))[0]


def new_orders(parsed: DataFrame, key: str, received_at: str) -> DataFrame:
    """Parsed requests -> orders with their items, ids made from the request key."""
    with_ids = parsed.select(
        F.col(key),
        ids.stable_uuid("order", F.col(key)).alias("order_id"),
        F.col(received_at).alias("created_at"),
        F.col(received_at).alias("updated_at"),
        ids.short_code(F.col(key)).alias("order_short_code"),
        ids.parse_uuid(F.col("customer_id")).alias("customer_id"),
        "items",
    )
    return rules.apply_defaults(with_ids, rules.ORDER_DEFAULTS)


def orders_table(orders: DataFrame) -> DataFrame:
    return orders.select(
        "order_id", "created_at", "updated_at", "order_short_code", "customer_id", "status"
    )


def items_table(orders: DataFrame) -> DataFrame:
    """One row per item, with its place in the list."""
    lines = orders.select("order_id", F.posexplode("items").alias("line", "_item")).select(
        "order_id",
        "line",
        ids.parse_uuid(F.col("_item.productId")).alias("product_id"),
        F.col("_item.count").alias("count"),
    )
    return rules.apply_defaults(lines, rules.ITEM_DEFAULTS)


def order_tables(
    orders: DataFrame, occurred_at: Column, event_id: Column
) -> dict[str, DataFrame]:
    """The three tables one accepted request ends up in."""
    return {
        "orders": orders_table(orders),
        "order_items": items_table(orders),
        "outbox_events": outbox.outbox_events(orders, occurred_at, event_id),
    }


def item_lines(parsed: DataFrame) -> DataFrame:
    return parsed.withColumn("item_lines", items.line_count(F.col("items")))
