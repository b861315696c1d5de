"""The given tables read as the order model. Every frame covers its whole table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers, ids, times
from tidemark.functions.once import once
from tidemark.operators import ingest, outbox
from tidemark.sources import files

# Status letters of the orders table.
STATUS_LETTERS = {"P": "PENDING", "F": "FULFILLED", "O": "SHIPPED"}

SOURCE_PARTITIONS = 3  # a topic has three partitions


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream. The path is a pattern, so it may be one file or a folder."""
    schema = table(spark, folder, name).schema
    return files.stream_files(spark, f"{folder}/{name}.parque[t]", schema)


def events(spark: SparkSession, folder: str) -> DataFrame:
    """All events with ``event_time`` as an instant and ``k`` from the properties."""
    return with_instants(table(spark, folder, "events"))


def with_instants(raw_events: DataFrame) -> DataFrame:
    return raw_events.select(
        "event_id",
        times.as_instant(F.col("ts")).alias("event_time"),
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
    )


def purchases(all_events: DataFrame) -> DataFrame:
    """Purchase events as the stream of placed orders."""
    return all_events.where(F.col("event_type") == "purchase").select(
        "event_id", "event_time", "user_id", F.col("value").alias("amount"), "k"
    )


def arrivals(all_events: DataFrame, *keep: str) -> DataFrame:
    """Events with an arrival time: every seventh one comes ten minutes late."""
    delay = F.when(F.col("event_id") % 7 == 0, F.expr("interval 600 seconds")).otherwise(
        F.expr("interval 0 seconds")
    )
    return all_events.select(
        "event_id", "event_time", (F.col("event_time") + delay).alias("arrived_at"), *keep
    )


def source_position(key: Column) -> dict[str, Column]:
    """Partition and offset a row has when its table stands for a topic."""
    return {
        "partition": (key % SOURCE_PARTITIONS).cast("int"),
        "offset": F.call_function("div", key, F.lit(SOURCE_PARTITIONS)),
    }


def requests(all_events: DataFrame) -> DataFrame:
    """Each event as an order request with a JSON body.

    purchase: one to three items; click: counts may be 0; view: an empty list;
    signup: no list; error: the body is cut off.
    """
    k = F.col("k")
    kind = F.col("event_type")
    numbers = F.sequence(F.lit(0), k % 3)

    def item(i: Column) -> Column:
        return F.struct(
            ids.stable_uuid("product", k + i).alias("productId"),
            F.when(kind == "click", (k + i) % 3).otherwise(i + 1).alias("count"),
        )

    no_items = F.array().cast("array<struct<productId:string,count:int>>")
    items = F.when(kind.isin("purchase", "click"), F.transform(numbers, item)).when(
        kind != "signup", no_items
    )
    body = F.to_json(
        F.struct(ids.stable_uuid("customer", F.col("user_id")).alias("customerId"), items.alias("items"))
    )
    cut = F.expr("substring(_body, 1, length(_body) - 2)")
    return (
        once(all_events, "_body", body)
        .select(
            F.col("event_id").alias("request_id"),
            F.col("event_time").alias("received_at"),
            F.when(kind == "error", cut).otherwise(F.col("_body")).alias("body"),
        )
        .withColumns(source_position(F.col("request_id")))
    )


def parsed_requests(all_events: DataFrame) -> DataFrame:
    return ingest.parse_requests(requests(all_events))


def new_orders(all_events: DataFrame) -> DataFrame:
    """Orders made from the requests the store accepts."""
    return ingest.new_orders(
        ingest.accepted(parsed_requests(all_events)), "request_id", "received_at"
    )


def fresh_outbox(all_events: DataFrame) -> DataFrame:
    """The outbox right after those orders were stored, with the request id kept."""
    return outbox_of(new_orders(all_events))


def outbox_of(orders: DataFrame) -> DataFrame:
    return outbox.outbox_events(
        orders,
        F.col("created_at"),
        ids.stable_uuid("outbox", F.col("request_id")),
        keep=("request_id",),
    )


def used_outbox(all_events: DataFrame) -> DataFrame:
    """The same outbox after some traffic: state and retries set from the request id."""
    key = F.col("request_id")
    states = F.array(*[F.lit(s) for s in ("PENDING", "FAILED", "PUBLISHED", "PROCESSING")])
    state = F.element_at(states, (key % 4 + 1).cast("int"))
    retries = (F.call_function("div", key, F.lit(4)) % 5).cast("int")
    return fresh_outbox(all_events).withColumns(
        {"status": state, "retry_count": F.when(state == "FAILED", retries).otherwise(0)}
    )


def placed_messages(outbox_rows: DataFrame) -> DataFrame:
    """Outbox rows as messages of the placed topic, some of them damaged.

    Every 11th request lacks a header, every 13th has a version that is no number, and
    every 17th has no value.
    """
    key = F.col("request_id")
    good = outbox.event_headers()
    missing = F.filter(good, lambda h: h["key"] != C.HEADER_ENTITY_TYPE)
    broken = F.transform(
        good,
        lambda h: F.when(
            h["key"] == C.HEADER_EVENT_VERSION, headers.pair(C.HEADER_EVENT_VERSION, F.lit("x"))
        ).otherwise(h),
    )
    value = F.encode(F.to_json("placed"), "UTF-8")
    return (
        outbox.order_placed(outbox_rows)
        .select(
            "request_id",
            F.col("entity_id").alias("key"),
            F.when(key % 17 != 0, value).alias("value"),
            F.when(key % 11 == 0, missing)
            .when(key % 13 == 0, broken)
            .otherwise(good)
            .alias("headers"),
        )
        .withColumns(source_position(key))
    )


def placed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders table as placed orders."""
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_short_code"),
        F.col("o_custkey").alias("customer_id"),
        times.as_instant(F.col("o_orderdate")).alias("placed_at"),
        F.col("o_totalprice").alias("amount"),
    )


def stored_orders(spark: SparkSession, folder: str) -> DataFrame:
    """The orders table as the order store, with its status."""
    status = F.col("o_orderstatus")
    named = F.lit(None).cast("string")
    for letter, name in STATUS_LETTERS.items():
        named = F.when(status == letter, name).otherwise(named)
    placed = times.as_instant(F.col("o_orderdate"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_short_code"),
        F.col("o_custkey").alias("customer_id"),
        named.alias("status"),
        placed.alias("created_at"),
        placed.alias("updated_at"),
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("order_short_code"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("count"),
    )


def fulfilled(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a fulfilled event: many repeats per order.

    Lines taxed at 8 % carry a code no order has (the negative of their own, less one).
    """
    return fulfilled_of(table(spark, folder, "lineitem"))


def fulfilled_of(lines: DataFrame) -> DataFrame:
    code = F.col("l_orderkey")
    return lines.select(
        F.when(F.col("l_tax") >= 0.08, -1 - code).otherwise(code).alias("order_short_code"),
        times.as_instant(F.col("l_shipdate")).alias("fulfilled_at"),
        F.col("l_partkey").alias("part"),
        F.col("l_suppkey").alias("supplier"),
        F.col("l_linenumber").alias("line"),
    )

