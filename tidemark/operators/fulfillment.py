"""Placed orders to fulfilled events, and how well fulfillment keeps up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import ids, money, times
from tidemark.operators import asof

Hook = Callable[[DataFrame], DataFrame]


def accept_all(placed: DataFrame) -> DataFrame:
    """The default processing step: nothing to do, every order succeeds."""
    return placed.withColumns(
        {
            "error_type": F.lit(None).cast("string"),
            "error_message": F.lit(None).cast("string"),
        }
    )


def process(placed: DataFrame, hook: Hook = accept_all) -> DataFrame:
    """Run the hook (adds ``error_type, error_message``) and set ``outcome``."""
    return hook(placed).withColumn(
        "outcome", F.when(F.col("error_type").isNull(), "fulfilled").otherwise("dead_letter")
    )


def event_columns(fulfilled_at: Column) -> list[Column]:
    """The columns of a fulfilled event, from those of its placed event."""
    return [
        F.col("order_short_code"),
        F.col("customer_id"),
        F.unix_millis(fulfilled_at).alias("fulfillment_timestamp"),
        ids.stable_uuid("fulfilled", F.col("event_id")).alias("event_id"),
        F.lit(C.EVENT_VERSION).alias("event_version"),
        F.lit(C.ENTITY_DEFAULT).alias("entity_type"),
        F.col("order_short_code").alias("entity_id"),
        F.col("event_id").alias("causation_id"),
    ]


def fulfilled_events(processed: DataFrame, fulfilled_at: Column) -> DataFrame:
    """The event for each order: same code and customer, fresh id, the source id as cause.

    Needs ``order_short_code, customer_id, event_id``.
    """
    return processed.select(*event_columns(fulfilled_at))


def first_fulfilled(
    placed: DataFrame, fulfilled: DataFrame, key: str, *keep: str, unique: bool = False
) -> DataFrame:
    """Earliest fulfillment not before the order: ``key, placed_at, fulfilled_at``, and ``keep``.

    The key need not be unique. With ``unique`` (at most one order or few fulfillments per key)
    it is a plain join, which is cheaper there but makes a row for each order and each
    fulfillment of a key.
    """
    if not unique:
        return asof.next_event(placed, fulfilled, key, "placed_at", "fulfilled_at", keep)
    return (
        placed.select(key, "placed_at", *keep)
        .join(fulfilled.select(key, "fulfilled_at"), key)
        .where(F.col("fulfilled_at") >= F.col("placed_at"))
        .groupBy(key, "placed_at", *keep)
        .agg(F.min("fulfilled_at").alias("fulfilled_at"))
    )


def placed_fulfilled(
    placed: DataFrame, fulfilled: DataFrame, key: str, unique: bool = False
) -> DataFrame:
    """Every placed order with its first fulfillment, null while it is pending.

    The key need not be unique: an order is matched by key and placing time.
    """
    first = first_fulfilled(placed, fulfilled, key, unique=unique)
    return placed.join(first, [key, "placed_at"], "left")


def latency_ms() -> Column:
    return F.unix_millis("fulfilled_at") - F.unix_millis("placed_at")


def fulfillment_metrics(
    placed: DataFrame, fulfilled: DataFrame, key: str, size: str = "24h", unique: bool = False
) -> DataFrame:
    """Pending and fulfilled orders, rate in percent and mean latency per placing window.

    Orders are counted in one narrow scan; only the fulfilled ones go through the join.
    Orders with the same key and time are one row with a number until they are counted.
    """
    window = times.window_start(F.col("placed_at"), size).alias("window_start")
    all_orders = placed.groupBy(window).agg(F.count("*").alias("placed"))
    alike = placed.groupBy(key, "placed_at").agg(F.count("*").alias("_n"))
    matched = first_fulfilled(alike, fulfilled, key, "_n", unique=unique)
    done = matched.groupBy(window).agg(
        F.sum("_n").alias("_done"), F.sum(F.col("_n") * latency_ms()).alias("_latency")
    )
    fulfilled_count = F.coalesce(F.col("_done"), F.lit(0))
    return all_orders.join(done, "window_start", "left").select(
        "window_start",
        "placed",
        fulfilled_count.alias("fulfilled"),
        (F.col("placed") - fulfilled_count).alias("pending"),
        money.hundredths_text(
            money.half_up_mean(fulfilled_count * 10_000, F.col("placed"))
        ).alias("rate_percent"),
        money.half_up_mean(F.col("_latency"), F.col("_done")).alias("mean_latency_ms"),
    )


def delivery_quality(produced: DataFrame, consumed: DataFrame, key: str) -> DataFrame:
    """Share of produced events that arrived, and share of arrivals that were repeats.

    Per-key counts are made first, so a key with many copies is reduced before the join.
    """
    arrived = consumed.groupBy(key).agg(F.count("*").alias("_copies"))
    matched = produced.select(key).distinct().join(arrived, key, "left")
    copies = F.coalesce(F.sum("_copies"), F.lit(0))
    delivered = F.count("_copies")
    return matched.agg(
        F.count("*").alias("produced"),
        delivered.alias("delivered"),
        copies.alias("arrivals"),
        (copies - delivered).alias("repeats"),
        money.hundredths_text(money.half_up_mean(delivered * 10_000, F.count("*"))).alias(
            "delivered_percent"
        ),
        money.hundredths_text(money.half_up_mean((copies - delivered) * 10_000, copies)).alias(
            "repeat_percent"
        ),
    )
