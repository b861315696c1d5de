"""Placed and fulfilled events joined while both arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import WINDOW_SIZES
from tidemark.functions import money
from tidemark.sources import files


def placed_fulfilled_stream(
    placed: DataFrame,
    fulfilled: DataFrame,
    key: str,
    horizon: str = "1 hour",
    placed_delay: str = "60 seconds",
    fulfilled_delay: str = "60 seconds",
) -> DataFrame:
    """Left outer stream join on the order key, ``fulfilled_at`` within ``horizon``.

    Watermarks on both sides and the time range bound the state; an order without a match
    comes out with a null once its horizon has passed.
    """
    left = placed.withWatermark("placed_at", placed_delay).alias("p")
    right = (
        fulfilled.select(F.col(key).alias("_code"), "fulfilled_at")
        .withWatermark("fulfilled_at", fulfilled_delay)
        .alias("f")
    )
    within = (
        (F.col(f"p.{key}") == F.col("f._code"))
        & (F.col("f.fulfilled_at") >= F.col("p.placed_at"))
        & (F.col("f.fulfilled_at") <= F.col("p.placed_at") + F.expr(f"interval {horizon}"))
    )
    return left.join(right, within, "leftOuter").drop("_code")


def fulfillment_metrics_stream(joined: DataFrame, size: str = "1h") -> DataFrame:
    """Placed, fulfilled and latency per placing window, over the joined stream.

    Each order must be joined at most once (see ``drop_repeats``). A window comes out when
    the horizon of its last order has passed, so late fulfillments are in it.
    """
    latency = F.unix_millis("fulfilled_at") - F.unix_millis("placed_at")
    return (
        joined.groupBy(F.window("placed_at", WINDOW_SIZES[size]).alias("_window"))
        .agg(
            F.count("*").alias("placed"),
            F.count("fulfilled_at").alias("fulfilled"),
            F.coalesce(F.sum(latency), F.lit(0)).alias("latency_ms"),
        )
        .select(F.col("_window.start").alias("window_start"), "placed", "fulfilled", "latency_ms")
    )


def with_rates(counts: DataFrame) -> DataFrame:
    """Counts and summed latency -> pending, rate in percent and mean latency."""
    placed, fulfilled = F.col("placed"), F.col("fulfilled")
    return counts.select(
        "window_start",
        "placed",
        "fulfilled",
        (placed - fulfilled).alias("pending"),
        money.hundredths_text(money.half_up_mean(fulfilled * 10_000, placed)).alias(
            "rate_percent"
        ),
        F.when(fulfilled > 0, money.half_up_mean(F.col("latency_ms"), fulfilled)).alias(
            "mean_latency_ms"
        ),
    )


def start_join(joined: DataFrame, folder: str, interval: str | None = None):
    def write(batch: DataFrame, batch_id: int) -> None:
        files.replace_batch(batch, f"{folder}/joined", batch_id)

    return files.start(joined, write, f"{folder}/offsets", interval)


def read_joined(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(f"{folder}/joined")


def drop_repeats(events: DataFrame, key: str, event_time: str, horizon: str) -> DataFrame:
    """Stream form of the duplicate skip: a repeat within ``horizon`` is dropped."""
    return events.withWatermark(event_time, horizon).dropDuplicatesWithinWatermark([key])
