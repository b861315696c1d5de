"""Order metrics in tumbling event-time windows.

A metrics frame has ``window_start, window_end, window_size, order_count,
revenue_cents``. Counts and cents add up, so larger windows are made from smaller ones.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import WINDOW_SIZES
from tidemark.functions import money, times

MEASURES = ("order_count", "revenue_cents")


def windowed_metrics(
    orders: DataFrame,
    size: str = "1m",
    event_time: str = "event_time",
    amount: str = "amount",
    by: Sequence[str] = (),
) -> DataFrame:
    """Count and revenue per window (and per ``by`` key). Batch or stream."""
    return (
        orders.groupBy(F.window(event_time, WINDOW_SIZES[size]).alias("_window"), *by)
        .agg(
            F.count("*").alias("order_count"),
            F.coalesce(F.sum(money.to_cents(F.col(amount))), F.lit(0)).alias("revenue_cents"),
        )
        .select(
            F.col("_window.start").alias("window_start"),
            F.col("_window.end").alias("window_end"),
            F.lit(size).alias("window_size"),
            *by,
            *MEASURES,
        )
    )


def multi_size_metrics(
    orders: DataFrame,
    sizes: Sequence[str] = tuple(WINDOW_SIZES),
    event_time: str = "event_time",
    amount: str = "amount",
) -> DataFrame:
    """All window sizes from one scan: minutes first, then the minutes rolled up."""
    minutes = windowed_metrics(orders, "1m", event_time, amount)
    spread = minutes.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(size).alias("window_size"),
                        times.window_start(F.col("window_start"), size).alias("window_start"),
                        (times.window_start(F.col("window_start"), size) + times.window_step(size))
                        .alias("window_end"),
                    )
                    for size in sizes
                ]
            )
        ).alias("_target"),
        *MEASURES,
    )
    return (
        spread.groupBy("_target.window_start", "_target.window_end", "_target.window_size")
        .agg(*[F.sum(m).alias(m) for m in MEASURES])
        .select("window_start", "window_end", "window_size", *MEASURES)
    )


def union_sizes(*frames: DataFrame) -> DataFrame:
    """Results of separate window sizes as one output, told apart by ``window_size``."""
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def _next_in_table(metrics: DataFrame, size: str) -> DataFrame:
    """Adds ``next_start``, the start of the next window that has a row.

    The window function runs inside one day; the step over midnight is looked up in a
    table with one row per day, so no task sees the whole table.
    """
    rows = metrics.where(F.col("window_size") == size).withColumn(
        "_day", F.date_trunc("day", "window_start")
    )
    in_day = Window.partitionBy("_day").orderBy("window_start")
    first = rows.groupBy("_day").agg(F.min("window_start").alias("_first"))
    following = first.select("_day", F.lead("_first").over(Window.orderBy("_day")).alias("_after"))
    return (
        rows.withColumn("_same_day", F.lead("window_start").over(in_day))
        .join(following, "_day")
        .withColumn("next_start", F.coalesce("_same_day", "_after"))
        .drop("_day", "_same_day", "_after")
    )


def metric_gaps(metrics: DataFrame, size: str) -> DataFrame:
    """Windows followed by missing ones: ``window_start, next_start, missing_windows``.

    Reads ``metrics`` twice; give it a stored table.
    """
    step = F.unix_micros("window_end") - F.unix_micros("window_start")
    ahead = F.unix_micros("next_start") - F.unix_micros("window_start")
    return (
        _next_in_table(metrics, size)
        .withColumn("missing_windows", money.whole_div(ahead, step) - 1)
        .where(F.col("missing_windows") > 0)
        .select("window_size", "window_start", "next_start", "missing_windows")
    )


def fill_empty_windows(
    metrics: DataFrame,
    size: str,
    since: Column | None = None,
    until: Column | None = None,
) -> DataFrame:
    """A row for every window from the first to the last one, zero where nothing came.

    ``since``/``until`` (window starts) widen the range. Reads ``metrics`` twice; give it
    a stored table. The spine has one row per window: it grows with time, not with data.
    """
    rows = metrics.where(F.col("window_size") == size)
    step = times.window_step(size)
    bounds = rows.agg(
        F.least(F.min("window_start"), since if since is not None else F.min("window_start")).alias(
            "_first"
        ),
        F.greatest(
            F.max("window_start"), until if until is not None else F.max("window_start")
        ).alias("_last"),
    )
    day = F.expr("interval 1 day")
    days = bounds.where(F.col("_first").isNotNull()).select(
        "_first",
        "_last",
        F.explode(F.sequence(F.date_trunc("day", "_first"), F.col("_last"), day)).alias("_day"),
    )
    spine = (
        days.select(
            "_first",
            "_last",
            F.explode(F.sequence(F.col("_day"), F.col("_day") + day - step, step)).alias(
                "window_start"
            ),
        )
        .where(F.col("window_start").between(F.col("_first"), F.col("_last")))
        .select("window_start")
    )
    return spine.join(rows.select("window_start", *MEASURES), "window_start", "left").select(
        "window_start",
        (F.col("window_start") + step).alias("window_end"),
        F.lit(size).alias("window_size"),
        *[F.coalesce(F.col(m), F.lit(0)).cast("bigint").alias(m) for m in MEASURES],
    )


def running_daily_totals(metrics: DataFrame) -> DataFrame:
    """Totals so far on the same (UTC) day. A partition is one day of windows."""
    so_far = (
        Window.partitionBy("window_size", F.date_trunc("day", "window_start"))
        .orderBy("window_start")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return metrics.select(
        "*", *[F.sum(m).over(so_far).alias(f"day_{m}") for m in MEASURES]
    )


def latest_metrics(versions: DataFrame) -> DataFrame:
    """One row per window: the version processed last, and how many versions there were."""
    return (
        versions.groupBy("window_size", "window_start", "window_end")
        .agg(
            F.max_by(F.struct(*MEASURES), "processed_at").alias("_last"),
            F.max("processed_at").alias("processed_at"),
            F.count("*").alias("versions"),
        )
        .select(
            "window_start",
            "window_end",
            "window_size",
            "_last.order_count",
            "_last.revenue_cents",
            "processed_at",
            "versions",
        )
    )


def metric_records(metrics: DataFrame, processed_at: Column) -> DataFrame:
    """The outgoing record: times in epoch millis, money as plain text."""
    cents = F.col("revenue_cents")
    count = F.col("order_count")
    return metrics.select(
        times.millis(F.col("window_start")).alias("windowStart"),
        times.millis(F.col("window_end")).alias("windowEnd"),
        F.col("window_size").alias("windowSize"),
        count.alias("orderCount"),
        money.hundredths_text(cents).alias("totalRevenue"),
        money.hundredths_text(money.half_up_mean(cents, count)).alias("avgOrderValue"),
        times.millis(processed_at).alias("processedAt"),
    )
