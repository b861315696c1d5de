"""Running results over one global order, without a window that holds the whole table.

The rows are cut into range slices of about equal size (the tie-breaking id is part of the
range key, so even a single hot timestamp is spread). The slices are written to the
checkpoint folder: the layout is then fixed, and small per-slice results can be carried
from slice to slice. The table of slices has one row per slice, whatever the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import WINDOW_SIZES
from tidemark.functions import times
from tidemark.functions.money import half_up_mean, hundredths_text, whole_div
from tidemark.session import settle

ROWS_PER_SLICE = 2_000_000
_POSITION_BITS = 33  # rows of a partition in monotonically_increasing_id
_GROUPS_PER_BLOCK = 100_000
_EARLIER = (Window.unboundedPreceding, -1)


def _count_slices(df: DataFrame) -> int:
    """As many as there are shuffle partitions, and more where slices would grow too large."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-df.count() // ROWS_PER_SLICE))


def range_slices(
    df: DataFrame, order_by: Sequence[str], slices: int | None, work: str | None = None
) -> DataFrame:
    count = slices or _count_slices(df)
    return settle(
        df.repartitionByRange(count, *order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("_slice", F.spark_partition_id())
        .withColumn(
            "_position",
            F.monotonically_increasing_id().bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        ),
        work,
    )


def number_rows(
    df: DataFrame, order_by: Sequence[str], slices: int | None = None, work: str | None = None
) -> DataFrame:
    """Adds ``n``, the 1-based place in the global order. ``order_by`` must be unique.

    ``work`` is a folder for the slices that the caller uses again and again; each run
    replaces what the one before left there.
    """
    cut = range_slices(df, order_by, slices, work)
    sizes = cut.groupBy("_slice").agg(F.count("*").alias("_rows"))
    starts = sizes.select(
        "_slice",
        F.coalesce(F.sum("_rows").over(Window.orderBy("_slice").rowsBetween(*_EARLIER)), F.lit(0))
        .alias("_start"),
    )
    return (
        cut.join(F.broadcast(starts), "_slice")  # one row per slice
        .withColumn("n", F.col("_start") + F.col("_position") + 1)
        .drop("_slice", "_position", "_start")
    )


def order_count_snapshot(
    orders: DataFrame,
    order_by: Sequence[str],
    lines: str = "item_lines",
    every: int = 10,
    counted: int = 0,
    total: int = 0,
    slices: int | None = None,
    work: str | None = None,
) -> DataFrame:
    """Cumulative ``order_count`` and ``item_lines`` after each ``every``-th order.

    ``counted``/``total`` continue an earlier run. Once rows are numbered, each run of
    ``every`` rows is one small group; only the groups are shuffled, and the running sum
    goes over blocks of groups that are equally large by construction.
    """
    rows = number_rows(orders.select(*order_by, lines), order_by, slices, work)
    numbered = rows.withColumn("n", F.col("n") + counted)
    place = F.col("n") - 1
    value = F.coalesce(F.col(lines), F.lit(0)).cast("bigint")
    block_rows = every * _GROUPS_PER_BLOCK

    groups = (
        numbered.groupBy(
            whole_div(place, F.lit(block_rows)).alias("_block"),
            whole_div(place, F.lit(every)).alias("_group"),
        )
        .agg(F.max("n").alias("order_count"), F.sum(value).alias("_lines"))
    )
    blocks = numbered.groupBy(whole_div(place, F.lit(block_rows)).alias("_block")).agg(
        F.sum(value).alias("_block_lines")
    )
    earlier_blocks = Window.orderBy("_block").rowsBetween(*_EARLIER)
    starts = blocks.select(
        "_block",
        F.coalesce(F.sum("_block_lines").over(earlier_blocks), F.lit(0)).alias("_start"),
    )
    in_block = (
        Window.partitionBy("_block")
        .orderBy("_group")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        groups.join(starts, "_block")
        .withColumn("item_lines", F.lit(total) + F.col("_start") + F.sum("_lines").over(in_block))
        .where(F.col("order_count") % every == 0)
        .select("order_count", "item_lines")
    )


def snapshot_records(snapshots: DataFrame, as_of: Column) -> DataFrame:
    """The outgoing record of a snapshot: the minute before ``as_of``, total without scale."""
    now = F.unix_millis(as_of)
    count = F.col("order_count")
    lines = F.col("item_lines")
    return snapshots.select(
        (now - 60_000).alias("windowStart"),
        now.alias("windowEnd"),
        F.lit("1m").alias("windowSize"),
        count.alias("orderCount"),
        lines.cast("string").alias("totalRevenue"),
        hundredths_text(half_up_mean(lines * 100, count)).alias("avgOrderValue"),
        now.alias("processedAt"),
    )


def running_totals(
    df: DataFrame, order_by: Sequence[str], values: Sequence[str], slices: int | None = None
) -> DataFrame:
    """Adds ``n`` and ``running_<value>`` from the first row to this one, for every row."""
    cut = range_slices(df, order_by, slices)
    sums = {v: F.sum(F.coalesce(F.col(v), F.lit(0))) for v in values}
    sizes = cut.groupBy("_slice").agg(
        F.count("*").alias("_rows"), *[total.alias(f"_sum_{v}") for v, total in sums.items()]
    )
    earlier = Window.orderBy("_slice").rowsBetween(*_EARLIER)
    starts = sizes.select(
        "_slice",
        *[
            F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(f"_start{name}")
            for name in ("_rows", *[f"_sum_{v}" for v in values])
        ],
    )
    so_far = (
        Window.partitionBy("_slice")
        .orderBy("_position")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return cut.join(F.broadcast(starts), "_slice").select(  # one row per slice
        *df.columns,
        (F.col("_start_rows") + F.col("_position") + 1).alias("n"),
        *[
            (F.col(f"_start_sum_{v}") + total.over(so_far)).alias(f"running_{v}")
            for v, total in sums.items()
        ],
    )


def tag_late(
    events: DataFrame,
    arrival_order: Sequence[str],
    event_time: str = "event_time",
    tolerance: str = "60 seconds",
    seen: Column | None = None,
    slices: int | None = None,
    work: str | None = None,
) -> DataFrame:
    """Adds ``is_late``: more than ``tolerance`` behind the newest earlier arrival.

    Exactly ``tolerance`` behind is on time. ``seen`` is the newest event time of earlier
    batches, if any. ``arrival_order`` must be unique.
    """
    cut = range_slices(events, arrival_order, slices, work)
    tops = cut.groupBy("_slice").agg(F.max(event_time).alias("_top"))
    before = tops.select(
        "_slice",
        F.max("_top").over(Window.orderBy("_slice").rowsBetween(*_EARLIER)).alias("_before"),
    )
    in_slice = Window.partitionBy("_slice").orderBy("_position").rowsBetween(*_EARLIER)
    newest = F.greatest(
        F.col("_before"),
        F.max(event_time).over(in_slice),
        seen if seen is not None else F.lit(None).cast("timestamp"),
    )
    limit = newest - F.expr(f"interval {tolerance}")
    return (
        cut.join(F.broadcast(before), "_slice")  # one row per slice
        .withColumn("is_late", F.coalesce(F.col(event_time) < limit, F.lit(False)))
        .drop("_slice", "_position", "_before")
    )


def late_counts(
    tagged: DataFrame, sizes: Sequence[str] = tuple(WINDOW_SIZES), event_time: str = "event_time"
) -> DataFrame:
    """Included and late rows per window, for every window size, from one scan."""
    minutes = tagged.groupBy(times.window_start(F.col(event_time), "1m").alias("_minute")).agg(
        F.count_if(~F.col("is_late")).alias("included"), F.count_if("is_late").alias("late")
    )
    targets = F.array(
        *[
            F.struct(
                F.lit(size).alias("window_size"),
                times.window_start(F.col("_minute"), size).alias("window_start"),
            )
            for size in sizes
        ]
    )
    return (
        minutes.select(F.explode(targets).alias("_target"), "included", "late")
        .groupBy("_target.window_size", "_target.window_start")
        .agg(F.sum("included").alias("included"), F.sum("late").alias("late"))
    )
