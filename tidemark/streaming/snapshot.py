"""The every-n-th-order snapshot as a live query."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.config import StreamPolicy
from tidemark.operators import ordered
from tidemark.sources import files

SNAPSHOTS = StructType(
    [StructField("order_count", LongType()), StructField("item_lines", LongType())]
)


def start_snapshot(
    orders: DataFrame,
    order_by: Sequence[str],
    folder: str,
    lines: str = "item_lines",
    every: int = 10,
    interval: str | None = None,
    slices: int | None = None,
):
    """Global snapshots in arrival order of the batches and ``order_by`` inside a batch.

    Only the two totals pass from batch to batch; they are stored, so a restart goes on
    where the last run stopped.
    """
    totals = f"{folder}/totals"

    def write(batch: DataFrame, batch_id: int) -> None:
        before = files.carried_row(batch.sparkSession, totals, batch_id)
        counted, total = (before["counted"], before["total"]) if before else (0, 0)
        files.replace_batch(
            ordered.order_count_snapshot(
                batch, order_by, lines, every, counted, total, slices, f"{folder}/work"
            ),
            f"{folder}/snapshots",
            batch_id,
        )
        files.replace_batch(
            batch.agg(
                (F.lit(counted) + F.count("*")).alias("counted"),
                (F.lit(total) + F.coalesce(F.sum(lines), F.lit(0))).cast("bigint").alias("total"),
            ),
            totals,
            batch_id,
        )

    return files.start(orders, write, f"{folder}/offsets", interval)


def read_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(SNAPSHOTS).parquet(f"{folder}/snapshots")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    schema = StructType([StructField("shard", LongType()), *SNAPSHOTS.fields])
    return spark.read.schema(schema).parquet(f"{folder}/snapshots").select(schema.fieldNames())


def sharded_snapshots(
    orders: DataFrame, shard: str, lines: str = "item_lines", every: int = 10
) -> DataFrame:
    """Each shard keeps its own count and total, in arrival order.

    The state is two numbers per shard; the rows of a shard stream through in Arrow batches.
    A shard is one task per batch: deal rows out by a unique id and to enough shards.
    """

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        counted, total = state.get if state.exists else (0, 0)
        for rows in batches:
            counts = counted + pd.RangeIndex(1, len(rows) + 1).to_series(index=rows.index)
            sums = total + rows[lines].fillna(0).astype("int64").cumsum()
            if len(rows):
                counted, total = int(counts.iloc[-1]), int(sums.iloc[-1])
            fires = counts % every == 0
            yield pd.DataFrame(
                {"shard": key[0], "order_count": counts[fires], "item_lines": sums[fires]}
            )
        state.update((counted, total))

    return orders.groupBy(F.col(shard).cast("bigint").alias("shard")).applyInPandasWithState(
        step,
        outputStructType="shard bigint, order_count bigint, item_lines bigint",
        stateStructType="counted bigint, total bigint",
        outputMode="append",
        timeoutConf=GroupStateTimeout.NoTimeout,
    )


def ordered_shards(
    orders: DataFrame,
    shard: str,
    lines: str = "item_lines",
    every: int = 10,
    event_time: str = "event_time",
    event_id: str = "event_id",
    delay: str = StreamPolicy.watermark,
) -> DataFrame:
    """Each shard's count and total in order of time and id, however its rows arrive.

    A shard keeps rows until the watermark has passed them and then counts them in order; its
    state is two numbers and the rows of the last ``delay``. A timer at its oldest row lets a
    shard go on when only others get rows. Rows behind the watermark cannot be put in order
    any more and are left out: give it the on-time side of ``start_late_split``.
    """

    def step(
        key: tuple, batches: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        counted, total, *kept = state.get if state.exists else (0, 0, [], [], [])
        parts = [[np.array(values, np.int64)] for values in kept]
        for rows in batches:
            for part, name in zip(parts, ("_time", "_id", "_lines")):
                part.append(rows[name].to_numpy(np.int64))
        times, ids, values = (np.concatenate(part) for part in parts)
        order = np.lexsort((ids, times))
        times, ids, values = times[order], ids[order], values[order]
        reached = state.getCurrentWatermarkMs()
        ready = int(np.searchsorted(times, reached * 1000, "right"))
        counts = counted + np.arange(1, ready + 1)
        sums = total + np.cumsum(values[:ready])
        if ready:
            counted, total = int(counts[-1]), int(sums[-1])
        left = [part[ready:].tolist() for part in (times, ids, values)]
        state.update((counted, total, *left))
        if left[0]:
            state.setTimeoutTimestamp(max(left[0][0] // 1000, reached + 1))
        fires = counts % every == 0
        yield pd.DataFrame(
            {"shard": key[0], "order_count": counts[fires], "item_lines": sums[fires]}
        )

    rows = orders.where(F.col(event_time).isNotNull()).withWatermark(event_time, delay).select(
        F.col(shard).cast("bigint").alias("shard"),
        event_time,
        F.unix_micros(event_time).alias("_time"),
        F.col(event_id).cast("bigint").alias("_id"),
        F.coalesce(F.col(lines), F.lit(0)).cast("bigint").alias("_lines"),
    )
    return rows.groupBy("shard").applyInPandasWithState(
        step,
        outputStructType="shard bigint, order_count bigint, item_lines bigint",
        stateStructType=(
            "counted bigint, total bigint, "
            "times array<bigint>, ids array<bigint>, lines array<bigint>"
        ),
        outputMode="append",
        timeoutConf=GroupStateTimeout.EventTimeTimeout,
    )


def start_ordered_shards(
    orders: DataFrame, shard: str, folder: str, interval: str | None = None, **options
):
    def write(batch: DataFrame, batch_id: int) -> None:
        files.replace_batch(batch, f"{folder}/snapshots", batch_id)

    stream = ordered_shards(orders, shard, **options)
    return files.start(stream, write, f"{folder}/offsets", interval)


def start_sharded_snapshot(
    orders: DataFrame,
    shard: str,
    folder: str,
    lines: str = "item_lines",
    every: int = 10,
    interval: str | None = None,
):
    def write(batch: DataFrame, batch_id: int) -> None:
        files.replace_batch(batch, f"{folder}/snapshots", batch_id)

    stream = sharded_snapshots(orders.select(shard, lines), shard, lines, every)
    return files.start(stream, write, f"{folder}/offsets", interval)
