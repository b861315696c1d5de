"""Windowed metrics as a live query, one query per window size."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from tidemark.config import WINDOW_SIZES, StreamPolicy
from tidemark.operators import metrics
from tidemark.sources import files, messages
from tidemark.sources.topics import Send

METRICS = StructType(
    [
        StructField("window_start", TimestampType()),
        StructField("window_end", TimestampType()),
        StructField("order_count", LongType()),
        StructField("revenue_cents", LongType()),
        StructField("window_size", StringType()),
    ]
)


def closed_windows(
    orders: DataFrame,
    size: str,
    event_time: str = "event_time",
    amount: str = "amount",
    watermark: str = StreamPolicy.watermark,
) -> DataFrame:
    """Metrics of a stream; in append mode each window comes out once, when it closes."""
    return metrics.windowed_metrics(
        orders.withWatermark(event_time, watermark), size, event_time, amount
    )


def start_metrics(
    orders: DataFrame,
    size: str,
    folder: str,
    interval: str | None = None,
    fill_empty: bool = True,
    send: Send | None = None,
    **columns: str,
):
    """Append closed windows to ``folder/metrics``, with zero rows for empty windows.
    With ``send`` they go to the analytics topic too, after the table.

    A window that closed without rows lies between two windows that had some, so it is
    filled in when the later one closes.
    """
    frontier = f"{folder}/frontier/{size}"
    table = f"{folder}/metrics/window_size={size}"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = files.carried_row(spark, frontier, batch_id)
        reached = F.lit(before["reached"] if before else None).cast("timestamp")
        closed = batch.persist()
        try:
            rows = metrics.fill_empty_windows(closed, size, since=reached) if fill_empty else closed
            by_day = rows.withColumn("day", F.to_date("window_start"))
            # A day has at most 1,440 windows, so one file per day stays small.
            files.replace_batch(
                by_day.drop("window_size").repartition("day"), table, batch_id, by=["day"]
            )
            if send:
                # The written table: a batch that is run again sends the same rows.
                stored = files.read_batch(spark, table, batch_id, StructType(METRICS.fields[:-1]))
                records = stored.withColumn("window_size", F.lit(size))
                send(messages.metric_messages(records, F.current_timestamp()))
            files.replace_batch(
                closed.agg(F.coalesce(F.max("window_end"), reached).alias("reached")),
                frontier,
                batch_id,
            )
        finally:
            closed.unpersist()

    stream = closed_windows(orders, size, **columns)
    return files.start(stream, write, f"{folder}/offsets/{size}", interval)


def start_all_sizes(
    orders: DataFrame,
    folder: str,
    sizes: Sequence[str] = tuple(WINDOW_SIZES),
    interval: str | None = None,
    **columns: str,
) -> list:
    return [start_metrics(orders, size, folder, interval, **columns) for size in sizes]


def read_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """The stored metrics, partitioned by ``window_size`` and ``day``."""
    return spark.read.schema(METRICS).parquet(f"{folder}/metrics")
