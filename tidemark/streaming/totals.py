"""Live windows per key, and live running totals that start anew each (UTC) day.

Both take closed windows only: in append mode a window comes out once, when the watermark
has passed its end, and all later ones end after it. So the totals of a day need no more
than the totals of its last closed window, which are carried from batch to batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.config import StreamPolicy
from tidemark.operators import metrics
from tidemark.sources import files
from tidemark.streaming.metrics import METRICS

TOTALS = StructType(
    [
        *METRICS.fields,
        *(StructField(f"day_{name}", LongType()) for name in metrics.MEASURES),
    ]
)


def start_keyed_metrics(
    orders: DataFrame,
    size: str,
    by: Sequence[str],
    folder: str,
    interval: str | None = None,
    event_time: str = "event_time",
    amount: str = "amount",
    watermark: str = StreamPolicy.watermark,
):
    """Append the closed windows of each ``by`` key to ``folder/keyed``.

    A task sends one row per key and window to the shuffle however many orders a key has,
    and the state is one row per key and open window, so a hot key needs no salt. Null is
    a key like any other. Windows of a key without rows do not come out.
    """
    table = f"{folder}/keyed/window_size={size}"
    stream = metrics.windowed_metrics(
        orders.withWatermark(event_time, watermark), size, event_time, amount, by
    )

    def write(batch: DataFrame, batch_id: int) -> None:
        by_day = batch.drop("window_size").withColumn("day", F.to_date("window_start"))
        files.replace_batch(by_day, table, batch_id, by=["day"])

    return files.start(stream, write, f"{folder}/offsets/keyed-{size}", interval)


def read_keyed_metrics(spark: SparkSession, folder: str, keys: StructType) -> DataFrame:
    """The stored windows; ``keys`` has the fields of ``by``."""
    schema = StructType([*METRICS.fields, *keys.fields])
    return spark.read.schema(schema).parquet(f"{folder}/keyed")


def start_running_totals(
    orders: DataFrame,
    size: str,
    folder: str,
    interval: str | None = None,
    event_time: str = "event_time",
    amount: str = "amount",
    watermark: str = StreamPolicy.watermark,
):
    """Append closed windows with the totals so far on their day to ``folder/totals``.

    A batch that runs again starts from the totals of the batch before, so it counts no
    window twice. Rows behind the watermark are in no window, as with all closed windows.
    """
    table, carried = f"{folder}/totals/window_size={size}", f"{folder}/carried/{size}"
    stream = metrics.windowed_metrics(
        orders.withWatermark(event_time, watermark), size, event_time, amount
    )
    sums = [f"day_{name}" for name in metrics.MEASURES]

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = files.carried_row(spark, carried, batch_id)
        day = F.lit(before["day"] if before else None).cast("timestamp")
        starts = {name: F.lit(before[name] if before else None).cast("bigint") for name in sums}
        same_day = F.date_trunc("day", "window_start") == day
        running = metrics.running_daily_totals(batch).withColumns(
            {n: F.col(n) + F.when(same_day, starts[n]).otherwise(0) for n in sums}
        )
        files.replace_batch(running.drop("window_size"), table, batch_id)
        written = files.read_batch(
            spark, table, batch_id, StructType([f for f in TOTALS if f.name != "window_size"])
        )
        last = written.agg(
            F.max_by(F.struct(F.date_trunc("day", "window_start").alias("day"), *sums), "window_start")
            .alias("last")
        )
        kept = F.struct(day.alias("day"), *(starts[n].alias(n) for n in sums))
        files.replace_batch(
            last.select(F.coalesce("last", kept).alias("last")).select("last.*"), carried, batch_id
        )

    return files.start(stream, write, f"{folder}/offsets/totals-{size}", interval)


def read_running_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The stored windows with the totals of their day so far."""
    return spark.read.schema(TOTALS).parquet(f"{folder}/totals")
