"""Windowed metrics that late rows correct and a quiet input does not hold up.

Nothing is dropped behind a watermark. Each batch is aggregated to partial windows, which are
added to the stored totals of just these windows. A window comes out as version 1 once the
newest event is ``lateness`` past its end; a row that comes later still is added and the
window comes out again with the next version, so the newest versions equal a calculation over
all rows. Windows without rows come out as zero rows. A batch without rows (a heartbeat) may
close windows by the clock, so that gaps show while nothing arrives.

The stored windows are one row per window and batch that touched it, by day; a batch reads the
days it touches or closes, never the rows of earlier batches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, LongType, StructField, StructType

from tidemark.config import WINDOW_SIZES, StreamPolicy
from tidemark.functions import money, times
from tidemark.operators import metrics
from tidemark.sources import files, messages
from tidemark.sources.topics import Send
from tidemark.streaming import retries
from tidemark.streaming.metrics import METRICS

VERSIONS = StructType([*METRICS.fields, StructField("version", IntegerType())])
_KEPT = StructType(
    [
        METRICS["window_start"],
        *(METRICS[name] for name in metrics.MEASURES),
        StructField("version", IntegerType()),
        StructField("day", DateType()),
        StructField("batch_id", LongType()),
    ]
)


def start_corrected_metrics(
    orders: DataFrame,
    size: str,
    folder: str,
    interval: str | None = None,
    event_time: str = "event_time",
    amount: str = "amount",
    lateness: str = StreamPolicy.watermark,
    now: Column | None = None,
    quiet_after: str = StreamPolicy.watermark,
    send: Send | None = None,
):
    """Append versions of windows to ``folder/metrics``; ``read_latest`` gives the newest.

    With ``now`` a batch without rows closes the windows that ended ``quiet_after`` before it.
    With ``send`` every version goes to the analytics topic too, from the written table.
    """
    kept = f"{folder}/windows/window_size={size}"
    table = f"{folder}/metrics/window_size={size}"
    frontier = f"{folder}/frontier/{size}"
    step = times.window_step(size)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = retries.without_heartbeat(batch).where(F.col(event_time).isNotNull())
        start = times.window_start(F.col(event_time), size)
        partial = (
            rows.groupBy(start.alias("window_start"))
            .agg(
                F.count("*").alias("order_count"),
                F.coalesce(F.sum(money.to_cents(F.col(amount))), F.lit(0)).alias("revenue_cents"),
                F.max(event_time).alias("_newest"),
            )
            .persist()
        )
        try:
            before = files.carried_row(spark, frontier, batch_id)
            first, reached = (before["first"], before["reached"]) if before else (None, None)
            clock = F.lit(None).cast("timestamp")
            if now is not None:
                clock = now - F.expr(f"interval {quiet_after}")
            limit = F.coalesce(F.max("_newest") - F.expr(f"interval {lateness}"), clock)
            old_first, old_reached = (F.lit(v).cast("timestamp") for v in (first, reached))
            ends = partial.agg(
                F.least(F.min("window_start"), old_first).alias("first"),
                times.window_start(limit, size).alias("limit"),
                F.collect_set(_day()).alias("days"),  # as many as the calendar has
            )
            known = ends.select(
                "first", F.greatest("limit", old_reached, "first").alias("reached"), "days"
            ).first()
            new_first, new_reached = known["first"], known["reached"]
            totals = _totals(spark, kept, batch_id, known["days"], reached, new_reached)
            spans = [(reached or new_first, new_reached)]
            if first is not None:
                spans.append((new_first, first))
            merged = _merge(totals, partial, _spine(spark, spans, size))
            closed = F.col("window_start") + step <= F.lit(new_reached).cast("timestamp")
            version = F.coalesce("version", F.lit(0)) + closed.cast("int")
            changed = merged.select(
                "window_start", *metrics.MEASURES, version.alias("version"), _day().alias("day")
            )
            files.replace_batch(changed.repartition("day"), kept, batch_id, by=["day"])
            written = spark.read.schema(_KEPT).parquet(files.batch_path(kept, batch_id))
            out = written.where(closed).select(
                "window_start",
                (F.col("window_start") + step).alias("window_end"),
                *metrics.MEASURES,
                "version",
                "day",
            )
            files.replace_batch(out, table, batch_id, by=["day"])
            if send:
                stored = spark.read.schema(VERSIONS).parquet(files.batch_path(table, batch_id))
                records = stored.withColumn("window_size", F.lit(size))
                send(messages.metric_messages(records, F.current_timestamp()))
            carried = "first timestamp, reached timestamp"
            files.replace_batch(
                spark.createDataFrame([(new_first, new_reached)], carried), frontier, batch_id
            )
        finally:
            partial.unpersist()

    stream = retries.with_heartbeat(orders.select(event_time, amount))
    return files.start(stream, write, f"{folder}/offsets/{size}", interval)


def _day() -> Column:
    return F.to_date("window_start")


def _totals(spark: SparkSession, kept: str, batch_id: int, days: list, reached, new_reached):
    """The newest totals of the windows on these days, and of those that close now."""
    if batch_id == 0:
        return spark.createDataFrame([], StructType(_KEPT.fields[:4]))
    wanted = F.col("day").isin(days) if days else F.lit(False)
    if new_reached is not None:
        from_day = F.to_date(F.lit(reached).cast("timestamp"))
        to_day = F.to_date(F.lit(new_reached).cast("timestamp"))
        wanted = wanted | F.coalesce(F.col("day").between(from_day, to_day), F.lit(False))
    rows = spark.read.schema(_KEPT).parquet(kept)
    newest = F.max_by(F.struct(*metrics.MEASURES, "version"), "batch_id")
    return (
        rows.where((F.col("batch_id") < batch_id) & wanted)
        .groupBy("window_start")
        .agg(newest.alias("_last"))
        .select("window_start", "_last.*")
    )


def _spine(spark: SparkSession, spans: list[tuple], size: str) -> DataFrame:
    """The starts of all windows in these spans: they close now, with rows or without."""
    step = times.window_step(size)
    known = [span for span in spans if span[0] is not None and span[1] is not None]
    ends = spark.createDataFrame(known, "low timestamp, high timestamp")
    return (
        ends.where(F.col("low") < F.col("high"))
        .select(F.explode(F.sequence(F.col("low"), F.col("high") - step, step)).alias("window_start"))
        .distinct()
    )


def _merge(totals: DataFrame, partial: DataFrame, spine: DataFrame) -> DataFrame:
    """Totals with this batch's partials added, of windows that got rows or close now."""
    zero = [F.lit(0).cast("bigint").alias(name) for name in metrics.MEASURES]
    added = (
        partial.select("window_start", *metrics.MEASURES)
        .unionByName(spine.select("window_start", *zero))
        .groupBy("window_start")
        .agg(*(F.sum(name).alias(f"_{name}") for name in metrics.MEASURES))
    )
    return added.join(totals, "window_start", "left").select(
        "window_start",
        *(
            (F.coalesce(F.col(name), F.lit(0)) + F.col(f"_{name}")).alias(name)
            for name in metrics.MEASURES
        ),
        "version",
    )


def start_all_sizes(
    orders: DataFrame,
    folder: str,
    sizes: Sequence[str] = tuple(WINDOW_SIZES),
    interval: str | None = None,
    **options,
) -> list:
    return [
        start_corrected_metrics(orders, size, folder, interval, **options) for size in sizes
    ]


def read_versions(spark: SparkSession, folder: str) -> DataFrame:
    """Every version of every window that came out."""
    return spark.read.schema(VERSIONS).parquet(f"{folder}/metrics")


def read_latest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per window, its newest version."""
    return (
        read_versions(spark, folder)
        .groupBy("window_size", "window_start", "window_end")
        .agg(F.max_by(F.struct(*metrics.MEASURES), "version").alias("_last"), F.max("version").alias("version"))
        .select("window_start", "window_end", "window_size", "_last.*", "version")
    )
