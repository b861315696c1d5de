"""Late events to a table of their own."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ordered
from tidemark.sources import files


def start_late_split(
    events: DataFrame,
    arrival_order: Sequence[str],
    folder: str,
    event_time: str = "event_time",
    tolerance: str = "60 seconds",
    interval: str | None = None,
    slices: int | None = None,
):
    """Split each batch against the newest event time seen so far.

    What was seen is stored per batch, so a batch run again gives the same split.
    """
    seen_table = f"{folder}/seen"

    def write(batch: DataFrame, batch_id: int) -> None:
        before = files.carried_row(batch.sparkSession, seen_table, batch_id)
        seen = F.lit(before["seen"] if before else None).cast("timestamp")
        tagged = ordered.tag_late(
            batch, arrival_order, event_time, tolerance, seen, slices, f"{folder}/work"
        )
        files.replace_batch(tagged, f"{folder}/events", batch_id, by=["is_late"])
        files.replace_batch(
            batch.agg(F.greatest(F.max(event_time), seen).alias("seen")), seen_table, batch_id
        )

    return files.start(events, write, f"{folder}/offsets", interval)


def read_split(spark: SparkSession, folder: str) -> DataFrame:
    """On-time and late events; filter on ``is_late`` to read one side only."""
    rows = spark.read.parquet(f"{folder}/events")
    return rows.withColumn("is_late", F.col("is_late").cast("boolean"))


def dropped_rows(query) -> int:
    """Rows a finished or running query dropped behind its watermark (recent progress)."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )
