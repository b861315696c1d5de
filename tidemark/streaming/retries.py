"""Retries as rows: a failed row waits in a table and joins a later batch when it is due.

Nothing sleeps. The waiting table of a batch holds all rows that still wait, so a batch reads
only the table of the one before it. A heartbeat gives a query a batch per trigger even when
its input is quiet, so that waiting rows come up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType, TimestampType

from tidemark.config import RetryPolicy
from tidemark.functions import retry
from tidemark.sources import files

ATTEMPT, DUE = "attempt", "next_attempt_at"
_STATE = [StructField(ATTEMPT, IntegerType()), StructField(DUE, TimestampType())]
_BEAT = "_beat"


def with_heartbeat(stream: DataFrame) -> DataFrame:
    """The stream plus one marked row per trigger; ``without_heartbeat`` takes it out again."""
    beat = (
        stream.sparkSession.readStream.format("rate-micro-batch")
        .option("rowsPerBatch", 1)
        .load()
        .select(F.lit(True).alias(_BEAT))
    )
    marked = stream.withColumn(_BEAT, F.lit(False))
    return marked.unionByName(beat, allowMissingColumns=True)


def without_heartbeat(batch: DataFrame) -> DataFrame:
    return batch.where(~F.col(_BEAT)).drop(_BEAT) if _BEAT in batch.columns else batch


def waiting_schema(schema: StructType) -> StructType:
    return StructType([f for f in schema.fields if f.name not in (ATTEMPT, DUE)] + _STATE)


def with_due(
    batch: DataFrame, folder: str, batch_id: int, now: Column
) -> tuple[DataFrame, DataFrame]:
    """The rows to try now (new ones with attempt 1) and those that go on waiting."""
    schema = waiting_schema(batch.schema)
    new = batch.withColumns({ATTEMPT: F.lit(1), DUE: now}).select(schema.fieldNames())
    if batch_id == 0:
        return new, new.limit(0)
    waiting = files.read_batch(batch.sparkSession, f"{folder}/waiting", batch_id - 1, schema)
    due = F.col(DUE) <= now
    return new.unionByName(waiting.where(due)), waiting.where(~due)


def again(
    failed: DataFrame, now: Column, policy: RetryPolicy, transient: Column | None = None
) -> tuple[DataFrame, DataFrame]:
    """Failed rows that get another try, with its time, and those that had their last one.

    With ``transient`` only rows for which it holds are tried again.
    """
    left = F.col(ATTEMPT) < policy.max_attempts
    if transient is not None:
        left = left & F.coalesce(transient, F.lit(False))
    waiting = failed.where(left).withColumns(
        {DUE: retry.next_attempt_at(now, F.col(ATTEMPT), policy), ATTEMPT: F.col(ATTEMPT) + 1}
    )
    return waiting, failed.where(~left)


def keep_waiting(
    rows: DataFrame, folder: str, batch_id: int, schema: StructType
) -> None:
    files.replace_batch(rows.select(schema.fieldNames()), f"{folder}/waiting", batch_id)
