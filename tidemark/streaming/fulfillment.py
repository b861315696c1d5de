"""Placed events to fulfilled events, and fulfilled events to order status."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark import config as C
from tidemark.config import RetryPolicy
from tidemark.functions import headers
from tidemark.operators import deadletter, fulfillment, orders
from tidemark.sources import files, messages
from tidemark.sources.topics import Send
from tidemark.streaming import delivery, retries


def route(decoded: DataFrame, hook: fulfillment.Hook) -> DataFrame:
    """Adds ``outcome``: fulfilled, dead_letter, quarantine (bad metadata) or skipped."""
    processed = fulfillment.process(
        decoded.withColumn("event_id", F.col("metadata.event_id")), hook
    )
    return processed.withColumn(
        "outcome",
        F.when(F.col("placed").isNull(), "skipped")
        .when(F.col("metadata.state") == "malformed", "quarantine")
        .otherwise(F.col("outcome")),
    )


def start_fulfillment(
    placed_messages: DataFrame,
    folder: str,
    as_of: Column,
    hook: fulfillment.Hook = fulfillment.accept_all,
    interval: str | None = None,
    send: Send | None = None,
    policy: RetryPolicy = RetryPolicy(max_attempts=1),
    transient: Column | None = None,
    connect: delivery.Connect | None = None,
):
    """Each batch: decode, process, then fulfilled events and dead letters to their tables.

    A message whose processing fails waits for its next try; after ``policy.max_attempts``
    tries it becomes a dead letter. The hook sees the number of the try as ``attempt``. With
    ``transient``, a condition on ``error_type`` (and ``fatal``), other errors are not tried
    again. With ``send`` both are sent to their topics as well, after the tables are written.

    With ``connect`` the tasks send the fulfilled events themselves, and an event the client
    refuses counts as failed, its code as ``error_type``. What was sent is written first and
    is not sent again when the batch is run again.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        messages_in = retries.without_heartbeat(batch)
        kept = retries.waiting_schema(messages_in.schema)
        tried, waiting = retries.with_due(messages_in, folder, batch_id, as_of)
        routed = route(messages.decode_placed(tried, as_of), hook).persist()
        try:
            fulfilled = routed.where(F.col("outcome") == "fulfilled")
            errors = routed.where(F.col("outcome") == "dead_letter")
            if "fatal" not in errors.columns:
                errors = errors.withColumn("fatal", F.lit(False))
            if connect:
                sent = _sent(fulfilled, folder, batch_id, as_of, connect)
                events = sent.where(F.col("error").isNull()).select("_event.*")
                refused = sent.where(F.col("error").isNotNull()).withColumns(
                    {"error_type": F.col("error_code"), "error_message": F.col("error")}
                )
                names = [*kept.fieldNames(), "metadata", "error_type", "error_message", "fatal"]
                errors = errors.select(*names).unionByName(refused.select(*names))
            else:
                events = fulfillment.fulfilled_events(fulfilled, as_of)
            files.replace_batch(events, f"{folder}/fulfilled", batch_id)
            failed, gone = retries.again(errors, as_of, policy, transient)
            retries.keep_waiting(
                waiting.unionByName(failed.select(kept.fieldNames())), folder, batch_id, kept
            )
            files.replace_batch(
                deadletter.dead_letters(
                    gone,
                    "fulfillment-service",
                    C.TOPIC_ORDER_PLACED,
                    as_of,
                    own_headers=headers.headers_of(F.col("metadata")),
                ),
                f"{folder}/dead_letters",
                batch_id,
            )
            aside = routed.where(F.col("outcome").isin("quarantine", "skipped"))
            files.replace_batch(
                aside.select("key", "value", "headers", "partition", "offset", "outcome"),
                f"{folder}/quarantine",
                batch_id,
            )
            if send:
                if not connect:
                    written = spark.read.parquet(files.batch_path(f"{folder}/fulfilled", batch_id))
                    send(messages.fulfilled_messages(written, as_of))
                send(
                    messages.letter_messages(
                        spark.read.parquet(files.batch_path(f"{folder}/dead_letters", batch_id))
                    )
                )
        finally:
            routed.unpersist()

    stream = retries.with_heartbeat(placed_messages)
    return files.start(stream, write, f"{folder}/offsets", interval)


def _sent(
    fulfilled: DataFrame, folder: str, batch_id: int, as_of: Column, connect: delivery.Connect
) -> DataFrame:
    """The fulfilled rows with their event and what became of its message, as a table."""
    spark, table, marks = fulfilled.sparkSession, f"{folder}/sent", f"{folder}/sent_marks"
    events = fulfilled.withColumn("_event", F.struct(*fulfillment.event_columns(as_of)))
    rows = events.withColumn(delivery.MESSAGE, messages.fulfilled_message(F.col("_event"), as_of))
    told = delivery.deliver(rows, connect, "order_short_code", ["partition", "offset"]).drop(
        delivery.MESSAGE
    )
    if not files.is_marked(spark, marks, batch_id):
        files.replace_batch(told, table, batch_id)
        files.mark(spark, marks, batch_id)
    return files.read_batch(spark, table, batch_id, told.schema)


def read_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """``key, outcome`` of every message, from the three tables."""

    def keys(name: str, key: str, outcome: Column) -> DataFrame:
        rows = spark.read.schema(f"{key} string, outcome string").parquet(f"{folder}/{name}")
        return rows.select(F.col(key).alias("key"), outcome.alias("outcome"))

    return (
        keys("fulfilled", "order_short_code", F.lit("fulfilled"))
        .unionByName(keys("dead_letters", "key", F.lit("dead_letter")))
        .unionByName(keys("quarantine", "key", F.col("outcome")))
    )


def change_schema(key_field: StructField) -> StructType:
    return StructType([key_field, StructField("old_status", StringType())])


def start_status_apply(
    fulfilled: DataFrame,
    order_store: Callable[[], DataFrame],
    key: str,
    folder: str,
    as_of: Column,
    event_order: list[str],
    status: str = "FULFILLED",
    unknown_order: str = "dead_letter",
    interval: str | None = None,
    send: Send | None = None,
    policy: RetryPolicy = RetryPolicy(max_attempts=1),
):
    """Each batch: first event per order, skip what is done, record changes, split unknowns.

    The order store is not rewritten; changes are appended, and ``current_orders`` merges
    them. Of the store and of earlier changes only the rows of this batch's orders are used.
    An event whose order is unknown waits for its next try, as it may have overtaken the
    order; after ``policy.max_attempts`` tries each such event is one dead letter, or one row
    of ``acknowledged`` with ``unknown_order="acknowledge"``. Events that do not decode (a
    null key) or have malformed metadata go to ``quarantine``.
    """
    changes_folder = f"{folder}/changes"

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = retries.without_heartbeat(batch)
        kept = retries.waiting_schema(rows.schema)
        tried, waiting = retries.with_due(rows, folder, batch_id, as_of)
        tried = tried.persist()
        try:
            bad = F.col(key).isNull()
            if "metadata" in rows.columns:
                bad = bad | (F.col("metadata.state") == "malformed")
            bad = F.coalesce(bad, F.lit(False))
            files.replace_batch(tried.where(bad), f"{folder}/quarantine", batch_id)
            good = tried.where(~bad)
            events = orders.first_per_key(good, key, event_order)
            # Once counted, the planner knows the size of the batch: a small one is broadcast
            # and the store and the earlier changes are scanned without a shuffle.
            tried.count()
            codes = events.select(key)
            schema = change_schema(rows.schema[key])
            fresh = events
            if batch_id > 0:
                earlier = files.read_batches(spark, changes_folder, schema, before=batch_id)
                done = earlier.select(key).join(codes, key, "left_semi")
                fresh = events.join(done, key, "left_anti")
            touched = order_store().join(codes, key, "left_semi")
            pending = touched.where(
                orders.rank(F.col("status")) < orders.rank(F.lit(status))
            ).select(key, F.col("status").alias("old_status"))
            files.replace_batch(
                fresh.select(key).join(pending, key).select(*schema.fieldNames()),
                changes_folder,
                batch_id,
            )
            missing, gone = retries.again(orders.unknown(good, touched, key), as_of, policy)
            retries.keep_waiting(
                waiting.unionByName(missing.select(kept.fieldNames())), folder, batch_id, kept
            )
            letters = unknown_letters(gone, key, as_of, rows.columns)
            if unknown_order == "dead_letter":
                files.replace_batch(letters, f"{folder}/dead_letters", batch_id)
                if send:
                    send(
                        messages.letter_messages(
                            files.read_batch(
                                spark, f"{folder}/dead_letters", batch_id, letters.schema
                            )
                        )
                    )
            else:
                files.replace_batch(
                    letters.select("key", "partition", "offset"), f"{folder}/acknowledged", batch_id
                )
        finally:
            tried.unpersist()

    return files.start(retries.with_heartbeat(fulfilled), write, f"{folder}/offsets", interval)


def unknown_letters(
    events: DataFrame, key: str, failed_at: Column, value_columns: list[str] | None = None
) -> DataFrame:
    """Fulfilled events without an order, as dead letters that can be replayed.

    The original value and the metadata headers (parsed, or the default ones) are kept where
    the events carry them; else the value is the event as JSON.
    """
    code = F.col(key).cast("string")
    own = F.to_json(F.struct(*(value_columns or events.columns)))
    rows = events.withColumns(
        {
            "value": F.col("value").cast("string") if "value" in events.columns else own,
            "key": code,
            "error_type": F.lit("UnknownOrder"),
            "error_message": F.concat(F.lit("no order has the code "), code),
        }
    )
    for name, kind in (("partition", "int"), ("offset", "bigint")):
        if name not in events.columns:
            rows = rows.withColumn(name, F.lit(None).cast(kind))
    metadata = headers.headers_of(F.col("metadata")) if "metadata" in events.columns else None
    return deadletter.dead_letters(
        rows, "order-service", C.TOPIC_ORDER_FULFILLED, failed_at, own_headers=metadata
    )


def read_changes(spark: SparkSession, folder: str, key_field: StructField) -> DataFrame:
    return files.read_batches(spark, f"{folder}/changes", change_schema(key_field))


def current_orders(
    order_store: DataFrame, changes: DataFrame, key: str, as_of: Column, status: str = "FULFILLED"
) -> DataFrame:
    """The order store with the recorded changes applied."""
    return orders.apply_status(order_store, changes, key, status, as_of)
