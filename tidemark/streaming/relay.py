"""The outbox relay: new and failed events are published, the outcome goes to a ledger."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from tidemark import config as C
from tidemark.operators import deadletter, outbox
from tidemark.schemas import ORDER_PLACED, OUTBOX_EVENTS
from tidemark.sources import files, messages
from tidemark.sources.topics import Send
from tidemark.streaming import delivery, retries

LEDGER = StructType(
    [
        *OUTBOX_EVENTS.fields,
        StructField("placed", ORDER_PLACED),
        StructField("exhausted", BooleanType()),
    ]
)
_OUTBOX_COLUMNS = OUTBOX_EVENTS.fieldNames()


def start_relay(
    outbox_rows: DataFrame,
    publish: Callable[[DataFrame], DataFrame] | None,
    folder: str,
    failed_at: Column,
    limit: int = outbox.POLICY.retry_limit,
    rounds: int = 1,
    interval: str | None = None,
    send: Send | None = None,
    connect: delivery.Connect | None = None,
):
    """One attempt per event and round; failed events go on in the next round or batch.

    A batch touches its new rows and the ones carried over, never the whole outbox.
    ``rounds=1`` suits a live query; ``limit + 1`` settles every event in its own batch. The
    setting may change at a restart: each batch notes its rounds, and the next one carries
    over what the last of them left. A heartbeat makes a batch per trigger (or per start,
    without an interval), so failed events are tried again while the outbox is quiet.
    With ``send`` messages and dead letters go to their topics too, after the ledger.

    With ``connect`` (in place of ``publish``) the tasks send the messages themselves and the
    ledger holds what the client said of each: PUBLISHED only where it took the message, else
    FAILED with its text. A round whose ledger is written is not sent again when the batch is
    run again; ``send`` then takes the dead letters only.
    """
    ledger, noted, sent = f"{folder}/ledger", f"{folder}/rounds", f"{folder}/sent"
    if connect:
        publish = delivery.publisher(connect)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        due = retries.without_heartbeat(batch).select(*_OUTBOX_COLUMNS)
        before = files.carried_row(spark, noted, batch_id)
        if before:
            due = due.unionByName(
                _to_retry(spark, ledger, batch_id - 1, before["rounds"] - 1, limit)
            )
        due = outbox.eligible(due, limit=limit)
        for turn in range(rounds):
            if not (connect and files.is_marked(spark, f"{sent}/round={turn}", batch_id)):
                tried = outbox.attempt(due, publish, limit).select(*LEDGER.fieldNames())
                files.replace_batch(tried, f"{ledger}/round={turn}", batch_id)
                if connect:
                    files.mark(spark, f"{sent}/round={turn}", batch_id)
            due = _to_retry(spark, ledger, batch_id, turn, limit)
        paths = [files.batch_path(f"{ledger}/round={turn}", batch_id) for turn in range(rounds)]
        done = spark.read.schema(LEDGER).parquet(*paths)
        published = messages.placed_messages(done.where(F.col("status") == "PUBLISHED"))
        files.replace_batch(published, f"{folder}/published", batch_id)
        letters = exhausted_letters(done, failed_at)
        files.replace_batch(letters, f"{folder}/dead_letters", batch_id)
        files.replace_batch(
            spark.range(1).select(F.lit(rounds).alias("rounds")), noted, batch_id
        )
        if send:
            # The written tables: nothing is computed or sampled a second time.
            if not connect:
                send(files.read_batch(spark, f"{folder}/published", batch_id, published.schema))
            send(
                messages.letter_messages(
                    files.read_batch(spark, f"{folder}/dead_letters", batch_id, letters.schema)
                )
            )

    return files.start(
        retries.with_heartbeat(outbox_rows), write, f"{folder}/offsets", interval
    )


def _to_retry(spark: SparkSession, ledger: str, batch_id: int, turn: int, limit: int) -> DataFrame:
    """What the last round of a batch left to do; earlier rounds passed theirs on to it."""
    rows = files.read_batch(spark, f"{ledger}/round={turn}", batch_id, LEDGER)
    failed = (F.col("status") == "FAILED") & (F.col("retry_count") < limit)
    return rows.where(failed).select(*_OUTBOX_COLUMNS)


def exhausted_letters(done: DataFrame, failed_at: Column) -> DataFrame:
    """Events that failed for good, as dead letters."""
    gone = done.where(F.col("exhausted")).select(
        F.col("entity_id").alias("key"),
        F.to_json("placed").alias("value"),
        F.lit(None).cast("int").alias("partition"),
        F.lit(None).cast("bigint").alias("offset"),
        F.lit("PublishError").alias("error_type"),
        F.col("last_error").alias("error_message"),
        outbox.event_headers().alias("_own"),
    )
    return deadletter.dead_letters(
        gone, "order-service", C.TOPIC_ORDER_PLACED, failed_at, own_headers=F.col("_own")
    )


def read_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Every attempt of finished batches, with ``batch_id`` and ``round``."""
    extra = StructType.fromDDL("batch_id bigint, round int")
    schema = StructType([*LEDGER.fields, *extra.fields])
    noted = spark.read.schema("rounds int, batch_id bigint").parquet(f"{folder}/rounds")
    # A batch that broke off may have left more rounds than its second run made.
    return (
        spark.read.schema(schema)
        .parquet(f"{folder}/ledger")
        .join(noted, "batch_id")
        .where(F.col("round") < F.col("rounds"))
        .drop("rounds")
    )


def final_states(ledger: DataFrame) -> DataFrame:
    """The last attempt of each event. An event has at most limit + 1 attempts."""
    return ledger.groupBy("id").agg(
        F.max("retry_count").alias("retry_count"),
        F.count("*").alias("attempts"),
        F.max_by("status", "retry_count").alias("status"),
        F.max_by("last_error", "retry_count").alias("last_error"),
    )
