"""The live queries, drained once over the given tables and read back from their sinks."""

from __future__ import annotations

import hashlib

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.config import RetryPolicy
from tidemark.functions import money, retry, times
from tidemark.operators import metrics, ordered
from tidemark.plans.queries import EVENT_ORDER, KEY, as_of, flag, flaky_publish, query, refuse_empty
from tidemark.session import new_folder, settle
from tidemark.sources import files, tables
from tidemark.streaming import (
    corrections,
    delivery,
    fulfillment,
    ingest,
    join,
    keyed_status,
    late,
    relay,
    snapshot,
    totals,
)
from tidemark.streaming import metrics as live

SHARDS = 64  # counters of the sharded snapshot; rows are dealt out by event id


BATCHES = 3


def _thirds(rows: DataFrame, order: Column) -> list[DataFrame]:
    """The rows cut by ``order`` in three; rows without it are in the first part."""
    cuts = [i / BATCHES for i in range(1, BATCHES)]
    place = order.cast("double")
    low, high = rows.agg(F.percentile_approx(place, F.lit(cuts))).first()[0]
    first = F.coalesce(place <= low, F.lit(True))
    return [rows.where(part) for part in (first, (place > low) & (place <= high), place > high)]


def _in_batches(spark: SparkSession, rows: DataFrame, order: Column, name: str) -> DataFrame:
    """The rows as a stream of micro-batches in ``order``: each third as as many files."""
    out = new_folder(spark, name)
    each = spark.sparkContext.defaultParallelism
    for part in _thirds(rows, order):
        part.repartition(each).write.mode("append").parquet(out)
    return files.stream_files(spark, out, rows.schema, files_per_batch=each)


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return tables.with_instants(tables.stream(spark, folder, "events"))


@query
def windowed_metrics_stream(spark, folder):
    """Closed windows of all sizes, empty ones included."""
    out = new_folder(spark, "metrics")
    files.finish(*live.start_all_sizes(tables.purchases(_event_stream(spark, folder)), out))
    return metrics.metric_records(live.read_metrics(spark, out), as_of())


@query
def order_count_snapshot_stream(spark, folder):
    out = new_folder(spark, "snapshot")
    placed = tables.purchases(_event_stream(spark, folder)).select(
        "event_time", "event_id", (F.col("k") % 3 + 1).alias("item_lines")
    )
    files.finish(snapshot.start_snapshot(placed, ["event_time", "event_id"], out))
    return ordered.snapshot_records(snapshot.read_snapshots(spark, out), as_of())


@query
def order_ingest_stream(spark, folder):
    """Every request: the order it became with its item and event rows, or why it did not."""
    out = new_folder(spark, "ingest")
    requests = tables.requests(_event_stream(spark, folder)).drop("partition", "offset")
    files.finish(ingest.start_ingest(requests, "request_id", "received_at", out))
    rows = ingest.read_tables(spark, out, requests.schema["request_id"])
    lines = rows["order_items"].groupBy("order_id").agg(F.count("*").alias("items"))
    events = rows["outbox_events"].groupBy("entity_id").agg(F.count("*").alias("events"))
    stored = (
        rows["orders"]
        .join(lines, "order_id", "left")
        .join(events.withColumnRenamed("entity_id", KEY), KEY, "left")
        .select(
            "request_id",
            KEY,
            F.coalesce("items", F.lit(0)).cast("bigint").alias("items"),
            F.coalesce("events", F.lit(0)).cast("bigint").alias("events"),
            F.lit("").alias("violations"),
        )
    )
    refused = rows["quarantine"].select(
        "request_id",
        F.lit(None).cast("string").alias(KEY),
        F.lit(0).cast("bigint").alias("items"),
        F.lit(0).cast("bigint").alias("events"),
        F.array_join("violations", ",").alias("violations"),
    )
    return stored.unionByName(refused)


@query
def sharded_snapshot_stream(spark, folder):
    """Counts per shard and the item lines so far, of the rows the watermark has passed."""
    out = new_folder(spark, "shards")
    placed = tables.purchases(_event_stream(spark, folder)).select(
        "event_time",
        "event_id",
        (F.col("event_id") % SHARDS).alias("shard"),
        (F.col("k") % 3 + 1).alias("item_lines"),
    )
    files.finish(snapshot.start_ordered_shards(placed, "shard", out))
    return snapshot.read_shards(spark, out)


@query
def late_split_stream(spark, folder):
    out = new_folder(spark, "late")
    arrived = tables.arrivals(_event_stream(spark, folder))
    files.finish(late.start_late_split(arrived, ["arrived_at", "event_id"], out))
    return late.read_split(spark, out).select("event_id", flag(F.col("is_late")).alias("is_late"))


@query
def outbox_relay_stream(spark, folder):
    """Every event to its last state: published, or failed for good."""
    out = new_folder(spark, "relay")
    rows = tables.used_outbox(_event_stream(spark, folder))
    limit = relay.outbox.POLICY.retry_limit
    files.finish(relay.start_relay(rows, flaky_publish, out, as_of(), limit, rounds=limit + 1))
    return relay.final_states(relay.read_ledger(spark, out))


@query
def fulfillment_stream(spark, folder):
    """What became of every placed message."""
    out = new_folder(spark, "fulfillment")
    messages = tables.placed_messages(tables.fresh_outbox(_event_stream(spark, folder)))
    files.finish(fulfillment.start_fulfillment(messages, out, as_of(), refuse_empty))
    return fulfillment.read_outcomes(spark, out)


def _event_batches(spark: SparkSession, folder: str, order: Column) -> DataFrame:
    raw = tables.table(spark, folder, "events")
    return tables.with_instants(_in_batches(spark, raw, order, "events"))


def _micros(name: str) -> Column:
    return F.unix_micros(F.col(name).cast("timestamp"))


@query
def windowed_metrics_batches_stream(spark, folder):
    """The same windows from several micro-batches: state and watermark go from one to the next."""
    out = new_folder(spark, "metrics")
    orders_in = lambda: tables.purchases(_event_batches(spark, folder, _micros("ts")))
    for size in ("1m", "1h", "24h"):
        files.finish(live.start_metrics(orders_in(), size, out))
    return metrics.metric_records(live.read_metrics(spark, out), as_of())


@query
def customer_windows_stream(spark, folder):
    """Closed days per customer, from three batches."""
    out = new_folder(spark, "customers")
    orders = tables.purchases(_event_batches(spark, folder, _micros("ts")))
    files.finish(totals.start_keyed_metrics(orders, "24h", ["user_id"], out))
    keys = orders.select("user_id").schema
    return totals.read_keyed_metrics(spark, out, keys).select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "user_id",
        "order_count",
        money.hundredths_text(F.col("revenue_cents")).alias("total_revenue"),
    )


@query
def running_totals_stream(spark, folder):
    """Closed hours with the totals so far on their day, from three batches."""
    out = new_folder(spark, "totals")
    orders = tables.purchases(_event_batches(spark, folder, _micros("ts")))
    files.finish(totals.start_running_totals(orders, "1h", out))
    return totals.read_running_totals(spark, out).select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "order_count",
        "revenue_cents",
        "day_order_count",
        "day_revenue_cents",
    )


@query
def order_count_snapshot_batches_stream(spark, folder):
    out = new_folder(spark, "snapshot")
    placed = tables.purchases(_event_batches(spark, folder, _micros("ts"))).select(
        "event_time", "event_id", (F.col("k") % 3 + 1).alias("item_lines")
    )
    files.finish(snapshot.start_snapshot(placed, ["event_time", "event_id"], out))
    return ordered.snapshot_records(snapshot.read_snapshots(spark, out), as_of())


@query
def late_split_batches_stream(spark, folder):
    """Batches in order of arrival: what was seen so far comes from the batch before."""
    out = new_folder(spark, "late")
    delay = F.when(F.col("event_id") % 7 == 0, 600_000_000).otherwise(0)
    arrived = tables.arrivals(_event_batches(spark, folder, _micros("ts") + delay))
    files.finish(late.start_late_split(arrived, ["arrived_at", "event_id"], out))
    return late.read_split(spark, out).select("event_id", flag(F.col("is_late")).alias("is_late"))


@query
def status_apply_batches_stream(spark, folder):
    """Repeats of an order fall into different micro-batches; only the first one counts."""
    out = new_folder(spark, "status")
    lines = tables.table(spark, folder, "lineitem")
    events = tables.fulfilled_of(
        _in_batches(spark, lines, _micros("l_shipdate"), "lines")
    )
    store = lambda: tables.stored_orders(spark, folder)
    files.finish(
        fulfillment.start_status_apply(events, store, KEY, out, as_of(), EVENT_ORDER)
    )
    changes = fulfillment.read_changes(spark, out, events.schema[KEY])
    pairs = changes.groupBy(KEY).agg(F.count("*").alias("changes"))
    return pairs.withColumn("changes", F.col("changes").cast("bigint"))


def _later(hours: int):
    return as_of() + F.make_dt_interval(hours=F.lit(hours))


@query
def relay_quiet_stream(spark, folder):
    """One attempt per start, and no new rows after the first: failed events still come up."""
    out = new_folder(spark, "relay-quiet")
    limit = relay.outbox.POLICY.retry_limit
    for _ in range(limit + 1):
        rows = tables.used_outbox(_event_stream(spark, folder))
        files.finish(relay.start_relay(rows, flaky_publish, out, as_of(), limit))
    return relay.final_states(relay.read_ledger(spark, out))


def fail_some(placed: DataFrame) -> DataFrame:
    """Processing that fails the first 0 to 4 times, by the place of the message."""
    number = (F.col("offset") * tables.SOURCE_PARTITIONS + F.col("partition")) % 5
    failed = F.col("attempt") <= number
    return placed.withColumns(
        {
            "error_type": F.when(failed, F.lit("Busy")),
            "error_message": F.when(failed, F.lit("try again")),
        }
    )


@query
def fulfillment_retry_stream(spark, folder):
    """Each message is tried up to three times, one start apart."""
    out = new_folder(spark, "fulfillment-retry")
    policy = RetryPolicy()
    for turn in range(policy.max_attempts):
        messages = tables.placed_messages(tables.fresh_outbox(_event_stream(spark, folder)))
        files.finish(
            fulfillment.start_fulfillment(
                messages, out, _later(turn), fail_some, policy=policy
            )
        )
    return fulfillment.read_outcomes(spark, out)


@query
def status_retry_stream(spark, folder):
    """Letters per code: one for each event whose order did not turn up in three tries."""
    out = new_folder(spark, "status-retry")
    policy = RetryPolicy()
    for turn in range(policy.max_attempts):
        events = tables.fulfilled_of(tables.stream(spark, folder, "lineitem"))
        store = lambda: tables.stored_orders(spark, folder)
        files.finish(
            fulfillment.start_status_apply(
                events, store, KEY, out, _later(turn), EVENT_ORDER, policy=policy
            )
        )
    letters = spark.read.schema("key string").parquet(f"{out}/dead_letters")
    return letters.groupBy("key").agg(F.count("*").alias("letters"))


@query
def status_apply_stream(spark, folder):
    out = new_folder(spark, "status")
    events = tables.fulfilled_of(tables.stream(spark, folder, "lineitem"))
    files.finish(
        fulfillment.start_status_apply(
            events,
            lambda: tables.stored_orders(spark, folder),
            KEY,
            out,
            as_of(),
            EVENT_ORDER,
        )
    )
    changes = fulfillment.read_changes(spark, out, events.schema[KEY])
    return fulfillment.current_orders(
        tables.stored_orders(spark, folder), changes, KEY, as_of()
    ).select(KEY, "status", times.millis(F.col("updated_at")).alias("updated_at_ms"))


def _pairs(all_events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Purchases as placed orders, four in five of them fulfilled after ``k`` minutes."""
    placed = tables.purchases(all_events).select(
        F.col("event_id").alias(KEY), F.col("event_time").alias("placed_at")
    )
    fulfilled = (
        tables.purchases(all_events)
        .where(F.col("k") < 80)
        .select(
            F.col("event_id").alias(KEY),
            (F.col("event_time") + F.make_dt_interval(mins=F.col("k"))).alias("fulfilled_at"),
        )
    )
    return placed, fulfilled


def _joined(spark: SparkSession, folder: str) -> DataFrame:
    placed, _ = _pairs(_event_stream(spark, folder))
    _, fulfilled = _pairs(_event_stream(spark, folder))
    return join.placed_fulfilled_stream(
        placed, fulfilled, KEY, placed_delay="2 hours", fulfilled_delay="2 hours"
    )


@query
def placed_fulfilled_stream_join(spark, folder):
    """Orders fulfilled within the hour. Orders that ran out of time are in the sink too,
    with a null; those still open when the stream was drained are not."""
    out = new_folder(spark, "join")
    joined = _joined(spark, folder)
    files.finish(join.start_join(joined, out))
    done = join.read_joined(spark, out, joined.schema)
    return done.where(F.col("fulfilled_at").isNotNull()).select(
        KEY,
        times.millis(F.col("placed_at")).alias("placed_at_ms"),
        times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"),
    )


@query
def fulfillment_metrics_stream(spark, folder):
    """Hours whose orders all had their hour to be fulfilled."""
    out = new_folder(spark, "fulfillment-metrics")
    counts = join.fulfillment_metrics_stream(_joined(spark, folder))
    files.finish(join.start_join(counts, out))
    rates = join.with_rates(join.read_joined(spark, out, counts.schema))
    return rates.withColumn("window_start", times.millis(F.col("window_start"))).withColumnRenamed(
        "window_start", "window_start_ms"
    )


class RefusingClient:
    """Refuses three in sixteen events, each with its own text, whatever the try."""

    def send(self, message):
        headers = {pair["key"]: pair["value"] for pair in message["headers"]}
        event_id = headers[C.HEADER_EVENT_ID].decode()
        if hashlib.md5(event_id.encode()).hexdigest()[0] in "012":
            raise delivery.Refused(f"refused {event_id}", "MsgSizeTooLarge")

    def close(self):
        pass


@query
def relay_delivery_stream(spark, folder):
    """Sent by the tasks: PUBLISHED is what the client took, FAILED keeps the client's text."""
    out = new_folder(spark, "relay-delivery")
    rows = tables.used_outbox(_event_stream(spark, folder))
    limit = relay.outbox.POLICY.retry_limit
    files.finish(
        relay.start_relay(
            rows, None, out, as_of(), limit, rounds=limit + 1, connect=RefusingClient
        )
    )
    return relay.final_states(relay.read_ledger(spark, out))


@query
def relay_restart_stream(spark, folder):
    """The topic breaks off after the first ledger; the second start ends what was begun."""
    out = new_folder(spark, "relay-restart")
    limit = relay.outbox.POLICY.retry_limit

    def away(frame):
        raise ConnectionError("the topic is away")

    for send in (away, None):
        rows = tables.used_outbox(_event_stream(spark, folder))
        started = relay.start_relay(
            rows, flaky_publish, out, as_of(), limit, rounds=limit + 1, send=send
        )
        try:
            files.finish(started)
        except StreamingQueryException as error:
            if "the topic is away" not in str(error):
                raise
    return relay.final_states(relay.read_ledger(spark, out))


class TakingClient:
    """Takes everything."""

    def send(self, message):
        pass

    def close(self):
        pass


@query
def delivery_key_order(spark, folder):
    """Messages per key, and how many went out before an earlier one of their key."""
    orders = tables.new_orders(tables.events(spark, folder))
    rows = orders.select(
        F.col("customer_id").alias("key"),
        "created_at",
        "request_id",
        F.struct(F.col("customer_id").alias("key"), F.col("request_id").alias("value")).alias(
            delivery.MESSAGE
        ),
    )
    # Read from its table: each action on a delivery would send again.
    sent = settle(delivery.deliver(rows, TakingClient, "key", ["created_at", "request_id"]))
    before = Window.partitionBy("key").orderBy("created_at", "request_id")
    swapped = (F.lag("task").over(before) != F.col("task")) | (
        F.lag("place").over(before) > F.col("place")
    )
    return (
        sent.withColumn("swapped", F.coalesce(swapped, F.lit(False)))
        .groupBy("key")
        .agg(F.count("*").alias("messages"), F.count_if("swapped").alias("swapped"))
    )


class UnsteadyClient:
    """Takes four in five messages; of the rest half fail in passing, half for good."""

    def send(self, message):
        digit = int(hashlib.md5(message["key"].encode()).hexdigest()[:4], 16) % 10
        if digit < 2:
            code = "Local_Transport" if digit == 0 else "MsgSizeTooLarge"
            raise delivery.Refused(f"refused {message['key']}", code)

    def close(self):
        pass


@query
def fulfillment_delivery_stream(spark, folder):
    """Only errors in passing are tried again: three tries for these, one for the others."""
    out = new_folder(spark, "fulfillment-delivery")
    policy = RetryPolicy()
    for turn in range(policy.max_attempts):
        messages = tables.placed_messages(tables.fresh_outbox(_event_stream(spark, folder)))
        files.finish(
            fulfillment.start_fulfillment(
                messages,
                out,
                _later(turn),
                policy=policy,
                transient=retry.is_transient(F.col("error_type"), F.col("fatal")),
                connect=UnsteadyClient,
            )
        )
    tries = spark.read.schema("order_short_code string, error_code string, attempt int").parquet(
        f"{out}/sent"
    )
    done = fulfillment.read_outcomes(spark, out)
    sent = tries.groupBy(F.col("order_short_code").alias("key")).agg(
        F.count("*").alias("tries"), F.max("error_code").alias("code")
    )
    return done.join(sent, "key", "left").select(
        "key", "outcome", F.coalesce("tries", F.lit(0)).cast("bigint").alias("tries"), "code"
    )


@query
def status_keyed_stream(spark, folder):
    """Three starts, one third of the lines each: state carries what earlier batches did."""
    out, landing = new_folder(spark, "status-keyed"), new_folder(spark, "lines")
    lines = tables.table(spark, folder, "lineitem")
    for part in _thirds(lines, _micros("l_shipdate")):
        part.write.mode("append").parquet(landing)
        events = tables.fulfilled_of(files.stream_files(spark, landing, lines.schema))
        outcomes = keyed_status.status_outcomes(
            events, tables.stored_orders(spark, folder), KEY, EVENT_ORDER
        )
        files.finish(keyed_status.start_keyed_status(outcomes, out))
    done = keyed_status.read_outcomes(spark, out, outcomes.schema)
    return done.groupBy(KEY, "outcome").agg(F.count("*").alias("n"))


@query
def corrected_metrics_stream(spark, folder):
    """Every seventh event comes ten minutes late and corrects its windows; then the input
    stops, and a heartbeat closes what is open, empty windows included."""
    out = new_folder(spark, "corrected")
    delay = F.when(F.col("event_id") % 7 == 0, 600_000_000).otherwise(0)
    orders_in = tables.purchases(_event_batches(spark, folder, _micros("ts") + delay))
    for size in ("1m", "1h", "24h"):
        for clock in (None, as_of()):  # the second start finds no new rows
            files.finish(
                corrections.start_corrected_metrics(orders_in, size, out, now=clock)
            )
    return metrics.metric_records(corrections.read_latest(spark, out), as_of())
