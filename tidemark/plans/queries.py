"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers, ids, items, money, retry, times
from tidemark.functions.once import once
from tidemark.operators import (
    deadletter,
    fulfillment,
    ingest,
    metrics,
    ordered,
    orders,
    outbox,
    rules,
)
from tidemark.session import prepare, settle
from tidemark.sources import messages, store, tables, topics, wire

Query = Callable[[SparkSession, str], DataFrame]

# The clock of all queries, so that their results can be compared.
AS_OF = "2024-02-01T00:00:00Z"
KEY = "order_short_code"
FULFILLED_SCHEMA_ID = 42

QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    """Register under the function's name, with the session settings applied first."""

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return function(prepare(spark), folder)

    QUERIES[function.__name__] = run
    return run


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp")


def flag(condition: Column) -> Column:
    return condition.cast("int")


# --- metrics -----------------------------------------------------------------


def _purchases(spark: SparkSession, folder: str) -> DataFrame:
    return tables.purchases(tables.events(spark, folder))


def _records(frame: DataFrame) -> DataFrame:
    return metrics.metric_records(frame, as_of())


@query
def metrics_1m(spark, folder):
    return _records(metrics.windowed_metrics(_purchases(spark, folder), "1m"))


@query
def metrics_1h(spark, folder):
    return _records(metrics.windowed_metrics(_purchases(spark, folder), "1h"))


@query
def metrics_24h(spark, folder):
    return _records(metrics.windowed_metrics(_purchases(spark, folder), "24h"))


@query
def metrics_all_sizes(spark, folder):
    return _records(metrics.multi_size_metrics(_purchases(spark, folder)))


def _stored(spark: SparkSession, folder: str, size: str) -> DataFrame:
    return settle(metrics.windowed_metrics(_purchases(spark, folder), size))


@query
def metrics_zero_filled_1h(spark, folder):
    return _records(metrics.fill_empty_windows(_stored(spark, folder, "1h"), "1h"))


@query
def metrics_zero_filled_1m(spark, folder):
    return _records(metrics.fill_empty_windows(_stored(spark, folder, "1m"), "1m"))


@query
def metrics_per_customer_24h(spark, folder):
    per_customer = metrics.windowed_metrics(_purchases(spark, folder), "24h", by=["user_id"])
    return per_customer.select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "user_id",
        "order_count",
        money.hundredths_text(F.col("revenue_cents")).alias("total_revenue"),
    )


@query
def metrics_running_daily_reset(spark, folder):
    running = metrics.running_daily_totals(
        metrics.windowed_metrics(_purchases(spark, folder), "1h")
    )
    return running.select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "order_count",
        "revenue_cents",
        "day_order_count",
        "day_revenue_cents",
    )


@query
def metrics_gap_check(spark, folder):
    return metrics.metric_gaps(_stored(spark, folder, "1h"), "1h").select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        times.millis(F.col("next_start")).alias("next_start_ms"),
        "missing_windows",
    )


@query
def metrics_latest_version(spark, folder):
    """First version without the late events, then the recalculated one."""
    arrived = tables.arrivals(_purchases(spark, folder), "amount")
    tagged = ordered.tag_late(arrived, ["arrived_at", "event_id"])
    versions = metrics.union_sizes(
        metrics.windowed_metrics(tagged.where(~F.col("is_late")), "24h").withColumn(
            "processed_at", as_of()
        ),
        metrics.windowed_metrics(tagged, "24h").withColumn(
            "processed_at", as_of() + F.expr("interval 10 minutes")
        ),
    )
    latest = metrics.latest_metrics(versions)
    return latest.select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "order_count",
        "revenue_cents",
        times.millis(F.col("processed_at")).alias("processed_at_ms"),
        "versions",
    )


# --- counted snapshots and late events ---------------------------------------


def _orders_with_lines(spark: SparkSession, folder: str) -> DataFrame:
    return orders.lines_per_order(
        tables.placed_orders(spark, folder), tables.order_lines(spark, folder), KEY
    )


@query
def order_count_snapshot(spark, folder):
    snapshots = ordered.order_count_snapshot(
        _orders_with_lines(spark, folder), ["placed_at", KEY]
    )
    return ordered.snapshot_records(snapshots, as_of())


@query
def item_lines_per_order(spark, folder):
    return _orders_with_lines(spark, folder).select(KEY, "item_lines")


@query
def running_item_lines(spark, folder):
    """Orders and item lines so far, at every order."""
    running = ordered.running_totals(
        _orders_with_lines(spark, folder).select("placed_at", KEY, "item_lines"),
        ["placed_at", KEY],
        ["item_lines"],
    )
    return running.select(KEY, "n", "running_item_lines")


@query
def order_item_join(spark, folder):
    """Orders with their items; orders without items keep one row."""
    return orders.with_items(
        tables.placed_orders(spark, folder).select(KEY, "customer_id"),
        tables.order_lines(spark, folder),
        KEY,
    )


@query
def order_item_join_bucketed(spark, folder):
    """The same join of two stores laid out by the order's key: neither is shuffled."""
    placed = tables.placed_orders(spark, folder).select(KEY, "customer_id")
    return orders.with_items(
        store.bucketed(placed, KEY, "placed"),
        store.bucketed(tables.order_lines(spark, folder), KEY, "lines"),
        KEY,
    )


def _tagged(spark: SparkSession, folder: str) -> DataFrame:
    return ordered.tag_late(
        tables.arrivals(tables.events(spark, folder)), ["arrived_at", "event_id"]
    )


@query
def late_split(spark, folder):
    return _tagged(spark, folder).select("event_id", flag(F.col("is_late")).alias("is_late"))


@query
def late_counts(spark, folder):
    return ordered.late_counts(_tagged(spark, folder)).select(
        "window_size",
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "included",
        "late",
    )


# --- requests, ingest and rules ----------------------------------------------


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return tables.parsed_requests(tables.events(spark, folder))


def _checked(spark: SparkSession, folder: str) -> DataFrame:
    return rules.check(_parsed(spark, folder), ingest.request_rules())


@query
def order_request_parse(spark, folder):
    return ingest.item_lines(_parsed(spark, folder)).select(
        "request_id",
        "customer_id",
        "item_lines",
        flag(F.col("malformed")).alias("malformed"),
        flag(F.col("items").isNull()).alias("items_missing"),
    )


@query
def row_rules_quarantine(spark, folder):
    _, quarantined = rules.split(_checked(spark, folder))
    return quarantined.select(
        "request_id", F.array_join("violations", ",").alias("violations")
    )


@query
def order_contract_rules(spark, folder):
    """The stricter event contract: it also asks for at least one item."""
    checked = rules.check(
        _parsed(spark, folder).withColumn("code", ids.short_code(F.col("request_id"))),
        rules.order_contract("code", "customer_id", "items"),
    )
    return checked.groupBy(F.array_join("violations", ",").alias("violations")).agg(
        F.count("*").alias("rows")
    )


@query
def null_guard_counts(spark, folder):
    reason = F.when(F.col("malformed"), "malformed").when(F.col("items").isNull(), "no_items")
    return rules.guard_counts(_parsed(spark, folder), reason)


def _new_orders(spark: SparkSession, folder: str) -> DataFrame:
    return tables.new_orders(tables.events(spark, folder))


@query
def order_ingest_orders(spark, folder):
    return ingest.orders_table(_new_orders(spark, folder)).select(
        "order_id",
        "order_short_code",
        "customer_id",
        "status",
        times.millis(F.col("created_at")).alias("created_at_ms"),
        times.millis(F.col("updated_at")).alias("updated_at_ms"),
    )


@query
def order_items_exploded(spark, folder):
    return ingest.items_table(_new_orders(spark, folder))


def _outbox(spark: SparkSession, folder: str) -> DataFrame:
    return tables.fresh_outbox(tables.events(spark, folder))


@query
def order_payload_roundtrip(spark, folder):
    """The stored event with its payload text, and the fields read back from it."""
    return outbox.order_placed(_outbox(spark, folder)).select(
        "id",
        "entity_type",
        "entity_id",
        "event_type",
        "event_version",
        "payload",
        times.millis(F.col("occurred_at")).alias("occurred_at_ms"),
        "status",
        "retry_count",
        F.col("placed.customerId").alias("customer_id"),
        items.line_count(F.col("placed.items")).alias("item_lines"),
    )


@query
def order_placed_nested(spark, folder):
    """The event decoded from the payload, its items as text."""
    decoded = rules.guard(outbox.order_placed(_outbox(spark, folder)), "placed")
    lines = F.transform("placed.items", lambda i: F.concat_ws(":", i["productId"], i["count"]))
    return decoded.select(
        F.col("placed.orderShortCode").alias("order_short_code"),
        F.col("placed.customerId").alias("customer_id"),
        F.array_join(lines, "|").alias("items"),
    )


@query
def duplicate_order_lines(spark, folder):
    lines = tables.table(spark, folder, "lineitem")
    return rules.duplicate_keys(lines, ["l_orderkey", "l_linenumber"])


@query
def duplicate_short_codes(spark, folder):
    """Codes of new orders that are not unique."""
    return rules.duplicate_keys(_new_orders(spark, folder), [KEY])


@query
def order_items_after_delete(spark, folder):
    """Items left per order once the shipped orders are deleted."""
    kept = tables.stored_orders(spark, folder).where(F.col("status") != "SHIPPED")
    left = rules.surviving_children(tables.order_lines(spark, folder), kept, KEY)
    return left.groupBy(KEY).agg(F.count("*").alias("lines"), F.sum("count").alias("pieces"))


# --- headers and wire format -------------------------------------------------


def _messages(spark: SparkSession, folder: str) -> DataFrame:
    return tables.placed_messages(_outbox(spark, folder))


@query
def headers_encode(spark, folder):
    pairs = _outbox(spark, folder).select("id", F.posexplode(outbox.event_headers()))
    return pairs.select(
        "id",
        F.col("pos").alias("position"),
        F.col("col.key").alias("key"),
        F.decode("col.value", "UTF-8").alias("value"),
    )


@query
def headers_decode(spark, folder):
    texts = headers.metadata_texts(F.col("headers"))
    return once(_messages(spark, folder), "texts", texts).select("request_id", "texts.*")


@query
def metadata_default(spark, folder):
    decoded = headers.read_metadata(
        _messages(spark, folder), ids.stable_uuid("default", F.col("request_id")), as_of()
    )
    return decoded.select(
        "request_id",
        "metadata.event_id",
        "metadata.event_version",
        times.millis(F.col("metadata.occurred_at")).alias("occurred_at_ms"),
        "metadata.entity_type",
        "metadata.entity_id",
        "metadata.state",
    )


@query
def wire_frames(spark, folder):
    """Fulfilled events framed, and read back from the frame."""
    event = F.struct(
        F.col(KEY).cast("string").alias("orderShortCode"),
        F.col("customer_id").cast("string").alias("customerId"),
        times.millis(F.col("placed_at")).alias("fulfillmentTimestamp"),
    )
    framed = tables.placed_orders(spark, folder).select(
        KEY, wire.encode_json(event, FULFILLED_SCHEMA_ID).alias("value")
    )
    return wire.by_schema(framed).select(
        KEY,
        F.hex("value").alias("frame_hex"),
        "schema_id",
        F.decode(wire.payload(F.col("value")), "UTF-8").alias("payload"),
    )


@query
def topic_messages(spark, folder):
    """Keyed messages as the topic sink takes them."""
    decoded = rules.guard(outbox.order_placed(_outbox(spark, folder)), "placed")
    frame = topics.messages(
        decoded,
        C.TOPIC_ORDER_PLACED,
        value=F.to_json("placed"),
        key=F.col("placed.orderShortCode"),
        headers=outbox.event_headers(),
    )
    return frame.select(
        "topic",
        "key",
        "value",
        F.array_join(F.transform("headers", lambda h: h["key"]), ",").alias("header_keys"),
        headers.first_value(F.col("headers"), C.HEADER_ENTITY_ID).alias("entity_id"),
    )


@query
def message_disposition(spark, folder):
    """Placed messages by what becomes of them; the counts add up to all messages."""
    decoded = messages.decode_placed(_messages(spark, folder), as_of())
    return decoded.groupBy(messages.disposition().alias("disposition")).agg(
        F.count("*").alias("messages")
    )


@query
def metrics_from_messages(spark, folder):
    """Orders and item lines per hour; the time comes from the header, not from the value."""
    placed = messages.placed_events(_messages(spark, folder), as_of())
    on_time = placed.where(F.col("metadata.state") == "ok")
    hours = metrics.windowed_metrics(on_time, "1h", amount="item_lines")
    return hours.select(
        times.millis(F.col("window_start")).alias("window_start_ms"),
        "order_count",
        money.whole_div(F.col("revenue_cents"), F.lit(100)).alias("item_lines"),
    )


# --- outbox ------------------------------------------------------------------


def _used_outbox(spark: SparkSession, folder: str) -> DataFrame:
    return tables.used_outbox(tables.events(spark, folder))


@query
def outbox_eligible(spark, folder):
    return outbox.eligible(_used_outbox(spark, folder)).select("id", "status", "retry_count")


def _claimed_ids(events: DataFrame) -> DataFrame:
    return outbox.oldest(outbox.eligible(events)).select("id")


@query
def outbox_eligible_topk(spark, folder):
    oldest = outbox.oldest(outbox.eligible(_used_outbox(spark, folder)))
    named = outbox.model_names(oldest)
    return named.select(
        "Id",
        "EntityName",
        "EntityId",
        "EventType",
        "EventVersion",
        "Payload",
        times.millis(F.col("OccurredAt")).alias("OccurredAtMs"),
        "Status",
        "RetryCount",
        "LastError",
    )


@query
def outbox_claim(spark, folder):
    events = _used_outbox(spark, folder)
    return outbox.claim(events, _claimed_ids(events)).select("id", "status", "retry_count")


def _processing(events: DataFrame, fails: bool) -> DataFrame:
    """Claimed events; publishing fails for every fifth request."""
    broken = F.col("request_id") % 5 == 0
    return events.where((F.col("status") == "PROCESSING") & (broken if fails else ~broken))


@query
def outbox_mark_published(spark, folder):
    events = _used_outbox(spark, folder)
    return outbox.mark_published(events, _processing(events, fails=False)).select(
        "id", "status", flag(F.col("published_at").isNull()).alias("never_stamped")
    )


@query
def outbox_mark_repeated_ids(spark, folder):
    """The same ids and errors given several times: every outbox row still comes once."""
    events = _used_outbox(spark, folder)
    done = _processing(events, fails=False).select("id")
    errors = _processing(events, fails=True).select(
        "id", F.explode(F.array(F.lit("a first error"), F.lit("the last error"))).alias("error")
    )
    marked = outbox.mark_failed(outbox.mark_published(events, done.union(done)), errors)
    return marked.select("id", "status", "last_error")


@query
def outbox_mark_failed(spark, folder):
    events = _used_outbox(spark, folder)
    errors = _processing(events, fails=True).select(
        "id", F.concat(F.lit("timed out: "), "entity_id").alias("error")
    )
    return outbox.mark_failed(events, errors).select("id", "status", "last_error")


@query
def outbox_by_entity(spark, folder):
    stored = ingest.orders_table(_new_orders(spark, folder))
    return outbox.of_entity(stored, _used_outbox(spark, folder)).select(
        "order_id", KEY, "event_id", "event_type", "event_status"
    )


@query
def outbox_stuck(spark, folder):
    return outbox.stuck(_used_outbox(spark, folder), as_of(), "10 days").select(
        "id", times.millis(F.col("occurred_at")).alias("occurred_at_ms")
    )


@query
def outbox_attempt(spark, folder):
    """One attempt for every eligible event."""
    tried = outbox.attempt(outbox.eligible(_used_outbox(spark, folder)), flaky_publish)
    return tried.select(
        "id", "status", "retry_count", "last_error", flag(F.col("exhausted")).alias("exhausted")
    )


def flaky_publish(events: DataFrame) -> DataFrame:
    """Publishing that fails a number of times set by a digest of the event id."""
    number = F.conv(F.substring(F.md5("id"), 1, 4), 16, 10).cast("int")
    failures = F.when(number % 5 == 0, money.whole_div(number, F.lit(5)) % 5).otherwise(0)
    return events.withColumn(
        "error", F.when(F.col("retry_count") < failures, F.lit("Local_Transport"))
    )


@query
def publish_outcomes(spark, folder):
    tried = outbox.attempt(outbox.eligible(_used_outbox(spark, folder)), flaky_publish)
    hour = money.whole_div(times.millis(F.col("occurred_at")), F.lit(3_600_000))
    return outbox.outcome_counts(tried.withColumn("batch_id", hour), ["batch_id"])


@query
def backoff_schedule(spark, folder):
    attempt = F.col("k") % 9 + 1
    return tables.events(spark, folder).select(
        "event_id",
        attempt.alias("attempt"),
        retry.backoff_ms(attempt).alias("delay_ms"),
        times.millis(retry.next_attempt_at(F.col("event_time"), attempt)).alias("next_attempt_ms"),
    )


@query
def transient_errors(spark, folder):
    codes = F.array(*[F.lit(c) for c in (*C.TRANSIENT_ERROR_CODES, "MsgSizeTooLarge", "Local_Fatal")])
    tagged = tables.events(spark, folder).select(
        F.element_at(codes, F.col("k") % 5 + 1).alias("code"),
        (F.col("event_type") == "error").alias("fatal"),
    )
    transient = retry.is_transient(F.col("code"), F.col("fatal"))
    return tagged.groupBy(
        "code", flag(F.col("fatal")).alias("fatal"), flag(transient).alias("transient")
    ).agg(F.count("*").alias("errors"))


# --- fulfillment and order status --------------------------------------------


@query
def fulfilled_projection(spark, folder):
    placed = tables.placed_orders(spark, folder).withColumn(
        "event_id", ids.stable_uuid("placed", F.col(KEY))
    )
    return fulfillment.fulfilled_events(placed, as_of())


def refuse_empty(placed: DataFrame) -> DataFrame:
    """A processing step that cannot handle an order without items."""
    empty = F.size("items") == 0
    return placed.withColumns(
        {
            "error_type": F.when(empty, F.lit("EmptyOrder")),
            "error_message": F.when(
                empty, F.concat(F.lit("order has no items: "), F.col(KEY))
            ),
        }
    )


def _processed(spark: SparkSession, folder: str) -> DataFrame:
    placed = _new_orders(spark, folder).withColumns(
        tables.source_position(F.col("request_id"))
    )
    return fulfillment.process(placed, refuse_empty)


@query
def fulfillment_outcomes(spark, folder):
    return _processed(spark, folder).select(
        KEY, "outcome", "error_type", "error_message"
    )


@query
def status_exists(spark, folder):
    """Fulfilled events whose order is FULFILLED already."""
    return orders.having_status(
        tables.fulfilled(spark, folder), tables.stored_orders(spark, folder), KEY, "FULFILLED"
    ).select(KEY, times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"), "part", "line")


@query
def unknown_orders(spark, folder):
    return orders.unknown(
        tables.fulfilled(spark, folder), tables.stored_orders(spark, folder), KEY
    ).select(KEY, times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"), "part", "line")


EVENT_ORDER = ["fulfilled_at", "part", "supplier", "line"]


@query
def fulfilled_dedupe(spark, folder):
    """The first event of every order that is not FULFILLED yet."""
    first = orders.first_per_key(tables.fulfilled(spark, folder), KEY, EVENT_ORDER)
    fresh = orders.without_status(first, tables.stored_orders(spark, folder), KEY, "FULFILLED")
    return fresh.select(KEY, times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"))


def _applied(
    spark: SparkSession, folder: str, guard_regression: bool, stored: DataFrame | None = None
) -> DataFrame:
    done = tables.fulfilled(spark, folder)
    known = tables.stored_orders(spark, folder) if stored is None else stored
    return orders.apply_status(
        known, done, KEY, "FULFILLED", as_of(), guard_regression
    ).select(KEY, "status", times.millis(F.col("updated_at")).alias("updated_at_ms"))


@query
def status_apply(spark, folder):
    return _applied(spark, folder, guard_regression=True)


@query
def status_apply_unguarded(spark, folder):
    return _applied(spark, folder, guard_regression=False)


@query
def status_apply_bucketed(spark, folder):
    """The update on a store laid out by code: only the events are shuffled."""
    stored = store.bucketed(tables.stored_orders(spark, folder), KEY, "orders")
    return _applied(spark, folder, guard_regression=True, stored=stored)


@query
def furthest_status(spark, folder):
    """Stored status and fulfilled events of an order folded into one status."""
    stored = tables.stored_orders(spark, folder).select(KEY, "status")
    done = tables.fulfilled(spark, folder).select(KEY, F.lit("FULFILLED").alias("status"))
    return orders.furthest_status(stored.unionByName(done), KEY)


@query
def dead_letters_merged(spark, folder):
    failed = _processed(spark, folder).where(F.col("outcome") == "dead_letter")
    placed = deadletter.dead_letters(
        failed.withColumn("value", F.to_json(F.struct(KEY, "customer_id", "items"))),
        "fulfillment-service",
        C.TOPIC_ORDER_PLACED,
        as_of(),
        key=KEY,
    )
    missing = orders.unknown(
        tables.fulfilled(spark, folder), tables.stored_orders(spark, folder), KEY
    )
    unknown = deadletter.dead_letters(
        missing.withColumns(
            {
                **tables.source_position(-F.col(KEY)),
                "value": F.to_json(F.struct(KEY, "part", "line")),
                "error_type": F.lit("UnknownOrder"),
                "error_message": F.concat(F.lit("no order has the code "), F.col(KEY)),
            }
        ),
        "order-service",
        C.TOPIC_ORDER_FULFILLED,
        as_of(),
        key=KEY,
    )
    merged = deadletter.merge(placed, unknown)
    header = F.col("headers")
    return merged.select(
        "service",
        "topic",
        "key",
        "original_topic",
        "partition",
        "offset",
        "error_type",
        "error_message",
        headers.original_topic(header).alias("header_topic"),
        headers.failure_timestamp(header).alias("header_failed_at"),
        F.array_join(F.transform(header, lambda h: h["key"]), ",").alias("header_keys"),
    )


@query
def dead_letters_replayed(spark, folder):
    """Refused placed messages as letters, and the letters decoded back to events."""
    decoded = messages.decode_placed(_messages(spark, folder), as_of())
    readable = F.col("placed").isNotNull() & (F.col("metadata.state") != "malformed")
    refused = refuse_empty(decoded.where(readable)).where(F.col("error_type").isNotNull())
    letters = deadletter.dead_letters(
        refused,
        "fulfillment-service",
        C.TOPIC_ORDER_PLACED,
        as_of(),
        own_headers=headers.headers_of(F.col("metadata")),
    )
    again = messages.decode_placed(letters.drop("order_short_code"), as_of())
    return again.select(
        "key",
        F.col("placed.orderShortCode").alias("order_short_code"),
        F.col("placed.customerId").alias("customer_id"),
        F.size("placed.items").cast("bigint").alias("items"),
        F.col("metadata.state").alias("state"),
        F.array_join(F.transform("headers", lambda h: h["key"]), ",").alias("header_keys"),
    )


@query
def placed_fulfilled_join(spark, folder):
    return fulfillment.placed_fulfilled(
        tables.placed_orders(spark, folder), tables.fulfilled(spark, folder), KEY, unique=True
    ).select(
        KEY,
        times.millis(F.col("placed_at")).alias("placed_at_ms"),
        times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"),
    )


def _by_customer(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Orders under the customer as code, which many orders share, and their fulfillments."""
    code = F.col("customer_id").alias(KEY)
    placed = tables.placed_orders(spark, folder)
    lines = tables.fulfilled(spark, folder).select(KEY, "fulfilled_at")
    owners = placed.select(F.col(KEY).alias("_order"), code)
    done = lines.withColumnRenamed(KEY, "_order").join(owners, "_order").drop("_order")
    return placed.select(code, "placed_at"), done


@query
def placed_fulfilled_repeated_codes(spark, folder):
    """A code that many orders share: each order gets the first fulfillment after it."""
    placed, done = _by_customer(spark, folder)
    return fulfillment.placed_fulfilled(placed, done, KEY).select(
        KEY,
        times.millis(F.col("placed_at")).alias("placed_at_ms"),
        times.millis(F.col("fulfilled_at")).alias("fulfilled_at_ms"),
    )


@query
def fulfillment_metrics_repeated_codes(spark, folder):
    placed, done = _by_customer(spark, folder)
    return fulfillment.fulfillment_metrics(placed, done, KEY).withColumn(
        "window_start", times.millis(F.col("window_start"))
    ).withColumnRenamed("window_start", "window_start_ms")


@query
def fulfillment_metrics_24h(spark, folder):
    return fulfillment.fulfillment_metrics(
        tables.placed_orders(spark, folder), tables.fulfilled(spark, folder), KEY, unique=True
    ).withColumn("window_start", times.millis(F.col("window_start"))).withColumnRenamed(
        "window_start", "window_start_ms"
    )


@query
def delivery_quality(spark, folder):
    return fulfillment.delivery_quality(
        tables.placed_orders(spark, folder), tables.fulfilled(spark, folder), KEY
    )
