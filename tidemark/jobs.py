"""The services as live queries over topics: what to start, with which settings.

``messages`` frames come from ``topics.read_topic`` or from files of the same shape.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.config import OutboxPolicy, RetryPolicy, StreamPolicy, WINDOW_SIZES
from tidemark.functions import retry
from tidemark.operators import fulfillment as steps
from tidemark.sources import files
from tidemark.sources import messages as M
from tidemark.sources.topics import Send
from tidemark.streaming import corrections, delivery, fulfillment, relay, snapshot


def order_metrics(
    messages: DataFrame,
    folder: str,
    sizes: Sequence[str] = tuple(WINDOW_SIZES),
    amount: str = "item_lines",
    interval: str | None = StreamPolicy.checkpoint_interval,
    send: Send | None = None,
    now: Column | None = None,
) -> list:
    """Placed messages to windowed metrics. The event has no total, so lines are summed.

    Rows behind the watermark correct their windows, which come out again as the next version
    (``corrections.read_latest`` gives the newest), and with ``now`` a quiet topic closes windows
    by that clock. A message whose time is not known (no or default
    metadata, or none that parses) is in no window; ``set_aside`` holds it with the reason, so
    that none goes away unseen.
    """
    decoded = M.decode_placed(messages, F.current_timestamp())
    reason = M.disposition()
    events = M.timed(decoded.where(reason == "ok")).select("event_time", amount)
    aside = decoded.where(reason != "ok").select(
        "key", "value", "headers", "partition", "offset", reason.alias("reason")
    )

    def keep(batch: DataFrame, batch_id: int) -> None:
        files.replace_batch(batch, f"{folder}/set_aside", batch_id)

    return [
        files.start(aside, keep, f"{folder}/set_aside_offsets", interval),
        *(
            corrections.start_corrected_metrics(
                events, size, folder, interval, amount=amount, now=now, send=send
            )
            for size in sizes
        ),
    ]


def order_snapshots(
    messages: DataFrame,
    folder: str,
    every: int = 10,
    interval: str | None = StreamPolicy.checkpoint_interval,
):
    """Placed messages to the cumulative snapshot, in order of partition and offset."""
    events = M.placed_events(messages, F.current_timestamp())
    return snapshot.start_snapshot(
        events.select("offset", "partition", "item_lines"),
        ["offset", "partition"],
        folder,
        every=every,
        interval=interval,
    )


def outbox_relay(
    outbox_rows: DataFrame,
    folder: str,
    publish: Callable[[DataFrame], DataFrame] | None,
    interval: str | None = OutboxPolicy.polling_interval,
    send: Send | None = None,
    connect: delivery.Connect | None = None,
):
    """Outbox rows to the placed topic; with ``connect`` each row's state is what its send gave."""
    return relay.start_relay(
        outbox_rows,
        publish,
        folder,
        F.current_timestamp(),
        interval=interval,
        send=send,
        connect=connect,
    )


def fulfillment_service(
    messages: DataFrame,
    folder: str,
    hook: steps.Hook = steps.accept_all,
    interval: str | None = StreamPolicy.checkpoint_interval,
    send: Send | None = None,
    policy: RetryPolicy = RetryPolicy(),
    connect: delivery.Connect | None = None,
):
    """Placed messages to fulfilled messages and dead letters.

    With ``connect`` the events are sent by the tasks, and only errors in passing are tried
    again.
    """
    transient = retry.is_transient(F.col("error_type"), F.col("fatal")) if connect else None
    return fulfillment.start_fulfillment(
        messages,
        folder,
        F.current_timestamp(),
        hook,
        interval,
        send,
        policy,
        transient=transient,
        connect=connect,
    )


def order_status(
    messages: DataFrame,
    order_store: Callable[[], DataFrame],
    folder: str,
    unknown_order: str = "dead_letter",
    interval: str | None = StreamPolicy.checkpoint_interval,
    send: Send | None = None,
    policy: RetryPolicy = RetryPolicy(),
):
    """Fulfilled messages to status changes. Messages that do not decode are set aside."""
    now = F.current_timestamp()
    events = M.decode_fulfilled(messages, now)
    return fulfillment.start_status_apply(
        events.select(
            "order_short_code", "fulfilled_at", "partition", "offset", "value", "metadata"
        ),
        order_store,
        "order_short_code",
        folder,
        now,
        ["fulfilled_at", "partition", "offset"],
        unknown_order=unknown_order,
        interval=interval,
        send=send,
        policy=policy,
    )
