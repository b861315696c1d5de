"""Order status as keyed state: what a batch does depends on its rows and their keys' state.

Order rows and fulfilled events are one stream, told apart by ``kind``. The state of an order
code is its status, and the events that came before their order. The stored orders are the
initial state: they are read in the first batch and never again, and neither are earlier
changes. A repeat finds the status moved on and is skipped, whenever it comes. State that was
not written for ``ttl`` is dropped, so codes that are done with do not stay for ever; choose it
beyond the time a repeat may take.

An event without an order waits ``wait`` for it. Then a timer of its code puts it out as
``unknown``; without a wait it is put out at once.

Only waits and times to live need state of a single code. Without them the state of a bucket of
codes is one value, as each call from Python to the state store takes far longer than a row does.
The bucket of a code must stay the same, so ``BUCKETS`` must too while a checkpoint is in use.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from datetime import timedelta
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, StringType, StructField, StructType

from tidemark.config import ORDER_STATUSES
from tidemark.sources import files
from tidemark.streaming import retries

CHANGED, UNKNOWN = "changed", "unknown"
# Values of the state without waits: each holds the codes of a bucket with their statuses.
BUCKETS = 4096


def _rank(status: str | None) -> int:
    return ORDER_STATUSES.index(status) + 1 if status in ORDER_STATUSES else 0


class StatusProcessor(StatefulProcessor):
    """One order code: ``status`` once the order is known, ``waiting`` events until then."""

    def __init__(
        self, key: str, event: StructType, order: list[str], status: str, wait_ms: int, ttl_ms: int
    ):
        self._key, self._event, self._order = key, event, order
        self._status, self._wait_ms, self._ttl_ms = status, wait_ms, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        ttl = self._ttl_ms or None
        known = StructType([StructField("status", StringType())])
        self._handle = handle
        self._known = handle.getValueState("status", known, ttl)
        self._waiting = handle.getListState("waiting", self._event, ttl)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        self._learn(initialState.status)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        events = []
        for row in rows:
            if row.kind == "order":
                self._learn(row.status)
            else:
                events.append(self._values(row.event))
        if self._known.exists():
            if self._waiting.exists():
                events = [*map(tuple, self._waiting.get()), *events]
                self._waiting.clear()
            yield from self._apply(key, events)
        elif events and self._wait_ms:
            if not self._waiting.exists():
                now = timerValues.getCurrentProcessingTimeInMs()
                self._handle.registerTimer(now + self._wait_ms)
            self._waiting.appendList(events)
        else:
            for event in events:
                yield self._row(key, UNKNOWN, None, event)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        if self._waiting.exists():
            for event in self._waiting.get():
                yield self._row(key, UNKNOWN, None, event)
            self._waiting.clear()

    def close(self) -> None:
        pass

    def _values(self, event: Any) -> tuple:
        """A struct inside a row comes as a dictionary."""
        return tuple(event[name] for name in self._event.fieldNames())

    def _row(self, key: Any, outcome: str, old: str | None, event: Any) -> Row:
        named = Row(**dict(zip(self._event.fieldNames(), event)))
        return Row(**{self._key: key[0], "outcome": outcome, "old_status": old, "event": named})

    def _learn(self, status: str | None) -> None:
        """An order never moves back."""
        if self._known.exists() and _rank(self._known.get()[0]) >= _rank(status):
            return
        self._known.update((status,))

    def _apply(self, key: Any, events: list[tuple]) -> Iterator[Row]:
        """The first event moves the order on; the others find it there."""
        old = self._known.get()[0]
        if events and old is not None and _rank(old) < _rank(self._status):
            places = [self._event.fieldNames().index(name) for name in self._order]
            first = min(events, key=lambda event: [_sortable(event[place]) for place in places])
            self._known.update((self._status,))
            yield self._row(key, CHANGED, old, first)


class BucketProcessor(StatusProcessor):
    """A bucket of order codes: the ``status`` of each known one, as one value."""

    def __init__(self, key: str, event: StructType, order: list[str], status: str):
        super().__init__(key, event, order, status, 0, 0)
        self._places = [event.fieldNames().index(name) for name in order]

    def init(self, handle: StatefulProcessorHandle) -> None:
        known = StructType([StructField("statuses", BinaryType())])
        self._known = handle.getValueState("known", known)

    def handleInitialState(self, key: Any, initialState: Row, timerValues: Any) -> None:
        statuses = self._read()
        for order in initialState.orders:
            _raise(statuses, order["code"], order["status"])
        self._write(statuses)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        statuses, learned, firsts, unmet = self._read(), False, {}, {}
        for row in rows:
            code = row[self._key]
            if row.kind == "order":
                learned |= _raise(statuses, code, row.status)
            elif code not in statuses:
                unmet.setdefault(code, []).append(self._values(row.event))
            elif _rank(statuses[code]) < _rank(self._status):  # or an order may come yet
                event = self._values(row.event)
                firsts[code] = min(firsts.get(code, event), event, key=self._place)
        for code, events in unmet.items():
            if code not in statuses:
                for event in events:
                    yield self._row((code,), UNKNOWN, None, event)
            else:  # its order came after it in this batch
                later = [firsts[code]] if code in firsts else []
                firsts[code] = min(events + later, key=self._place)
        changed = [code for code in firsts if self._open(statuses[code])]
        for code in changed:
            yield self._row((code,), CHANGED, statuses[code], firsts[code])
            statuses[code] = self._status
        if learned or changed:
            self._write(statuses)

    def _read(self) -> dict[Any, str | None]:
        found = self._known.get() if self._known.exists() else None
        return pickle.loads(found[0]) if found else {}

    def _write(self, statuses: dict[Any, str | None]) -> None:
        self._known.update((pickle.dumps(statuses),))

    def _open(self, status: str | None) -> bool:
        return status is not None and _rank(status) < _rank(self._status)

    def _place(self, event: tuple) -> list[tuple]:
        return [_sortable(event[place]) for place in self._places]


def _raise(statuses: dict[Any, str | None], code: Any, status: str | None) -> bool:
    """Learn the status of an order, which never moves back; whether it is news."""
    if code in statuses and _rank(statuses[code]) >= _rank(status):
        return False
    statuses[code] = status
    return True


def _sortable(value: Any) -> tuple:
    """Nulls first, as Spark sorts them."""
    return (value is not None, value)


def as_orders(orders: DataFrame, key: str) -> DataFrame:
    """New orders for the stream of ``status_outcomes``: key and status."""
    return orders.select(key, F.lit("order").alias("kind"), "status")


def as_events(events: DataFrame, key: str) -> DataFrame:
    """Fulfilled events for that stream; all columns go along as ``event``."""
    return events.where(F.col(key).isNotNull()).select(
        key, F.lit("event").alias("kind"), F.struct(*events.columns).alias("event")
    )


def status_outcomes(
    events: DataFrame,
    stored: DataFrame,
    key: str,
    event_order: list[str],
    new_orders: DataFrame | None = None,
    status: str = "FULFILLED",
    wait: timedelta = timedelta(0),
    ttl: timedelta = timedelta(0),
) -> DataFrame:
    """``key, outcome, old_status, event``: ``changed`` once per order, ``unknown`` per event.

    ``stored`` is a batch frame with ``key`` and ``status``, ``new_orders`` a stream of the
    same shape. With a ``ttl`` of zero the state stays.
    """
    rows = as_events(events, key)
    if wait:
        rows = retries.without_heartbeat(retries.with_heartbeat(rows))
    if new_orders is not None:
        rows = rows.unionByName(as_orders(new_orders, key), allowMissingColumns=True)
    else:
        rows = rows.withColumn("status", F.lit(None).cast("string"))
    event = rows.schema["event"].dataType
    result = StructType(
        [
            rows.schema[key],
            StructField("outcome", StringType()),
            StructField("old_status", StringType()),
            StructField("event", event),
        ]
    )
    if not wait and not ttl:
        return _by_bucket(
            rows, stored, key, BucketProcessor(key, event, event_order, status), result
        )
    in_ms = [int(span.total_seconds() * 1000) for span in (wait, ttl)]
    processor = StatusProcessor(key, event, event_order, status, *in_ms)
    return rows.groupBy(key).transformWithState(
        processor,
        outputStructType=result,
        outputMode="Append",
        timeMode="ProcessingTime",
        initialState=stored.select(key, "status").groupBy(key),
    )


def _by_bucket(
    rows: DataFrame, stored: DataFrame, key: str, processor: BucketProcessor, result: StructType
) -> DataFrame:
    """The stored orders of a bucket are one row of the initial state."""
    code = F.col(key).cast(rows.schema[key].dataType)
    bucket = F.pmod(F.xxhash64(code), F.lit(BUCKETS)).cast("int").alias("bucket")
    orders = (
        stored.where(F.col(key).isNotNull())
        .select(bucket, F.struct(code.alias("code"), "status").alias("order"))
        .groupBy("bucket")
        .agg(F.collect_list("order").alias("orders"))
    )
    return rows.select(bucket, "*").groupBy("bucket").transformWithState(
        processor,
        outputStructType=result,
        outputMode="Append",
        timeMode="None",
        initialState=orders.groupBy("bucket"),
    )


def start_keyed_status(outcomes: DataFrame, folder: str, interval: str | None = None):
    """Append what ``status_outcomes`` says to ``folder/outcomes``, by batch.

    A query with timers would go on with empty batches for ever; a heartbeat in its events
    gives it one per trigger instead, so timers run while the input is quiet.
    """
    spark, empty_batches = outcomes.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"

    def write(batch: DataFrame, batch_id: int) -> None:
        files.replace_batch(batch, f"{folder}/outcomes", batch_id)

    before = spark.conf.get(empty_batches)
    spark.conf.set(empty_batches, "false")
    try:
        return files.start(outcomes, write, f"{folder}/offsets", interval)
    finally:
        spark.conf.set(empty_batches, before)  # the started query keeps its own settings


def read_outcomes(spark: SparkSession, folder: str, schema: StructType) -> DataFrame:
    return files.read_batches(spark, f"{folder}/outcomes", schema)
