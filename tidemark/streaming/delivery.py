"""Messages sent by the tasks that hold them, with an outcome for every row.

A sink that takes a whole frame can only fail as a whole. Here each task opens a client, sends
its rows one after the other and returns every row with what became of it, so that a table of
outcomes is written like any other and nothing but its rows says PUBLISHED. The outcomes stay
rows: they do not go through the driver, as commit messages of a data source would.

A key is one task and its messages keep their order; after a refused message the next ones of
the key are still sent, each by itself. A task that is run again
sends again: delivery is at least once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import Any, Protocol

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from tidemark.operators import outbox
from tidemark.sources import messages

MESSAGE = "_message"
OUTCOME = StructType(
    [
        StructField("error", StringType()),
        StructField("error_code", StringType()),
        StructField("fatal", BooleanType()),
        StructField("task", IntegerType()),
        StructField("place", LongType()),
    ]
)


class Refused(Exception):
    """What a client raises for a message it could not deliver."""

    def __init__(self, text: str, code: str = "", fatal: bool = False):
        super().__init__(text)
        self.code, self.fatal = code, fatal


class Client(Protocol):
    """One connection of one task."""

    def send(self, message: dict[str, Any]) -> None:
        """Deliver ``key, value, headers, topic``; an exception is the row's error."""

    def close(self) -> None:
        """Called once, after the last row or an error of the task."""


Connect = Callable[[], Client]


def _outcome(error: Exception | None) -> tuple:
    if error is None:
        return None, None, None
    code = getattr(error, "code", "") or type(error).__name__
    return str(error), str(code), bool(getattr(error, "fatal", False))


def _sender(connect: Connect):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, place, client = TaskContext.get().partitionId(), 0, None
        try:
            for batch in batches:
                outcomes = []
                for message in batch[MESSAGE].to_pylist():
                    error = None
                    if message is not None:
                        try:
                            if client is None:
                                client = connect()
                            client.send(message)
                        except Exception as caught:  # the row's outcome, whatever it was
                            error = caught
                    outcomes.append((*_outcome(error), task, place))
                    place += 1
                columns = zip(*outcomes) if outcomes else [[]] * len(OUTCOME)
                kinds = (pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int64())
                added = [pa.array(list(c), kind) for c, kind in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, *added], names=[*batch.schema.names, *OUTCOME.fieldNames()]
                )
        finally:
            if client is not None:
                client.close()

    return run


def deliver(rows: DataFrame, connect: Connect, key: str, order: Sequence[str]) -> DataFrame:
    """Send the ``_message`` of each row; adds ``error, error_code, fatal, task, place``.

    ``error`` is null for a row the client took and for one without a message. ``place``
    counts the rows of a task in the order they were sent. Every action on the result sends
    again: write it to a table first.
    """
    in_order = outbox.in_key_order(rows, key, order)
    schema = StructType([*in_order.schema.fields, *OUTCOME.fields])
    return in_order.mapInArrow(_sender(connect), schema)


def publisher(connect: Connect) -> Callable[[DataFrame], DataFrame]:
    """``publish`` for ``outbox.attempt``: sends each decoded event and says how that ended."""

    def publish(events: DataFrame) -> DataFrame:
        rows = events.withColumn(MESSAGE, messages.placed_message())
        return deliver(rows, connect, "entity_id", ["occurred_at", "id"]).drop(
            MESSAGE, *(name for name in OUTCOME.fieldNames() if name != "error")
        )

    return publish
