"""Order status: duplicates, lookups, the state machine and the update itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import ORDER_STATUSES


def rank(status: Column) -> Column:
    """Place of the status in PENDING -> FULFILLED -> SHIPPED; 0 for anything else."""
    return F.array_position(F.array(*[F.lit(s) for s in ORDER_STATUSES]), status)


def first_per_key(events: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """The earliest event of each key.

    Spark cuts the rows to the first per key before the shuffle, so a key with very many
    copies sends one row per task.
    """
    place = F.row_number().over(Window.partitionBy(key).orderBy(*order_by))
    return events.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def having_status(events: DataFrame, orders: DataFrame, key: str, status: str) -> DataFrame:
    """Events whose order exists and has this status."""
    return events.join(orders.where(F.col("status") == status).select(key), key, "left_semi")


def without_status(events: DataFrame, orders: DataFrame, key: str, status: str) -> DataFrame:
    """Events whose order does not have this status yet (duplicates are skipped)."""
    return events.join(orders.where(F.col("status") == status).select(key), key, "left_anti")


def unknown(events: DataFrame, orders: DataFrame, key: str) -> DataFrame:
    """Events that match no order."""
    return events.join(orders.select(key), key, "left_anti")


def furthest_status(changes: DataFrame, key: str) -> DataFrame:
    """The furthest status each order reached, whatever the order of its changes."""
    return changes.groupBy(key).agg(
        F.element_at(
            F.array(*[F.lit(s) for s in ORDER_STATUSES]), F.max(rank(F.col("status"))).cast("int")
        ).alias("status")
    )


def apply_status(
    orders: DataFrame,
    changes: DataFrame,
    key: str,
    status: str,
    as_of: Column,
    guard_regression: bool = True,
) -> DataFrame:
    """``orders`` with ``status`` set where ``changes`` has the key, however often.

    With the guard an order only moves forward. ``updated_at`` moves with every update.
    """
    hits = changes.select(key).distinct().withColumn("_hit", F.lit(1))
    allowed = F.col("_hit").isNotNull()
    if guard_regression:
        allowed = allowed & (rank(F.col("status")) < rank(F.lit(status)))
    moved = (
        orders.join(hits, key, "left")
        .withColumn("_changed", allowed)
        .withColumn("status", F.when(F.col("_changed"), status).otherwise(F.col("status")))
    )
    return touch(moved, as_of).select(*orders.columns)


def touch(df: DataFrame, as_of: Column, changed: str = "_changed") -> DataFrame:
    """Move ``updated_at`` on changed rows."""
    return df.withColumn("updated_at", F.when(F.col(changed), as_of).otherwise(F.col("updated_at")))


def lines_per_order(orders: DataFrame, lines: DataFrame, key: str) -> DataFrame:
    """Orders with ``item_lines``; 0 without lines. Lines are counted before the join."""
    counts = lines.groupBy(key).agg(F.count("*").alias("_lines"))
    return (
        orders.join(counts, key, "left")
        .withColumn("item_lines", F.coalesce(F.col("_lines"), F.lit(0)))
        .drop("_lines")
    )


def with_items(orders: DataFrame, items: DataFrame, key: str, keep_empty: bool = True) -> DataFrame:
    """Orders joined to their items, one row per item; orders without items are optional.

    An inner join and the rest apart: Spark can split a hot key of an inner join on either
    side, of a left join only on the left one.
    """
    found = orders.join(items, key)
    if not keep_empty:
        return found
    without = orders.join(items.select(key), key, "left_anti")
    return found.unionByName(without, allowMissingColumns=True)
