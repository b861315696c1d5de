"""The next event of a key at or after a point in time, for keys that many rows share.

A join on the key would make a row for each order and each event of a key. Here both sides
are one list in order of key and time, cut into range slices of about equal size, and the next
event is carried backwards: inside a slice by a window, from slice to slice by a table of one
row per slice. A key with m orders and n events costs m + n rows, and a key with half of all
rows spans many slices.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import ordered


def next_event(
    points: DataFrame,
    events: DataFrame,
    key: str,
    at: str,
    event_at: str,
    keep: Sequence[str] = (),
    slices: int | None = None,
) -> DataFrame:
    """``key, at, *keep, event_at``: for each distinct point the first event not before it.

    Points without one are left out, as are rows without a key or a time. Points that agree in
    all these columns are one row, so that equal ones do not crowd a slice.
    """
    wanted = points.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    happened = events.where(F.col(key).isNotNull() & F.col(event_at).isNotNull())
    rows = (
        wanted.select(key, F.col(at).alias("_t"), F.lit(0).alias("_side"), *keep)
        .distinct()
        .unionByName(
            happened.select(key, F.col(event_at).alias("_t"), F.lit(1).alias("_side")).distinct(),
            allowMissingColumns=True,
        )
    )
    cut = ordered.range_slices(rows, [key, "_t", "_side", *keep], slices)
    event = F.when(F.col("_side") == 1, F.col("_t"))
    later = (  # backwards, so that the frame grows and is not computed anew for each row
        Window.partitionBy("_slice", key)
        .orderBy(F.desc("_position"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        cut.withColumn("_next", F.min(event).over(later))
        .join(F.broadcast(_carried(cut, key)), "_slice")  # one row per slice
        .withColumn(
            "_next", F.coalesce("_next", F.when(F.col(key) == F.col("_last"), F.col("_carried")))
        )
        .where((F.col("_side") == 0) & F.col("_next").isNotNull())
        .select(key, F.col("_t").alias(at), *keep, F.col("_next").alias(event_at))
    )


def _carried(cut: DataFrame, key: str) -> DataFrame:
    """Per slice its last key, and that key's first event in the slices after it."""
    event = F.when(F.col("_side") == 1, F.col("_t"))
    heads = cut.groupBy("_slice").agg(
        # The first key, and its first event: the least of those with one.
        F.min(F.struct(F.col(key).alias("k"), event.isNull().alias("none"), event.alias("e"))).alias(
            "_head"
        ),
        F.max(key).alias("_last"),
    )
    on = Window.orderBy("_slice")
    same = (
        Window.partitionBy("_head.k")
        .orderBy(F.desc("_slice"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    first = F.struct(F.col("_head.k").alias("k"), F.min("_head.e").over(same).alias("e"))
    ahead = heads.withColumn("_first", first).withColumn("_ahead", F.lead("_first").over(on))
    return ahead.select(
        "_slice",
        "_last",
        F.when(F.col("_ahead.k") == F.col("_last"), F.col("_ahead.e")).alias("_carried"),
    )
