"""Mixing of sources to target weights by Pfair scheduling.

Documents of a source, in id order, form blocks. The k-th block of a source with share w of
the slots is released at floor((k-1)/w) and due at ceil(k/w); in each slot the released
block with the earliest deadline runs. So after any number of slots a source is less than
one block away from its share.

Sources that run out leave the schedule, and the shares of the others grow in proportion:
with w(s) the weight and n(s) the blocks of a source, the k-th block of s ends in the fluid
schedule at the sum of min(w(j) * k / w(s), n(j)) over all sources j. Release and deadline are
that of the block before and of the block, rounded down and up, in whole numbers without a
rounding of weights. Sources with a target of 0 come after all others, in equal shares.

Every source has a place of its own. The driver holds one row per source and walks through
the blocks once (some microseconds for ``BLOCK`` documents), writing ``CHUNK`` slots at a time;
documents are numbered and joined by Spark and never reach it.

Rows that repeat an id travel together as one document, rows with a null id too; its source
is the least one among them. A null source is a source of its own. An empty table gives an
empty result. Other columns are carried by ``mix`` and ignored by ``schedule``.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate, islice

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small
from tidemark.session import new_folder, settle

BLOCK = 8
# Target weight of a source of n documents: n to this power.
POWER = 0.5
# Slots that the driver holds at a time.
CHUNK = 500_000


def slots_of(weights: list[float], blocks: list[int]) -> Iterator[tuple[int, int]]:
    """(place, block) slot by slot: the released block with the earliest deadline."""
    places = [p for p, w in enumerate(weights) if w > 0 and blocks[p]]
    unit = max((w.as_integer_ratio()[1] for w in weights), default=1)  # powers of two
    whole = {p: int(Fraction(weights[p]) * unit) for p in places}
    # Sources in the order in which the fluid schedule ends them.
    ends = sorted(places, key=lambda p: Fraction(blocks[p], whole[p]))
    near = [blocks[p] / whole[p] for p in ends]
    gone = [0, *accumulate(blocks[p] for p in ends)]
    live = [0, *accumulate(whole[p] for p in ends)]
    live = [live[-1] - w for w in live]

    def window(place: int, block: int) -> tuple[int, int]:
        """Release of a block and its deadline."""
        out, w = [], whole[place]
        for k in (block, block + 1):
            at = bisect_left(near, k / w)
            # The nearest doubles may be off; whole numbers decide.
            while at < len(ends) and blocks[ends[at]] * w < k * whole[ends[at]]:
                at += 1
            while at and blocks[ends[at - 1]] * w >= k * whole[ends[at - 1]]:
                at -= 1
            out.append((gone[at] * w + k * live[at], w))
        return out[0][0] // w, -(-out[1][0] // w)

    waiting, ready = [], []
    for place in places:
        release, due = window(place, 0)
        waiting.append((release, due, place, 0))
    heapq.heapify(waiting)
    for slot in range(gone[-1]):
        while waiting and waiting[0][0] <= slot:
            _, due, place, block = heapq.heappop(waiting)
            heapq.heappush(ready, (due, place, block))
        _, place, block = heapq.heappop(ready)
        yield place, block
        if block + 1 < blocks[place]:
            release, due = window(place, block + 1)
            heapq.heappush(waiting, (release, due, place, block + 1))
    rest = [0 if w > 0 else n for w, n in zip(weights, blocks)]
    if any(rest):
        yield from slots_of([float(n > 0) for n in rest], rest)


def _timed(keys: DataFrame, targets: dict[str, float] | None, block: int) -> DataFrame:
    """The schedule by unrounded weights, with a place for each source."""
    spark = keys.sparkSession
    sizes = keys.groupBy("source").agg(F.count("*").alias("n"))
    rows = sorted(sizes.collect(), key=lambda r: (r.source is not None, r.source))  # one per source
    if targets is None:
        weights = [float(r.n) ** POWER for r in rows]
    else:
        weights = [float(targets.get(r.source, 0.0)) for r in rows]
    kind = keys.schema["source"].dataType.simpleString()
    places = settle(
        spark.createDataFrame(
            [(r.source, place) for place, r in enumerate(rows)], f"own {kind}, place long"
        )
    )
    placed = keys.join(small(places), F.col("source").eqNullSafe(F.col("own")))
    numbered = _numbered(placed.select("doc_id", "source", "place"))
    walk = slots_of(weights, [-(-r.n // block) for r in rows])
    folder, first = new_folder(spark, "slots"), 0
    while True:
        part = list(islice(walk, CHUNK))
        columns = {
            "place": pa.array([p for p, _ in part], pa.int64()),
            "block": pa.array([b for _, b in part], pa.int64()),
            "slot": pa.array(range(first, first + len(part)), pa.int64()),
        }
        spark.createDataFrame(pa.table(columns)).write.mode("append").parquet(folder)
        first += len(part)
        if len(part) < CHUNK:
            break
    slots = spark.read.schema("place long, block long, slot long").parquet(folder)
    return (
        numbered.withColumn("block", F.floor(F.col("number") / block))
        .withColumn("spot", F.col("number") % block)
        .join(small(slots), ["place", "block"])
        .select("doc_id", "source", "block", "slot", "spot")
    )


def _numbered(keys: DataFrame) -> DataFrame:
    """Documents numbered per place from 0 in id order, with no place in one task.

    The rows are cut into ranges and written; the numbers come from the written ranges.
    """
    ranges = settle(
        keys.repartitionByRange("place", "doc_id").withColumn("range", F.spark_partition_id())
    )
    counts = ranges.groupBy("range", "place").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("range")
    bases = counts.select(
        "range", "place", (F.sum("n").over(before) - F.col("n")).alias("base_rank")
    )
    inside = Window.partitionBy("range", "place").orderBy(F.asc_nulls_first("doc_id"))
    ranked = ranges.withColumn("rank", F.row_number().over(inside) - 1)
    return ranked.join(bases, ["range", "place"]).select(
        "doc_id", "source", "place", (F.col("base_rank") + F.col("rank")).alias("number")
    )


def schedule(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """doc_id, source, block (of its place in the schedule), slot (of the block, gapless) and
    spot (in the block) of each document."""
    keys = settle(docs.groupBy("doc_id").agg(F.min("source").alias("source")))
    return _timed(keys, targets, block)


def mix(
    docs: DataFrame,
    targets: dict[str, float] | None = None,
    block: int = BLOCK,
) -> DataFrame:
    """The documents, all columns kept, in the order of the schedule."""
    places = schedule(docs, targets, block).select(
        F.col("doc_id").alias("_mix_id"),
        F.col("slot").alias("_mix_slot"),
        F.col("spot").alias("_mix_spot"),
    )
    joined = docs.join(places, docs["doc_id"].eqNullSafe(places["_mix_id"]))
    ordered = joined.repartitionByRange("_mix_slot", "_mix_spot").sortWithinPartitions(
        "_mix_slot", "_mix_spot"
    )
    return ordered.drop("_mix_id", "_mix_slot", "_mix_spot")
