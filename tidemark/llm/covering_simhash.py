"""SimHash near-duplicates by covering locality-sensitive hashing.

A text's fingerprint is the bitwise majority of the XXH64 values of its word shingles. Two
fingerprints are linked if they differ in at most ``RADIUS`` bits, and no link is lost: every
bit has a point of a projective space of ``RADIUS`` dimensions, and the mask of a hyperplane
has the bits whose points are not on it. Up to ``RADIUS`` points lie on a common hyperplane,
so two fingerprints within the radius are equal under its mask and meet in its table.

Equal fingerprints are one node from the start, so copies cost nothing here. A bucket of two
nodes is compared in an expression; a larger one is searched in one task for a spanning set of
links, never for all pairs. A bucket above ``MOST`` nodes is not searched: its members are
dealt again, by the masks of the bits that its mask left out, as they can differ only there.
The bits left out shrink from 64 to at most 32, 16 and 8, so at the third turn a bucket holds at
most 256 different fingerprints: the bound is proved, nothing is capped.

Null text is the empty text. Texts without a word have the fingerprint zero, which is linked
like any other. Shorter texts than a shingle are one shingle. Rows with the same text, and
repeated rows and ids, are judged row by row and end in one component. A null id stays null and
is nobody's component id; a component of null ids only has a null one. An empty table gives an
empty result. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small, text_or_empty
from tidemark.llm.grouping import PAIRS, components
from tidemark.session import settle

SHINGLE = 3
SEED = 42
RADIUS = 3
BITS = 64
ORDER = 2  # size of the prime field: 2 gives 15 tables of 34 bits, 3 gives 40 of 43 bits
MOST = 2048  # nodes of a bucket that one task searches
_STEP = 1 << 16  # shingles counted at a time, so that a long text needs no long list

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingle_hashes(data: bytes, width: int = SHINGLE) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles of a UTF-8 text, in runs of bounded length."""
    from xxhash import xxh64_intdigest as digest

    words = data.translate(_LOWER).split()
    if not words:
        return
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(width, len(words)) - 1
    first, final = starts[: len(words) - last], ends[last:]
    for place in range(0, len(first), _STEP):
        spans = zip(first[place : place + _STEP].tolist(), final[place : place + _STEP].tolist())
        yield np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)


def fingerprint(data: bytes, width: int = SHINGLE) -> int:
    """The bits that are set in more than half of the shingle hashes, as an unsigned number."""
    total, ones = 0, np.zeros(BITS, np.int64)
    for hashes in shingle_hashes(data, width):
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), 1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
        total += len(hashes)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _fingerprints(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 2000):
                found = [fingerprint(data, width) for data in batch["data"].to_pylist()]
                bits = np.array(found, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"], pa.array(bits)], names=["doc_id", "bits"]
                )

    return run


def fingerprints(docs: DataFrame, width: int = SHINGLE) -> DataFrame:
    """doc_id and ``bits``, the fingerprint as a signed long, of each row."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        text_or_empty().cast("binary").alias("data"),
    )
    return rows.mapInArrow(_fingerprints(width), "doc_id long, bits long")


def points(order: int, radius: int) -> list[tuple[int, ...]]:
    """The points of the projective space: vectors whose first coordinate but zero is one."""
    vectors = product(range(order), repeat=radius + 1)
    return [v for v in vectors if next((x for x in v if x), None) == 1]


def masks(order: int, radius: int, free: int = (1 << BITS) - 1) -> list[int]:
    """One mask per hyperplane, over the ``free`` bits: bits whose points are not on it."""
    space = points(order, radius)
    places = [i for i in range(BITS) if free >> i & 1]
    at = {place: space[rank % len(space)] for rank, place in enumerate(places)}
    return [
        sum(
            1 << place
            for place, point in at.items()
            if sum(x * y for x, y in zip(point, plane)) % order
        )
        for plane in space
    ]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _deeper(spark: SparkSession, known: dict[int, int], order: int, radius: int) -> tuple:
    """The masks below each known one, as a dictionary and as a table; their number is fixed."""
    rows, below = [], {}
    for path, mask in known.items():
        for place, more in enumerate(masks(order, radius, ~mask & ((1 << BITS) - 1))):
            child = path * len(points(order, radius)) + place
            below[child] = mask | more
            rows.append((path, child, _signed(mask | more)))
    return below, spark.createDataFrame(rows, "path long, child long, mask long")


def _spanning(radius: int):
    """Links that connect what is connected within a bucket: at most one less than its nodes."""

    def links(nodes: np.ndarray) -> Iterator[tuple[int, int]]:
        unseen = nodes
        while len(unseen) > 1:
            stack, unseen = [unseen[0]], unseen[1:]
            while stack and len(unseen):
                node = stack.pop()
                near = np.bitwise_count(unseen ^ node) <= radius
                found, unseen = unseen[near], unseen[~near]
                stack.extend(found)
                for other in found:
                    yield node, other

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 500):
                pairs = [
                    pair
                    for nodes in batch["nodes"]
                    for pair in links(nodes.values.to_numpy().view(np.uint64))
                ]
                ends = np.array(pairs, np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends.min(axis=1)), pa.array(ends.max(axis=1))], names=["a", "b"]
                )

    return run


def links(
    nodes: DataFrame, radius: int = RADIUS, order: int = ORDER, most: int = MOST
) -> DataFrame:
    """Pairs (a, b) that connect all fingerprints (column ``bits``, distinct) within the radius."""
    spark = nodes.sparkSession
    found = spark.createDataFrame([], PAIRS)
    known, table = _deeper(spark, {0: 0}, order, radius)
    members = nodes.select(F.lit(0).cast("long").alias("path"), "bits")
    while True:
        # The table of masks is as long as the tables are many: a constant.
        dealt = members.join(F.broadcast(table), "path").select(
            F.col("child").alias("path"), F.col("bits").bitwiseAND(F.col("mask")).alias("key"), "bits"
        )
        counted = dealt.groupBy("path", "key").agg(
            F.count("*").alias("n"), F.min("bits").alias("a"), F.max("bits").alias("b")
        )
        several = settle(counted.filter("n > 1"))
        two = several.filter("n = 2").select("a", "b")
        found = found.union(two.filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        middle = settle(several.filter((F.col("n") > 2) & (F.col("n") <= most)).select("path", "key"))
        lists = (
            dealt.join(small(middle), ["path", "key"])
            .groupBy("path", "key")
            .agg(F.collect_list("bits").alias("nodes"))  # at most ``most``
        )
        found = found.union(lists.select("nodes").mapInArrow(_spanning(radius), PAIRS))
        large = settle(several.filter(F.col("n") > most).select("path", "key"))
        if large.isEmpty():
            return settle(found.distinct())
        if 1 << max(BITS - mask.bit_count() for mask in known.values()) <= most:
            raise AssertionError("a bucket holds more nodes than its free bits can tell apart")
        members = settle(dealt.join(small(large), ["path", "key"]).select("path", "bits").distinct())
        known, table = _deeper(spark, known, order, radius)


def classes(
    docs: DataFrame, radius: int = RADIUS, order: int = ORDER, width: int = SHINGLE
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of each row."""
    printed = settle(fingerprints(docs, width))
    first = settle(printed.groupBy("bits").agg(F.min("doc_id").alias("first")))
    roots = components(links(first.select("bits"), radius, order))
    named = first.join(roots.withColumnRenamed("node", "bits"), "bits")
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    linked = roots.join(least, "root").select(F.col("node").alias("bits"), "component_id")
    ids = first.join(linked, "bits", "left").select(
        "bits", F.coalesce("component_id", "first").alias("component_id")
    )
    # An inner join, as every row has its fingerprint here: a hot one can be split.
    return printed.join(ids, "bits").select(
        "doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id"
    )
