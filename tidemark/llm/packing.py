"""Packing of documents into fixed windows by best-fit decreasing.

Overlong documents are first cut into full windows; what is left of each document is one
piece. Pieces are taken by falling length, and each goes into the open window with the least
room that still holds it. The room of a window is a whole number up to the window size, so a
segment tree over the rooms finds the tightest one, and pieces of one length are alike: the
plan is made from the number of pieces per length. Those are at most as many numbers as the
window has places, whatever the corpus; only they reach the driver, and the plan that goes
back has a size bound by the window alone.

Every row is a document of its own: repeated ids and repeated rows are packed once per row.
A null text is empty; an empty text is the one id that ends a document. Other columns of the
input are ignored. An empty table gives an empty result. Texts of any length are encoded
whole.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import slices, text_or_empty, with_longs
from tidemark.llm.tokens import encoder
from tidemark.session import settle

VOCABULARY = "byte_bpe_50k.json"
WINDOW = 1024
END_ID = 0

PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


def cut(
    docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """Pieces of at most ``window`` ids; ``ids`` holds them as little-endian 32-bit numbers."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).array
        end = np.array([end_id], "<u4")
        for whole in batches:
            for batch in slices(whole, 256):
                rows = []
                for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                    ids = np.concatenate([encode(text), end])
                    for at in range(0, len(ids), window):
                        piece = ids[at : at + window]
                        rows.append((key, at, len(piece), len(ids), piece.tobytes()))
                columns = list(zip(*rows)) or [[]] * 5
                types = [pa.int64()] * 4 + [pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    texts = docs.select(F.col("doc_id").cast("long"), text_or_empty().alias("text"))
    return texts.mapInArrow(pieces, PIECES)


class Rooms:
    """Open windows by remaining room: a segment tree over rooms 0..window."""

    def __init__(self, window: int):
        self.size = 1
        while self.size <= window:
            self.size *= 2
        self.any = [0] * (2 * self.size)
        self.runs: list[deque] = [deque() for _ in range(window + 1)]

    def add(self, room: int, first: int, count: int) -> None:
        self.runs[room].append((first, count))
        self._mark(room)

    def take(self, room: int, most: int) -> tuple[int, int]:
        """Up to ``most`` windows of this room, as (first, count)."""
        first, count = self.runs[room].popleft()
        if count > most:
            self.runs[room].appendleft((first + most, count - most))
            count = most
        self._mark(room)
        return first, count

    def tightest(self, least: int) -> int | None:
        """The smallest room of at least ``least`` that an open window has."""
        node = self.size + least
        if self.any[node]:
            return least
        while node > 1:
            if node % 2 == 0 and self.any[node + 1]:
                node += 1
                while node < self.size:
                    node = 2 * node if self.any[2 * node] else 2 * node + 1
                return node - self.size
            node //= 2
        return None

    def _mark(self, room: int) -> None:
        node = self.size + room
        self.any[node] = 1 if self.runs[room] else 0
        while node > 1:
            node //= 2
            self.any[node] = self.any[2 * node] | self.any[2 * node + 1]


def plan(numbers: dict[int, int], window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing over the number of pieces per length.

    Returns (placements, fills): placements are rows (length, first rank, first sequence,
    offset), sorted; the pieces of this length from that rank on go one each into the
    sequences from there on. Fills are rows (first sequence, tokens in it), sorted.
    """
    rooms, placed, opened = Rooms(window), [], 0
    for length in sorted(numbers, reverse=True):
        left, rank = numbers[length], 0
        while left:
            room = rooms.tightest(length)
            fresh = room is None
            if fresh:
                room = window
            fit = room // length
            wanted = max(1, left // fit)
            if fresh:
                first, count = opened, wanted
                opened += count
            else:
                first, count = rooms.take(room, wanted)
            # One window is filled as far as it goes before the next one is the tightest.
            each = min(fit, left)
            for turn in range(each):
                placed.append((length, rank, first, window - room + turn * length))
                rank += count
            left -= each * count
            rooms.add(room - each * length, first, count)
    fills = sorted(
        (first, window - room) for room, runs in enumerate(rooms.runs) for first, _ in runs
    )
    return (
        np.array(sorted(placed), np.int64).reshape(-1, 4),
        np.array(fills, np.int64).reshape(-1, 2),
    )


def assign(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Add ``sequence_id``, ``offset``, ``sequence_tokens`` and ``padded_tokens`` to pieces.

    The pieces are numbered per task and length while they are written once; later steps
    read that table, so a lost executor cannot change a number. ``padded_tokens`` is the
    window, or the tokens themselves where they are a power of two and need no padding.
    """
    names = pieces.columns

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(window + 1, np.int64)
        for batch in batches:
            lengths = batch["length"].to_numpy()
            order = np.argsort(lengths, kind="stable")
            kinds, counts = np.unique(lengths, return_counts=True)
            ranks = np.empty(len(lengths), np.int64)
            ranks[order] = np.arange(len(lengths)) - np.repeat(
                np.cumsum(counts) - counts - seen[kinds], counts
            )
            seen[kinds] += counts
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(ranks), task)), pa.array(ranks)],
                names=[*names, "_slice", "_rank"],
            )

    numbered = settle(pieces.mapInArrow(number, with_longs(pieces.schema, "_slice", "_rank")))
    counted = numbered.groupBy("_slice", "length").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_slice")
    bases = counted.select(
        "_slice",
        "length",
        (F.sum("_n").over(before) - F.col("_n")).alias("_base"),
    )
    totals = counted.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # <= window rows
    placements, fills = plan({row.length: row.n for row in totals}, window)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = placements[:, 0] << 48 | placements[:, 1]
        for batch in batches:
            rank = batch["_base"].to_numpy() + batch["_rank"].to_numpy()
            at = np.searchsorted(starts, batch["length"].to_numpy() << 48 | rank, "right") - 1
            sequence = placements[at, 2] + rank - placements[at, 1]
            tokens = fills[np.searchsorted(fills[:, 0], sequence, "right") - 1, 1]
            padded = np.where(tokens & (tokens - 1) == 0, tokens, window)
            added = [sequence, placements[at, 3], tokens, padded]
            yield pa.RecordBatch.from_arrays(
                [batch[n] for n in names] + [pa.array(a) for a in added],
                names=[*names, "sequence_id", "offset", "sequence_tokens", "padded_tokens"],
            )

    out = with_longs(
        pieces.schema, "sequence_id", "offset", "sequence_tokens", "padded_tokens"
    )
    return numbered.join(bases, ["_slice", "length"]).mapInArrow(place, out)


def pack(
    docs: DataFrame, vocabulary: str = VOCABULARY, window: int = WINDOW, end_id: int = END_ID
) -> DataFrame:
    """All pieces with their ids and their places."""
    return assign(cut(docs, vocabulary, window, end_id), window)


def sequences(packed: DataFrame) -> DataFrame:
    """One row per sequence: its pieces in order, with their ids. A sequence is bounded."""
    fields = F.struct("offset", "doc_id", "start", "length", "ids")
    return packed.groupBy("sequence_id").agg(
        F.array_sort(F.collect_list(fields)).alias("pieces"),
        F.max("sequence_tokens").alias("sequence_tokens"),
        F.max("padded_tokens").alias("padded_tokens"),
    )


def digest(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
