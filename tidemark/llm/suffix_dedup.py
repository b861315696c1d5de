"""Removal of repeated passages, by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a document with a
smaller id. Nothing is sampled away: every string of that length is judged.

Sorting all suffixes of a corpus in one place is not possible, and comparing shards with each
other costs the square of their number. So the strings are dealt to shards by content. Of the
runs of ``ANCHOR`` bytes inside a string, the one with the least hash (the leftmost of equals)
is its anchor; equal strings have equal anchors. Neighbouring strings mostly share one, so a
document falls into blocks: an anchor and the consecutive strings that belong to it.

1. Documents are bundled into text shards. Each reports its sorted distinct anchors, cut to 32
   bits, to buckets of anchors; a bucket merges the sorted lists and tells each text shard
   which of its anchors other shards have too.
2. Blocks of such anchors, and of anchors that two documents of the shard have, go to their
   bucket, equal blocks once per shard with their least id.
3. A block whose anchor has no other content is settled: its strings are nowhere else. So is
   one of whose strings no hash occurs again. Over the other distinct blocks a bucket builds suffix arrays by Larsson-Sadakane refinement, in
   parts of bounded size, reads the common prefixes eight bytes at a time, and takes the least id of
   each group of equal strings. Parts are merged by binary search in their sorted strings.
   A mask per block says which of its strings an earlier document has.
4. The text shards apply the masks.

Text travels compressed, once in step 2 and once in step 4. Hash collisions and 32-bit keys
only cost work: strings are compared by their bytes.

Null text is empty. A null id counts as larger than every id. Rows that repeat an id never
remove each other's bytes. Documents shorter than ``LENGTH`` bytes stay whole. An empty table
gives an empty result. Other columns are ignored. A text larger than a shard is a shard of
its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shares, slices, text_bytes
from tidemark.llm.hashing import ODD, mix
from tidemark.session import settle

LENGTH = 50
ANCHOR = 16
SPAN = LENGTH - ANCHOR + 1  # places an anchor can have in a string
SHARD_BYTES = 4 << 20
BUCKET_BYTES = 16 << 20
PART_BYTES = 1 << 20
# A bucket is judged in this many turns, by the last bits of the anchors.
TURNS = 16
LAST_ID = np.iinfo(np.int64).max
LOW32 = np.uint64(0xFFFFFFFF)

SHARDS = "shard long, doc_ids array<long>, sizes array<long>, packed binary"
ANCHORS = "shard long, bucket long, anchors binary"
MASKS = "shard long, step int, bucket long, masks binary"
BLOCKS = "shard long, bucket long, sizes binary, anchors binary, ids binary, packed binary"
RESULT = (
    "doc_id long, n_bytes long, span_starts array<long>, span_ends array<long>, kept binary"
)


@cache
def _zstd() -> tuple:
    """One pair a process: making one takes longer than packing a small message."""
    return zstandard.ZstdCompressor(level=3), zstandard.ZstdDecompressor()


def _packed(data: bytes) -> bytes:
    return _zstd()[0].compress(data)


def _opened(data: bytes) -> bytes:
    return _zstd()[1].decompress(data)


# --- text shards -------------------------------------------------------------


def _bundle(shard_bytes: int):
    def bundle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        ids, texts, size = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task << 32 | number], pa.int64()),
                    pa.array([ids], pa.list_(pa.int64())),
                    pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
                    pa.array([_packed(b"".join(texts))], pa.binary()),
                ],
                names=["shard", "doc_ids", "sizes", "packed"],
            )

        for whole in batches:
            for batch in slices(whole, 500):
                data = batch["text"].cast(pa.binary()).to_pylist()
                for key, text in zip(batch["doc_id"].to_pylist(), data):
                    ids.append(key)
                    texts.append(text or b"")
                    size += len(texts[-1])
                    if size >= shard_bytes:
                        yield row()
                        number += 1
                        ids, texts, size = [], [], 0
        if ids:
            yield row()

    return bundle


def words_at(data: np.ndarray, kind: str) -> np.ndarray:
    """The eight bytes from each place on as one number; zeros follow the end."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).tobytes()
    out = np.empty(len(data), np.uint64)
    for shift in range(min(8, len(data))):
        count = (len(data) - shift + 7) // 8
        out[shift::8] = np.frombuffer(padded, kind, count, shift)
    return out


class Shard:
    """The blocks of a text shard, found anew wherever the shard is read."""

    def __init__(self, ids: list, sizes: list, packed: bytes, buckets: int):
        self.raw_ids = ids
        self.ids = np.array([LAST_ID if i is None else i for i in ids], np.int64)
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.starts = self.ends - np.array(sizes, np.int64)
        self.data = np.frombuffer(_opened(packed), np.uint8)
        self._cut()
        self.anchors, self.anchor = np.unique(
            (self.hash >> np.uint64(32)) % np.uint64(buckets) << np.uint64(32)
            | (self.hash & LOW32),
            return_inverse=True,
        )
        self.doc = np.searchsorted(self.ends, self.first, "right")

    def _cut(self) -> None:
        """first, count: the strings of each block; hash: of its anchor."""
        data, n = self.data, len(self.data)
        none = np.zeros(0, np.int64)
        self.first, self.count, self.hash = none, none, np.zeros(0, np.uint64)
        valid = np.ones(max(n - LENGTH + 1, 0), bool)
        for start, end in zip(self.starts.tolist(), self.ends.tolist()):
            valid[max(start, end - LENGTH + 1) : end] = False
        if not valid.any():
            return
        eight = words_at(data, "<u8")
        runs = eight[: n - ANCHOR + 1] + eight[8 : n - ANCHOR + 9] * ODD
        runs = (runs ^ (runs >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        least = (runs & ~LOW32) | np.arange(len(runs), dtype=np.uint64)
        width = 1
        while 2 * width <= SPAN:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        rest = SPAN - width
        least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
        place = np.flatnonzero(valid)
        owner = (least[place] & LOW32).astype(np.int64)
        new = np.ones(len(place), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
        at = np.flatnonzero(new)
        self.first = place[at]
        self.count = np.diff(np.append(at, len(place)))
        self.hash = mix(runs[owner[at]])

    def reports(self):
        """(bucket, sorted 32-bit anchors) of this shard."""
        bucket = self.anchors >> np.uint64(32)
        kinds, starts = np.unique(bucket, return_index=True)
        for kind, part in zip(kinds, np.split(self.anchors, starts[1:])):
            yield int(kind), (part & LOW32).astype("<u4")

    def shared(self, masks: dict[int, bytes]) -> np.ndarray:
        """The blocks whose anchor another shard or another document of this one has."""
        flags = np.zeros(len(self.anchors), bool)
        bucket = self.anchors >> np.uint64(32)
        for kind, packed in masks.items():
            low, high = np.searchsorted(bucket, [kind, kind + 1])
            flags[low:high] = np.unpackbits(
                np.frombuffer(packed, np.uint8), count=high - low
            ).astype(bool)
        if not len(flags):
            return np.zeros(0, np.int64)
        pairs = np.unique(self.anchor * len(self.ids) + self.doc)
        flags |= np.bincount(pairs // len(self.ids), minlength=len(flags)) > 1
        return np.flatnonzero(flags[self.anchor])

    def entries(self, blocks: np.ndarray):
        """Distinct contents of the blocks: (entry of each block, contents, least ids, anchors)."""
        data = self.data.tobytes()
        known: dict[bytes, int] = {}
        entry = np.empty(len(blocks), np.int64)
        spans = zip(self.first[blocks].tolist(), self.count[blocks].tolist())
        for at, (first, count) in enumerate(spans):
            entry[at] = known.setdefault(data[first : first + count + LENGTH - 1], len(known))
        ids = np.full(len(known), LAST_ID, np.int64)
        np.minimum.at(ids, entry, self.ids[self.doc[blocks]])
        anchors = np.zeros(len(known), np.uint64)
        anchors[entry] = self.anchors[self.anchor[blocks]]
        return entry, list(known), ids, anchors


def _shard_of(row: pa.Table, buckets: int) -> Shard:
    return Shard(
        row["doc_ids"][0].as_py(), row["sizes"][0].as_py(), row["packed"][0].as_py(), buckets
    )


def _report(buckets: int):
    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for row in slices(whole, 1):
                found = list(_shard_of(row, buckets).reports())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["shard"][0].as_py()] * len(found), pa.int64()),
                        pa.array([bucket for bucket, _ in found], pa.int64()),
                        pa.array([anchors.tobytes() for _, anchors in found], pa.binary()),
                    ],
                    names=["shard", "bucket", "anchors"],
                )

    return report


def _merge(group: pa.Table) -> pa.Table:
    """Which anchors of each shard another shard reports too."""
    lists = [np.frombuffer(b, "<u4") for b in group["anchors"].to_pylist()]
    every = np.sort(np.concatenate(lists))
    again = np.unique(every[1:][every[1:] == every[:-1]])
    masks = []
    for anchors in lists:
        at = np.minimum(np.searchsorted(again, anchors), max(len(again) - 1, 0))
        found = again[at] == anchors if len(again) else np.zeros(len(anchors), bool)
        masks.append(np.packbits(found).tobytes())
    return pa.table(
        {
            "shard": group["shard"],
            "step": pa.array([1] * len(masks), pa.int32()),
            "bucket": group["bucket"],
            "masks": pa.array(masks, pa.binary()),
        }
    )


def _masks_of(group: pa.Table, step: int) -> dict[int, bytes]:
    rows = zip(*(group[n].to_pylist() for n in ("step", "bucket", "masks")))
    return {bucket: mask for own, bucket, mask in rows if own == step}


def _send(buckets: int):
    def send(row: pa.Table, replies: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if row.num_rows:
            shard = _shard_of(row, buckets)
            _, contents, ids, anchors = shard.entries(shard.shared(_masks_of(replies, 1)))
            bucket = (anchors >> np.uint64(32)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            kinds, starts = np.unique(bucket[order], return_index=True)
            for kind, own in zip(kinds, np.split(order, starts[1:])):
                parts = [contents[i] for i in own]
                sizes = np.array([len(p) for p in parts], np.uint8)
                packed = _packed(b"".join(parts))
                keys = (anchors[own] & LOW32).astype("<u4").tobytes()
                out.append(
                    (int(kind), sizes.tobytes(), keys, _packed(ids[own].tobytes()), packed)
                )
        columns = list(zip(*out)) or [()] * 5
        return pa.table(
            {
                "shard": pa.array([row["shard"][0].as_py()] * len(out) if out else [], pa.int64()),
                "bucket": pa.array(columns[0], pa.int64()),
                "sizes": pa.array(columns[1], pa.binary()),
                "anchors": pa.array(columns[2], pa.binary()),
                "ids": pa.array(columns[3], pa.binary()),
                "packed": pa.array(columns[4], pa.binary()),
            }
        )

    return send


# --- suffix arrays -----------------------------------------------------------


def suffix_array(data: np.ndarray) -> np.ndarray:
    """All suffixes in order, by Larsson-Sadakane refinement.

    Suffixes are first ordered by eight bytes. The rank of a suffix is the place of its
    group; a round orders each unsorted group by the ranks ``depth`` places further on, which
    doubles the depth, and leaves sorted groups alone.
    """
    n = len(data)
    eight = words_at(data, ">u8")
    order = np.argsort(eight, kind="stable")
    # A suffix shorter than eight bytes equals a longer one with zeros there; it comes first.
    tail = np.arange(max(n - 8, 0), n)
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    same = np.zeros(n, bool)
    same[1:] = eight[order[1:]] == eight[order[:-1]]
    group = np.maximum.accumulate(np.where(same, 0, np.arange(n)))
    rank[order] = group
    depth = 8
    if len(tail):
        # Ranks of short suffixes are told apart by length in the first round.
        short = np.isin(order, tail)
        mixed = np.unique(group[short])
        for start in mixed:
            members = order[group == start]
            length = np.minimum(n - members, 8)
            by = members[np.argsort(length, kind="stable")]
            order[start : start + len(by)] = by
            steps = np.concatenate([[0], np.cumsum(np.diff(np.sort(length)) > 0)])
            firsts = np.searchsorted(steps, steps)
            rank[by] = start + firsts
    while True:
        places = rank[order]
        first = np.ones(n, bool)
        first[1:] = places[1:] != places[:-1]
        single = first & np.append(first[1:], True)
        at = np.flatnonzero(~single)
        if not len(at):
            return order
        members = order[at]
        own, further = rank[members], rank[np.minimum(members + depth, n)]
        by = np.argsort(own << 32 | (further + 1))
        members, own, further = members[by], own[by], further[by]
        order[at] = members
        new = np.ones(len(at), bool)
        new[1:] = (own[1:] != own[:-1]) | (further[1:] != further[:-1])
        rank[members] = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        depth *= 2


def common_prefixes(data: np.ndarray, order: np.ndarray, starts: np.ndarray, sizes: np.ndarray):
    """Common prefix of each suffix with the one before it in order, up to the largest block.

    All pairs go on in step, eight bytes at a time, until they differ; the first byte that
    differs is read off the two words. The number of steps has a bound from the largest block,
    so small parts take no longer than their bytes do.
    """
    n, most = len(data), int(sizes.max(initial=0)) + LENGTH
    eight = np.append(words_at(data, "<u8"), np.uint64(0))
    one, other = order[1:], order[:-1]
    limit = np.minimum(n - np.maximum(one, other), most)
    length = np.zeros(len(one), np.int64)
    going = np.arange(len(one))
    while len(going):
        at = length[going]
        apart = eight[one[going] + at] ^ eight[other[going] + at]
        # The lowest bit set says how many bytes are equal; none set is eight of them.
        low = apart & (~apart + np.uint64(1))
        length[going] = at + np.where(apart == 0, 64, np.bitwise_count(low - np.uint64(1))) // 8
        going = going[(apart == 0) & (length[going] < limit[going])]
    prefix = np.zeros(n, np.int64)
    prefix[one] = np.minimum(length, limit)
    return prefix


class Part:
    """Blocks of bounded size: their suffix array, and the least id of each string."""

    def __init__(self, contents: list[bytes], ids: np.ndarray):
        self.sizes = np.array([len(c) for c in contents], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.ids = ids
        self.data = np.frombuffer(b"".join(contents), np.uint8)
        order = suffix_array(self.data)
        prefix = common_prefixes(self.data, order, self.starts, self.sizes)
        counts = self.sizes - LENGTH + 1
        self.block = np.repeat(np.arange(len(contents)), counts)
        self.turn = np.arange(len(self.block)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = self.starts[self.block] + self.turn
        group = np.cumsum(prefix[order] < LENGTH) - 1
        of = np.empty(len(self.data), np.int64)
        of[order] = group
        # Groups of strings only, in order; suffixes at a block's end are no strings.
        self.kinds, first, self.group = np.unique(
            of[place], return_index=True, return_inverse=True
        )
        self.least = np.full(len(self.kinds), LAST_ID, np.int64)
        np.minimum.at(self.least, self.group, ids[self.block])
        self.sample = place[first]

    def strings(self) -> np.ndarray:
        """The distinct strings, sorted."""
        return np.lib.stride_tricks.sliding_window_view(self.data, LENGTH)[
            self.sample
        ].copy().view(f"S{LENGTH}")[:, 0]

    def masks(self) -> np.ndarray:
        """Per block, the strings that a document before its own least one has."""
        out = np.zeros(len(self.sizes), np.uint64)
        earlier = self.least[self.group] < self.ids[self.block]
        np.bitwise_or.at(
            out, self.block[earlier], np.uint64(1) << self.turn[earlier].astype(np.uint64)
        )
        return out


def merge_parts(parts: list[Part]) -> None:
    """Give every string the least id over all parts, by binary search in sorted strings."""
    if len(parts) < 2:
        return
    strings = [part.strings() for part in parts]
    found = [part.least.copy() for part in parts]
    for one, keys in enumerate(strings):
        for other, sorted_keys in enumerate(strings):
            if one == other:
                continue
            at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
            hit = sorted_keys[at] == keys
            found[one][hit] = np.minimum(found[one][hit], parts[other].least[at[hit]])
    for part, least in zip(parts, found):
        part.least = least


def _may_repeat(contents: list[bytes], part_bytes: int) -> np.ndarray:
    """Whether a block has a string that stands in these blocks again, or one of its hash.

    Anchors are 16 bytes and recur by chance the more the larger the corpus is; strings of
    ``LENGTH`` bytes do not. A block none of whose hashes recurs has no string to lose.
    """
    sizes = np.array([len(c) for c in contents], np.int64)
    cuts = np.unique(np.cumsum(sizes) // part_bytes, return_index=True)[1][1:]
    hashes = []
    for group in np.split(np.arange(len(contents)), cuts):
        counts = sizes[group] - LENGTH + 1
        starts = np.cumsum(sizes[group]) - sizes[group]
        place = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        data = b"".join([contents[i] for i in group])
        eight = words_at(np.frombuffer(data, np.uint8), "<u8")
        found = eight[place]
        for step in [*range(8, LENGTH - 7, 8), LENGTH - 8]:
            found = (found ^ (found >> np.uint64(32))) * ODD + eight[place + step]
        hashes.append(mix(found))
    every = np.concatenate(hashes)
    order = np.sort(every)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(again):
        return np.zeros(len(contents), bool)
    at = np.minimum(np.searchsorted(again, every), len(again) - 1)
    counts = sizes - LENGTH + 1
    return np.add.reduceat(again[at] == every, np.cumsum(counts) - counts) > 0


def _masks(contents: list[bytes], anchors: np.ndarray, ids: np.ndarray, part_bytes: int):
    """Per distinct content, the strings that a document before its least one has."""
    out = np.zeros(len(contents), np.uint64)
    _, kind, times = np.unique(anchors, return_inverse=True, return_counts=True)
    open_ones = np.flatnonzero(times[kind] > 1)
    if len(open_ones):
        open_ones = open_ones[_may_repeat([contents[i] for i in open_ones], part_bytes)]
    if not len(open_ones):
        return out
    # Blocks of one anchor stand together, so that few strings lie in two parts.
    open_ones = open_ones[np.argsort(kind[open_ones], kind="stable")]
    ends = np.cumsum([len(contents[i]) for i in open_ones])
    cuts = np.unique(ends // part_bytes, return_index=True)[1][1:]
    groups = np.split(open_ones, cuts)
    parts = [Part([contents[i] for i in group], ids[group]) for group in groups]
    merge_parts(parts)
    for group, part in zip(groups, parts):
        out[group] = part.masks()
    return out


def _judge(part_bytes: int):
    def judge(group: pa.Table) -> pa.Table:
        # The messages of all shards as one: a large corpus has many small ones a bucket.
        counts = [len(sizes) for sizes in group["sizes"].to_pylist()]
        sizes = np.frombuffer(b"".join(group["sizes"].to_pylist()), np.uint8).astype(np.int64)
        keys = np.frombuffer(b"".join(group["anchors"].to_pylist()), "<u4")
        ids = np.frombuffer(b"".join(map(_opened, group["ids"].to_pylist())), np.int64)
        data = b"".join(map(_opened, group["packed"].to_pylist()))
        ends = np.cumsum(sizes)
        starts = ends - sizes
        replies = np.zeros(len(sizes), np.uint64)
        for turn in range(TURNS):
            at = np.flatnonzero(keys % TURNS == turn)
            if not len(at):
                continue
            known: dict[bytes, int] = {}
            spans = zip(starts[at].tolist(), ends[at].tolist())
            own = np.array([known.setdefault(data[a:b], len(known)) for a, b in spans], np.int64)
            least = np.full(len(known), LAST_ID, np.int64)
            np.minimum.at(least, own, ids[at])
            anchors = np.zeros(len(known), np.uint32)
            anchors[own] = keys[at]
            contents = list(known)
            masks = _masks(contents, anchors, least, part_bytes)
            lengths = np.array([len(c) for c in contents], np.uint64)
            every = (np.uint64(1) << (lengths - np.uint64(LENGTH - 1))) - np.uint64(1)
            replies[at] = np.where(ids[at] > least[own], every[own], masks[own])
        parts = np.split(replies, np.cumsum(counts)[:-1])
        return pa.table(
            {
                "shard": group["shard"],
                "step": pa.array([2] * len(parts), pa.int32()),
                "bucket": group["bucket"],
                "masks": pa.array([_packed(part.tobytes()) for part in parts], pa.binary()),
            }
        )

    return judge


def _apply(buckets: int):
    def apply(row: pa.Table, replies: pa.Table) -> pa.Table:
        names = ("doc_id", "n_bytes", "span_starts", "span_ends", "kept")
        longs = pa.list_(pa.int64())
        types = (pa.int64(), pa.int64(), longs, longs, pa.binary())
        if not row.num_rows:
            return pa.table({n: pa.array([], t) for n, t in zip(names, types)})
        shard = _shard_of(row, buckets)
        blocks = shard.shared(_masks_of(replies, 1))
        entry, _, ids, anchors = shard.entries(blocks)
        bucket = (anchors >> np.uint64(32)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        bucket = bucket[order]
        masks = np.zeros(len(ids), np.uint64)
        for kind, packed in _masks_of(replies, 2).items():
            low, high = np.searchsorted(bucket, [kind, kind + 1])
            masks[order[low:high]] = np.frombuffer(_opened(packed), np.uint64)
        count = shard.count[blocks].astype(np.uint64)
        later = shard.ids[shard.doc[blocks]] > ids[entry]
        mask = np.where(later, (np.uint64(1) << count) - np.uint64(1), masks[entry])
        n = len(shard.data)
        starts = np.zeros(n + 1, np.int8)
        for turn in range(SPAN):
            hit = (mask >> np.uint64(turn)) & np.uint64(1) == 1
            starts[shard.first[blocks[hit]] + turn] = 1
        change = starts.astype(np.int32)
        change[LENGTH:] -= starts[:-LENGTH] if n + 1 > LENGTH else 0
        gone = np.cumsum(change)[:n] > 0
        edge = np.diff(np.concatenate([[0], gone.astype(np.int8), [0]]))
        opens = edge[:-1] == 1
        closes = edge[1:] == -1
        inner = shard.starts[(shard.starts < n) & (shard.starts > 0)]
        opens[inner] |= gone[inner]
        closes[inner - 1] |= gone[inner - 1]
        opened, closed = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        low = np.searchsorted(opened, shard.starts)
        high = np.searchsorted(opened, shard.ends)
        rows = []
        for key, start, end, a, b in zip(shard.raw_ids, shard.starts, shard.ends, low, high):
            kept = shard.data[start:end]
            if b > a:
                kept = kept[~gone[start:end]]
            rows.append((key, end - start, opened[a:b] - start, closed[a:b] - start, kept.tobytes()))
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, zip(*rows), types)})

    return apply


def remove_repeats(
    docs: DataFrame,
    shard_bytes: int = SHARD_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """doc_id, n_bytes, the removed spans and the kept bytes of each document."""
    buckets = shares(text_bytes(docs), bucket_bytes, 8)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shards = settle(texts.mapInArrow(_bundle(shard_bytes), SHARDS))
    anchors = shards.mapInArrow(_report(buckets), ANCHORS)
    seen = settle(anchors.groupBy("bucket").applyInArrow(_merge, MASKS))
    blocks = (
        shards.groupBy("shard").cogroup(seen.groupBy("shard")).applyInArrow(_send(buckets), BLOCKS)
    )
    judged = settle(blocks.groupBy("bucket").applyInArrow(_judge(part_bytes), MASKS))
    replies = seen.union(judged)
    return (
        shards.groupBy("shard")
        .cogroup(replies.groupBy("shard"))
        .applyInArrow(_apply(buckets), RESULT)
    )
