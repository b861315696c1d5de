"""Alignment of two tokenizers over the same bytes, by galloping intersection.

A text is encoded by a byte-level BPE file (A) and a piece model (B), and each side becomes the
ascending list of byte offsets where its tokens end. Per text the shorter list drives: from the
place where it should be, each of its ends goes through the longer list by steps that double,
then by halving. All texts of an Arrow batch are searched in step, as their offsets follow each
other. Common ends cut both sides into groups; a token's overlap range on the other side is the
difference of two ranks.

The counts of linked id pairs go to all tasks at once. Their number has a proven bound: two
tokens that end together share their last bytes, so one is a suffix of the other, and the two
vocabularies hold a fixed number of such pairs (``pair_bound``), whatever the corpus.

Null and empty texts, and texts whose tokens do not spell space+text again (the piece model
may replace or drop characters), have no tokens: their lists are empty and their digests zero.
Rows are judged one by one, repeated rows and ids as well; a null id stays null. Equal counts
all are the best of their B id. An empty table gives an empty result. Other columns of the
input are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices
from tidemark.llm.tokens import encoder, has_long_run
from tidemark.session import settle

BYTE_LEVEL = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
ROWS = 500  # texts that one step of a task holds

ALIGNED = "doc_id long, ids_a array<int>, ids_b array<int>, sizes_a array<int>, sizes_b array<int>"


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes in ascending order for
    the characters from 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [byte for byte in range(256) if byte not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    """A piece in UTF-8, its space sign as a space, ``<0xHH>`` as that byte."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class ByteLevel:
    """Ids and token bytes of the byte-level file; special strings are plain text."""

    def __init__(self, name: str):
        import public_tokenizers
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
        self.tokenizer.encode_special_tokens = True
        self.ranked = encoder(name).ranked
        byte_of, count = byte_alphabet(), self.tokenizer.get_vocab_size()
        entries = [self.tokenizer.id_to_token(place) or "" for place in range(count)]
        self.bytes = [
            bytes(byte_of[c] for c in entry) if all(c in byte_of for c in entry) else entry.encode()
            for entry in entries
        ]

    def ids(self, text: str) -> list[int]:
        if self.ranked is None or has_long_run(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.ranked.encode_ordinary(text)


class Pieces:
    """Ids and token bytes of the piece model."""

    def __init__(self, name: str):
        import public_tokenizers
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.bytes = [
            piece_bytes(self.model.id_to_piece(place)) for place in range(self.model.vocab_size())
        ]

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text, num_threads=1)


@lru_cache(maxsize=2)
def sides(a: str = BYTE_LEVEL, b: str = PIECES) -> tuple[ByteLevel, Pieces]:
    """Both sides, once per Python worker."""
    return ByteLevel(a), Pieces(b)


def pair_bound(a: str = BYTE_LEVEL, b: str = PIECES) -> int:
    """How many id pairs can be linked at all: one's bytes are a suffix of the other's."""
    left, right = (side.bytes for side in sides(a, b))

    def longer(tokens, others, least):
        known: dict[bytes, int] = {}
        for token in others:
            known[token] = known.get(token, 0) + 1
        return sum(
            known.get(token[start:], 0) for token in tokens for start in range(least, len(token))
        )

    return longer(left, right, 0) + longer(right, left, 1)


def gallop(driver: np.ndarray, other: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """The place in ascending ``other`` of the first value not below each of ``driver``.

    From ``guess`` on in doubling steps, to the side where the place must be, then by halving.
    """
    count = len(other)
    at = np.clip(guess, 0, count - 1)
    up = other[at] < driver
    low, high = np.where(up, at + 1, 0), np.where(up, count, at)
    active, step = np.arange(len(driver)), 1
    while active.size:
        probe = np.where(up[active], at[active] + step, at[active] - step)
        inside = (probe >= 0) & (probe < count)
        active, probe = active[inside], probe[inside]
        below = other[probe] < driver[active]
        low[active[below]] = probe[below] + 1
        high[active[~below]] = probe[~below]
        active, step = active[below == up[active]], step * 2
    active = np.flatnonzero(low < high)
    while active.size:
        middle = (low[active] + high[active]) // 2
        below = other[middle] < driver[active]
        low[active[below]] = middle[below] + 1
        high[active[~below]] = middle[~below]
        active = active[low[active] < high[active]]
    return low


def _within(counts: np.ndarray) -> np.ndarray:
    """0, 1, 2, ... within each list of these lengths."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def common_ends(
    ends_a: np.ndarray, counts_a: np.ndarray, ends_b: np.ndarray, counts_b: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Places in A and in B of the ends that both have, ascending.

    The lists of several texts follow each other: ``counts`` has their lengths, and the offsets
    go on from text to text. Each text is driven by its shorter list.
    """
    if not len(ends_a) or not len(ends_b):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    a_drives = counts_a <= counts_b
    found = []
    for chosen, ends, counts, other, others in (
        (a_drives, ends_a, counts_a, ends_b, counts_b),
        (~a_drives, ends_b, counts_b, ends_a, counts_a),
    ):
        mine = np.flatnonzero(np.repeat(chosen, counts))
        start = np.cumsum(others) - others
        per_text = np.maximum(counts[chosen], 1)
        share = _within(counts[chosen]) * np.repeat(others[chosen], counts[chosen])
        guess = np.repeat(start[chosen], counts[chosen]) + share // np.repeat(
            per_text, counts[chosen]
        )
        place = gallop(ends[mine], other, guess)
        hit = place < len(other)
        hit[hit] = other[place[hit]] == ends[mine][hit]
        found.append((mine[hit], place[hit]))
    (in_a, in_b), (also_b, also_a) = found
    return np.sort(np.concatenate([in_a, also_a])), np.sort(np.concatenate([in_b, also_b]))


def overlap_ranges(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each A token the first B token that shares a byte with it, and the one after the last.

    The first follows the B ends up to the token's start; the last is the first B end that is
    not before the token's own end: two ranks.
    """
    if not len(ends_a) or not len(ends_b):
        return np.zeros(len(ends_a), np.int64), np.zeros(len(ends_a), np.int64)
    guess = np.arange(len(ends_a)) * len(ends_b) // len(ends_a)
    starts = np.concatenate([[0], ends_a[:-1]])
    first = gallop(starts + 1, ends_b, guess)
    return first, np.minimum(gallop(ends_a, ends_b, guess) + 1, len(ends_b))


def spelled(text: str | None, left: ByteLevel, right: Pieces) -> tuple[list[int], list[int]]:
    """The ids of both sides; none where a side does not spell space+text."""
    if not text:
        return [], []
    whole = " " + text
    want = whole.encode()
    ids_b = right.ids(text)
    if b"".join(map(right.bytes.__getitem__, ids_b)) != want:
        return [], []
    ids_a = left.ids(whole)
    if b"".join(map(left.bytes.__getitem__, ids_a)) != want:
        return [], []
    return ids_a, ids_b


def _lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.concatenate([np.empty(0, np.int64), *(np.array(x, np.int64) for x in lists)]), counts


def _group_sizes(common: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each group, and groups of each text."""
    starts = np.cumsum(counts) - counts
    groups = np.searchsorted(common, starts + counts) - np.searchsorted(common, starts)
    return np.diff(common, prepend=-1), groups


def _align(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left, right = sides(a, b)
        length_a = np.fromiter(map(len, left.bytes), np.int64)
        length_b = np.fromiter(map(len, right.bytes), np.int64)
        for whole in batches:
            for batch in slices(whole, ROWS):
                both = [spelled(text, left, right) for text in batch["text"].to_pylist()]
                ids_a, counts_a = _flat([ids for ids, _ in both])
                ids_b, counts_b = _flat([ids for _, ids in both])
                # Both sides of a text have the same bytes, so the offsets stay in step.
                at_a, at_b = common_ends(
                    np.cumsum(length_a[ids_a]), counts_a, np.cumsum(length_b[ids_b]), counts_b
                )
                sizes_a, groups = _group_sizes(at_a, counts_a)
                sizes_b, _ = _group_sizes(at_b, counts_b)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"],
                        _lists(ids_a, counts_a),
                        _lists(ids_b, counts_b),
                        _lists(sizes_a, groups),
                        _lists(sizes_b, groups),
                    ],
                    names=["doc_id", "ids_a", "ids_b", "sizes_a", "sizes_b"],
                )

    return run


def align(docs: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """doc_id, the ids of both sides, and how many of them each group has (``sizes``)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_align(a, b), ALIGNED)


class _Batch:
    """The lists of an aligned batch as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        self.counts, self.flat = {}, {}
        for name in ("ids_a", "ids_b", "sizes_a", "sizes_b"):
            column = batch[name]
            self.counts[name] = column.value_lengths().to_numpy().astype(np.int64)
            self.flat[name] = column.flatten().to_numpy().astype(np.int64)
        self.last_a = np.cumsum(self.flat["sizes_a"]) - 1
        self.last_b = np.cumsum(self.flat["sizes_b"]) - 1

    def linked(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the tokens that end together."""
        return self.flat["ids_a"][self.last_a], self.flat["ids_b"][self.last_b]


def _number_type(a: str, b: str) -> str:
    """The narrowest type that holds the number of an id pair."""
    left, right = sides(a, b)
    return "<u4" if len(left.bytes) * len(right.bytes) < 1 << 32 else "<u8"


def group_texts(batch: _Batch, marks: np.ndarray, size_a: int) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` of each text. ``marks`` has the four written forms of all ids."""
    sizes_a, sizes_b = batch.flat["sizes_a"], batch.flat["sizes_b"]
    ids_a, ids_b = batch.flat["ids_a"], batch.flat["ids_b"]
    ends_a, ends_b = np.zeros(len(ids_a), np.int64), np.zeros(len(ids_b), np.int64)
    ends_a[batch.last_a] = 1
    ends_b[batch.last_b] = 1
    # An A token comes after the B tokens of earlier groups, a B token after all A tokens so far.
    before_a = np.repeat(batch.last_b + 1 - sizes_b, sizes_a)
    before_b = np.repeat(batch.last_a + 1, sizes_b)
    written = np.empty(len(ids_a) + len(ids_b), np.int64)
    written[np.arange(len(ids_a)) + before_a] = 2 * ids_a + ends_a
    written[np.arange(len(ids_b)) + before_b] = 2 * (size_a + ids_b) + ends_b
    texts, start = marks[written], 0
    for end in np.cumsum(batch.counts["ids_a"] + batch.counts["ids_b"]).tolist():
        yield "".join(texts[start:end])[:-1]
        start = end


def _marks(size_a: int, size_b: int) -> np.ndarray:
    a_forms = (f"{place}{sign}" for place in range(size_a) for sign in ",|")
    b_forms = (f"{place}{sign}" for place in range(size_b) for sign in ",;")
    return np.array([*a_forms, *b_forms], object)


SUMMARY = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
DIGESTS = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
    "groups_sha256 string"
)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def _summary(a: str, b: str, kind: str):
    align_batches = _align(a, b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size_a, size_b = (len(side.bytes) for side in sides(a, b))
        marks = _marks(size_a, size_b)
        for rows in align_batches(batches):
            batch = _Batch(rows)
            ids_a, ids_b = batch.linked()
            numbers = (ids_a * size_b + ids_b).astype(kind)
            groups = batch.counts["sizes_a"]
            ends = np.cumsum(groups)
            hashed = [
                hashlib.sha256(text.encode()).hexdigest() if text else ""
                for text in group_texts(batch, marks, size_a)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    rows["doc_id"],
                    pa.array(batch.counts["ids_a"]),
                    pa.array(batch.counts["ids_b"]),
                    pa.array(groups),
                    pa.array(hashed, pa.string()),
                    pa.array(
                        [numbers[e - n : e].tobytes() for e, n in zip(ends, groups)], pa.binary()
                    ),
                ],
                names=_names(SUMMARY),
            )

    return run


def summaries(docs: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """Of each row the sizes and a checksum of its alignment, and the numbers of its links.

    The alignment is summed up in the task that makes it; its lists never leave Python. The
    number of a linked pair is the A id times the size of B's vocabulary plus the B id.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_summary(a, b, _number_type(a, b)), SUMMARY)


def _numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """The pair numbers of all rows, and how many each row has."""
    counts = pc.binary_length(column).to_numpy() // np.dtype(kind).itemsize
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, kind).astype(np.int64), counts.astype(np.int64)


def _count_pairs(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 4 * ROWS):
                pairs, n = np.unique(_numbers(batch["links"], kind)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs), pa.array(n, pa.int64())], names=["pair", "n"]
                )

    return run


def pair_counts(summed: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """pair and n, how many links of the corpus it is; at most ``pair_bound`` rows."""
    partial = summed.select("links").mapInArrow(
        _count_pairs(_number_type(a, b)), "pair long, n long"
    )
    return partial.groupBy("pair").agg(F.sum("n").alias("n"))


def _digests(pairs: np.ndarray, counts: np.ndarray, best: np.ndarray, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for rows in slices(whole, ROWS):
                numbers, links = _numbers(rows["links"], kind)
                place, ends = np.searchsorted(pairs, numbers), np.cumsum(links)

                def per_row(values, ends=ends, links=links):
                    total = np.concatenate([[0], np.cumsum(values)])
                    return pa.array(total[ends] - total[ends - links])

                yield pa.RecordBatch.from_arrays(
                    [
                        *(rows[name] for name in ("doc_id", "n_a", "n_b", "n_groups")),
                        pa.array(links),
                        per_row(best[place].astype(np.int64)),
                        per_row(counts[place]),
                        rows["groups_sha256"],
                    ],
                    names=_names(DIGESTS),
                )

    return run


def digests(docs: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """Counts and a checksum of the alignment of each row, and how usual its links are.

    The summaries are written once and read twice: for the corpus-wide counts and for the rows.
    """
    summed = settle(summaries(docs, a, b))
    # At most ``pair_bound`` rows, whatever the corpus.
    table = pair_counts(summed, a, b).toPandas().sort_values("pair")
    pairs, counts = (table[name].to_numpy(np.int64) for name in ("pair", "n"))
    size_b = len(sides(a, b)[1].bytes)
    highest = np.zeros(size_b, np.int64)
    np.maximum.at(highest, pairs % size_b, counts)
    run = _digests(pairs, counts, counts == highest[pairs % size_b], _number_type(a, b))
    return summed.mapInArrow(run, DIGESTS)


def _overlaps(a: str, b: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length_a, length_b = (
            np.fromiter(map(len, side.bytes), np.int64) for side in sides(a, b)
        )
        for whole in batches:
            for rows in slices(whole, ROWS):
                batch = _Batch(rows)
                first, after = overlap_ranges(
                    np.cumsum(length_a[batch.flat["ids_a"]]),
                    np.cumsum(length_b[batch.flat["ids_b"]]),
                )
                counts, others = batch.counts["ids_a"], batch.counts["ids_b"]
                start = np.repeat(np.cumsum(others) - others, counts)
                yield pa.RecordBatch.from_arrays(
                    [rows["doc_id"], _lists(first - start, counts), _lists(after - start, counts)],
                    names=["doc_id", "first_b", "after_b"],
                )

    return run


def overlaps(aligned: DataFrame, a: str = BYTE_LEVEL, b: str = PIECES) -> DataFrame:
    """doc_id and, for each A token of the row, the range of B tokens that share bytes with it."""
    return aligned.mapInArrow(
        _overlaps(a, b), "doc_id long, first_b array<int>, after_b array<int>"
    )
