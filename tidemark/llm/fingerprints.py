"""Document fingerprints by a randomised edit embedding.

A walk reads a text character by character. At time t it writes the current character at
place t of the embedding and then, by a random bit shared by all texts and drawn for (t,
character), stays or moves on. After an edit the walks of two texts fall into step again, so
the Hamming distance of the embeddings follows the edit distance of the texts. Instead of
one step per place, the time until the bit is set is looked up, one step per character.

A fingerprint is ``SLOTS`` hexadecimal digits: slot k reads the place with the least hash
(k, place) within the embedding, so texts of nearly the same length read the same places, and
keeps four bits of a hash of place and character. The likeness of two fingerprints is the
share of equal digits, with the share that chance gives taken out.

``edit_classes`` finds texts within an edit similarity of each other. In a long text the walks
of two copies drift apart for good after enough edits, so there they start anew at anchors
(``band_keys``), and places sampled from these short embeddings make the keys by which texts
meet; the edit distance of all that meet is computed exactly.

Null text is empty; all empty texts have one fingerprint. Equal texts have equal
fingerprints whatever else is in the table. Rows that repeat an id are ordered by their
text. A null id comes first. The last document is followed by the first one; a single
document follows itself. An empty table gives an empty result. Texts are read whole; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from math import floor
from os.path import commonprefix

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import content_key, shares, slices, small, text_bytes, text_or_empty
from tidemark.llm.grouping import link_classes, near_sizes
from tidemark.llm.hashing import LOW64, ODD, mix, powers, uniform
from tidemark.session import settle

SLOTS = 128
# Keys of a document: anchors, characters of an anchor, places of a walk that may be read,
# places read, characters read there, and characters walked (a step writes a place at least).
ANCHORS, GRAM, PLACES, READS, RUN = 64, 6, 24, 2, 6
REACH = PLACES + GRAM + 1
PERIOD = 4096
THRESHOLD = 0.8
RANGE_BYTES = 16 << 20
# Characters of texts that are walked at once, and texts below which a plain loop is faster.
GROUP = 3 << 20
FEW = 48
DIGITS = np.frombuffer(b"0123456789abcdef", np.uint8)
EMPTY = 256


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    """(symbol, time modulo PERIOD) -> places written before the walk moves on."""
    seeds = np.arange(256 * PERIOD, dtype=np.uint64) * ODD + np.uint64(7)
    moves = (mix(seeds) >> np.uint64(63)).astype(bool).reshape(256, PERIOD)
    times = np.arange(2 * PERIOD)
    twice = np.where(np.concatenate([moves, moves], 1), times, 3 * PERIOD)
    following = np.minimum.accumulate(twice[:, ::-1], 1)[:, ::-1][:, :PERIOD]
    return (following - np.arange(PERIOD) + 1).astype(np.int64).reshape(-1)


@lru_cache(maxsize=1)
def _places() -> list[np.ndarray]:
    """Per slot, the places that have the least hash of all places up to them.

    The records of independent uniform numbers, drawn record by record: after a least value
    u, the next lower one comes after a geometric gap.
    """
    out = []
    for slot in range(SLOTS):
        state, place, least = slot + 1, 0, 1.0
        places = []
        while place < 1 << 48:
            places.append(place)
            state = (state + int(ODD)) & LOW64
            drawn = uniform(mix(np.array([state, state ^ 0x5851F42D4C957F2D], np.uint64)))
            least *= max(float(drawn[0]), 1e-12)
            place += 1 + int(np.log(max(1 - float(drawn[1]), 1e-300)) / np.log1p(-least))
        out.append(np.array(places, np.int64))
    return out


def _walks(texts: list[str]) -> tuple:
    """The walks over some texts, one after the other.

    Gives the code points, their symbols, the length of each text, its number of places, its
    first place, and the place at which each character is written first.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = ((points ^ (points >> 8) * np.uint32(31)) & np.uint32(255)).astype(np.uint8)
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    steps = _steps()
    times = np.empty(len(symbols), np.int64)
    order = np.argsort(-lengths, kind="stable")
    sorted_lengths, at = lengths[order], starts[order].copy()
    now = np.zeros(len(texts), np.int64)
    shared = int(sorted_lengths[FEW - 1]) if len(texts) >= FEW else 0
    active = len(texts)
    for step in range(shared):
        while sorted_lengths[active - 1] <= step:
            active -= 1
        places, time = at[:active], now[:active]
        times[places] = time
        time += steps[(symbols[places].astype(np.int64) << 12) | (time & (PERIOD - 1))]
        places += 1
    if len(texts):
        rows = _step_rows()
        for text in range(min(len(texts), max(FEW, 1))):
            first, last = int(at[text]), int(starts[order[text]] + sorted_lengths[text])
            if first < last:
                time, seen = int(now[text]), []
                for symbol in symbols[first:last].tobytes():
                    seen.append(time)
                    time += rows[symbol][time & (PERIOD - 1)]
                times[first:last] = seen
                now[text] = time
    written = np.empty(len(texts), np.int64)
    written[order] = now
    offsets = np.cumsum(written) - written
    return points, symbols, lengths, written, offsets, times + np.repeat(offsets, lengths)


def _sampled(places: np.ndarray, written: np.ndarray) -> np.ndarray:
    """The place a slot reads in each embedding: the one with the least hash of all it has."""
    return places[np.maximum(np.searchsorted(places, written) - 1, 0)]


def _digits(texts: list[str], walks: tuple) -> np.ndarray:
    _, symbols, lengths, written, offsets, world = walks
    out = np.empty((len(texts), SLOTS), np.uint8)
    full = lengths > 0
    for slot, places in enumerate(_places()):
        place = _sampled(places, written)
        read = np.full(len(texts), EMPTY, np.uint64)
        found = np.searchsorted(world, (offsets + place)[full], "right") - 1
        read[full] = symbols[found]
        key = mix(place.astype(np.uint64) * ODD + read) + np.uint64(slot)
        out[:, slot] = mix(key) >> np.uint64(60)
    return out


def fingerprints(texts: list[str]) -> np.ndarray:
    """One row of digits (0..15) per text."""
    return _digits(texts, _walks(texts))


def _anchors(hashes: np.ndarray, most: int) -> np.ndarray:
    """Places of the ``most`` least distinct hashes, each where it comes first."""
    kept = np.arange(len(hashes))
    if len(hashes) > 8 * most:
        bound = np.partition(hashes, 4 * most)[4 * most]
        least = np.flatnonzero(hashes <= bound)
        if len(np.unique(hashes[least])) >= most:
            kept = least
    _, first = np.unique(hashes[kept], return_index=True)
    return kept[first[:most]]


def band_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The keys of all texts, and for each key the number of its text.

    The walk starts anew at each anchor: the ``ANCHORS`` distinct runs of ``GRAM`` characters
    with the least hashes. A key holds an anchor and what ``READS`` places of its embedding
    read, ``RUN`` characters each; the places are drawn by the anchor. Edits elsewhere in a
    text cannot bring these walks out of step, however long the text is.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
    padded = np.concatenate([points, np.zeros(REACH + RUN, np.uint32)]).astype(np.uint64)
    lengths = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(lengths)
    grams = np.zeros(len(points), np.uint64)
    for at, weight in enumerate(powers(GRAM, int(ODD))):
        grams += (padded[at : at + len(points)] + np.uint64(1)) * weight
    grams = mix(grams)
    anchors, owner = [], []
    for text, (end, length) in enumerate(zip(ends.tolist(), lengths.tolist())):
        if length:
            # A text shorter than a run has its start as the only anchor.
            last = max(end - GRAM + 1, end - length + 1)
            found = _anchors(grams[end - length : last], ANCHORS) + (end - length)
            anchors.append(found)
            owner.append(np.full(len(found), text))
    if not anchors:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    at, owner = np.concatenate(anchors), np.concatenate(owner)
    stop = ends[owner]
    symbols = ((padded ^ (padded >> np.uint64(8)) * np.uint64(31)) & np.uint64(255)).astype(np.int64)
    steps = _steps()

    def run(start: np.ndarray, n: int) -> np.ndarray:
        held = np.zeros(len(start), np.uint64)
        for i, weight in enumerate(powers(n, int(ODD))):
            there = start + i
            held += np.where(there < stop, padded[there] + np.uint64(1), np.uint64(0)) * weight
        return held

    key = mix(run(at, GRAM))
    wanted = [
        (mix(key + np.uint64(i + 1)) % np.uint64(PLACES // READS)).astype(np.int64)
        + GRAM
        + i * (PLACES // READS)
        for i in range(READS)
    ]
    reads = [at] * READS
    now, place = np.zeros(len(at), np.int64), at.copy()
    for _ in range(REACH):
        reads = [np.where(now <= w, place, r) for w, r in zip(wanted, reads)]
        now = now + steps[(symbols[np.minimum(place, stop - 1)] << 12) | (now & (PERIOD - 1))]
        place = np.minimum(place + 1, stop)
    for read in reads:
        key = mix(key * ODD + run(read, RUN))
    return key, owner


@lru_cache(maxsize=1)
def _step_rows() -> list[bytes]:
    return [row.astype(np.uint8).tobytes() for row in _steps().reshape(256, PERIOD)]


def text_of(digits: np.ndarray) -> list[str]:
    """Hexadecimal strings of rows of digits."""
    return [row.tobytes().decode() for row in DIGITS[digits]]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal digits, 0 for what chance gives and 1 for all."""
    return np.clip(((a == b).mean(1) - 1 / 16) / (15 / 16), 0, 1)


def edited(text: str, following: str) -> str:
    """The last half of the text replaced by the start of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)
NAMES = [part.split()[0] for part in RESULT.split(", ")]


def _compare(ids: list, texts: list[str], followed: int):
    """Result columns of the first ``followed`` texts, each with the next one of the list."""
    changed = [edited(texts[i], texts[i + 1]) for i in range(followed)]
    digits = fingerprints(texts + changed)
    own, other = digits[:followed], digits[len(texts) :]
    shas = [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed]
    return [
        pa.array(ids[:followed], pa.int64()),
        pa.array([len(t) for t in texts[:followed]], pa.int64()),
        pa.array(shas, pa.string()),
        pa.array(text_of(own), pa.string()),
        pa.array(text_of(other), pa.string()),
        pa.array(likeness(own, other), pa.float64()),
        pa.array(likeness(own, digits[1 : followed + 1]), pa.float64()),
    ]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all documents of a sorted range but its last; its first and last as edges."""
    part = TaskContext.get().partitionId()
    ids, texts, size, first = [], [], 0, None

    def rows(followed):
        columns = _compare(ids, texts, followed)
        empty = [pa.nulls(followed, t) for t in (pa.string(), pa.int64(), pa.string())]
        return pa.RecordBatch.from_arrays([*columns, *empty], names=[*NAMES, "edge", "part", "text"])

    for whole in batches:
        for batch in slices(whole, 500):
            for key, text in zip(batch["doc_id"].to_pylist(), batch["text"].to_pylist()):
                first = first or (key, text)
                ids.append(key)
                texts.append(text)
                size += len(text)
                if size >= GROUP and len(texts) > 1:
                    yield rows(len(texts) - 1)
                    ids, texts, size = ids[-1:], texts[-1:], len(texts[-1])
    if first:
        if len(texts) > 1:
            yield rows(len(texts) - 1)
        edges = [first, (ids[-1], texts[-1])]
        nothing = [pa.nulls(2, t) for t in [pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in edges], pa.int64()),
                *nothing,
                pa.array(["first", "last"]),
                pa.array([part, part], pa.int64()),
                pa.array([t for _, t in edges], pa.string()),
            ],
            names=[*NAMES, "edge", "part", "text"],
        )


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last document of each range with the first one of the next."""
    for batch in batches:
        columns = (batch[n].to_pylist() for n in ("doc_id", "text", "following"))
        for key, text, following in zip(*columns):
            yield pa.RecordBatch.from_arrays(
                _compare([key], [text, following], 1), names=NAMES
            )


def compare_with_next(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    Texts are shuffled once, into ranges of ids. A range settles all its documents but the
    last, which needs the first of the next range; these two per range meet in a second step.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    parallel = docs.sparkSession.sparkContext.defaultParallelism
    parts = shares(text_bytes(docs), range_bytes, parallel)
    ordered = texts.repartitionByRange(parts, F.asc_nulls_first("doc_id")).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), "text"
    )
    walked = settle(ordered.mapInArrow(_walk, f"{RESULT}, edge string, part long, text string"))
    firsts = walked.filter("edge = 'first'").select("part", F.col("text").alias("following"))
    # Two rows per range; the order of the ranges is found without their texts.
    order = Window.orderBy("part")
    parts_only = firsts.select("part")
    least = parts_only.agg(F.min("part")).first()[0]
    nexts = parts_only.select(
        "part", F.coalesce(F.lead("part").over(order), F.lit(least).cast("long")).alias("next")
    )
    lasts = walked.filter("edge = 'last'").select("doc_id", "part", "text")
    met = (
        lasts.join(nexts, "part")
        .join(firsts.withColumnRenamed("part", "next"), "next")
        .select("doc_id", "text", "following")
        .mapInArrow(_meet, RESULT)
    )
    return walked.filter("edge is null").select(*NAMES).unionByName(met)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row without its text, with the keys of the text."""
    for whole in batches:
        for batch in slices(whole, 500):
            texts = batch["text"].to_pylist()
            keys, owner = band_keys(texts)
            places = np.searchsorted(owner, np.arange(len(texts) + 1))
            buckets = pa.ListArray.from_arrays(
                pa.array(places, pa.int32()), pa.array(keys.view(np.int64))
            )
            kept = [batch[n] for n in ("doc_id", "key_a", "key_b", "n_chars")]
            yield pa.RecordBatch.from_arrays(
                [*kept, buckets], names=["doc_id", "key_a", "key_b", "n_chars", "buckets"]
            )


def within(a: str, b: str, most: int) -> bool:
    """Whether the edit distance of two texts is at most ``most``.

    A column of the distance matrix is held as two whole numbers, the bits of its steps up
    and down, so a character of ``b`` costs a few operations on len(a) bits. It ends as soon
    as even equal characters from here on leave too many edits.
    """
    if abs(len(a) - len(b)) > most:
        return False
    same = len(commonprefix((a, b)))
    a, b = a[same:], b[same:]
    same = len(commonprefix((a[::-1], b[::-1])))
    a, b = a[: len(a) - same], b[: len(b) - same]
    if not a or not b:
        return max(len(a), len(b)) <= most
    size, points = len(a), np.frombuffer(a.encode("utf-32-le", "surrogatepass"), "<u4")
    masks = {
        chr(c): int.from_bytes(np.packbits(points == c, bitorder="little").tobytes(), "little")
        for c in np.unique(points).tolist()
    }
    full = (1 << size) - 1
    up, down, distance, left = full, 0, size, len(b)
    for char in b:
        equal = masks.get(char, 0)
        across = ((((equal & up) + up) ^ up) | equal) & full
        rise = down | (full ^ (across | up))
        fall = up & across
        # The top bit says how the last row changes.
        if rise.bit_length() == size:
            distance += 1
        elif fall.bit_length() == size:
            distance -= 1
        left -= 1
        if distance - left > most:
            return False
        rise = (rise << 1 | 1) & full
        down_or_equal = equal | down
        up = (fall << 1) & full | (full ^ (down_or_equal | rise))
        down = rise & down_or_equal
    return distance <= most


def near(a: str, b: str, threshold: float) -> bool:
    """Whether 1 - distance / length of the longer text reaches the threshold."""
    return within(a, b, floor((1 - threshold) * max(len(a), len(b)) + 1e-9))


def edit_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id: groups of documents that are linked by a small edit distance.

    Documents that share a key of ``band_keys`` are verified by their edit similarity. The
    class id is the least id of the group. Equal texts are one class, empty ones (and null,
    which is read as empty) too. Rows that repeat an id are judged row by row, each by its
    text. A null id is one like any other, but names a class only if the group has no other.
    An empty table gives an empty result.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    size = F.char_length("text").cast("long").alias("n_chars")
    keyed = texts.select("doc_id", "text", *content_key(F.col("text")), size)
    schema = "doc_id long, key_a long, key_b long, n_chars long, buckets array<long>"
    marked = settle(keyed.mapInArrow(_keyed, schema))
    # One node per text; all rows of a text have the same keys.
    kinds = settle(
        marked.groupBy("key_a", "key_b", "n_chars")
        .agg(F.min("doc_id").alias("first_doc"), F.first("buckets").alias("buckets"))
        .withColumn("node", F.monotonically_increasing_id())
    )
    nodes = kinds.select("node", F.col("n_chars").alias("size"), F.lit(0).alias("mark"))
    members = kinds.select("node", F.explode("buckets").alias("bucket"))

    def load(wanted: DataFrame) -> DataFrame:
        """The texts of these nodes, each from one row of its first document."""
        asked = settle(
            kinds.join(small(wanted), "node", "semi").select(
                "node", "key_a", "key_b", F.col("first_doc").alias("_in")
            )
        )
        here = F.col("doc_id").eqNullSafe(F.col("_in"))
        found = keyed.join(small(asked), ["key_a", "key_b"]).filter(here)
        return settle(found.select("node", "text").dropDuplicates(["node"]))

    def verify(pairs: DataFrame, content: DataFrame) -> DataFrame:
        first = content.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
        second = content.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
        joined = pairs.join(first, "a").join(second, "b")

        def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist())
                good = pa.array([near(x, y, threshold) for x, y in texts], pa.bool_())
                yield batch.select(["a", "b"]).filter(good)

        return joined.mapInArrow(similar, "a long, b long")

    roots = link_classes(nodes, members, near_sizes(threshold), load, verify)
    rooted = kinds.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = rooted.groupBy("root").agg(F.min("first_doc").alias("class_id"))
    known = rooted.select("root", "key_a", "key_b").join(named, "root")
    return marked.join(known, ["key_a", "key_b"]).select("doc_id", "class_id")
