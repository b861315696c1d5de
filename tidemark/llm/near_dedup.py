"""MinHash near-duplicates: BagMinHash signatures, banding and exact verification.

A document is the multiset of its runs of five words (lower case, split at white space; one
run of all words if there are fewer). A run with weight w owns the levels 1..w. The levels
are cut into the blocks (0,1], (1,2], (2,4], (4,8] and so on; each block of a run is a
Poisson process whose rate is its width, and each of its points has a time, a register and a
level, all drawn from hashes of the run, so equal runs of two documents have equal points. A
register keeps the earliest point at a level that the document owns; two registers agree
with the probability of the weighted Jaccard similarity. A process is stopped once its time
exceeds all registers, so after the registers are filled most runs cost one point.

Documents that share a band are candidates; their exact multisets decide (``THRESHOLD``).
Classes are connected groups of similar documents; the class id is the least id in it.
Documents with the same words are one class through a digest and are sketched as one.

A document without words (null, empty or white text) is a class of its own. Rows that repeat
an id are judged row by row, each by its text. A null id gets a null class and groups
nothing. An empty table gives an empty result. Other columns are ignored. Texts are read
whole; a very long one only makes its own arrays longer.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small
from tidemark.llm.grouping import link_classes, near_sizes
from tidemark.llm.hashing import LOW64, ODD, mix, powers, uniform
from tidemark.session import settle

RUN = 5
THRESHOLD = 0.8
BANDS = 20
PER_BAND = 5
REGISTERS = BANDS * PER_BAND
# Hash classes of runs in the bound on what two documents have in common.
RUN_CLASSES = 64
# Characters per group of documents that is sketched at once.
GROUP = 1 << 19


def runs_of(texts: list[str], run: int = RUN) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of words; texts are words joined by single spaces."""
    data = np.frombuffer((" ".join(texts) + " ").encode(), np.uint8)
    power = powers(len(data) + 1, int(ODD))
    inverse = powers(len(data) + 1, pow(int(ODD), -1, 1 << 64))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[:-1], out=sums[1:])
    ends = np.flatnonzero(data == 32)  # the end of each word
    starts = np.concatenate([[0], ends[:-1] + 1])
    words = np.array([t.count(" ") + 1 for t in texts], np.int64)
    last = np.repeat(np.cumsum(words), words)  # one past the last word of the document
    doc = np.repeat(np.arange(len(texts)), words)
    place = np.arange(len(ends))
    first = last - np.repeat(words, words)
    # A run starts at every word with enough words after it, or at the only start there is.
    begins = (place + run <= last) | (place == first)
    place, doc, last = place[begins], doc[begins], last[begins]
    stop = ends[np.minimum(place + run, last) - 1]
    start = starts[place]
    return doc, mix((sums[stop] - sums[start]) * inverse[start])


def signatures(doc: np.ndarray, run: np.ndarray, docs: int, registers: int = REGISTERS):
    """BagMinHash: earliest times by document and register, and total weights."""
    kinds, at, weight = np.unique(
        mix(run + doc.astype(np.uint64) * ODD), return_index=True, return_counts=True
    )
    doc, run = doc[at], run[at]
    total = np.bincount(doc, weight, docs).astype(np.int64)
    out = np.full((docs, registers), np.inf)
    flat = out.reshape(-1)
    parts = []
    for block in range(int(weight.max(initial=0)).bit_length() + 1):
        low, width = (0, 1) if block == 0 else (1 << (block - 1), 1 << (block - 1))
        own = np.flatnonzero(weight > low)
        if len(own):
            state = mix(run[own] + np.uint64((block + 1) * int(ODD) & LOW64))
            owned = np.minimum(weight[own] - low, width)
            parts.append((doc[own], state, np.full(len(own), width), owned))
    if not parts:
        return out, total
    doc, state, width, owned = (np.concatenate(x) for x in zip(*parts))
    time, latest = np.zeros(len(doc)), np.full(docs, np.inf)
    while len(doc):
        state = state + ODD
        drawn = mix(state)
        time = time - np.log1p(-uniform(drawn)) / width
        more = mix(drawn ^ ODD)
        register = ((more >> np.uint64(32)) * np.uint64(registers)) >> np.uint64(32)
        hits = time <= latest[doc]
        level = (more & np.uint64(0xFFFFFFFF)) * width.astype(np.uint64) >> np.uint64(32)
        kept = hits & (level.astype(np.int64) < owned)
        np.minimum.at(flat, doc[kept] * registers + register[kept].astype(np.int64), time[kept])
        busy = np.unique(doc[kept])
        latest[busy] = out[busy].max(1)
        going = time <= latest[doc]
        doc, state, width, owned, time = (x[going] for x in (doc, state, width, owned, time))
    return out, total


def bands(signature: np.ndarray, count: int = BANDS) -> np.ndarray:
    """One 64-bit key per band of registers."""
    bits = signature.view(np.uint64).reshape(len(signature), count, -1)
    keys = np.arange(1, count + 1, dtype=np.uint64)[None, :] * ODD
    keys = np.repeat(keys, len(signature), axis=0)
    for column in range(bits.shape[2]):
        keys = mix(keys + bits[:, :, column] * ODD)
    return keys.view(np.int64)


def _groups(texts: list[str]) -> Iterator[range]:
    start, size = 0, 0
    for place, text in enumerate(texts):
        size += len(text)
        if size >= GROUP:
            yield range(start, place + 1)
            start, size = place + 1, 0
    if start < len(texts):
        yield range(start, len(texts))


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for batch in slices(whole, 2000):
            texts = [normal(t) for t in batch["text"].to_pylist()]
            for group in _groups(texts):
                full = [texts[i] for i in group if texts[i]]
                keys, totals = np.zeros((0, BANDS), np.int64), []
                if full:
                    signature, totals = signatures(*runs_of(full), len(full))
                    keys = bands(signature)
                place = iter(range(len(full)))
                rows = [next(place) if texts[i] else None for i in group]
                digests = [
                    texts[i] and hashlib.blake2b(texts[i].encode(), digest_size=16).digest()
                    for i in group
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(group.start, len(group)),
                        pa.array([d or None for d in digests], pa.binary()),
                        pa.array([None if r is None else int(totals[r]) for r in rows], pa.int64()),
                        pa.array(
                            [None if r is None else keys[r] for r in rows], pa.list_(pa.int64())
                        ),
                    ],
                    names=["doc_id", "digest", "size", "keys"],
                )


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, digest of the words, number of runs, and the key of each band."""
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return asked.mapInArrow(_sketch, "doc_id long, digest binary, size long, keys array<long>")


def bag(text: str, run: int = RUN) -> Counter:
    """The multiset of runs of words."""
    words = text.lower().split()
    if len(words) < run:
        return Counter([tuple(words)] if words else [])
    return Counter(zip(*(words[i:] for i in range(run))))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    both = sum(min(n, large[k]) for k, n in small.items() if k in large)
    return both / ((a.total() + b.total() - both) or 1)


def _verified(threshold: float):
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_bag = None, None
        for batch in batches:
            keep = []
            for a, b in zip(batch["text_a"].to_pylist(), batch["text_b"].to_pylist()):
                if a != last:
                    last, last_bag = a, bag(a)
                keep.append(similarity(last_bag, bag(b)) >= threshold)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return check


def _distinct_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's distinct runs with their weights."""
    for whole in batches:
        for batch in slices(whole, 200):
            texts = [normal(t) for t in batch["text"].to_pylist()]
            for group in _groups(texts):
                own = [i for i in group if texts[i]]
                if not own:
                    continue
                doc, run = runs_of([texts[i] for i in own])
                order = np.lexsort((run, doc))
                doc, run = doc[order], run[order]
                new = np.ones(len(doc), bool)
                new[1:] = (doc[1:] != doc[:-1]) | (run[1:] != run[:-1])
                at = np.flatnonzero(new)
                ids = batch["doc_id"].to_numpy()[np.array(own)[doc[at]]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids),
                        pa.array(run[at].view(np.int64)),
                        pa.array(np.diff(np.append(at, len(doc)))),
                    ],
                    names=["node", "run", "weight"],
                )


def _partnered(threshold: float):
    """Nodes that can reach the threshold with another one of the given nodes, with marks.

    A mark counts, per hash class of runs, the weight of the runs that another node has too.
    The classwise minima of two marks add up to the most the two can have in common, and a
    similarity of t needs t / (1 + t) of both sizes in common. Nothing that could reach the
    threshold is left out; hashes that collide only keep more.
    """

    def possible(size: Column, mark: Column, other: Column, other_mark: Column) -> Column:
        common = F.aggregate(
            F.zip_with(mark, other_mark, lambda one, two: F.least(one, two)),
            F.lit(0).cast("long"),
            lambda total, least: total + least,
        )
        return common >= threshold / (1 + threshold) * (size + other) - 1e-6

    def keep(nodes: DataFrame, content: DataFrame) -> tuple:
        texts = content.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "semi")
        runs = settle(texts.mapInArrow(_distinct_runs, "node long, run long, weight long"))
        shared = (
            runs.groupBy("run")
            .agg(F.min("node").alias("low"), F.max("node").alias("high"))
            .filter("low <> high")
            .select("run")
        )
        whole = runs.groupBy("node").agg(F.sum("weight").alias("size"))
        kind = F.pmod("run", F.lit(RUN_CLASSES))
        parts = [
            F.sum(F.when(kind == place, F.col("weight")).otherwise(0)) for place in range(RUN_CLASSES)
        ]
        common = runs.join(shared, "run").groupBy("node").agg(
            F.sum("weight").alias("common"), F.array(*parts).alias("mark")
        )
        marked = common.join(whole, "node")
        reach = F.col("common") >= threshold * F.col("size") - 1e-6
        return marked.filter(reach).drop("common"), possible

    return keep


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, class_id and n_runs of each row."""
    sketched = settle(sketches(docs))
    kinds = settle(
        sketched.filter("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("size").alias("size"), F.first("keys").alias("keys"))
    )
    nodes = kinds.groupBy("node").agg(F.min("size").alias("size"), F.lit(0).alias("mark"))
    members = kinds.select("node", F.explode("keys").alias("bucket"))

    def load(nodes: DataFrame) -> DataFrame:
        ids = small(nodes).withColumnRenamed("node", "doc_id")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return settle(texts.filter("text is not null").join(ids, "doc_id", "semi"))

    def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        first = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        second = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        joined = pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b")
        return joined.mapInArrow(_verified(threshold), "a long, b long").distinct()

    roots = link_classes(
        nodes, members, near_sizes(threshold), load, verify, _partnered(threshold)
    )
    named = kinds.select("digest", "node").join(roots, "node", "left").select(
        "digest", F.coalesce("root", "node").alias("class_id")
    )
    return sketched.join(named, "digest", "left").select(
        "doc_id",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("class_id", "doc_id")).alias("class_id"),
        F.coalesce("size", F.lit(0)).alias("n_runs"),
    )


def drop_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One document of each class, the one with the least id; all columns kept.

    Of rows that share that id each different text stays once.
    """
    found = classes(docs, threshold)
    firsts = found.filter("doc_id = class_id").select(F.col("doc_id").alias("_first")).distinct()
    kept = docs.join(firsts, docs["doc_id"] == firsts["_first"], "semi")
    texts = kept.withColumn("_td_digest", F.sha2("text", 256))
    once = texts.dropDuplicates(["doc_id", "_td_digest"]).drop("_td_digest")
    return once.unionByName(docs.filter("doc_id is null"))
