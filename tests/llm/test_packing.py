import random
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tidemark.llm import packing, queries
from tidemark.llm.tokens import encoder


def best_fit(lengths, window):
    """One piece at a time: the tightest window that still holds it."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [(room, at) for at, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits)[1]] -= length
        else:
            rooms.append(window - length)
    return sorted(rooms)


@pytest.mark.parametrize("seed", range(8))
def test_plan_is_best_fit_decreasing(seed):
    drawn = random.Random(seed)
    window = drawn.choice([8, 16, 100])
    lengths = [drawn.randint(1, window) for _ in range(drawn.randint(0, 300))]
    placements, fills = packing.plan(Counter(lengths), window)
    rooms = {}
    counts = Counter(lengths)
    for number, (length, rank, first, offset) in enumerate(placements.tolist()):
        after = placements[number + 1] if number + 1 < len(placements) else None
        last = after[1] if after is not None and after[0] == length else counts[length]
        for sequence in range(first, first + last - rank):
            rooms.setdefault(sequence, []).append((offset, length))
    for pieces in rooms.values():
        ends = 0
        for offset, length in sorted(pieces):
            assert offset == ends
            ends += length
        assert ends <= window
    found = sorted(window - sum(n for _, n in pieces) for pieces in rooms.values())
    assert found == best_fit(lengths, window)
    assert sorted(rooms) == list(range(len(rooms)))
    starts = fills[:, 0]
    for sequence, pieces in rooms.items():
        at = np.searchsorted(starts, sequence, "right") - 1
        assert fills[at, 1] == sum(n for _, n in pieces)


def test_rooms_find_the_tightest():
    drawn = random.Random(2)
    rooms, held = packing.Rooms(64), Counter()
    for _ in range(2000):
        room = drawn.randint(0, 64)
        if drawn.random() < 0.5:
            rooms.add(room, 0, 1)
            held[room] += 1
        elif held[room]:
            rooms.take(room, 1)
            held[room] -= 1
        least = drawn.randint(0, 64)
        assert rooms.tightest(least) == min((r for r in held if held[r] and r >= least), default=None)


def check(rows, documents):
    encode = encoder(packing.VOCABULARY).ids
    left = Counter()
    for text in documents:
        ids = np.array([*encode(text or ""), 0], "<u4")
        left[zlib.crc32(ids.tobytes()), len(ids)] += 1
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        end = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == end and 0 < p.length <= 1024
            end += p.length
        assert end <= 1024
        padded = end if end & (end - 1) == 0 else 1024
        assert {(p.sequence_tokens, p.padded_tokens) for p in pieces} == {(end, padded)}
    assert sum(r.length for r in rows) == sum(n * c for (_, n), c in left.items())


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op1_packing"](spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    check(rows, docs.values())
    encode = encoder(packing.VOCABULARY).ids
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc, text in docs.items():
        ids, at = np.array([*encode(text), 0], "<u4"), 0
        for p in sorted(by_doc[doc], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = packing.pack(docs).collect()
    check(rows, [r.text for r in docs.collect()])


def test_sequences_hold_the_ids(spark):
    docs = cases.documents(spark, [cases.prose(i, 400) for i in range(6)])
    packed = packing.pack(docs, window=64)
    made = packing.sequences(packed).collect()
    tokens = b"".join(p.ids for s in made for p in s.pieces)
    assert all(sum(p.length for p in s.pieces) == s.sequence_tokens for s in made)
    want = Counter()
    for r in docs.collect():
        want.update([*encoder(packing.VOCABULARY).ids(r.text), 0])
    assert Counter(np.frombuffer(tokens, "<u4").tolist()) == want


def test_empty_table(spark):
    assert packing.pack(cases.empty(spark)).count() == 0
