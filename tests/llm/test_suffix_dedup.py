import hashlib
import random

import cases
import numpy as np
import pytest

from tidemark.llm import queries, suffix_dedup


def brute(rows, length=suffix_dedup.LENGTH):
    """(id, bytes, removed flags) of each row, by a dictionary of all strings."""
    first = {}
    key = lambda i: suffix_dedup.LAST_ID if i is None else i
    for doc, data in rows:
        for at in range(len(data) - length + 1):
            string = data[at : at + length]
            first[string] = min(first.get(string, key(doc)), key(doc))
    out = []
    for doc, data in rows:
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - length + 1):
            if first[data[at : at + length]] < key(doc):
                gone[at : at + length] = True
        out.append((doc, data, gone))
    return out


def as_rows(found):
    return sorted((str(r.doc_id), r.n_bytes, r.span_starts, r.span_ends, bytes(r.kept)) for r in found)


def expected(rows):
    out = []
    for doc, data, gone in brute(rows):
        edge = np.diff(np.concatenate([[0], gone.astype(int), [0]]))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if data else b""
        starts, ends = np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist()
        out.append((str(doc), len(data), starts, ends, kept))
    return sorted(out)


@pytest.mark.parametrize("seed", range(4))
def test_against_all_strings(spark, seed):
    drawn = random.Random(seed)
    letters = ["ab", "abcdefgh ", "é漢a", "a"][seed]
    pool = ["".join(drawn.choices(letters, k=drawn.randint(30, 200))) for _ in range(8)]
    rows = []
    for n in range(60):
        parts = [
            drawn.choice(pool)[drawn.randint(0, 25) :]
            if drawn.random() < 0.6
            else "".join(drawn.choices(letters, k=drawn.randint(0, 90)))
            for _ in range(drawn.randint(0, 4))
        ]
        rows.append((drawn.choice([n, n, n, 3, None]), "".join(parts) if parts else None))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = suffix_dedup.remove_repeats(docs, shard_bytes=500, bucket_bytes=2000, part_bytes=700)
    assert as_rows(found.collect()) == expected([(i, (t or "").encode()) for i, t in rows])


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op5_suffix_dedup"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = {r.doc_id: r for r in rows}
    assert len(found) == len(docs)
    for doc, data, gone in brute([(d.doc_id, d.text.encode()) for d in docs]):
        edge = np.diff(np.concatenate([[0], gone.astype(int)]))
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes()
        want = (len(data), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(kept).hexdigest())
        assert tuple(found[doc])[1:] == want


def test_suffix_array_and_prefixes():
    drawn = random.Random(1)
    for _ in range(100):
        data = bytes(drawn.choices(b"\x00\x01ab", k=drawn.randint(1, 80)))
        array = np.frombuffer(data, np.uint8)
        order = suffix_dedup.suffix_array(array)
        assert order.tolist() == sorted(range(len(data)), key=lambda i: data[i:])
        prefix = suffix_dedup.common_prefixes(array, order, np.array([0]), np.array([len(data)]))
        for one, other in zip(order[:-1], order[1:]):
            a, b = data[one:], data[other:]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert prefix[other] == same


def test_parts_merge_like_one():
    drawn = random.Random(2)
    contents = list({"".join(drawn.choices("ab", k=drawn.randint(50, 84))).encode() for _ in range(40)})
    contents += [c[:50] + b"x" * 5 for c in contents[:10]]
    ids = np.array([drawn.randint(0, 20) for _ in contents])
    whole = suffix_dedup.Part(contents, ids).masks().tolist()
    parts = [suffix_dedup.Part(contents[i : i + 7], ids[i : i + 7]) for i in range(0, len(contents), 7)]
    suffix_dedup.merge_parts(parts)
    assert [m for p in parts for m in p.masks().tolist()] == whole


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = [(r.doc_id, (r.text or "").encode()) for r in docs.collect()]
    rows = [r for r in rows if len(r[1]) < 100_000]
    small = docs.filter("text is null or length(text) < 100000")
    assert as_rows(suffix_dedup.remove_repeats(small).collect()) == expected(rows)
    assert suffix_dedup.remove_repeats(docs).count() == docs.count()


def test_empty_table(spark):
    assert suffix_dedup.remove_repeats(cases.empty(spark)).count() == 0


def test_blocks_that_share_an_anchor_alone_need_no_suffix_array(monkeypatch):
    """Equal anchors in different surroundings: only blocks with a repeated string are sorted."""
    drawn = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"

    def block(middle):
        sides = ["".join(drawn.choices(letters, k=25)).encode() for _ in range(2)]
        return sides[0] + middle + sides[1]

    anchor, passage = b"one anchor of 16", b"a passage that is fifty bytes long, or more than so"
    contents = [block(anchor) for _ in range(40)] + [block(passage) for _ in range(3)]
    sorted_blocks, part = [], suffix_dedup.Part

    def counted(blocks, ids):
        sorted_blocks.extend(blocks)
        return part(blocks, ids)

    monkeypatch.setattr(suffix_dedup, "Part", counted)
    ids = np.arange(len(contents))
    masks = suffix_dedup._masks(contents, np.zeros(len(contents), np.uint32), ids, 1 << 20)
    strings = [{c[i : i + 50] for i in range(len(c) - 49)} for c in contents]
    for i, content in enumerate(contents):
        earlier = set().union(*strings[:i])
        assert int(masks[i]) == sum(1 << k for k in range(len(content) - 49) if content[k : k + 50] in earlier)
    # Before, all 43 blocks were sorted.
    assert sorted_blocks == contents[40:]
