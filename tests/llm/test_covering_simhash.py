import random
import re
from itertools import combinations

import cases
import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tidemark.llm import covering_simhash as simhash
from tidemark.llm import queries


def brute_print(text):
    """The definition, bit by bit."""
    lowered = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    runs = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(" ".join(run).encode(), seed=42).intdigest() for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute(rows):
    """(doc_id, text) -> sorted (doc_id, fingerprint, component) over all pairs."""
    prints = [brute_print(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 3:
            parent[root(a)] = root(b)
    least = {}
    for place, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[root(place)] = min(least.get(root(place), doc_id), doc_id)
    return sorted(
        (str(doc_id), f"{prints[place]:016x}", str(least.get(root(place))))
        for place, (doc_id, _) in enumerate(rows)
    )


def found(frame):
    return sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in frame.collect())


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    drawn = random.Random(seed)
    rows = []
    for i in range(120):
        words = cases.prose(drawn.randint(0, 6), 300).split()
        for _ in range(drawn.choice([0, 0, 1, 2, 4])):
            words[drawn.randrange(len(words))] = "".join(drawn.choices("qwz", k=5))
        text = " ".join(words)
        rows.append((i * 3 % 120, text.upper() if drawn.random() < 0.2 else text))
    rows += [(500, None), (501, ""), (502, " \n"), (503, "One"), (504, "one\ttwo"), (505, "ONE two")]
    rows += [(506, "É é"), (507, "é é"), (508, "a b c d")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert found(simhash.classes(frame)) == brute(rows)


@pytest.mark.parametrize("order", [2, 3])
def test_masks_cover_the_radius(order):
    """Any three bits are left out together by some mask, also among the free bits below one."""
    drawn = random.Random(order)
    masks = simhash.masks(order, 3)
    assert len(masks) == (order**4 - 1) // (order - 1)
    for free in [(1 << 64) - 1, ~masks[0] & ((1 << 64) - 1)]:
        places = [i for i in range(64) if free >> i & 1]
        below = simhash.masks(order, 3, free)
        for _ in range(3000):
            apart = sum(1 << p for p in drawn.sample(places, 3))
            assert any(not apart & mask for mask in below)


def _groups(nodes, pairs):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[root(a)] = root(b)
    return {frozenset(x for x in nodes if root(x) == root(n)) for n in nodes}


@pytest.mark.parametrize("order,depth", [(2, 1), (2, 2), (3, 1)])
def test_crowded_buckets_lose_no_link(spark, order, depth):
    """Numbers that differ only where a mask has no bits all meet in its bucket."""
    drawn, free = random.Random(depth), (1 << 64) - 1
    for _ in range(depth):
        free &= ~simhash.masks(order, 3, free)[0]
    places = [i for i in range(64) if free >> i & 1]
    assert len(places) > 10
    nodes = {0, (1 << 64) - 1}
    while len(nodes) < 420:
        node = sum(1 << p for p in places if drawn.random() < 0.5)
        nodes |= {node, node ^ sum(1 << p for p in drawn.sample(places, drawn.randint(1, 4)))}
    frame = spark.createDataFrame([(n - (1 << 64) if n >> 63 else n,) for n in nodes], "bits long")
    rows = simhash.links(frame, order=order, most=300).collect()
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in rows]
    assert all((a ^ b).bit_count() <= 3 for a, b in pairs)
    near = [(a, b) for a, b in combinations(nodes, 2) if (a ^ b).bit_count() <= 3]
    assert _groups(nodes, pairs) == _groups(nodes, near)


def test_a_family_is_searched_without_all_pairs():
    nodes = np.array(sorted(random.Random(1).sample(range(1 << 12), 2000)), np.uint64)
    run = simhash._spanning(3)
    batch = pa.RecordBatch.from_arrays(
        [pa.array([nodes.view(np.int64).tolist()], pa.list_(pa.int64()))], names=["nodes"]
    )
    (out,) = list(run(iter([batch])))
    assert out.num_rows == 1999  # one class: a spanning tree


def test_long_text_in_steps():
    data = cases.prose(4, 70_000).encode()
    assert simhash.fingerprint(data) == brute_print(data.decode())


def test_awkward_rows(spark):
    frame = cases.awkward(spark)
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    assert found(simhash.classes(frame)) == brute(rows)


def test_null_ids_only(spark):
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c")], "doc_id long, text string")
    assert [r.component_id for r in simhash.classes(frame).collect()] == [None, None]


def test_empty_table(spark):
    result = simhash.classes(cases.empty(spark))
    assert result.columns == ["doc_id", "fingerprint", "component_id"]
    assert result.count() == 0


def test_query_against_all_pairs(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert found(queries.QUERIES["op12_covering_simhash"](spark, folder)) == brute(rows)
