import random
from collections import Counter, defaultdict
from itertools import combinations

import cases
import numpy as np
import pytest

from tidemark.llm import near_dedup, queries
from tidemark.llm.grouping import components


def brute(texts, threshold=near_dedup.THRESHOLD):
    """Least member of each connected group over all pairs of bags."""
    bags = {i: near_dedup.bag(t or "") for i, t in texts.items()}
    parent = {i: i for i in texts}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(texts), 2):
        if bags[a] and bags[b] and near_dedup.similarity(bags[a], bags[b]) >= threshold:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {i: root(i) for i in texts}


def edited(text, edits, drawn):
    words = text.split()
    for _ in range(edits):
        words[drawn.randrange(len(words))] = "".join(drawn.choices("qwz", k=5))
    return " ".join(words)


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    drawn = random.Random(seed)
    texts = {}
    for i in range(60):
        base = cases.prose(drawn.randint(0, 8), 150)
        texts[i] = edited(base, drawn.choice([0, 0, 1, 2, 3, 12]), drawn)
    texts |= {60: None, 61: "", 62: " \n", 63: "one two", 64: "ONE  two", 65: "one three"}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()}
    assert found == brute(texts)


def test_family_linked_through_its_centre(spark):
    """Copies that are near the centre but not near each other are one class."""
    base = cases.prose(3, 200).split()
    texts = {}
    for i in range(30):
        words = list(base)
        for place in (i * 6 % 190, (i * 6 + 95) % 190, (i * 13 + 40) % 190):
            words[place] = f"q{i}"
        texts[i] = " ".join(words)
    texts[99] = " ".join(base)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()}
    assert found == brute(texts)


def test_multiset_counts_matter(spark):
    line = "a b c d e f g h i j "
    texts = {0: line * 10, 1: line * 9, 2: line * 5, 3: line * 2}
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r.class_id for r in near_dedup.classes(frame).collect()}
    assert found == brute(texts)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_registers_agree_by_the_similarity(share):
    """Signatures of many pairs: the mean agreement is the weighted Jaccard similarity."""
    drawn, agree, truth = random.Random(7), [], []
    for _ in range(60):
        one = Counter({f"r{drawn.randrange(10**9)}": drawn.choice([1, 1, 2, 3, 7]) for _ in range(40)})
        other = Counter({k if drawn.random() < share else k + "x": max(1, n + drawn.choice([-1, 0, 1])) for k, n in one.items()})
        truth.append(near_dedup.similarity(one, other))
        runs, docs = [], []
        for place, bag in enumerate((one, other)):
            for name, n in bag.items():
                runs += [hash_of(name)] * n
                docs += [place] * n
        signature, total = near_dedup.signatures(np.array(docs), np.array(runs, np.uint64), 2)
        assert total.tolist() == [one.total(), other.total()]
        agree.append((signature[0] == signature[1]).mean())
    assert abs(np.mean(agree) - np.mean(truth)) < 0.02


def hash_of(name):
    import xxhash

    return xxhash.xxh64_intdigest(name)


def test_runs_are_the_bag():
    texts = [near_dedup.normal(t) for t in ("a b c d e f a b c d e", "x", "A b  c d E", "q w e r")]
    doc, run = near_dedup.runs_of(texts)
    bags = [near_dedup.bag(t) for t in texts]
    assert Counter(doc.tolist()) == {i: b.total() for i, b in enumerate(bags)}
    kinds = defaultdict(set)
    for d, r in zip(doc.tolist(), run.tolist()):
        kinds[d].add(r)
    assert [len(kinds[i]) for i in range(4)] == [len(b) for b in bags]
    assert len(kinds[0] & kinds[2]) == len(bags[0].keys() & bags[2].keys()) == 1


def test_components(spark):
    drawn = random.Random(1)
    for n, m in ((30, 12), (200, 190), (50, 0)):
        edges = [(drawn.randrange(n), drawn.randrange(n)) for _ in range(m)]
        edges += [(i, i + 1) for i in range(1000, 1000 + m)]
        parent = {x: x for e in edges for x in e}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in edges:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
        linked = {x for a, b in edges if a != b for x in (a, b)}
        found = components(spark.createDataFrame(edges, "a long, b long") if edges else spark.createDataFrame([], "a long, b long"))
        assert {r.node: r.root for r in found.collect()} == {x: root(x) for x in linked}


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op10_bag_minhash"](spark, folder).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert {r.doc_id: r.class_id for r in rows} == brute(docs)
    assert {r.doc_id: r.n_runs for r in rows} == {i: near_dedup.bag(t).total() for i, t in docs.items()}


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    found = defaultdict(list)
    for r in near_dedup.classes(docs).collect():
        found[r.doc_id].append(r.class_id)
    assert found[5] == [1] and found[6] == [6, 6] and found[None] == [None, None]
    assert found[2] == [2] and found[3] == [3] and found[4] == [4]
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = Counter(r.doc_id for r in kept.collect())
    assert ids == Counter({i: 1 for i in (1, 2, 3, 4, 6, 7, 8, 9, 10, 11)}) + Counter({None: 2})


def test_empty_table(spark):
    assert near_dedup.classes(cases.empty(spark)).count() == 0
    assert near_dedup.drop_near_duplicates(cases.empty(spark)).count() == 0


def test_rows_that_share_an_id_keep_their_texts(spark):
    """Three different texts, two of them with one id: all stay; a repeated row stays once."""
    texts = [cases.prose(i, 80) for i in (1, 2, 3)]
    rows = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted((r.doc_id, r.text) for r in near_dedup.drop_near_duplicates(frame).collect())
    assert kept == sorted(rows[:3])
