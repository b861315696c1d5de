import math
from collections import Counter, defaultdict
from fractions import Fraction

import cases
import pytest

from tidemark.llm import mixing, queries


def docs_of(spark, sizes):
    rows, number = [], 0
    for source, n in sizes.items():
        for _ in range(n):
            rows.append((number * 7919 % 100_003, "t", source))
            number += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)


def weights_of(sizes, targets):
    """The unrounded target weight of each source."""
    return {
        s: Fraction(targets.get(s, 0.0) if targets else float(n) ** mixing.POWER)
        for s, n in sizes.items()
    }


def check(rows, sizes, targets, block):
    by_source, by_slot = defaultdict(list), defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
        by_slot[r.slot].append(r)
    assert Counter(r.source for r in rows) == Counter({s: n for s, n in sizes.items() if n})
    assert sorted(by_slot) == list(range(len(by_slot)))
    for source, own in by_source.items():
        own.sort(key=lambda r: r.doc_id)
        for number, r in enumerate(own):
            assert (r.block, r.spot) == (number // block, number % block)
        slots = [r.slot for r in own if r.spot == 0]
        assert slots == sorted(slots)
    for own in by_slot.values():
        assert len({(r.source, r.block) for r in own}) == 1
    # Less than one block from the share, in every prefix of the run in which all have blocks.
    weights = weights_of(sizes, targets)
    blocks = {s: math.ceil(n / block) for s, n in sizes.items()}
    total = sum(weights.values())
    full = min(blocks[s] * total // w for s, w in weights.items() if w)
    done = Counter()
    for slot in range(full):
        done[by_slot[slot][0].source] += 1
        for source, w in weights.items():
            assert abs(done[source] - (slot + 1) * w / total) < 1


@pytest.mark.parametrize(
    "sizes, targets, block",
    [
        ({"a": 60, "b": 30, "c": 10}, {"a": 0.5, "b": 0.3, "c": 0.2}, 1),
        ({"a": 500, "b": 20, "c": 7, "d": 1}, None, 1),
        ({"a": 100, "b": 100}, {"a": 1.0, "b": 2.0}, 3),
        ({"a": 40, "b": 45}, {"a": 1.0}, 4),
        ({"a": 5}, None, 8),
    ],
)
def test_deviation_is_below_one_block(spark, sizes, targets, block):
    rows = mixing.schedule(docs_of(spark, sizes), targets, block).collect()
    check(rows, sizes, targets, block)


def test_slots_equal_a_plain_simulation(spark):
    """Earliest deadline among released blocks, slot by slot, while no source runs out."""
    sizes = {"a": 40, "b": 25, "c": 15}
    weights = weights_of(sizes, None)
    total, done, want = sum(weights.values()), Counter(), []
    cycles = min(n / weights[s] for s, n in sizes.items())
    for slot in range(math.floor(cycles * total - total / min(weights.values()))):
        released = [s for s in sizes if math.floor(done[s] * total / weights[s]) <= slot]
        pick = min(released, key=lambda s: (math.ceil((done[s] + 1) * total / weights[s]), s))
        done[pick] += 1
        want.append(pick)
    rows = mixing.schedule(docs_of(spark, sizes), None, 1).collect()
    order = [r.source for r in sorted(rows, key=lambda r: r.slot)]
    assert order[: len(want)] == want and len(want) > 50


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op9_pfair_mix"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert sorted(r.doc_id for r in rows) == sorted(d.doc_id for d in docs)
    check(rows, Counter(d.source for d in docs), None, mixing.BLOCK)


def test_mix_keeps_rows_and_order(spark, work):
    docs = cases.awkward(spark)
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    assert Counter(map(str, mixed.collect())) == Counter(map(str, docs.collect()))
    slots = {str(r.doc_id): r.slot * 100 + r.spot for r in mixing.schedule(docs).collect()}
    order = [slots[str(r.doc_id)] for r in mixed.collect()]
    assert order == sorted(order)


def test_empty_table(spark):
    assert mixing.schedule(cases.empty(spark)).count() == 0
    assert mixing.mix(cases.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = mixing.mix(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
