import math
from collections import Counter
from fractions import Fraction

from test_mixing import docs_of

from tidemark.llm import mixing


def worst_deviation(order, weights):
    """Of blocks done from the unrounded share, until the first source is near its end."""
    total, done, left, worst = sum(weights.values()), Counter(), Counter(order), 0
    for slot, source in enumerate(order):
        done[source] += 1
        for s, w in weights.items():
            worst = max(worst, abs(done[s] - (slot + 1) * w / total))
        if any(w and done[s] >= left[s] - 1 for s, w in weights.items()):
            break
    return worst


def order_of(frame):
    rows = frame.filter("spot = 0").collect()
    assert sorted(r.slot for r in rows) == list(range(len(rows)))
    return [r.source for r in sorted(rows, key=lambda r: r.slot)]


def test_unrounded_weights(spark):
    """Weights that are no multiples of 1/1000, one far below it."""
    targets = {"a": 0.70049, "b": 0.29931, "c": 0.0002}
    sizes = {"a": 7200, "b": 3100, "c": 6}
    order = order_of(mixing.schedule(docs_of(spark, sizes), targets, 1))
    weights = {s: Fraction(w) for s, w in targets.items()}
    assert Counter(order) == Counter(sizes)
    assert worst_deviation(order, weights) < 1


def test_zero_target_comes_last(spark):
    order = order_of(mixing.schedule(docs_of(spark, {"a": 40, "b": 45}), {"a": 1.0}, 4))
    assert order == ["a"] * 10 + ["b"] * 12


def test_whole_run_stays_near_the_fluid_schedule():
    weights, blocks = [1.0, 2.5, 0.3, 7.7, 0.3], [50, 20, 9, 300, 1]
    done = [0] * 5
    for slot, (place, block) in enumerate(mixing.slots_of(weights, blocks)):
        assert block == done[place]
        done[place] += 1
        low, high = 0.0, 1e6
        for _ in range(100):
            v = (low + high) / 2
            if sum(min(w * v, n) for w, n in zip(weights, blocks)) < slot + 1:
                low = v
            else:
                high = v
        assert all(abs(d - min(w * low, n)) < 1 + 1e-6 for d, w, n in zip(done, weights, blocks))
    assert done == blocks and math.isclose(sum(done), slot + 1)


def test_every_source_has_its_own_place(spark):
    """Many small sources, and one with a high target."""
    sizes = {f"s{i:03d}": 12 for i in range(130)} | {"tiny": 5, None: 7}
    targets = {s: 1.0 for s in sizes if s} | {"tiny": 40.0}
    frame = docs_of(spark, sizes)
    order = order_of(mixing.schedule(frame, targets, 1))
    assert Counter(order) == Counter(sizes)
    assert order[-7:] == [None] * 7  # no target: after all others
    weights = {s: Fraction(w) for s, w in targets.items()}
    assert worst_deviation(order, weights) < 1
