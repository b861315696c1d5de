import hashlib
import random

import cases
import numpy as np
import pytest

from tidemark.llm import fingerprints as fp
from tidemark.llm import queries


def check(rows, ordered):
    """Rows against (id, text) in order; the last one is followed by the first."""
    found = {(r.doc_id, r.edited_sha256): r for r in rows}
    assert len(rows) == len(ordered)
    for at, (key, text) in enumerate(ordered):
        following = ordered[(at + 1) % len(ordered)][1]
        changed = fp.edited(text, following)
        r = found[key, hashlib.sha256(changed.encode()).hexdigest()]
        own, other, near = fp.fingerprints([text, changed, following])
        assert r.n_chars == len(text)
        assert [r.fingerprint, r.edited_fingerprint] == fp.text_of(np.stack([own, other]))
        assert r.near_edited == pytest.approx(float(fp.likeness(own[None], other[None])[0]))
        assert r.near_next == pytest.approx(float(fp.likeness(own[None], near[None])[0]))


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op7_edit_fingerprints"](spark, folder).collect()
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(rows, sorted((d.doc_id, d.text) for d in docs))


def walk(text):
    """The embedding by definition: one place at a time."""
    steps = fp._steps().reshape(256, fp.PERIOD)
    out = []
    for c in text:
        point = ord(c)
        symbol = (point ^ (point >> 8) * 31) & 255
        left = steps[symbol][len(out) % fp.PERIOD]
        out.extend([symbol] * int(left))
    return out


def test_digits_read_the_embedding():
    texts = ["", "a", "abc" * 50, "é漢😀", cases.prose(4, 500)]
    digits = fp.fingerprints(texts)
    for text, row in zip(texts, digits):
        places = walk(text)
        for slot, records in enumerate(fp._places()):
            at = records[max(np.searchsorted(records, len(places)) - 1, 0)]
            read = places[at] if places else fp.EMPTY
            key = fp.mix(np.array([int(at) * int(fp.ODD) + read & fp.LOW64], np.uint64)) + np.uint64(slot)
            assert row[slot] == int(fp.mix(key)[0] >> np.uint64(60))


def test_many_and_few_texts_agree(monkeypatch):
    texts = [cases.prose(i, 3 + i * 7) for i in range(120)] + ["", "x"]
    whole = fp.fingerprints(texts)
    alone = np.concatenate([fp.fingerprints([t]) for t in texts])
    assert (whole == alone).all()


def test_likeness_follows_the_edits():
    drawn, means = random.Random(1), []
    for edits in (0, 1, 5, 20, 200):
        found = []
        for i in range(25):
            text = list(cases.prose(i, 300))
            other = list(text)
            for _ in range(edits):
                place = drawn.randrange(len(other))
                other[place : place + drawn.randint(0, 1)] = drawn.choice("xyz")
            a, b = fp.fingerprints(["".join(text), "".join(other)])
            found.append(float(fp.likeness(a[None], b[None])[0]))
        means.append(np.mean(found))
    assert means[0] == 1 and means == sorted(means, reverse=True)
    assert means[1] > 0.85 and means[-1] < 0.3


@pytest.mark.parametrize("range_bytes", [200, 5000, 1 << 24])
def test_awkward_rows(spark, range_bytes):
    docs = cases.awkward(spark)
    rows = fp.compare_with_next(docs, range_bytes).collect()
    order = lambda d: (d.doc_id is not None, d.doc_id or 0, (d.text or "").encode())
    check(rows, [(d.doc_id, d.text or "") for d in sorted(docs.collect(), key=order)])


def test_one_row_and_none(spark):
    one = spark.createDataFrame([(5, "alone")], "doc_id long, text string")
    row = fp.compare_with_next(one).first()
    assert (row.near_next, row.n_chars) == (1.0, 5)
    assert fp.compare_with_next(cases.empty(spark)).count() == 0


def test_edit_classes(spark):
    drawn, texts = random.Random(2), []
    for i in range(8):
        base = cases.prose(i, 120)
        texts.append(base)
        for _ in range(3):
            other = list(base)
            for _ in range(3):
                other[drawn.randrange(len(other))] = drawn.choice(["", "xx", "y"])
            texts.append("".join(other))
    found = {r.doc_id: r.class_id for r in fp.edit_classes(cases.documents(spark, texts)).collect()}
    assert found == {i: i // 4 * 4 for i in range(len(texts))}
    assert fp.edit_classes(cases.empty(spark)).count() == 0
    assert fp.edit_classes(cases.awkward(spark)).count() == 15


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_within_against_the_whole_matrix():
    drawn = random.Random(4)
    for _ in range(1500):
        a = "".join(drawn.choices("ab\u6f22\U0001f600", k=drawn.randint(0, 12)))
        b = "".join(drawn.choices("ab\u6f22", k=drawn.randint(0, 12)))
        b = drawn.choice([b, a[:4] + "b" + a[6:], a])
        exact = distance(a, b)
        assert [fp.within(a, b, most) for most in range(14)] == [exact <= m for m in range(14)]


def some_edits(text, rate, drawn):
    """Letters exchanged, deleted or put in, at most ``rate`` of the length."""
    chars = list(text)
    for at in sorted(drawn.sample(range(len(chars)), int(rate * len(chars))), reverse=True):
        kind = drawn.randrange(3)
        chars[at : at + 1] = [[], [drawn.choice(LETTERS)], [drawn.choice(LETTERS), chars[at]]][kind]
    return "".join(chars)


LETTERS = "abcdefghijklmnopqrstuvwxyz "


@pytest.mark.parametrize("words", [10, 50, 200, 1000])
def test_recall_by_edit_rate(words):
    drawn = random.Random(words)
    for rate in (0.01, 0.05, 0.1):
        first = [cases.prose(drawn.random(), words) for _ in range(40)]
        second = [some_edits(text, rate, drawn) for text in first]
        keys, owner = fp.band_keys(first + second)
        held = [set(keys[owner == i].tolist()) for i in range(80)]
        assert sum(bool(held[i] & held[40 + i]) for i in range(40)) >= 36, rate


def test_edit_classes_against_all_pairs(spark):
    drawn, texts = random.Random(5), []
    for i in range(12):
        base = cases.prose(200 + i, 40)
        texts += [base] + [some_edits(base, rate, drawn) for rate in (0.01, 0.05, 0.1, 0.4)]
    found = {r.doc_id: r.class_id for r in fp.edit_classes(cases.documents(spark, texts)).collect()}
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if root[i] != root[j] and distance(texts[i], texts[j]) <= 0.2 * max(
                len(texts[i]), len(texts[j])
            ):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    assert found == dict(enumerate(root))


def test_edit_classes_of_awkward_rows(spark):
    rows = fp.edit_classes(cases.awkward(spark)).collect()
    classes = {}
    for r in rows:
        classes.setdefault(r.doc_id, set()).add(r.class_id)
    assert classes[1] == classes[5] == {1} and classes[6] == {6}
    # Null text is empty; a null id names no class that has another one.
    assert classes[2] == classes[3] == classes[11] == {2}
    assert classes[None] == {None, 2}
    # Two texts of one id are judged one by one.
    assert sum(r.doc_id == 7 for r in rows) == 2 and classes[7] == {7}
