import random
import math
import zlib
from collections import Counter, defaultdict

import cases
import numpy as np
import pytest

from tidemark.llm import language_id, queries


def reference_bits(train, lang, text):
    """Code length by walking the contexts symbol by symbol."""
    contexts = [defaultdict(Counter) for _ in range(4)]
    for own, data in train:
        if own == lang:
            padded = language_id.PAD + data
            for at in range(3, len(padded)):
                for order in range(4):
                    contexts[order][padded[at - order : at]][padded[at]] += 1
    bits, padded = 0.0, language_id.PAD + text
    for at in range(3, len(padded)):
        for order in (3, 2, 1, 0):
            seen = contexts[order].get(padded[at - order : at])
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if seen[padded[at]]:
                bits -= math.log2(seen[padded[at]] / (total + kinds))
                break
            bits -= math.log2(kinds / (total + kinds))
        else:
            bits += 8
    return bits


def model_of(train):
    langs = sorted({lang for lang, _ in train})
    counts = Counter()
    for lang, data in train:
        for gram in language_id._grams(data).tolist():
            counts[langs.index(lang), gram] += 1
    lang, gram = np.array(list(counts)).T
    return language_id.Model(langs, lang, gram, np.array(list(counts.values())))


def test_costs_equal_the_context_walk():
    train = [("a", b"abracadabra"), ("a", b"cab"), ("b", b"zyxzyxyzz abra"), ("c", "é漢é".encode())]
    model = model_of(train)
    texts = [b"", b"abra", b"zyx", b"qqq", "é!漢".encode(), b"abracadabra" * 3]
    bits = model.all_bits(texts)
    for row, text in zip(bits, texts):
        for found, lang in zip(row, model.langs):
            assert found == pytest.approx(reference_bits(train, lang, text), abs=1e-3)


def test_chunks_do_not_change_the_sum(monkeypatch):
    model = model_of([("a", b"abracadabra"), ("b", b"zyxzyx")])
    texts = [b"abra" * 50, b"", b"z", b"zyxab" * 30]
    whole = model.all_bits(texts)
    monkeypatch.setattr(language_id, "CHUNK", 7)
    assert np.allclose(model.all_bits(texts), whole, atol=1e-2)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op6_language_id"](spark, folder).collect()
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert len(rows) == len(langs)
    held = [r for r in rows if r.held_out]
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1
    assert sum(r.lang_pred == langs[r.doc_id] for r in held) / len(held) > 0.97


def test_labels_of_the_held_out_fold_are_not_used(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    from pyspark.sql import functions as F

    other = docs.withColumn("lang", F.when(language_id.held_out(), "xx").otherwise(F.col("lang")))
    rows = lambda frame: sorted(map(str, language_id.predict_languages(frame).collect()))
    assert rows(docs) == rows(other)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    rows = language_id.predict_languages(docs).collect()
    assert len(rows) == docs.count()
    preds = defaultdict(list)
    for r in rows:
        preds[r.doc_id].append(r)
    for doc in (2, 3, 4, 11):
        assert preds[doc][0].lang_pred == "und" and preds[doc][0].score == 0
    assert {r.held_out for r in preds[None]} == {False}
    judged = language_id.identify(docs, language_id.train(docs))
    assert set(docs.columns) - {"score"} < set(judged.columns)


def test_without_labels_or_rows(spark):
    assert language_id.predict_languages(cases.empty(spark)).count() == 0
    docs = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert language_id.predict_languages(docs).first().lang_pred == "und"


def test_unlearned_languages_and_gibberish_are_rejected(spark, folder):
    docs = spark.read.parquet(f"{folder.replace('sf0.001', 'sf0.01')}/documents.parquet")
    model = language_id.train(docs)
    bounds = language_id.usual_rates(docs, model)
    drawn = random.Random(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = ["".join(drawn.choices(letters, k=400)) for _ in range(20)]
    texts += ["".join(chr(drawn.randrange(0x4E00, 0x9000)) for _ in range(300)) for _ in range(20)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert language_id.in_known_language(frame, model, bounds, 0.5).count() == 0
    prose = docs.filter("text rlike '[a-z]{3}' and lang is not null")
    kept = language_id.in_known_language(prose, model, bounds, 0.5)
    assert kept.columns == prose.columns
    assert kept.count() >= 0.99 * prose.count()


def test_no_bound_without_held_out_texts(spark):
    frame = spark.createDataFrame([(1, "a b c", None)], "doc_id long, text string, lang string")
    assert language_id.usual_rates(frame, None) == {}
    assert language_id.in_known_language(frame, None, {}, 0.5).count() == 0
