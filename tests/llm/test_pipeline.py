import cases
import pytest
from test_near_dedup import brute as near_classes

import __spark_entry__ as contract
import corpus_pipeline
from tidemark.session import settle


def test_stages_over_the_given_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    sizes, columns = [docs.count()], docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id: r for r in docs.collect()}
        docs = settle(stage(spark, docs, folder))
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys()
        sizes.append(len(after))
        if name == "line_dedup":
            assert all(r.n_chars == len(r.text) for r in after.values())
        else:
            assert all(after[i] == before[i] for i in after)
        if name == "near_dedup":
            classes = near_classes({i: r.text for i, r in before.items()})
            assert after.keys() == {i for i, c in classes.items() if i == c}
        if name == "mixing":
            assert after.keys() == before.keys()
    assert sizes[1] >= 0.99 * sizes[0]
    kept = {r.doc_id for r in docs.collect()}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r.doc_id for r in packed} == kept
    run = contract.queries()["pipeline"](spark, folder)
    assert {r.doc_id for r in run.select("doc_id").distinct().collect()} == kept


@pytest.mark.parametrize("place", range(5))
def test_awkward_rows(spark, folder, place):
    name, stage = corpus_pipeline.STAGES[place]
    docs = cases.awkward(spark)
    found = stage(spark, docs, folder)
    rows = found.collect()
    if name != "packing":
        assert found.columns == docs.columns
        assert {r.doc_id for r in rows} <= {r.doc_id for r in docs.collect()}
    assert stage(spark, cases.empty(spark), folder).count() == 0


def test_language_stage_drops_what_has_no_language(spark, folder):
    kept = corpus_pipeline.known_language(spark, cases.awkward(spark), folder).collect()
    assert {r.doc_id for r in kept} == {1, 5, 6, 7, 8, 9, 10, None}
