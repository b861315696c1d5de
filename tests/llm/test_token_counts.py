import cases

from tidemark.llm import queries, token_counts
from tidemark.llm.tokens import encoder


def count(text):
    return len(encoder(token_counts.VOCABULARY).tokenizer.encode(text or "", add_special_tokens=False))


def test_query_over_whole_table(spark, folder):
    rows = {r.doc_id: r for r in queries.QUERIES["op3_token_counts"](spark, folder).collect()}
    for doc in spark.read.parquet(f"{folder}/documents.parquet").collect():
        n = count(doc.text)
        assert rows[doc.doc_id][1:] == (len(doc.text.encode()), n, n > 1024)


def test_only_distinct_misses_are_encoded(spark, work):
    cache = f"{work}/cache"
    docs = cases.awkward(spark)
    first = token_counts.count_tokens(docs, cache).collect()
    stored = spark.read.parquet(cache)
    assert stored.count() == len({r.text or "" for r in docs.collect()})
    assert sorted(map(str, token_counts.count_tokens(docs, cache).collect())) == sorted(map(str, first))
    assert spark.read.parquet(cache).count() == stored.count()
    more = docs.union(spark.createDataFrame([cases.row(50, "one more")], cases.COLUMNS))
    assert token_counts.count_tokens(more, cache).count() == docs.count() + 1
    assert spark.read.parquet(cache).count() == stored.count() + 1


def test_stored_counts_are_used(spark, work):
    cache = f"{work}/cache"
    docs = spark.createDataFrame([(1, "stored elsewhere")], "doc_id long, text string")
    from pyspark.sql import functions as F

    digest = docs.select(F.unhex(F.sha2("text", 256)).alias("digest"), F.lit(77).cast("long").alias("n_tokens"))
    for version in (token_counts.version(token_counts.VOCABULARY), "another tokenizer"):
        digest.withColumn("tokenizer", F.lit(version)).write.mode("append").parquet(cache)
    assert token_counts.count_tokens(docs, cache).first().n_tokens == 77


def test_awkward_rows(spark, work):
    docs = cases.awkward(spark)
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in token_counts.count_tokens(docs, f"{work}/c").collect())
    want = sorted((r.doc_id or -1, len((r.text or "").encode()), count(r.text)) for r in docs.collect())
    assert got == want


def test_empty_table(spark, work):
    assert token_counts.count_tokens(cases.empty(spark), f"{work}/c").count() == 0
