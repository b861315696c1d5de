"""One query per corpus operator, over its whole table."""

from __future__ import annotations


from pyspark.sql import functions as F

from tidemark.llm import (
    alignment,
    centroids,
    covering_simhash,
    fingerprints,
    language_id,
    line_dedup,
    mixing,
    near_dedup,
    packing,
    quality_rules,
    suffix_dedup,
    token_counts,
    url_filters,
)
from tidemark.llm.common import table
from tidemark.session import new_folder, prepare

QUERIES: dict = {}


def query(function):
    """Register under the function's name, with the session settings applied first."""

    def run(spark, folder):
        return function(prepare(spark), folder)

    QUERIES[function.__name__] = run
    return run


@query
def op1_packing(spark, folder):
    pieces = packing.digest(packing.cut(table(spark, folder, "documents")))
    return packing.assign(pieces).select(
        "doc_id",
        "start",
        "length",
        "ids_crc32",
        "doc_tokens",
        "sequence_id",
        "offset",
        "sequence_tokens",
        "padded_tokens",
    )


@query
def op3_token_counts(spark, folder):
    cache = new_folder(spark, "token-counts")
    return token_counts.count_tokens(table(spark, folder, "documents"), cache)


@query
def op4_host_quality(spark, folder):
    return quality_rules.judge(table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


@query
def op6_language_id(spark, folder):
    return language_id.predict_languages(table(spark, folder, "documents"))


@query
def op8_url_filters(spark, folder):
    return url_filters.judge(table(spark, folder, "pages"))


@query
def op9_pfair_mix(spark, folder):
    return mixing.schedule(table(spark, folder, "documents"))


@query
def op10_bag_minhash(spark, folder):
    return near_dedup.classes(table(spark, folder, "documents"))


@query
def op2_fuzzy_lines(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents"), search="sketch").select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.sha2("text", 256).alias("kept_sha256"),
    )


@query
def op5_suffix_dedup(spark, folder):
    spans = suffix_dedup.remove_repeats(table(spark, folder, "documents"))
    lengths = F.zip_with("span_starts", "span_ends", lambda start, end: end - start)
    return spans.select(
        "doc_id",
        "n_bytes",
        F.aggregate(lengths, F.lit(0).cast("long"), lambda a, n: a + n).alias("n_removed"),
        F.size("span_starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op7_edit_fingerprints(spark, folder):
    return fingerprints.compare_with_next(table(spark, folder, "documents"))


@query
def op11_shallot_centroids(spark, folder):
    return centroids.clusters_with_inertia(table(spark, folder, "embeddings"))


@query
def op12_covering_simhash(spark, folder):
    return covering_simhash.classes(table(spark, folder, "documents"))


@query
def op13_galloping_alignment(spark, folder):
    return alignment.digests(table(spark, folder, "documents"))
