"""Token counts by a digest cache.

The cache is a Parquet folder of (digest, n_tokens, tokenizer version). A
text is looked up by the SHA-256 of its content; only distinct texts that are not there are
encoded, and their counts are appended. The ids of a byte-level vocabulary depend on each
byte, so the only normalisation of the content is that null is the empty text.

Each row is counted, repeated ids and rows too. An empty table leaves the cache as it is.
Other columns of the input are ignored. Copies of one text meet after a partial aggregate,
so a text that a third of all rows have is one row per task. Two runs that append at the
same time may both store a digest; reading keeps one.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import slices, small, text_or_empty
from tidemark.llm.tokens import encoder, version
from tidemark.session import settle

VOCABULARY = "byte_bpe_50k.json"
LIMIT = 1024

STORED = "digest binary, n_tokens long, tokenizer string"


def stored(spark: SparkSession, cache: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """The stored counts of this tokenizer version, one row per digest; none without a cache."""
    try:
        rows = spark.read.schema(STORED).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], STORED)
    return (
        rows.filter(F.col("tokenizer") == version(vocabulary))
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def _counts(vocabulary: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).ids
        for whole in batches:
            for batch in slices(whole, 1000):
                numbers = [len(encode(text)) for text in batch["text"].to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [batch["digest"], pa.array(numbers, pa.int64())],
                    names=["digest", "n_tokens"],
                )

    return count


def refresh(docs: DataFrame, cache: str, vocabulary: str = VOCABULARY) -> DataFrame:
    """Count what the cache lacks and append it; returns the keys of the rows of ``docs``."""
    spark = docs.sparkSession
    text = text_or_empty()
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        text.alias("text"),
    )
    keys = settle(
        keyed.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "digest")
    )
    # The lookup takes digests only. Texts are read once more for those that are missing, and
    # only these texts travel.
    known = stored(spark, cache, vocabulary).select("digest")
    missing = settle(keys.select("digest").distinct().join(known, "digest", "anti"))
    misses = (
        keyed.select("digest", "text")
        .join(small(missing), "digest", "semi")
        .dropDuplicates(["digest"])
    )
    counted = misses.mapInArrow(_counts(vocabulary), "digest binary, n_tokens long")
    (
        counted.withColumn("tokenizer", F.lit(version(vocabulary)))
        .write.mode("append")
        .parquet(cache)
    )
    return keys


def count_tokens(
    docs: DataFrame, cache: str, vocabulary: str = VOCABULARY, limit: int = LIMIT
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit for each row."""
    keys = refresh(docs, cache, vocabulary)
    counts = stored(docs.sparkSession, cache, vocabulary)
    return keys.join(counts, "digest", "left").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
