"""Host-level quality rules.

Each document is counted once, by built-in expressions over its whole text. A host (the
``source`` of a document) is then judged by how many of its documents break each rule. The
rates of small hosts say little, so they are shrunk: the rates of all hosts give a beta
prior by their mean and variance, and a host's rate is the mean of its posterior. A host
whose shrunk rate exceeds ``HOST_LIMIT`` for a rule takes all its documents with it.

Null text has no words and fails the base rule. Documents of a null host are judged by the
base rule alone. Rows that repeat are judged row by row. An empty table gives an empty
result. Columns other than the id, the text and the host are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import words_of
from tidemark.session import settle

MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOL_PERCENT = 10
DUP_LINE_PERCENT = 30
HOST_LIMIT = 0.5

SYMBOLS = r"[#*$%&|<>]"
WORD = r"[^\x20\x09-\x0D]"


def _three(words: Column, at: Column) -> list[Column]:
    return [F.get(words, at + step) for step in range(3)]


def count_rules(docs: DataFrame, host: str = "source") -> DataFrame:
    """Base counts of each document; every array is built once, in its own projection."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        "doc_id",
        F.col(host).alias("host"),
        words_of(F.col("text")).alias("words"),
        F.split(text, "\n").alias("lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
    )
    words = F.col("words")
    hashed = split.select(
        "doc_id",
        "host",
        "words",
        "n_symbols",
        F.filter("lines", lambda line: line.rlike(WORD)).alias("lines"),
        F.char_length(F.concat_ws("", words)).cast("long").alias("word_chars"),
        F.size(words).cast("long").alias("n_words"),
        F.when(
            F.size(words) >= 3,
            F.transform(
                F.sequence(F.lit(0), F.size(words) - 3),
                lambda at: F.xxhash64(*_three(words, at)),
            ),
        ).alias("hashes"),
    )
    # Hashes that are all different prove that no three words come twice.
    repeats = F.size("hashes") > F.size(F.array_distinct("hashes"))
    sorted_threes = hashed.select(
        "doc_id",
        "host",
        "n_symbols",
        "word_chars",
        "n_words",
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(
            repeats,
            F.sort_array(
                F.transform(
                    F.sequence(F.lit(0), F.size(words) - 3),
                    lambda at: F.struct(
                        F.concat_ws(" ", *_three(words, at)).alias("three"), at.alias("at")
                    ),
                )
            ),
        ).alias("threes"),
    )
    threes = F.col("threes")
    found = F.filter(
        threes,
        lambda item, at: F.coalesce(
            (F.get(threes, at + 1)["three"] == item["three"])
            | ((at > 0) & (F.get(threes, F.greatest(at - 1, F.lit(0)))["three"] == item["three"])),
            (at > 0) & (F.get(threes, F.greatest(at - 1, F.lit(0)))["three"] == item["three"]),
        ),
    )
    covered = F.flatten(
        F.transform(found, lambda item: F.array(*(item["at"] + step for step in range(3))))
    )
    counted = sorted_threes.withColumn(
        "n_repeat_words",
        F.when(threes.isNull(), 0).otherwise(F.size(F.array_distinct(covered))).cast("long"),
    ).drop("threes")
    few = F.col("n_words") < MIN_WORDS
    repetitive = 100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words")
    return counted.withColumn("base_failed", few | repetitive)


def rules() -> dict[str, Column]:
    """The rules whose failures are counted per host."""
    words = F.col("n_words")
    return {
        "few_words": words < MIN_WORDS,
        "repetitive": 100 * F.col("n_repeat_words") > REPEAT_PERCENT * words,
        "symbols": 100 * F.col("n_symbols") > SYMBOL_PERCENT * words,
        "dup_lines": 100 * F.col("n_dup_lines") > DUP_LINE_PERCENT * words,
    }


# How many documents the prior is worth where hosts do not differ beyond chance.
STRONGEST = 1e9


def prior_strength(hosts: int, docs: int, squares: int, mean: float, spread: float) -> float:
    """alpha + beta of the beta prior, by the moments of beta-binomial counts.

    ``squares`` is the sum of n * n over hosts and ``spread`` that of f * f / n. The weighted
    variance of the rates has a part that drawing n documents makes by itself; only what is
    beyond it counts as difference between hosts. Where that cannot be told (hosts of one
    document each) or is none, the prior outweighs any host.
    """
    drawn = mean * (1 - mean)
    known = docs - squares / docs - (hosts - 1) if docs else 0.0
    if drawn <= 0 or known <= 0:
        return STRONGEST
    alike = ((spread - mean * mean * docs) / drawn - (hosts - 1)) / known
    return min(STRONGEST, max(0.0, 1 / alike - 1)) if alike > 0 else STRONGEST


def host_verdicts(counted: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """host, host_rate (the worst shrunk rate over the rules) and host_kept."""
    hosts = (
        counted.filter(F.col("host").isNotNull())
        .groupBy("host")
        .agg(
            F.count("*").alias("n"),
            *(F.sum(failed.cast("long")).alias(name) for name, failed in rules().items()),
        )
    )
    n = F.col("n")
    sums = hosts.agg(
        F.count("*").alias("hosts"),
        F.sum("n").alias("docs"),
        F.sum(n * n).alias("squares"),
        *(F.sum(name).alias(f"{name}_f") for name in rules()),
        *(F.sum(F.col(name) * F.col(name) / n).alias(f"{name}_q") for name in rules()),
    ).first()  # one row whatever the number of hosts
    rates = []
    for name in rules():
        mean = (sums[f"{name}_f"] or 0) / (sums["docs"] or 1)
        strength = prior_strength(
            sums["hosts"], sums["docs"] or 0, sums["squares"] or 0, mean, sums[f"{name}_q"] or 0.0
        )
        rates.append((F.col(name) + mean * strength) / (n + strength))
    worst = F.greatest(*rates)
    return hosts.select("host", worst.alias("host_rate"), (worst <= limit).alias("host_kept"))


def judge(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, base verdict and final verdict of each document."""
    counted = settle(count_rules(docs, host))
    judged = counted.join(host_verdicts(counted, limit), "host", "left")
    good = ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))
    return judged.withColumn("kept", good)
