"""URL filters: rules first, then a classifier over segmented names.

Names in hosts and paths are words run together. A unigram model, counted over the visible
words of all pages, splits them by the Viterbi rule: the split with the highest product of
word probabilities, where an unknown word of n letters counts as 10 / (total * 10**n).
Multinomial naive Bayes with add-one smoothing then scores the words. It learns from the
URLs that the rules decide.

All words of all pages count, whatever their number and length. The counts stay a table: the
distinct names are taken apart into their substrings, these are joined with the counts, and
each distinct name is split once. The model learns from about ``TRAIN_URLS`` rule-decided
URLs, drawn by a hash of the URL; only the tokens of these reach the driver.

A null URL, or one without ``://``, has an empty host and path; the classifier judges it by
its prior. Without any rule-decided URL the verdict is allow. Rows that repeat are judged row
by row; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import content_key, slices, small
from tidemark.session import settle

# Rule -> verdict; a rule is a host suffix followed by a path prefix.
RULES = {
    "org/": "allow",
    "example.org/es/": "block",
    "example.org/en/1": "block",
    "com/fr/": "allow",
    "com/de/": "block",
}
TRAIN_URLS = 100_000
PART_LETTERS = 1 << 18

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = re.compile(r"[^\W\d_]+|\d+")


def split_url(pages: DataFrame) -> DataFrame:
    """page_id, host (A-Z in lower case) and path."""
    url = F.coalesce("url", F.lit(""))
    return pages.select(
        "page_id",
        F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER).alias("host"),
        F.regexp_extract(url, PARTS, 2).alias("path"),
    )


def rule_for(rules: dict[str, str] = RULES) -> Column:
    """The longest rule that fits host and path, or null."""
    host, path = F.col("host"), F.col("path")
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        name, slash, rest = rule.partition("/")
        same = (host == name) | host.endswith("." + name)
        fits.append(F.when(same & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string"))


def counted_words(pages: DataFrame) -> DataFrame:
    """word and n of every visible word over all pages."""
    visible = F.regexp_replace(F.coalesce("html", F.lit("")), r"(?s)<[^>]*>", " ")
    words = F.explode(F.split(F.lower(visible), r"[^\p{L}]+"))
    return settle(
        pages.select(words.alias("word"))
        .filter("word <> ''")
        .groupBy("word")
        .agg(F.count("*").alias("n"))
    )


def best_split(name: str, known: dict[str, float], unknown: float) -> list[str]:
    """The split of the highest score; a word of n letters that is not known has unknown - n."""
    lengths = {len(word) for word in known}
    best = [(0.0, 0)]
    # Greatest score + position so far: where an unknown word does best to start.
    reach = (0.0, 0)
    for end in range(1, len(name) + 1):
        choices = [(reach[0] + unknown - end, reach[1])]
        for start in (end - n for n in lengths if n <= end):
            score = known.get(name[start:end])
            if score is not None:
                choices.append((best[start][0] + score, start))
        best.append(max(choices))
        reach = max(reach, (best[end][0] + end, end))
    words, end = [], len(name)
    while end:
        start = best[end][1]
        words.append(name[start:end])
        end = start
    return words[::-1]


def scores(counts: dict[str, int], total: int) -> tuple[dict[str, float], float]:
    """log10 probabilities of the words, and the part of an unknown word without its length."""
    known = {word: math.log10(n / total) for word, n in counts.items()}
    return known, 1 - math.log10(total)


class Words:
    """Unigram Viterbi over counts at hand."""

    def __init__(self, counts: dict[str, int]):
        self.known, self.unknown = scores(counts, sum(counts.values()) or 1)
        self.split = lru_cache(maxsize=50_000)(self._split)

    def _split(self, name: str) -> list[str]:
        return best_split(name, self.known, self.unknown)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of host and path in order, marked by where they stand; numbers by their length."""
    for whole in batches:
        for batch in slices(whole, 5000):
            rows = []
            columns = (batch[n].to_pylist() for n in ("row", "host", "path", "learn"))
            for row, host, path, learn in zip(*columns):
                found = [("h:", n) for n in TOKEN.findall(host)]
                found += [("p:", n) for n in TOKEN.findall(path.lower())]
                for at, (mark, name) in enumerate(found):
                    shown = f"#{len(name)}" if name.isdigit() else name
                    rows.append((row, at, mark, shown, learn))
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)],
                names=["row", "at", "mark", "name", "learn"],
            )


def split_names(names: DataFrame, counted: DataFrame) -> DataFrame:
    """name and its words, for a table of distinct names and that of all counts.

    A long name has many substrings, so these carry its 128-bit key and not the name, and
    come in batches of at most ``PART_LETTERS`` letters.
    """
    about = counted.agg(
        F.sum("n").alias("total"), F.collect_set(F.char_length("word")).alias("lengths")
    ).first()
    total, lengths = int(about.total or 1), sorted(about.lengths)

    def runs(name: str) -> Iterator[list[str]]:
        """The distinct substrings of the lengths that words have, a bounded number at a time."""
        for n in lengths if not name.startswith("#") else ():
            if n > len(name):
                return
            each = max(1, PART_LETTERS // n)
            for low in range(0, len(name) - n + 1, each):
                high = min(low + each, len(name) - n + 1)
                yield list({name[at : at + n] for at in range(low, high)})

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = (batch[k].to_pylist() for k in ("key_a", "key_b", "name"))
            for key_a, key_b, name in zip(*keys):
                for found in runs(name):
                    columns = [[key_a] * len(found), [key_b] * len(found)]
                    yield pa.RecordBatch.from_arrays(
                        [*(pa.array(c, pa.int64()) for c in columns), pa.array(found)],
                        names=["key_a", "key_b", "word"],
                    )

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, 1000):
                out = []
                for name, words in zip(batch["name"].to_pylist(), batch["words"].to_pylist()):
                    counts = {w["word"]: w["n"] for w in words or ()}
                    whole_name = name.startswith("#")
                    out.append([name] if whole_name else best_split(name, *scores(counts, total)))
                yield pa.RecordBatch.from_arrays(
                    [batch["name"], pa.array(out, pa.list_(pa.string()))], names=["name", "words"]
                )

    keyed = names.select(*content_key(F.col("name")), "name")
    known = (
        keyed.mapInArrow(parts, "key_a long, key_b long, word string")
        .distinct()
        .join(small(counted), "word")
        .groupBy("key_a", "key_b")
        .agg(F.collect_list(F.struct("word", "n")).alias("words"))
    )
    joined = keyed.join(known, ["key_a", "key_b"], "left").select("name", "words")
    return settle(joined.mapInArrow(split, "name string, words array<string>"))


class Bayes:
    """Multinomial naive Bayes over two verdicts."""

    def __init__(self, docs: dict[str, int], tokens: dict[str, Counter]):
        kinds = set(tokens["allow"]) | set(tokens["block"])
        whole = sum(docs.values())
        self.prior = math.log((docs["block"] + 1) / (docs["allow"] + 1)) if whole else -1.0
        sizes = {v: sum(tokens[v].values()) + len(kinds) + 1 for v in tokens}
        self.odds = {
            token: math.log((tokens["block"][token] + 1) / sizes["block"])
            - math.log((tokens["allow"][token] + 1) / sizes["allow"])
            for token in kinds
        }

    def block_odds(self, tokens: list[str]) -> float:
        return self.prior + sum(self.odds.get(token, 0.0) for token in tokens)


def train(ruled: DataFrame, tokens: DataFrame) -> Bayes:
    """Fit on the counts (learn, token, n) of the drawn URLs; ``ruled`` has all decided ones."""
    docs = {"allow": 0, "block": 0}
    decided = ruled.filter("rule is not null")
    for row in decided.groupBy("decided").agg(F.count("*").alias("n")).collect():  # two rows
        docs[row.decided] = row.n
    counts: dict[str, Counter] = {"allow": Counter(), "block": Counter()}
    for row in tokens.collect():  # at most the tokens of the drawn URLs
        counts[row.learn][row.token] = row.n
    return Bayes(docs, counts)


def judge(
    pages: DataFrame, rules: dict[str, str] = RULES, most: int = TRAIN_URLS
) -> DataFrame:
    """page_id, host, path, rule, verdict and block_odds (natural log; by the classifier)."""
    context = pages.sparkSession.sparkContext
    verdicts = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair))
    ruled = settle(
        split_url(pages)
        .withColumn("rule", rule_for(rules))
        .withColumn("decided", F.try_element_at(verdicts, F.col("rule")))
        .withColumn("row", F.monotonically_increasing_id())
    )
    share = min(1.0, most / max(1, ruled.filter("rule is not null").count()))
    drawn = F.pmod(F.xxhash64("host", "path"), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)) + 1)
    places = settle(
        ruled.select("row", "host", "path", F.when(drawn, F.col("decided")).alias("learn"))
        .mapInArrow(_names, "row long, at int, mark string, name string, learn string")
    )
    marked = settle(places.select("mark", "name").distinct())
    words = split_names(settle(marked.select("name").distinct()), counted_words(pages))
    tokens = (
        places.filter("learn is not null")
        .groupBy("learn", "mark", "name")
        .agg(F.count("*").alias("n"))
        .join(small(words), "name")
        .select("learn", "mark", "n", F.explode("words").alias("word"))
        .groupBy("learn", F.concat("mark", "word").alias("token"))
        .agg(F.sum("n").alias("n"))
    )
    learned = train(ruled, tokens)
    model = context.broadcast(learned.odds)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odds = model.value
        for batch in batches:
            pairs = zip(batch["mark"].to_pylist(), batch["words"].to_pylist())
            sums = [sum(odds.get(mark + word, 0.0) for word in own) for mark, own in pairs]
            yield pa.RecordBatch.from_arrays(
                [batch["mark"], batch["name"], pa.array(sums, pa.float64())],
                names=["mark", "name", "odds"],
            )

    weights = settle(
        marked.join(small(words), "name")
        .select("mark", "name", "words")
        .mapInArrow(weigh, "mark string, name string, odds double")
    )
    # Added in the order of the URL, so that a run gives what the last one gave.
    listed = F.transform(F.array_sort(F.collect_list(F.struct("at", "odds"))), lambda x: x["odds"])
    sums = (
        places.select("row", "at", "mark", "name")
        .join(small(weights), ["mark", "name"])
        .groupBy("row")
        .agg(listed.alias("odds"))
        .select("row", F.aggregate("odds", F.lit(0.0), lambda total, x: total + x).alias("odds"))
    )
    scored = ruled.join(sums, "row", "left").withColumn(
        "block_odds", F.lit(float(learned.prior)) + F.coalesce("odds", F.lit(0.0))
    )
    method = F.when(F.col("block_odds") > 0, "block").otherwise("allow")
    return scored.select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("decided", method).alias("verdict"),
        "block_odds",
    )
