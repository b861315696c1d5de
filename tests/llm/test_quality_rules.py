import random
import re
from collections import Counter, defaultdict

import cases
import pytest

from tidemark.llm import quality_rules, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    threes = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    counts = Counter(threes)
    covered = {i + k for i, three in enumerate(threes) if counts[three] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n, repeat = len(words), len(covered)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": repeat,
        "base_failed": n < 50 or 100 * repeat > 50 * n,
    }


def verdicts(rows):
    """Host verdicts from (host, counts) by plain arithmetic."""
    rules = {
        "few": lambda c: c["n_words"] < 50,
        "rep": lambda c: 100 * c["n_repeat_words"] > 50 * c["n_words"],
        "sym": lambda c: 100 * c["n_symbols"] > 10 * c["n_words"],
        "dup": lambda c: 100 * c["n_dup_lines"] > 30 * c["n_words"],
    }
    hosts = defaultdict(list)
    for host, counts in rows:
        if host is not None:
            hosts[host].append(counts)
    kept = dict.fromkeys(hosts, True)
    for rule in rules.values():
        failed = {h: (sum(map(rule, c)), len(c)) for h, c in hosts.items()}
        docs, k = sum(n for _, n in failed.values()), len(failed)
        if not docs:
            continue
        mean = sum(f for f, _ in failed.values()) / docs
        between = sum(n * (f / n - mean) ** 2 for f, n in failed.values())
        known = docs - sum(n * n for _, n in failed.values()) / docs - (k - 1)
        strength = 1e9
        if 0 < mean < 1 and known > 0:
            alike = (between / (mean * (1 - mean)) - (k - 1)) / known
            if alike > 0:
                strength = min(1e9, max(0.0, 1 / alike - 1))
        for h, (f, n) in failed.items():
            kept[h] &= (f + mean * strength) / (n + strength) <= 0.5
    return kept


def check(frame, docs):
    want = Counter()
    counts = [(d.source, base(d.text)) for d in docs]
    kept = verdicts(counts)
    for d, (host, c) in zip(docs, counts):
        good = not c["base_failed"] and kept.get(host, True)
        want[(d.doc_id, *c.values(), good)] += 1
    names = ["doc_id", *base("").keys(), "kept"]
    assert Counter(tuple(r[n] for n in names) for r in frame.collect()) == want
    return kept


def test_query_over_whole_table(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    check(queries.QUERIES["op4_host_quality"](spark, folder), docs)


def test_bad_hosts_go_and_small_ones_are_shrunk(spark):
    good, bad = cases.prose(1, 90), "buy now"
    texts = [good] * 40 + [bad] * 30 + [bad] + [good] * 30 + [good]
    sources = ["a"] * 40 + ["spam"] * 30 + ["tiny"] + ["b"] * 30 + ["spam"]
    frame = cases.documents(spark, texts, source=sources)
    kept = check(quality_rules.judge(frame), frame.collect())
    assert not kept["spam"] and kept["a"] and kept["b"]


@pytest.mark.parametrize(
    "text",
    [
        "a b c a b c a b",
        "a a a a",
        "x y z " * 40,
        "one two three\none two three\n\n \none two three",
        "\x0b#a\x0c&b\r|c\x1fd\xa0e",
        "é漢😀 é漢😀 é漢😀 é漢😀",
    ],
)
def test_counts(spark, text):
    frame = spark.createDataFrame([(1, text, "h")], "doc_id long, text string, source string")
    row = quality_rules.count_rules(frame).first()
    assert {n: row[n] for n in base(text)} == base(text)


def test_awkward_rows(spark):
    docs = cases.awkward(spark)
    check(quality_rules.judge(docs), docs.collect())


def test_empty_table(spark):
    assert quality_rules.judge(cases.empty(spark)).count() == 0


def test_no_python_in_the_plan(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plan = quality_rules.count_rules(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sql_gives_the_same(spark, folder):
    import compare

    from tidemark.llm.oracle import ORACLE

    frame = queries.QUERIES["op4_host_quality"](spark, folder)
    assert compare.difference(frame, compare.connect(folder), ORACLE["op4_host_quality"]) is None


def test_hosts_of_one_document_shrink_to_the_mean(spark):
    """Forty hosts of one document, ten of them failing: none is told apart from chance."""
    texts = [cases.prose(i, 90) for i in range(30)] + ["buy now"] * 10
    hosts = [f"h{i}" for i in range(40)]
    frame = cases.documents(spark, texts, source=hosts)
    counted = quality_rules.count_rules(frame)
    found = quality_rules.host_verdicts(counted).collect()
    assert len(found) == 40
    assert all(abs(r.host_rate - 0.25) < 1e-6 and r.host_kept for r in found)


def test_prior_strength_is_that_of_the_drawn_rates():
    """Counts drawn from a beta prior of known strength give about that strength back."""
    drawn = random.Random(7)
    hosts = []
    for _ in range(4000):
        n, rate = drawn.randint(1, 30), drawn.betavariate(2, 6)
        hosts.append((sum(drawn.random() < rate for _ in range(n)), n))
    docs = sum(n for _, n in hosts)
    strength = quality_rules.prior_strength(
        len(hosts),
        docs,
        sum(n * n for _, n in hosts),
        sum(f for f, _ in hosts) / docs,
        sum(f * f / n for f, n in hosts),
    )
    assert 7 < strength < 9
