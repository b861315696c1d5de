import math
from collections import Counter

import pytest

from tidemark.llm import queries, url_filters


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host, tail = rest[:cut], rest[cut:]
    path = tail.split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    fits = []
    for r in url_filters.RULES:
        name, slash, rest = r.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest):
            fits.append(r)
    return max(fits, key=len, default=None)


URLS = [
    "http://A.Example.ORG/es/1?x=/en/", "https://example.org/en/12", "https://example.org/en/2",
    "ftp://com/fr/", "http://notcom/fr/", "http://x.com/de/a#b", "http://x.com?/de/", "nothing",
    None, "", "http://", "://org/", "http://É.ORG/a", "http://a.net/en/1\n?x", "http://example.org",
    "http://evilexample.org/es/1", "http://u:p@h.com:80/fr/x", "http://org/?q", "a://b://c.org/x",
]


def test_split_and_rules(spark):
    frame = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    rows = url_filters.split_url(frame).withColumn("rule", url_filters.rule_for()).collect()
    for r in rows:
        assert (r.host, r.path) == parts(URLS[r.page_id])
        assert r.rule == rule(r.host, r.path)


def test_query_over_whole_table(spark, folder):
    rows = queries.QUERIES["op8_url_filters"](spark, folder).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    assert sorted(r.page_id for r in rows) == sorted(pages)
    for r in rows:
        assert (r.host, r.path) == parts(pages[r.page_id])
        assert r.rule == rule(r.host, r.path)
        method = "block" if r.block_odds > 0 else "allow"
        assert r.verdict == (url_filters.RULES[r.rule] if r.rule else method)


def all_splits(name):
    if not name:
        yield []
    for cut in range(1, len(name) + 1):
        for rest in all_splits(name[cut:]):
            yield [name[:cut], *rest]


@pytest.mark.parametrize("name", ["thecatsat", "catthe", "zzthe", "a", "satsatsat"])
def test_viterbi_finds_the_best_split(name):
    counts = {"the": 50, "cat": 20, "sat": 10, "cats": 5, "at": 30, "he": 8}
    words, total = url_filters.Words(counts), sum(counts.values())

    def score(split):
        known = lambda w: math.log10(counts[w] / total) if w in counts else 1 - math.log10(total) - len(w)
        return sum(map(known, split))

    best = max(score(s) for s in all_splits(name))
    assert score(words.split(name)) == pytest.approx(best)
    assert "".join(words.split(name)) == name


def test_bayes_by_hand():
    tokens = {"allow": Counter({"h:good": 3}), "block": Counter({"h:bad": 2, "h:good": 1})}
    model = url_filters.Bayes({"allow": 4, "block": 2}, tokens)
    want = math.log(3 / 5) + math.log((2 + 1) / (3 + 3)) - math.log((0 + 1) / (3 + 3))
    assert model.block_odds(["h:bad", "h:never"]) == pytest.approx(want)


def test_learns_from_rules(spark):
    rows = [(i, f"http://casino{i}.com/de/win", "<p>casino good news</p>") for i in range(20)]
    rows += [(100 + i, f"http://good{i}.org/news", "<p>casino good news</p>") for i in range(20)]
    rows += [(200, "http://bigcasino.net/win", ""), (201, "http://goodnews.net/news", None)]
    rows += [(202, None, None), (203, "x", "y"), (203, "x", "y")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.verdict for r in url_filters.judge(frame).collect()}
    assert found[200] == "block" and found[201] == "allow" and len(found) == 44


def test_clashing_names_and_empty(spark):
    kinds = "page_id long, url string, html string, host string, rule string, verdict string"
    frame = spark.createDataFrame([(1, "http://a.org/b", "", "h", "r", "v")], kinds)
    row = url_filters.judge(frame).first()
    assert (row.host, row.rule, row.verdict) == ("a.org", "org/", "allow")
    assert url_filters.judge(spark.createDataFrame([], kinds)).count() == 0


def test_very_long_names(spark):
    """A host label and a path name of 100,000 letters are split like any other."""
    long_name = "goodnews" * 12_500
    rows = [
        (1, f"http://{long_name}.net/a", "good news of the day"),
        (2, f"http://x.org/{long_name}", "good good news"),
        (3, "http://example.org/es/x", "day"),
        (4, "http://goodnews.com/de/x", "of"),
    ]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r for r in url_filters.judge(frame).collect()}
    assert len(found) == 4 and found[3].rule == "example.org/es/" and found[1].verdict in ("allow", "block")
