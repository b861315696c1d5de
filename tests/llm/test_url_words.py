import math

from tidemark.llm import url_filters


def splits(spark, counts, names):
    counted = spark.createDataFrame(counts, "word string, n long").repartition(4)
    frame = spark.createDataFrame([(n,) for n in names], "name string")
    return {r.name: r.words for r in url_filters.split_names(frame, counted).collect()}


def test_every_word_counts(spark):
    """60,000 words of one frequency, and a word of more than 24 letters."""
    letters = "bcdfghjklmnpqrstvwxz"
    words = [a + b + c + d for a in letters for b in letters for c in letters for d in letters]
    long = "a" + "eiou" * 7
    counts = [(w, 1) for w in words[:60_000]] + [(long, 1)]
    names = ["bcdf" + long + "nmlk", "#4", "yyy" * 20]
    found = splits(spark, counts, names)
    assert found[names[0]] == ["bcdf", long, "nmlk"]
    assert found["#4"] == ["#4"] and found["yyy" * 20] == ["yyy" * 20]


def test_tables_split_as_counts_at_hand(spark):
    counts = {"the": 50, "cat": 20, "sat": 10, "cats": 5, "at": 30, "he": 8}
    names = ["thecatsat", "catthe", "zzthe", "a", "satsatsat"]
    own = url_filters.Words(counts)
    assert splits(spark, list(counts.items()), names) == {n: own.split(n) for n in names}
    assert math.isclose(own.unknown, 1 - math.log10(123))
