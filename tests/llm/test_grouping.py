from tidemark.llm import grouping


def test_buckets_are_grouped_in_one_pass_and_only_shared_ones_written(spark, monkeypatch):
    written = []
    settle = grouping.settle

    def counted(df, *args, **kwargs):
        written.append(df)
        return settle(df, *args, **kwargs)

    monkeypatch.setattr(grouping, "settle", counted)
    rows = [(1, 10), (1, 11), (2, 12), (3, 10), (3, 11), (3, 13), (4, 14), (4, 14), (5, 15), (5, 15), (5, 16), (None, 17)]
    members = spark.createDataFrame(rows, "bucket long, node long")
    got = sorted(tuple(r) for r in grouping._together(members).collect())
    assert got == [(1, 2, 10), (1, 2, 11), (3, 3, 10), (3, 3, 11), (3, 3, 13), (5, 3, 15), (5, 3, 15), (5, 3, 16)]
    # Before, the buckets were counted, written, and the members read and written again.
    assert len(written) == 1


def test_last_turn_tests_every_pair_of_a_bucket_without_all_pairs_at_once(spark):
    m = 12
    nodes = spark.createDataFrame([(i, 10, 0) for i in range(m)], "node long, size long, mark long")
    members = spark.createDataFrame([(1, i) for i in range(m)], "bucket long, node long")
    similar = spark.createDataFrame([(5, 9)], "a long, b long")
    batches = []

    def verify(pairs, content):
        batches.append(sorted(tuple(r) for r in pairs.collect()))
        return pairs.join(similar, ["a", "b"], "semi")

    roots = grouping.link_classes(
        nodes, members, grouping.near_sizes(0.5), lambda ids: ids, verify
    )
    asked = [pair for batch in batches for pair in batch]
    # Every pair of the bucket is tested once, and the one link is found.
    assert sorted(asked) == [(a, b) for a in range(m) for b in range(a + 1, m)]
    assert sorted(tuple(r) for r in roots.collect()) == [(5, 5), (9, 5)]
    # Before, the last turn asked all 55 pairs that the hub left in one step.
    assert max(map(len, batches)) < 55


def test_no_round_without_pairs_and_only_joined_classes_are_contracted(spark, monkeypatch):
    nodes = spark.createDataFrame([(i, 10, 0) for i in range(6)], "node long, size long, mark long")
    members = spark.createDataFrame([(1, i) for i in range(6)], "bucket long, node long")
    similar = spark.createDataFrame([(0, 1), (0, 2), (2, 4), (3, 5)], "a long, b long")
    asked, contracted, components = [], [], grouping.components

    def verify(pairs, content):
        asked.append(pairs.count())
        return pairs.join(similar, ["a", "b"], "semi")

    def counted(edges):
        contracted.append(edges.count())
        return components(edges)

    monkeypatch.setattr(grouping, "components", counted)
    roots = grouping.link_classes(nodes, members, grouping.near_sizes(0.5), lambda ids: ids, verify)
    found = sorted(tuple(r) for r in roots.collect())
    assert found == [(0, 0), (1, 0), (2, 0), (3, 3), (4, 0), (5, 3)]
    # Before, the hub met the same nodes again in two rounds, and each round took up all links.
    assert all(asked)
    assert contracted[0] == 2 and sum(contracted) == 4
