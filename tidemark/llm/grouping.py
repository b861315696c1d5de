"""Classes of similar items: candidate pairs from shared buckets, and connected components.

A bucket of m items has m(m-1)/2 pairs; here it costs m-1 as long as its items are alike.
Each bucket compares its hub with all others. Items that are linked to the hub are already
in one class, so their own pairs say nothing new. Only pairs of a bucket whose items are
still in different classes are compared after that, and every one of those is, so no link
between two classes is lost.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import small
from tidemark.session import settle

ROOTS = "node long, root long"
PAIRS = "a long, b long"
# Rows that the driver is given for a broadcast where a shuffle of narrow rows would do.
FEW_ROWS = 250_000
# Hubs of a bucket in the first round after the one of its most shared node, and times more a round.
FIRST_HUBS, MORE_HUBS = 2, 8


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of each node of ``edges`` (a, b); the root is the least node.

    Alternating star contraction: each round points edges at the least node nearby, by one
    aggregate and one join on either end. A hub's edges meet as one row per task.
    """
    spark = edges.sparkSession
    high, low = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    current = settle(edges.filter("a <> b").select(high, low).distinct())
    state = _state(current)
    while state[0]:
        both = current.union(current.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(
            F.col("a").alias("k"), F.least("a", "m").alias("m")
        )
        large = (
            current.join(least, F.col("b") == F.col("k")).select("a", F.col("m").alias("b"))
        ).distinct()
        floor = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), "m")
        joined = large.join(floor, F.col("a") == F.col("k"))
        small = joined.select(
            F.explode(
                F.array(
                    F.struct(F.col("a"), F.col("m").alias("b")),
                    F.struct(F.col("b").alias("a"), F.col("m").alias("b")),
                )
            ).alias("e")
        ).select("e.*")
        current = settle(small.filter("a <> b").distinct())
        before, state = state, _state(current)
        if state == before:
            break
    if not state[0]:
        return spark.createDataFrame([], ROOTS)
    roots = current.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return settle(roots.union(current.select("b", "b").distinct()))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row.n, row.h


def _together(members: DataFrame) -> DataFrame:
    """bucket, node and in_bucket of the members of buckets that hold several nodes.

    One pass over the members, grouped by bucket, counts them and keeps those of buckets
    with two different nodes; only these are written. The members are read once, so they
    need not be written themselves.
    """
    bucket = Window.partitionBy("bucket")
    counted = members.select(
        "bucket",
        "node",
        F.count("*").over(bucket).alias("in_bucket"),
        F.min("node").over(bucket).alias("low"),
        F.max("node").over(bucket).alias("high"),
    )
    return settle(counted.filter("low <> high").select("bucket", "in_bucket", "node"))


def link_classes(
    nodes: DataFrame,
    members: DataFrame,
    alike: Callable[[Column, Column, Column, Column], Column],
    load: Callable[[DataFrame], DataFrame],
    verify: Callable[[DataFrame, DataFrame], DataFrame],
    partnered: Callable[[DataFrame, DataFrame], tuple] | None = None,
) -> DataFrame:
    """(node, root) of all nodes that are linked to another one.

    ``nodes`` has node, size and mark, ``members`` has bucket and node; two nodes of a bucket
    are compared if their sizes and marks are ``alike`` (size, mark, size, mark).
    ``load`` gets the nodes that meet another one and fetches what ``verify`` needs of them;
    ``verify`` gets pairs (a, b) and that, and keeps the similar ones. ``partnered`` gets the
    nodes of buckets that the hubs did not settle; it returns (node, size, mark) of those that
    may be similar to another one, and an ``alike`` over these marks to use from then on.
    """
    spark: SparkSession = members.sparkSession
    together = _together(members)
    # The item that shares its buckets with most others is the likely centre of its family.
    centre = settle(together.groupBy("node").agg(F.sum("in_bucket").alias("shared")))
    known = nodes.join(small(centre, FEW_ROWS), "node")
    shared = settle(together.drop("in_bucket").join(known, "node"))
    content = load(centre.select("node"))
    tested, roots = spark.createDataFrame([], PAIRS), spark.createDataFrame([], ROOTS)
    pairs = _hub_pairs(shared.withColumn("root", F.col("node")), alike)
    roots, tested = _test(pairs, tested, roots, content, verify)
    open_members, low = settle(_open(shared, roots)), 1
    if partnered and not open_members.isEmpty():
        marked, alike = partnered(open_members.select("node").distinct(), content)
        shared = settle(open_members.drop("root", "size", "mark").join(marked, "node"))
        # Members have gone, so the first place may be another node's than the hub's.
        open_members, low = settle(_open(shared, roots)), 0
    if open_members.isEmpty():
        return roots
    # Every pair of classes of a bucket, with more hubs a round instead of all pairs at once: a
    # pair is tested when its first node by place is a hub. The hub of before has place 0.
    ranked, width = _ranked(open_members), FIRST_HUBS
    while True:
        current = settle(_open(ranked, roots))
        if current.filter(F.col("place") >= low).isEmpty():
            return roots
        pairs = _ranked_pairs(current, low, low + width, alike)
        roots, tested = _test(pairs, tested, roots, content, verify)
        low, width = low + width, MORE_HUBS * width


def _test(pairs, tested, roots, content, verify) -> tuple:
    """Verify the pairs not tested before; roots and tested pairs after that."""
    asked = settle(pairs.distinct().join(tested, ["a", "b"], "anti"))
    found = settle(verify(asked, content))
    if not found.isEmpty():
        roots = _joined(roots, found)
    return roots, tested.union(asked)


def _joined(roots: DataFrame, links: DataFrame) -> DataFrame:
    """Roots after these links too: only the classes that a link joins are contracted."""
    if roots.isEmpty():
        return components(links)
    ends = links
    for end in ("a", "b"):
        known = roots.select(F.col("node").alias(end), F.col("root").alias(f"root_{end}"))
        ends = ends.join(known, end, "left")
    merged = components(
        ends.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
    )
    further = merged.select(F.col("node").alias("root"), F.col("root").alias("least"))
    moved = roots.join(further, "root", "left").select(
        "node", F.coalesce("least", "root").alias("root")
    )
    return settle(moved.union(merged.join(roots, "node", "anti").select("node", "root")))


def _open(shared: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets that still hold more than one class."""
    labelled = shared.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = (
        labelled.groupBy("bucket")
        .agg(F.min("root").alias("low"), F.max("root").alias("high"))
        .filter("low <> high")
        .select("bucket")
    )
    return labelled.join(mixed, "bucket", "semi")


def near_sizes(ratio: float):
    """Sizes of which the smaller is at least ``ratio`` of the larger; marks do not matter."""
    return lambda size, mark, other, other_mark: (
        F.least(size, other) >= ratio * F.greatest(size, other) - 1e-9
    )


def _alike(alike) -> Column:
    return alike(F.col("size"), F.col("mark"), F.col("hub_size"), F.col("hub_mark"))


def _ordered():
    return F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")


def _hub_pairs(members: DataFrame, alike) -> DataFrame:
    """Each bucket's most shared node with all nodes of other classes."""
    best = F.struct("shared", (-F.col("node")).alias("first"), "root", "size", "mark")
    hubs = members.groupBy("bucket").agg(F.max(best).alias("h")).select(
        "bucket",
        (-F.col("h.first")).alias("hub"),
        F.col("h.root").alias("hub_root"),
        F.col("h.size").alias("hub_size"),
        F.col("h.mark").alias("hub_mark"),
    )
    joined = members.join(hubs, "bucket").filter(F.col("root") != F.col("hub_root"))
    return joined.filter(_alike(alike)).select(*_ordered())


def _ranked(members: DataFrame) -> DataFrame:
    """bucket, node, size, mark and place: 0 for the bucket's most shared node, then on."""
    order = Window.partitionBy("bucket").orderBy(F.col("shared").desc(), "node")
    place = (F.row_number().over(order) - 1).alias("place")
    return settle(members.select("bucket", "node", "size", "mark", place))


def _ranked_pairs(members: DataFrame, low: int, high: int, alike) -> DataFrame:
    """Nodes placed from ``low`` to before ``high`` with the later ones of other classes.

    A bucket of m items makes at most (high - low) * m rows, not m(m-1)/2 at once. Classes
    only grow, so a pair of different classes now was of different classes when its first
    node was a hub: over all rounds every such pair is made.
    """
    hubs = members.filter((F.col("place") >= low) & (F.col("place") < high)).select(
        "bucket",
        F.col("node").alias("hub"),
        F.col("root").alias("hub_root"),
        F.col("size").alias("hub_size"),
        F.col("mark").alias("hub_mark"),
        F.col("place").alias("hub_place"),
    )
    joined = members.join(hubs, "bucket").filter(
        (F.col("place") > F.col("hub_place")) & (F.col("root") != F.col("hub_root"))
    )
    return joined.filter(_alike(alike)).select(*_ordered())
