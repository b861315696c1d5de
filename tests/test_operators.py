import random
import re
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.operators import (
    deadletter,
    fulfillment,
    ingest,
    metrics,
    ordered,
    orders,
    outbox,
    rules,
)
from tidemark.schemas import OUTBOX_EVENTS
from tidemark.sources import store as layout

UTC = timezone.utc
T0 = datetime(2024, 1, 1, tzinfo=UTC)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def placed(spark, rows):
    return spark.createDataFrame(rows, "event_time timestamp, amount double")


def records(frame):
    rows = metrics.metric_records(frame, F.lit(T0)).orderBy("windowSize", "windowStart")
    return [(r.orderCount, r.totalRevenue, r.avgOrderValue) for r in rows.collect()]


def test_count_and_mean_of_a_minute(spark):
    frame = placed(spark, [(at(1), 10.0), (at(59), 0.01), (at(60), 5.0)])
    assert records(metrics.windowed_metrics(frame)) == [(2, "10.01", "5.01"), (1, "5.00", "5.00")]


def test_null_amounts_count_but_add_nothing(spark):
    assert records(metrics.windowed_metrics(placed(spark, [(at(1), None)]))) == [
        (1, "0.00", "0.00")
    ]


def test_empty_window_between_two(spark):
    frame = placed(spark, [(at(1), 1.0), (at(125), 2.0)])
    filled = metrics.fill_empty_windows(metrics.windowed_metrics(frame), "1m")
    assert records(filled) == [(1, "1.00", "1.00"), (0, "0.00", "0.00"), (1, "2.00", "2.00")]


def test_fill_widened_range_and_empty_input(spark):
    frame = metrics.windowed_metrics(placed(spark, [(at(1), 1.0)]))
    filled = metrics.fill_empty_windows(frame, "1m", until=F.lit(at(120)))
    assert [r[0] for r in records(filled)] == [1, 0, 0]
    assert metrics.fill_empty_windows(frame.limit(0), "1m").count() == 0


def test_days_reset_at_midnight(spark):
    rows = [(at(-1), 1.0), (at(0), 2.0), (at(3600), 4.0)]
    hours = metrics.windowed_metrics(placed(spark, rows), "1h")
    running = metrics.running_daily_totals(hours).orderBy("window_start").collect()
    assert [r.day_revenue_cents for r in running] == [100, 200, 600]
    assert records(metrics.windowed_metrics(placed(spark, rows), "24h")) == [
        (1, "1.00", "1.00"),
        (2, "6.00", "3.00"),
    ]


def test_sizes_rolled_up_equal_sizes_computed(spark):
    rng = random.Random(1)
    frame = placed(
        spark, [(at(rng.randrange(200_000)), rng.randrange(9999) / 100) for _ in range(500)]
    )
    rolled = metrics.multi_size_metrics(frame)
    single = metrics.union_sizes(*[metrics.windowed_metrics(frame, s) for s in ("1m", "1h", "24h")])
    assert rolled.exceptAll(single).count() == 0 and single.exceptAll(rolled).count() == 0


def test_gap_over_midnight(spark):
    frame = placed(spark, [(at(-3600), 1.0), (at(7200), 1.0), (at(10_800), 1.0)])
    (gap,) = metrics.metric_gaps(metrics.windowed_metrics(frame, "1h"), "1h").collect()
    assert gap.missing_windows == 2


def test_latest_version_wins(spark):
    first = metrics.windowed_metrics(placed(spark, [(at(1), 1.0)])).withColumn(
        "processed_at", F.lit(at(60))
    )
    second = metrics.windowed_metrics(placed(spark, [(at(1), 1.0), (at(2), 1.0)])).withColumn(
        "processed_at", F.lit(at(90))
    )
    (row,) = metrics.latest_metrics(metrics.union_sizes(second, first)).collect()
    assert (row.order_count, row.versions) == (2, 2)


# --- ordered results ---------------------------------------------------------


def test_snapshot_of_25_orders(spark):
    rows = [(i, None if i % 4 == 0 else i % 3) for i in range(25)]
    frame = spark.createDataFrame(rows, "id int, item_lines int")
    got = ordered.order_count_snapshot(frame, ["id"]).orderBy("order_count").collect()
    sums = [sum(n or 0 for _, n in rows[:k]) for k in (10, 20)]
    assert [(r.order_count, r.item_lines) for r in got] == [(10, sums[0]), (20, sums[1])]
    out = ordered.snapshot_records(ordered.order_count_snapshot(frame, ["id"]), F.lit(T0))
    first = out.orderBy("orderCount").first()
    assert first.totalRevenue == str(sums[0])
    assert first.avgOrderValue == f"{sums[0] / 10:.2f}"
    assert first.windowEnd - first.windowStart == 60_000


def test_snapshot_goes_on_from_earlier_totals(spark):
    frame = spark.createDataFrame([(i, 1) for i in range(12)], "id int, item_lines int")
    got = ordered.order_count_snapshot(frame, ["id"], counted=5, total=100)
    assert [tuple(r) for r in got.collect()] == [(10, 105)]


@pytest.mark.parametrize("slices", [1, 3, 16])
def test_numbering_with_one_hot_time(spark, slices):
    # Two thirds of the rows share one time; the id spreads them over the slices.
    rows = [(0 if i % 3 else i, i) for i in range(300)]
    frame = spark.createDataFrame(rows, "t int, id int").repartition(7)
    got = ordered.number_rows(frame, ["t", "id"], slices).orderBy("n").collect()
    assert [r.n for r in got] == list(range(1, 301))
    assert [(r.t, r.id) for r in got] == sorted(rows)


@pytest.mark.parametrize("slices", [1, 4])
def test_running_totals(spark, slices):
    rows = [(i, None if i % 5 == 0 else i) for i in range(100)]
    frame = spark.createDataFrame(rows, "id int, v int").repartition(3)
    got = ordered.running_totals(frame, ["id"], ["v"], slices).orderBy("id").collect()
    total = 0
    for place, ((_, v), row) in enumerate(zip(rows, got), start=1):
        total += v or 0
        assert (row.n, row.running_v) == (place, total)


def test_ordered_results_of_no_rows(spark):
    frame = spark.createDataFrame([], "id int, item_lines int")
    assert ordered.order_count_snapshot(frame, ["id"]).count() == 0
    assert ordered.running_totals(frame, ["id"], ["item_lines"]).count() == 0
    assert ordered.tag_late(late_frame(spark, []), ["arrived_at", "id"]).count() == 0


def brute_late(rows, tolerance=60):
    newest, late = None, set()
    for arrived, key, event in sorted(rows):
        if newest is not None and event < newest - tolerance:
            late.add(key)
        newest = event if newest is None else max(newest, event)
    return late


def late_frame(spark, rows):
    return spark.createDataFrame(
        [(at(a), k, at(e)) for a, k, e in rows],
        "arrived_at timestamp, id int, event_time timestamp",
    )


@pytest.mark.parametrize("behind,late", [(30, False), (60, False), (61, True)])
def test_late_limit(spark, behind, late):
    frame = late_frame(spark, [(0, 0, 1000), (1, 1, 1000 - behind)])
    got = {r.id: r.is_late for r in ordered.tag_late(frame, ["arrived_at", "id"]).collect()}
    assert got == {0: False, 1: late}


@pytest.mark.parametrize("seed", range(4))
def test_late_against_a_plain_loop(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.randrange(400), i, rng.randrange(500)) for i in range(300)]
    tagged = ordered.tag_late(late_frame(spark, rows), ["arrived_at", "id"], slices=5)
    assert {r.id for r in tagged.where("is_late").collect()} == brute_late(rows)


def test_order_of_arrival_does_not_change_totals(spark):
    rng = random.Random(3)
    rows = [(at(rng.randrange(5000)), rng.randrange(999) / 100) for _ in range(200)]
    shuffled = rng.sample(rows, len(rows))
    one = metrics.windowed_metrics(placed(spark, rows))
    two = metrics.windowed_metrics(placed(spark, shuffled).repartition(5))
    assert records(one) == records(two)


# --- rules and ingest --------------------------------------------------------


def test_request_parsing(spark):
    bodies = [
        '{"customerId":"529f0699-0367-43a8-93e3-b792b2eb2dd8",'
        '"items":[{"productId":"03eea945-aa44-4155-bed1-68e9e420efad","count":1}]}',
        '{"customerId":null,"items":[]}',
        '{"customerId":null,"items":[{"count":0}]}',
        "{not json",
        None,
    ]
    frame = spark.createDataFrame(
        [(i, T0, b) for i, b in enumerate(bodies)], "id int, at timestamp, body string"
    )
    parsed = ingest.parse_requests(frame)
    checked = rules.check(parsed, ingest.request_rules())
    got = {r.id: r.violations for r in checked.collect()}
    assert got == {0: [], 1: [], 2: ["counts_positive"], 3: ["body_readable"], 4: ["body_readable"]}

    stored = ingest.new_orders(ingest.accepted(parsed), "id", "at")
    tables = ingest.order_tables(stored, F.col("created_at"), F.col("order_id"))
    by_code = {r.customer_id: r for r in tables["orders"].collect()}
    assert set(by_code) == {
        "529f0699-0367-43a8-93e3-b792b2eb2dd8",
        "00000000-0000-0000-0000-000000000000",
    }
    assert {r.status for r in by_code.values()} == {"PENDING"}
    (line,) = tables["order_items"].collect()
    assert (line["line"], line["count"]) == (0, 1)
    events = tables["outbox_events"]
    assert events.columns == OUTBOX_EVENTS.fieldNames()
    assert {(r.status, r.retry_count) for r in events.collect()} == {("PENDING", 0)}


def test_status_and_item_rules(spark):
    frame = spark.createDataFrame([("PENDING",), ("LOST",), (None,)], "status string")
    good, bad = rules.split(rules.check(frame, rules.status_rule()))
    assert (good.count(), bad.count()) == (1, 2)
    lines = spark.createDataFrame(
        [("o", "p", 1), ("o", None, 0)], "order_id string, product_id string, count int"
    )
    _, bad = rules.split(rules.check(lines, rules.item_rules()))
    assert [r.violations for r in bad.collect()] == [["product_present", "count_positive"]]
    assert rules.status_rule(outbox=True)


def test_keys(spark):
    children = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    parents = spark.createDataFrame([(1,)], "k int")
    assert [r.k for r in rules.orphans(children, parents, "k").collect()] == [2]
    assert [r.k for r in rules.surviving_children(children, parents, "k").collect()] == [1]
    assert rules.duplicate_keys(children.union(children.limit(1)), ["k"]).count() == 1


def test_defaults_fill_and_add(spark):
    frame = spark.createDataFrame([(None,), ("SHIPPED",)], "status string")
    got = rules.apply_defaults(frame, {"status": "PENDING", "retry_count": 0}).collect()
    assert [(r.status, r.retry_count) for r in got] == [("PENDING", 0), ("SHIPPED", 0)]


# --- outbox ------------------------------------------------------------------

PAYLOAD = '{"OrderShortCode":"abc","CustomerId":"c","Items":[],"Status":0}'


def events(spark, rows):
    """Rows of (id, status, retry_count) or (id, status, retry_count, payload)."""
    full = [
        (r[0], "ORDER", r[0], "ORDER_PLACED", 1, r[3] if len(r) > 3 else PAYLOAD)
        + (at(n), r[1], r[2], None, None)
        for n, r in enumerate(rows)
    ]
    return spark.createDataFrame(full, OUTBOX_EVENTS)


def states(frame):
    return {r.id: (r.status, r.retry_count) for r in frame.collect()}


def test_eligibility(spark):
    frame = events(
        spark,
        [("a", "PENDING", 0), ("b", "FAILED", 2), ("c", "FAILED", 3), ("d", "PROCESSING", 0),
         ("e", "PUBLISHED", 0)],
    )
    assert set(states(outbox.eligible(frame))) == {"a", "b"}
    assert set(states(frame.where(outbox.is_exhausted()))) == {"c"}
    assert [r.id for r in outbox.oldest(outbox.eligible(frame), 1).collect()] == ["a"]


def test_claim_adds_a_retry_only_for_failed(spark):
    frame = events(spark, [("a", "PENDING", 0), ("b", "FAILED", 1), ("c", "FAILED", 1)])
    got = states(outbox.claim(frame, frame.where("id <> 'c'")))
    assert got == {"a": ("PROCESSING", 0), "b": ("PROCESSING", 2), "c": ("FAILED", 1)}


def test_marking(spark):
    frame = events(spark, [("a", "PROCESSING", 0), ("b", "PROCESSING", 1), ("c", "PROCESSING", 0)])
    published = outbox.mark_published(frame, frame.where("id = 'a'"))
    errors = spark.createDataFrame([("b", "boom")], "id string, error string")
    marked = {r.id: r for r in outbox.mark_failed(published, errors).collect()}
    assert [marked[k].status for k in "abc"] == ["PUBLISHED", "FAILED", "PROCESSING"]
    assert (marked["a"].published_at, marked["b"].last_error) == (None, "boom")
    assert set(states(outbox.stuck(frame, F.lit(at(1000)), "5 minutes"))) == {"a", "b", "c"}


def test_attempt_leaves_undecodable_events_claimed(spark):
    frame = events(spark, [("a", "PENDING", 0), ("b", "PENDING", 0, "null"), ("c", "FAILED", 2)])

    def publish(rows):
        return rows.withColumn("error", F.when(F.col("id") == "c", F.lit("boom")))

    got = {r.id: r for r in outbox.attempt(frame, publish).collect()}
    assert (got["a"].status, got["b"].status, got["c"].status) == (
        "PUBLISHED",
        "PROCESSING",
        "FAILED",
    )
    assert got["c"].exhausted and not got["b"].exhausted and got["c"].last_error == "boom"


def test_messages_of_a_key_are_sent_by_one_task_in_order(spark):
    frame = spark.createDataFrame(
        [(f"k{i % 3 if i % 9 else 0}", at(100 - i), i) for i in range(600)],
        "key string, occurred_at timestamp, id int",
    ).repartition(5)
    ordered = outbox.in_key_order(frame, "key", ["occurred_at", "id"])
    rows = ordered.withColumn("task", F.spark_partition_id()).collect()
    assert {len({r.task for r in rows if r.key == k}) for k in ("k0", "k1", "k2")} == {1}
    seen = {}
    for row in rows:
        assert seen.get(row.key, datetime.min) <= row.occurred_at
        seen[row.key] = row.occurred_at


# --- order status ------------------------------------------------------------


def store(spark, rows):
    return spark.createDataFrame(
        [(c, s, T0) for c, s in rows], "order_short_code string, status string, updated_at timestamp"
    )


def test_apply_status(spark):
    frame = store(spark, [("a", "PENDING"), ("a", "PENDING"), ("b", "SHIPPED"), ("c", "PENDING")])
    hits = spark.createDataFrame([("a",), ("b",), ("zzz",)], "order_short_code string")

    def run(guard):
        done = orders.apply_status(
            frame, hits, "order_short_code", "FULFILLED", F.lit(at(60)), guard
        ).withColumn("moved", F.col("updated_at") > F.lit(T0))
        return sorted((r.order_short_code, r.status, r.moved) for r in done.collect())

    # The code is not unique: both rows are updated.
    assert run(True) == [
        ("a", "FULFILLED", True),
        ("a", "FULFILLED", True),
        ("b", "SHIPPED", False),
        ("c", "PENDING", False),
    ]
    assert run(False)[2] == ("b", "FULFILLED", True)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


def keyed_rows(spark, count=60):
    """Codes with several rows each, and rows without one."""
    return spark.range(count).select(
        F.when(F.col("id") % 10 < 9, F.format_string("c%d", F.col("id") % 20)).alias("code"),
        F.lit("PENDING").alias("status"),
        F.lit(T0).alias("updated_at"),
        F.col("id").alias("n"),
    )


def test_a_bucketed_store_is_not_shuffled(spark, no_broadcast):
    rows = keyed_rows(spark)
    stored = layout.bucketed(rows, "code", "orders")
    assert sorted(stored.collect(), key=str) == sorted(rows.collect(), key=str)
    hits = spark.createDataFrame([("c3",), ("c3",), ("c4",), (None,)], "code string")
    moved = orders.apply_status(stored, hits, "code", "FULFILLED", F.lit(at(60)))
    plan = plan_of(moved)
    # The one exchange is that of the events.
    assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    plain = orders.apply_status(rows, hits, "code", "FULFILLED", F.lit(at(60)))
    assert sorted(moved.collect(), key=str) == sorted(plain.collect(), key=str)
    assert moved.where("status = 'FULFILLED'").select("code").distinct().count() == 2


def test_stores_of_one_layout_join_in_place(spark, no_broadcast):
    placed = keyed_rows(spark).select("code").distinct()
    lines = keyed_rows(spark).where("n % 20 < 15").select("code", "n")
    both = orders.with_items(
        layout.bucketed(placed, "code", "placed", 4), layout.bucketed(lines, "code", "lines", 4), "code"
    )
    assert "Exchange" not in plan_of(both)
    plain = orders.with_items(placed, lines, "code")
    assert sorted(both.collect(), key=str) == sorted(plain.collect(), key=str)


def test_a_lookup_reads_its_buckets_only(spark):
    stored = layout.bucketed(keyed_rows(spark), "code", "orders", 16)
    found = layout.find(stored, "code", ["c3", "c4"])
    assert found.select("code").distinct().count() == 2 and found.count() == 6
    # The plan names the selected buckets only where it reads one bucket per task.
    auto = "spark.sql.sources.bucketing.autoBucketedScan.enabled"
    spark.conf.set(auto, "false")
    found = layout.find(stored, "code", ["c3", "c4"])
    plan = plan_of(found)
    spark.conf.unset(auto)
    (selected,) = set(re.findall(r"SelectedBucketsCount: (\d+) out of 16", plan))
    assert int(selected) <= 2
    assert layout.bucketed(keyed_rows(spark, 0), "code", "none", 4).count() == 0


def test_first_event_per_order_survives_a_hot_key(spark):
    rows = [("hot" if i % 3 else f"k{i}", i) for i in range(600)]
    frame = spark.createDataFrame(rows, "code string, ts int").repartition(6)
    first = orders.first_per_key(frame, "code", ["ts"])
    assert "WindowGroupLimit" in first._jdf.queryExecution().executedPlan().toString()
    got = {r.code: r.ts for r in first.collect()}
    assert got["hot"] == 1 and len(got) == 201


def test_furthest_status_ignores_the_order_of_changes(spark):
    rows = [("a", "SHIPPED"), ("a", "PENDING"), ("b", "PENDING"), ("b", "FULFILLED")]
    frame = spark.createDataFrame(rows, "k string, status string")
    got = {r.k: r.status for r in orders.furthest_status(frame, "k").collect()}
    assert got == {"a": "SHIPPED", "b": "FULFILLED"}


# --- fulfillment -------------------------------------------------------------


def test_fulfillment_numbers(spark):
    placed_rows = spark.createDataFrame(
        [("a", at(0)), ("b", at(10)), ("c", at(20))], "code string, placed_at timestamp"
    )
    done = spark.createDataFrame(
        [("a", at(2)), ("a", at(1)), ("b", at(5)), ("x", at(9))], "code string, fulfilled_at timestamp"
    )
    (row,) = fulfillment.fulfillment_metrics(placed_rows, done, "code").collect()
    assert (row.placed, row.fulfilled, row.pending) == (3, 1, 2)
    assert (row.rate_percent, row.mean_latency_ms) == ("33.33", 1000)
    pairs = fulfillment.placed_fulfilled(placed_rows, done, "code").collect()
    joined = {r.code: r.fulfilled_at for r in pairs}
    assert joined["b"] is None and joined["a"] is not None


def test_repeated_codes_keep_their_own_fulfillment(spark):
    placed_rows = spark.createDataFrame(
        [("a", at(0)), ("a", at(36000)), ("a", at(36000)), ("b", at(5))],
        "code string, placed_at timestamp",
    )
    done = spark.createDataFrame(
        [("a", at(3600)), ("a", at(39600))], "code string, fulfilled_at timestamp"
    )
    pairs = fulfillment.placed_fulfilled(placed_rows, done, "code").collect()
    got = sorted((r.code, r.placed_at, r.fulfilled_at) for r in pairs if r.code == "a")
    assert [(f - p).total_seconds() for _, p, f in got] == [3600, 3600, 3600] and len(pairs) == 4
    (row,) = fulfillment.fulfillment_metrics(placed_rows, done, "code").collect()
    assert (row.placed, row.fulfilled, row.pending) == (4, 3, 1)


def test_marking_with_repeated_ids(spark):
    frame = events(spark, [("a", "PROCESSING", 0), ("b", "FAILED", 1)])
    ids_twice = frame.where("id = 'b'").select("id").union(frame.select("id"))
    assert states(outbox.claim(frame, ids_twice)) == {"a": ("PROCESSING", 0), "b": ("PROCESSING", 2)}
    assert outbox.claim(frame, ids_twice).count() == 2
    assert outbox.mark_published(frame, ids_twice).count() == 2
    errors = spark.createDataFrame([("a", "x"), ("a", "y")], "id string, error string")
    assert [r.last_error for r in outbox.mark_failed(frame, errors).orderBy("id").collect()] == ["y", None]


def test_ids_that_are_no_uuids_are_refused(spark):
    good = "0b4a2a3e-6a40-4e06-8c4d-1f7a0d9b2c11"
    bodies = [
        '{"customerId":"not-a-uuid","items":[]}',
        '{"items":[{"count":1}]}',
        '{"customerId":"%s","items":[{"productId":"x","count":1}]}' % good,
        '{"customerId":"%s","items":[{"productId":"%s","count":1}]}' % (good, good),
    ]
    frame = spark.createDataFrame(list(enumerate(bodies)), "id int, body string")
    checked = rules.check(ingest.parse_requests(frame), ingest.request_rules())
    got = {r.id: r.violations for r in checked.collect()}
    assert got == {0: ["customer_id_valid"], 1: [], 2: ["product_ids_valid"], 3: []}


def test_dead_letters_of_messages_without_headers(spark):
    frame = spark.createDataFrame(
        [("k", "v", 1, 2, "Boom", "it broke", None)],
        "key string, value string, partition int, offset long, error_type string, "
        "error_message string, headers array<struct<key:string,value:binary>>",
    )
    made = deadletter.dead_letters(
        frame, "order-service", "order.fulfilled", F.lit(T0), own_headers=F.col("headers")
    )
    assert [h.key for h in made.first().headers][0] == "x-original-topic"


def test_delivery_quality_of_nothing(spark):
    empty = spark.createDataFrame([], "code string")
    row = fulfillment.delivery_quality(empty, empty, "code").first()
    assert (row.produced, row.delivered_percent, row.repeat_percent) == (0, "0.00", "0.00")


def test_default_hook_accepts(spark):
    frame = spark.createDataFrame(
        [("a", "c", "e")], "order_short_code string, customer_id string, event_id string"
    )
    done = fulfillment.process(frame)
    assert done.first().outcome == "fulfilled"
    event = fulfillment.fulfilled_events(done, F.lit(at(1))).first()
    assert event.fulfillment_timestamp == 1704067201000
    assert event.causation_id == "e" and event.event_id != "e"


def test_dead_letters_keep_their_headers(spark):
    frame = spark.createDataFrame(
        [("k", "v", 1, 2, "Boom", "it broke", [("event-id", b"x")])],
        "key string, value string, partition int, offset long, error_type string, "
        "error_message string, headers array<struct<key:string,value:binary>>",
    )
    made = deadletter.dead_letters(
        frame, "order-service", "order.fulfilled", F.lit(T0), own_headers=F.col("headers")
    )
    keys = [h.key for h in made.first().headers]
    assert keys[0] == "event-id" and keys[-1] == "x-exception-message" and len(keys) == 7
    assert made.first().topic == "order-service.dlq"
    assert deadletter.merge(made, made.drop("error_message")).count() == 2
