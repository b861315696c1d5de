"""Live queries over several batches, with failures in between, against the batch forms."""

import itertools
import random
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark import jobs
from tidemark.config import RetryPolicy
from tidemark.functions import ids
from tidemark.operators import metrics, ordered, outbox
from tidemark.plans.queries import as_of, refuse_empty
from tidemark.plans.streams import fail_some
from tidemark.schemas import OUTBOX_EVENTS
from tidemark.sources import files, tables
from tidemark.sources.messages import decode_placed
from tidemark.streaming import fulfillment, ingest, join, late, relay, snapshot, totals
from tidemark.streaming import metrics as live

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def parts(frame, key, count):
    """The frame cut into ``count`` frames by ranges of ``key`` (0, 1, 2, ...)."""
    size = frame.count() // count + 1
    return [frame.where(F.floor(F.col(key) / size) == n) for n in range(count)]


@pytest.fixture
def broken(monkeypatch):
    """Let the n-th write of a run fail once."""

    def arm(nth):
        real, state = files.replace_batch, {"left": nth}

        def failing(*args, **kwargs):
            state["left"] -= 1
            if state["left"] == 0:
                raise RuntimeError("the sink is away")
            return real(*args, **kwargs)

        monkeypatch.setattr(files, "replace_batch", failing)

    return arm


def run_to_the_end(start):
    """Run; if the query fails, start it again from its checkpoint."""
    for _ in range(2):
        try:
            files.finish(*start())
            return
        except Exception as error:
            assert "the sink is away" in str(error)
    raise AssertionError("failed twice")


def same(one, two):
    return one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


@pytest.mark.parametrize("fail_at", [None, 3, 6])
def test_metrics_over_batches(spark, folder, land, work, broken, fail_at):
    source = tables.purchases(tables.events(spark, folder))
    numbered = ordered.number_rows(source, ["event_time", "event_id"]).withColumn(
        "n", F.col("n") - 1
    )
    path = land(parts(numbered, "n", 4))
    if fail_at:
        broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, numbered.schema, files_per_batch=1)
        return [live.start_metrics(stream, size, work) for size in ("1h",)]

    run_to_the_end(start)
    newest = source.agg(F.max("event_time")).first()[0]
    closed = metrics.windowed_metrics(source, "1h").where(
        F.col("window_end") <= F.lit(newest) - F.expr("interval 60 seconds")
    )
    want = metrics.fill_empty_windows(closed, "1h")
    assert same(live.read_metrics(spark, work).select(*want.columns), want)


@pytest.mark.parametrize("fail_at", [None, 2, 3, 6])
def test_running_totals_over_batches(spark, folder, land, work, broken, fail_at):
    source = tables.purchases(tables.events(spark, folder))
    numbered = ordered.number_rows(source, ["event_time", "event_id"]).withColumn(
        "n", F.col("n") - 1
    )
    path = land(parts(numbered, "n", 4))
    if fail_at:
        broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, numbered.schema, files_per_batch=1)
        return [totals.start_running_totals(stream, "1h", work)]

    run_to_the_end(start)
    newest = source.agg(F.max("event_time")).first()[0]
    closed = metrics.windowed_metrics(source, "1h").where(
        F.col("window_end") <= F.lit(newest) - F.expr("interval 60 seconds")
    )
    want = metrics.running_daily_totals(closed)
    assert want.count() > 24
    assert same(totals.read_running_totals(spark, work).select(*want.columns), want)


def test_running_totals_of_quiet_batches(spark, land, work):
    """Batches that close no window hand the totals on; the next day starts from zero."""
    at = lambda text: datetime.fromisoformat(f"2024-01-{text}+00:00")
    schema = "event_time timestamp, amount double"
    batches = [
        [(at("01 22:10"), 1.0), (at("01 23:05"), 2.0)],
        [(at("01 23:06"), 4.0)],
        [(None, 5.0)],
        [(at("01 23:50"), 8.0), (at("02 00:30"), 16.0)],
        [(at("02 03:00"), 1.0)],
    ]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    files.finish(totals.start_running_totals(stream, "1h", work))
    rows = totals.read_running_totals(spark, work).orderBy("window_start").collect()
    assert [r.day_revenue_cents for r in rows] == [100, 1500, 1600]
    assert [r.day_order_count for r in rows] == [1, 4, 1]


def test_windows_of_a_hot_customer(spark, land, work):
    """One customer has half of all orders, one is null; each batch sends few rows."""
    rows = spark.range(40_000).select(
        (F.lit(1_704_067_200) + F.col("id") * 10).cast("timestamp").alias("event_time"),
        (F.col("id") % 7).cast("double").alias("amount"),
        F.when(F.col("id") % 2 == 0, 0)
        .when(F.col("id") % 5 != 0, F.col("id") % 100)
        .cast("long")
        .alias("user_id"),
        "id",
    )
    path = land(parts(rows, "id", 3))
    stream = files.stream_files(spark, path, rows.schema, files_per_batch=1)
    query = totals.start_keyed_metrics(stream, "24h", ["user_id"], work)
    files.finish(query)
    closed = metrics.windowed_metrics(rows, "24h", by=["user_id"]).where(
        F.col("window_end") <= F.timestamp_seconds(F.lit(1_704_067_200 + 399_990 - 60))
    )
    found = totals.read_keyed_metrics(spark, work, rows.select("user_id").schema)
    assert same(found.select(*closed.columns), closed) and closed.count() > 100
    assert closed.where("user_id is null").count() == 4


@pytest.mark.parametrize("fail_at", [3, 8])
def test_ingest_tables_agree_after_a_failure(spark, folder, land, work, broken, fail_at):
    requests = tables.requests(tables.events(spark, folder)).drop("partition", "offset")
    path = land(parts(requests, "request_id", 2))
    broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, requests.schema, files_per_batch=1)
        return [ingest.start_ingest(stream, "request_id", "received_at", work)]

    with pytest.raises(Exception, match="the sink is away"):
        files.finish(*start())
    if fail_at == 8:
        # The second batch is half written; readers still see the first one only.
        half = ingest.read_tables(spark, work, requests.schema["request_id"])
        assert half["orders"].count() == half["outbox_events"].count() > 0
        assert half["orders"].agg(F.max("batch_id")).first()[0] == 0
    files.finish(*start())
    done = ingest.read_tables(spark, work, requests.schema["request_id"])
    want = tables.new_orders(tables.events(spark, folder))
    assert same(done["orders"].select("order_id"), want.select("order_id"))
    assert done["outbox_events"].count() == want.count()
    assert done["quarantine"].count() == requests.count() - want.count()


def test_late_rows_do_not_reopen_a_window(spark, land, work):
    schema = "event_time timestamp, amount double"
    batches = [
        [(at(10), 1.0)],
        [(at(150), 1.0), (at(95), 1.0)],  # 95 s is 55 s behind: kept
        [(at(160), 1.0)],  # the window of minute 0 comes out here
        [(at(20), 1.0)],
        [(at(400), 1.0)],
        [(at(500), 1.0)],
    ]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    query = live.start_metrics(stream, "1m", work)
    files.finish(query)
    assert late.dropped_rows(query) == 1
    got = {
        (r.window_start - datetime(2024, 1, 1)).seconds // 60: r.order_count
        for r in live.read_metrics(spark, work).collect()
    }
    assert got == {0: 1, 1: 1, 2: 2, 3: 0, 4: 0, 5: 0, 6: 1}


def test_daily_windows_reset_at_midnight(spark, land, work):
    schema = "event_time timestamp, amount double"
    rows = [[(at(-1), 1.0), (at(0), 2.0)], [(at(90_000), 4.0)], [(at(180_000), 8.0)]]
    frames = [spark.createDataFrame(r, schema) for r in rows]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    files.finish(live.start_metrics(stream, "24h", work))
    got = live.read_metrics(spark, work).orderBy("window_start").collect()
    assert [r.revenue_cents for r in got] == [100, 200, 400]


@pytest.mark.parametrize("fail_at", [None, 3, 4])
def test_snapshot_over_batches(spark, land, work, broken, fail_at):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, 0, 1, 2, 5])) for i in range(57)]
    frame = spark.createDataFrame(rows, "id int, item_lines int")
    path = land(parts(frame, "id", 4))
    if fail_at:
        broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, frame.schema, files_per_batch=1)
        return [snapshot.start_snapshot(stream, ["id"], work)]

    run_to_the_end(start)
    want = ordered.order_count_snapshot(frame, ["id"])
    assert same(snapshot.read_snapshots(spark, work).select(*want.columns), want)


def test_one_shard_equals_the_batch_form(spark, land, work):
    # One row per file and batch fixes the order of arrival.
    rows = [(0, i, i % 5) for i in range(9)]
    frame = spark.createDataFrame(rows, "shard int, id int, item_lines int")
    path = land(parts(frame, "id", 9))
    stream = files.stream_files(spark, path, frame.schema, files_per_batch=1)
    files.finish(
        snapshot.start_sharded_snapshot(stream.select("shard", "item_lines"), "shard", work, every=4)
    )
    want = ordered.order_count_snapshot(frame, ["id"], every=4)
    assert want.count() == 2
    assert same(snapshot.read_shards(spark, work).select(*want.columns), want)


def test_shards_keep_their_own_state_over_a_restart(spark, land, work):
    first = spark.createDataFrame([(i % 2, 1) for i in range(18)], "shard int, item_lines int")
    second = spark.createDataFrame([(i % 2, 1) for i in range(8)], "shard int, item_lines int")
    path = land([first])
    for extra in (None, second):
        if extra is not None:
            path_two = land([extra], "more")
            # The same folder gets one more file.
            (new,) = Path(path_two).glob("*.parquet")
            (Path(path) / "0001.parquet").write_bytes(new.read_bytes())
        stream = files.stream_files(spark, path, first.schema)
        files.finish(snapshot.start_sharded_snapshot(stream, "shard", work))
    rows = snapshot.read_shards(spark, work).select("shard", "order_count", "item_lines")
    got = sorted(tuple(r) for r in rows.collect())
    assert got == [(0, 10, 10), (1, 10, 10)]


@pytest.mark.parametrize("fail_at", [None, 4])
def test_late_split_over_batches(spark, land, work, broken, fail_at):
    rng = random.Random(9)
    rows = [(at(i), i, at(i - rng.choice([0, 0, 30, 60, 61, 200]))) for i in range(200)]
    frame = spark.createDataFrame(rows, "arrived_at timestamp, id int, event_time timestamp")
    path = land(parts(frame, "id", 5))
    if fail_at:
        broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, frame.schema, files_per_batch=1)
        return [late.start_late_split(stream, ["arrived_at", "id"], work)]

    run_to_the_end(start)
    want = ordered.tag_late(frame, ["arrived_at", "id"]).select("id", "is_late")
    assert same(late.read_split(spark, work).select("id", "is_late"), want)


def outbox_rows(spark, count):
    payload = '{"OrderShortCode":"%s","CustomerId":"c","Items":[],"Status":0}'
    rows = [
        (f"e{i:03d}", "ORDER", f"o{i}", "ORDER_PLACED", 1, payload % f"o{i}", at(i), "PENDING", 0, None, None)
        for i in range(count)
    ]
    return spark.createDataFrame(rows, OUTBOX_EVENTS)


def fails_by_number(events):
    """e000 never fails, e001 once, ... e004 four times, e005 never, ..."""
    number = F.substring("id", 2, 3).cast("int") % 5
    return events.withColumn(
        "error", F.when(F.col("retry_count") < number, F.concat(F.lit("try "), F.col("retry_count")))
    )


@pytest.mark.parametrize("fail_at", [None, 5])
def test_relay_carries_failures_to_later_batches(spark, land, work, broken, fail_at):
    frame = outbox_rows(spark, 10)
    empty = frame.limit(0)
    path = land([frame, empty, empty, empty, empty])
    if fail_at:
        broken(fail_at)

    def start():
        stream = files.stream_files(spark, path, frame.schema, files_per_batch=1)
        return [relay.start_relay(stream, fails_by_number, work, as_of())]

    run_to_the_end(start)
    ledger = relay.read_ledger(spark, work)
    states = relay.final_states(ledger).collect()
    got = {r.id: (r.status, r.attempts, r.retry_count) for r in states}
    for i in range(10):
        fails = i % 5
        want = ("FAILED", 4, 3) if fails == 4 else ("PUBLISHED", fails + 1, fails)
        assert got[f"e{i:03d}"] == want
    letters = spark.read.parquet(f"{work}/dead_letters")
    assert {r.key for r in letters.collect()} == {"o4", "o9"}
    sent = spark.read.parquet(f"{work}/published")
    assert sent.count() == 8
    assert [h.key for h in sent.first().headers][0] == "event-id"


def test_relay_rounds_settle_events_in_one_batch(spark, land, work):
    frame = outbox_rows(spark, 10)
    stream = files.stream_files(spark, land([frame]), frame.schema)
    files.finish(relay.start_relay(stream, fails_by_number, work, as_of(), rounds=4))
    states = relay.final_states(relay.read_ledger(spark, work))
    assert states.where("status = 'PUBLISHED'").count() == 8
    counts = outbox.outcome_counts(relay.read_ledger(spark, work), ["round"])
    got = {r["round"]: (r.received, r.published, r.failed) for r in counts.collect()}
    assert got == {0: (10, 2, 8), 1: (8, 2, 6), 2: (6, 2, 4), 3: (4, 2, 2)}


def test_fulfillment_routes_every_message_once(spark, folder, land, work):
    rows = tables.fresh_outbox(tables.events(spark, folder))
    messages = tables.placed_messages(rows).drop("request_id")
    numbered = messages.withColumn("n", F.monotonically_increasing_id())
    path = land([numbered.where(F.col("n") % 3 == i).drop("n") for i in range(3)])
    stream = files.stream_files(spark, path, messages.schema, files_per_batch=1)
    files.finish(fulfillment.start_fulfillment(stream, work, as_of(), refuse_empty))
    routed = fulfillment.route(decode_placed(messages, as_of()), refuse_empty)
    assert same(fulfillment.read_outcomes(spark, work), routed.select("key", "outcome"))
    done = spark.read.parquet(f"{work}/fulfilled").first()
    assert done.event_id != done.causation_id


@pytest.mark.parametrize("policy,letters", [("dead_letter", 2), ("acknowledge", 0)])
def test_status_changes_over_batches(spark, land, work, policy, letters):
    store = spark.createDataFrame(
        [("a", "PENDING", T0), ("b", "SHIPPED", T0), ("c", "FULFILLED", T0), ("d", "PENDING", T0)],
        "code string, status string, updated_at timestamp",
    )
    schema = "code string, ts int"
    batches = [[("a", 1), ("a", 2), ("x", 1)], [("a", 3), ("b", 4), ("c", 5), ("y", 1)]]
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    files.finish(
        fulfillment.start_status_apply(
            stream, lambda: store, "code", work, as_of(), ["ts"], unknown_order=policy
        )
    )
    changes = fulfillment.read_changes(spark, work, stream.schema["code"])
    assert [(r.code, r.old_status, r.batch_id) for r in changes.collect()] == [("a", "PENDING", 0)]
    now = fulfillment.current_orders(store, changes, "code", as_of())
    assert {r.code: r.status for r in now.collect()} == {
        "a": "FULFILLED",
        "b": "SHIPPED",
        "c": "FULFILLED",
        "d": "PENDING",
    }
    if letters:
        assert spark.read.parquet(f"{work}/dead_letters").count() == letters
    else:
        assert {r.key for r in spark.read.parquet(f"{work}/acknowledged").collect()} == {"x", "y"}


def status_rows(spark, rows):
    """Decoded fulfilled messages: code, ts, value and metadata."""
    schema = (
        "code string, ts int, value string, metadata struct<event_id:string,event_version:int,"
        "occurred_at:timestamp,entity_type:string,entity_id:string,state:string>"
    )
    return spark.createDataFrame(
        [(c, t, f"v{c}{t}", (f"id{c}{t}", 1, T0, "Order", c, state)) for c, t, state in rows], schema
    )


def test_an_event_may_overtake_its_order(spark, land, work):
    """The order is stored one batch after its event came; another order never is."""
    empty = status_rows(spark, [])
    rows = [("a", 1, "ok"), ("x", 1, "ok"), ("x", 2, "default")]
    first = status_rows(spark, [*rows, (None, 3, "ok"), ("a", 4, "malformed")])
    known = {0: [], 1: [("a", "PENDING", T0)], 2: [("a", "PENDING", T0)]}
    path = land([first])

    def store():
        return spark.createDataFrame(
            known[min(now, 2)], "code string, status string, updated_at timestamp"
        )

    for now in range(3):
        stream = files.stream_files(spark, path, empty.schema)
        files.finish(
            fulfillment.start_status_apply(
                stream, store, "code", work, F.lit(at(3600 * now)), ["ts"], policy=RetryPolicy()
            )
        )
    changes = fulfillment.read_changes(spark, work, empty.schema["code"]).collect()
    assert [(r.code, r.batch_id) for r in changes] == [("a", 1)]
    letters = spark.read.parquet(f"{work}/dead_letters").collect()
    assert sorted(r.value for r in letters) == ["vx1", "vx2"]
    assert {r.batch_id for r in letters} == {2}
    for letter in letters:
        keys = [h.key for h in letter.headers]
        assert keys[:5] == ["event-id", "event-version", "occurred-at", "entity-type", "entity-id"]
        assert "x-exception-type" in keys
    aside = spark.read.parquet(f"{work}/quarantine").collect()
    assert sorted(r.value for r in aside) == ["vNone3", "va4"]


def test_failed_events_come_up_while_the_outbox_is_quiet(spark, land, work):
    frame = outbox_rows(spark, 10)
    path = land([frame])
    for turn in range(1, 5):
        stream = files.stream_files(spark, path, frame.schema)
        files.finish(relay.start_relay(stream, fails_by_number, work, as_of()))
        states = {r.id: r for r in relay.final_states(relay.read_ledger(spark, work)).collect()}
        assert states["e004"].attempts == turn
    assert states["e003"].status == "PUBLISHED" and states["e004"].status == "FAILED"
    sent = [r.key for r in spark.read.parquet(f"{work}/published").collect()]
    assert len(sent) == len(set(sent)) == 8


@pytest.mark.parametrize("rounds", [(2, 1, 1, 1), (1, 3, 1, 1), (3, 1, 2, 1)])
def test_rounds_may_change_at_a_restart(spark, land, work, rounds):
    frame = outbox_rows(spark, 10)
    path = land([frame])
    for number in rounds:
        stream = files.stream_files(spark, path, frame.schema)
        files.finish(relay.start_relay(stream, fails_by_number, work, as_of(), rounds=number))
    states = relay.final_states(relay.read_ledger(spark, work)).collect()
    got = {r.id: (r.status, r.attempts) for r in states}
    for i in range(10):
        assert got[f"e{i:03d}"] == (("FAILED", 4) if i % 5 == 4 else ("PUBLISHED", i % 5 + 1))
    sent = [r.key for r in spark.read.parquet(f"{work}/published").collect()]
    assert len(sent) == len(set(sent)) == 8


def test_a_running_relay_polls(spark, land, work):
    frame = outbox_rows(spark, 5)
    stream = files.stream_files(spark, land([frame]), frame.schema)
    query = relay.start_relay(stream, fails_by_number, work, as_of(), interval="200 milliseconds")
    try:
        for _ in range(120):
            time.sleep(0.5)
            if query.lastProgress and query.lastProgress["batchId"] >= 4:
                break
    finally:
        query.stop()
    states = {r.id: r.status for r in relay.final_states(relay.read_ledger(spark, work)).collect()}
    assert states == {f"e{i:03d}": "FAILED" if i == 4 else "PUBLISHED" for i in range(5)}


def test_processing_is_tried_again(spark, folder, land, work):
    rows = tables.fresh_outbox(tables.events(spark, folder)).limit(40)
    messages = tables.placed_messages(rows).drop("request_id")
    path = land([messages])
    for turn in range(3):
        stream = files.stream_files(spark, path, messages.schema)
        files.finish(
            fulfillment.start_fulfillment(
                stream, work, F.lit(at(3600 * turn)), fail_some, policy=RetryPolicy()
            )
        )
        waiting = spark.read.parquet(f"{work}/waiting/batch_id={turn}")
        assert {r.attempt for r in waiting.collect()} <= {turn + 2}
    assert waiting.count() == 0
    outcomes = fulfillment.read_outcomes(spark, work)
    assert outcomes.count() == messages.count()


def test_stream_join_gives_matches_and_overdue_orders(spark, land, work):
    placed = [(f"o{i}", at(60 * i)) for i in range(0, 400, 10)]
    done = [(code, when + timedelta(minutes=5 + 8 * (i % 10))) for i, (code, when) in enumerate(placed)]
    left = spark.createDataFrame(placed, "code string, placed_at timestamp")
    right = spark.createDataFrame(sorted(done, key=lambda r: r[1]), "code string, fulfilled_at timestamp")
    half = F.lit(at(12_000))
    early, done_early = F.col("placed_at") < half, F.col("fulfilled_at") < half
    lefts = land([left.where(early), left.where(~early)], "l")
    rights = land([right.where(done_early), right.where(~done_early)], "r")
    joined = join.placed_fulfilled_stream(
        files.stream_files(spark, lefts, left.schema, files_per_batch=1),
        files.stream_files(spark, rights, right.schema, files_per_batch=1),
        "code",
    )
    files.finish(join.start_join(joined, work))
    got = {r.code: r.fulfilled_at for r in join.read_joined(spark, work, joined.schema).collect()}
    in_time = {code for (code, when), (_, then) in zip(placed, done) if then - when <= timedelta(hours=1)}
    assert {c for c, f in got.items() if f is not None} == in_time
    overdue = {c for c, f in got.items() if f is None}
    assert overdue and overdue <= {c for c, _ in placed} - in_time


def test_repeats_are_dropped_in_the_stream(spark, land, work):
    frame = spark.createDataFrame(
        [("a", at(0)), ("a", at(5)), ("b", at(6)), ("a", at(9))], "code string, ts timestamp"
    )
    stream = files.stream_files(spark, land([frame, frame]), frame.schema, files_per_batch=1)
    files.finish(join.start_join(join.drop_repeats(stream, "code", "ts", "10 minutes"), work))
    assert sorted(r.code for r in spark.read.parquet(f"{work}/joined").collect()) == ["a", "b"]


def test_ids_do_not_change_on_replay(spark):
    frame = spark.range(5).select(ids.stable_uuid("outbox", F.col("id")).alias("x"))
    assert same(frame, frame)


def test_jobs_from_messages_to_status(spark, folder, land, work):
    """Outbox rows through all services, topic messages kept in folders."""
    sent = itertools.count()

    def send(frame):
        columns = [c for c in ("topic", "value", "key", "headers") if c in frame.columns]
        frame.select(*columns).write.parquet(f"{work}/topics/{next(sent):04d}")

    def topic(name):
        frames = [spark.read.parquet(str(p)) for p in sorted(Path(work, "topics").iterdir())]
        keyed = [f for f in frames if "key" in f.columns]
        rows = keyed[0]
        for frame in keyed[1:]:
            rows = rows.unionByName(frame)
        return rows.where(F.col("topic") == name).withColumns(
            {"partition": F.lit(0), "offset": F.monotonically_increasing_id()}
        )

    frame = outbox_rows(spark, 20).withColumn("id", ids.stable_uuid("outbox", F.col("id")))
    accept = lambda rows: rows.withColumn("error", F.lit(None).cast("string"))
    stream = files.stream_files(spark, land([frame], "outbox"), frame.schema)
    files.finish(jobs.outbox_relay(stream, f"{work}/relay", accept, interval=None, send=send))

    placed = topic(C.TOPIC_ORDER_PLACED)
    assert placed.count() == 20
    path = land([placed], "placed")
    read = lambda: files.stream_files(spark, path, placed.schema)
    files.finish(
        *jobs.order_metrics(read(), f"{work}/metrics", ["1m"], interval=None, send=send),
        jobs.order_snapshots(read(), f"{work}/snapshots", interval=None),
        jobs.fulfillment_service(read(), f"{work}/fulfillment", interval=None, send=send),
    )
    snapshots = snapshot.read_snapshots(spark, f"{work}/snapshots").collect()
    assert sorted(r.order_count for r in snapshots) == [10, 20]

    done = topic(C.TOPIC_ORDER_FULFILLED)
    assert done.count() == 20
    store = spark.createDataFrame(
        [(f"o{i}", "PENDING", T0) for i in range(19)],
        "order_short_code string, status string, updated_at timestamp",
    )
    stream = files.stream_files(spark, land([done], "done"), done.schema)
    files.finish(
        jobs.order_status(
            stream,
            lambda: store,
            f"{work}/status",
            interval=None,
            send=send,
            policy=RetryPolicy(max_attempts=1),
        )
    )
    changes = fulfillment.read_changes(spark, f"{work}/status", store.schema["order_short_code"])
    assert changes.count() == 19
    letters = topic(C.TOPIC_ORDER_DLQ)
    assert [r.key for r in letters.collect()] == ["o19"]
