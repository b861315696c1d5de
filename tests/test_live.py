"""Deliveries with outcomes, keyed status, corrected windows and the as-of match."""

import itertools
import random
from collections import Counter
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.config import RetryPolicy
from tidemark.functions import retry
from tidemark.operators import asof, fulfillment, metrics
from tidemark.schemas import OUTBOX_EVENTS
from tidemark.sources import files
from tidemark.streaming import corrections, delivery, keyed_status, relay, retries, snapshot

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def at(seconds):
    return T0 + timedelta(seconds=seconds)


def as_of():
    return F.lit("2024-02-01 00:00:00").cast("timestamp")


def file_client(folder):
    """Keeps what it takes in one file per task; refuses odd orders."""

    class FileClient:  # local, so that it travels to the workers by value
        def __init__(self):
            self.path = Path(folder) / f"{random.getrandbits(64):x}"
            self.lines = []

        def send(self, message):
            if int(message["key"][1:]) % 2:
                raise delivery.Refused(f"no room for {message['key']}", "Local_Transport")
            self.lines.append(message["key"])

        def close(self):
            self.path.write_text("\n".join(self.lines))

    return FileClient


def outbox_rows(spark, count):
    rows = [
        (
            f"id{i}", "ORDER", f"o{i}", "ORDER_PLACED", 1,
            None if i == 4 else f'{{"OrderShortCode": "o{i}", "CustomerId": "c", "Items": []}}',
            at(i), "PENDING", 0, None, None,
        )
        for i in range(count)
    ]
    return spark.createDataFrame(rows, OUTBOX_EVENTS)


def taken(folder):
    return Counter(k for p in Path(folder).iterdir() for k in p.read_text().split())


def test_published_is_what_the_client_took(spark, land, work):
    sink = Path(work) / "sink"
    sink.mkdir()
    frame = outbox_rows(spark, 20)
    stream = files.stream_files(spark, land([frame], "outbox"), frame.schema)
    folder = str(sink)
    files.finish(
        relay.start_relay(
            stream, None, f"{work}/relay", as_of(), connect=file_client(folder)
        )
    )
    states = {r.id: r for r in relay.final_states(relay.read_ledger(spark, f"{work}/relay")).collect()}
    published = {i for i, r in states.items() if r.status == "PUBLISHED"}
    assert published == {f"id{k[1:]}" for k in taken(sink)}
    assert states["id3"].status == "FAILED" and states["id3"].last_error == "no room for o3"
    assert states["id4"].status == "PROCESSING"  # nothing to send


def test_a_written_ledger_is_not_sent_again(spark, land, work, monkeypatch):
    """The run breaks off after the ledger; the second one sends no message twice."""
    sink = Path(work) / "sink"
    sink.mkdir()
    frame = outbox_rows(spark, 20)
    path, folder = land([frame], "outbox"), str(sink)
    real, left = files.replace_batch, itertools.count(1)

    def failing(df, target, *rest, **options):
        if target.endswith("/published") and next(left) == 1:
            raise RuntimeError("the sink is away")
        return real(df, target, *rest, **options)

    monkeypatch.setattr(files, "replace_batch", failing)
    start = lambda: relay.start_relay(
        files.stream_files(spark, path, frame.schema),
        None, f"{work}/relay", as_of(), connect=file_client(folder),
    )
    with pytest.raises(Exception, match="the sink is away"):
        files.finish(start())
    files.finish(start())
    assert set(taken(sink).values()) == {1}
    ledger = relay.read_ledger(spark, f"{work}/relay")
    done = {r.id for r in ledger.where("status = 'PUBLISHED'").collect()}
    assert done == {f"id{k[1:]}" for k in taken(sink)}


def test_a_client_that_does_not_connect_fails_its_rows(spark):
    def connect():
        raise OSError("no route")

    rows = spark.createDataFrame([("a", 1), ("b", 2)], "key string, n int").withColumn(
        delivery.MESSAGE, F.struct("key", "n")
    )
    found = delivery.deliver(rows, connect, "key", ["n"]).collect()
    assert {(r.error, r.error_code, r.fatal) for r in found} == {("no route", "OSError", False)}
    none = delivery.deliver(rows.limit(0), connect, "key", ["n"])
    assert none.count() == 0


def test_only_transient_errors_are_tried_again(spark):
    failed = spark.createDataFrame(
        [("a", "Local_Transport", False, 1), ("b", "MsgSizeTooLarge", False, 1),
         ("c", "Local_Transport", True, 1), ("d", "Local_Transport", False, 3), ("e", None, None, 1)],
        "id string, code string, fatal boolean, attempt int",
    ).withColumn("next_attempt_at", as_of())
    transient = retry.is_transient(F.col("code"), F.col("fatal"))
    waiting, gone = retries.again(failed, as_of(), RetryPolicy(), transient)
    assert [r.id for r in waiting.collect()] == ["a"]
    assert sorted(r.id for r in gone.collect()) == ["b", "c", "d", "e"]


def brute_first(placed, done):
    return {
        (c, t): min((u for d, u in done if d == c and u >= t), default=None) for c, t in set(placed)
    }


@pytest.mark.parametrize("slices", [1, 3, 17])
def test_asof_with_a_key_that_holds_half_of_all_rows(spark, slices):
    drawn = random.Random(slices)
    code = lambda: "hot" if drawn.random() < 0.5 else f"c{drawn.randrange(30)}"
    placed = [(code(), at(drawn.randrange(5000))) for _ in range(400)]
    done = [(code(), at(drawn.randrange(5000))) for _ in range(300)] + [placed[0], placed[1]]
    orders = spark.createDataFrame(placed + [(None, at(1)), ("c1", None)], "code string, placed_at timestamp")
    events = spark.createDataFrame(done + [(None, at(2)), ("c1", None)], "code string, fulfilled_at timestamp")
    cut = asof.next_event(orders, events, "code", "placed_at", "fulfilled_at", slices=slices)
    found = {(r.code, r.placed_at.astimezone(timezone.utc)): r.fulfilled_at.astimezone(timezone.utc) for r in cut.collect()}
    assert found == {k: v for k, v in brute_first(placed, done).items() if v}
    joined = fulfillment.first_fulfilled(orders, events, "code", unique=True)
    assert joined.exceptAll(cut).count() == 0 and cut.exceptAll(joined).count() == 0
    plan = cut._jdf.queryExecution().toString()
    assert "SortMergeJoin" not in plan


def test_asof_of_empty_sides(spark):
    orders = spark.createDataFrame([("a", T0)], "code string, placed_at timestamp")
    events = spark.createDataFrame([], "code string, fulfilled_at timestamp")
    assert asof.next_event(orders, events, "code", "placed_at", "fulfilled_at").count() == 0
    assert asof.next_event(orders.limit(0), events, "code", "placed_at", "fulfilled_at").count() == 0


EVENT = "code string, fulfilled_at timestamp, line int"


def statuses(spark, land, work, parts, stored, **options):
    """One start per part, so that each goes on from the checkpoint of the one before."""
    first = spark.createDataFrame(stored, "code string, status string")
    for turn in range(len(parts)):
        # Later starts get a store where all is done: were it read, nothing would change.
        store = first.withColumn("status", F.lit("SHIPPED")) if turn else first
        frames = [spark.createDataFrame(rows, EVENT) for rows in parts[: turn + 1]]
        path = f"{work}/in"
        frames[-1].coalesce(1).write.mode("append").parquet(path)
        events = files.stream_files(spark, path, frames[-1].schema)
        outcomes = keyed_status.status_outcomes(
            events, store, "code", ["fulfilled_at", "line"], **options
        )
        files.finish(keyed_status.start_keyed_status(outcomes, f"{work}/status"))
    rows = keyed_status.read_outcomes(spark, f"{work}/status", outcomes.schema).collect()
    return sorted((r.code, r.outcome, r.old_status, r.event.line) for r in rows)


def test_repeats_in_later_batches_are_skipped(spark, land, work):
    parts = [
        [("a", at(9), 1), ("a", at(3), 2), ("b", at(1), 3), ("x", at(1), 4)],
        [("a", at(1), 5), ("c", at(1), 6), ("x", at(2), 7), (None, at(1), 8)],
        [("c", at(0), 9), ("d", at(1), 10), ("d", at(1), 11)],
    ]
    stored = [("a", "PENDING"), ("b", "SHIPPED"), ("c", "PENDING"), ("d", None), ("e", "PENDING")]
    assert statuses(spark, land, work, parts, stored) == [
        ("a", "changed", "PENDING", 2),
        ("c", "changed", "PENDING", 6),
        ("x", "unknown", None, 4),
        ("x", "unknown", None, 7),
    ]


def test_an_event_waits_for_its_order(spark, land, work):
    """The order comes in a later batch of the same stream and releases the waiting event."""
    store = spark.createDataFrame([("a", "PENDING")], "code string, status string")
    events, orders = f"{work}/events", f"{work}/orders"
    for name, schema, path in (("e", EVENT, events), ("o", "code string, status string", orders)):
        spark.createDataFrame([], schema).write.parquet(path)
    steps = [
        (events, [("n", at(1), 1), ("n", at(0), 2), ("a", at(1), 3)], EVENT),
        (orders, [("n", "PENDING")], "code string, status string"),
        (events, [("n", at(5), 4)], EVENT),
    ]
    for path, rows, schema in steps:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        outcomes = keyed_status.status_outcomes(
            files.stream_files(spark, events),
            store,
            "code",
            ["fulfilled_at", "line"],
            new_orders=files.stream_files(spark, orders),
            wait=timedelta(hours=1),
            ttl=timedelta(days=30),
        )
        files.finish(keyed_status.start_keyed_status(outcomes, f"{work}/status"))
    rows = keyed_status.read_outcomes(spark, f"{work}/status", outcomes.schema).collect()
    assert sorted((r.code, r.outcome, r.event.line) for r in rows) == [
        ("a", "changed", 3),
        ("n", "changed", 2),
    ]


def test_the_wait_runs_out(spark, land, work):
    parts = [[("n", at(1), 1)], [("z", at(1), 2)], [("a", at(2), 3)]]
    found = statuses(spark, land, work, parts, [("a", "PENDING")], wait=timedelta(milliseconds=1))
    assert ("n", "unknown", None, 1) in found and ("a", "changed", "PENDING", 3) in found


def corrected(spark, work, land, batches, size="1m", **options):
    schema = "event_time timestamp, amount double"
    frames = [spark.createDataFrame(rows, schema) for rows in batches]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    files.finish(corrections.start_corrected_metrics(stream, size, f"{work}/out", **options))
    return frames


def test_late_rows_come_out_as_versions(spark, work, land):
    batches = [
        [(at(0), 1.0), (at(200), 2.0)],
        [(at(10), 4.0), (at(400), 1.0), (None, 9.0)],
        [(at(20), 8.0), (at(15), 16.0), (at(401), None), (at(-100), 3.0)],
    ]
    corrected(spark, work, land, batches)
    versions = {
        (r.window_start.astimezone(timezone.utc), r.version): (r.order_count, r.revenue_cents)
        for r in corrections.read_versions(spark, f"{work}/out").collect()
    }
    assert versions[T0, 1] == (1, 100) and versions[T0, 2] == (2, 500) and versions[T0, 3] == (4, 2900)
    assert versions[at(60), 1] == (0, 0) and versions[at(180), 1] == (1, 200)
    assert versions[at(-120), 1] == (1, 300) and versions[at(-60), 1] == (0, 0)
    assert (at(360), 1) not in versions  # still open


@pytest.mark.parametrize("seed", range(2))
def test_newest_versions_equal_the_recalculation(spark, work, land, seed):
    drawn = random.Random(seed)
    rows = [(at(drawn.randrange(7200)), float(drawn.randrange(100))) for _ in range(300)]
    rows.sort(key=lambda r: r[0] + timedelta(seconds=drawn.choice([0, 0, 30, 2000])))
    batches = [rows[i : i + 100] for i in range(0, 300, 100)]
    frames = corrected(spark, work, land, batches)
    stream = files.stream_files(spark, f"{work}/in", frames[0].schema)
    clock = F.lit("2024-01-01 05:00:00").cast("timestamp")
    files.finish(corrections.start_corrected_metrics(stream, "1m", f"{work}/out", now=clock))
    found = corrections.read_latest(spark, f"{work}/out").drop("version")
    everything = frames[0].union(frames[1]).union(frames[2])
    until = F.lit("2024-01-01 04:58:00").cast("timestamp")
    want = metrics.fill_empty_windows(
        metrics.windowed_metrics(everything, "1m"), "1m", until=until
    ).select(*found.columns)
    assert found.exceptAll(want).count() == 0 and want.exceptAll(found).count() == 0


def test_a_batch_that_breaks_off_counts_no_row_twice(spark, work, land, monkeypatch):
    real, left = files.replace_batch, itertools.count(1)

    def failing(*args, **options):
        if next(left) == 6:
            raise RuntimeError("the sink is away")
        return real(*args, **options)

    monkeypatch.setattr(files, "replace_batch", failing)
    batches = [[(at(0), 1.0), (at(300), 1.0)], [(at(5), 1.0), (at(600), 1.0)]]
    with pytest.raises(Exception, match="the sink is away"):
        corrected(spark, work, land, batches)
    stream = files.stream_files(spark, f"{work}/in", files_per_batch=1)
    files.finish(corrections.start_corrected_metrics(stream, "1m", f"{work}/out"))
    latest = {
        r.window_start.astimezone(timezone.utc): (r.order_count, r.version)
        for r in corrections.read_latest(spark, f"{work}/out").collect()
    }
    assert latest[T0] == (2, 2) and latest[at(300)] == (1, 1)


@pytest.mark.parametrize("seed", range(2))
def test_shard_totals_do_not_depend_on_arrival(spark, land, work, seed):
    drawn = random.Random(seed)
    rows = [(at(i // 2), i, i % 3, drawn.randrange(1, 5)) for i in range(240)]
    # Out of order by less than the watermark allows.
    arrived = sorted(rows, key=lambda r: r[0] + timedelta(seconds=drawn.randrange(30)))
    schema = "event_time timestamp, event_id long, shard long, item_lines long"
    frames = [spark.createDataFrame(arrived[i : i + 60], schema) for i in range(0, 240, 60)]
    stream = files.stream_files(spark, land(frames), frames[0].schema, files_per_batch=1)
    files.finish(snapshot.start_ordered_shards(stream, "shard", f"{work}/out", every=5))
    want, reached = set(), max(r[0] for r in rows) - timedelta(seconds=60)
    for shard in range(3):
        total = 0
        mine = sorted(r for r in rows if r[2] == shard and r[0] <= reached)
        for n, row in enumerate(mine, 1):
            total += row[3]
            if n % 5 == 0:
                want.add((shard, n, total))
    found = snapshot.read_shards(spark, f"{work}/out").collect()
    assert len(found) == len(want) and {tuple(r) for r in found} == want


class FakeState:
    """The state of one grouping key; counts the calls, each of which leaves the process."""

    def __init__(self):
        self.value, self.calls = None, 0

    def getValueState(self, name, schema, ttl=None):
        return self

    def getListState(self, name, schema, ttl=None):
        return FakeState()

    def exists(self):
        self.calls += 1
        return self.value is not None

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls += 1
        self.value = value


@pytest.mark.parametrize("seed", range(5))
def test_a_bucket_does_what_its_codes_do_with_a_few_state_calls(spark, seed):
    drawn = random.Random(seed)
    event = StructType.fromDDL("code string, line int, part int")
    codes = [f"c{i}" for i in range(30)]
    kinds = ["PENDING", "FULFILLED", "SHIPPED", "odd", None]
    stored = [(drawn.choice(codes[:20]), drawn.choice(kinds)) for _ in range(25)]
    batches = []
    for _ in range(4):
        rows = []
        for number in range(60):
            code = drawn.choice(codes)
            if drawn.random() < 0.1:
                rows.append(Row(code=code, kind="order", status=drawn.choice(kinds), event=None))
            else:
                values = {"code": code, "line": drawn.choice([None, 1, 2, 3]), "part": number}
                rows.append(Row(code=code, kind="event", status=None, event=values))
        batches.append(rows)

    def outcomes(processor, state, key, rows):
        processor.init(state)
        return [tuple(r) for r in processor.handleInputRows(key, iter(rows), None)]

    one_by_one, states = [], {code: FakeState() for code in codes}
    single = keyed_status.StatusProcessor("code", event, ["line", "part"], "FULFILLED", 0, 0)
    for code, status in stored:
        single.init(states[code])
        single.handleInitialState((code,), Row(status=status), None)
    for rows in batches:
        found = []
        for code in codes:
            own = [row for row in rows if row.code == code]
            found += outcomes(single, states[code], (code,), own) if own else []
        one_by_one.append(found)
    state, together = FakeState(), keyed_status.BucketProcessor("code", event, ["line", "part"], "FULFILLED")
    together.init(state)
    orders = [{"code": code, "status": status} for code, status in stored]
    together.handleInitialState((0,), Row(bucket=0, orders=orders), None)
    for rows, want in zip(batches, one_by_one):
        found = outcomes(together, state, (0,), rows)
        assert sorted(map(str, found)) == sorted(map(str, want))
    # Before, each of the 30 codes had state of its own: some hundred calls.
    assert state.calls <= 3 * (len(batches) + 1)


def test_new_orders_without_a_wait(spark, land, work):
    """An order that comes with its events or before them counts; earlier events were unknown."""
    store = spark.createDataFrame([("a", "PENDING"), (None, "PENDING")], "code string, status string")
    events, orders = f"{work}/events", f"{work}/orders"
    spark.createDataFrame([], EVENT).write.parquet(events)
    spark.createDataFrame([], "code string, status string").write.parquet(orders)
    steps = [
        ([("n", at(1), 1), ("m", at(3), 2), ("m", at(2), 3), ("a", at(1), 4)], [("m", "PENDING")]),
        ([("n", at(2), 5), ("m", at(0), 6)], [("n", "PENDING"), ("a", "PENDING"), (None, "PENDING")]),
        ([("n", at(0), 7), ("a", at(0), 8)], []),
    ]
    for sent, made in steps:
        for path, rows, schema in ((events, sent, EVENT), (orders, made, "code string, status string")):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        outcomes = keyed_status.status_outcomes(
            files.stream_files(spark, events),
            store,
            "code",
            ["fulfilled_at", "line"],
            new_orders=files.stream_files(spark, orders),
        )
        assert "bucket" in outcomes._jdf.queryExecution().logical().toString()
        files.finish(keyed_status.start_keyed_status(outcomes, f"{work}/status"))
    rows = keyed_status.read_outcomes(spark, f"{work}/status", outcomes.schema).collect()
    assert sorted((r.code, r.outcome, r.event.line) for r in rows) == [
        ("a", "changed", 4),
        ("m", "changed", 3),
        ("n", "changed", 5),
        ("n", "unknown", 1),
    ]
