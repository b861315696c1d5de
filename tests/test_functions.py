from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tidemark import config as C
from tidemark.functions import headers, ids, items, money, retry, times
from tidemark.schemas import HEADERS, ORDER_PLACED, WINDOWED_METRIC
from tidemark.sources import topics, wire


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "total,count,mean",
    [(500, 8, "0.63"), (123456, 42, "29.39"), (0, 3, "0.00"), (7, 0, "0.00"), (-500, 8, "-0.63")],
)
def test_half_up_mean(spark, total, count, mean):
    # 500 hundredths over 8 is 62.5, which rounds to 63 hundredths.
    value = money.half_up_mean(F.lit(total).cast("bigint"), F.lit(count).cast("bigint"))
    assert one(spark, money.hundredths_text(value)) == mean


def test_plain_text_has_no_exponent(spark):
    big = F.lit(123456789012345678).cast("bigint")
    assert one(spark, money.hundredths_text(big)) == "1234567890123456.78"


def test_cents_of_decimal_and_double(spark):
    assert one(spark, money.to_cents(F.lit("1234.56").cast("decimal(18,2)"))) == 123456
    assert one(spark, money.to_cents(F.lit(0.29))) == 29


@pytest.mark.parametrize(
    "attempt,delay",
    [(1, 100), (2, 200), (3, 400), (7, 6400), (8, 10000), (9, 10000), (400, 10000)],
)
def test_backoff(spark, attempt, delay):
    assert one(spark, retry.backoff_ms(F.lit(attempt))) == delay


@pytest.mark.parametrize(
    "code,fatal,transient",
    [
        ("Local_Transport", False, True),
        ("Local_AllBrokersDown", False, True),
        ("UnknownTopicOrPart", False, True),
        ("Local_Transport", True, False),
        ("MsgSizeTooLarge", False, False),
    ],
)
def test_transient(spark, code, fatal, transient):
    assert one(spark, retry.is_transient(F.lit(code), F.lit(fatal))) is transient


def test_iso_text_and_back(spark):
    instant = F.lit("2024-01-01T00:00:07.179575Z").cast("timestamp")
    assert one(spark, times.iso_text(instant)) == "2024-01-01T00:00:07.1795750Z"
    back = times.parse_iso(F.lit("2024-01-01T00:00:07.1795759Z"))
    assert one(spark, F.unix_micros(back)) == 1704067207179575
    assert one(spark, times.parse_iso(F.lit("yesterday-ish"))) is None


def test_millis_are_cut_not_rounded(spark):
    instant = F.lit("1970-01-01T00:00:00.0019Z").cast("timestamp")
    assert one(spark, times.millis(instant)) == 1
    assert one(spark, times.millis(times.from_millis(F.lit(1745736000000)))) == 1745736000000


def test_ids(spark):
    made = one(spark, ids.stable_uuid("order", F.lit(7)))
    assert one(spark, ids.parse_uuid(F.lit(made.upper()))) == made
    assert one(spark, ids.parse_uuid(F.lit("not-a-uuid"))) is None
    assert one(spark, ids.parse_uuid(ids.random_uuid())) is not None
    code = one(spark, ids.short_code(F.lit(7)))
    assert len(code) == 10 and set(code).isdisjoint("+/=")


def test_line_count(spark):
    rows = spark.createDataFrame(
        [(["a", "b"],), ([],), (None,)], "items array<string>"
    ).select(items.line_count(F.col("items")).alias("n"))
    assert [r.n for r in rows.collect()] == [2, 0, 0]


def headers_frame(spark, pairs):
    rows = [(None if pairs is None else [(k, v.encode()) for k, v in pairs],)]
    return spark.createDataFrame(rows, f"headers {HEADERS.simpleString()}")


GOOD = [
    ("event-id", "529F0699-0367-43a8-93e3-b792b2eb2dd8"),
    ("event-version", "3"),
    ("occurred-at", "2024-01-01T00:00:00.0000000Z"),
    ("entity-type", "ORDER"),
    ("entity-id", "abc"),
]


def metadata(spark, pairs):
    now = F.lit(datetime(2024, 2, 1, tzinfo=timezone.utc))
    return headers.read_metadata(headers_frame(spark, pairs), F.lit("fresh"), now).first().metadata


def test_metadata_complete(spark):
    m = metadata(spark, GOOD)
    assert (m.event_id, m.event_version, m.entity_type, m.entity_id, m.state) == (
        "529f0699-0367-43a8-93e3-b792b2eb2dd8",
        3,
        "ORDER",
        "abc",
        "ok",
    )


@pytest.mark.parametrize("missing", range(5))
def test_one_missing_header_gives_the_whole_default(spark, missing):
    m = metadata(spark, GOOD[:missing] + GOOD[missing + 1 :])
    assert (m.event_id, m.event_version, m.entity_type, m.entity_id, m.state) == (
        "fresh",
        1,
        "Order",
        "",
        "default",
    )


def test_no_headers_give_the_default(spark):
    assert metadata(spark, None).state == "default"


@pytest.mark.parametrize(
    "place,text", [(0, "not-a-uuid"), (1, "x"), (2, "some day")]
)
def test_malformed_header_is_marked(spark, place, text):
    pairs = list(GOOD)
    pairs[place] = (pairs[place][0], text)
    assert metadata(spark, pairs).state == "malformed"


def test_repeated_header(spark):
    frame = headers_frame(spark, [("x-original-topic", "a"), ("x-original-topic", "b")])
    first = headers.first_value(F.col("headers"), "x-original-topic")
    row = frame.select(
        first.alias("first"),
        headers.original_topic(F.col("headers")).alias("last"),
        headers.failure_timestamp(F.col("headers")).alias("none"),
    ).first()
    assert tuple(row) == ("a", "b", "")


def test_dead_letter_headers_without_error(spark):
    made = headers.dead_letter_headers(
        F.lit("t"), F.lit(1), F.lit(2), F.current_timestamp(), F.lit(None).cast("string"), F.lit("m")
    )
    keys = one(spark, F.transform(made, lambda h: h["key"]))
    assert keys == ["x-original-topic", "x-failure-timestamp", "x-partition", "x-offset"]


def test_frame_round_trip(spark):
    record = F.struct(
        F.lit("abc").alias("orderShortCode"),
        F.lit("c").alias("customerId"),
        F.array(F.struct(F.lit("p").alias("productId"), F.lit(2).alias("count"))).alias("items"),
    )
    value = wire.encode_json(record, 258)
    assert one(spark, F.hex(value)).startswith("0000000102")
    assert one(spark, wire.schema_id(value)) == 258
    assert one(spark, wire.decode_json(value, ORDER_PLACED, 258))["items"][0]["count"] == 2
    assert one(spark, wire.decode_json(value, ORDER_PLACED, 259)) is None
    assert one(spark, wire.payload(F.encode(F.lit("{}"), "UTF-8"))) is None


def test_avro_schema_text():
    placed = wire.avro_schema(ORDER_PLACED, "OrderPlaced", "Schemas")
    assert '"name": "OrderPlacedItem"' in placed and '"namespace": "Schemas"' in placed
    assert '"type": "long"' in wire.avro_schema(WINDOWED_METRIC, "WindowedMetric")


def test_missing_packages_are_named(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        topics.read_topic(spark, topics.source_options("localhost:1", C.TOPIC_ORDER_PLACED))
    frame = topics.messages(spark.range(1), "t", value=F.lit("v"), key=F.lit("k"))
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        topics.write_topic(frame, topics.sink_options("localhost:1"))


def test_avro_needs_its_package(spark):
    schema = wire.avro_schema(ORDER_PLACED, "OrderPlaced")
    record = F.struct(F.lit("abc").alias("orderShortCode"))
    with pytest.raises(Exception, match="(?i)avro"):
        spark.range(1).select(wire.encode_avro(record, 1, schema)).collect()


def test_source_options():
    live = topics.source_options("b:1", "t")
    assert live["startingOffsets"] == "latest" and live["includeHeaders"] == "true"
    replay = topics.source_options("b:1", "t", starting="earliest", rows_per_batch=100)
    assert (replay["startingOffsets"], replay["maxOffsetsPerTrigger"]) == ("earliest", "100")


def test_metric_message_has_no_key(spark):
    frame = topics.messages(spark.range(1), C.TOPIC_ORDER_ANALYTICS, value=F.lit("v"))
    assert frame.columns == ["value", "topic"]
