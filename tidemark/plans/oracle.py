"""The same results in plain SQL, written without the library's operators."""

from __future__ import annotations

AS_OF_MS = 1706745600000  # 2024-02-01T00:00:00Z

_WIDTH = {"1m": "1 minute", "1h": "1 hour", "24h": "24 hours"}


def _uuid(kind: str, key: str) -> str:
    return (
        f"regexp_replace(md5('{kind}:' || CAST({key} AS VARCHAR)), "
        r"'^(.{8})(.{4})(.{4})(.{4})(.{12})$', '\1-\2-\3-\4-\5')"
    )


def _code(key: str) -> str:
    return (
        f"translate(substr(to_base64(unhex(sha256(CAST({key} AS VARCHAR)))), 1, 10), '+/', '-_')"
    )


def _text(hundredths: str) -> str:
    """Whole hundredths (not negative) as text with two decimals."""
    return (
        f"(CAST(({hundredths}) // 100 AS VARCHAR) || '.' || "
        f"lpad(CAST(({hundredths}) % 100 AS VARCHAR), 2, '0'))"
    )


def _mean(total: str, count: str) -> str:
    return f"(CASE WHEN {count} = 0 THEN 0 ELSE (2 * ({total}) + ({count})) // (2 * ({count})) END)"


def _iso(ts: str) -> str:
    return f"(strftime({ts}, '%Y-%m-%dT%H:%M:%S.%f') || '0Z')"


_CENTS = "CAST(round(value * 100) AS BIGINT)"


def _windows(size: str, where: str = "event_type = 'purchase'") -> str:
    return f"""
        SELECT time_bucket(INTERVAL '{_WIDTH[size]}', ts) AS ws, '{size}' AS size,
               count(*) AS n, CAST(sum({_CENTS}) AS BIGINT) AS cents
        FROM events WHERE {where} GROUP BY 1"""


def _records(windows: str) -> str:
    """Metric records of a relation (ws, size, n, cents)."""
    width = (
        "CASE size WHEN '1m' THEN 60000 WHEN '1h' THEN 3600000 ELSE 86400000 END"
    )
    return f"""
    SELECT (epoch_us(ws) // 1000) AS "windowStart",
           CAST((epoch_us(ws) // 1000) + {width} AS BIGINT) AS "windowEnd",
           size AS "windowSize", CAST(n AS BIGINT) AS "orderCount",
           {_text('cents')} AS "totalRevenue",
           {_text(_mean('cents', 'n'))} AS "avgOrderValue",
           CAST({AS_OF_MS} AS BIGINT) AS "processedAt"
    FROM ({windows})"""


def _filled(size: str, windows: str) -> str:
    return f"""
        SELECT s.ws, '{size}' AS size, coalesce(m.n, 0) AS n, coalesce(m.cents, 0) AS cents
        FROM (SELECT unnest(generate_series(min(ws), max(ws), INTERVAL '{_WIDTH[size]}')) AS ws
              FROM ({windows})) s
        LEFT JOIN ({windows}) m ON m.ws = s.ws"""


# Requests: one per event. ``ok`` marks those the store accepts.
_REQ = f"""req AS (
    SELECT event_id AS id, ts, user_id, event_type AS kind,
           CAST(props->>'$.k' AS INTEGER) AS k,
           {_uuid('customer', 'user_id')} AS customer,
           {_code('event_id')} AS code,
           event_type IN ('purchase', 'view')
             OR (event_type = 'click' AND CAST(props->>'$.k' AS INTEGER) % 3 = 1) AS ok
    FROM events)"""

_LINES = f"""lines AS (
    SELECT id, i AS line, {_uuid('product', 'k + i')} AS product,
           CAST(CASE WHEN kind = 'click' THEN (k + i) % 3 ELSE i + 1 END AS INTEGER) AS cnt
    FROM (SELECT *, unnest(range(0, k % 3 + 1)) AS i FROM req
          WHERE kind IN ('purchase', 'click')))"""

_LISTS = """lists AS (
    SELECT id, count(*) AS n,
           string_agg(product || ':' || cnt, '|' ORDER BY line) AS items,
           string_agg('{"ProductId":"' || product || '","Count":' || cnt || '}', ','
                      ORDER BY line) AS stored,
           string_agg('{"productId":"' || product || '","count":' || cnt || '}', ','
                      ORDER BY line) AS sent
    FROM lines GROUP BY id)"""

# The outbox of the accepted requests, in its used state.
_OUTBOX = f"""outbox AS (
    SELECT req.id AS request_id, {_uuid('outbox', 'req.id')} AS id, code AS entity_id,
           customer, ts AS occurred_at, coalesce(n, 0) AS n, coalesce(items, '') AS items,
           '{{"OrderShortCode":"' || code || '","CustomerId":"' || customer || '","Items":['
             || coalesce(stored, '') || '],"Status":0}}' AS payload,
           '{{"orderShortCode":"' || code || '","customerId":"' || customer || '","items":['
             || coalesce(sent, '') || ']}}' AS sent,
           CASE req.id % 4 WHEN 0 THEN 'PENDING' WHEN 1 THEN 'FAILED'
                           WHEN 2 THEN 'PUBLISHED' ELSE 'PROCESSING' END AS status,
           CAST(CASE WHEN req.id % 4 = 1 THEN (req.id // 4) % 5 ELSE 0 END AS INTEGER)
             AS retry_count
    FROM req LEFT JOIN lists ON lists.id = req.id WHERE ok)"""

_WITH_REQ = f"WITH {_REQ}"
_WITH_LINES = f"WITH {_REQ}, {_LINES}, {_LISTS}"
_WITH_OUTBOX = f"WITH {_REQ}, {_LINES}, {_LISTS}, {_OUTBOX}"

_ELIGIBLE = "(status = 'PENDING' OR (status = 'FAILED' AND retry_count < 3))"

# How often publishing an event fails before it succeeds.
_NUMBER = "CAST('0x' || substr(md5(id), 1, 4) AS INTEGER)"
_FAILURES = f"(CASE WHEN {_NUMBER} % 5 = 0 THEN ({_NUMBER} // 5) % 5 ELSE 0 END)"

_ATTEMPT = f"""attempt AS (
    SELECT id, occurred_at, c AS retry_count, c < f AS failed
    FROM (SELECT *, retry_count + CASE WHEN status = 'FAILED' THEN 1 ELSE 0 END AS c,
                 {_FAILURES} AS f
          FROM outbox WHERE {_ELIGIBLE}))"""

# Fulfilled events: every line item; lines taxed at 8 % carry a code no order has.
_DONE = """done AS (
    SELECT CASE WHEN l_tax >= 0.08 THEN -1 - l_orderkey ELSE l_orderkey END AS code,
           l_shipdate AS ts, l_partkey AS part, l_suppkey AS supplier, l_linenumber AS line
    FROM lineitem)"""

_STORE = """store AS (
    SELECT o_orderkey AS code, o_custkey AS customer, o_orderdate AS ts,
           CASE o_orderstatus WHEN 'P' THEN 'PENDING' WHEN 'F' THEN 'FULFILLED'
                              WHEN 'O' THEN 'SHIPPED' END AS status
    FROM orders)"""

_WITH_STORE = f"WITH {_DONE}, {_STORE}"

# Orders under their customer as code, each with the first fulfillment after it.
_REPEATED = """WITH shipped AS (
    SELECT o_custkey AS code, l_shipdate AS ts
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE l_tax < 0.08),
firsts AS (
    SELECT o_custkey AS code, o_orderdate AS placed, min(ts) AS fulfilled
    FROM (SELECT DISTINCT o_custkey, o_orderdate FROM orders)
    JOIN shipped ON shipped.code = o_custkey AND ts >= o_orderdate GROUP BY 1, 2),
pairs AS (
    SELECT o_custkey AS code, o_orderdate AS placed, fulfilled
    FROM orders LEFT JOIN firsts ON firsts.code = o_custkey AND firsts.placed = o_orderdate)"""

# First fulfillment not before the order.
_FIRST = """first AS (
    SELECT store.code, store.ts AS placed, min(done.ts) AS fulfilled
    FROM store JOIN done ON done.code = store.code AND done.ts >= store.ts
    GROUP BY 1, 2)"""

# Arrival order: every seventh event comes ten minutes late.
_ARRIVED = """arrived AS (
    SELECT event_id, ts, value, event_type,
           ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL '600 seconds'
                     ELSE INTERVAL '0 seconds' END AS arrived_at
    FROM events)"""


def _late(where: str = "TRUE") -> str:
    return f"""tagged AS (
    SELECT *, coalesce(ts < max(ts) OVER (ORDER BY arrived_at, event_id
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - INTERVAL '60 seconds',
               FALSE) AS is_late
    FROM arrived WHERE {where})"""


def _violations(*rules: tuple[str, str]) -> str:
    """Names of the broken rules; each rule is (name, condition under which it is broken)."""
    cases = ", ".join(f"CASE WHEN {broken} THEN '{name}' END" for name, broken in rules)
    return f"concat_ws(',', {cases})"


_BAD_COUNT = "(kind = 'click' AND k % 3 <> 1)"


def _snapshots(source: str, order: str) -> str:
    """(n, total) after every tenth row of ``source(lines, ...)``."""
    return f"""
        SELECT n, total FROM (
            SELECT row_number() OVER w AS n,
                   CAST(sum(lines) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total
            FROM ({source}) WINDOW w AS (ORDER BY {order}))
        WHERE n % 10 = 0"""


_ORDER_LINES = """
    SELECT o_orderkey, o_orderdate, coalesce(c, 0) AS lines
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS c FROM lineitem GROUP BY 1)
      ON l_orderkey = o_orderkey"""

_STATUS_RANK = "CASE status WHEN 'PENDING' THEN 1 WHEN 'FULFILLED' THEN 2 ELSE 3 END"


def _status_apply(changed: str) -> str:
    return f"""{_WITH_STORE}, hit AS (SELECT DISTINCT code FROM done)
    SELECT store.code AS order_short_code,
           CASE WHEN {changed} THEN 'FULFILLED' ELSE status END AS status,
           CASE WHEN {changed} THEN CAST({AS_OF_MS} AS BIGINT) ELSE (epoch_us(ts) // 1000) END
             AS updated_at_ms
    FROM store LEFT JOIN hit ON hit.code = store.code"""


ORACLE: dict[str, str] = {
    "metrics_1m": _records(_windows("1m")),
    "metrics_1h": _records(_windows("1h")),
    "metrics_24h": _records(_windows("24h")),
    "metrics_all_sizes": _records(
        " UNION ALL ".join(_windows(size) for size in _WIDTH)
    ),
    "metrics_zero_filled_1h": _records(_filled("1h", _windows("1h"))),
    "metrics_zero_filled_1m": _records(_filled("1m", _windows("1m"))),
    "metrics_per_customer_24h": f"""
        SELECT (epoch_us(ws) // 1000) AS window_start_ms, user_id, n AS order_count,
               {_text('cents')} AS total_revenue
        FROM (SELECT time_bucket(INTERVAL '24 hours', ts) AS ws, user_id, count(*) AS n,
                     CAST(sum({_CENTS}) AS BIGINT) AS cents
              FROM events WHERE event_type = 'purchase' GROUP BY 1, 2)""",
    "metrics_running_daily_reset": f"""
        SELECT (epoch_us(ws) // 1000) AS window_start_ms, n AS order_count, cents AS revenue_cents,
               CAST(sum(n) OVER w AS BIGINT) AS day_order_count,
               CAST(sum(cents) OVER w AS BIGINT) AS day_revenue_cents
        FROM ({_windows('1h')})
        WINDOW w AS (PARTITION BY date_trunc('day', ws) ORDER BY ws ROWS UNBOUNDED PRECEDING)""",
    "metrics_gap_check": f"""
        SELECT * FROM (
            SELECT (epoch_us(ws) // 1000) AS window_start_ms,
                   (epoch_us(lead(ws) OVER (ORDER BY ws)) // 1000) AS next_start_ms,
                   ((epoch_us(lead(ws) OVER (ORDER BY ws)) // 1000) - (epoch_us(ws) // 1000)) // 3600000 - 1
                     AS missing_windows
            FROM ({_windows('1h')}))
        WHERE missing_windows > 0""",
    "metrics_latest_version": f"""
        WITH {_ARRIVED}, {_late("event_type = 'purchase'")}
        SELECT (epoch_us(time_bucket(INTERVAL '24 hours', ts)) // 1000) AS window_start_ms,
               count(*) AS order_count, CAST(sum({_CENTS}) AS BIGINT) AS revenue_cents,
               CAST({AS_OF_MS} + 600000 AS BIGINT) AS processed_at_ms,
               CAST(1 + max(CASE WHEN is_late THEN 0 ELSE 1 END) AS BIGINT) AS versions
        FROM tagged GROUP BY 1""",
    "order_count_snapshot": f"""
        SELECT CAST({AS_OF_MS} - 60000 AS BIGINT) AS "windowStart",
               CAST({AS_OF_MS} AS BIGINT) AS "windowEnd", '1m' AS "windowSize",
               n AS "orderCount", CAST(total AS VARCHAR) AS "totalRevenue",
               {_text(_mean('total * 100', 'n'))} AS "avgOrderValue",
               CAST({AS_OF_MS} AS BIGINT) AS "processedAt"
        FROM ({_snapshots(_ORDER_LINES, 'o_orderdate, o_orderkey')})""",
    "item_lines_per_order": f"""
        SELECT o_orderkey AS order_short_code, lines AS item_lines FROM ({_ORDER_LINES})""",
    "running_item_lines": f"""
        SELECT o_orderkey AS order_short_code, row_number() OVER w AS n,
               CAST(sum(lines) OVER (w ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running_item_lines
        FROM ({_ORDER_LINES}) WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""",
    "order_item_join": """
        SELECT o_orderkey AS order_short_code, o_custkey AS customer_id,
               l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS count
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey""",
    "late_split": f"""
        WITH {_ARRIVED}, {_late()}
        SELECT event_id, CAST(is_late AS INTEGER) AS is_late FROM tagged""",
    "late_counts": f"""
        WITH {_ARRIVED}, {_late()}
        """
    + " UNION ALL ".join(
        f"""SELECT '{size}' AS window_size,
               (epoch_us(time_bucket(INTERVAL '{width}', ts)) // 1000) AS window_start_ms,
               count(*) FILTER (NOT is_late) AS included, count(*) FILTER (is_late) AS late
        FROM tagged GROUP BY 2"""
        for size, width in _WIDTH.items()
    ),
    "order_request_parse": f"""{_WITH_LINES}
        SELECT req.id AS request_id, CASE WHEN kind <> 'error' THEN customer END AS customer_id,
               CASE WHEN kind IN ('purchase', 'click') THEN n ELSE 0 END AS item_lines,
               CAST(kind = 'error' AS INTEGER) AS malformed,
               CAST(kind IN ('error', 'signup') AS INTEGER) AS items_missing
        FROM req LEFT JOIN lists ON lists.id = req.id""",
    "row_rules_quarantine": f"""{_WITH_REQ}
        SELECT id AS request_id,
               {_violations(
                   ('body_readable', "kind = 'error'"),
                   ('items_listed', "kind = 'signup'"),
                   ('counts_positive', _BAD_COUNT))} AS violations
        FROM req WHERE NOT ok""",
    "order_contract_rules": f"""{_WITH_REQ}
        SELECT {_violations(
                   ('customer_present', "kind = 'error'"),
                   ('items_present', "kind IN ('error', 'signup', 'view')"),
                   ('counts_positive', _BAD_COUNT))} AS violations,
               count(*) AS rows
        FROM req GROUP BY 1""",
    "null_guard_counts": f"""{_WITH_REQ}
        SELECT CASE kind WHEN 'error' THEN 'malformed' WHEN 'signup' THEN 'no_items'
                         ELSE 'decoded' END AS reason, count(*) AS rows
        FROM req GROUP BY 1""",
    "order_ingest_orders": f"""{_WITH_REQ}
        SELECT {_uuid('order', 'id')} AS order_id, code AS order_short_code,
               customer AS customer_id, 'PENDING' AS status, (epoch_us(ts) // 1000) AS created_at_ms,
               (epoch_us(ts) // 1000) AS updated_at_ms
        FROM req WHERE ok""",
    "order_items_exploded": f"""{_WITH_LINES}
        SELECT {_uuid('order', 'lines.id')} AS order_id, CAST(line AS INTEGER) AS line,
               product AS product_id, cnt AS count
        FROM lines JOIN req ON req.id = lines.id WHERE ok""",
    "order_payload_roundtrip": f"""{_WITH_OUTBOX}
        SELECT id, 'ORDER' AS entity_type, entity_id, 'ORDER_PLACED' AS event_type,
               1 AS event_version, payload, (epoch_us(occurred_at) // 1000) AS occurred_at_ms,
               'PENDING' AS status, 0 AS retry_count, payload->>'$.CustomerId' AS customer_id,
               CAST(json_array_length(payload, '$.Items') AS BIGINT) AS item_lines
        FROM outbox""",
    "order_placed_nested": f"""{_WITH_OUTBOX}
        SELECT entity_id AS order_short_code, customer AS customer_id, items FROM outbox""",
    "duplicate_order_lines": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY 1, 2 HAVING count(*) > 1""",
    "duplicate_short_codes": f"""{_WITH_REQ}
        SELECT code AS order_short_code, count(*) AS rows FROM req WHERE ok
        GROUP BY 1 HAVING count(*) > 1""",
    "order_items_after_delete": """
        SELECT l_orderkey AS order_short_code, count(*) AS lines,
               CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS pieces
        FROM lineitem JOIN orders ON o_orderkey = l_orderkey
        WHERE o_orderstatus <> 'O' GROUP BY 1""",
    "headers_encode": f"""{_WITH_OUTBOX}
        SELECT id, CAST(position AS INTEGER) AS position, key, value FROM (
            SELECT id, 0 AS position, 'event-id' AS key, id AS value FROM outbox
            UNION ALL SELECT id, 1, 'event-version', '1' FROM outbox
            UNION ALL SELECT id, 2, 'occurred-at', {_iso('occurred_at')} FROM outbox
            UNION ALL SELECT id, 3, 'entity-type', 'ORDER' FROM outbox
            UNION ALL SELECT id, 4, 'entity-id', entity_id FROM outbox)""",
    "headers_decode": f"""{_WITH_OUTBOX}
        SELECT request_id, id AS event_id,
               CASE WHEN request_id % 13 = 0 AND request_id % 11 <> 0 THEN 'x' ELSE '1' END
                 AS event_version,
               {_iso('occurred_at')} AS occurred_at,
               CASE WHEN request_id % 11 <> 0 THEN 'ORDER' END AS entity_type, entity_id
        FROM outbox""",
    "metadata_default": f"""{_WITH_OUTBOX}
        SELECT request_id,
               CASE WHEN request_id % 11 = 0 THEN {_uuid('default', 'request_id')} ELSE id END
                 AS event_id,
               CASE WHEN request_id % 11 <> 0 AND request_id % 13 = 0 THEN NULL ELSE 1 END
                 AS event_version,
               CASE WHEN request_id % 11 = 0 THEN CAST({AS_OF_MS} AS BIGINT)
                    ELSE (epoch_us(occurred_at) // 1000) END AS occurred_at_ms,
               CASE WHEN request_id % 11 = 0 THEN 'Order' ELSE 'ORDER' END AS entity_type,
               CASE WHEN request_id % 11 = 0 THEN '' ELSE entity_id END AS entity_id,
               CASE WHEN request_id % 11 = 0 THEN 'default'
                    WHEN request_id % 13 = 0 THEN 'malformed' ELSE 'ok' END AS state
        FROM outbox""",
    "message_disposition": f"""{_WITH_OUTBOX}
        SELECT CASE WHEN request_id % 17 = 0 THEN 'undecodable'
                    WHEN request_id % 11 = 0 THEN 'default'
                    WHEN request_id % 13 = 0 THEN 'malformed' ELSE 'ok' END AS disposition,
               count(*) AS messages
        FROM outbox GROUP BY 1""",
    "metrics_from_messages": f"""{_WITH_OUTBOX}
        SELECT epoch_us(time_bucket(INTERVAL '1 hour', occurred_at)) // 1000 AS window_start_ms,
               count(*) AS order_count, CAST(sum(n) AS BIGINT) AS item_lines
        FROM outbox
        WHERE request_id % 11 <> 0 AND request_id % 13 <> 0 AND request_id % 17 <> 0
        GROUP BY 1""",
    "wire_frames": """
        SELECT code AS order_short_code, '000000002A' || hex(encode(payload)) AS frame_hex,
               CAST(42 AS BIGINT) AS schema_id, payload
        FROM (SELECT o_orderkey AS code,
                     '{"orderShortCode":"' || o_orderkey || '","customerId":"' || o_custkey
                     || '","fulfillmentTimestamp":' || (epoch_us(o_orderdate) // 1000) || '}' AS payload
              FROM orders)""",
    "topic_messages": f"""{_WITH_OUTBOX}
        SELECT 'order.placed' AS topic, entity_id AS key, sent AS value,
               'event-id,event-version,occurred-at,entity-type,entity-id' AS header_keys,
               entity_id
        FROM outbox""",
    "outbox_eligible": f"""{_WITH_OUTBOX}
        SELECT id, status, retry_count FROM outbox WHERE {_ELIGIBLE}""",
    "outbox_eligible_topk": f"""{_WITH_OUTBOX}
        SELECT id AS "Id", 'ORDER' AS "EntityName", entity_id AS "EntityId",
               'ORDER_PLACED' AS "EventType", 1 AS "EventVersion", payload AS "Payload",
               (epoch_us(occurred_at) // 1000) AS "OccurredAtMs", status AS "Status",
               retry_count AS "RetryCount", CAST(NULL AS VARCHAR) AS "LastError"
        FROM outbox WHERE {_ELIGIBLE} ORDER BY occurred_at, id LIMIT 100""",
    "outbox_claim": f"""{_WITH_OUTBOX}, taken AS (
            SELECT id FROM outbox WHERE {_ELIGIBLE} ORDER BY occurred_at, id LIMIT 100)
        SELECT id,
               CASE WHEN id IN (SELECT id FROM taken) THEN 'PROCESSING' ELSE status END AS status,
               CAST(retry_count + CASE WHEN id IN (SELECT id FROM taken) AND status = 'FAILED'
                                       THEN 1 ELSE 0 END AS INTEGER) AS retry_count
        FROM outbox""",
    "outbox_mark_published": f"""{_WITH_OUTBOX}
        SELECT id, CASE WHEN status = 'PROCESSING' AND request_id % 5 <> 0 THEN 'PUBLISHED'
                        ELSE status END AS status, 1 AS never_stamped
        FROM outbox""",
    "outbox_mark_failed": f"""{_WITH_OUTBOX}
        SELECT id, CASE WHEN status = 'PROCESSING' AND request_id % 5 = 0 THEN 'FAILED'
                        ELSE status END AS status,
               CASE WHEN status = 'PROCESSING' AND request_id % 5 = 0
                    THEN 'timed out: ' || entity_id END AS last_error
        FROM outbox""",
    "outbox_mark_repeated_ids": f"""{_WITH_OUTBOX}
        SELECT id, CASE WHEN status = 'PROCESSING' AND request_id % 5 <> 0 THEN 'PUBLISHED'
                        WHEN status = 'PROCESSING' THEN 'FAILED' ELSE status END AS status,
               CASE WHEN status = 'PROCESSING' AND request_id % 5 = 0
                    THEN 'the last error' END AS last_error
        FROM outbox""",
    "outbox_by_entity": f"""{_WITH_OUTBOX}
        SELECT {_uuid('order', 'request_id')} AS order_id, entity_id AS order_short_code,
               id AS event_id, 'ORDER_PLACED' AS event_type, status AS event_status
        FROM outbox""",
    "outbox_stuck": f"""{_WITH_OUTBOX}
        SELECT id, (epoch_us(occurred_at) // 1000) AS occurred_at_ms FROM outbox
        WHERE status = 'PROCESSING' AND occurred_at < TIMESTAMP '2024-01-22 00:00:00'""",
    "outbox_attempt": f"""{_WITH_OUTBOX}, {_ATTEMPT}
        SELECT id, CASE WHEN failed THEN 'FAILED' ELSE 'PUBLISHED' END AS status,
               CAST(retry_count AS INTEGER) AS retry_count,
               CASE WHEN failed THEN 'Local_Transport' END AS last_error,
               CAST(failed AND retry_count >= 3 AS INTEGER) AS exhausted
        FROM attempt""",
    "publish_outcomes": f"""{_WITH_OUTBOX}, {_ATTEMPT}
        SELECT (epoch_us(occurred_at) // 1000) // 3600000 AS batch_id, count(*) AS received,
               count(*) FILTER (NOT failed) AS published, count(*) FILTER (failed) AS failed
        FROM attempt GROUP BY 1""",
    "backoff_schedule": """
        SELECT event_id, attempt, delay_ms,
               CAST((epoch_us(ts) // 1000) + delay_ms AS BIGINT) AS next_attempt_ms
        FROM (SELECT event_id, ts, attempt,
                     CAST(least(10000, 100 * (1 << (attempt - 1))) AS INTEGER) AS delay_ms
              FROM (SELECT event_id, ts, CAST(props->>'$.k' AS INTEGER) % 9 + 1 AS attempt
                    FROM events))""",
    "transient_errors": """
        SELECT code, fatal, CAST(fatal = 0 AND code NOT IN ('MsgSizeTooLarge', 'Local_Fatal')
                                 AS INTEGER) AS transient, count(*) AS errors
        FROM (SELECT CASE CAST(props->>'$.k' AS INTEGER) % 5
                       WHEN 0 THEN 'Local_Transport' WHEN 1 THEN 'Local_AllBrokersDown'
                       WHEN 2 THEN 'UnknownTopicOrPart' WHEN 3 THEN 'MsgSizeTooLarge'
                       ELSE 'Local_Fatal' END AS code,
                     CAST(event_type = 'error' AS INTEGER) AS fatal
              FROM events)
        GROUP BY 1, 2, 3""",
    "fulfilled_projection": f"""
        SELECT o_orderkey AS order_short_code, o_custkey AS customer_id,
               CAST({AS_OF_MS} AS BIGINT) AS fulfillment_timestamp,
               {_uuid('fulfilled', 'cause')} AS event_id, 1 AS event_version,
               'Order' AS entity_type, o_orderkey AS entity_id, cause AS causation_id
        FROM (SELECT *, {_uuid('placed', 'o_orderkey')} AS cause FROM orders)""",
    "fulfillment_outcomes": f"""{_WITH_REQ}
        SELECT code AS order_short_code,
               CASE WHEN kind = 'view' THEN 'dead_letter' ELSE 'fulfilled' END AS outcome,
               CASE WHEN kind = 'view' THEN 'EmptyOrder' END AS error_type,
               CASE WHEN kind = 'view' THEN 'order has no items: ' || code END AS error_message
        FROM req WHERE ok""",
    "status_exists": f"""{_WITH_STORE}
        SELECT code AS order_short_code, (epoch_us(ts) // 1000) AS fulfilled_at_ms, part, line
        FROM done
        WHERE EXISTS (SELECT 1 FROM store WHERE store.code = done.code AND status = 'FULFILLED')""",
    "unknown_orders": f"""{_WITH_STORE}
        SELECT code AS order_short_code, (epoch_us(ts) // 1000) AS fulfilled_at_ms, part, line
        FROM done WHERE NOT EXISTS (SELECT 1 FROM store WHERE store.code = done.code)""",
    "fulfilled_dedupe": f"""{_WITH_STORE}
        SELECT code AS order_short_code, (epoch_us(ts) // 1000) AS fulfilled_at_ms FROM (
            SELECT *, row_number() OVER (PARTITION BY code ORDER BY ts, part, supplier, line) AS p
            FROM done)
        WHERE p = 1 AND code NOT IN (SELECT code FROM store WHERE status = 'FULFILLED')""",
    "status_apply": _status_apply("(hit.code IS NOT NULL AND status = 'PENDING')"),
    "status_apply_bucketed": _status_apply("(hit.code IS NOT NULL AND status = 'PENDING')"),
    "status_apply_unguarded": _status_apply("(hit.code IS NOT NULL)"),
    "furthest_status": f"""{_WITH_STORE}
        SELECT code AS order_short_code,
               CASE max({_STATUS_RANK}) WHEN 1 THEN 'PENDING' WHEN 2 THEN 'FULFILLED'
                                        ELSE 'SHIPPED' END AS status
        FROM (SELECT code, status FROM store UNION ALL SELECT code, 'FULFILLED' FROM done)
        GROUP BY 1""",
    "dead_letters_merged": f"""WITH {_REQ}, {_DONE}, {_STORE}, letters AS (
            SELECT 'fulfillment-service' AS service, 'fulfillment-service.dlq' AS topic,
                   code AS key, 'order.placed' AS original_topic, id AS place,
                   'EmptyOrder' AS error_type, 'order has no items: ' || code AS error_message
            FROM req WHERE ok AND kind = 'view'
            UNION ALL
            SELECT 'order-service', 'order-service.dlq', CAST(code AS VARCHAR),
                   'order.fulfilled', -code, 'UnknownOrder', 'no order has the code ' || code
            FROM done WHERE code NOT IN (SELECT code FROM store))
        SELECT service, topic, key, original_topic, CAST(place % 3 AS INTEGER) AS partition,
               CAST(place // 3 AS BIGINT) AS "offset", error_type, error_message,
               original_topic AS header_topic,
               '2024-02-01T00:00:00.0000000Z' AS header_failed_at,
               'x-original-topic,x-failure-timestamp,x-partition,x-offset,'
                 || 'x-exception-type,x-exception-message' AS header_keys
        FROM letters""",
    "dead_letters_replayed": f"""{_WITH_OUTBOX}
        SELECT entity_id AS key, entity_id AS order_short_code, customer AS customer_id,
               CAST(0 AS BIGINT) AS items, 'ok' AS state,
               'event-id,event-version,occurred-at,entity-type,entity-id,'
                 || 'x-original-topic,x-failure-timestamp,x-partition,x-offset,'
                 || 'x-exception-type,x-exception-message' AS header_keys
        FROM outbox
        WHERE n = 0 AND request_id % 17 <> 0
          AND (request_id % 11 = 0 OR request_id % 13 <> 0)""",
    "placed_fulfilled_repeated_codes": f"""{_REPEATED}
        SELECT code AS order_short_code, epoch_us(placed) // 1000 AS placed_at_ms,
               epoch_us(fulfilled) // 1000 AS fulfilled_at_ms
        FROM pairs""",
    "fulfillment_metrics_repeated_codes": f"""{_REPEATED}, days AS (
            SELECT time_bucket(INTERVAL '24 hours', placed) AS ws, count(*) AS n,
                   count(fulfilled) AS f,
                   CAST(sum((epoch_us(fulfilled) // 1000) - (epoch_us(placed) // 1000)) AS BIGINT)
                     AS latency
            FROM pairs GROUP BY 1)
        SELECT (epoch_us(ws) // 1000) AS window_start_ms, n AS placed, f AS fulfilled,
               n - f AS pending, {_text(_mean('f * 10000', 'n'))} AS rate_percent,
               CASE WHEN f > 0 THEN {_mean('latency', 'f')} END AS mean_latency_ms
        FROM days""",
    "placed_fulfilled_join": f"""{_WITH_STORE}, {_FIRST}
        SELECT store.code AS order_short_code, (epoch_us(store.ts) // 1000) AS placed_at_ms,
               (epoch_us(fulfilled) // 1000) AS fulfilled_at_ms
        FROM store LEFT JOIN first ON first.code = store.code""",
    "fulfillment_metrics_24h": f"""{_WITH_STORE}, {_FIRST}, days AS (
            SELECT time_bucket(INTERVAL '24 hours', store.ts) AS ws, count(*) AS n,
                   count(fulfilled) AS f,
                   CAST(sum((epoch_us(fulfilled) // 1000) - (epoch_us(placed) // 1000)) AS BIGINT) AS latency
            FROM store LEFT JOIN first ON first.code = store.code GROUP BY 1)
        SELECT (epoch_us(ws) // 1000) AS window_start_ms, n AS placed, f AS fulfilled, n - f AS pending,
               {_text(_mean('f * 10000', 'n'))} AS rate_percent,
               CASE WHEN f > 0 THEN {_mean('latency', 'f')} END AS mean_latency_ms
        FROM days""",
    "delivery_quality": f"""{_WITH_STORE}, arrived AS (
            SELECT code, count(*) AS copies FROM done GROUP BY 1),
        totals AS (
            SELECT count(*) AS produced, count(copies) AS delivered,
                   CAST(coalesce(sum(copies), 0) AS BIGINT) AS arrivals
            FROM store LEFT JOIN arrived ON arrived.code = store.code)
        SELECT produced, delivered, arrivals, arrivals - delivered AS repeats,
               {_text(_mean('delivered * 10000', 'produced'))} AS delivered_percent,
               {_text(_mean('(arrivals - delivered) * 10000', 'arrivals'))} AS repeat_percent
        FROM totals""",
}


def _closed(size: str) -> str:
    """Windows that have closed when all purchases were seen, 60 s of tolerance kept."""
    return f"""
        SELECT * FROM ({_windows(size)})
        WHERE ws + INTERVAL '{_WIDTH[size]}' <= (
            SELECT max(ts) - INTERVAL '60 seconds' FROM events WHERE event_type = 'purchase')"""


_PURCHASE_LINES = """
    SELECT event_id, ts, CAST(props->>'$.k' AS INTEGER) % 3 + 1 AS lines
    FROM events WHERE event_type = 'purchase'"""

ORACLE["order_item_join_bucketed"] = ORACLE["order_item_join"]

ORACLE.update(
    {
        "windowed_metrics_stream": _records(
            " UNION ALL ".join(_filled(size, _closed(size)) for size in _WIDTH)
        ),
        "customer_windows_stream": f"""
            SELECT * FROM ({ORACLE["metrics_per_customer_24h"]})
            WHERE window_start_ms IN (SELECT epoch_us(ws) // 1000 FROM ({_closed("24h")}))""",
        "running_totals_stream": ORACLE["metrics_running_daily_reset"].replace(
            _windows("1h"), _closed("1h")
        ),
        "order_count_snapshot_stream": f"""
            SELECT CAST({AS_OF_MS} - 60000 AS BIGINT) AS "windowStart",
                   CAST({AS_OF_MS} AS BIGINT) AS "windowEnd", '1m' AS "windowSize",
                   n AS "orderCount", CAST(total AS VARCHAR) AS "totalRevenue",
                   {_text(_mean('total * 100', 'n'))} AS "avgOrderValue",
                   CAST({AS_OF_MS} AS BIGINT) AS "processedAt"
            FROM ({_snapshots(_PURCHASE_LINES, 'ts, event_id')})""",
        "order_ingest_stream": f"""{_WITH_REQ}
            SELECT id AS request_id, CASE WHEN ok THEN code END AS order_short_code,
                   CAST(CASE WHEN NOT ok OR kind = 'view' THEN 0 ELSE k % 3 + 1 END AS BIGINT)
                     AS items,
                   CAST(ok AS BIGINT) AS events,
                   {_violations(
                       ('body_readable', "kind = 'error'"),
                       ('items_listed', "kind = 'signup'"),
                       ('counts_positive', _BAD_COUNT))} AS violations
            FROM req""",
        "sharded_snapshot_stream": """
            SELECT shard, CAST(n AS BIGINT) AS order_count, CAST(total AS BIGINT) AS item_lines
            FROM (
                SELECT event_id % 64 AS shard, row_number() OVER w AS n,
                       sum(CAST(props->>'$.k' AS INTEGER) % 3 + 1)
                         OVER (w ROWS UNBOUNDED PRECEDING) AS total
                FROM events
                WHERE event_type = 'purchase' AND epoch_us(ts) <= (
                    SELECT (epoch_us(max(ts)) // 1000 - 60000) * 1000
                    FROM events WHERE event_type = 'purchase')
                WINDOW w AS (PARTITION BY event_id % 64 ORDER BY ts, event_id))
            WHERE n % 10 = 0""",
        "late_split_stream": ORACLE["late_split"],
        "outbox_relay_stream": f"""{_WITH_OUTBOX}, tries AS (
                SELECT id, f, CASE WHEN status = 'FAILED' THEN retry_count + 1 ELSE 0 END AS c,
                       least(3, greatest(f, CASE WHEN status = 'FAILED' THEN retry_count + 1
                                                 ELSE 0 END)) AS final
                FROM (SELECT *, {_FAILURES} AS f FROM outbox WHERE {_ELIGIBLE}))
            SELECT id, CAST(final AS INTEGER) AS retry_count,
                   CAST(final - c + 1 AS BIGINT) AS attempts,
                   CASE WHEN f > 3 THEN 'FAILED' ELSE 'PUBLISHED' END AS status,
                   CASE WHEN f > 3 THEN 'Local_Transport' END AS last_error
            FROM tries""",
        "fulfillment_stream": f"""{_WITH_REQ}
            SELECT code AS key,
                   CASE WHEN id % 17 = 0 THEN 'skipped'
                        WHEN id % 11 <> 0 AND id % 13 = 0 THEN 'quarantine'
                        WHEN kind = 'view' THEN 'dead_letter' ELSE 'fulfilled' END AS outcome
            FROM req WHERE ok""",
        "relay_quiet_stream": "",
        "status_apply_batches_stream": f"""{_WITH_STORE}
            SELECT code AS order_short_code, CAST(1 AS BIGINT) AS changes
            FROM store WHERE status = 'PENDING' AND code IN (SELECT code FROM done)""",
        "fulfillment_retry_stream": f"""{_WITH_REQ}
            SELECT code AS key,
                   CASE WHEN id % 17 = 0 THEN 'skipped'
                        WHEN id % 11 <> 0 AND id % 13 = 0 THEN 'quarantine'
                        WHEN id % 5 >= 3 THEN 'dead_letter' ELSE 'fulfilled' END AS outcome
            FROM req WHERE ok""",
        "status_retry_stream": f"""{_WITH_STORE}
            SELECT CAST(code AS VARCHAR) AS key, count(*) AS letters
            FROM done WHERE code NOT IN (SELECT code FROM store) GROUP BY 1""",
        "status_apply_stream": ORACLE["status_apply"],
        "fulfillment_metrics_stream": f"""
            WITH placed AS (
                SELECT event_id, ts, CAST(props->>'$.k' AS INTEGER) AS k
                FROM events WHERE event_type = 'purchase'),
            mark AS (  -- both watermarks wait two hours, and an order has one hour
                SELECT least(max(ts), max(CASE WHEN k < 80 THEN ts + to_minutes(k) END))
                       - INTERVAL '2 hours' - INTERVAL '1 hour' AS reached
                FROM placed),
            hours AS (
                SELECT time_bucket(INTERVAL '1 hour', ts) AS ws, count(*) AS n,
                       count(*) FILTER (k <= 60) AS f,
                       CAST(coalesce(sum(k * 60000) FILTER (k <= 60), 0) AS BIGINT) AS latency
                FROM placed GROUP BY 1)
            SELECT epoch_us(ws) // 1000 AS window_start_ms, n AS placed, f AS fulfilled,
                   n - f AS pending, {_text(_mean('f * 10000', 'n'))} AS rate_percent,
                   CASE WHEN f > 0 THEN {_mean('latency', 'f')} END AS mean_latency_ms
            FROM hours, mark WHERE ws + INTERVAL '1 hour' <= reached""",
        "placed_fulfilled_stream_join": """
            SELECT event_id AS order_short_code, epoch_us(ts) // 1000 AS placed_at_ms,
                   epoch_us(ts + to_minutes(k)) // 1000 AS fulfilled_at_ms
            FROM (SELECT event_id, ts, CAST(props->>'$.k' AS INTEGER) AS k
                  FROM events WHERE event_type = 'purchase')
            WHERE k <= 60""",
    }
)

ORACLE["relay_quiet_stream"] = ORACLE["outbox_relay_stream"]
for _name in ("windowed_metrics", "order_count_snapshot", "late_split"):
    ORACLE[f"{_name}_batches_stream"] = ORACLE[f"{_name}_stream"]

ORACLE["relay_restart_stream"] = ORACLE["outbox_relay_stream"]
# The client refuses these for good, so they use up their tries.
_REFUSED = "substr(md5(id), 1, 1) IN ('0', '1', '2')"
ORACLE["relay_delivery_stream"] = f"""{_WITH_OUTBOX}, tries AS (
        SELECT id, {_REFUSED} AS refused,
               CASE WHEN status = 'FAILED' THEN retry_count + 1 ELSE 0 END AS c
        FROM outbox WHERE {_ELIGIBLE})
    SELECT id, CAST(CASE WHEN refused THEN 3 ELSE c END AS INTEGER) AS retry_count,
           CAST(CASE WHEN refused THEN 4 - c ELSE 1 END AS BIGINT) AS attempts,
           CASE WHEN refused THEN 'FAILED' ELSE 'PUBLISHED' END AS status,
           CASE WHEN refused THEN 'refused ' || id END AS last_error
    FROM tries"""
ORACLE["delivery_key_order"] = f"""{_WITH_REQ}
    SELECT customer AS key, count(*) AS messages, CAST(0 AS BIGINT) AS swapped
    FROM req WHERE ok GROUP BY 1"""
_DIGIT = "CAST('0x' || substr(md5(code), 1, 4) AS INTEGER) % 10"
ORACLE["fulfillment_delivery_stream"] = f"""{_WITH_REQ}, seen AS (
        SELECT code AS key, {_DIGIT} AS digit,
               CASE WHEN id % 17 = 0 THEN 'skipped'
                    WHEN id % 11 <> 0 AND id % 13 = 0 THEN 'quarantine' ELSE 'sent' END AS kind
        FROM req WHERE ok)
    SELECT key,
           CASE WHEN kind <> 'sent' THEN kind
                WHEN digit < 2 THEN 'dead_letter' ELSE 'fulfilled' END AS outcome,
           CAST(CASE WHEN kind <> 'sent' THEN 0 WHEN digit = 0 THEN 3 ELSE 1 END AS BIGINT)
             AS tries,
           CASE WHEN kind = 'sent' AND digit = 0 THEN 'Local_Transport'
                WHEN kind = 'sent' AND digit = 1 THEN 'MsgSizeTooLarge' END AS code
    FROM seen"""
ORACLE["status_keyed_stream"] = f"""{_WITH_STORE}
    SELECT code AS order_short_code, 'changed' AS outcome, CAST(1 AS BIGINT) AS n
    FROM store WHERE status = 'PENDING' AND code IN (SELECT code FROM done)
    UNION ALL
    SELECT code, 'unknown', count(*) FROM done
    WHERE code NOT IN (SELECT code FROM store) GROUP BY 1"""


def _until(size: str) -> str:
    """All windows from the first one to those that ended a minute before the clock."""
    windows = _windows(size)
    width = f"INTERVAL '{_WIDTH[size]}'"
    last = f"TIMESTAMP '2024-02-01' - INTERVAL '60 seconds' - {width}"
    return f"""
        SELECT s.ws, '{size}' AS size, coalesce(m.n, 0) AS n, coalesce(m.cents, 0) AS cents
        FROM (SELECT unnest(generate_series(min(ws), {last}, {width})) AS ws
              FROM ({windows})) s
        LEFT JOIN ({windows}) m ON m.ws = s.ws"""


ORACLE["corrected_metrics_stream"] = _records(
    " UNION ALL ".join(_until(size) for size in _WIDTH)
)
