"""The same results as plain SQL over the given tables, for checking."""

from __future__ import annotations

EMAIL = "'user' || {0} || '@test.com'"
TEXT_TIME = "strftime({0}, '%b %-d, %Y, %-I:%M:%S %p')"
K = "CAST(json_extract(props, '$.k') AS INTEGER)"

CUSTOMER = f"""
    SELECT c_name AS "customerName", {EMAIL.format('(c_custkey // 10)')} AS email,
           lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone,
           '19' || lpad(CAST(c_custkey % 100 AS VARCHAR), 2, '0') || '-01-02' AS "birthDay",
           CAST(c_custkey AS VARCHAR) AS "accountNumber", 'NATION_' || c_nationkey AS location
    FROM customer"""

CLICK = f"""
    SELECT event_id, ts, {EMAIL.format('user_id')} AS email, strftime(ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
           '/' || event_type || '/' || user_id AS uri, CAST(floor(value) AS BIGINT) AS number
    FROM events"""

DEPOSIT_JOIN = """
    SELECT CAST(o_custkey AS VARCHAR) AS "accountNumber", CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS amount,
           strftime(o_orderdate, '%b %-d, %Y, %-I:%M:%S %p') AS "dateAndTime",
           c_name AS "customerName", CAST(c_custkey AS VARCHAR) AS "customerNumber"
    FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE CAST(o_totalprice AS FLOAT) > 250000.0"""

CHECK_IN = """
    SELECT CAST(l_orderkey AS VARCHAR) AS "statusTruckNumber", l_returnflag AS destination,
           CAST(l_quantity AS INTEGER) AS "milesFromShop", CAST(l_partkey AS INTEGER) AS "odometerReading",
           CAST(o_orderkey AS VARCHAR) AS "reservationId", o_orderpriority AS "locationName",
           CAST(o_orderkey AS VARCHAR) AS "checkinTruckNumber", o_orderstatus AS status
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey"""

PLACES = """
    SELECT CAST(user_id AS VARCHAR) AS account, 'NATION_' || (event_id % 25) AS location FROM events"""

COUNTRY_PICK = f"""
    SELECT p.account AS "locationAccountNumber", p.location, c."accountNumber" AS "customerAccountNumber",
           c.location AS "homeLocation", substr(c."birthDay", 1, 4) AS "birthYear"
    FROM places p JOIN ({CUSTOMER}) c ON p.account = c."accountNumber" """

COUNTRY = f"""
    WITH places AS ({PLACES} UNION ALL SELECT "accountNumber", location FROM ({CUSTOMER})) {COUNTRY_PICK}"""

RISK = f"""
    SELECT e.customer, e.score, c.email, substr(c."birthDay", 1, 4) AS "birthYear"
    FROM (SELECT {EMAIL.format('user_id')} AS customer, CAST(CAST(value AS FLOAT) AS DOUBLE) AS score FROM events) e
    JOIN ({CUSTOMER}) c ON e.customer = c.email"""

# How each mixed click is spoiled, and the fields it then has.
MIXED = f"""
    SELECT *, CASE WHEN event_id % 7 = 0 THEN 'renamed' WHEN event_id % 11 = 0 THEN 'null'
                   WHEN event_id % 13 = 0 THEN 'text' WHEN event_id % 17 = 0 THEN 'cut' ELSE 'good' END AS flaw
    FROM ({CLICK}) JOIN (SELECT event_id, event_type FROM events) USING (event_id)"""

MIXED_VALUE = """
    CASE flaw
        WHEN 'renamed' THEN '{"user_email":"' || email || '","timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":' || number || '}'
        WHEN 'text' THEN '{"email":"' || email || '","timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":"many"}'
        WHEN 'cut' THEN '{"email":' || event_type END"""


def _windows(size: int) -> str:
    hops = size // 10
    return f"""
    SELECT uri, start_at AS window_start, start_at + INTERVAL {size} SECOND AS window_end,
           CAST(sum(number) AS BIGINT) AS total
    FROM (SELECT uri, number, time_bucket(INTERVAL 10 SECOND, ts) - to_seconds(10 * hop) AS start_at
          FROM ({CLICK}), range({hops}) hops(hop))
    GROUP BY uri, start_at"""


STATION = f"""
    SELECT CAST(user_id AS INTEGER) AS station_id, 'Station ' || user_id AS station_name, {K} AS "order",
           CASE WHEN event_type IN ('click', 'purchase') THEN 'red' WHEN event_type IN ('purchase', 'signup') THEN 'green'
                WHEN event_type = 'view' THEN 'blue' END AS line, ts, event_id
    FROM events"""


def _latest(rows: str, columns: str, keys: str, order: str) -> str:
    return f"""
    SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn FROM ({rows}))
    WHERE rn = 1"""


ATTRIBUTES = f"""
    SELECT email, uri, CAST(number AS INTEGER) AS number, name, event_type AS element, props AS content
    FROM ({CLICK}) JOIN (SELECT event_id, event_type, props, unnest(['first', 'k' || {K}]) AS name FROM events) USING (event_id)"""

_LINE = "(CASE ({0}) % 4 WHEN 0 THEN 'blue' WHEN 1 THEN 'green' WHEN 2 THEN 'red' END)"

# Messages of the board in the order (ts, kind, topic, event_id); event ids are unique, so
# the order within one kind is decided by ts, the topic text and the id.
BOARD = f"""
    WITH e AS (SELECT *, {K} AS k FROM events),
    regs AS (
        SELECT * FROM (
            SELECT user_id AS station_id, {_LINE.format('event_id')} AS line, 'Station ' || user_id AS station_name,
                   k AS "order", ts, row_number() OVER (PARTITION BY user_id, {_LINE.format('event_id')}
                                                        ORDER BY ts DESC, event_id DESC) AS rn
            FROM e WHERE event_type = 'signup')
        WHERE rn = 1 AND line IS NOT NULL),
    arr AS (
        SELECT user_id AS station_id, 'T' || lpad(CAST(event_id % 1000 AS VARCHAR), 3, '0') AS train_id,
               CASE WHEN event_id % 2 = 0 THEN 'a' ELSE 'b' END AS direction, {_LINE.format('event_id + k')} AS line,
               CASE WHEN k % 3 = 0 THEN 'out of service' ELSE 'in service' END AS status,
               CASE WHEN k % 10 <> 0 THEN k END AS prev_station,
               CASE WHEN k % 15 <> 1 THEN CASE WHEN event_id % 3 = 0 THEN 'b' ELSE 'a' END END AS prev_direction,
               ts, 'station_' || user_id AS topic, event_id
        FROM e WHERE event_type IN ('view', 'click')),
    slots AS (
        SELECT line, prev_station AS station_id, prev_direction AS direction, NULL AS train_id, NULL AS status,
               ts, topic, event_id, 0 AS step
        FROM arr WHERE prev_station IS NOT NULL AND prev_direction IS NOT NULL
        UNION ALL
        SELECT line, station_id, direction, train_id, status, ts, topic, event_id, 1 FROM arr WHERE event_id % 9 <> 0),
    newest AS (
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY line, station_id, direction
                                                    ORDER BY ts DESC, topic DESC, event_id DESC, step DESC) AS rn
                       FROM slots WHERE line IS NOT NULL) WHERE rn = 1),
    counts AS (
        SELECT * FROM (SELECT user_id AS station_id, k AS entries, ts,
                              row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
                       FROM e WHERE event_type = 'purchase') WHERE rn = 1),
    state AS (
        SELECT r.line, r.station_id, r.station_name, r."order", a.train_id AS train_a, a.status AS status_a,
               b.train_id AS train_b, b.status AS status_b, coalesce(c.entries, 0) AS entries
        FROM regs r
        LEFT JOIN newest a ON a.line = r.line AND a.station_id = r.station_id AND a.direction = 'a' AND a.ts >= r.ts
        LEFT JOIN newest b ON b.line = r.line AND b.station_id = r.station_id AND b.direction = 'b' AND b.ts >= r.ts
        LEFT JOIN counts c ON c.station_id = r.station_id AND c.ts >= r.ts)"""

STATE_COLUMNS = """
    SELECT line, CAST(station_id AS INTEGER) AS station_id, station_name, "order", train_a, status_a, train_b, status_b,
           CAST(entries AS BIGINT) AS entries FROM state"""

STATUS_BOARD = f"""{BOARD}
    SELECT line, CASE line WHEN 'blue' THEN '#1E90FF' WHEN 'green' THEN '#32CD32' WHEN 'red' THEN '#DC143C' END AS color,
           CAST(station_id AS INTEGER) AS station_id, "order", station_name, coalesce(train_a, '---') AS direction_a,
           coalesce(train_b, '---') AS direction_b, CAST(entries AS BIGINT) AS entries FROM state"""

# Each message of the board beside the registration and the slot changes before it.
OUTCOMES = f"""{BOARD},
    messages AS (
        SELECT *, row_number() OVER (ORDER BY ts, rank, topic, "offset", step) AS seq FROM (
            SELECT {_LINE.format('event_id')} AS line, user_id AS station_id, event_id AS "offset", 'station' AS kind, 0 AS step, ts, 0 AS rank,
                   '' AS topic, NULL AS train_id, NULL AS status, NULL AS entries FROM e WHERE event_type = 'signup'
            UNION ALL SELECT line, station_id, event_id, direction, step, ts, 1, topic, train_id, status, NULL FROM slots
            UNION ALL SELECT unnest(['blue', 'green', 'red']), user_id, event_id, 'count', 0, ts, 2, '', NULL, NULL, k FROM e WHERE event_type = 'purchase')
        WHERE line IS NOT NULL),
    marked AS (
        SELECT *, max(CASE WHEN kind = 'station' THEN seq END) OVER w AS reg, min(CASE WHEN kind = 'station' THEN seq END) OVER w AS first_reg,
               max(CASE WHEN kind = 'a' THEN seq END) OVER w AS a_seq, max(CASE WHEN kind = 'b' THEN seq END) OVER w AS b_seq,
               max(CASE WHEN kind = 'count' THEN seq END) OVER w AS c_seq
        FROM messages WINDOW w AS (PARTITION BY line, station_id ORDER BY seq))
    SELECT m.line, CAST(m.station_id AS INTEGER) AS station_id, m."offset", m.kind, CAST(m.step AS INTEGER) AS step,
           CASE WHEN m.kind = 'station' THEN CASE WHEN m.first_reg = m.seq THEN 'registered' ELSE 'reset' END WHEN m.reg IS NULL THEN 'unknown'
                WHEN m.kind = 'count' THEN 'counted' WHEN m.step = 1 THEN 'applied' ELSE 'cleared' END AS outcome,
           CASE WHEN a_seq > reg THEN a.train_id END AS train_a, CASE WHEN a_seq > reg THEN a.status END AS status_a,
           CASE WHEN b_seq > reg THEN b.train_id END AS train_b, CASE WHEN b_seq > reg THEN b.status END AS status_b,
           CAST(CASE WHEN reg IS NOT NULL THEN CASE WHEN c_seq > reg THEN c.entries ELSE 0 END END AS BIGINT) AS entries
    FROM marked m LEFT JOIN messages a ON a.seq = m.a_seq LEFT JOIN messages b ON b.seq = m.b_seq LEFT JOIN messages c ON c.seq = m.c_seq"""

CURRENT = f"""
    SELECT event_id AS "offset", uri, ts AS at, CAST(own AS BIGINT) AS current,
           CAST(own + coalesce(sum(coalesce(number, 0)) OVER (PARTITION BY uri ORDER BY pane RANGE BETWEEN 5 PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS oldest
    FROM (SELECT *, sum(coalesce(number, 0)) OVER (PARTITION BY uri, pane ORDER BY ts, event_id) AS own
          FROM (SELECT *, epoch_us(ts) // 10000000 AS pane FROM ({CLICK})))"""

TOPOLOGY = """
    WITH s AS (
        SELECT c_custkey AS stop_id, c_custkey // 2 AS station_id, c_custkey % 997 AS "order", c_nationkey AS n,
               'Station ' || (CASE WHEN (c_custkey // 2) % 10 = 9 THEN c_custkey // 2 - 1 ELSE c_custkey // 2 END) AS station_name
        FROM customer),
    on_lines AS (
        SELECT 'red' AS line, * FROM s WHERE n % 3 = 0 UNION ALL SELECT 'blue', * FROM s WHERE n % 3 = 1
        UNION ALL SELECT 'green', * FROM s WHERE n % 2 = 0),
    named AS (
        SELECT *, row_number() OVER (PARTITION BY line, station_name ORDER BY "order", stop_id) AS rn,
               min(station_id) OVER (PARTITION BY line, station_name) <> max(station_id) OVER (PARTITION BY line, station_name) AS shared_name
        FROM on_lines)"""

RIDERS = """
    WITH hours AS (SELECT hour(ts) AS hour, count(*) AS n FROM events GROUP BY 1),
    curve AS (SELECT hour, n / (SELECT sum(n) FROM hours) AS ratio FROM hours),
    riders AS (
        SELECT CAST(s_suppkey AS INTEGER) AS station_id, day,
               round_even(abs(s_acctbal) / CASE day WHEN 'weekday' THEN 1 WHEN 'saturday' THEN 2 ELSE 4 END, 0) AS riders
        FROM supplier, (SELECT unnest(['weekday', 'saturday', 'sunday']) AS day))"""


def _entries_at(day: str) -> str:
    return f"""{RIDERS}
    SELECT event_id, CAST(user_id AS INTEGER) AS station_id, ts,
           CASE WHEN riders IS NOT NULL THEN CAST(greatest(floor(riders * ratio / 3), 0) AS BIGINT) END AS entries
    FROM events LEFT JOIN curve ON hour(ts) = curve.hour
    LEFT JOIN riders ON riders.station_id = user_id AND day = {day}"""


ORACLES = {
    "letter_counts": """
        SELECT count(*) FILTER (WHERE contains(text, 'd')) AS num_d, count(*) FILTER (WHERE contains(text, 's')) AS num_s
        FROM documents""",
    "line_letter_counts": """
        SELECT count(*) FILTER (WHERE contains(line, 'd')) AS num_d, count(*) FILTER (WHERE contains(line, 's')) AS num_s
        FROM (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM documents)""",
    "fuel_level": "SELECT CAST(user_id AS VARCHAR) AS key, props AS value FROM events",
    "balance_updates": "SELECT CAST(c_custkey AS VARCHAR) AS key, c_name AS value FROM customer",
    "gear_position": 'SELECT CAST(l_suppkey AS VARCHAR) AS "truckId", l_returnflag AS "gearPosition" FROM lineitem',
    "atm_visits": "SELECT CAST(o_custkey AS VARCHAR) AS key, o_orderpriority AS value FROM orders",
    "vehicle_status": """
        SELECT CAST(l_orderkey AS VARCHAR) AS "truckNumber", l_returnflag AS destination,
               CAST(l_quantity AS INTEGER) AS "milesFromShop", CAST(l_partkey AS INTEGER) AS "odometerReading" FROM lineitem""",
    "bank_deposits": f"""
        SELECT CAST(o_custkey AS VARCHAR) AS "accountNumber", CAST(o_totalprice AS VARCHAR) AS amount,
               {TEXT_TIME.format('o_orderdate')} AS "dateAndTime" FROM orders""",
    "json_flatten": f"SELECT {K} AS k, event_id FROM events",
    "purchase_json": f"""
        SELECT CAST(event_id AS VARCHAR) AS key, '{{"username":"' || {EMAIL.format('user_id')} || '","currency":"USD","amount":' ||
               CASE WHEN event_type = 'purchase' THEN CAST({K} AS VARCHAR) ELSE 'null' END || '}}' AS value FROM events""",
    "large_deposit_join": DEPOSIT_JOIN,
    "large_deposit_join_split": DEPOSIT_JOIN,
    "vehicle_check_in": CHECK_IN,
    "vehicle_check_in_topic": f"""
        SELECT "statusTruckNumber" AS key, '{{"statusTruckNumber":"' || "statusTruckNumber" || '","destination":"' || destination ||
               '","milesFromShop":"' || "milesFromShop" || '","odometerReading":"' || "odometerReading" ||
               '","reservationId":"' || "reservationId" || '","locationName":"' || "locationName" ||
               '","checkinTruckNumber":"' || "checkinTruckNumber" || '","status":"' || status || '"}}' AS value
        FROM ({CHECK_IN})""",
    "withdrawal_location_topic": f"""
        SELECT CAST(l_orderkey AS VARCHAR) AS key, '{{"accountNumber":"' || l_suppkey || '","amount":"' || CAST(l_extendedprice AS VARCHAR) ||
               '","dateAndTime":"' || {TEXT_TIME.format('l_shipdate')} || '","transactionId":"' || l_orderkey ||
               '","atmTransactionId":"' || o_orderkey || '","atmLocation":"' || o_orderpriority ||
               '","transactionDate":"' || {TEXT_TIME.format('o_orderdate')} || '"}}' AS value
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "bounded_deposit_join": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate AS shipped, o_orderkey, o_orderdate AS ordered
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        WHERE l_shipdate BETWEEN o_orderdate - INTERVAL 30 DAY AND o_orderdate + INTERVAL 30 DAY""",
    "known_only": """
        SELECT event_id, user_id, event_type FROM events
        WHERE user_id IN (SELECT user_id FROM events WHERE event_type = 'signup')""",
    "left_defaults": f"""
        SELECT c_custkey, c_name, coalesce(n, 0) AS n_orders, coalesce(o_orderstatus, '---') AS o_orderstatus
        FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey
        LEFT JOIN ({_latest("SELECT * FROM orders", "o_custkey AS k, o_orderstatus", "o_custkey", "o_orderdate DESC, o_orderkey DESC")})
        ON k = c_custkey""",
    "lookup_first": f"""
        SELECT o_orderkey, o_custkey, l_linenumber, l_partkey FROM orders JOIN ({_latest(
            "SELECT * FROM lineitem", "l_orderkey, l_linenumber, l_partkey", "l_orderkey",
            "l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice")}) ON l_orderkey = o_orderkey""",
    "truck_reservations": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "reservationId", CAST(o_custkey AS VARCHAR) AS "customerId",
               'Customer#' || o_custkey AS "customerName", CAST(o_orderkey % 1000 AS VARCHAR) AS "truckNumber",
               strftime(o_orderdate, '%Y-%m-%d') AS "reservationDate", o_orderstatus AS "checkInStatus",
               o_orderpriority AS origin, 'NATION_0' AS destination FROM orders""",
    "customer_locations": f"""
        SELECT account AS "accountNumber", location FROM ({PLACES})
        UNION ALL SELECT "accountNumber", location FROM ({CUSTOMER})
        UNION ALL SELECT NULL, NULL FROM orders UNION ALL SELECT NULL, NULL FROM lineitem""",
    "payment_topic": """
        SELECT CAST(l_orderkey AS VARCHAR) AS key, '{"reservationId":"' || l_orderkey || '","amount":"' || CAST(l_quantity AS INTEGER) || '"}' AS value
        FROM lineitem
        UNION ALL SELECT CAST(o_orderkey AS VARCHAR), '{"reservationId":"' || o_orderkey || '"}' FROM orders
        UNION ALL SELECT NULL, '{}' FROM customer UNION ALL SELECT NULL, '{}' FROM events""",
    "country_now_and_home": COUNTRY,
    "country_now_and_home_split": f"WITH places AS ({PLACES}) {COUNTRY_PICK}",
    "email_and_birth_year": f"""SELECT email, substr("birthDay", 1, 4) AS "birthYear" FROM ({CUSTOMER})""",
    "birth_year_split": "SELECT o_orderkey, split_part(strftime(o_orderdate, '%Y-%m-%d'), '-', 1) AS year FROM orders",
    "change_feed_decode": f"""{CUSTOMER}
        UNION ALL SELECT 'Customer#' || o_custkey, NULL, NULL, NULL, NULL, NULL FROM orders
        UNION ALL SELECT 'Supplier#' || l_suppkey, NULL, NULL, NULL, NULL, NULL FROM lineitem
        UNION ALL SELECT NULL, NULL, NULL, NULL, account, location FROM ({PLACES})""",
    "customer_risk": f"""
        SELECT {EMAIL.format('user_id')} AS customer, CAST(CAST(value AS FLOAT) AS DOUBLE) AS score FROM events""",
    "risk_by_birth_year": RISK,
    "risk_topic": f"""
        SELECT r.customer AS key, r.customer, CAST(CAST(score AS FLOAT) AS VARCHAR)::DOUBLE AS score, email, "birthYear"
        FROM ({RISK}) r""",
    "click_text": f"""
        SELECT '{{"email":"' || email || '","timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":' || number || '}}' AS value
        FROM ({CLICK})""",
    "click_print": f"""
        SELECT '{{' || chr(10) || '  "email" : "' || email || '",' || chr(10) || '  "timestamp" : "' || "timestamp" || '",' || chr(10) ||
               '  "uri" : "' || uri || '",' || chr(10) || '  "number" : ' || number || chr(10) || '}}' AS value
        FROM ({CLICK})""",
    "click_events": f"""
        SELECT CASE WHEN flaw = 'null' THEN NULL ELSE email END AS email, "timestamp", uri, number
        FROM ({MIXED}) WHERE flaw IN ('good', 'null')""",
    "invalid_clicks": f"""
        SELECT {MIXED_VALUE} AS value, CASE flaw WHEN 'renamed' THEN 'missing email' WHEN 'text' THEN 'type of number' ELSE 'malformed' END AS reason
        FROM ({MIXED}) WHERE flaw NOT IN ('good', 'null')""",
    "required_clicks_valid": f"""
        SELECT CASE WHEN flaw = 'null' THEN NULL ELSE email END AS email, "timestamp", uri
        FROM ({MIXED}) WHERE flaw IN ('good', 'null', 'text')""",
    "required_clicks_rejected": f"""
        SELECT {MIXED_VALUE} AS value, CASE flaw WHEN 'renamed' THEN 'email' ELSE 'malformed' END AS reason
        FROM ({MIXED}) WHERE flaw IN ('renamed', 'cut')""",
    "sanitized_clicks": f"""
        SELECT uri AS key, '{{"timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":' || number || '}}' AS value
        FROM ({CLICK})""",
    "popular_clicks": f"""
        SELECT uri AS key, '{{"email":"' || email || '","timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":' || number || '}}' AS value
        FROM ({CLICK}) WHERE number >= 100""",
    "uri_sums": f"SELECT uri, CAST(sum(number) AS BIGINT) AS total FROM ({CLICK}) GROUP BY uri",
    "tumbling_uri_sums": _windows(10),
    "hopping_uri_sums": _windows(60),
    "current_uri_sums": _latest(_windows(60), "uri, window_start, window_end, total", "uri", "window_start DESC"),
    "click_attributes": ATTRIBUTES,
    "avro_click_attributes": ATTRIBUTES,
    "running_sum": f"SELECT event_type, CAST(sum({K}) AS BIGINT) AS total FROM events GROUP BY event_type",
    "keyed_count": "SELECT user_id, count(user_id) AS count FROM events GROUP BY user_id",
    "count_latest_by_key": "SELECT user_id, count(DISTINCT event_type) AS count FROM events GROUP BY user_id",
    "latest_by_key": _latest("SELECT * FROM events", "event_id, ts, user_id, event_type, value, props", "user_id",
                             "ts DESC, event_id DESC"),
    "latest_item_by_part": _latest(
        "SELECT * FROM lineitem", "l_partkey, l_shipdate, l_orderkey, l_linenumber, l_suppkey, l_quantity, l_extendedprice",
        "l_partkey", "l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC"),
    "distinct_in_order": """
        SELECT l_returnflag, l_partkey, min(l_shipdate) AS l_shipdate FROM lineitem GROUP BY l_returnflag, l_partkey""",
    "progress_count": """
        SELECT event_type, count(*) AS count, (SELECT count(*) FROM events) AS progress FROM events GROUP BY event_type""",
    "flagged_parts": "SELECT p_partkey FROM part WHERE p_size % 7 <> 0 AND p_size > 25",
    "scored_clicks": f"""
        SELECT uri AS key, '{{"email":"' || email || '","timestamp":"' || "timestamp" || '","uri":"' || uri || '","number":' || number ||
               ',"score":' || (CAST('0x' || substr(md5('0/clicks/0/' || event_id), 1, 8) AS BIGINT) % 100 + 1) || '}}' AS value
        FROM ({CLICK})""",
    "text_without": "SELECT doc_id, lang FROM documents WHERE NOT contains(text, 'the')",
    "topic_match": f"""
        SELECT event_id, 'org.example.arrival.' || event_type || '.v3' AS topic FROM events
        WHERE {K} % 2 = 0 AND {K} % 3 = 0""",
    "topic_pattern": """
        SELECT 'org.example.arrival.station_' || user_id || '.v3' AS topic, event_id AS "offset" FROM events
        WHERE event_type IN ('view', 'click')""",
    "route_by_value": """
        SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type ELSE 'other' END AS branch
        FROM events""",
    "route_label": f"""
        SELECT CASE WHEN event_type IN ('view', 'click', 'purchase') THEN event_type ELSE 'other' END AS branch,
               count(*) AS rows, CAST(sum({K}) AS BIGINT) AS k FROM events GROUP BY 1""",
    "fan_out": "SELECT event_id, user_id, unnest(['blue', 'green', 'red']) AS line FROM events",
    "slug_topics": """
        SELECT p_partkey, slug, 'org.example.arrival.' || slug || '.v3' AS topic FROM (
            SELECT p_partkey, replace(replace(replace(replace(
                lower(p_name || '/' || p_brand || '''s-' || p_type), '/', '_and_'), ' ', '_'), '-', '_'), '''', '') AS slug
            FROM part)""",
    "line_colors": """
        SELECT p_partkey,
               CASE WHEN p_size > 40 THEN 'red' WHEN p_size > 20 AND p_size < 45 THEN 'green' WHEN p_size < 25 THEN 'blue' END AS line,
               CASE WHEN p_size > 40 THEN '#DC143C' WHEN p_size > 20 AND p_size < 45 THEN '#32CD32'
                    WHEN p_size < 15 THEN '#1E90FF' ELSE '0xFFFFFF' END AS color
        FROM part""",
    "status_texts": """
        SELECT l_orderkey, l_linenumber, lower(l_returnflag) || ' ' || lower(l_linestatus) || ' in service' AS status,
               l_returnflag || ' ' || l_linestatus || ' In Service' AS title,
               CAST(trunc(l_extendedprice - 50000) AS INTEGER) AS whole,
               CASE WHEN l_linenumber > 2 THEN l_returnflag ELSE '---' END AS flag
        FROM lineitem""",
    "epoch_keys": """
        SELECT event_id, (epoch_us(ts) + 500) // 1000 AS millis, make_timestamp((epoch_us(ts) + 500) // 1000 * 1000) AS at
        FROM events""",
    "text_times": "SELECT o_orderkey, o_orderdate AS at FROM orders",
    "frame_ids": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 258 WHEN 'O' THEN 70000 END AS schema_id,
               CASE WHEN o_orderstatus IN ('F', 'O') THEN o_orderpriority END AS payload FROM orders""",
    "station_rows": f"""SELECT station_id, station_name, "order", line, event_id AS "offset" FROM ({STATION})""",
    "station_table": _latest(STATION, 'station_id, station_name, "order", line', "station_id", "ts DESC, event_id DESC"),
    "station_table_by_line": _latest(STATION, 'station_id, station_name, "order", line', "station_id, line",
                                     "ts DESC, event_id DESC"),
    "turnstile_summary": """
        SELECT CAST(user_id AS INTEGER) AS "STATION_ID", count(*) AS "COUNT" FROM events GROUP BY user_id""",
    "turnstile_table_summary": """
        SELECT CAST(user_id AS INTEGER) AS station_id, count(DISTINCT event_type) AS count FROM events GROUP BY user_id""",
    "declared_table_sql": """
        SELECT event_type AS line, count(*) AS entries, count(DISTINCT user_id) AS stations FROM events GROUP BY event_type""",
    "declared_keyed_table": _latest(
        "SELECT *, CAST(user_id AS INTEGER) AS station_id, 'Station ' || user_id AS station_name FROM events",
        "station_id, station_name, event_type AS line", "station_id", "ts DESC, event_id DESC"),
    "position_state": BOARD + STATE_COLUMNS,
    "status_board": STATUS_BOARD,
    "status_board_order": f"""{BOARD}
        SELECT line, CAST(station_id AS INTEGER) AS station_id,
               CAST(row_number() OVER (PARTITION BY line ORDER BY "order", station_id) AS INTEGER) AS rank FROM state""",
    "weather_line": f"""
        SELECT CAST(trunc(CAST(value AS FLOAT)) AS INTEGER) AS degrees, CASE WHEN {K} % 2 = 0 THEN 'Partly Cloudy' ELSE 'Windy' END AS sky
        FROM events WHERE event_type = 'error' ORDER BY ts DESC, event_id DESC LIMIT 1""",
    "line_topology": f"""{TOPOLOGY}
        SELECT line, station_name, CAST(station_id AS INTEGER) AS station_id, CAST("order" AS INTEGER) AS "order", shared_name,
               CAST(lag(station_id) OVER w AS INTEGER) AS prev_station_id, CAST(lead(station_id) OVER w AS INTEGER) AS next_station_id
        FROM named WHERE rn = 1 WINDOW w AS (PARTITION BY line ORDER BY "order", station_id, station_name)""",
    "line_hops": f"{TOPOLOGY} SELECT line, count(*) - 1 AS hops FROM named WHERE rn = 1 GROUP BY line",
    "expected_entries": f"""{RIDERS}
        SELECT station_id, day, CAST(hour AS INTEGER) AS hour, CAST(greatest(floor(riders * ratio / 3), 0) AS BIGINT) AS entries
        FROM riders, curve""",
    "entries_at": _entries_at("CASE dayofweek(ts) WHEN 0 THEN 'sunday' WHEN 6 THEN 'saturday' ELSE 'weekday' END"),
    "incremental_ingest": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
               '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value,
               CASE WHEN o_orderkey <= (SELECT floor(avg(o_orderkey)) FROM orders) THEN 1 ELSE 2 END AS increment
        FROM orders""",
    "csv_parts": """
        SELECT p_partkey, p_name || ', ' || p_brand AS p_name, p_brand, p_type, p_size, p_retailprice FROM part""",
}

ORACLES |= {
    "stream_uri_sums": ORACLES["uri_sums"],
    "stream_tumbling_uri_sums": ORACLES["tumbling_uri_sums"],
    "stream_hopping_uri_sums": ORACLES["hopping_uri_sums"],
    "stream_large_deposit_join": ORACLES["large_deposit_join"],
    "stream_deposits_of_hot_accounts": ORACLES["large_deposit_join"],
    "stream_country_now_and_home": ORACLES["country_now_and_home"],
    "stream_station_table": ORACLES["station_table"],
    "stream_turnstile_summary": """
        SELECT CAST(user_id AS INTEGER) AS station_id, count(*) AS count FROM events GROUP BY user_id""",
    "stream_status_board": ORACLES["status_board"],
    "stream_tumbling_bounded": f"SELECT *, CAST(0 AS BIGINT) AS late_rows FROM ({ORACLES['tumbling_uri_sums']})",
    "restarted_sums": ORACLES["uri_sums"],
    "stream_current_uri_sums": ORACLES["current_uri_sums"],
    "stream_turnstile_table_summary": ORACLES["turnstile_table_summary"],
    "stream_users_by_latest_event": f"""
        SELECT event_type, count(*) AS count FROM ({_latest("SELECT * FROM events", "user_id, event_type", "user_id", "ts DESC, event_id DESC")})
        GROUP BY event_type""",
    "stream_current_per_event": CURRENT,
    "stream_tumbling_current_per_event": f'SELECT "offset", uri, current FROM ({CURRENT})',
    "stream_message_outcomes": OUTCOMES,
    "stream_bounded_deposit_join": """
        SELECT CAST(o_orderkey AS VARCHAR) AS "accountNumber", CAST(CAST(o_totalprice AS FLOAT) AS DOUBLE) AS amount,
               'line ' || l_linenumber AS "customerName", o_orderdate AS "depositTime", l_shipdate AS "customerTime"
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey
        WHERE CAST(o_totalprice AS FLOAT) > 250000.0
          AND o_orderdate BETWEEN l_shipdate - INTERVAL 30 DAY AND l_shipdate + INTERVAL 30 DAY""",
    "replayed_topic": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, run FROM orders, (SELECT CAST(unnest([0, 2]) AS INTEGER) AS run)""",
    "bounded_batches": """
        SELECT CAST(3 AS BIGINT) AS batches, CAST(2 AS BIGINT) AS most_files, count(*) AS rows FROM orders""",
    "split_clicks": f"""
        SELECT uri AS key, '{{' || CASE WHEN flaw = 'null' THEN '' ELSE '"email":"' || email || '",' END || '"timestamp":"' || "timestamp" ||
               '","uri":"' || uri || '"}}' AS value, 'clicks.required' AS topic
        FROM ({MIXED}) WHERE flaw IN ('good', 'null', 'text')
        UNION ALL SELECT reason, value, 'clicks.rejected' FROM ({ORACLES['required_clicks_rejected']})""",
    "stream_newest_orders": _latest(
        "SELECT * FROM orders", "o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority",
        "o_custkey", "o_orderdate DESC, o_orderkey DESC"),
    "stream_text_lines": ORACLES["line_letter_counts"],
    "stream_growing_lines": """
        SELECT count(*) FILTER (WHERE contains(line, 'd')) AS num_d, count(*) FILTER (WHERE contains(line, 's')) AS num_s
        FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
    "stream_topic_pattern": ORACLES["topic_pattern"],
    "stream_sums_and_late_rows": f"SELECT CAST(sum(number) AS BIGINT) AS total, true AS some_late FROM ({CLICK})",
    "published_withdrawals": ORACLES["withdrawal_location_topic"],
    "published_gears": "SELECT CAST(l_suppkey AS VARCHAR) AS key, l_returnflag AS value FROM lineitem",
    "published_summary": """
        SELECT CAST(user_id AS VARCHAR) AS key, CAST(user_id AS INTEGER) AS "STATION_ID", count(*) AS "COUNT"
        FROM events GROUP BY user_id""",
    "handled_by_topic": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key, 'bank-deposits' AS topic, 'deposits' AS handler FROM orders
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'bank-customers', 'customers' FROM customer""",
    "polled_ingest": """
        SELECT CAST(o_orderkey AS VARCHAR) AS key,
               '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}' AS value
        FROM orders""",
}
