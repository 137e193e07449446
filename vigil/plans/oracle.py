"""DuckDB SQL oracles (independent formulations) for the named queries.

Tables are the driver's pre-registered views. Statistics use the reference's own shifted-sum
form (K = first reading) with window sums; the Spark side uses batch moments re-centred on K,
so agreement is a real cross-check. Doubles derived from sums are rounded to 4 decimals.
"""

LONG_READINGS = """
r AS (
  SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS guid, event_type AS sensor, value AS x,
         date_trunc('day', ts) AS batch
  FROM events WHERE value IS NOT NULL AND NOT isnan(value))"""

WIDE_READINGS = """
m AS (
  SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS guid, date_trunc('hour', ts) AS batch,
         value AS v, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
  FROM events),
r0 AS (
  SELECT ord, guid, batch, 'TEMPERATURE' AS sensor, v AS x FROM m
  UNION ALL SELECT ord, guid, batch, 'PRESSURE', 25.0 + k / 20.0 FROM m
  UNION ALL SELECT ord, guid, batch, 'HUMIDITY', k FROM m
  UNION ALL SELECT ord, guid, batch, 'LIGHT', 255.0 - v FROM m),
r AS (SELECT * FROM r0 WHERE x IS NOT NULL AND NOT isnan(x))"""

THRESHOLDS = """
kk AS (SELECT sensor, arg_min(x, ord) AS k FROM r GROUP BY sensor),
p AS (
  SELECT r.sensor, r.batch, count(*) AS n, sum(r.x - kk.k) AS a, sum((r.x - kk.k) * (r.x - kk.k)) AS b
  FROM r JOIN kk ON r.sensor = kk.sensor GROUP BY r.sensor, r.batch),
c AS (
  SELECT p.sensor, p.batch, kk.k,
         CAST(sum(p.n) OVER w AS BIGINT) AS cnt, sum(p.a) OVER w AS sa, sum(p.b) OVER w AS sb
  FROM p JOIN kk ON p.sensor = kk.sensor
  WINDOW w AS (PARTITION BY p.sensor ORDER BY p.batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
s AS (
  SELECT sensor, batch, cnt, k + sa / cnt AS mean,
         CASE WHEN cnt < 2 THEN 0.0 ELSE (sb - sa * sa / cnt) / (cnt - 1) END AS var
  FROM c),
th AS (
  SELECT sensor, batch, cnt, mean, sqrt(greatest(var, 0.0)) AS std,
         mean - 2.0 * sqrt(greatest(var, 0.0)) AS lo, mean + 2.0 * sqrt(greatest(var, 0.0)) AS hi
  FROM s),
coded AS (
  SELECT r.ord, r.guid, r.sensor, r.batch, r.x, th.lo, th.hi,
         CASE WHEN r.x > th.hi THEN 1 WHEN r.x < th.lo THEN -1 ELSE 0 END AS code
  FROM r JOIN th ON r.sensor = th.sensor AND r.batch = th.batch)"""

STATES = """
st AS (
  SELECT *, max(abs(code)) OVER (PARTITION BY sensor ORDER BY batch, ord
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
  FROM coded),
states AS (
  SELECT ord, guid, sensor, batch, x, lo, hi, code,
         CASE WHEN code <> 0 THEN code WHEN coalesce(prior, 0) > 0 THEN 2 ELSE 0 END AS state
  FROM st)"""

ALARM_TYPES = """
ends AS (SELECT sensor, batch, arg_max(state, ord) AS s FROM states GROUP BY sensor, batch),
bs AS (
  SELECT batch,
         max(CASE WHEN sensor = 'TEMPERATURE' THEN s END) AS t, max(CASE WHEN sensor = 'PRESSURE' THEN s END) AS p,
         max(CASE WHEN sensor = 'HUMIDITY' THEN s END) AS h, max(CASE WHEN sensor = 'LIGHT' THEN s END) AS l
  FROM ends GROUP BY batch),
types AS (
  SELECT batch, CASE WHEN abs(t) = 1 THEN 'TEMPERATURE' WHEN abs(p) = 1 THEN 'PRESSURE'
                     WHEN abs(h) = 1 THEN 'HUMIDITY' WHEN abs(l) = 1 THEN 'LIGHT' ELSE '' END AS alarm_type
  FROM bs)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n"


ORACLE = {
    "breaches": _with(LONG_READINGS, THRESHOLDS) + """
SELECT ord, guid, sensor, batch, x, round(round(lo, 10), 4) AS lo, round(round(hi, 10), 4) AS hi, code FROM coded""",

    "running_stats": _with(LONG_READINGS, THRESHOLDS) + """
SELECT sensor, batch, cnt, round(round(mean, 10), 4) AS mean, round(round(std, 10), 4) AS std, round(round(lo, 10), 4) AS lo,
       round(round(hi, 10), 4) AS hi FROM th""",

    "running_totals": _with(LONG_READINGS) + """
SELECT sensor, batch, CAST(sum(n) OVER w AS BIGINT) AS cnt, round(round(sum(t) OVER w, 10), 4) AS total,
       round(round(sum(t) OVER w / sum(n) OVER w, 10), 4) AS mean
FROM (SELECT sensor, batch, count(*) AS n, sum(x) AS t FROM r GROUP BY sensor, batch)
WINDOW w AS (PARTITION BY sensor ORDER BY batch ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",

    "sensor_states": _with(WIDE_READINGS, THRESHOLDS, STATES) + """
SELECT ord, guid, sensor, batch, x, code, state FROM states""",

    "breach_events": _with(WIDE_READINGS, THRESHOLDS, STATES) + """
SELECT sensor, batch, ord, guid, x, round(round(lo, 10), 4) AS lo, round(round(hi, 10), 4) AS hi,
       CASE code WHEN 1 THEN 'HIGH' WHEN -1 THEN 'LOW' ELSE 'BACK' END AS kind
FROM states WHERE code <> 0 OR state = 2""",

    "alarm_type": _with(WIDE_READINGS, THRESHOLDS, STATES, ALARM_TYPES) + """
SELECT batch, alarm_type FROM types""",

    "alarm_commands": _with(WIDE_READINGS, THRESHOLDS, STATES, ALARM_TYPES) + """
, e AS (SELECT batch, alarm_type, alarm_type <> '' AS on_,
              coalesce(lag(alarm_type <> '') OVER (ORDER BY batch), false) AS prev FROM types)
SELECT batch, CASE WHEN on_ THEN 'ON' ELSE 'OFF' END AS command, CASE WHEN on_ THEN '1' ELSE '0' END AS code,
       alarm_type AS warning, CASE WHEN on_ THEN 1 ELSE 0 END AS alarm
FROM e WHERE on_ <> prev""",
}

# The alarm with acknowledgements replays the state machine literally, batch by batch.
ORACLE["alarm_with_acks"] = ("WITH RECURSIVE" + ",".join([WIDE_READINGS, THRESHOLDS, STATES, ALARM_TYPES]) + """,
seq AS (SELECT row_number() OVER (ORDER BY batch) AS i, batch, alarm_type, hour(batch) % 3 <> 0 AS ack FROM types),
fsm(i, batch, alarm_type, ack, alarm, command) AS (
  SELECT CAST(0 AS BIGINT), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN), 0, CAST(NULL AS VARCHAR)
  UNION ALL
  SELECT q.i, q.batch, q.alarm_type, q.ack,
         CASE WHEN q.alarm_type <> '' THEN
                CASE f.alarm WHEN 1 THEN 1 WHEN 2 THEN 2 ELSE (CASE WHEN q.ack THEN 1 ELSE 3 END) END
              ELSE
                CASE f.alarm WHEN 0 THEN 0 WHEN 3 THEN 3 ELSE (CASE WHEN q.ack THEN 0 ELSE 2 END) END
         END,
         CASE WHEN q.alarm_type <> '' AND f.alarm IN (0, 3) THEN 'ON'
              WHEN q.alarm_type = '' AND f.alarm IN (1, 2) THEN 'OFF' END
  FROM fsm f JOIN seq q ON q.i = f.i + 1)
SELECT batch, alarm_type, ack, alarm, command FROM fsm WHERE i > 0""")


# ---- message, summary, line, word and baseline jobs ----------------------------------------

MSG = """
m AS (
  SELECT event_id AS ord, CAST(user_id AS VARCHAR) AS guid, date_trunc('hour', ts) AS batch, ts,
         value AS temperature, CAST(CAST(json_extract_string(props, '$.k') AS INTEGER) AS DOUBLE) AS k
  FROM events)"""

PROJECTION = """
SELECT ord, guid, CAST(NULL AS VARCHAR) AS reply_url, temperature, 25.0 + k / 20.0 AS pressure,
       k AS humidity, 255.0 - temperature AS ambient_light,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS "timestamp"
FROM m"""

DISTINCT_FLOAT = """
d AS (SELECT DISTINCT CAST(value AS FLOAT) AS temperature FROM events)"""

LINE_VALUES = MSG + """,
lv AS (
  SELECT batch, ord, 'HUMIDITY' AS sensor, printf('%f', k) AS x_text FROM m
  UNION ALL SELECT batch, ord, 'LIGHT', printf('%f', 255.0 - temperature) FROM m),
v AS (SELECT batch, ord, sensor, x_text, TRY_CAST(x_text AS DOUBLE) AS x FROM lv)"""

ORACLE.update({
    "json_decode": _with(MSG) + PROJECTION,
    "json_reassemble": _with(MSG) + PROJECTION,
    "reassemble_rejects": """
SELECT event_id AS ord, '{"guid": "cut off"' AS value, 'unclosed' AS reason FROM events WHERE event_id % 97 = 5""",
    "decode_mixed": """
WITH e AS (SELECT event_id AS ord, event_id % 11 AS f, value AS temperature,
                  CAST(13 + event_id % 88 AS INTEGER) AS levels FROM events)
SELECT ord, i AS idx, temperature, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS VARCHAR) AS reason
FROM (SELECT *, unnest(CASE WHEN f IN (2, 9) THEN [0, 1] WHEN f IN (0, 1, 3, 8) THEN [0]
                            WHEN f = 10 THEN [1] ELSE [] END) AS i FROM e)
UNION ALL
SELECT ord, NULL, NULL,
       CASE f WHEN 3 THEN 'trailing' WHEN 4 THEN 'null' WHEN 5 THEN '{"payload":5}'
              WHEN 6 THEN '{"foo":1}' WHEN 8 THEN '{"guid":'
              ELSE '{"foo":' || repeat('{"x":', levels) || '1' || repeat('}', levels) || '}' END,
       CASE WHEN f IN (6, 10) THEN 'not a message' ELSE 'malformed' END
FROM e WHERE f IN (3, 4, 5, 6, 8, 10)""",
    "sensor_array": _with(MSG) + """
SELECT ord, guid, 'TEMPERATURE' AS sensor, temperature AS x FROM m
UNION ALL SELECT ord, guid, 'PRESSURE', 25.0 + k / 20.0 FROM m
UNION ALL SELECT ord, guid, 'HUMIDITY', k FROM m
UNION ALL SELECT ord, guid, 'LIGHT', 255.0 - temperature FROM m""",
    "rejects": "SELECT event_id AS ord, 'malformed' AS reason FROM events WHERE event_type = 'error'",

    "distinct_float": _with(DISTINCT_FLOAT) + "SELECT temperature FROM d",
    "summary": _with(DISTINCT_FLOAT) + """
SELECT round(round(avg(temperature), 10), 4) AS "avg(temperature)", min(temperature) AS "min(temperature)",
       max(temperature) AS "max(temperature)" FROM d""",
    "summary_stats": _with(DISTINCT_FLOAT) + """
SELECT count(temperature) AS "count", round(round(avg(temperature), 10), 4) AS mean,
       round(round(stddev_samp(temperature), 10), 4) AS stddev, min(temperature) AS "min", max(temperature) AS "max" FROM d""",
    "describe": _with(DISTINCT_FLOAT) + """
SELECT s AS summary, round(round(v, 10), 4) AS temperature FROM (
  SELECT unnest(['count', 'mean', 'stddev', 'min', 'max']) AS s,
         unnest([count(temperature)::DOUBLE, avg(temperature), stddev_samp(temperature),
                 CAST(CAST(min(temperature) AS VARCHAR) AS DOUBLE), CAST(CAST(max(temperature) AS VARCHAR) AS DOUBLE)]) AS v FROM d)""",
    "alerts": _with(DISTINCT_FLOAT) + """
SELECT max(temperature) AS max_temperature, round(round(avg(temperature), 10), 4) AS avg_temperature,
       CASE WHEN max(temperature) > 95.0 THEN '*ALERT!* - Temperature rose above 95.0!' END AS max_alert,
       CASE WHEN avg(temperature) > 95.0 THEN 'Avg. temperature was above 95.0!'
            ELSE 'Avg. temperature was OK, not above 95.0' END AS avg_alert FROM d""",
    "search_eq": "SELECT event_id AS ord, value AS temperature FROM events WHERE value = 100.0",
    "filter_gt": "SELECT event_id AS ord, value AS temperature FROM events WHERE value > 85",
    "top_desc": "SELECT event_id AS ord, value AS temperature FROM events ORDER BY value DESC, event_id LIMIT 100",

    "line_filter": _with(MSG) + """,
c AS (SELECT batch, ord, '{"humidity":' || printf('%f', k) || ',"ambient_light":' || printf('%f', 255.0 - temperature) || ',' AS line FROM m)
SELECT batch, ord, 'HUMIDITY' AS sensor, '"humidity":' || printf('%f', k) || ',' AS line FROM m
UNION ALL SELECT batch, ord, 'LIGHT', '"ambient_light":' || printf('%f', 255.0 - temperature) || ',' FROM m
UNION ALL SELECT batch, ord, 'HUMIDITY', line FROM c UNION ALL SELECT batch, ord, 'LIGHT', line FROM c""",
    "line_filter_values": _with(LINE_VALUES) + """
SELECT batch, ord, CASE sensor WHEN 'HUMIDITY' THEN 4 ELSE 5 END AS line_no, sensor, x FROM v
UNION ALL SELECT batch, ord, 0, sensor, x FROM v""",
    "line_filter_temperature": _with(MSG) + """
SELECT batch, ord, 'TEMPERATURE' AS sensor, TRY_CAST(printf('%f', temperature) AS DOUBLE) AS x FROM m""",
    "line_values": _with(LINE_VALUES) + "SELECT batch, ord, sensor, x FROM v",
    "batch_count": _with(LINE_VALUES) + """
SELECT batch, count(*) AS n, 'Total Count of Msgs: ' || CAST(count(*) AS VARCHAR) AS label
FROM v WHERE sensor = 'HUMIDITY' AND x IS NOT NULL GROUP BY batch""",
    "batch_sum": _with(LINE_VALUES) + """
SELECT batch, sensor, round(round(sum(x), 12), 6) AS total,
       CASE sensor WHEN 'HUMIDITY' THEN 'Total Sum of Humidity: ' ELSE 'Total Sum of Light: ' END
         || printf('%.6f', sum(x)) AS label
FROM v WHERE x IS NOT NULL GROUP BY batch, sensor""",
    "batch_sort": _with(LINE_VALUES) + "SELECT batch, sensor, x FROM v WHERE x IS NOT NULL ORDER BY batch, sensor, x",
    "string_sort": _with(LINE_VALUES) + "SELECT batch, sensor, x_text FROM v ORDER BY batch, sensor, x_text",

    "word_counts": """
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY word""",
    "word_total": """
SELECT CAST(count(*) AS BIGINT) AS total
FROM (SELECT unnest(regexp_split_to_array(text, '[\\s\\x{85}\\p{Z}\\x{1c}-\\x{1f}]+')) AS w FROM documents) WHERE w <> ''""",
    "strip_whitespace": """
SELECT doc_id, length(regexp_replace(text, '[\\s\\x{85}\\p{Z}\\x{1c}-\\x{1f}]+', '', 'g')) AS n FROM documents""",
})

ORACLE["residual_breaches"] = _with(MSG + """,
r1 AS (
  SELECT ord, guid, batch, hour(ts) AS h, 'TEMPERATURE' AS sensor, temperature AS x FROM m
  UNION ALL SELECT ord, guid, batch, hour(ts), 'PRESSURE', 25.0 + k / 20.0 FROM m
  UNION ALL SELECT ord, guid, batch, hour(ts), 'HUMIDITY', k FROM m
  UNION ALL SELECT ord, guid, batch, hour(ts), 'LIGHT', 255.0 - temperature FROM m),
r0 AS (SELECT * FROM r1 WHERE x IS NOT NULL AND NOT isnan(x)),
r AS (
  SELECT ord, guid, batch, sensor,
         round(round(x - avg(x) OVER (PARTITION BY sensor, h), 12), 6) AS x FROM r0)""", THRESHOLDS) + """
SELECT ord, sensor, batch, x, round(round(lo, 10), 4) AS lo, round(round(hi, 10), 4) AS hi, code FROM coded"""


DEVICE_THRESHOLDS = THRESHOLDS.replace("PARTITION BY p.sensor", "PARTITION BY p.guid, p.sensor") \
    .replace("SELECT sensor, arg_min(x, ord) AS k FROM r GROUP BY sensor",
             "SELECT guid, sensor, arg_min(x, ord) AS k FROM r GROUP BY guid, sensor") \
    .replace("SELECT r.sensor, r.batch, count(*)", "SELECT r.guid, r.sensor, r.batch, count(*)") \
    .replace("FROM r JOIN kk ON r.sensor = kk.sensor GROUP BY r.sensor, r.batch",
             "FROM r JOIN kk ON r.guid = kk.guid AND r.sensor = kk.sensor GROUP BY r.guid, r.sensor, r.batch") \
    .replace("SELECT p.sensor, p.batch, kk.k,", "SELECT p.guid, p.sensor, p.batch, kk.k,") \
    .replace("FROM p JOIN kk ON p.sensor = kk.sensor", "FROM p JOIN kk ON p.guid = kk.guid AND p.sensor = kk.sensor") \
    .replace("SELECT sensor, batch, cnt, k + sa / cnt AS mean,", "SELECT guid, sensor, batch, cnt, k + sa / cnt AS mean,") \
    .replace("SELECT sensor, batch, cnt, mean, sqrt(", "SELECT guid, sensor, batch, cnt, mean, sqrt(") \
    .replace("FROM r JOIN th ON r.sensor = th.sensor AND r.batch = th.batch",
             "FROM r JOIN th ON r.guid = th.guid AND r.sensor = th.sensor AND r.batch = th.batch")

ORACLE.update({
    "device_breaches": _with(LONG_READINGS, DEVICE_THRESHOLDS) + """
SELECT ord, guid, sensor, batch, x, round(round(lo, 10), 4) AS lo, round(round(hi, 10), 4) AS hi, code FROM coded""",
    "sql_sort": "SELECT rank() OVER (ORDER BY value DESC) AS place, value AS temperature FROM events",
    "sql_search": "SELECT value AS temperature FROM events WHERE value = 100.0",
    "sql_filter": "SELECT value AS temperature FROM events WHERE value > 85",
    "sql_readings": _with(MSG) + """
SELECT guid, CAST(NULL AS VARCHAR) AS reply_url, temperature, 25.0 + k / 20.0 AS pressure, k AS humidity,
       255.0 - temperature AS ambient_light FROM m""",
    "sql_distinct_float": "SELECT DISTINCT CAST(value AS FLOAT) AS temperature FROM events",
})


DEVICE_STATES = STATES.replace("PARTITION BY sensor ORDER BY batch, ord", "PARTITION BY guid, sensor ORDER BY batch, ord")
DEVICE_TYPES = ALARM_TYPES \
    .replace("SELECT sensor, batch, arg_max(state, ord) AS s FROM states GROUP BY sensor, batch",
             "SELECT guid, sensor, batch, arg_max(state, ord) AS s FROM states GROUP BY guid, sensor, batch") \
    .replace("SELECT batch,\n         max(CASE", "SELECT guid, batch,\n         max(CASE") \
    .replace("FROM ends GROUP BY batch", "FROM ends GROUP BY guid, batch") \
    .replace("SELECT batch, CASE WHEN abs(t) = 1", "SELECT guid, batch, CASE WHEN abs(t) = 1")

ORACLE["device_alarm_commands"] = _with(WIDE_READINGS, DEVICE_THRESHOLDS, DEVICE_STATES, DEVICE_TYPES) + """
, e AS (SELECT guid, batch, alarm_type, alarm_type <> '' AS on_,
              coalesce(lag(alarm_type <> '') OVER (PARTITION BY guid ORDER BY batch), false) AS prev FROM types)
SELECT guid, batch, CASE WHEN on_ THEN 'ON' ELSE 'OFF' END AS command, CASE WHEN on_ THEN '1' ELSE '0' END AS code,
       alarm_type AS warning, CASE WHEN on_ THEN 1 ELSE 0 END AS alarm
FROM e WHERE on_ <> prev"""


# ---- streams: the events landed in three slices of ten days, one micro-batch each ----------------

SLICE = """coalesce(greatest(0, least({last}, CAST(floor(
    date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / {days}.0) AS BIGINT))), 0)"""


def _sliced(text: str, slices: int = 3) -> str:
    return text.replace("date_trunc('hour', ts)", SLICE.format(last=slices - 1, days=30 // slices))


ORACLE["stream_events"] = _sliced(ORACLE["breach_events"]).replace(
    "SELECT sensor, batch, ord, guid, x, round", "SELECT batch AS batch_id, sensor, ord, guid, x, round")
ORACLE["stream_commands"] = _sliced(ORACLE["device_alarm_commands"]).replace(
    "SELECT guid, batch, CASE WHEN on_ THEN 'ON'", "SELECT guid, batch AS batch_id, CASE WHEN on_ THEN 'ON'")
ORACLE["stream_statistics"] = _sliced(_with(WIDE_READINGS, THRESHOLDS)) + """
SELECT batch AS batch_id, sensor, cnt, round(round(mean, 10), 4) AS mean, round(round(std, 10), 4) AS std FROM th"""
ORACLE["stream_line_sums"] = _sliced(ORACLE["batch_sum"]).replace("SELECT batch, sensor", "SELECT batch AS batch_id, sensor")
ORACLE["stream_word_counts"] = """
SELECT CAST(((coalesce(doc_id, 0) % 3) + 3) % 3 AS BIGINT) AS batch_id, word, count(*) AS n
FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) GROUP BY 1, 2"""
ORACLE["read_documents"] = _with(MSG) + PROJECTION.replace("SELECT ord, guid", "SELECT CAST(NULL AS VARCHAR) AS reason, guid")
ORACLE["read_text"] = ORACLE["word_total"]
ORACLE["stream_reassemble"] = _with(MSG) + """
SELECT ord, guid, CAST(NULL AS VARCHAR) AS reply_url, temperature, 25.0 + k / 20.0 AS pressure, k AS humidity,
       255.0 - temperature AS ambient_light FROM m"""
ORACLE["stream_headers"] = _sliced("""
WITH s AS (SELECT date_trunc('hour', ts) AS slice FROM events)
SELECT b AS batch_id, CAST((SELECT 8 * count(*) FROM s WHERE CASE slice WHEN 0 THEN 0 ELSE slice + 1 END = b)
                           AS BIGINT) AS records
FROM (SELECT unnest([CAST(0 AS BIGINT), 1, 2, 3]) AS b)""")
# The machine of every device, batch by batch; an answer comes before the batch after its command's.
ORACLE["stream_acks"] = _sliced("WITH RECURSIVE" + ",".join(
    [WIDE_READINGS, DEVICE_THRESHOLDS, DEVICE_STATES, DEVICE_TYPES]) + """,
devices AS (SELECT DISTINCT guid FROM types),
seq AS (
  SELECT d.guid, CAST(b AS BIGINT) AS batch, t.alarm_type FROM devices d, (SELECT unnest(range(0, 6)) AS b)
  LEFT JOIN types t ON t.guid = d.guid AND t.batch = b),
fsm(guid, batch, alarm_type, alarm, command) AS (
  SELECT guid, CAST(-1 AS BIGINT), CAST(NULL AS VARCHAR), 0, CAST(NULL AS VARCHAR) FROM devices
  UNION ALL
  SELECT guid, batch, alarm_type,
         CASE WHEN alarm_type IS NULL THEN was
              WHEN alarm_type <> '' THEN CASE was WHEN 0 THEN 3 ELSE was END
              ELSE CASE was WHEN 1 THEN 2 ELSE was END END,
         CASE WHEN alarm_type <> '' AND was IN (0, 3) THEN 'ON'
              WHEN alarm_type = '' AND was IN (1, 2) THEN 'OFF' END
  FROM (SELECT q.guid, q.batch, q.alarm_type,
               CASE WHEN f.command IS NOT NULL AND (CAST(f.guid AS BIGINT) + f.batch) % 3 <> 0
                    THEN CASE f.alarm WHEN 3 THEN 1 WHEN 2 THEN 0 ELSE f.alarm END ELSE f.alarm END AS was
        FROM fsm f JOIN seq q ON q.guid = f.guid AND q.batch = f.batch + 1))
SELECT guid, batch AS batch_id, command, CASE command WHEN 'ON' THEN '1' ELSE '0' END AS code,
       alarm_type AS warning, alarm FROM fsm WHERE command IS NOT NULL""", 6)
