"""Independent answers for the correctness gate, as DuckDB SQL.

Each query here computes the expected output of one registered Spark
query straight from the typed tables (``events``, ``orders``,
``conversations``, ``documents``). It rebuilds the record texts the same
way :mod:`logweave.sources.derived` does, but it never parses them: the
routing answer comes from the record's class, which is a function of its
id. (DuckDB's JSON validity rules differ from the JSON reader the jobs
follow, so classifying by parsing would test the wrong thing.)
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong one in the library shows.
DAILY_SCHEMA = ('{"type":"struct","fields":[{"field":"svrid","type":"int32"},'
                '{"field":"dteventtime","type":"string","name":"org.apache.kafka.connect.data.Timestamp"},'
                '{"field":"loguuid","type":"int64"},{"field":"content","type":"string"}]}')
DB_SCHEMA = ('{"type":"struct","fields":[{"field":"server_no","type":"int32"},{"field":"date_time","type":"string"},'
             '{"field":"uuid","type":"string"},{"field":"content","type":"string"}]}')
INVALID_JSON = "Invalid JSON format"
FILEBEAT_ERROR = "Filebeat Message Deserialization Error"
FLUENTBIT_ERROR = "Fluentbit Log Deserialization Error"
TRANSFORM_ERROR = "Record Transform Error"
TOPIC_ERROR = "Output Topic Resolution Error"
BEYOND_LIMITS = "Record Beyond Reader Limits"
MASKED = [("[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}", "**MASKED_CREDIT_CARD_NUM**"),
          ("[0-9]{6}-[0-9]{7}", "**MASKED_RRN**"),
          ("0[0-9]{1,2}-[0-9]{3,4}-[0-9]{4}", "**MASKED_PHONE_NUM**")]


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def iso_kst(ts: str) -> str:
    """ISO offset date-time of a UTC wall-clock timestamp, in Asia/Seoul
    (+09:00 all through the data's years)."""
    frac = f"rtrim(strftime({ts}, '%f'), '0')"
    return (f"(strftime({ts} + INTERVAL 9 HOUR, '%Y-%m-%dT%H:%M:%S') || "
            f"CASE WHEN {frac} = '' THEN '' ELSE '.' || {frac} END || '+09:00')")


def err_json(data: str, reason: str, ts: str) -> str:
    return (f"CAST(to_json({{'detected_at': {iso_kst(ts)}, 'deserial_error': {q(reason)}, "
            f"'data': {data}}}) AS VARCHAR)")


def half(x: str) -> str:
    return f"substr({x}, 1, length({x}) // 2)"


# --------------------------------------------------------------------------
# Records (same construction as logweave.sources.derived)
# --------------------------------------------------------------------------
BUSINESS = """
ev0 AS (
  SELECT event_id, ts, user_id, event_type, event_id % 20 AS cls, event_id % 100 = 99 AS tomb,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         CASE event_type WHEN 'click' THEN 'currency_a' WHEN 'view' THEN 'Currency_B'
              WHEN 'purchase' THEN 'exchange_buy' WHEN 'signup' THEN 'LAYBY_BUY' ELSE 'other' END AS log_type,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || CAST(event_id % 10 AS VARCHAR)
           || CASE WHEN event_id % 20 = 5 THEN '+0900' WHEN event_id % 20 = 8 THEN '+19:00' ELSE '+09:00' END AS date_time,
         user_id + CASE WHEN event_id % 20 = 7 THEN 3000000000 ELSE 0 END AS sno
  FROM events),
ev1 AS (
  SELECT *, CAST(CASE WHEN cls = 6
      THEN to_json({'log_type': log_type, 'currency_type': CAST(k % 3 AS VARCHAR), 'server_no': sno,
                    'date_time': date_time, 'uuid': CAST(event_id AS VARCHAR)})
      ELSE to_json({'log_type': log_type, 'currency_type': CAST(k % 3 AS INTEGER), 'server_no': sno,
                    'date_time': date_time, 'uuid': CAST(event_id AS VARCHAR)}) END AS VARCHAR) AS inner_text
  FROM ev0),
ev AS (
  SELECT *, CASE WHEN cls = 2 THEN CAST(k AS VARCHAR) WHEN cls = 3 THEN '[' || inner_text || ']'
                 WHEN cls = 4 THEN """ + half("inner_text") + """ ELSE inner_text END AS msg,
         NOT tomb AND cls NOT IN (0, 1, 2, 4) AS unwrap_ok,
         NOT tomb AND cls NOT IN (0, 1, 2, 3, 4) AS is_obj,
         lower(log_type) AS lt
  FROM ev1)"""

FILEBEAT = BUSINESS + """,
fb0 AS (
  SELECT *, CAST(to_json({'@timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z', 'message': msg,
                          'fields': MAP {}, 'host': {'name': 'host-' || CAST(user_id % 8 AS VARCHAR)},
                          'log': {'offset': event_id * 512, 'file': {'path': '/var/log/app/' || event_type || '.log'}},
                          'input': {'type': 'log'}, 'agent': {'name': 'filebeat', 'version': '8.12.0'}}) AS VARCHAR) AS env_full,
            CAST(to_json({'@timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z',
                          'fields': MAP {}, 'host': {'name': 'host-' || CAST(user_id % 8 AS VARCHAR)},
                          'log': {'offset': event_id * 512, 'file': {'path': '/var/log/app/' || event_type || '.log'}},
                          'input': {'type': 'log'}, 'agent': {'name': 'filebeat', 'version': '8.12.0'}}) AS VARCHAR) AS env_nomsg
  FROM ev),
fb AS (
  SELECT event_id AS "offset", ts, CAST(user_id AS VARCHAR) AS key, CAST(user_id % 8 AS INTEGER) AS "partition",
         CASE WHEN user_id % 10 = 9 THEN 'prod-' ELSE 'test-' END || 'filebeat-' || event_type AS topic,
         CASE WHEN tomb THEN NULL WHEN cls = 1 THEN env_nomsg WHEN cls = 0 THEN """ + half("env_full") + """
              ELSE env_full END AS value,
         cls, tomb, k, msg, inner_text, unwrap_ok, is_obj, lt, log_type, user_id, event_id, date_time, event_type
  FROM fb0)"""

FLUENTBIT = BUSINESS + """,
fl0 AS (
  SELECT *, {'pod_name': 'app-' || CAST(user_id % 8 AS VARCHAR), 'namespace_name': 'game',
             'container_name': event_type, 'docker_id': sha256(CAST(user_id AS VARCHAR)),
             'labels': MAP {'app': event_type}, 'annotations': MAP {}} AS kube,
            strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS d
  FROM ev),
fl1 AS (
  SELECT *, CAST(to_json({'date': d, 'log': msg, 'kubernetes': kube}) AS VARCHAR) AS env_full,
            CAST(to_json({'date': d, 'kubernetes': kube}) AS VARCHAR) AS env_nolog
  FROM fl0),
fl AS (
  SELECT event_id AS "offset", ts, CAST(user_id AS VARCHAR) AS key, 'test-fluentbit-' || event_type AS topic,
         CASE WHEN tomb THEN NULL WHEN cls = 1 THEN env_nolog WHEN cls = 0 THEN """ + half("env_full") + """
              ELSE env_full END AS value, cls, tomb, msg, unwrap_ok
  FROM fl1)"""


def conversations(head_name: str, head_expr: str, topic: str, name: str) -> str:
    return f"""
{name}0 AS (
  SELECT conv_id, turn, role, text, 1704067200 + conv_id * 3600 + turn * 60 AS secs,
         CAST(CASE WHEN conv_id % 10 = 0 THEN to_json({{'uid': CAST(conv_id AS VARCHAR)}})
              ELSE to_json({{'uid': CAST(conv_id AS VARCHAR), 'arguments': {{'message': {{'Body': text}}}}}}) END
              AS VARCHAR) AS data,
         {head_expr} AS head
  FROM conversations),
{name} AS (
  SELECT conv_id * 1000 + turn AS "offset", CAST(conv_id AS VARCHAR) AS key, {q(topic)} AS topic,
         CAST(to_json({{{q(head_name)}: head, 'time': CAST(secs AS VARCHAR), 'data': data}}) AS VARCHAR) AS value,
         conv_id % 10 <> 0 AS flat_ok, CAST(secs AS VARCHAR) AS time_text,
         CAST(conv_id AS VARCHAR) AS uid, coalesce(text, 'null') AS body, head, conv_id, turn, role
  FROM {name}0)"""


ACTIONS = conversations("action", "CASE WHEN role = 'user' THEN 'chat.sendmessage' "
                        "WHEN role = 'assistant' AND conv_id % 2 = 0 THEN 'chat.join' ELSE 'login' END",
                        "chat-actions", "act")
TABLES = conversations("table", "CASE WHEN role = 'user' THEN 'chat_message' ELSE role || '_message' END",
                       "chat-tables", "tab")

PIPE = """
pp0 AS (
  SELECT event_id, ts, user_id, event_type, event_id % 10 AS cls,
         concat_ws('|', CASE event_type WHEN 'click' THEN 'chatlogflow' WHEN 'view' THEN 'chatflow' ELSE event_type END,
                   CAST(event_id AS VARCHAR), strftime(ts, '%Y-%m-%d %H:%M:%S'),
                   'srv' || CAST(user_id % 4 AS VARCHAR), event_type) AS head,
         concat_ws('|', CAST(CAST(json_extract(props, '$.k') AS INTEGER) AS VARCHAR),
                   'ch' || CAST(event_id % 7 AS VARCHAR), 'ko') AS mid
  FROM events),
pp1 AS (
  SELECT *, CASE WHEN cls = 0 THEN head WHEN cls = 5 THEN head || '|' || mid || '||'
                 WHEN cls = 7 THEN head || '|' || mid || '||' || chr(10)
                 ELSE head || '|' || mid || '|' || CAST(user_id AS VARCHAR) || '|end' END AS msg
  FROM pp0),
pp AS (
  SELECT event_id AS "offset", 'chat-raw-' || CAST(user_id % 3 AS VARCHAR) AS topic,
         CAST(to_json({'message': msg}) AS VARCHAR) AS value, msg, cls,
         event_type IN ('click', 'view') AS is_chat,
         CASE WHEN cls IN (0, 5) THEN NULL WHEN cls = 7 THEN '' ELSE CAST(user_id AS VARCHAR) END AS field8
  FROM pp1)"""

GAME = """
gm0 AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority, o_orderkey % 50 AS cls,
         CASE o_orderstatus WHEN 'F' THEN 'LogType1' WHEN 'O' THEN 'logtype2' ELSE 'other' END AS name,
         CASE WHEN o_orderkey % 50 = 7 THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS dt
  FROM orders),
gm AS (
  SELECT o_orderkey AS "offset", 'game-log' AS topic, CAST(NULL AS VARCHAR) AS key, o_orderdate AS ts,
         CAST(CASE WHEN cls = 13
              THEN to_json({'name': name, 'dtEventTime': dt, 'logUUID': o_orderkey, 'priority': o_orderpriority})
              ELSE to_json({'name': name, 'SvrId': o_custkey, 'dtEventTime': dt, 'logUUID': o_orderkey,
                            'priority': o_orderpriority}) END AS VARCHAR) AS value,
         cls, name, lower(name) IN ('logtype1', 'logtype2') AS target, dt, o_custkey, o_orderkey, o_orderdate
  FROM gm0)"""

MONTHLY = """
mn0 AS (
  SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus, o_orderpriority, o_orderkey % 40 AS cls,
         CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS t,
         CASE WHEN o_custkey % 97 = 0 THEN 'jdbc.mum2.audit'
              ELSE CASE WHEN o_custkey % 2 = 0 THEN 'jdbc.mum2.log_' ELSE 'jdbc.mum.filtered_log_' END
                   || lower(o_orderstatus) END AS topic
  FROM orders),
mn1 AS (
  SELECT *, CAST(to_json({'time': t, 'orderkey': o_orderkey, 'status': o_orderstatus,
                          'priority': o_orderpriority}) AS VARCHAR) AS good,
            CASE cls WHEN 21 THEN to_json(t * 1000) WHEN 23 THEN to_json(t * 1000000)
                     WHEN 25 THEN to_json(CAST(t AS VARCHAR) || '.5') ELSE to_json(CAST(t AS VARCHAR) || 'e0') END AS odd
  FROM mn0),
mn AS (
  SELECT o_orderkey AS "offset", topic, CAST(o_orderkey AS VARCHAR) AS key, o_orderdate AS ts,
         CASE WHEN cls = 3 THEN """ + half("good") + """
              WHEN cls = 11 THEN CAST(to_json({'orderkey': o_orderkey, 'status': o_orderstatus,
                                               'priority': o_orderpriority}) AS VARCHAR)
              WHEN cls = 17 THEN CAST(to_json({'time': 'unknown', 'orderkey': o_orderkey, 'status': o_orderstatus,
                                               'priority': o_orderpriority}) AS VARCHAR)
              WHEN cls IN (21, 23, 25, 27) THEN CAST(to_json({'time': odd, 'orderkey': o_orderkey, 'status': o_orderstatus,
                                                              'priority': o_orderpriority}) AS VARCHAR)
              ELSE good END AS value,
         cls, t, cls <> 3 AS valid, cls NOT IN (3, 11, 17, 21, 23) AND topic LIKE '%log\\_%' ESCAPE '\\' AS routable,
         strftime(make_timestamp((t + 32400) * 1000000), '%Y_%m') AS ym
  FROM mn1)"""

DECIMALS = """
dc AS (
  SELECT o_orderkey AS "offset",
         '1' || lpad(CAST(o_orderkey AS VARCHAR), 19, '0') || '.' || lpad(CAST(o_custkey AS VARCHAR), 9, '0') AS amount
  FROM orders)"""


LEDGER = """
lg AS (
  SELECT o_orderkey AS "offset",
         '1' || lpad(CAST(o_orderkey AS VARCHAR), 39, '0') || '.' || lpad(CAST(o_custkey AS VARCHAR), 20, '0') AS amount,
         CASE o_orderkey % 4 WHEN 0 THEN CAST(o_custkey AS VARCHAR) || '.500'
                             WHEN 1 THEN CAST(o_custkey AS VARCHAR) || 'E+02' END AS rate,
         CAST(o_custkey AS VARCHAR) || '.10' AS tax
  FROM orders)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"


# Business-log derived answers over fb rows
CURRENCY = "(is_obj AND k % 3 = 1 AND lt IN ('currency_a', 'currency_b', 'currency_c', 'currency_d'))"
BUY = "(is_obj AND lt IN ('exchange_buy', 'layby_buy'))"
BUSINESS_ROW = f"(unwrap_ok AND ({CURRENCY} OR {BUY}))"
DT6 = "strftime(ts, '%Y-%m-%d %H:%M:%S.%f')"
DB_KEY = "lt || '#' || CAST(event_id AS VARCHAR)"
DB_VALUE = (f"'{{\"schema\":' || {q(DB_SCHEMA)} || ',\"payload\":' || "
            f"CAST(to_json({{'server_no': CAST(user_id AS INTEGER), 'date_time': {DT6}, "
            f"'uuid': CAST(event_id AS VARCHAR), 'content': inner_text}}) AS VARCHAR) || '}}'")
DAILY_KEY = "lower(name) || '_' || CAST(o_orderkey AS VARCHAR)"
DAILY_VALUE = (f"'{{\"schema\":' || {q(DAILY_SCHEMA)} || ',\"payload\":' || "
               f"CAST(to_json({{'svrid': CAST(o_custkey AS INTEGER), 'dteventtime': dt, "
               f"'loguuid': o_orderkey, 'content': value}}) AS VARCHAR) || '}}'")
DAILY_TOPIC = "'my_log_' || lower(name) || strftime(o_orderdate, '_%Y%m%d')"
FLAT_VALUE = "CAST(to_json({'datetime': time_text, 'message': body, 'user': uid}) AS VARCHAR)"
FLAT_SK_KEY = "CAST(to_json({'uid': uid}) AS VARCHAR)"
FLAT_SK_VALUE = "CAST(to_json({'uid': uid, 'datetime': time_text, 'message': body}) AS VARCHAR)"


TICKETS = """
tk0 AS (
  SELECT c_custkey AS k, c_name, c_mktsegment,
         '0' || lpad(CAST(c_custkey % 90 + 10 AS VARCHAR), 2, '0') || '-' || lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
           || '-' || lpad(CAST(c_custkey * 7 % 10000 AS VARCHAR), 4, '0') AS phone,
         '02-' || lpad(CAST(c_custkey * 3 % 1000 AS VARCHAR), 3, '0') || '-' || lpad(CAST(c_custkey * 9 % 10000 AS VARCHAR), 4, '0') AS phone2,
         concat_ws('-', lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0'), lpad(CAST(c_custkey * 3 % 10000 AS VARCHAR), 4, '0'),
                   lpad(CAST(c_custkey * 5 % 10000 AS VARCHAR), 4, '0'), lpad(CAST(c_custkey * 11 % 10000 AS VARCHAR), 4, '0')) AS card,
         lpad(CAST(c_custkey % 1000000 AS VARCHAR), 6, '0') || '-' || lpad(CAST(c_custkey * 13 % 10000000 AS VARCHAR), 7, '0') AS rrn
  FROM customer),
tk AS (
  SELECT k AS "offset", CASE k % 4
           WHEN 0 THEN c_name || ' called from ' || phone || ', card ' || card || ', rrn ' || rrn || '.'
           WHEN 1 THEN phone || '/' || phone2 || ' both busy'
           WHEN 2 THEN 'order 9' || card || ' for ' || c_name
           ELSE c_name || ' in segment ' || c_mktsegment END AS text
  FROM tk0)"""


def mask_sql(x: str, documents: bool = False) -> str:
    """PII masking without look-around: each digit-bounded pattern is
    replaced with its neighbours captured and put back, twice, so matches
    separated by a single character are all found."""
    rules = [("[^0-9]", core, token) for core, token in MASKED]
    if documents:
        rules.append(("[^0-9+]", r"\+[0-9]{1,3} \([0-9]{2,4}\) [0-9]{3,4}-[0-9]{4}", "**MASKED_PHONE_NUM**"))
    for before, core, token in rules:
        rx = f"(^|{before})" + core + "([^0-9]|$)"
        for _ in range(2):
            x = f"regexp_replace({x}, {q(rx)}, {q(chr(92) + '1' + token + chr(92) + '2')}, 'g')"
    return x


LIMITS = """
WITH lim0 AS (
  SELECT ts, CAST(user_id AS VARCHAR) AS key, event_id % 40 AS cls, CAST(event_id AS VARCHAR) AS i,
         '[{"id":' || event_id || '}' || repeat(',{}', 1100) AS objects FROM events),
lim AS (
  SELECT ts, key, cls,
         CASE cls WHEN 0 THEN repeat('[', 1500) || i || repeat(']', 1500)
                  WHEN 1 THEN repeat('{"a":', 2000) || i || repeat('}', 2000)
                  WHEN 2 THEN '{"n":1' || lpad(i, 1499, '0') || '}'
                  WHEN 3 THEN repeat('[', 1500) || i
                  WHEN 4 THEN '{"s":"' || repeat('[', 1500) || '"}'
                  WHEN 5 THEN objects || ']'
                  WHEN 6 THEN objects
                  WHEN 7 THEN repeat('[', 1000) || repeat(']', 1000)
                  ELSE '{"id":' || i || '}' END AS value
  FROM lim0)"""


def message_limit(limit: int) -> str:
    """Documents as records; those beyond ``limit`` bytes in a produce request in numbered pieces."""
    def varint(n: str) -> str:
        return f"CASE WHEN {n} < 64 THEN 1 WHEN {n} < 8192 THEN 2 WHEN {n} < 1048576 THEN 3 WHEN {n} < 134217728 THEN 4 ELSE 5 END"

    chunk = (limit - 1024 - 2 * (limit // 8)) // 6
    return f"""
WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS key, text AS value, strlen(CAST(doc_id AS VARCHAR)) AS nk, strlen(text) AS nv,
                  TIMESTAMP '2024-01-01' + doc_id * INTERVAL 1 SECOND AS ts FROM documents),
s AS (SELECT *, 82 + nk + {varint('nk')} + CASE WHEN value IS NULL THEN 1 ELSE nv + {varint('nv')} END + 1 AS size FROM d),
p AS (SELECT *, CAST(ceil(length(value) / {chunk}.0) AS INTEGER) AS parts FROM s WHERE size > {limit}),
c AS (SELECT *, unnest(range(parts))::INTEGER AS part FROM p)
SELECT 'documents' AS topic, key, value FROM s WHERE size <= {limit}
UNION ALL
SELECT 'dead-letter', key, CAST(to_json({{'detected_at': {iso_kst('ts')}, 'deserial_error': 'Message Too Large For Sink',
       'data': substr(value, part * {chunk} + 1, {chunk}), 'topic': 'documents', 'size': size, 'part': part, 'parts': parts,
       'sha256': sha256(value)}}) AS VARCHAR) FROM c"""
