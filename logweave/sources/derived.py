"""Topic records derived in Spark from the typed test tables.

Each function reads one typed table and writes it out as the JSON log
records a real deployment receives (shipper envelopes, action logs, pipe
logs, game logs, table feeds). Every record's class (good, cut short,
missing field, ...) is a function of its id, so an independent check can
compute the expected routing straight from the typed columns without ever
parsing the JSON. All of it is one narrow projection per table: it scales
with the input and never shuffles.

Layouts (``%`` = modulo of the record id):

filebeat (from ``events``)
    envelope ``{"@timestamp","message","fields","host","log","input","agent"}``
    whose ``message`` is a business log ``{"log_type","currency_type",
    "server_no","date_time","uuid"}``. ``event_id % 100 = 99`` is a tombstone
    (NULL value); otherwise by ``event_id % 20``: 0 envelope cut short,
    1 no ``message``, 2 ``message`` a JSON number, 3 ``message`` a JSON array,
    4 ``message`` cut short, 5 ``date_time`` with a ``+0900`` offset,
    6 ``currency_type`` written as text, 7 ``server_no`` beyond 32 bits,
    8 an offset beyond 18 hours; the rest are good.
fluentbit (from ``events``)
    the same business log inside ``{"date","log","kubernetes"}``.
actions / tables (from ``conversations``)
    ``{"action"|"table","time","data"}`` where ``data`` is JSON *text*
    ``{"uid","arguments":{"message":{"Body"}}}``; ``conv_id % 10 = 0`` has no
    ``arguments``.
pipe (from ``events``)
    ``{"message":"f0|f1|...|f9"}`` with field 8 the user id;
    ``event_id % 10 = 0`` has 5 fields, ``= 5`` ends in empty fields 8-9,
    ``= 7`` in an empty field 8 and a line feed.
game (from ``orders``)
    ``{"name","SvrId","dtEventTime","logUUID","priority"}``;
    ``o_orderkey % 50``: 7 bad date, 13 no ``SvrId``.
monthly (from ``orders``)
    ``{"time","orderkey","status","priority"}`` on ``jdbc.*log_<status>``
    topics; ``o_orderkey % 40``: 3 cut short, 11 no ``time``, 17 ``time``
    not numeric, 21 in milliseconds, 23 in microseconds, 25 and 27 numeric
    text (``"1.5"``, ``"1e0"``); ``o_custkey % 97 = 0`` is on a topic without ``log_``.
decimals (from ``orders``)
    ``{"orderkey","amount"}`` with a 29-digit decimal ``amount``.
ledger (from ``orders``)
    ``amount`` of sixty digits, ``rate`` and ``detail.tax`` with ending
    zeros or exponents; ``o_orderkey % 4``: see :func:`ledger_records`.
tickets (from ``customer``)
    ``{"message"}`` texts with phone, card and resident numbers;
    ``c_custkey % 4``: 0 all three, 1 two phones one character apart,
    2 a card glued to a preceding digit, 3 none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.sources.records import as_records



def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch() -> Column:
    # a string literal: a Python datetime literal would go through the
    # session time zone before the cast
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def epoch_seconds(ntz) -> Column:
    """Wall-clock TIMESTAMP_NTZ read as UTC -> epoch seconds."""
    return F.timestamp_diff("SECOND", _epoch(), ntz)


def utc_instant(ntz) -> Column:
    """Wall-clock TIMESTAMP_NTZ read as UTC -> TIMESTAMP instant."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch(), ntz))


def _half(c: Column) -> Column:
    """First half of a text (a record cut short in transit)."""
    return c.substr(F.lit(1), F.floor(F.length(c) / 2).cast("int"))


def _json(*cols: Column) -> Column:
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


LOG_TYPE_BY_EVENT = [("click", "currency_a"), ("view", "Currency_B"),
                     ("purchase", "exchange_buy"), ("signup", "LAYBY_BUY")]


def _business_log(e: DataFrame) -> tuple[Column, Column]:
    """(business-log text, event_id % 20) for an events frame."""
    cls = (F.col("event_id") % 20).cast("int")
    lt = F.lit("other")
    for ev, t in reversed(LOG_TYPE_BY_EVENT):
        lt = F.when(F.col("event_type") == ev, F.lit(t)).otherwise(lt)
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int")
    cur = (k % 3).cast("int")
    date_time = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
                         (F.col("event_id") % 10).cast("string"),
                         F.when(cls == 5, F.lit("+0900")).when(cls == 8, F.lit("+19:00")).otherwise(F.lit("+09:00")))
    server = F.col("user_id") + F.when(cls == 7, F.lit(3_000_000_000)).otherwise(F.lit(0))
    rest = [server.alias("server_no"), date_time.alias("date_time"),
            F.col("event_id").cast("string").alias("uuid")]
    text = F.when(cls == 6, _json(lt.alias("log_type"), cur.cast("string").alias("currency_type"), *rest)) \
        .otherwise(_json(lt.alias("log_type"), cur.alias("currency_type"), *rest))
    msg = (F.when(cls == 2, k.cast("string"))
           .when(cls == 3, F.concat(F.lit("["), text, F.lit("]")))
           .when(cls == 4, _half(text))
           .otherwise(text))
    return msg, cls


def _event_records(e: DataFrame, value: Column, topic: Column) -> DataFrame:
    return as_records(e.select(
        topic.alias("topic"),
        F.col("user_id").cast("string").alias("key"),
        value.alias("value"),
        (F.col("user_id") % 8).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        utc_instant(F.col("ts")).alias("timestamp")))


def filebeat_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    msg, cls = _business_log(e)
    common = dict(
        fields=F.create_map().cast("map<string,string>").alias("fields"),
        host=F.struct(F.concat(F.lit("host-"), (F.col("user_id") % 8).cast("string")).alias("name")).alias("host"),
        log=F.struct((F.col("event_id") * 512).alias("offset"),
                     F.struct(F.concat(F.lit("/var/log/app/"), F.col("event_type"), F.lit(".log")).alias("path"))
                     .alias("file")).alias("log"),
        input=F.struct(F.lit("log").alias("type")).alias("input"),
        agent=F.struct(F.lit("filebeat").alias("name"), F.lit("8.12.0").alias("version")).alias("agent"))
    stamp = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("@timestamp")
    with_msg = _json(stamp, msg.alias("message"), *common.values())
    no_msg = _json(stamp, *common.values())
    env = F.when(cls == 1, no_msg).when(cls == 0, _half(with_msg)).otherwise(with_msg)
    value = F.when(F.col("event_id") % 100 == 99, F.lit(None).cast("string")).otherwise(env)
    topic = F.concat(F.when(F.col("user_id") % 10 == 9, F.lit("prod-")).otherwise(F.lit("test-")),
                     F.lit("filebeat-"), F.col("event_type"))
    return _event_records(e, value, topic)


def fluentbit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    msg, cls = _business_log(e)
    date = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("date")
    kube = F.struct(
        F.concat(F.lit("app-"), (F.col("user_id") % 8).cast("string")).alias("pod_name"),
        F.lit("game").alias("namespace_name"),
        F.col("event_type").alias("container_name"),
        F.sha2(F.col("user_id").cast("string"), 256).alias("docker_id"),
        F.create_map(F.lit("app"), F.col("event_type")).alias("labels"),
        F.create_map().cast("map<string,string>").alias("annotations")).alias("kubernetes")
    with_log = _json(date, msg.alias("log"), kube)
    env = F.when(cls == 1, _json(date, kube)).when(cls == 0, _half(with_log)).otherwise(with_log)
    value = F.when(F.col("event_id") % 100 == 99, F.lit(None).cast("string")).otherwise(env)
    topic = F.concat(F.lit("test-fluentbit-"), F.col("event_type"))
    return _event_records(e, value, topic)


def _conversation_records(spark, sf_dir, head: Column, head_name: str, topic: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    secs = F.lit(1704067200) + F.col("conv_id") * 3600 + F.col("turn") * 60
    uid = F.col("conv_id").cast("string").alias("uid")
    args = F.struct(F.struct(F.col("text").alias("Body")).alias("message")).alias("arguments")
    data = F.when(F.col("conv_id") % 10 == 0, _json(uid)).otherwise(_json(uid, args))
    value = _json(head.alias(head_name), secs.cast("string").alias("time"), data.alias("data"))
    return as_records(c.select(
        F.lit(topic).alias("topic"), F.col("conv_id").cast("string").alias("key"), value.alias("value"),
        (F.col("conv_id") % 8).cast("int").alias("partition"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("offset"),
        F.timestamp_seconds(secs).alias("timestamp")))


def action_records(spark: SparkSession, sf_dir: str, topic: str = "chat-actions") -> DataFrame:
    action = (F.when(F.col("role") == "user", F.lit("chat.sendmessage"))
              .when((F.col("role") == "assistant") & (F.col("conv_id") % 2 == 0), F.lit("chat.join"))
              .otherwise(F.lit("login")))
    return _conversation_records(spark, sf_dir, action, "action", topic)


def table_records(spark: SparkSession, sf_dir: str, topic: str = "chat-tables") -> DataFrame:
    tbl = F.when(F.col("role") == "user", F.lit("chat_message")).otherwise(F.concat(F.col("role"), F.lit("_message")))
    return _conversation_records(spark, sf_dir, tbl, "table", topic)


def pipe_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    f0 = (F.when(F.col("event_type") == "click", F.lit("chatlogflow"))
          .when(F.col("event_type") == "view", F.lit("chatflow"))
          .otherwise(F.col("event_type")))
    k = F.try_variant_get(F.try_parse_json("props"), "$.k", "int").cast("string")
    head = [f0, F.col("event_id").cast("string"), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
            F.concat(F.lit("srv"), (F.col("user_id") % 4).cast("string")), F.col("event_type")]
    mid = [k, F.concat(F.lit("ch"), (F.col("event_id") % 7).cast("string")), F.lit("ko")]
    full = F.concat_ws("|", *head, *mid, F.col("user_id").cast("string"), F.lit("end"))
    cls = F.col("event_id") % 10
    msg = (F.when(cls == 0, F.concat_ws("|", *head))
           .when(cls == 5, F.concat(F.concat_ws("|", *head, *mid), F.lit("||")))
           .when(cls == 7, F.concat(F.concat_ws("|", *head, *mid), F.lit("||\n")))
           .otherwise(full))
    return as_records(e.select(
        F.concat(F.lit("chat-raw-"), (F.col("user_id") % 3).cast("string")).alias("topic"),
        F.lit(None).cast("string").alias("key"), _json(msg.alias("message")).alias("value"),
        (F.col("user_id") % 8).cast("int").alias("partition"), F.col("event_id").alias("offset"),
        utc_instant(F.col("ts")).alias("timestamp")))


def game_records(spark: SparkSession, sf_dir: str, topic: str = "game-log") -> DataFrame:
    o = table(spark, sf_dir, "orders")
    name = (F.when(F.col("o_orderstatus") == "F", F.lit("LogType1"))
            .when(F.col("o_orderstatus") == "O", F.lit("logtype2")).otherwise(F.lit("other")))
    cls = F.col("o_orderkey") % 50
    dt = F.when(cls == 7, F.date_format("o_orderdate", "yyyy/MM/dd")) \
        .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    tail = [dt.alias("dtEventTime"), F.col("o_orderkey").alias("logUUID"), F.col("o_orderpriority").alias("priority")]
    value = F.when(cls == 13, _json(name.alias("name"), *tail)) \
        .otherwise(_json(name.alias("name"), F.col("o_custkey").alias("SvrId"), *tail))
    return as_records(o.select(
        F.lit(topic).alias("topic"), F.lit(None).cast("string").alias("key"), value.alias("value"),
        (F.col("o_custkey") % 8).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
        utc_instant(F.col("o_orderdate")).alias("timestamp")))


def monthly_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cls = F.col("o_orderkey") % 40
    t = epoch_seconds(F.col("o_orderdate")) + F.col("o_orderkey") % 86400
    tail = [F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"),
            F.col("o_orderpriority").alias("priority")]
    good = _json(t.alias("time"), *tail)
    value = (F.when(cls == 3, _half(good))
             .when(cls == 11, _json(*tail))
             .when(cls == 17, _json(F.lit("unknown").alias("time"), *tail))
             .when(cls == 21, _json((t * 1000).alias("time"), *tail))
             .when(cls == 23, _json((t * 1000000).alias("time"), *tail))
             .when(cls == 25, _json(F.concat(t.cast("string"), F.lit(".5")).alias("time"), *tail))
             .when(cls == 27, _json(F.concat(t.cast("string"), F.lit("e0")).alias("time"), *tail))
             .otherwise(good))
    topic = (F.when(F.col("o_custkey") % 97 == 0, F.lit("jdbc.mum2.audit"))
             .otherwise(F.concat(F.when(F.col("o_custkey") % 2 == 0, F.lit("jdbc.mum2.log_"))
                                 .otherwise(F.lit("jdbc.mum.filtered_log_")), F.lower("o_orderstatus"))))
    return as_records(o.select(
        topic.alias("topic"), F.col("o_orderkey").cast("string").alias("key"), value.alias("value"),
        (F.col("o_custkey") % 8).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
        utc_instant(F.col("o_orderdate")).alias("timestamp")))


def limit_records(spark: SparkSession, sf_dir: str, topic: str = "test-limits") -> DataFrame:
    """Records at and beyond the readers' limits (from ``events``).

    ``event_id % 40``: 0 an array 1,500 levels deep, 1 an object 2,000 levels
    deep, 2 a number of 1,500 digits, 3 1,500 open brackets that never close,
    4 a text value of 1,500 brackets, 5 an array of 1,100 objects, 6 the same
    cut short, 7 an array 1,000 levels deep; the rest are small objects.
    """
    e = table(spark, sf_dir, "events")
    i = F.col("event_id")
    cls = i % 40
    objects = F.concat(F.lit('[{"id":'), i.cast("string"), F.lit("}"), F.repeat(F.lit(",{}"), F.lit(1100)))
    value = (F.when(cls == 0, F.concat(F.repeat(F.lit("["), F.lit(1500)), i.cast("string"), F.repeat(F.lit("]"), F.lit(1500))))
             .when(cls == 1, F.concat(F.repeat(F.lit('{"a":'), F.lit(2000)), i.cast("string"), F.repeat(F.lit("}"), F.lit(2000))))
             .when(cls == 2, F.concat(F.lit('{"n":1'), F.lpad(i.cast("string"), 1499, "0"), F.lit("}")))
             .when(cls == 3, F.concat(F.repeat(F.lit("["), F.lit(1500)), i.cast("string")))
             .when(cls == 4, F.concat(F.lit('{"s":"'), F.repeat(F.lit("["), F.lit(1500)), F.lit('"}')))
             .when(cls == 5, F.concat(objects, F.lit("]")))
             .when(cls == 6, objects)
             .when(cls == 7, F.concat(F.repeat(F.lit("["), F.lit(1000)), F.repeat(F.lit("]"), F.lit(1000))))
             .otherwise(_json(i.alias("id"))))
    return as_records(e.select(
        F.lit(topic).alias("topic"), F.col("user_id").cast("string").alias("key"), value.alias("value"),
        (F.col("user_id") % 8).cast("int").alias("partition"), i.alias("offset"), utc_instant(F.col("ts")).alias("timestamp")))


def document_records(spark: SparkSession, sf_dir: str, topic: str = "documents") -> DataFrame:
    """Every document as a record: small ones and ones that no default producer takes."""
    d = table(spark, sf_dir, "documents")
    return as_records(d.select(
        F.lit(topic).alias("topic"), F.col("doc_id").cast("string").alias("key"), F.col("text").alias("value"),
        (F.col("doc_id") % 8).cast("int").alias("partition"), F.col("doc_id").alias("offset"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id")).alias("timestamp")))


def decimal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records carrying 29-digit decimals (precision must survive parsing)."""
    o = table(spark, sf_dir, "orders")
    amount = F.concat(F.lit("1"), F.lpad(F.col("o_orderkey").cast("string"), 19, "0"), F.lit("."),
                      F.lpad(F.col("o_custkey").cast("string"), 9, "0"))
    value = F.concat(F.lit('{"orderkey":'), F.col("o_orderkey").cast("string"),
                     F.lit(',"amount":'), amount, F.lit("}"))
    return as_records(o.select(
        F.lit("ledger").alias("topic"), F.col("o_orderkey").cast("string").alias("key"), value.alias("value"),
        (F.col("o_custkey") % 8).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
        utc_instant(F.col("o_orderdate")).alias("timestamp")))


def ledger_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose numbers have a form that their value does not tell: sixty digits, ending zeros, exponents.

    ``rate`` is by ``o_orderkey % 4``: 0 a decimal that ends in zeros, 1 an
    exponent, 2 a text, 3 missing. A string, an array and the object after
    ``detail`` hold members of the same names.
    """
    o = table(spark, sf_dir, "orders")
    key, cust = F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")
    amount = F.concat(F.lit("1"), F.lpad(key, 39, "0"), F.lit("."), F.lpad(cust, 20, "0"))
    cls = F.col("o_orderkey") % 4
    rate = (F.when(cls == 0, F.concat(F.lit(',"rate":'), cust, F.lit(".500")))
            .when(cls == 1, F.concat(F.lit(',"rate" : '), cust, F.lit("E+02 ")))
            .when(cls == 2, F.concat(F.lit(',"rate":"'), cust, F.lit('.500"'))).otherwise(F.lit("")))
    value = F.concat(F.lit('{"note":"\\"amount\\":0.10,{","lines":[{"amount":0.10}],"detail":{"tax":'), cust, F.lit('.10},"amount":'),
                     amount, rate, F.lit(',"other":{"tax":0.20,"rate":0.20}}'))
    return as_records(o.select(
        F.lit("ledger").alias("topic"), key.alias("key"), value.alias("value"),
        (F.col("o_custkey") % 8).cast("int").alias("partition"), F.col("o_orderkey").alias("offset"),
        utc_instant(F.col("o_orderdate")).alias("timestamp")))


def ticket_records(spark: SparkSession, sf_dir: str, topic: str = "support-tickets") -> DataFrame:
    """Support-ticket texts (from ``customer``) carrying phone, card and
    resident numbers in the formats the PII masker targets.

    ``c_custkey % 4``: 0 all three kinds in one sentence, 1 two phones one
    character apart, 2 a card glued to a preceding digit (must stay), 3 none.
    """
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")

    def pad(x, n):
        return F.lpad(x.cast("string"), n, "0")
    phone = F.concat(F.lit("0"), pad(k % 90 + 10, 2), F.lit("-"), pad(k % 10000, 4), F.lit("-"), pad(k * 7 % 10000, 4))
    phone2 = F.concat(F.lit("02-"), pad(k * 3 % 1000, 3), F.lit("-"), pad(k * 9 % 10000, 4))
    card = F.concat_ws("-", pad(k % 10000, 4), pad(k * 3 % 10000, 4), pad(k * 5 % 10000, 4), pad(k * 11 % 10000, 4))
    rrn = F.concat(pad(k % 1000000, 6), F.lit("-"), pad(k * 13 % 10000000, 7))
    cls = k % 4
    text = (F.when(cls == 0, F.concat(F.col("c_name"), F.lit(" called from "), phone, F.lit(", card "), card,
                                      F.lit(", rrn "), rrn, F.lit(".")))
            .when(cls == 1, F.concat(phone, F.lit("/"), phone2, F.lit(" both busy")))
            .when(cls == 2, F.concat(F.lit("order 9"), card, F.lit(" for "), F.col("c_name")))
            .otherwise(F.concat(F.col("c_name"), F.lit(" in segment "), F.col("c_mktsegment"))))
    return as_records(c.select(
        F.lit(topic).alias("topic"), k.cast("string").alias("key"), _json(text.alias("message")).alias("value"),
        (k % 8).cast("int").alias("partition"), k.alias("offset"),
        F.timestamp_seconds(F.lit(1704067200) + k).alias("timestamp")))
