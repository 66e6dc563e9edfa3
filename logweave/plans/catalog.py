"""Registered queries: one per operator of the inventory, plus the jobs.

Every query takes ``(spark, sf_dir)``, derives its topic records from the
given tables in Spark (:mod:`logweave.sources.derived`) and runs the
operator over all of them. ``ORACLE`` holds, for the same name, DuckDB SQL
that computes the expected rows directly from the typed tables.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions import textcols as X
from logweave.functions import timecols as T
from logweave.functions.numtext import number_text
from logweave.operators import predicates as P
from logweave.operators import reshape as R
from logweave.operators.grouped import latest_by_key, route_counts
from logweave.operators.route import Branch, Emit, filter_once, route
from logweave.operators.sizes import within_limit
from logweave.plans import jobs
from logweave.plans import oracle as O
from logweave.sources import derived as D
from logweave.sources.records import select_topics

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


REC = "record"  # deterministic detected_at for registered queries


# ---------------------------------------------------------------- helpers
def _fb_inner(spark, sf):
    """Filebeat records with the unwrap result and the parsed payload (each text parsed once)."""
    df = D.filebeat_records(spark, sf).select("offset", "key", "timestamp", "value")
    return J.with_unwrapped(df, "message").select(
        "offset", "key", "timestamp", F.col("_inner_ok").alias("ok"), F.col("_inner").alias("inner"),
        F.col("_ivar").alias("var"))


def _fb_objects(spark, sf):
    """Unwrapped payloads that are JSON objects."""
    return filter_once(_fb_inner(spark, sf), F.col("ok") & (J.first_char("inner") == "{"), ["offset", "var"])


def _msg_texts(spark, sf):
    fb = D.filebeat_records(spark, sf)
    return fb.select("offset", J.text_of(J.parse("value"), "message").alias("msg"))


def _parsed(df):
    return df.withColumn("var", J.parse("value"))


DB_OK = "cls NOT IN (5, 7, 8)"
PARSE_OK_SQL = "(NOT tomb AND cls NOT IN (0, 1, 4))"


def fb_obj(cols: str) -> str:
    return O.with_(O.FILEBEAT) + f"SELECT \"offset\", {cols} FROM fb WHERE is_obj"


# ---------------------------------------------------------------- sources
@register("source_topic", O.with_(O.FILEBEAT) +
          "SELECT topic, key, value, \"partition\", \"offset\" FROM fb WHERE topic = 'test-filebeat-click'")
def source_topic(spark, sf):
    return select_topics(D.filebeat_records(spark, sf), topic="test-filebeat-click") \
        .select("topic", "key", "value", "partition", "offset")


@register("source_topic_regex", O.with_(O.FILEBEAT) +
          "SELECT topic, key, \"offset\" FROM fb WHERE regexp_full_match(topic, 'test-filebeat-(click|view)')")
def source_topic_regex(spark, sf):
    return select_topics(D.filebeat_records(spark, sf), pattern="test-filebeat-(click|view)") \
        .select("topic", "key", "offset")


@register("fanout", O.with_(O.ACTIONS) + f"""
SELECT 'chat-flat' AS topic, CASE WHEN flat_ok THEN uid END AS key,
       CASE WHEN flat_ok THEN {O.FLAT_VALUE} ELSE value END AS value FROM act WHERE head = 'chat.sendmessage'
UNION ALL
SELECT 'chat-copy', key, value FROM act WHERE head = 'chat.sendmessage'""")
def fanout(spark, sf):
    df = _parsed(D.action_records(spark, sf))
    flat = R.flatten_chat(F.col("var"), F.col("value"))
    staged = df.select("key", "value", P.field_equals(F.col("var"), "action", "chat.sendmessage").alias("_c"),
                       flat.key.alias("_fk"), flat.value.alias("_fv"))
    return route(staged, [Branch("chat", F.col("_c"), [Emit("chat-flat", F.col("_fv"), F.col("_fk")),
                                                        Emit("chat-copy")])])


# ---------------------------------------------------------------- parse / validate
@register("json_parse_lenient", O.with_(O.FILEBEAT) + f"""
SELECT "offset", {PARSE_OK_SQL} AS parsed,
       CASE WHEN NOT {PARSE_OK_SQL} THEN NULL WHEN cls = 2 THEN 'scalar' WHEN cls = 3 THEN 'array'
            ELSE 'object' END AS json_type
FROM fb""")
def json_parse_lenient(spark, sf):
    m = _msg_texts(spark, sf)
    return m.select("offset", F.coalesce(J.parse("msg").isNotNull(), F.lit(False)).alias("parsed"),
                    J.json_kind("msg").alias("json_type"))


@register("json_parse_strict", O.with_(O.FILEBEAT) + f"""
SELECT "offset", NOT tomb AND cls <> 0 AS valid,
       CASE WHEN NOT tomb AND cls <> 0 THEN value ELSE {O.err_json('value', O.INVALID_JSON, 'ts')} END AS value
FROM fb""")
def json_parse_strict(spark, sf):
    df = _parsed(D.filebeat_records(spark, sf))
    valid = J.is_container("value", F.col("var"))
    err = J.error_record("value", J.INVALID_JSON, jobs.stamp(REC))
    return df.select("offset", valid.alias("valid"), F.when(valid, J.trimmed("value")).otherwise(err).alias("value"))


@register("unwrap_filebeat", O.with_(O.FILEBEAT) + f"""
SELECT "offset", unwrap_ok AS ok,
       CASE WHEN unwrap_ok THEN msg ELSE {O.err_json('value', O.FILEBEAT_ERROR, 'ts')} END AS value
FROM fb""")
def unwrap_filebeat(spark, sf):
    fb = D.filebeat_records(spark, sf)
    ok, inner = J.unwrap("value", "message")
    err = J.error_record("value", J.FILEBEAT_ERROR, jobs.stamp(REC))
    return fb.select("offset", ok.alias("ok"), F.when(ok, inner).otherwise(err).alias("value"))


@register("unwrap_fluentbit", O.with_(O.FLUENTBIT) + f"""
SELECT "offset", unwrap_ok AS ok,
       CASE WHEN unwrap_ok THEN msg ELSE {O.err_json('value', O.FLUENTBIT_ERROR, 'ts')} END AS value
FROM fl""")
def unwrap_fluentbit(spark, sf):
    fl = D.fluentbit_records(spark, sf)
    ok, inner = J.unwrap("value", "log")
    err = J.error_record("value", J.FLUENTBIT_ERROR, jobs.stamp(REC))
    return fl.select("offset", ok.alias("ok"), F.when(ok, inner).otherwise(err).alias("value"))


@register("is_valid_json", O.with_(O.FILEBEAT) + "SELECT \"offset\", unwrap_ok AS is_valid FROM fb")
def is_valid_json(spark, sf):
    return _msg_texts(spark, sf).select("offset", J.is_valid_json("msg").alias("is_valid"))


@register("is_parseable_json", O.with_(O.FILEBEAT) + f"SELECT \"offset\", {PARSE_OK_SQL} AS is_parseable FROM fb")
def is_parseable_json(spark, sf):
    return _msg_texts(spark, sf).select("offset", J.is_parseable_json("msg").alias("is_parseable"))


@register("error_record", O.with_(O.FILEBEAT) +
          f"SELECT \"offset\", {O.err_json('value', O.FILEBEAT_ERROR, 'ts')} AS value FROM fb WHERE NOT unwrap_ok")
def error_record(spark, sf):
    fb = D.filebeat_records(spark, sf)
    ok, _ = J.unwrap("value", "message")
    bad = filter_once(fb.select("offset", "value", "timestamp", ok.alias("ok")), ~F.col("ok"))
    return bad.select("offset", J.error_record("value", J.FILEBEAT_ERROR, jobs.stamp(REC)).alias("value"))


@register("json_decimal_exact", O.with_(O.DECIMALS) + "SELECT \"offset\", amount FROM dc")
def json_decimal_exact(spark, sf):
    df = _parsed(D.decimal_records(spark, sf))
    return df.select("offset", J.decimal_of(F.col("var"), "amount", 38, 9).cast("string").alias("amount"))


@register("json_number_text", O.with_(O.LEDGER) + "SELECT \"offset\", amount, rate, tax FROM lg")
def json_number_text(spark, sf):
    df = _parsed(D.ledger_records(spark, sf))
    return df.select("offset", *[number_text("value", "var", f).alias(n) for n, f in (
        ("amount", "amount"), ("rate", "rate"), ("tax", "$.detail.tax"))])


# ---------------------------------------------------------------- projections
@register("flatten_chat", O.with_(O.ACTIONS) + f"""
SELECT "offset", CASE WHEN flat_ok THEN uid END AS key,
       CASE WHEN flat_ok THEN {O.FLAT_VALUE} ELSE value END AS value
FROM act WHERE head = 'chat.sendmessage'""")
def flatten_chat(spark, sf):
    df = _parsed(D.action_records(spark, sf))
    df = filter_once(df, P.field_equals(F.col("var"), "action", "chat.sendmessage"))
    r = R.flatten_chat(F.col("var"), F.col("value"))
    return df.select("offset", r.key.alias("key"), r.value.alias("value"))


@register("flatten_chat_struct_key", O.with_(O.TABLES) + f"""
SELECT "offset", CASE WHEN flat_ok THEN {O.FLAT_SK_KEY} END AS key,
       CASE WHEN flat_ok THEN {O.FLAT_SK_VALUE} ELSE value END AS value
FROM tab WHERE head = 'chat_message'""")
def flatten_chat_struct_key(spark, sf):
    df = _parsed(D.table_records(spark, sf))
    df = filter_once(df, P.field_equals(F.col("var"), "table", "chat_message"))
    r = R.flatten_chat_struct_key(F.col("var"), F.col("value"))
    return df.select("offset", r.key.alias("key"), r.value.alias("value"))


@register("pipe_rekey", O.with_(O.PIPE) + """
SELECT "offset", field8 AS key, CASE WHEN field8 IS NOT NULL THEN msg ELSE value END AS value FROM pp""")
def pipe_rekey(spark, sf):
    df = _parsed(D.pipe_records(spark, sf))
    r = R.pipe_rekey(F.col("var"), F.col("value"))
    return df.select("offset", r.key.alias("key"), r.value.alias("value"))


@register("schema_envelope_daily", O.with_(O.GAME) + f"""
SELECT "offset", cls <> 13 AS ok, CASE WHEN cls <> 13 THEN {O.DAILY_KEY} END AS key,
       CASE WHEN cls <> 13 THEN {O.DAILY_VALUE} END AS value
FROM gm WHERE target""")
def schema_envelope_daily(spark, sf):
    df = _parsed(D.game_records(spark, sf))
    df = filter_once(df, P.field_in_ci(F.col("var"), "name", P.TARGET_LOG_NAMES))
    r = R.daily_envelope(F.col("var"), F.col("value"))
    return df.select("offset", r.ok.alias("ok"), r.key.alias("key"), r.value.alias("value"))


@register("schema_envelope_db", O.with_(O.FILEBEAT) + f"""
SELECT "offset", {DB_OK} AS ok, CASE WHEN {DB_OK} THEN {O.DB_KEY} END AS key,
       CASE WHEN {DB_OK} THEN {O.DB_VALUE} END AS value
FROM fb WHERE {O.BUSINESS_ROW}""")
def schema_envelope_db(spark, sf):
    df = filter_once(_fb_inner(spark, sf), F.col("ok") & P.is_business(F.col("var")))
    r = R.db_envelope(F.col("var"), F.col("inner"))
    return df.select("offset", r.ok.alias("ok"), r.key.alias("key"), r.value.alias("value"))


@register("extract_message", O.with_(O.FILEBEAT) +
          "SELECT \"offset\", key, msg AS value FROM fb WHERE NOT tomb AND cls NOT IN (0, 1)")
def extract_message(spark, sf):
    df = _parsed(D.filebeat_records(spark, sf))
    df = df.select("offset", "key", J.is_container("value", F.col("var")).alias("valid"),
                   J.text_of(F.col("var"), "message").alias("msg"))
    df = filter_once(df, F.col("valid") & F.col("msg").isNotNull())
    return df.select("offset", "key", F.col("msg").alias("value"))


@register("routing_key", O.with_(O.FILEBEAT) + f"SELECT \"offset\", {O.DB_KEY} AS key FROM fb WHERE {O.BUSINESS_ROW}")
def routing_key(spark, sf):
    df = filter_once(_fb_inner(spark, sf), F.col("ok") & P.is_business(F.col("var")))
    return df.select("offset", X.composite_key(J.text_of(F.col("var"), "log_type"),
                                               J.text_of(F.col("var"), "uuid"), "#").alias("key"))


@register("error_counts", O.with_(O.FILEBEAT) + """
SELECT CASE WHEN unwrap_ok THEN 's3-archive' ELSE 'dead-letter' END AS topic, count(*) AS n
FROM fb WHERE topic LIKE 'test-%' GROUP BY 1""")
def error_counts(spark, sf):
    return route_counts(jobs.filebeat_dlq(D.filebeat_records(spark, sf), detected_at=REC))


# ---------------------------------------------------------------- filters
def _offsets(df, cond):
    return filter_once(df, cond, ["offset"])


@register("pipe_filter", O.with_(O.PIPE) + "SELECT \"offset\" FROM pp WHERE is_chat")
def pipe_filter(spark, sf):
    df = _parsed(D.pipe_records(spark, sf))
    return _offsets(df, R.pipe_table_in(F.col("var"), P.CHAT_TABLES))


@register("filter_equals", O.with_(O.TABLES) + "SELECT \"offset\" FROM tab WHERE head = 'chat_message'")
def filter_equals(spark, sf):
    return _offsets(_parsed(D.table_records(spark, sf)), P.field_equals(F.col("var"), "table", "chat_message"))


@register("filter_valid", O.with_(O.FILEBEAT) + "SELECT \"offset\" FROM fb WHERE NOT tomb AND cls <> 0")
def filter_valid(spark, sf):
    df = _parsed(D.filebeat_records(spark, sf))
    return _offsets(df, J.is_container("value", F.col("var")))


@register("branch_s3", O.with_(O.ACTIONS) + "SELECT \"offset\" FROM act WHERE head = 'login'")
def branch_s3(spark, sf):
    return _offsets(_parsed(D.action_records(spark, sf)), P.field_not_startswith(F.col("var"), "action", "chat."))


@register("branch_chat", O.with_(O.ACTIONS) + "SELECT \"offset\" FROM act WHERE head = 'chat.sendmessage'")
def branch_chat(spark, sf):
    return _offsets(_parsed(D.action_records(spark, sf)), P.field_equals(F.col("var"), "action", "chat.sendmessage"))


@register("filter_name_ci", O.with_(O.GAME) + "SELECT \"offset\" FROM gm WHERE target")
def filter_name_ci(spark, sf):
    return _offsets(_parsed(D.game_records(spark, sf)), P.field_in_ci(F.col("var"), "name", P.TARGET_LOG_NAMES))


@register("filter_currency", O.with_(O.FILEBEAT) + f"SELECT \"offset\" FROM fb WHERE unwrap_ok AND {O.CURRENCY}")
def filter_currency(spark, sf):
    return _offsets(_fb_inner(spark, sf), F.col("ok") & P.is_currency(F.col("var")))


@register("filter_buy", O.with_(O.FILEBEAT) + f"SELECT \"offset\" FROM fb WHERE unwrap_ok AND {O.BUY}")
def filter_buy(spark, sf):
    return _offsets(_fb_inner(spark, sf), F.col("ok") & P.is_buy(F.col("var")))


@register("filter_business", O.with_(O.FILEBEAT) + f"SELECT \"offset\" FROM fb WHERE {O.BUSINESS_ROW}")
def filter_business(spark, sf):
    return _offsets(_fb_inner(spark, sf), F.col("ok") & P.is_business(F.col("var")))


@register("filter_not_null", O.with_(O.FILEBEAT) + "SELECT \"offset\" FROM fb WHERE value IS NOT NULL")
def filter_not_null(spark, sf):
    return D.filebeat_records(spark, sf).where(P.not_null("value")).select("offset")  # a stored column


# ---------------------------------------------------------------- branching
@register("branch_drop_rest", O.with_(O.ACTIONS) + """
SELECT "offset", CASE head WHEN 'login' THEN 's3' ELSE 'chat' END AS branch
FROM act WHERE head IN ('login', 'chat.sendmessage')""")
def branch_drop_rest(spark, sf):
    df = _parsed(D.action_records(spark, sf))
    return route(df, [Branch("s3", P.field_not_startswith(F.col("var"), "action", "chat."), [Emit("s3")]),
                      Branch("chat", P.field_equals(F.col("var"), "action", "chat.sendmessage"), [Emit("chat")])],
                 keep=["offset"], with_branch=True).select("offset", "branch")


@register("branch_default", O.with_(O.FILEBEAT) + """
SELECT "offset", CASE WHEN unwrap_ok THEN 's3' ELSE 'error' END AS branch FROM fb WHERE topic LIKE 'test-%'""")
def branch_default(spark, sf):
    df = select_topics(D.filebeat_records(spark, sf), pattern="test-.*")
    ok, _ = J.unwrap("value", "message")
    return route(df, [Branch("s3", ok, [Emit("s3")])], default=Branch("error", None, [Emit("error")]),
                 keep=["offset"], with_branch=True).select("offset", "branch")


@register("branch_two_level", O.with_(O.FILEBEAT) + """
SELECT "offset", CASE WHEN tomb OR cls = 0 THEN 'invalid' WHEN cls = 1 THEN 'no_message'
                      WHEN unwrap_ok THEN 's3' ELSE 'error' END AS branch
FROM fb WHERE topic LIKE 'test-%'""")
def branch_two_level(spark, sf):
    out = jobs.two_level_dlq(D.filebeat_records(spark, sf), detected_at=REC, keep=["offset"], with_branch=True)
    return out.select("offset", "branch")


@register("multi_filter", O.with_(O.FILEBEAT) + f"""
SELECT "offset", 'currency' AS branch FROM fb WHERE unwrap_ok AND {O.CURRENCY}
UNION ALL SELECT "offset", 'buy' FROM fb WHERE unwrap_ok AND {O.BUY}
UNION ALL SELECT "offset", 'even_server' FROM fb WHERE unwrap_ok AND is_obj AND cls <> 7 AND user_id % 2 = 0""")
def multi_filter(spark, sf):
    df = filter_once(_fb_inner(spark, sf), F.col("ok"))
    even = F.coalesce(J.int_of(F.col("var"), "server_no") % 2 == 0, F.lit(False))
    none = F.lit(None).cast("string")
    return route(df, [Branch("currency", P.is_currency(F.col("var")), [Emit("currency", none)]),
                      Branch("buy", P.is_buy(F.col("var")), [Emit("buy", none)]),
                      Branch("even_server", even, [Emit("even_server", none)])],
                 exclusive=False, keep=["offset"], with_branch=True).select("offset", "branch")


# ---------------------------------------------------------------- dynamic topics
@register("dynamic_topic_daily", O.with_(O.GAME) + f"""
SELECT "offset", CASE WHEN cls NOT IN (7, 13) THEN {O.DAILY_TOPIC} END AS topic FROM gm WHERE target""")
def dynamic_topic_daily(spark, sf):
    df = _parsed(D.game_records(spark, sf))
    df = filter_once(df, P.field_in_ci(F.col("var"), "name", P.TARGET_LOG_NAMES))
    return df.select("offset", R.daily_envelope(F.col("var"), F.col("value")).topic.alias("topic"))


@register("dynamic_topic_by_type", O.with_(O.FILEBEAT) + f"""
SELECT "offset", CASE WHEN {DB_OK} THEN 'tb_log_' || lt END AS topic FROM fb WHERE {O.BUSINESS_ROW}""")
def dynamic_topic_by_type(spark, sf):
    df = filter_once(_fb_inner(spark, sf), F.col("ok") & P.is_business(F.col("var")))
    return df.select("offset", R.db_envelope(F.col("var"), F.col("inner")).topic.alias("topic"))


MONTH_TOPIC_SQL = ("substr(topic, 1, strpos(topic, 'log_') - 1) || 'filtered_' || "
                   "substr(topic, strpos(topic, 'log_')) || '_' || ym")


@register("dynamic_topic_monthly", O.with_(O.MONTHLY) + f"""
SELECT "offset", CASE WHEN cls NOT IN (11, 17, 21, 23) AND strpos(topic, 'log_') > 0 THEN {MONTH_TOPIC_SQL} END AS topic
FROM mn WHERE valid""")
def dynamic_topic_monthly(spark, sf):
    df = _parsed(D.monthly_records(spark, sf))
    df = filter_once(df, J.is_container("value", F.col("var")))
    t = J.long_of(F.col("var"), "time", None)
    return df.select("offset", R.month_topic(F.col("topic"), t, "filtered_").alias("topic"))


# ---------------------------------------------------------------- time, coercion, hash
@register("mysql_datetime6", fb_obj(f"CASE WHEN cls NOT IN (5, 8) THEN {O.DT6} END AS date_time"))
def mysql_datetime6(spark, sf):
    return _fb_objects(spark, sf).select(
        "offset", T.mysql_datetime6(J.text_of(F.col("var"), "date_time")).alias("date_time"))


@register("mysql_datetime6_compact", fb_obj(f"CASE WHEN cls = 5 THEN {O.DT6} END AS date_time"))
def mysql_datetime6_compact(spark, sf):
    return _fb_objects(spark, sf).select(
        "offset", T.mysql_datetime6_compact(J.text_of(F.col("var"), "date_time")).alias("date_time"))


@register("reformat_datetime", fb_obj("CASE WHEN cls NOT IN (5, 8) THEN strftime(ts, '%Y/%m/%d %H:%M:%S') END AS date_time"))
def reformat_datetime(spark, sf):
    return _fb_objects(spark, sf).select("offset", T.reformat_datetime(
        J.text_of(F.col("var"), "date_time"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSSXXX", "yyyy/MM/dd HH:mm:ss")
        .alias("date_time"))


@register("year_month_kst", O.with_(O.MONTHLY) +
          "SELECT \"offset\", CASE WHEN cls NOT IN (11, 17, 21, 23) THEN ym END AS year_month FROM mn WHERE valid")
def year_month_kst(spark, sf):
    df = _parsed(D.monthly_records(spark, sf))
    df = filter_once(df, J.is_container("value", F.col("var")))
    return df.select("offset", T.year_month(J.long_of(F.col("var"), "time", None)).alias("year_month"))


@register("coerce_int", fb_obj("CAST(k % 3 AS INTEGER) AS currency_type"))
def coerce_int(spark, sf):
    return _fb_objects(spark, sf).select("offset", J.int_of(F.col("var"), "currency_type").alias("currency_type"))


@register("hash_key", fb_obj("sha256(CAST(event_id AS VARCHAR)) AS uuid_hash"))
def hash_key(spark, sf):
    return _fb_objects(spark, sf).select("offset", X.sha256_hex(J.text_of(F.col("var"), "uuid")).alias("uuid_hash"))


# ---------------------------------------------------------------- jobs J0-J8
@register("job_chat_rekey", O.with_(O.PIPE) + """
SELECT 'chat-keyed' AS topic, field8 AS key, CASE WHEN field8 IS NOT NULL THEN msg ELSE value END AS value
FROM pp WHERE is_chat""")
def job_chat_rekey(spark, sf):
    return jobs.chat_rekey(D.pipe_records(spark, sf))


@register("job_log_split", O.with_(O.ACTIONS) + f"""
SELECT 's3-archive' AS topic, key, value FROM act WHERE head = 'login'
UNION ALL
SELECT 'chat-flat', CASE WHEN flat_ok THEN uid END, CASE WHEN flat_ok THEN {O.FLAT_VALUE} ELSE value END
FROM act WHERE head = 'chat.sendmessage'
UNION ALL
SELECT 'chat-copy', key, value FROM act WHERE head = 'chat.sendmessage'""")
def job_log_split(spark, sf):
    return jobs.log_split(D.action_records(spark, sf))


@register("job_chat_extract", O.with_(O.TABLES) + f"""
SELECT 'chat-extracted' AS topic, CASE WHEN flat_ok THEN {O.FLAT_SK_KEY} END AS key,
       CASE WHEN flat_ok THEN {O.FLAT_SK_VALUE} ELSE value END AS value
FROM tab WHERE head = 'chat_message'""")
def job_chat_extract(spark, sf):
    return jobs.chat_extract(D.table_records(spark, sf))


@register("job_daily_feed", O.with_(O.GAME) + f"""
SELECT CASE WHEN cls NOT IN (7, 13) THEN {O.DAILY_TOPIC} ELSE 'dead-letter' END AS topic,
       CASE WHEN cls NOT IN (7, 13) THEN {O.DAILY_KEY} ELSE key END AS key,
       CASE WHEN cls NOT IN (7, 13) THEN {O.DAILY_VALUE}
            ELSE {O.err_json('value', O.TOPIC_ERROR, 'ts')} END AS value
FROM gm WHERE target""")
def job_daily_feed(spark, sf):
    return jobs.daily_feed(D.game_records(spark, sf), detected_at=REC)


@register("job_filebeat_dlq", O.with_(O.FILEBEAT) + f"""
SELECT CASE WHEN unwrap_ok THEN 's3-archive' ELSE 'dead-letter' END AS topic, key,
       CASE WHEN unwrap_ok THEN msg ELSE {O.err_json('value', O.FILEBEAT_ERROR, 'ts')} END AS value
FROM fb WHERE topic LIKE 'test-%'""")
def job_filebeat_dlq(spark, sf):
    return jobs.filebeat_dlq(D.filebeat_records(spark, sf), detected_at=REC)


@register("job_two_level_dlq", O.with_(O.FILEBEAT) + f"""
SELECT CASE WHEN unwrap_ok THEN 's3-archive' ELSE 'dead-letter' END AS topic, key,
       CASE WHEN tomb OR cls = 0 THEN {O.err_json('value', O.INVALID_JSON, 'ts')}
            WHEN cls = 1 THEN {O.err_json('value', O.TRANSFORM_ERROR, 'ts')}
            ELSE msg END AS value
FROM fb WHERE topic LIKE 'test-%'""")
def job_two_level_dlq(spark, sf):
    return jobs.two_level_dlq(D.filebeat_records(spark, sf), detected_at=REC)


@register("job_db_feed", O.with_(O.FILEBEAT) + f"""
SELECT CASE WHEN {DB_OK} THEN 'tb_log_' || lt ELSE 'dead-letter' END AS topic,
       CASE WHEN {DB_OK} THEN {O.DB_KEY} ELSE key END AS key,
       CASE WHEN {DB_OK} THEN {O.DB_VALUE} ELSE {O.err_json('inner_text', O.TOPIC_ERROR, 'ts')} END AS value
FROM fb WHERE topic LIKE 'test-%' AND {O.BUSINESS_ROW}""")
def job_db_feed(spark, sf):
    return jobs.db_feed(D.filebeat_records(spark, sf), detected_at=REC)


@register("job_monthly_split", O.with_(O.MONTHLY) + f"""
SELECT CASE WHEN routable THEN {MONTH_TOPIC_SQL} ELSE 'dead-letter' END AS topic, key,
       CASE WHEN routable THEN value ELSE {O.err_json('value', O.TOPIC_ERROR, 'ts')} END AS value
FROM mn WHERE valid""")
def job_monthly_split(spark, sf):
    return jobs.monthly_split(D.monthly_records(spark, sf), topic_prefix="filtered_", detected_at=REC)


@register("job_validate_pass", O.with_(O.FILEBEAT) +
          "SELECT 'validated' AS topic, key, value FROM fb WHERE topic LIKE 'test-%' AND NOT tomb AND cls <> 0")
def job_validate_pass(spark, sf):
    return jobs.validate_pass(D.filebeat_records(spark, sf))


# ---------------------------------------------------------------- limits and statuses
@register("reader_limits", O.LIMITS + f"""
SELECT CASE WHEN cls < 3 THEN 'dead-letter' ELSE 'validated' END AS topic, key,
       CASE WHEN cls < 3 THEN {O.err_json('value', O.BEYOND_LIMITS, 'ts')} ELSE value END AS value
FROM lim WHERE cls NOT IN (3, 6)""")
def reader_limits(spark, sf):
    """J8 over records nested too deeply, or with too long numbers, for the readers."""
    return jobs.validate_pass(D.limit_records(spark, sf), detected_at=REC)


@register("message_limit", O.message_limit(4096))
def message_limit(spark, sf):
    """Documents as messages of a sink that takes 4,096 bytes: larger ones are dead letters in pieces that fit."""
    df = D.document_records(spark, sf).select("topic", "key", "value", "timestamp")
    return within_limit(df, T.iso_offset_datetime(F.col("timestamp"), T.DEFAULT_ZONE), 4096).drop("timestamp")


@register("map_status", O.with_(O.ACTIONS) + """
SELECT topic, status, count(*) AS n, count(key) AS n_keys FROM (
  SELECT 's3-archive' AS topic, 'ok' AS status, key FROM act WHERE head NOT LIKE 'chat.%'
  UNION ALL SELECT 'chat-copy', 'ok', key FROM act WHERE head = 'chat.sendmessage'
  UNION ALL SELECT 'chat-flat', CASE WHEN flat_ok THEN 'ok' ELSE 'map_error' END, CASE WHEN flat_ok THEN uid END
            FROM act WHERE head = 'chat.sendmessage')
GROUP BY ALL""")
def map_status(spark, sf):
    """J1's records by topic and status: a failed reshape is not a record without a key."""
    out = jobs.log_split(D.action_records(spark, sf), with_status=True)
    return out.groupBy("topic", "status").agg(F.count(F.lit(1)).alias("n"), F.count("key").alias("n_keys"))


# ---------------------------------------------------------------- optional items
@register("pseudonymise_split", O.with_(O.ACTIONS) + """
SELECT 'user-ids' AS topic, sha256(uid) AS key, uid AS value FROM act WHERE head = 'chat.sendmessage' AND flat_ok
UNION ALL
SELECT 'user-content', sha256(uid), body FROM act WHERE head = 'chat.sendmessage' AND flat_ok""")
def pseudonymise_split(spark, sf):
    df = _parsed(D.action_records(spark, sf))
    data = J.parse(J.text_of(F.col("var"), "data"))
    uid = J.text_of(data, "uid")
    body = J.text_of(data, "$.arguments.message.Body")
    staged = df.select(P.field_equals(F.col("var"), "action", "chat.sendmessage").alias("_c"),
                       uid.alias("_uid"), body.alias("_body"))
    staged = staged.withColumn("_h", X.sha256_hex("_uid"))
    ok = F.col("_c") & F.col("_uid").isNotNull() & F.col("_body").isNotNull()
    return route(staged, [Branch("split", ok, [Emit("user-ids", F.col("_uid"), F.col("_h")),
                                               Emit("user-content", F.col("_body"), F.col("_h"))])])


@register("flat_map_words", """
SELECT conv_id, turn, pos, word FROM (
  SELECT conv_id, turn, unnest(range(len(ws))) AS pos, unnest(ws) AS word
  FROM (SELECT conv_id, turn, list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda w: w <> '') AS ws
        FROM conversations))""")
def flat_map_words(spark, sf):
    c = D.table(spark, sf, "conversations")
    return c.select("conv_id", "turn", F.posexplode(X.words("text")).alias("pos", "word")) \
        .select("conv_id", "turn", F.col("pos").cast("bigint").alias("pos"), "word")


@register("latest_by_key", O.with_(O.FILEBEAT) + """
SELECT topic, key, "offset", value FROM (
  SELECT topic, key, "offset", value,
         row_number() OVER (PARTITION BY topic, key ORDER BY ts DESC, "partition" DESC, "offset" DESC) AS rn
  FROM fb WHERE key IS NOT NULL)
WHERE rn = 1 AND value IS NOT NULL""")
def latest_by_key_q(spark, sf):
    return latest_by_key(D.filebeat_records(spark, sf))


@register("mask_pii", O.with_(O.TICKETS) + f"SELECT \"offset\", {O.mask_sql('text')} AS message FROM tk")
def mask_pii(spark, sf):
    df = _parsed(D.ticket_records(spark, sf))
    return df.select("offset", X.mask_pii(J.text_of(F.col("var"), "message")).alias("message"))


@register("mask_pii_documents", f"SELECT doc_id, {O.mask_sql('text', documents=True)} AS text FROM documents")
def mask_pii_documents(spark, sf):
    d = D.table(spark, sf, "documents")
    return d.select("doc_id", X.mask_pii("text", X.DOCUMENT_PII_RULES).alias("text"))
