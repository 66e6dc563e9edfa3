"""The routing jobs (J0-J8): records in, routed ``(topic, key, value)`` out.

Every job is one narrow plan — scan, parse once, compute the routing
columns, emit through one generator — with no shuffle, so it runs the
same way on a batch table or a stream and scales with input partitions.

Failure policy (decided once, used everywhere):

* a record that cannot be *read* (bad JSON, bad envelope) goes to the
  dead-letter topic as an error record when the job has one, and is
  dropped by jobs that only keep valid records;
* a record that cannot be read for its *size*, its *nesting* or the length of
  a number, or because its bytes are not UTF-8, goes to the dead-letter topic
  in every job, whole, with a reason of its own;
* a record that cannot be *reshaped* keeps flowing with a NULL key and its
  original value on static sinks;
* a record whose *output topic* cannot be computed goes to the dead-letter
  topic (``on_error="dead_letter"``), stops the job (``"fail"``) or is
  dropped (``"drop"``).

``detected_at`` of error records is the processing time by default
(``"processing"``); ``"record"`` stamps the record's own timestamp instead,
which makes reruns byte-identical. ``metadata=True`` adds the source record's
partition, offset, timestamp, topic (``source_topic``) and headers to the
output, dead letters included. ``with_status=True`` adds what became of each
record: ``ok``, ``map_error`` (a reshape failed), ``topic_error`` (no broker
would take its topic) or ``unreadable``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions import timecols as T
from logweave.operators import predicates as P
from logweave.operators import reshape as R
from logweave.operators.route import Branch, Emit, check_on_error, dead_letter_topic_or_fail, legal_topic, route
from logweave.sources.records import select_topics

VAR = "_var"
DEAD_LETTER = "dead-letter"


def _staged() -> R.Reshaped:
    """The ``_ok, _k, _v, _t`` columns added by the staged envelope builders."""
    return R.Reshaped(F.col("_ok"), F.col("_k"), F.col("_v"), F.col("_t"))


def stamp(detected_at: str = "processing", zone: str = T.DEFAULT_ZONE) -> Column:
    if detected_at == "processing":
        return T.now_iso(zone)
    if detected_at == "record":
        return T.iso_offset_datetime(F.col("timestamp"), zone)
    raise ValueError("detected_at must be 'processing' or 'record'")


BAD, SRC = "_bad", "_src"
_SOURCE = ["partition", "offset", "timestamp", "topic", "headers"]


def carried(df: DataFrame) -> list[str]:
    """The helper columns that every projection of a job hands on."""
    return [c for c in (BAD, SRC) if c in df.columns]


def begun(records: DataFrame, metadata: bool) -> DataFrame:
    """Records with their source as one struct, where a job hands it on."""
    if not metadata:
        return records
    return records.withColumn(SRC, F.struct(*[c for c in _SOURCE if c in records.columns]))


def parsed(records: DataFrame, detected_at: str = "processing", zone: str = T.DEFAULT_ZONE) -> DataFrame:
    """Records plus their parsed value (one parse per record) and, for those
    that cannot be read for their size, their nesting or their bytes, the error record."""
    first = records.withColumn("_first", F.try_parse_json("value"))
    var = J.or_large("value", "_first")
    return first.withColumns({VAR: var, BAD: unreadable(records.columns, var, detected_at, zone)}).drop("_first")


def unreadable(columns: list[str], var: Column, detected_at: str, zone: str, text="value") -> Column:
    """The error record of a record too large to parse or beyond the readers'
    limits (full text), or not UTF-8 (its bytes in base64); NULL for all
    others. ``text`` is what ``var`` was parsed from."""
    when = stamp(detected_at, zone)
    bad = (F.when(J.too_large("value", var), J.error_record("value", J.TOO_LARGE, when))
           .when(J.beyond_limits(text, var), J.error_record("value", J.BEYOND_LIMITS, when)))
    if "raw" in columns:
        raw = F.col("raw")
        bad = F.when(raw.isNotNull(), J.error_record(F.base64(raw), J.NOT_UTF8, when)).otherwise(bad)
    return bad


def routed(df: DataFrame, branches: list[Branch], error_topic: str, default: Branch | None = None,
           keep=(), with_branch: bool = False, with_status: bool = False) -> DataFrame:
    """Route with the unreadable records first; with their source columns where the job hands them on."""
    if BAD in df.columns:
        branches = [Branch("unreadable", F.col(BAD).isNotNull(), [Emit(error_topic, F.col(BAD), status="unreadable")]), *branches]
    out = route(df, branches, default, keep=[*keep, *[c for c in (SRC,) if c in df.columns]], with_branch=with_branch, with_status=with_status)
    if SRC not in df.columns:
        return out
    names = [f.name for f in df.schema[SRC].dataType.fields]
    return out.select(*[c for c in out.columns if c != SRC], *[
        F.col(f"{SRC}.{c}").alias("source_topic" if c == "topic" else c) for c in names if c not in keep])


def _dynamic(df: DataFrame, r: R.Reshaped, on_error: str, error_topic: str,
             detected_at: str, zone: str, keep: Column | None = None, with_status: bool = False) -> DataFrame:
    """Emit kept records to a per-record topic; failures follow ``on_error``.

    Records outside ``keep`` are dropped silently (a filter); kept records
    whose reshape or topic failed, or whose topic no broker would accept, are
    the errors.
    """
    check_on_error(on_error)
    keep = F.lit(True) if keep is None else F.coalesce(keep, F.lit(False))
    staged = df.select("key", "value", "timestamp", *carried(df), keep.alias("_keep"), r.ok.alias("_ok"),
                       r.key.alias("_k"), r.value.alias("_v"), r.topic.alias("_t"))
    ok = F.coalesce(F.col("_ok"), F.lit(False)) & legal_topic("_t")
    dest = dead_letter_topic_or_fail(ok, F.col("_t"), J.TOPIC_ERROR, on_error, error_topic)
    staged = staged.withColumn("_dest", F.when(F.col("_keep"), dest)).withColumn("_good", F.col("_keep") & ok)
    err = J.error_record("value", J.TOPIC_ERROR, stamp(detected_at, zone))
    return routed(staged, [
        Branch("out", F.col("_good"), [Emit(F.col("_dest"), F.col("_v"), F.col("_k"))]),
        Branch("error", F.col("_dest").isNotNull(), [Emit(F.col("_dest"), err, status=F.when(F.col("_ok"), F.lit("topic_error")).otherwise(F.lit("map_error")))]),
    ], error_topic, with_status=with_status)


# J0 -------------------------------------------------------------------------
def chat_rekey(records: DataFrame, pattern: str = "chat-raw-.*", sink: str = "chat-keyed",
               tables: list[str] = P.CHAT_TABLES, key_index: int = 8, error_topic: str = DEAD_LETTER, detected_at: str = "processing",
               zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Pipe-delimited chat logs: keep chat tables, key by the user field."""
    df = parsed(begun(select_topics(records, pattern=pattern), metadata), detected_at, zone)
    r = R.pipe_rekey(F.col(VAR), F.col("value"), key_index)
    staged = df.select("key", *carried(df), R.pipe_table_in(F.col(VAR), tables).alias("_keep"),
                       r.key.alias("_k"), r.value.alias("_v"), R.status_of(r.ok).alias("_s"))
    return routed(staged, [Branch("chat", F.col("_keep"), [Emit(sink, F.col("_v"), F.col("_k"), F.col("_s"))])], error_topic,
                  with_status=with_status)


# J1 -------------------------------------------------------------------------
def log_split(records: DataFrame, topic: str = "chat-actions", s3_topic: str = "s3-archive",
              flat_topic: str = "chat-flat", copy_topic: str = "chat-copy",
              error_topic: str = DEAD_LETTER, detected_at: str = "processing",
              zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Exclusive split: non-chat actions to the archive; chat messages both
    flattened and as-is; other chat actions dropped."""
    df = parsed(begun(select_topics(records, topic=topic), metadata), detected_at, zone)
    action = J.text_of(F.col(VAR), "action")
    df = df.select("key", *carried(df), J.trimmed("value").alias("value"), VAR, action.alias("_action"))
    df = df.select("key", *carried(df), "value", VAR,
                   F.coalesce(~F.col("_action").startswith("chat."), F.lit(False)).alias("_s3"),
                   F.coalesce(F.col("_action") == "chat.sendmessage", F.lit(False)).alias("_chat"))
    staged = R.with_flat_chat(df, VAR, "value", keep="_chat")   # nested data parsed for chat rows only
    return routed(staged, [
        Branch("s3", F.col("_s3"), [Emit(s3_topic)]),
        Branch("chat", F.col("_chat"), [Emit(flat_topic, F.col("_fv"), F.col("_fk"), F.col("_fs")), Emit(copy_topic)]),
    ], error_topic, with_status=with_status)


# J2 -------------------------------------------------------------------------
def chat_extract(records: DataFrame, topic: str = "chat-tables", sink: str = "chat-extracted",
                 table_name: str = "chat_message", error_topic: str = DEAD_LETTER, detected_at: str = "processing",
                 zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Keep one table's rows and flatten them with a JSON struct key."""
    df = parsed(begun(select_topics(records, topic=topic), metadata), detected_at, zone)
    df = df.withColumn("_keep", P.field_equals(F.col(VAR), "table", table_name))
    staged = R.with_flat_chat(df, VAR, "value", keep="_keep", struct_key=True)
    return routed(staged, [Branch("chat", F.col("_keep"), [Emit(sink, F.col("_fv"), F.col("_fk"), F.col("_fs"))])], error_topic,
                  with_status=with_status)


# J3 -------------------------------------------------------------------------
def daily_feed(records: DataFrame, topic: str = "game-log", names: list[str] = P.TARGET_LOG_NAMES,
               topic_prefix: str = "my_log_", on_error: str = "dead_letter",
               error_topic: str = DEAD_LETTER, detected_at: str = "processing",
               zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Target game logs -> Connect envelope on a per-name, per-day topic."""
    df = parsed(begun(select_topics(records, topic=topic), metadata), detected_at, zone)
    df = R.with_daily_fields(df, VAR)            # read once, shared by filter and envelope
    df = df.withColumn("_keep", P.in_ci(F.col("_f_name"), names))
    df = R.with_daily_envelope(df, VAR, "value", topic_prefix, keep="_keep")
    return _dynamic(df, _staged(), on_error, error_topic, detected_at, zone, F.col("_keep"), with_status)


def _unwrapped(records, pattern, field, metadata, detected_at, zone) -> DataFrame:
    """Envelopes unwrapped; an envelope or payload that is too large is unreadable."""
    text = F.when(F.col("_wrapped"), F.col("_inner")).otherwise(F.col("value"))
    return J.with_unwrapped(begun(select_topics(records, pattern=pattern), metadata), field,
                            more=lambda var: {BAD: unreadable(records.columns, var, detected_at, zone, text)})


# J4 -------------------------------------------------------------------------
def filebeat_dlq(records: DataFrame, pattern: str = "test-.*", sink: str = "s3-archive",
                 error_topic: str = DEAD_LETTER, field: str = "message",
                 reason: str = J.FILEBEAT_ERROR, detected_at: str = "processing",
                 zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Unwrap shipper envelopes; the payload goes on, anything unreadable
    goes to the dead-letter topic as an error record."""
    staged = _unwrapped(records, pattern, field, metadata, detected_at, zone)
    return routed(staged, [Branch("s3", F.col("_inner_ok"), [Emit(sink, F.col("_inner"))])], error_topic,
                  default=Branch("error", None, [Emit(error_topic, J.error_record(
                      "value", reason, stamp(detected_at, zone)), status="unreadable")]), with_status=with_status)


# J5 -------------------------------------------------------------------------
def two_level_dlq(records: DataFrame, pattern: str = "test-.*", sink: str = "s3-archive",
                  error_topic: str = DEAD_LETTER, field: str = "message",
                  detected_at: str = "processing", zone: str = T.DEFAULT_ZONE,
                  keep=(), with_branch: bool = False, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Validate the record, then the text of its ``message`` field.

    Invalid record -> error record; no readable ``message`` -> error record;
    message not an object/array -> the raw message text to the dead-letter
    topic; else the message text to the sink.
    """
    df = parsed(begun(select_topics(records, pattern=pattern), metadata), detected_at, zone)
    when = stamp(detected_at, zone)
    valid = J.is_container("value", F.col(VAR))
    msg = J.text_of(F.col(VAR), field)
    staged = df.select(*keep, "key", "value", "timestamp", *carried(df), valid.alias("_valid"), msg.alias("_msg"))
    staged = staged.withColumn("_msg_ok", J.is_valid_json(F.col("_msg")))
    return routed(staged, [
        Branch("invalid", ~F.col("_valid"), [Emit(error_topic, J.error_record("value", J.INVALID_JSON, when), status="unreadable")]),
        Branch("no_message", F.col("_msg").isNull(), [Emit(error_topic, J.error_record("value", J.TRANSFORM_ERROR, when), status="map_error")]),
        Branch("s3", F.col("_msg_ok"), [Emit(sink, F.col("_msg"))]),
    ], error_topic, default=Branch("error", None, [Emit(error_topic, F.col("_msg"), status="unreadable")]), keep=keep,
                  with_branch=with_branch, with_status=with_status)


# J6 -------------------------------------------------------------------------
def db_feed(records: DataFrame, pattern: str = "test-.*", topic_prefix: str = "tb_log_",
            field: str = "message", on_error: str = "dead_letter", error_topic: str = DEAD_LETTER,
            detected_at: str = "processing", zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Valid envelopes -> business logs (currency or buy) -> Connect
    envelope on ``tb_log_<log_type>``."""
    df = _unwrapped(records, pattern, field, metadata, detected_at, zone)
    df = R.with_db_fields(df, "_ivar")          # read once, shared by filter and envelope
    df = df.withColumn("_keep", F.col("_inner_ok") & P.business_rule(F.col("_f_cur"), F.col("_f_type")))
    df = R.with_db_envelope(df, "_ivar", "_inner", topic_prefix, keep="_keep")
    df = df.withColumn("value", F.col("_inner"))
    return _dynamic(df, _staged(), on_error, error_topic, detected_at, zone, F.col("_keep"), with_status)


# J7 -------------------------------------------------------------------------
def monthly_split(records: DataFrame, pattern: str = r"jdbc\..*", topic_prefix: str = "",
                  zone: str = T.DEFAULT_ZONE, coerce_zero: bool = False,
                  on_error: str = "dead_letter", error_topic: str = DEAD_LETTER,
                  detected_at: str = "processing", metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Valid records -> ``<source prefix><topic_prefix>log_<x>_yyyy_MM``.

    Numeric text is read as a number (``"1.7e9"``). A ``time`` that is no
    number is a failure unless ``coerce_zero`` (then it is read as 0, i.e.
    1970_01, the loose-reader behaviour); so is one outside the years 1 to
    9999 (microseconds or milliseconds by mistake).
    """
    df = parsed(begun(select_topics(records, pattern=pattern), metadata), detected_at, zone)
    valid = J.is_container("value", F.col(VAR))
    t = J.long_of(F.col(VAR), "time", 0 if coerce_zero else None)
    topic = R.month_topic(F.col("topic"), t, topic_prefix, zone)
    r = R.Reshaped(F.lit(True), F.col("key"), J.trimmed("value"), topic)
    return _dynamic(df, r, on_error, error_topic, detected_at, zone, valid, with_status)


# J8 -------------------------------------------------------------------------
def validate_pass(records: DataFrame, pattern: str = "test-.*", sink: str = "validated",
                  error_topic: str = DEAD_LETTER, detected_at: str = "processing",
                  zone: str = T.DEFAULT_ZONE, metadata: bool = False, with_status: bool = False) -> DataFrame:
    """Keep valid, non-null JSON records and pass them on unchanged."""
    df = parsed(begun(select_topics(records, pattern=pattern), metadata), detected_at, zone)
    staged = df.select("key", *carried(df), "value", J.is_container("value", VAR).alias("_valid"))
    return routed(staged, [Branch("pass", F.col("_valid") & P.not_null("value"),
                                  [Emit(sink, J.trimmed("value"))])], error_topic, with_status=with_status)
