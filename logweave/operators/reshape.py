"""Record reshaping: flatten nested chat logs, re-key, build DB envelopes.

Each builder takes the parsed record (a VARIANT column) and returns plain
columns — an ``ok`` flag plus the new key/value/topic pieces — so a job
can put them in one projection and route on ``ok``.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.functions import textcols as X
from logweave.functions import timecols as T
from logweave.functions.common import to_col


def connect_struct_schema(fields: list[tuple]) -> str:
    """Compact Kafka Connect JSON schema of a flat struct.

    ``fields`` items are ``(name, type)`` or ``(name, type, logical_name)``.
    """
    out = []
    for f in fields:
        d = {"field": f[0], "type": f[1]}
        if len(f) > 2:
            d["name"] = f[2]
        out.append(d)
    return json.dumps({"type": "struct", "fields": out}, separators=(",", ":"), ensure_ascii=False)


# The two envelope schemas (field, Connect type[, logical name]).
DAILY_SCHEMA = connect_struct_schema([
    ("svrid", "int32"),
    ("dteventtime", "string", "org.apache.kafka.connect.data.Timestamp"),
    ("loguuid", "int64"),
    ("content", "string"),
])
DB_SCHEMA = connect_struct_schema([
    ("server_no", "int32"),
    ("date_time", "string"),
    ("uuid", "string"),
    ("content", "string"),
])


def envelope(schema_json: str, payload: Column) -> Column:
    """``{"schema": <literal>, "payload": {...}}`` as compact JSON text.

    The schema is a constant, so it is spliced in as text (constant-folded
    once per query) rather than rebuilt per record.
    """
    return F.concat(F.lit('{"schema":' + schema_json + ',"payload":'), F.to_json(payload), F.lit("}"))


@dataclass
class Reshaped:
    ok: Column
    key: Column
    value: Column
    topic: Column | None = None


def status_of(ok: Column) -> Column:
    """``ok``, or ``map_error`` where a reshape failed."""
    return F.when(ok, F.lit("ok")).otherwise(F.lit("map_error"))


def flatten_chat(var, value) -> Reshaped:
    """Action log -> ``{"datetime","message","user"}`` keyed by the user id.

    ``data`` holds JSON *text* that is parsed a second time; the body is
    read at ``arguments.message.Body``. Output key order is the order the
    reference's hash map yields (datetime, message, user).
    """
    var = to_col(var)
    time = J.text_of(var, "time")
    data = J.parse(J.text_of(var, "data"))
    uid = J.text_of(data, "uid")
    body = J.text_of(data, "$.arguments.message.Body")
    ok = time.isNotNull() & uid.isNotNull() & body.isNotNull()
    flat = F.to_json(F.struct(time.alias("datetime"), body.alias("message"), uid.alias("user")))
    return Reshaped(ok, F.when(ok, uid), F.when(ok, flat).otherwise(J.trimmed(value)))


def flatten_chat_struct_key(var, value) -> Reshaped:
    """Table log -> key ``{"uid"}``, value ``{"uid","datetime","message"}``."""
    var = to_col(var)
    time = J.text_of(var, "time")
    data = J.parse(J.text_of(var, "data"))
    uid = J.text_of(data, "uid")
    body = J.text_of(data, "$.arguments.message.Body")
    ok = time.isNotNull() & uid.isNotNull() & body.isNotNull()
    key = F.to_json(F.struct(uid.alias("uid")))
    flat = F.to_json(F.struct(uid.alias("uid"), time.alias("datetime"), body.alias("message")))
    return Reshaped(ok, F.when(ok, key), F.when(ok, flat).otherwise(J.trimmed(value)))


def _stage(df: DataFrame, cols: dict) -> DataFrame:
    """One projection adding ``cols``; later stages read them as columns, so
    an expression used several times downstream is evaluated once."""
    return df.select("*", *[c.alias(n) for n, c in cols.items()])


def _drop_temps(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("_f_")])


def daily_envelope_parts(name, svrid, dt, uuid_long, uuid_text, content,
                         topic_prefix: str = "my_log_") -> Reshaped:
    """Envelope, key and topic of a game log from its field columns."""
    ok = name.isNotNull() & svrid.isNotNull() & dt.isNotNull() & uuid_long.isNotNull()
    payload = F.struct(svrid.alias("svrid"), dt.alias("dteventtime"), uuid_long.alias("loguuid"),
                       to_col(content).alias("content"))
    key = X.composite_key(name, uuid_text, "_")
    topic = F.concat(F.lit(topic_prefix), F.lower(name), T.date_suffix(dt))
    return Reshaped(ok, F.when(ok, key), F.when(ok, envelope(DAILY_SCHEMA, payload)), F.when(ok, topic))


def _daily_fields(var) -> dict:
    var = to_col(var)
    return {"_f_name": J.text_of(var, "name"), "_f_svrid": J.int_of(var, "SvrId"),
            "_f_dt": J.text_of(var, "dtEventTime"), "_f_uuid_long": J.long_of(var, "logUUID"),
            "_f_uuid_text": J.text_of(var, "logUUID")}


def with_daily_fields(df: DataFrame, var: str) -> DataFrame:
    """Read the field a game-log filter needs (``_f_name``), for the filter
    and the envelope to share."""
    return _stage(df, {"_f_name": _daily_fields(F.col(var))["_f_name"]})


def daily_envelope(var, value, topic_prefix: str = "my_log_") -> Reshaped:
    """Game log -> Connect envelope, key ``lower(name)_logUUID``, topic
    ``<prefix><name>_yyyyMMdd`` from ``dtEventTime`` (single projection)."""
    f = _daily_fields(var)
    return daily_envelope_parts(f["_f_name"], f["_f_svrid"], f["_f_dt"], f["_f_uuid_long"],
                                f["_f_uuid_text"], J.trimmed(value), topic_prefix)


def _gate(cols: dict, keep: str | None) -> dict:
    """Compute ``cols`` only for rows where ``keep`` holds (NULL elsewhere),
    so records a filter will drop skip the expensive parts."""
    if keep is None:
        return cols
    return {n: F.when(F.col(keep), c) for n, c in cols.items()}


def with_daily_envelope(df: DataFrame, var: str, value: str = "value",
                        topic_prefix: str = "my_log_", keep: str | None = None) -> DataFrame:
    """Staged :func:`daily_envelope`: adds ``_ok, _k, _v, _t`` (only where
    the boolean column ``keep`` holds, when given). Reuses the fields of
    :func:`with_daily_fields` when they are already there."""
    df = _stage(df, _gate({k: c for k, c in _daily_fields(F.col(var)).items() if k not in df.columns}, keep))
    r = daily_envelope_parts(*[F.col(c) for c in ("_f_name", "_f_svrid", "_f_dt", "_f_uuid_long", "_f_uuid_text")],
                             J.trimmed(value), topic_prefix)
    return _drop_temps(_stage(df, _gate({"_ok": r.ok, "_k": r.key, "_v": r.value, "_t": r.topic}, keep)))


def db_envelope_parts(server_no, dt6, uuid, log_type, content, topic_prefix: str = "tb_log_") -> Reshaped:
    """Envelope, key and topic of a business log from its field columns."""
    ok = server_no.isNotNull() & dt6.isNotNull() & uuid.isNotNull() & log_type.isNotNull()
    payload = F.struct(server_no.alias("server_no"), dt6.alias("date_time"), uuid.alias("uuid"),
                       to_col(content).alias("content"))
    key = X.composite_key(log_type, uuid, "#")
    topic = F.concat(F.lit(topic_prefix), F.lower(log_type))
    return Reshaped(ok, F.when(ok, key), F.when(ok, envelope(DB_SCHEMA, payload)), F.when(ok, topic))


def _db_fields(var) -> dict:
    var = to_col(var)
    return {"_f_server": J.int_of(var, "server_no"), "_f_dt": J.text_of(var, "date_time"),
            "_f_uuid": J.text_of(var, "uuid"), "_f_type": J.text_of(var, "log_type"),
            "_f_cur": J.int_of(var, "currency_type")}


def with_db_fields(df: DataFrame, var: str) -> DataFrame:
    """Read the fields a business-log filter needs (``_f_type, _f_cur``), for
    the filter and the envelope to share."""
    return _stage(df, {k: c for k, c in _db_fields(F.col(var)).items() if k in ("_f_type", "_f_cur")})


def db_envelope(var, value, topic_prefix: str = "tb_log_") -> Reshaped:
    """Business log -> Connect envelope with a ``datetime(6)`` field, key
    ``lower(log_type)#uuid``, topic ``<prefix><log_type>`` (single projection)."""
    f = _db_fields(var)
    return db_envelope_parts(f["_f_server"], T.mysql_datetime6(f["_f_dt"]), f["_f_uuid"], f["_f_type"],
                             J.trimmed(value), topic_prefix)


def with_db_envelope(df: DataFrame, var: str, value: str = "value",
                     topic_prefix: str = "tb_log_", keep: str | None = None) -> DataFrame:
    """Staged :func:`db_envelope`: adds ``_ok, _k, _v, _t`` (only where the
    boolean column ``keep`` holds, when given). Reuses the fields of
    :func:`with_db_fields` when they are already there."""
    df = _stage(df, _gate({k: c for k, c in _db_fields(F.col(var)).items() if k not in df.columns}, keep))
    df = _stage(df, _gate({"_f_dt6": T.mysql_datetime6("_f_dt")}, keep))
    r = db_envelope_parts(F.col("_f_server"), F.col("_f_dt6"), F.col("_f_uuid"), F.col("_f_type"),
                          J.trimmed(value), topic_prefix)
    return _drop_temps(_stage(df, _gate({"_ok": r.ok, "_k": r.key, "_v": r.value, "_t": r.topic}, keep)))


def with_flat_chat(df: DataFrame, var: str, value: str = "value", keep: str | None = None,
                   struct_key: bool = False) -> DataFrame:
    """Staged :func:`flatten_chat` (or :func:`flatten_chat_struct_key` when
    ``struct_key``): adds ``_fk, _fv`` and the status ``_fs``. The nested ``data`` text is parsed
    once, and only for rows where the boolean column ``keep`` holds."""
    v = F.col(var)
    df = _stage(df, _gate({"_f_time": J.text_of(v, "time"), "_f_data": J.parse(J.text_of(v, "data"))}, keep))
    d = F.col("_f_data")
    df = _stage(df, _gate({"_f_uid": J.text_of(d, "uid"),
                           "_f_body": J.text_of(d, "$.arguments.message.Body")}, keep))
    time, uid, body = F.col("_f_time"), F.col("_f_uid"), F.col("_f_body")
    ok = time.isNotNull() & uid.isNotNull() & body.isNotNull()
    if struct_key:
        key = F.to_json(F.struct(uid.alias("uid")))
        flat = F.to_json(F.struct(uid.alias("uid"), time.alias("datetime"), body.alias("message")))
    else:
        key = uid
        flat = F.to_json(F.struct(time.alias("datetime"), body.alias("message"), uid.alias("user")))
    out = {"_fk": F.when(ok, key), "_fv": F.when(ok, flat).otherwise(J.trimmed(value)), "_fs": status_of(ok)}
    return _drop_temps(_stage(df, _gate(out, keep)))


def pipe_rekey(var, value, index: int = 8, delimiter: str = "|") -> Reshaped:
    """Pipe log: key = field ``index`` of ``message``, value = the message;
    when the field is missing, key NULL and the original value."""
    msg = J.text_of(to_col(var), "message")
    k = X.field_at(msg, index, delimiter)
    ok = k.isNotNull()
    return Reshaped(ok, k, F.when(ok, msg).otherwise(to_col(value)))


def pipe_table_in(var, tables: list[str], delimiter: str = "|") -> Column:
    """First pipe field of ``message`` is one of ``tables`` (false if missing)."""
    msg = J.text_of(to_col(var), "message")
    return F.coalesce(X.field_at(msg, 0, delimiter).isin(*tables), F.lit(False))


def month_topic(src_topic, epoch_seconds, topic_prefix: str = "", zone: str = T.DEFAULT_ZONE,
                marker: str = "log_") -> Column:
    """``<before marker><topic_prefix><marker...>_yyyy_MM``; NULL when the
    source topic has no marker or the time is NULL."""
    before, rest = X.cut_at_first(to_col(src_topic), marker)
    ym = T.year_month(epoch_seconds, zone)
    return F.concat(before, F.lit(topic_prefix), rest, F.lit("_"), ym)
