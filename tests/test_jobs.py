"""Golden cases for the jobs J0-J8 on hand-written records."""

import json

import pytest

from helpers import collect, records
from logweave.functions import jsoncols as J
from logweave.plans import jobs


def test_filebeat_dlq_routes_payload_or_error(spark):
    inner = '{"log_type":"currency_a","currency_type":1,"server_no":3,"date_time":"2024-01-01T00:00:00.1+09:00","uuid":"u1"}'
    good = json.dumps({"message": inner, "host": {"name": "h"}})
    rows = [("k1", good),
            ("k2", '{"message": "not json"}'),
            ("k3", '{"other": 1}'),
            ("k4", '[{"message": "{}"}]'),
            ("k5", None),                                   # tombstone (R6)
            ("k6", json.dumps({"message": "[1,2]"})),       # array payload is valid
            ("k7", json.dumps({"message": '"just text"'}))]  # scalar payload is not
    out = jobs.filebeat_dlq(records(spark, rows), detected_at="record")
    got = {r.key: (r.topic, r.value) for r in out.collect()}
    assert got["k1"] == ("s3-archive", inner)
    assert got["k6"] == ("s3-archive", "[1,2]")
    for k in ("k2", "k3", "k4", "k5", "k7"):
        topic, value = got[k]
        assert topic == "dead-letter"
        e = json.loads(value)
        assert list(e) == ["detected_at", "deserial_error", "data"]
        assert e["deserial_error"] == J.FILEBEAT_ERROR
        assert e["detected_at"] == "2024-01-01T09:00:07.179575+09:00"
    assert json.loads(got["k5"][1])["data"] is None
    assert json.loads(got["k2"][1])["data"] == '{"message": "not json"}'


def test_detected_at_processing_time_has_offset(spark):
    out = jobs.filebeat_dlq(records(spark, [("k", "bad")]))
    e = json.loads(out.first().value)
    assert e["detected_at"].endswith("+09:00")


def test_two_level_dlq(spark):
    rows = [("a", '{"message": "{\\"x\\":1}"}'),
            ("b", '{"message": "nope"}'),
            ("c", "garbage"),
            ("d", '{"no_message": 1}'),
            ("e", '[1]')]                                   # R8: array, no message
    out = jobs.two_level_dlq(records(spark, rows), detected_at="record")
    got = {r.key: (r.topic, r.value) for r in out.collect()}
    assert got["a"] == ("s3-archive", '{"x":1}')
    assert got["b"] == ("dead-letter", "nope")
    assert json.loads(got["c"][1])["deserial_error"] == J.INVALID_JSON
    assert json.loads(got["d"][1])["deserial_error"] == J.TRANSFORM_ERROR
    assert json.loads(got["e"][1])["deserial_error"] == J.TRANSFORM_ERROR


def test_log_split_branches_and_fanout(spark):
    data = json.dumps({"uid": "u7", "arguments": {"message": {"Body": "hi"}}})
    rows = [("1", json.dumps({"action": "login", "time": "t", "data": data})),
            ("2", json.dumps({"action": "chat.sendmessage", "time": "t2", "data": data})),
            ("3", json.dumps({"action": "chat.join", "time": "t", "data": data})),
            ("4", json.dumps({"action": None, "time": "t", "data": data})),  # R13: null -> "null" -> s3
            ("5", json.dumps({"time": "t", "data": data})),                   # missing -> dropped
            ("6", json.dumps({"action": "chat.sendmessage", "time": "t", "data": "{}"})),  # R1
            ("7", "not json")]
    out = jobs.log_split(records(spark, rows, topic="chat-actions"))
    got = collect(out, "topic", "key", "value")
    topics = sorted(((t, k) for t, k, _ in got), key=repr)
    assert topics == sorted([("s3-archive", "1"), ("s3-archive", "4"),
                             ("chat-flat", "u7"), ("chat-copy", "2"),
                             ("chat-flat", None), ("chat-copy", "6")], key=repr)
    flat = [v for t, k, v in got if t == "chat-flat" and k == "u7"][0]
    assert flat == '{"datetime":"t2","message":"hi","user":"u7"}'
    failed = [v for t, k, v in got if t == "chat-flat" and k is None][0]
    assert json.loads(failed)["data"] == "{}"          # original value kept


def test_chat_extract_struct_key(spark):
    data = json.dumps({"uid": "u1", "arguments": {"message": {"Body": "yo"}}})
    rows = [("x", json.dumps({"table": "chat_message", "time": "t", "data": data})),
            ("y", json.dumps({"table": "other", "time": "t", "data": data}))]
    out = jobs.chat_extract(records(spark, rows, topic="chat-tables")).collect()
    assert len(out) == 1
    assert out[0].key == '{"uid":"u1"}'
    assert out[0].value == '{"uid":"u1","datetime":"t","message":"yo"}'


def test_chat_rekey_pipe_fields(spark):
    full = "chatflow|1|2|3|4|5|6|7|user9|end"
    rows = [("chat-raw-0", None, json.dumps({"message": full})),
            ("chat-raw-0", None, json.dumps({"message": "chatlogflow|1|2|3|4|5|6|7||"})),  # R12
            ("chat-raw-1", None, json.dumps({"message": "login|1|2|3|4|5|6|7|u|x"})),
            ("other", None, json.dumps({"message": full}))]
    out = collect(jobs.chat_rekey(records(spark, rows)), "topic", "key", "value")
    assert out == sorted([("chat-keyed", "user9", full),
                          ("chat-keyed", None, json.dumps({"message": "chatlogflow|1|2|3|4|5|6|7||"}))], key=repr)


def test_daily_feed_topics_and_dead_letter(spark):
    good = {"name": "LogType1", "SvrId": 5, "dtEventTime": "2024-03-05 10:11:12", "logUUID": 77}
    rows = [("a", json.dumps(good)),
            ("b", json.dumps({**good, "name": "LOGTYPE2"})),
            ("c", json.dumps({**good, "dtEventTime": "2024/03/05"})),   # R3
            ("d", json.dumps({k: v for k, v in good.items() if k != "SvrId"})),  # R2
            ("e", json.dumps({**good, "name": "other"}))]               # filtered
    out = {r.value if r.topic == "dead-letter" else r.key: r.topic
           for r in jobs.daily_feed(records(spark, rows, topic="game-log"), detected_at="record").collect()}
    assert out["logtype1_77"] == "my_log_logtype1_20240305"
    assert out["logtype2_77"] == "my_log_logtype2_20240305"
    assert sum(1 for t in out.values() if t == "dead-letter") == 2
    rec = [r for r in jobs.daily_feed(records(spark, rows[:1], topic="game-log")).collect()][0]
    env = json.loads(rec.value)
    assert env["schema"]["fields"][1]["name"] == "org.apache.kafka.connect.data.Timestamp"
    assert env["payload"] == {"svrid": 5, "dteventtime": "2024-03-05 10:11:12", "loguuid": 77,
                              "content": json.dumps(good)}


def test_daily_feed_on_error_policies(spark):
    bad = json.dumps({"name": "logtype1", "SvrId": 1, "dtEventTime": "bad", "logUUID": 1})
    df = records(spark, [("a", bad)], topic="game-log")
    assert jobs.daily_feed(df, on_error="drop").count() == 0
    with pytest.raises(Exception):
        jobs.daily_feed(df, on_error="fail").collect()


def test_db_feed(spark):
    def biz(**kw):
        base = {"log_type": "Currency_A", "currency_type": 1, "server_no": 9,
                "date_time": "2026-01-13T02:29:56.70212899+00:00", "uuid": "x1"}
        base.update(kw)
        return json.dumps({"message": json.dumps(base)})
    rows = [("1", biz()), ("2", biz(currency_type="1", uuid="x2")), ("3", biz(currency_type=2, uuid="x3")),
            ("4", biz(log_type="LAYBY_BUY", uuid="x4")), ("5", biz(date_time="2026-01-13T02:29:56.7+0000", uuid="x5")),
            ("6", biz(log_type="other", uuid="x6")), ("7", "broken")]
    out = {r.key: (r.topic, r.value) for r in jobs.db_feed(records(spark, rows), detected_at="record").collect()}
    assert set(out) == {"currency_a#x1", "currency_a#x2", "layby_buy#x4", "5"}
    assert out["currency_a#x1"][0] == "tb_log_currency_a"
    p = json.loads(out["currency_a#x1"][1])["payload"]
    assert p["date_time"] == "2026-01-13 02:29:56.702128" and p["server_no"] == 9
    assert out["5"][0] == "dead-letter"


def test_monthly_split(spark):
    rows = [("jdbc.mum2.log_abc", "1", '{"time": 1727352009}'),
            ("jdbc.mum.filtered_log_x", "2", '{"time": 1727708400}'),
            ("jdbc.mum2.audit", "3", '{"time": 1727352009}'),          # R4 no log_
            ("jdbc.mum2.log_abc", "4", '{"other": 1}'),                # R4 no time
            ("jdbc.mum2.log_abc", "5", '{"time": "soon"}'),            # R5
            ("jdbc.mum2.log_abc", "6", 'oops')]                         # invalid: dropped
    df = records(spark, rows)
    out = {r.key: r.topic for r in jobs.monthly_split(df, topic_prefix="filtered_").collect()}
    assert out == {"1": "jdbc.mum2.filtered_log_abc_2024_09", "2": "jdbc.mum.filtered_filtered_log_x_2024_10",
                   "3": "dead-letter", "4": "dead-letter", "5": "dead-letter"}
    parity = {r.key: r.topic for r in jobs.monthly_split(df, coerce_zero=True).collect()}
    assert parity["5"] == "jdbc.mum2.log_abc_1970_01"


def test_validate_pass(spark):
    rows = [("a", '{"x":1}'), ("b", "[1]"), ("c", '"s"'), ("d", None), ("e", "{bad")]
    out = collect(jobs.validate_pass(records(spark, rows)), "key")
    assert out == [("a",), ("b",)]


def test_duplicate_keys_last_wins(spark):
    rows = [("a", '{"message": "{\\"log_type\\":\\"x\\",\\"log_type\\":\\"exchange_buy\\",\\"server_no\\":1,'
                  '\\"date_time\\":\\"2024-01-01T00:00:00Z\\",\\"uuid\\":\\"u\\"}"}')]
    out = jobs.db_feed(records(spark, rows)).collect()
    assert [r.topic for r in out] == ["tb_log_exchange_buy"]


@pytest.mark.parametrize("job", ["filebeat_dlq", "two_level_dlq", "validate_pass", "db_feed"])
def test_conservation_on_derived_records(spark, sf_dir, job):
    """rows in (matching topics) = routed + filtered + dead-lettered."""
    from logweave.sources.derived import filebeat_records
    from pyspark.sql import functions as F
    recs = filebeat_records(spark, sf_dir).where(F.col("topic").startswith("test-"))
    n_in = recs.count()
    out = getattr(jobs, job)(recs, detected_at="record") if job != "validate_pass" else jobs.validate_pass(recs)
    n_dead = out.where(F.col("topic") == "dead-letter").count()
    n_out = out.count()
    if job in ("filebeat_dlq", "two_level_dlq"):
        assert n_out == n_in                    # every record goes somewhere, exactly once
    elif job == "validate_pass":
        valid = recs.where(J.is_valid_json("value")).count()
        assert n_out == valid and n_dead == 0
    else:
        ok, _ = J.unwrap("value")
        assert n_out <= recs.where(ok).count()


def test_r7_record_with_its_own_error_field_is_not_an_error(spark):
    payload = '{"deserial_error":"mine","log_type":"exchange_buy","server_no":1,"date_time":"2024-01-01T00:00:00Z","uuid":"u"}'
    rows = [("a", json.dumps({"message": payload})), ("b", '{"deserial_error": null}')]
    out4 = {r.key: r.topic for r in jobs.filebeat_dlq(records(spark, rows)).collect()}
    assert out4 == {"a": "s3-archive", "b": "dead-letter"}      # b: no message
    assert [r.topic for r in jobs.db_feed(records(spark, rows[:1])).collect()] == ["tb_log_exchange_buy"]
    assert collect(jobs.validate_pass(records(spark, rows[1:])), "key") == [("b",)]


def test_r9_trailing_text_after_the_value(spark):
    rows = [("a", '{"x":1} trailing'), ("b", '{"message":"{\\"y\\":2} tail"}')]
    assert collect(jobs.validate_pass(records(spark, rows[:1])), "value") == [('{"x":1} trailing',)]
    out = jobs.filebeat_dlq(records(spark, rows[1:])).first()
    assert (out.topic, out.value) == ("s3-archive", '{"y":2} tail')


def test_r14_object_read_as_text_is_empty(spark):
    data = json.dumps({"uid": "u", "arguments": {"message": {"Body": "b"}}})
    rows = [("1", json.dumps({"action": {"nested": True}, "time": "t", "data": data}))]
    out = collect(jobs.log_split(records(spark, rows, topic="chat-actions")), "topic", "key")
    assert out == [("s3-archive", "1")]                       # "" does not start with "chat."


def test_r17_struct_key_failure_gives_null_key(spark):
    rows = [("x", json.dumps({"table": "chat_message", "time": "t", "data": "not json"}))]
    r = jobs.chat_extract(records(spark, rows, topic="chat-tables")).first()
    assert r.key is None and json.loads(r.value)["data"] == "not json"
