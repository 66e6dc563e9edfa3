"""Records that are too large, not UTF-8, out of range or repeated in an hour; metadata through the sinks."""

import base64
import json

import pytest
from pyspark.sql import functions as F

from logweave import cli
from logweave.functions import jsoncols as J
from logweave.functions import textcols as X
from logweave.functions import timecols as T
from logweave.operators.grouped import latest_by_key
from logweave.operators.route import legal_topic
from logweave.plans import jobs
from logweave.session import merged_conf
from logweave.sources.records import as_records, read_topics
from logweave.streaming.sinks import write_routed


def records(spark, rows, topic="test-a"):
    schema = "topic string, key string, value string, partition int, offset long, timestamp timestamp"
    return spark.createDataFrame([(topic, "k", v, 0, i, None) for i, v in enumerate(rows)], schema)


def column(spark, expr, rows, kind="string"):
    return [r[0] for r in spark.createDataFrame([(r,) for r in rows], f"t {kind}").select(expr).collect()]


BIG = [24]


@pytest.mark.parametrize("mb", BIG)
def test_large_records_route_like_small_ones(spark, mb):
    pad = "concat('{0}', repeat('x', cast(id as int) + %d), '{1}')" % (mb * 1_000_000)  # not a constant of the plan

    def big(head, tail, topic):
        v = pad.format(head, tail)
        return spark.sql(f"SELECT '{topic}' topic, 'k' key, {v} value, 0 partition, 0L offset, timestamp'2024-01-01' timestamp FROM range(1)")

    def topics(df):
        return [(r.topic, r.n > mb * 1_000_000) for r in df.select("topic", F.length("value").alias("n")).collect()]

    at = dict(detected_at="record")
    assert topics(jobs.validate_pass(big('{"a":"', '"}', "test-a"))) == [("validated", True)]
    assert topics(jobs.validate_pass(big('["', '"]', "test-a"))) == [("validated", True)]
    assert topics(jobs.monthly_split(big('{"time":1727352009,"a":"', '"}', "jdbc.log_x"), **at)) == [("jdbc.log_x_2024_09", True)]
    assert topics(jobs.daily_feed(big('{"name":"LogType1","SvrId":1,"dtEventTime":"2024-05-06 07:08:09","logUUID":5,"a":"', '"}', "game-log"), **at)) \
        == [("my_log_logtype1_20240506", True)]
    assert topics(jobs.log_split(big('{"action":"login","a":"', '"}', "chat-actions"))) == [("s3-archive", True)]
    assert topics(jobs.chat_rekey(big('{"message":"chatflow|1|2|3|4|5|6|7|u9|', '"}', "chat-raw-1"))) == [("chat-keyed", True)]
    assert topics(jobs.filebeat_dlq(big('{"message":"{\\\\"a\\\\":\\\\"', '\\\\"}"}', "test-a"), **at)) == [("s3-archive", True)]
    assert topics(jobs.two_level_dlq(big('{"message":"{\\\\"a\\\\":\\\\"', '\\\\"}"}', "test-a"), **at)) == [("s3-archive", True)]
    assert topics(jobs.chat_extract(big('{"table":"chat_message","time":"1","a":"', '"}', "chat-tables"))) == [("chat-extracted", True)]


def test_what_cannot_be_held_is_dead_lettered_whole(spark):
    df = spark.sql("SELECT 'test-a' topic, 'k' key, concat('{\"a\":\"', repeat('x', cast(id as int) + 110000000), '\"}') value, "
                   "0 partition, 0L offset, timestamp'2024-01-01' timestamp FROM range(1)")
    out = jobs.validate_pass(df, detected_at="record").select(
        "topic", F.length("value") > 110000000, F.instr("value", J.TOO_LARGE) > 0).collect()
    assert [tuple(r) for r in out] == [("dead-letter", True, True)]


def test_the_second_reader_keeps_the_rules(spark):
    texts = ['{"a":1} x', "{'a':1}", '{"a":NaN}', "[1,2]", '"s"', '{"a":', "null", "", "{}", "[]", '{"a":{"b":[1,null]},"c":1.50}']
    first = column(spark, F.try_parse_json("t").cast("string"), texts)
    second = column(spark, J._parse_large(F.col("t")).cast("string"), texts)
    scalar = {'"s"', "null"}
    assert [x for t, x in zip(texts, first) if t not in scalar] == [x for t, x in zip(texts, second) if t not in scalar]


@pytest.mark.parametrize("policy, want", [("dead_letter", ["dead-letter"] * 4 + ["jdbc.log_x_2024_09"] * 3), ("drop", ["jdbc.log_x_2024_09"] * 3)])
def test_no_time_stops_the_monthly_split(spark, policy, want):
    times = [1727352009000, 1727352009000000, 1727352009000000000, "unknown", 1727352009, "1727352009.5", "1.727352009e9"]
    df = records(spark, [json.dumps({"time": t}) for t in times], "jdbc.log_x")
    assert sorted(r.topic for r in jobs.monthly_split(df, on_error=policy).collect()) == sorted(want)
    if policy == "drop":
        with pytest.raises(Exception, match=J.TOPIC_ERROR):
            jobs.monthly_split(df, on_error="fail").collect()


def test_illegal_topics_are_errors(spark):
    assert column(spark, legal_topic("t"), ["a.B_9-x", "a b", "", "+1", "x" * 249, "x" * 250, "a\n", ".", None]) == \
        [True, False, False, False, True, False, False, False, False]
    base = {"SvrId": 1, "dtEventTime": "2024-01-01 00:00:00", "logUUID": 3}
    df = records(spark, [json.dumps({"name": n, **base}) for n in ("game_login", "game_logout", "bad name")], "game-log")
    out = jobs.daily_feed(df, names=["game_login", "game_logout", "bad name"]).collect()
    assert sorted(r.topic for r in out) == ["dead-letter", "my_log_game_login_20240101", "my_log_game_logout_20240101"]


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Seoul"])
def test_results_do_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        stamps = column(spark, T.iso_offset_datetime(F.timestamp_seconds("t"), "UTC"), [1730611800, 1730615400], "long")
        assert stamps == ["2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z"]  # New York's repeated hour
        assert column(spark, T.year_month("t", "America/Denver"), [1793514600, 1793512740 - 3600], "long") == ["2026_11", "2026_10"]
        assert column(spark, T.year_month("t", "America/Denver"), [1793514600], "long") == ["2026_11"]
        assert column(spark, T.year_month("t"), [10**12, 10**15, -10**15, None], "long") == [None] * 4
        full = "yyyy-MM-dd'T'HH:mm:ssX"
        assert column(spark, T.reformat_datetime("t", full, "HH:mm"), ["2024-11-03T23:30:00+09", "2024-11-03T01:30:00Z", "x"]) == ["23:30", "01:30", None]
        assert column(spark, T.reformat_datetime("t", full[:-1], "HH:mm"), ["2024-11-03T10:00:00", "2024-03-10T02:30:00"]) == ["10:00", "02:30"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_offsets_are_bounded_and_ends_are_ends(spark):
    stem = "2026-01-13T02:29:56.7"
    ends = ["+99:99", "+19:00", "+18:01", "Z\n", "+18:00", "-17:59", "Z"]
    assert column(spark, T.mysql_datetime6("t"), [stem + e for e in ends]) == [None] * 4 + ["2026-01-13 02:29:56.700000"] * 3
    stem = "2026-01-13T02:29:56.7000000"
    assert column(spark, T.mysql_datetime6_compact("t"), [stem + e for e in ("+9999", "+1900", "+0900\n", "+1800")]) == \
        [None] * 3 + ["2026-01-13 02:29:56.700000"]
    assert column(spark, T.date_suffix("t"), ["2024-01-01 00:00:00\n", "2024-01-01 00:00:00"]) == [None, "_20240101"]
    assert column(spark, X.split_fields("t"), ["a|b||\n", "a|b||", "||"]) == [["a", "b", "", "\n"], ["a", "b"], []]


def test_numbers_out_of_range_and_odd_names(spark):
    text = json.dumps({"a": 3000000000, "$x": 1, "it's": 2, 'q"q': 3, "c": "zz", "d": "1.7e9", "e": None, "f": True, "g": "3000000000"})
    v = J.parse("t")
    cols = [J.int_of(v, "a"), J.long_of(v, "a"), J.int_of(v, "$x"), J.int_of(v, "it's"), J.int_of(v, 'q"q'), J.long_of(v, "c", None),
            J.long_of(v, "d", None), J.long_of(v, "e", None), J.int_of(v, "f"), J.int_of(v, "c"), J.int_of(v, "g"), J.int_of(v, "zz")]
    got = spark.createDataFrame([(text,)], "t string").select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()
    assert list(got) == [None, 3000000000, 1, 2, 3, None, 1700000000, None, 1, 0, 0, None]
    payload = json.dumps({"log_type": "exchange_buy", "server_no": 3000000000, "date_time": "2024-01-01T00:00:00Z", "uuid": "u"})
    out = jobs.db_feed(records(spark, [json.dumps({"message": payload})])).collect()
    assert [r.topic for r in out] == ["dead-letter"]


@pytest.fixture()
def bytes_table(spark, scratch):
    rows = [("test-a", b"k", b'{"message":"{}"}', 0, 0), ("test-a", b"\xff", b'\xff\xfe{"a":1}', 0, 1), ("test-a", None, None, 0, 2)]
    df = spark.createDataFrame([(t, k and bytearray(k), v and bytearray(v), p, o) for t, k, v, p, o in rows],
                               "topic string, key binary, value binary, partition int, offset long")
    df.withColumn("timestamp", F.timestamp_seconds(F.lit(1727352009) + F.col("offset"))).write.partitionBy("topic").parquet(f"{scratch}/in")
    return f"{scratch}/in"


def test_bytes_that_are_not_text_are_kept(spark, bytes_table):
    df = read_topics(spark, bytes_table, binary=True)
    data = base64.b64encode(b'\xff\xfe{"a":1}').decode()
    for job, others in ((jobs.filebeat_dlq, 2), (jobs.two_level_dlq, 2), (jobs.validate_pass, 1), (jobs.db_feed, 0)):
        out = job(df, detected_at="record").collect()
        bad = [json.loads(r.value) for r in out if r.topic == "dead-letter" and J.NOT_UTF8 in r.value]
        assert [b["data"] for b in bad] == [data] and bad[0]["detected_at"].startswith("2024-09-26T21:00:10")
        assert len(out) == others + 1


def test_metadata_survives_the_sink_and_jobs_chain(spark, bytes_table, scratch):
    first = jobs.filebeat_dlq(read_topics(spark, bytes_table, binary=True), sink="jdbc.log_y", detected_at="record", metadata=True)
    assert set(first.columns) == {"topic", "key", "value", "partition", "offset", "timestamp", "source_topic"}
    write_routed(first, f"{scratch}/mid", rebalance=True)
    back = read_topics(spark, f"{scratch}/mid")
    assert sorted((r.topic, r.offset, r.partition) for r in back.collect()) == [("dead-letter", 1, 0), ("dead-letter", 2, 0), ("jdbc.log_y", 0, 0)]
    assert back.where("timestamp is null").count() == 0
    again = [json.loads(r.value) for r in jobs.monthly_split(back, detected_at="record", metadata=True).collect()]
    assert again[0]["detected_at"].startswith("2024-09-26T21:00:09")


def test_latest_by_key_is_per_topic_and_by_time(spark):
    rows = [("a", "k", "old", 1, 9, 10), ("a", "k", "new", 0, 2, 20), ("b", "k", "other", 0, 1, 5), ("b", "d", None, 0, 3, 9), ("b", "d", "x", 0, 2, 8)]
    df = spark.createDataFrame(rows, "topic string, key string, value string, partition int, offset long, s long")
    df = as_records(df.withColumn("timestamp", F.timestamp_seconds("s")))
    assert sorted(tuple(r) for r in latest_by_key(df).collect()) == [("a", "k", 2, "new"), ("b", "k", 1, "other")]


def test_documents_change_under_masking(spark, sf_dir):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    masked = docs.select("text", X.mask_pii("text", X.DOCUMENT_PII_RULES).alias("m"))
    assert masked.where("text <> m").count() > 5


def test_command_line_types_options_and_session_defaults():
    assert cli.typed("daily_feed", {"names": "logtype1,logtype2", "on_error": "drop"}) == {"names": ["logtype1", "logtype2"], "on_error": "drop"}
    assert cli.typed("chat_rekey", {"key_index": "8", "tables": "chatflow"}) == {"key_index": 8, "tables": ["chatflow"]}
    assert cli.typed("monthly_split", {"coerce_zero": "true"}) == {"coerce_zero": True}
    with pytest.raises(SystemExit):
        cli.main(["daily_feed", "--source", "/x", "--sink", "/y", "--stream", "--starting-offsets", "latest"])
    got = merged_conf({"spark.executor.extraJavaOptions": "-XX:-A", "spark.ui.enabled": "false", "x": "1"},
                      {"spark.executor.extraJavaOptions": "-Dtrust=1", "spark.ui.enabled": "true"})
    assert got == {"spark.executor.extraJavaOptions": "-Dtrust=1 -XX:-A", "x": "1"}
