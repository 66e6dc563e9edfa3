"""Reader limits, message sizes, statuses, metrics, sized stream files and the changelog stream."""

import glob
import hashlib
import json
import os

import pytest
from helpers import collect
from pyspark.sql import Observation
from pyspark.sql import functions as F

from logweave.functions import jsoncols as J
from logweave.operators.grouped import latest_by_key, observe_routes, route_counts
from logweave.operators.sizes import TOO_LARGE_FOR_SINK, encoded_size, within_limit
from logweave.plans import jobs
from logweave.sources import derived as D
from logweave.sources.records import read_topics, read_topics_stream
from logweave.streaming.changelog import compact_latest, read_latest, start_latest_stream
from logweave.streaming.sinks import start_routed_stream, write_batch

SCHEMA = "topic string, key string, value string, partition int, offset long, timestamp timestamp"


def records(spark, rows, topic):
    return spark.createDataFrame([(topic, "k", v, 0, i, None) for i, v in enumerate(rows)], SCHEMA)


# -- reader limits ----------------------------------------------------------------

DEEP = ["[" * n + "]" * n for n in (1001, 1500, 2000, 100_000)]
DEEP += ['{"a":' * n + "1" + "}" * n for n in (1001, 1500, 2000, 100_000)] + ['[{"a":' * 3000 + "1" + "}]" * 3000, "[" * 2_000_000]
LONG = ['{"a":' + "9" * n + "}" for n in (1001, 300_000, 10_000_000)] + ['{"a":0.%s}' % ("9" * 5000)]
#: Not beyond any limit: at it, inside a string, or malformed with many brackets or digits.
WITHIN = ["[" * 1000 + "]" * 1000, '{"a":' + "9" * 1000 + "}", '{"a":"%s"}' % ("[" * 3000), "[" + ",".join(["{}"] * 3000) + "]"]
MALFORMED = ["[" * 1500, "[" + "{}," * 3000, '{"a":"%s' % ("9" * 3000), "[" * 1500 + "x" + "]" * 1500, '{"a":']

JOBS = [(jobs.chat_rekey, "chat-raw-1"), (jobs.log_split, "chat-actions"), (jobs.chat_extract, "chat-tables"), (jobs.daily_feed, "game-log"),
        (jobs.filebeat_dlq, "test-a"), (jobs.two_level_dlq, "test-a"), (jobs.db_feed, "test-a"), (jobs.monthly_split, "jdbc.log_x"),
        (jobs.validate_pass, "test-a")]


@pytest.mark.parametrize("job,topic", JOBS, ids=[j.__name__ for j, _ in JOBS])
def test_deep_records_and_long_numbers_are_dead_letters(spark, job, topic):
    texts = DEEP + LONG
    out = job(records(spark, texts + MALFORMED, topic), detected_at="record").where(F.instr("value", J.BEYOND_LIMITS) > 0)
    got = out.select("topic", F.get_json_object("value", "$.deserial_error"), F.length("value")).collect()
    assert len(got) == len(texts)
    assert {tuple(r)[:2] for r in got} == {("dead-letter", J.BEYOND_LIMITS)} or job is jobs.two_level_dlq


def test_limits_are_exact_and_the_rest_is_as_before(spark):
    df = spark.createDataFrame([(t,) for t in WITHIN + MALFORMED], "t string").withColumn("v", J.parse("t"))
    got = df.select(F.col("v").isNotNull(), J.beyond_limits("t", "v")).collect()
    assert [tuple(r) for r in got] == [(True, False)] * len(WITHIN) + [(False, False)] * len(MALFORMED)


def test_deep_payload_of_an_envelope(spark):
    rows = [json.dumps({"message": t}) for t in (DEEP[1], LONG[0], MALFORMED[0], '{"log_type":"exchange_buy"}')]
    out = jobs.filebeat_dlq(records(spark, rows, "test-a"), detected_at="record").select("topic", "value").collect()
    reasons = [json.loads(r.value).get("deserial_error") for r in out]
    assert reasons == [J.BEYOND_LIMITS, J.BEYOND_LIMITS, J.FILEBEAT_ERROR, None]


def test_large_record_beyond_the_second_readers_limits(spark):
    tail = "concat('{\"b\":', repeat('[', 1500), repeat(']', 1500), ',\"a\":\"', repeat('x', cast(id as int) + 21000000), '\"}')"
    df = spark.sql(f"SELECT 'test-a' topic, 'k' key, {tail} value, 0 partition, 0L offset, timestamp'2024-01-01' timestamp FROM range(1)")
    out = jobs.validate_pass(df, detected_at="record").select("topic", F.length("value") > 21_000_000).collect()
    assert [tuple(r) for r in out] == [("dead-letter", True)]


# -- message sizes ------------------------------------------------------------------

def producer_size(key, value, headers=()):
    """A producer's upper bound, computed by hand."""
    def varint(n):
        n, size = n << 1, 1
        while n >= 128:
            n, size = n >> 7, size + 1
        return size

    def sized(b):
        return 1 if b is None else varint(len(b)) + len(b)
    return 61 + 21 + sized(key) + sized(value) + varint(len(headers)) + sum(sized(k) + sized(v) for k, v in headers)


def test_encoded_size_is_the_producers(spark):
    for n in (0, 1, 63, 64, 8191, 8192, 1_048_575, 1_048_576):
        for key, headers in ((None, []), ("k" * 70, [("h", b"v"), ("é", None)])):
            df = spark.createDataFrame([(key, "é" * (n // 2) + "x" * (n % 2), headers)],
                                       "key string, value string, headers array<struct<key: string, value: binary>>")
            want = producer_size(key and key.encode(), b"x" * n, [(k.encode(), v) for k, v in headers])
            assert df.select(encoded_size("key", "value", "headers")).first()[0] == want
    assert spark.range(1).select(encoded_size(F.lit(None), F.lit(None))).first()[0] == producer_size(None, None)


def test_too_large_messages_are_whole_in_pieces_that_fit(spark):
    limit = 4096
    values = ["x" * 3000, "\x01é😀\"" * 3000, None, "", "y" * (limit - 61 - 21 - 2 - 2 - 1), "y" * (limit - 61 - 21 - 2 - 2), "z" * 50_000]
    rows = [("out", "k", v, [("h", bytearray(b"1"))], "ok") for v in values]
    rows += [("out", "K" * 5000, "v", [("h", bytearray(4000))], "ok")]
    df = spark.createDataFrame(rows, "topic string, key string, value string, headers array<struct<key: string, value: binary>>, status string")
    df = df.withColumn("headers", F.when(F.length("key") == 1, F.lit(None)).otherwise(F.col("headers")))
    got = within_limit(df, F.lit("2024-01-01T00:00:00+09:00"), limit)
    assert got.columns == df.columns
    assert got.select(F.max(encoded_size("key", "value", "headers"))).first()[0] <= limit
    small = [r for r in got.collect() if r.topic == "out"]
    assert sorted(str(r.value) for r in small) == sorted(str(v) for v in values if v is None or producer_size(b"k", v.encode()) <= limit)
    pieces = {}
    for r in got.collect():
        if r.topic == "dead-letter":
            e = json.loads(r.value)
            assert (e["deserial_error"], e["topic"], r.status) == (TOO_LARGE_FOR_SINK, "out", "too_large")
            assert r.key == ("k" if e["size"] != producer_size(b"K" * 5000, b"v", [(b"h", b"0" * 4000)]) else None)
            pieces.setdefault(e["sha256"], {})[e["part"]] = e
    whole = {sha: "".join(p[i]["data"] for i in range(p[0]["parts"])) for sha, p in pieces.items()}
    assert all(hashlib.sha256(v.encode()).hexdigest() == sha for sha, v in whole.items())
    assert sorted(whole.values()) == sorted([values[1], values[5], values[6], "v"])
    with pytest.raises(ValueError):
        within_limit(df, F.lit(""), 100)


# -- statuses and metrics -----------------------------------------------------------

def test_a_failed_reshape_is_not_a_record_without_a_key(spark, scratch):
    good = {"action": "chat.sendmessage", "time": "1", "data": json.dumps({"uid": "u", "arguments": {"message": {"Body": "b"}}})}
    bad = dict(good, data="{}")
    df = spark.createDataFrame([("chat-actions", None, json.dumps(v), 0, i, None) for i, v in enumerate([good, bad, {"action": "login"}])], SCHEMA)
    out = jobs.log_split(df, with_status=True)
    assert sorted((r.topic, r.key or "", r.status) for r in out.collect()) == [
        ("chat-copy", "", "ok"), ("chat-copy", "", "ok"), ("chat-flat", "", "map_error"), ("chat-flat", "u", "ok"), ("s3-archive", "", "ok")]
    pipes = [json.dumps({"message": m}) for m in ("chatflow|1|2|3|4|5|6|7|u9|x", "chatflow|1")]
    assert sorted(r.status for r in jobs.chat_rekey(records(spark, pipes, "chat-raw-1"), with_status=True).collect()) == ["map_error", "ok"]
    games = [json.dumps(g) for g in ({"name": "LogType1"}, {"name": "LogType1", "SvrId": 1, "dtEventTime": "2024-01-01 00:00:00", "logUUID": 1})]
    assert sorted(r.status for r in jobs.daily_feed(records(spark, games, "game-log"), with_status=True).collect()) == ["map_error", "ok"]
    obs = Observation("s")
    observe_routes(out, obs, statuses=("ok", "map_error")).count()
    assert (obs.get["status:ok"], obs.get["status:map_error"], obs.get["status:other"]) == (4, 1, 0)


def test_metrics_by_topic_and_reason_equal_the_counts(spark, sf_dir, scratch):
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    D.filebeat_records(spark, sf_dir).repartition(3).write.partitionBy("topic").parquet(src)
    kinds = dict(topics=("s3-archive", "dead-letter"), reasons=(J.FILEBEAT_ERROR, J.TOO_LARGE))

    def job(df):
        return jobs.filebeat_dlq(df, detected_at="record")
    want = {r.topic: r.n for r in route_counts(job(read_topics(spark, src))).collect()}
    obs = Observation("routes")
    observe_routes(job(read_topics(spark, src)), obs, **kinds).count()
    got = obs.get
    assert {t: got[f"topic:{t}"] for t in want} == want and got["topic:other"] == 0 and got["rows"] == sum(want.values())
    assert got[f"reason:{J.FILEBEAT_ERROR}"] == got["dead_letters"] == want["dead-letter"] and got["reason:other"] == 0
    streamed = observe_routes(job(read_topics_stream(spark, src, max_files_per_trigger=4)), "routes", **kinds)
    q = start_routed_stream(streamed, sink, ckpt, "t_metrics_by_reason")
    q.awaitTermination(180)
    batches = [p["observedMetrics"]["routes"] for p in q.recentProgress if p.get("observedMetrics")]
    assert len(batches) > 1
    assert {t: sum(b[f"topic:{t}"] for b in batches) for t in want} == want
    with pytest.raises(ValueError):
        observe_routes(read_topics(spark, src), "x", statuses=("ok",))


# -- files by size in streams ---------------------------------------------------------

def test_stream_files_are_sized_and_a_replay_replaces_itself(spark, scratch):
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 4 > 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), (F.col("id") % 40).cast("string"))).alias("topic"),
        F.col("id").cast("string").alias("key"), F.sha2(F.col("id").cast("string"), 512).alias("value"),
        F.lit(0).alias("partition"), F.col("id").alias("offset"), F.timestamp_seconds("id").alias("timestamp"))
    rows.repartition(8).write.partitionBy("topic").parquet(src)
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "512k", "spark.sql.files.maxPartitionBytes": "600k", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        q = start_routed_stream(read_topics_stream(spark, src), sink, ckpt, "t_sized", rebalance=True)
        q.awaitTermination(180)
        hot = glob.glob(f"{sink}/topic=hot/batch=0/*.parquet")
        assert len(hot) > 3  # a hot topic is split by size
        files = [len(glob.glob(f"{d}/batch=0/*.parquet")) for d in glob.glob(f"{sink}/topic=t*")]
        assert len(files) == 10 and sorted(files)[8] == 1  # small ones are one file each, but where they share the hot one's hash
        want = collect(rows.select("topic", "key", "value"))
        assert collect(read_topics(spark, sink).select("topic", "key", "value")) == want
        write_batch(read_topics(spark, src).select("topic", "key", "value"), 0, sink)  # the batch once more, after a crash
        assert collect(read_topics(spark, sink).select("topic", "key", "value")) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    with pytest.raises(ValueError):
        start_routed_stream(read_topics_stream(spark, src), sink, ckpt, "t_both", rebalance=True, spread=(2, 2))


# -- the changelog table as a stream ---------------------------------------------------

def test_changelog_stream_equals_the_batch_table(spark, sf_dir, scratch):
    src, root, ckpt = (os.path.join(scratch, d) for d in ("src", "latest", "ckpt"))
    recs = D.filebeat_records(spark, sf_dir)
    assert read_latest(spark, root).collect() == [] and compact_latest(spark, root) == -1
    for k in range(3):
        recs.where(F.col("offset") % 3 == k).write.mode("append").partitionBy("topic").parquet(src)
        start_latest_stream(read_topics_stream(spark, src), root, ckpt, "t_latest").awaitTermination(180)
        assert collect(read_latest(spark, root)) == collect(latest_by_key(read_topics(spark, src)))
        if k == 1:
            assert compact_latest(spark, root) == 1
            assert collect(read_latest(spark, root)) == collect(latest_by_key(read_topics(spark, src)))
    want = collect(latest_by_key(recs))
    start_latest_stream(read_topics_stream(spark, src), root, ckpt, "t_latest").awaitTermination(180)  # a restart with nothing new
    assert collect(read_latest(spark, root)) == want
    assert compact_latest(spark, root) == 2 and compact_latest(spark, root) == 2
    assert collect(read_latest(spark, root)) == want
    dead = collect(read_latest(spark, root, drop_tombstones=False))
    assert dead == collect(latest_by_key(recs, drop_tombstones=False)) and len(dead) >= len(want)


def test_a_replayed_delta_replaces_itself(spark, scratch):
    root = os.path.join(scratch, "latest")
    from logweave.operators.grouped import latest_records
    rows = spark.createDataFrame([("t", "a", "1", 0, 1, None), ("t", "a", "2", 0, 2, None), ("t", None, "x", 0, 3, None), ("t", "b", None, 0, 4, None)], SCHEMA)
    for _ in range(2):
        latest_records(rows).write.mode("overwrite").parquet(f"{root}/batch=0")
    assert [tuple(r) for r in read_latest(spark, root).collect()] == [("t", "a", 2, "2")]
    assert sorted(r.key for r in read_latest(spark, root, drop_tombstones=False).collect()) == ["a", "b"]
