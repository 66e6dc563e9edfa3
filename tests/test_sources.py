import pytest

from helpers import collect, records
from logweave.sources.records import kafka_source_options, select_topics
from logweave.streaming.sinks import kafka_sink_options


def test_regex_subscription_is_whole_name(spark):
    df = records(spark, [("test-a", "1", "{}"), ("xtest-a", "2", "{}"), ("test-", "3", "{}"), ("prod", "4", "{}")])
    assert collect(select_topics(df, pattern="test-.*"), "key") == [("1",), ("3",)]
    assert collect(select_topics(df, topic=["prod", "test-a"]), "key") == [("1",), ("4",)]


def test_kafka_options():
    o = kafka_source_options("b:9092", pattern="test-.*", starting_offsets="latest")
    assert o == {"kafka.bootstrap.servers": "b:9092", "startingOffsets": "latest", "subscribePattern": "test-.*"}
    with pytest.raises(ValueError):
        kafka_source_options("b", topic="t", starting_offsets="middle")
    o = kafka_source_options("b:9092", topic=["a", "b"], extra={"minPartitions": 64, "maxOffsetsPerTrigger": 10,
                                                                 "max.poll.records": 500})
    assert o["subscribe"] == "a,b" and o["minPartitions"] == "64" and o["maxOffsetsPerTrigger"] == "10"
    assert o["kafka.max.poll.records"] == "500"
    with pytest.raises(ValueError):
        kafka_source_options("b", topic="t", starting_offsets="latest", stream=False)
    s = kafka_sink_options("b:9092", compression="zstd", max_request_size=10485760, acks="all")
    assert s["kafka.compression.type"] == "zstd" and s["kafka.max.request.size"] == "10485760"
    assert s["kafka.acks"] == "all"


def test_binary_topic_table(spark, scratch):
    import datetime as dt
    import json
    from pyspark.sql import types as T
    from logweave.plans import jobs
    from logweave.sources.records import read_topics
    schema = T.StructType([T.StructField("topic", T.StringType()), T.StructField("key", T.BinaryType()),
                           T.StructField("value", T.BinaryType()), T.StructField("partition", T.IntegerType()),
                           T.StructField("offset", T.LongType()), T.StructField("timestamp", T.TimestampType())])
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    good = json.dumps({"message": json.dumps({"a": "é"})}).encode()
    rows = [("test-a", b"k1", bytearray(good), 0, 1, t0), ("test-a", b"k2", bytearray(b"\xff\xfe{"), 0, 2, t0)]
    spark.createDataFrame(rows, schema).write.partitionBy("topic").parquet(scratch + "/raw")
    recs = read_topics(spark, scratch + "/raw", binary=True)
    assert collect(recs, "key", "value") == [("k1", good.decode()), ("k2", None)]
    out = {r.key: (r.topic, r.value) for r in jobs.filebeat_dlq(recs, detected_at="record").collect()}
    assert out["k1"] == ("s3-archive", json.dumps({"a": "é"}))
    assert out["k2"][0] == "dead-letter" and json.loads(out["k2"][1])["data"] == "//57"  # its bytes, base64
