"""Session-zone independence, file spreading, metrics, shippers, CLI."""

import json
import os

import duckdb
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

import __spark_entry__ as E
from helpers import collect, records
from logweave.functions import jsoncols as J
from logweave.operators.grouped import observe_routes
from logweave.plans import jobs
from logweave.plans.inspect import formatted_plan
from logweave.sources.derived import filebeat_records, fluentbit_records
from logweave.streaming.sinks import spread_by_topic

SF = "/root/testdata/sf0.001"
ZONE_SENSITIVE = ["job_filebeat_dlq", "job_monthly_split", "job_daily_feed", "job_db_feed",
                  "reformat_datetime", "year_month_kst", "mysql_datetime6", "dynamic_topic_daily"]


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("\x1f".join("NULL" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("zone", ["America/Los_Angeles", "Asia/Seoul"])
def test_results_do_not_depend_on_session_zone(spark, zone):
    con = duckdb.connect()
    for t in ["orders", "events", "conversations", "customer"]:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        for name in ZONE_SENSITIVE:
            df = E.queries()[name](spark, SF)
            res = con.execute(E.oracle_sql()[name])
            assert _rows(df.columns, df.collect()) == _rows([d[0] for d in res.description], res.fetchall()), name
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_spread_by_topic_salts_hot_topics(spark):
    rows = [("hot", str(i), f'{{"i":{i}}}') for i in range(400)] + [("cold", "x", "{}")]
    df = records(spark, rows).select("topic", "key", "value")
    spread = spread_by_topic(df, 16, 4)
    assert "hashpartitioning(topic" in formatted_plan(spread)
    per_part = spread.groupBy(F.spark_partition_id().alias("p")).agg(
        F.countDistinct("topic").alias("t"), F.count("*").alias("n")).collect()
    hot_parts = [r for r in per_part if r.n > 1]
    assert len(hot_parts) >= 2                     # the hot topic is not in one task
    assert spread.count() == df.count()            # nothing dropped


def test_write_routed_with_spread(spark, scratch):
    from logweave.sources.records import read_topics
    from logweave.streaming.sinks import write_routed
    rows = [("hot", str(i), f'{{"i":{i}}}') for i in range(300)] + [("cold", "x", "{}")]
    df = records(spark, rows).select("topic", "key", "value")
    out = os.path.join(scratch, "out")
    write_routed(df, out, spread=(8, 3))
    got = read_topics(spark, out)
    assert collect(got, "topic", "key", "value") == collect(df, "topic", "key", "value")
    hot_files = [f for f in os.listdir(os.path.join(out, "topic=hot")) if f.endswith(".parquet")]
    assert 1 < len(hot_files) <= 3


def test_observed_route_metrics(spark):
    recs = filebeat_records(spark, SF)
    obs = Observation("routes")
    out = jobs.filebeat_dlq(recs, detected_at="record").observe(
        obs, F.count(F.lit(1)).alias("rows"),
        F.sum(F.when(F.col("topic") == "dead-letter", 1).otherwise(0)).alias("dead_letters"))
    n = out.count()
    m = obs.get
    assert m["rows"] == n and 0 < m["dead_letters"] < n
    assert observe_routes(out, "named").count() == n


def test_fluentbit_unwrap_job(spark):
    recs = fluentbit_records(spark, SF)
    out = jobs.filebeat_dlq(recs, pattern="test-fluentbit-.*", field="log",
                            reason=J.FLUENTBIT_ERROR, detected_at="record")
    dead = out.where(F.col("topic") == "dead-letter").collect()
    assert dead and all(json.loads(r.value)["deserial_error"] == J.FLUENTBIT_ERROR for r in dead)
    ok = out.where(F.col("topic") == "s3-archive").first()
    assert json.loads(ok.value)                    # the payload itself, not the envelope


def test_invalid_utf8_becomes_null_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"a":1}'),), (bytearray(b"\xff\xfe"),)], "v binary")
    got = [r.t for r in df.select(J.as_text("v").alias("t")).collect()]
    assert got == ['{"a":1}', None]


def test_cli_batch_run(spark, scratch):
    from logweave.cli import main
    from logweave.sources.records import read_topics
    src, sink = os.path.join(scratch, "src"), os.path.join(scratch, "sink")
    filebeat_records(spark, SF).write.partitionBy("topic").parquet(src)
    main(["validate_pass", "--source", src, "--sink", sink, "--pattern", "test-.*", "--param", "sink=ok"])
    got = read_topics(spark, sink)
    assert got.count() == jobs.validate_pass(read_topics(spark, src), sink="ok").count() > 0
    with pytest.raises(SystemExit):
        main(["validate_pass", "--source", src, "--sink", sink, "--param", "nope=1"])


def test_cli_stream_run(spark, scratch):
    from logweave.cli import main
    from logweave.sources.records import read_topics
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    filebeat_records(spark, SF).write.partitionBy("topic").parquet(src)
    main(["filebeat_dlq", "--source", src, "--sink", sink, "--stream", "--checkpoint", ckpt])
    want = jobs.filebeat_dlq(read_topics(spark, src))
    assert read_topics(spark, sink).count() == want.count() > 0


def test_cli_env_params():
    from logweave.cli import env_params
    env = {"INPUT_TOPIC_REGEX": "test-.*", "OUTPUT_TOPIC_S3": "s3.topic", "ERROR_TOPIC": "err",
           "TOPIC_PREFIX": "filtered_", "TZ": "UTC"}
    assert env_params("filebeat_dlq", env) == {"pattern": "test-.*", "sink": "s3.topic", "error_topic": "err",
                                               "zone": "UTC"}
    assert env_params("monthly_split", env) == {"pattern": "test-.*", "error_topic": "err",
                                                "topic_prefix": "filtered_", "zone": "UTC"}


def test_cli_stream_metrics(spark, scratch, capsys):
    from logweave.cli import main
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    filebeat_records(spark, SF).write.partitionBy("topic").parquet(src)
    main(["filebeat_dlq", "--source", src, "--sink", sink, "--stream", "--checkpoint", ckpt, "--metrics"])
    out = capsys.readouterr().out
    assert "dead_letters=" in out


def test_latest_by_key_with_a_hot_key(spark):
    """A key holding a third of all records: exact result, reduced per task
    before the shuffle (partial aggregation), nothing dropped."""
    from logweave.operators.grouped import latest_by_key
    from logweave.sources.records import RECORD_SCHEMA
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [("t", "hot" if i % 3 == 0 else f"k{i % 50}", f'{{"i":{i}}}', 0, i, t0) for i in range(3000)]
    df = spark.createDataFrame(rows, RECORD_SCHEMA).repartition(8)
    got = {r.key: (r.offset, r.value) for r in latest_by_key(df).collect()}
    assert got["hot"] == (2997, '{"i":2997}')
    assert len(got) == 1 + len({f"k{i % 50}" for i in range(3000) if i % 3})
    assert "partial_max_by" in formatted_plan(latest_by_key(df))


def test_fanout_conservation(spark):
    """Log split: outputs = archive records + 2 x chat messages."""
    from logweave.sources.derived import action_records
    recs = action_records(spark, SF)
    out = jobs.log_split(recs)
    act = recs.select(J.text_of(J.parse("value"), "action").alias("a"))
    n_s3 = act.where(~F.col("a").startswith("chat.")).count()
    n_chat = act.where(F.col("a") == "chat.sendmessage").count()
    assert out.count() == n_s3 + 2 * n_chat
    assert out.where(F.col("topic") == "chat-flat").count() == out.where(F.col("topic") == "chat-copy").count() == n_chat
