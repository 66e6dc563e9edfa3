"""Batch = stream; a restart on the same checkpoint adds nothing; new
input files add only their own records."""

import os

import pytest

from pyspark.sql import functions as F

from helpers import collect
from logweave.plans import jobs
from logweave.sources.derived import filebeat_records
from logweave.sources.records import read_topics
from logweave.streaming.runner import run_file_stream


def _job(df):
    return jobs.filebeat_dlq(df, detected_at="record")


def test_stream_equals_batch_and_restarts(spark, sf_dir, scratch):
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    recs = filebeat_records(spark, sf_dir)
    first = recs.where(F.col("offset") % 2 == 0)
    second = recs.where(F.col("offset") % 2 == 1)
    first.write.partitionBy("topic").parquet(src)

    q = run_file_stream(spark, _job, src, sink, checkpoint=ckpt, name="t_stream")
    q.awaitTermination(120)
    batch1 = collect(_job(read_topics(spark, src)))
    streamed1 = collect(read_topics(spark, sink).select("topic", "key", "value"))
    assert streamed1 == batch1

    q = run_file_stream(spark, _job, src, sink, checkpoint=ckpt, name="t_stream")   # restart, no new input
    q.awaitTermination(120)
    assert read_topics(spark, sink).count() == len(batch1)

    second.write.mode("append").partitionBy("topic").parquet(src)                 # new input
    q = run_file_stream(spark, _job, src, sink, checkpoint=ckpt, name="t_stream")
    q.awaitTermination(120)
    all_batch = collect(_job(read_topics(spark, src)))
    assert collect(read_topics(spark, sink).select("topic", "key", "value")) == all_batch


def test_checkpoint_defaults_to_shared_dir(spark, scratch):
    from logweave.session import shared_dir
    path = shared_dir(spark, "checkpoints/x", default_root=scratch)
    assert path.startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stream_metrics_are_observed(spark, sf_dir, scratch):
    from logweave.operators.grouped import observe_routes
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    filebeat_records(spark, sf_dir).write.partitionBy("topic").parquet(src)
    q = run_file_stream(spark, lambda df: observe_routes(_job(df), "routes"), src, sink,
                        checkpoint=ckpt, name="t_metrics")
    q.awaitTermination(120)
    progress = [p for p in q.recentProgress if p.get("observedMetrics")]
    assert progress
    m = progress[-1]["observedMetrics"]["routes"]
    assert m["rows"] > 0 and 0 < m["dead_letters"] < m["rows"]


JOB_SOURCES = {
    "chat_rekey": "pipe_records", "log_split": "action_records", "chat_extract": "table_records",
    "daily_feed": "game_records", "filebeat_dlq": "filebeat_records", "two_level_dlq": "filebeat_records",
    "db_feed": "filebeat_records", "monthly_split": "monthly_records", "validate_pass": "filebeat_records",
}


@pytest.mark.parametrize("job", sorted(JOB_SOURCES))
def test_every_job_streams_like_batch(spark, sf_dir, scratch, job):
    import inspect

    from logweave.sources import derived
    fn = getattr(jobs, job)
    kw = {"detected_at": "record"} if "detected_at" in inspect.signature(fn).parameters else {}
    run = lambda df: fn(df, **kw)
    src, sink, ckpt = (os.path.join(scratch, d) for d in ("src", "sink", "ckpt"))
    getattr(derived, JOB_SOURCES[job])(spark, sf_dir).write.partitionBy("topic").parquet(src)
    q = run_file_stream(spark, run, src, sink, checkpoint=ckpt, name=f"t_{job}")
    q.awaitTermination(180)
    assert q.exception() is None
    want = collect(run(read_topics(spark, src)))
    assert want
    assert collect(read_topics(spark, sink).select("topic", "key", "value")) == want
