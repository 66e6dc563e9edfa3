"""Run a routing job continuously: topic files (or Kafka) in, topic files out.

The same job function used in batch is applied to a streaming DataFrame;
all jobs are stateless projections, so each micro-batch is independent and
Structured Streaming's checkpoint gives exactly-once file output.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from logweave.sources.records import read_kafka, read_topics_stream
from logweave.streaming.sinks import start_routed_stream

Job = Callable[[DataFrame], DataFrame]


def run_file_stream(spark: SparkSession, job: Job, source_root: str, sink_root: str,
                    checkpoint: str | None = None, name: str = "routing",
                    max_files_per_trigger: int | None = None, available_now: bool = True,
                    processing_time: str | None = None) -> StreamingQuery:
    """``readStream`` the topic table at ``source_root``, apply ``job``,
    write routed records to ``sink_root``. Returns the started query."""
    records = read_topics_stream(spark, source_root, max_files_per_trigger=max_files_per_trigger)
    return start_routed_stream(job(records), sink_root, checkpoint, name,
                               available_now=available_now, processing_time=processing_time)


def run_kafka_stream(spark: SparkSession, job: Job, bootstrap: str, sink_root: str,
                     topic=None, pattern: str | None = None, starting_offsets: str = "earliest",
                     checkpoint: str | None = None, name: str = "routing-kafka",
                     processing_time: str | None = None) -> StreamingQuery:
    """As :func:`run_file_stream`, reading Kafka topics (connector needed)."""
    records = read_kafka(spark, bootstrap, topic, pattern, starting_offsets, stream=True)
    return start_routed_stream(job(records), sink_root, checkpoint, name,
                               available_now=processing_time is None, processing_time=processing_time)
