"""Topic records: the one relation every job reads and writes.

A record is ``(topic, key, value, partition, offset, timestamp)`` — the
column set of Spark's Kafka source — so a job runs unchanged on

* a Kafka stream (``format("kafka")``, when the connector is on the
  classpath),
* a file table laid out as ``<root>/topic=<name>/part-*.parquet`` (batch or
  ``readStream``), where choosing topics prunes whole directories, or
* any DataFrame with those columns (tests, tables derived in Spark).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORD_SCHEMA = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

# File layout: the topic is a directory partition column, data columns are
# the rest of the record.
FILE_DATA_SCHEMA = T.StructType([f for f in RECORD_SCHEMA.fields if f.name != "topic"])
FILE_SCHEMA = T.StructType(list(FILE_DATA_SCHEMA.fields) + [T.StructField("topic", T.StringType())])

ROUTED_COLUMNS = ["topic", "key", "value"]

# Where a routed record came from. ``partition``, ``offset`` and ``timestamp``
# keep their names, so routed output reads back as records and jobs chain.
METADATA_COLUMNS = ["partition", "offset", "timestamp", "source_topic", "headers", "status"]

# What a reader adds: the original bytes of a value that is not UTF-8, and
# Kafka's headers.
OPTIONAL_COLUMNS = ["raw", "headers", "source_topic"]


def routed_columns(df: DataFrame) -> list[str]:
    """The columns a sink writes: topic, key, value and the metadata that is there."""
    return ROUTED_COLUMNS + [c for c in METADATA_COLUMNS if c in df.columns]


def topic_matches(pattern: str) -> Column:
    """Whole-name regex subscription (``test-.*`` matches ``test-a`` only
    when the entire topic name matches)."""
    return F.col("topic").rlike("^(?:" + pattern + ")$")


def select_topics(df: DataFrame, topic: str | list[str] | None = None,
                  pattern: str | None = None) -> DataFrame:
    """Single-topic, topic-list or regex subscription over a record table.

    An equality/IN filter on ``topic`` is pushed to the file scan as a
    partition filter; a regex filter still prunes directories because the
    topic is a partition column (evaluated once per directory).
    """
    if topic is not None and pattern is not None:
        raise ValueError("give topic or pattern, not both")
    if isinstance(topic, str):
        return df.where(F.col("topic") == topic)
    if topic is not None:
        return df.where(F.col("topic").isin(list(topic)))
    if pattern is not None:
        re.compile(pattern)  # fail fast on a bad pattern, like a subscription would
        return df.where(topic_matches(pattern))
    return df


def _file_schema(binary: bool) -> T.StructType:
    if not binary:
        return FILE_SCHEMA
    return T.StructType([T.StructField(f.name, T.BinaryType()) if f.name in ("key", "value") else f
                         for f in FILE_SCHEMA.fields])


def _decoded(df: DataFrame, binary: bool) -> DataFrame:
    """Record columns; raw Kafka bytes are decoded as UTF-8.

    A value that is not UTF-8 is NULL and its bytes stay in ``raw``: jobs
    dead-letter it with a reason of its own. A key that is not UTF-8 is read
    with replacement characters.
    """
    extra = [c for c in OPTIONAL_COLUMNS if c in df.columns]
    if binary:
        text = F.try_validate_utf8(F.col("value").cast("string"))
        df = (df.withColumn("key", F.make_valid_utf8(F.col("key").cast("string")))
                .withColumn("raw", F.when(text.isNull(), F.col("value")))
                .withColumn("value", text))
        extra = [*extra, "raw"]
    return df.select(*RECORD_SCHEMA.fieldNames(), *extra)


def read_topics(spark: SparkSession, root: str, topic=None, pattern=None,
                fmt: str = "parquet", binary: bool = False) -> DataFrame:
    """Batch read of a ``topic=<name>`` directory table.

    ``binary=True`` reads tables that keep Kafka's raw ``key``/``value``
    bytes; of a value that is not valid UTF-8 the bytes are kept in ``raw``.
    """
    df = spark.read.format(fmt).schema(_file_schema(binary)).load(root)
    return select_topics(_decoded(df, binary), topic, pattern)


def read_topics_stream(spark: SparkSession, root: str, topic=None, pattern=None,
                       max_files_per_trigger: int | None = None,
                       fmt: str = "parquet", binary: bool = False,
                       options: dict[str, str] | None = None) -> DataFrame:
    """Streaming read of the same directory table (new files = new records)."""
    r = spark.readStream.format(fmt).schema(_file_schema(binary)).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.load(root)
    return select_topics(_decoded(df, binary), topic, pattern)


# Options of Spark's Kafka source itself; any other extra option is a Kafka
# consumer property and gets the ``kafka.`` prefix.
KAFKA_SOURCE_OPTIONS = {
    "startingOffsets", "endingOffsets", "startingTimestamp", "endingTimestamp",
    "startingOffsetsByTimestamp", "endingOffsetsByTimestamp", "startingOffsetsByTimestampStrategy",
    "failOnDataLoss", "kafkaConsumer.pollTimeoutMs", "fetchOffset.numRetries",
    "fetchOffset.retryIntervalMs", "maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay",
    "minPartitions", "maxRecordsPerPartition", "groupIdPrefix", "includeHeaders",
}


def kafka_source_options(bootstrap: str, topic=None, pattern: str | None = None,
                         starting_offsets: str = "earliest", stream: bool = True,
                         extra: dict[str, str] | None = None) -> dict[str, str]:
    """Options for ``format("kafka")``.

    ``starting_offsets`` applies only when the query has no checkpoint yet,
    the same rule as a consumer group without committed offsets. A batch
    read starts at ``earliest`` and ends at the latest offsets.
    """
    if starting_offsets not in ("earliest", "latest"):
        raise ValueError("starting_offsets must be 'earliest' or 'latest'")
    if not stream and starting_offsets == "latest":
        raise ValueError("a batch read cannot start at 'latest'")
    opts = {"kafka.bootstrap.servers": bootstrap, "startingOffsets": starting_offsets}
    if pattern is not None:
        opts["subscribePattern"] = pattern
    elif isinstance(topic, str):
        opts["subscribe"] = topic
    elif topic is not None:
        opts["subscribe"] = ",".join(topic)
    else:
        raise ValueError("give topic or pattern")
    for k, v in (extra or {}).items():
        opts[k if k.startswith("kafka.") or k in KAFKA_SOURCE_OPTIONS else "kafka." + k] = str(v)
    return opts


def read_kafka(spark: SparkSession, bootstrap: str, topic=None, pattern=None,
               starting_offsets: str = "earliest", stream: bool = True,
               extra: dict[str, str] | None = None) -> DataFrame:
    """Kafka topics as records (key/value decoded as UTF-8 text)."""
    opts = kafka_source_options(bootstrap, topic, pattern, starting_offsets, stream, extra)
    r = spark.readStream if stream else spark.read
    df = r.format("kafka").options(**opts).load()
    return _decoded(df, binary=True)


def as_records(df: DataFrame) -> DataFrame:
    """Project any DataFrame with the record columns onto the record schema."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RECORD_SCHEMA.fields])
