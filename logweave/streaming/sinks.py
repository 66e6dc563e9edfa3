"""Writing routed records ``(topic, key, value)`` and their metadata — batch and streaming.

File sinks lay records out as ``<root>/topic=<name>/part-*``: a topic is a
directory, so a dynamic topic per record is just a partition value and
downstream readers subscribe by pruning directories. The Kafka sink writes
each row to the topic named in its ``topic`` column.

Checkpoints and state go under the cluster's shared folder
(``spark.checkpoint.dir``), never a machine-local path, so a restarted
driver or a lost executor resumes where the last committed batch ended.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from logweave.session import shared_dir
from logweave.sources.records import ROUTED_COLUMNS, routed_columns


def kafka_sink_options(bootstrap: str, compression: str | None = None,
                       max_request_size: int | None = None, acks: str | None = None,
                       extra: dict[str, str] | None = None) -> dict[str, str]:
    """Producer options for ``format("kafka")`` (``kafka.``-prefixed).

    ``compression``: none/gzip/snappy/lz4/zstd; ``max_request_size`` in bytes
    (the producer's large-message limit); ``acks``: 0, 1 or all.
    """
    opts = {"kafka.bootstrap.servers": bootstrap}
    if compression:
        if compression not in ("none", "gzip", "snappy", "lz4", "zstd"):
            raise ValueError(f"unsupported compression: {compression}")
        opts["kafka.compression.type"] = compression
    if max_request_size:
        opts["kafka.max.request.size"] = str(int(max_request_size))
    if acks is not None:
        if str(acks) not in ("0", "1", "all", "-1"):
            raise ValueError("acks must be 0, 1 or all")
        opts["kafka.acks"] = str(acks)
    for k, v in (extra or {}).items():
        opts[k if k.startswith("kafka.") else "kafka." + k] = str(v)
    return opts


def spread_by_topic(routed: DataFrame, partitions: int, files_per_topic: int) -> DataFrame:
    """Optional pre-write shuffle that bounds file counts.

    Without it every task writes one file per topic it holds. With it rows
    are hash-partitioned on ``(topic, bucket)`` where ``bucket`` is a hash of
    the record modulo ``files_per_topic``: each topic lands in at most that
    many tasks, and a topic holding a third of all records is still spread
    over ``files_per_topic`` tasks instead of one.
    """
    bucket = F.pmod(F.xxhash64("key", "value"), F.lit(files_per_topic))
    return routed.repartition(partitions, F.col("topic"), bucket)


def write_routed(routed: DataFrame, root: str, mode: str = "append", fmt: str = "parquet",
                 compression: str | None = "zstd",
                 spread: tuple[int, int] | None = None, rebalance: bool = False) -> None:
    """Batch write into ``<root>/topic=<name>/``.

    ``rebalance`` shuffles by topic and lets adaptive execution split large
    topics and merge small ones by size, whatever their number.

    ``spread=(partitions, files_per_topic)`` runs :func:`spread_by_topic`
    first: worth its shuffle when computed topics are many (per day and
    type over a long backfill), where every task would otherwise write one
    small file per topic it saw.
    """
    if spread is not None:
        routed = spread_by_topic(routed, *spread)
    elif rebalance:
        routed = routed.hint("rebalance", F.col("topic"))
    w = routed.select(*routed_columns(routed)).write.mode(mode).format(fmt).partitionBy("topic")
    if compression and fmt in ("parquet", "orc", "json", "csv", "text"):
        w = w.option("compression", compression)
    w.save(root)


def _kafka_columns(routed: DataFrame) -> list[str]:
    """Kafka sets partition, offset and timestamp itself; headers go along."""
    return ROUTED_COLUMNS + [c for c in ("headers",) if c in routed.columns]


def write_routed_kafka(routed: DataFrame, options: dict[str, str]) -> None:
    """Batch write to Kafka (needs the Kafka connector on the classpath)."""
    routed.select(*_kafka_columns(routed)).write.format("kafka").options(**options).save()


def start_routed_stream(routed: DataFrame, root: str, checkpoint: str | None = None,
                        name: str = "routed", fmt: str = "parquet",
                        available_now: bool = True, processing_time: str | None = None,
                        compression: str | None = "zstd",
                        spread: tuple[int, int] | None = None, rebalance: bool = False) -> StreamingQuery:
    """Start a streaming write into ``<root>/topic=<name>/``.

    ``rebalance`` sizes each micro-batch's files: adaptive execution splits
    hot topics and merges small ones by bytes
    (``spark.sql.adaptive.advisoryPartitionSizeInBytes``), whatever their
    number. Each batch then writes ``<root>/topic=<name>/batch=<id>/`` and a
    replayed batch overwrites its own folders, so output is exactly-once.

    ``spread=(partitions, files_per_topic)`` bounds each micro-batch's files
    per topic (:func:`spread_by_topic`).

    The file sink with a checkpoint is exactly-once: a restarted query skips
    batches already committed. ``available_now`` processes what is there and
    stops; ``processing_time`` (e.g. ``"30 seconds"``) keeps running.
    """
    spark = routed.sparkSession
    ckpt = checkpoint or shared_dir(spark, f"checkpoints/{name}")
    if spread is not None and rebalance:
        raise ValueError("give spread or rebalance, not both")
    if spread is not None:
        routed = spread_by_topic(routed, *spread)
    packed = compression if fmt in ("parquet", "orc", "json", "csv", "text") else None
    out = routed.select(*routed_columns(routed))
    if rebalance:
        w = out.writeStream.foreachBatch(lambda batch, batch_id: write_batch(batch, batch_id, root, fmt, packed))
    else:
        w = out.writeStream.format(fmt).partitionBy("topic").option("path", root).outputMode("append")
        if packed:
            w = w.option("compression", packed)
    w = w.option("checkpointLocation", ckpt).queryName(name)
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def write_batch(batch: DataFrame, batch_id: int, root: str, fmt: str = "parquet", compression: str | None = None) -> None:
    """One micro-batch into ``<root>/topic=<name>/batch=<id>/``, in files sized by bytes; again, it replaces itself.

    A topic's rows are split between the tasks that read them, so a file is
    at least what one input split holds of the topic.
    """
    sized = batch.hint("rebalance", F.col("topic")).withColumn("batch", F.lit(batch_id))
    w = sized.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").format(fmt).partitionBy("topic", "batch")
    (w.option("compression", compression) if compression else w).save(root)


def start_routed_kafka_stream(routed: DataFrame, options: dict[str, str], checkpoint: str | None = None,
                              name: str = "routed-kafka", processing_time: str | None = None) -> StreamingQuery:
    """Streaming write to Kafka (at-least-once, as any Kafka producer)."""
    spark = routed.sparkSession
    ckpt = checkpoint or shared_dir(spark, f"checkpoints/{name}")
    w = (routed.select(*_kafka_columns(routed)).writeStream.format("kafka").options(**options)
         .option("checkpointLocation", ckpt).queryName(name))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()

