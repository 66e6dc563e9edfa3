"""The changelog table of topics as a stream: the latest value of every key, kept up to date.

Each micro-batch is reduced to its latest record per key and written as one
delta, ``<root>/batch=<id>``. A replayed batch overwrites its own delta, so
the table counts every record once whatever is restarted. Reading merges the
deltas with the same aggregate; deletes stay in the deltas as NULL values.
:func:`compact_latest` folds the deltas so far into one base table, so that
what a reader merges stays small. No state is held between batches: a lost
executor costs its tasks only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql import functions as F

from logweave.operators.grouped import latest_by_key, latest_records
from logweave.session import shared_dir

STATE = "topic string, key string, partition int, offset long, timestamp timestamp, value string, batch long"


def start_latest_stream(records: DataFrame, root: str, checkpoint: str | None = None, name: str = "latest",
                        processing_time: str | None = None) -> StreamingQuery:
    """Keep the changelog table of ``records`` at ``root`` (read it with :func:`read_latest`)."""
    def delta(batch: DataFrame, batch_id: int) -> None:
        latest_records(batch).write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    ckpt = checkpoint or shared_dir(records.sparkSession, f"checkpoints/{name}")
    w = records.writeStream.foreachBatch(delta).option("checkpointLocation", ckpt).queryName(name)
    return (w.trigger(processingTime=processing_time) if processing_time else w.trigger(availableNow=True)).start()


def _children(spark: SparkSession, root: str, prefix: str) -> list[int]:
    """Numbers of the finished folders ``<root>/<prefix><number>``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    found = []
    for status in fs.listStatus(path):
        own = status.getPath().getName()
        done = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if own.startswith(prefix) and own[len(prefix):].isdigit() and fs.exists(done):
            found.append(int(own[len(prefix):]))
    return sorted(found)


def _merged(spark: SparkSession, root: str) -> tuple[DataFrame, int]:
    """The latest record of every key, deletes included, and the last batch that it holds (-1: none)."""
    bases, batches = _children(spark, root, "base="), _children(spark, root, "batch=")
    base = bases[-1] if bases else -1
    new = [b for b in batches if b > base]
    paths = ([f"{root}/base={base}"] if bases else []) + [f"{root}/batch={b}" for b in new]
    schema = STATE.rsplit(",", 1)[0]
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return latest_records(rows), max([base, *new])


def read_latest(spark: SparkSession, root: str, drop_tombstones: bool = True) -> DataFrame:
    """The table as :func:`logweave.operators.grouped.latest_by_key` gives it: topic, key, offset, value."""
    return latest_by_key(_merged(spark, root)[0], drop_tombstones=drop_tombstones)


def compact_latest(spark: SparkSession, root: str) -> int:
    """Fold base and deltas into a new base; returns the last batch in it (-1: there is nothing).

    Safe beside a running stream: later batches have higher numbers, and a
    reader sees a base only when it is complete. Nothing is deleted; folders
    up to that batch may be once no reader uses them.
    """
    rows, last = _merged(spark, root)
    if last >= 0 and last not in _children(spark, root, "base="):
        rows.write.mode("overwrite").parquet(f"{root}/base={last}")
    return last
