"""Message size limits, as a route of their own.

A producer refuses a message larger than its ``max.request.size`` and a job
then fails on it again after every restart. Here a message is measured the
way a producer measures it, before the sink: one that is too large goes to
the dead-letter topic as error records that each fit, and nothing of it is
lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.common import to_col

#: A producer's default limit, and the bytes of a batch with one record besides its parts.
MAX_REQUEST_SIZE = 1_048_576
BATCH_OVERHEAD, RECORD_OVERHEAD = 61, 21
TOO_LARGE_FOR_SINK = "Message Too Large For Sink"
#: Bytes kept free in an error record for everything but its data and key, and the smallest limit that leaves room.
RESERVED, LEAST_LIMIT = 1024, 2048
#: The most bytes that one character takes in a JSON text.
JSON_BYTES = 6


def _varint(n: Column) -> Column:
    """Bytes of a length in the zigzag form that records use."""
    return (F.when(n < 1 << 6, 1).when(n < 1 << 13, 2).when(n < 1 << 20, 3).when(n < 1 << 27, 4).otherwise(5))


def _sized(part: Column) -> Column:
    n = F.octet_length(part)
    return F.when(part.isNull(), 1).otherwise(n + _varint(n)).cast("long")


def encoded_size(key="key", value="value", headers=None) -> Column:
    """Upper bound of the bytes that one record takes in a produce request (never NULL)."""
    size = F.lit(BATCH_OVERHEAD + RECORD_OVERHEAD).cast("long") + _sized(to_col(key).cast("binary")) + _sized(to_col(value).cast("binary"))
    if headers is None:
        return size + 1
    h = to_col(headers)
    of_headers = F.aggregate(h, F.lit(0).cast("long"), lambda n, x: n + _sized(x["key"].cast("binary")) + _sized(x["value"]))
    return size + F.coalesce(_varint(F.size(h)) + of_headers, F.lit(1))


def within_limit(routed: DataFrame, detected_at: Column, limit: int = MAX_REQUEST_SIZE, error_topic: str = "dead-letter") -> DataFrame:
    """Routed records of which none is larger than ``limit`` bytes in a produce request.

    A larger one becomes error records on ``error_topic`` with the reason
    ``Message Too Large For Sink``: ``data`` holds its value in ``parts``
    pieces, numbered by ``part`` from 0, beside the topic it was meant for, its
    ``size`` and its value's ``sha256``. The pieces joined in order are the
    value. Key and headers go along where they take at most an eighth of the
    limit each. Columns are unchanged; one projection, no shuffle.
    """
    if limit < LEAST_LIMIT:
        raise ValueError(f"limit must be at least {LEAST_LIMIT} bytes")
    has_headers = "headers" in routed.columns
    small = limit // 8
    chunk = (limit - RESERVED - 2 * small) // JSON_BYTES
    sized = routed.withColumn("_size", encoded_size("key", "value", "headers" if has_headers else None))
    parts = F.when(F.col("_size") > limit, F.greatest(F.ceil(F.length("value") / chunk), F.lit(1))).otherwise(F.lit(1)).cast("int")
    sized = sized.withColumn("_parts", parts)
    sized = sized.select("*", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)).alias("_part"))
    large = F.col("_size") > limit
    error = F.to_json(F.struct(
        detected_at.alias("detected_at"), F.lit(TOO_LARGE_FOR_SINK).alias("deserial_error"),
        F.substring(F.col("value"), F.col("_part") * chunk + 1, F.lit(chunk)).alias("data"), F.col("topic"), F.col("_size").alias("size"),
        F.col("_part").alias("part"), F.col("_parts").alias("parts"), F.sha2(F.col("value").cast("binary"), 256).alias("sha256")),
        {"ignoreNullFields": "false"})
    new = {"topic": F.when(large, F.lit(error_topic)).otherwise(F.col("topic")),
           "key": F.when(~large | (F.octet_length("key") <= small), F.col("key")),
           "value": F.when(large, error).otherwise(F.col("value"))}
    if has_headers:
        of_headers = encoded_size(F.lit(None).cast("string"), F.lit(None).cast("string"), "headers")
        new["headers"] = F.when(~large | (of_headers <= small), F.col("headers"))
    if "status" in routed.columns:
        new["status"] = F.when(large, F.lit("too_large")).otherwise(F.col("status"))
    return sized.select(*[new[c].alias(c) if c in new else F.col(c) for c in routed.columns])
