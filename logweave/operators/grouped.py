"""The few operators that group: latest value per key and per-topic counts.

Both aggregate in two phases: each task first reduces its own rows to one row
per key, so only that partial result is shuffled. A key that holds a third of
all records still costs one row per task in the shuffle, never one task
holding the whole group. ``route_counts`` is a hash aggregate;
``latest_by_key`` carries a struct, which Spark aggregates by sorting each
task's rows by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(records: DataFrame, key: str = "key", drop_tombstones: bool = True,
                  by: tuple[str, ...] = ("topic",),
                  order: tuple[str, ...] = ("timestamp", "partition", "offset")) -> DataFrame:
    """Changelog-table view of topics: the latest value of every key of each topic.

    An offset orders records within one partition only, so records are
    ordered by time, then partition and offset. Records without a key are
    ignored; when ``drop_tombstones`` a key whose latest value is NULL (a
    delete) is left out. Columns: topic, key, offset, value.
    """
    at = F.struct(*order)
    latest = (records.where(F.col(key).isNotNull())
              .groupBy(*by, key).agg(F.max_by(F.struct("offset", "value"), at).alias("_l")))
    out = latest.select(*by, key, "_l.offset", "_l.value")
    return out.where(F.col("value").isNotNull()) if drop_tombstones else out


def latest_records(records: DataFrame) -> DataFrame:
    """The latest whole record of every key of each topic, deletes included (see :func:`latest_by_key`)."""
    own = ["partition", "offset", "timestamp", "value"]
    latest = (records.where(F.col("key").isNotNull()).groupBy("topic", "key")
              .agg(F.max_by(F.struct(*own), F.struct("timestamp", "partition", "offset")).alias("_l")))
    return latest.select("topic", "key", *[f"_l.{c}" for c in own])


def route_counts(routed: DataFrame) -> DataFrame:
    """Records per output topic of a routed frame: ``topic, n``."""
    return routed.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))


def reason_of(value="value") -> Column:
    """The reason that an error record carries (``''`` for any other value)."""
    return F.regexp_extract(value, r'^\{"detected_at":"[^"]*","deserial_error":"([^"]*)"', 1)


def route_metrics(columns: Sequence[str], error_topic: str = "dead-letter", topics: Sequence[str] = (), branches: Sequence[str] = (),
                  statuses: Sequence[str] = (), reasons: Sequence[str] = ()) -> list[Column]:
    """Aggregates that count rows and dead letters, and rows by topic, branch, status and dead-letter reason.

    Metrics are ``topic:<name>``, ``branch:<name>``, ``status:<name>`` and
    ``reason:<name>``; rows with none of the names given are counted in
    ``<kind>:other``, so that the counts of a kind add up to its rows.
    """
    dead = F.col("topic") == error_topic
    out = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.count_if(dead), F.lit(0)).alias("dead_letters")]
    kinds = [("topic", F.col("topic"), topics, F.lit(True)), ("branch", F.col("branch") if "branch" in columns else None, branches, F.lit(True)),
             ("status", F.col("status") if "status" in columns else None, statuses, F.lit(True)), ("reason", reason_of(), reasons, dead)]
    for kind, value, names, where in kinds:
        if not names:
            continue
        if value is None:
            raise ValueError(f"the routed frame has no {kind} column")
        out += [F.count_if(where & (value == n)).alias(f"{kind}:{n}") for n in names]
        out.append(F.count_if(where & ~F.coalesce(value.isin(*names), F.lit(False))).alias(f"{kind}:other"))
    return out


def observe_routes(routed: DataFrame, name, error_topic: str = "dead-letter", topics: Sequence[str] = (), branches: Sequence[str] = (),
                   statuses: Sequence[str] = (), reasons: Sequence[str] = ()) -> DataFrame:
    """Attach named metrics (:func:`route_metrics`) without changing the rows.

    ``name`` is a name, or an ``Observation`` for a batch.

    Works on batch and streaming frames: for a stream the values arrive in
    each progress event (``query.lastProgress['observedMetrics']``), for a
    batch on the ``Observation`` after an action. Nothing is logged per row.
    """
    return routed.observe(name, *route_metrics(routed.columns, error_topic, topics, branches, statuses, reasons))
