"""Branching, fan-out and routed emission.

A routing job decides, per record, which branch it belongs to and which
output records ``(topic, key, value)`` that branch emits. Here:

* the decision is one ``CASE`` column (first matching predicate wins for
  exclusive branches; every matching predicate for independent filters);
* every output of every branch is a ``struct(topic, key, value)`` guarded by
  its condition, and the job emits them with one ``explode(array(...))``
  generator followed by ``o IS NOT NULL``.

So one scan and one JSON parse feed all sinks, there is no shuffle, and the
NULL check (like any later filter on ``topic``) stays above the generator
instead of being pushed below the parse and evaluated twice, which is what
happens with a plain ``DataFrame.filter`` on a parsed column. ``explode``
of an array of structs compiles into the same whole-stage code as the
projections below it (a lambda-based ``filter`` would not).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.functions.common import lit_or_col, to_col

BRANCH_COL = "_branch"


@dataclass
class Emit:
    """One output record of a branch. ``key=None`` keeps the input key.

    ``status`` says what became of the record (``ok`` unless given): a record
    whose reshape failed keeps flowing with a NULL key, and only its status
    tells it from one that never had a key.
    """
    topic: Column | str
    value: Column | str = "value"
    key: Column | str | None = None
    status: Column | str = "ok"

    def struct(self, branch: str) -> Column:
        key = F.col("key") if self.key is None else to_col(self.key)
        return F.struct(F.lit(branch).alias("branch"), lit_or_col(self.status).cast("string").alias("status"),
                        lit_or_col(self.topic).cast("string").alias("topic"),
                        key.cast("string").alias("key"),
                        to_col(self.value).cast("string").alias("value"))


@dataclass
class Branch:
    """A named branch: records matching ``predicate`` produce ``emits``.

    ``predicate=None`` matches everything (use it for a default branch).
    An empty ``emits`` list consumes the records without output (drop).
    """
    name: str
    predicate: Column | None
    emits: Sequence[Emit] = field(default_factory=list)


def branch_column(branches: Sequence[Branch], default: str | None = None) -> Column:
    """Name of the first branch whose predicate holds (NULL predicates are
    false); ``default`` (or NULL) when none does."""
    out = F.lit(default).cast("string")
    for b in reversed(branches):
        p = F.lit(True) if b.predicate is None else F.coalesce(b.predicate, F.lit(False))
        out = F.when(p, F.lit(b.name)).otherwise(out)
    return out


def route(df: DataFrame, branches: Sequence[Branch], default: Branch | None = None,
          exclusive: bool = True, keep: Sequence[str] = (), with_branch: bool = False,
          with_status: bool = False) -> DataFrame:
    """Route records to their outputs; returns ``topic, key, value``.

    ``exclusive=True`` is split/branch semantics (first match wins, the
    ``default`` branch takes the rest, no default = rest dropped).
    ``exclusive=False`` is several independent filters on one stream: a
    record is emitted once per matching branch.
    ``keep`` carries input columns along (e.g. ``offset``); ``with_branch``
    adds the branch name, ``with_status`` each output's status.
    """
    names = [b.name for b in branches] + ([default.name] if default else [])
    if len(set(names)) != len(names):
        raise ValueError("branch names must be unique")
    outs = []
    if exclusive:
        staged = df.withColumn(BRANCH_COL, branch_column(branches, default.name if default else None))
        for b in list(branches) + ([default] if default else []):
            for e in b.emits:
                outs.append(F.when(F.col(BRANCH_COL) == b.name, e.struct(b.name)))
    else:
        staged = df
        for b in branches:
            p = F.lit(True) if b.predicate is None else F.coalesce(b.predicate, F.lit(False))
            for e in b.emits:
                outs.append(F.when(p, e.struct(b.name)))
        if default:
            anyp = F.lit(False)
            for b in branches:
                anyp = anyp | (F.lit(True) if b.predicate is None else F.coalesce(b.predicate, F.lit(False)))
            for e in default.emits:
                outs.append(F.when(~anyp, e.struct(default.name)))
    if not outs:
        raise ValueError("no branch emits anything")
    routed = _emit(staged.select(*keep, F.explode(F.array(*outs)).alias("_o")), keep)
    cols = list(keep) + (["branch"] if with_branch else []) + ["topic", "key", "value"] + (["status"] if with_status else [])
    return routed.select(*cols)


def _emit(exploded: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Keep the non-NULL generated structs and flatten them."""
    return exploded.where(F.col("_o").isNotNull()).select(*keep, "_o.*")


LEGAL_TOPIC = r"^[a-zA-Z0-9._-]{1,249}\z"


def legal_topic(topic) -> Column:
    """True where a topic name is one that a broker accepts (never NULL)."""
    t = to_col(topic)
    return F.coalesce(t.rlike(LEGAL_TOPIC) & ~t.isin(".", ".."), F.lit(False))


def filter_once(df: DataFrame, condition: Column, keep: Sequence[str] | None = None) -> DataFrame:
    """``df.where(condition)`` that evaluates the condition's inputs once.

    For conditions on parsed columns; a condition on stored columns is better
    a plain ``where``, which reaches the scan. ``keep`` names the columns
    that go on (all by default), so that the scan reads no others.

    A plain filter over a parsed column is pushed below the projection and
    re-parses; emitting surviving rows through a generator keeps a single
    evaluation. Same rows, same columns.
    """
    cols = list(keep) if keep is not None else df.columns
    arr = F.array(F.when(F.coalesce(condition, F.lit(False)), F.struct(*cols)))
    return _emit(df.select(F.explode(arr).alias("_o")))


def dead_letter_topic_or_fail(ok: Column, topic: Column, message: str, on_error: str,
                              error_topic: str) -> Column:
    """Topic for a record whose output topic depends on ``ok``.

    ``on_error``: ``dead_letter`` (default) sends failures to
    ``error_topic``; ``fail`` stops the job with ``message``; ``drop``
    yields NULL (the record is not emitted).
    """
    if on_error == "dead_letter":
        return F.when(ok, topic).otherwise(F.lit(error_topic))
    if on_error == "fail":
        return F.when(ok, topic).otherwise(F.raise_error(F.lit(message)).cast("string"))
    if on_error == "drop":
        return F.when(ok, topic)
    raise ValueError(f"unknown on_error policy: {on_error}")


ON_ERROR = ("dead_letter", "fail", "drop")


def check_on_error(on_error: str) -> None:
    if on_error not in ON_ERROR:
        raise ValueError(f"on_error must be one of {ON_ERROR}")

