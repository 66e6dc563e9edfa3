"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import removed, written


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every end of the links ``(a, b)``; a component is its smallest node.

    Each round links every node's larger neighbours, then its smaller ones,
    to its smallest neighbour. Minima are combined before the shuffle and
    joined back to the links, so the links of a hub are never one group.
    Links of a node to itself and repeated links change nothing; nulls are
    left out. Each round's links are written to the shared folder.
    """
    now = written(edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
                  "links")
    mark = None
    while True:
        new = now.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("h")).first()
        if new == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                now.select("v", "v").distinct())
        mark = new
        both = now.union(now.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = written(large, "links-large")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least).distinct())
        after = written(small, "links")
        removed(large)
        removed(now)
        now = after
