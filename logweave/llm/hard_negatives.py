"""Hard-negative mining by slot-decomposed selection.

Anchors are met by all rows block by block: a bounded block of anchors goes
to every task, which multiplies it with its rows and keeps only top lists.

1. Positives: each task keeps an anchor's first rows of the same label; the
   lists of all tasks are merged, and the first of them are its positives.
2. Negatives: the positives' scores, which are the upper limits of their
   windows, split the scores into disjoint slots. Each task keeps the first
   rows of every slot; the lists of all tasks are merged slot by slot.
3. Windows overlap, but each is a run of slots down from its upper limit: the
   slots are merged from the lowest upwards, and the first rows of each such
   suffix, down to the window's lower limit, answer the window.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import removed, written

#: Anchors of one block at most, and bytes of their vectors.
ANCHORS, ANCHOR_BYTES = 20_000, 16 << 20
#: Rows and anchors that are multiplied at once.
ROWS, TILE = 2048, 256
#: Components are kept in 32 bits.
LARGEST = 1 << 31
EVERY, SCALE = 100, 256
KEPT = "anchor long, slot int, score long, vec_id long"


def usable(embeddings: DataFrame, label: Column | None = None) -> DataFrame:
    """``(vec_id, label, dims, raw)`` of the rows that take part; ``raw`` is floor(256 x) in 32 bits each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, dims = [], []
            for v in b.column("v").to_pylist():
                x = None if v is None or None in v or not v else np.floor(np.array(v, np.float64) * SCALE)
                good = x is not None and np.isfinite(x).all() and (np.abs(x) < LARGEST).all()
                raw.append(x.astype("<i4").tobytes() if good else None)
                dims.append(len(x) if good else 0)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), pa.array(dims, pa.int32()), pa.array(raw, pa.binary())],
                                             ["vec_id", "label", "dims", "raw"])
    own = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), (F.col("label") if label is None else label).cast("long").alias("label"),
                            F.col("embedding").cast("array<double>").alias("v"))
    return own.where("vec_id is not null and label is not null and v is not null").mapInArrow(
        run, "vec_id long, label long, dims int, raw binary").where("raw is not null")


def _scores(rows: np.ndarray, anchors: np.ndarray) -> np.ndarray:
    """Integer inner products, exact: in doubles where these hold them, else in 64 bits."""
    most = int(np.abs(rows, dtype=np.int64).max(initial=0)) * int(np.abs(anchors, dtype=np.int64).max(initial=0)) * rows.shape[1]
    if most < 1 << 53:
        return (rows.astype(np.float64) @ anchors.astype(np.float64).T).astype(np.int64)
    return rows.astype(np.int64) @ anchors.astype(np.int64).T


class Best:
    """The first ``keep`` rows of each (anchor, slot): highest score, then smallest vec_id."""

    def __init__(self, n_anchors: int, slots: int, keep: int):
        self.keep, self.slots = keep, slots
        self.floor = np.full(n_anchors * slots, np.iinfo(np.int64).min)  # no lower score can enter a full list
        self.lists = tuple(np.zeros(0, np.int64) for _ in range(3))

    def add(self, place: np.ndarray, score: np.ndarray, vec: np.ndarray) -> None:
        ok = score >= self.floor[place]
        place, score, vec = (np.concatenate([old, new[ok]]) for old, new in zip(self.lists, (place, score, vec)))
        order = np.lexsort((vec, -score, place))
        place, score, vec = place[order], score[order], vec[order]
        first = np.searchsorted(place, place)  # where each list starts
        top = np.arange(len(place)) - first < self.keep
        self.lists = tuple(x[top] for x in (place, score, vec))
        last = np.arange(len(place)) - first == self.keep - 1
        self.floor[place[last]] = score[last]

    def rows(self, ids: np.ndarray) -> pa.RecordBatch:
        place, score, vec = self.lists
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[place // self.slots], pa.int64()), pa.array(place % self.slots, pa.int32()), pa.array(score), pa.array(vec)],
            ["anchor", "slot", "score", "vec_id"])


def _top(tiles: np.ndarray, ok: np.ndarray, keep: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of each column's ``keep`` highest scores where ``ok``, ties at the last one included."""
    lowest = np.iinfo(np.int64).min
    held = np.where(ok, tiles, lowest)
    if len(held) > keep:
        limit = np.partition(held, len(held) - keep, axis=0)[len(held) - keep]
        ok = ok & (held >= limit)
    return np.nonzero(ok)


def _search(block, keep: int):
    """Rows of a task -> top lists of each anchor of the block: of its own label, or of the slots of other labels.

    The block is ``(row, anchor number, label, vectors, limits)`` of each vector length; limits (None in the first
    search) are each anchor's upper limits in descending order, filled up with the smallest number, and last the
    lowest score that any window takes.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for b in batches:
            sizes = b.column("dims").to_numpy()
            for dims in np.unique(sizes).tolist():
                if dims not in block.value:
                    continue
                number, label, vectors, limits = block.value[dims]
                slots = 1 if limits is None else limits.shape[1] - 1
                best = held.setdefault(dims, Best(len(number), slots, keep))
                at = np.flatnonzero(sizes == dims)
                vec, own, rowid = (b.column(c).to_numpy()[at] for c in ("vec_id", "label", "row"))
                x = np.frombuffer(b"".join(b.column("raw").take(pa.array(at)).to_pylist()), "<i4").reshape(len(at), dims)
                for s in range(0, len(at), ROWS):
                    r = slice(s, s + ROWS)
                    for t in range(0, len(number), TILE):
                        tiles = _scores(x[r], vectors[t:t + TILE])
                        same = own[r, None] == label[None, t:t + TILE]
                        for slot in range(slots):
                            if limits is None:
                                ok = same & (rowid[r, None] != number[None, t:t + TILE])
                            else:
                                up, low = limits[t:t + TILE, slot], np.maximum(limits[t:t + TILE, slot + 1], limits[t:t + TILE, -1] - 1)
                                ok = ~same & (tiles <= up) & (tiles > low)
                            row, col = _top(tiles, ok, keep)
                            best.add((t + col) * slots + slot, tiles[row, col], vec[r][row])
        for dims, best in held.items():
            yield best.rows(block.value[dims][0])
    return run


def _merged(kept: DataFrame, keep: int) -> DataFrame:
    """The first ``keep`` rows of each (anchor, slot) of all tasks; each task gave at most as many."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


def _block(anchors: pa.Table, limits: dict | None) -> dict:
    out = {}
    for dims in set(anchors.column("dims").to_pylist()):
        own = anchors.filter(pc.equal(anchors.column("dims"), dims))
        number, label = (own.column(c).to_numpy() for c in ("row", "label"))
        vectors = np.frombuffer(b"".join(own.column("raw").to_pylist()), "<i4").reshape(len(number), dims)
        if limits is not None:
            there = np.array([n in limits for n in number.tolist()], bool)
            number, label, vectors = number[there], label[there], vectors[there]
        if len(number):
            out[dims] = number, label, vectors, None if limits is None else np.array([limits[n] for n in number.tolist()], np.int64)
    return out


def _limits(positives: pa.Table, n_positives: int, percent: int) -> dict:
    """Each anchor's different positive scores in descending order, filled up, and the lowest score wanted."""
    lowest, out = np.iinfo(np.int64).min + 1, {}
    for anchor, scores in zip(positives.column("anchor").to_pylist(), positives.column("scores").to_pylist()):
        upper = sorted(set(scores), reverse=True)
        wanted = min(-(-percent * s // 100) for s in upper)
        out[anchor] = upper + [lowest] * (n_positives + 1 - len(upper)) + [wanted]
    return out


def _answers(keep: int, percent: int):
    """Rows ``(anchor_id, positives, kept)`` -> the ranked negatives of every positive."""
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for anchor, positives, kept in zip(*(b.column(c).to_pylist() for c in ("anchor_id", "positives", "kept"))):
                upper = sorted({p["score"] for p in positives}, reverse=True)
                slots = [[] for _ in upper]
                for k in kept or []:
                    slots[k["slot"]].append((-k["score"], k["vec_id"]))
                suffix, first = [], {}
                for score, slot in zip(upper[::-1], slots[::-1]):  # each slot joins those below it
                    suffix = list(heapq.merge(sorted(slot), suffix))[:keep]
                    first[score] = suffix
                for p in positives:
                    found = [(-s, v) for s, v in first[p["score"]] if percent * p["score"] <= 100 * -s <= 100 * p["score"]]
                    out += [(anchor, p["vec_id"], r, v, p["score"], s) for r, (s, v) in enumerate(found, 1)]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
    return run


def mine(embeddings: DataFrame, label: Column | None = None, n_positives: int = 5, n_negatives: int = 5, percent: int = 80) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``label`` is the class of a row (default: its column). Rows with a null
    vec_id, a null label, a null or empty vector, a null or non-finite
    component, or one beyond 32 bits once scaled take no part. Vectors meet
    those of their own length. Repeated rows are rows each: ids repeat in
    lists, and in anchors. Other columns are ignored; an empty table, or one
    without anchors, gives no rows.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings, label).withColumn("row", F.monotonically_increasing_id())
    rows = written(rows, "vectors")
    anchors = written(rows.where(F.col("vec_id") % EVERY == 0), "anchors")
    # blocks of bounded size, by a running count within each partition of the anchors' rows
    size = F.length("raw") + 24
    running = F.sum(size).over(Window.partitionBy(F.shiftright("row", 33)).orderBy("row"))
    number = F.row_number().over(Window.partitionBy(F.shiftright("row", 33)).orderBy("row"))
    parts = anchors.select(F.shiftright("row", 33).alias("part"), "row", running.alias("sum"), number.alias("n"))
    cuts = (parts.groupBy("part", F.greatest(F.floor(F.col("sum") / ANCHOR_BYTES), F.floor((F.col("n") - 1) / ANCHORS)).alias("cut"))
            .agg(F.min("row").alias("low"), F.max("row").alias("high"), F.count(F.lit(1)).alias("n"), F.max("sum").alias("bytes"),
                 F.min("sum").alias("least")))
    results = []
    for low, high in _together(cuts.orderBy("low").toLocalIterator()):
        own = anchors.where(F.col("row").between(low, high))
        table = own.select("row", "label", "dims", "raw").toArrow()
        block = spark.sparkContext.broadcast(_block(table, None))
        found = _merged(rows.mapInArrow(_search(block, n_positives), KEPT), n_positives)
        positives = written(found.groupBy("anchor").agg(F.collect_list(F.struct("rank", "score", "vec_id")).alias("positives")), "positives")
        block.destroy()
        scores = positives.select("anchor", F.col("positives.score").alias("scores")).toArrow()
        block = spark.sparkContext.broadcast(_block(table, _limits(scores, n_positives, percent)))
        found = _merged(rows.mapInArrow(_search(block, n_negatives), KEPT), n_negatives)
        kept = found.groupBy("anchor").agg(F.collect_list(F.struct("slot", "score", "vec_id")).alias("kept"))
        both = positives.join(kept, "anchor").join(own.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        answers = both.select("anchor_id", F.array_sort("positives").alias("positives"), "kept").mapInArrow(
            _answers(n_negatives, percent),
            "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
        results.append(written(answers, "negatives"))
        block.destroy()
        removed(positives)
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out


def _together(cuts) -> Iterator[tuple[int, int]]:
    """Neighbouring cuts that make one block, as the first and the last row of it."""
    low = high = None
    n = size = 0
    for c in cuts:
        own = c["bytes"] - c["least"]
        if low is not None and (n + c["n"] > ANCHORS or size + own > ANCHOR_BYTES):
            yield low, high
            low, n, size = None, 0, 0
        low, high, n, size = c["low"] if low is None else low, c["high"], n + c["n"], size + own
    if low is not None:
        yield low, high


def moved_label() -> Column:
    """The contract's label: every seventh vec_id's is the next class."""
    return F.when(F.col("vec_id") % 7 == 0, F.expr("(label + 1) % 10")).otherwise(F.col("label"))


def query(spark, sf_dir: str) -> DataFrame:
    """op12: the hard negatives of every anchor's positives."""
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), moved_label())


#: DuckDB SQL for the same rows.
SQL = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding::DOUBLE[] AS e
           FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0),
q AS MATERIALIZED (SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)) AS e, row_number() OVER () AS row FROM v
      WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.row AS anchor, a.vec_id AS anchor_id, r.row AS row, r.vec_id, a.label = r.label AS same,
             list_inner_product(a.e, r.e)::BIGINT AS score
      FROM q a JOIN q r ON len(a.e) = len(r.e) WHERE a.vec_id % 100 = 0),
p AS (SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM s WHERE same AND row <> anchor
      QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor, p.anchor_id, positive_id, positive_score, s.vec_id AS negative_id, s.score AS negative_score,
             row_number() OVER (PARTITION BY p.anchor, positive ORDER BY s.score DESC, s.vec_id) AS rank
      FROM p JOIN s ON p.anchor = s.anchor AND NOT s.same
           AND 80 * positive_score::HUGEINT <= 100 * s.score::HUGEINT AND s.score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
"""
