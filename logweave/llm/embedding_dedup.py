"""Embedding near-dedup by NN-descent.

Equal vectors form a class and are searched once. The neighbour graph starts
from a random-projection forest: vectors sorted by the signs of random
projections, each compared with its block. Rounds of neighbours-of-neighbours
joins refine it: the lists that meet at a vector (its neighbours, and a sample
of those that have it as neighbour) are compared with each other, where one of
a pair is new. A list holds LIST neighbours; one that is saturated with links
is enlarged up to LONG_LIST. The forest has as many trees as the table's size
asks for, that a pair at the threshold meets in one of them. A sample of
vectors, enlarged until it has enough that are linked, is then compared with
all vectors; while the mean share found of a vector's links falls short of the
wanted recall, of vectors with few links or of others, or is unknown as none
was linked, fresh trees are added and lists grow. If that does not do after
EXTRA_ROUNDS, all vectors are compared, block by block.

Links are the edges at the threshold. Inside each component of links all
pairs are counted, block by block, without emitting them: that is exact for
groups of copies larger than any list.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.common import written
from logweave.llm.graph import components

#: The fewest and the most trees of the first forest, bits of a code, vectors of a block.
TREES, MOST_TREES, BITS, BLOCK = 5, 64, 40, 160
LIST, LONG_LIST, SAMPLE = 8, 32, 8
#: Candidates that one meeting proposes to each vector.
PROPOSE = 6
ROUNDS, EXTRA_ROUNDS = 3, 3
#: Linked vectors that the recall audit looks for, the vectors that it first compares with all, the most bytes of
#: them, and the recall below which rounds go on.
LINKED, AUDIT, AUDIT_BYTES, RECALL = 256, 4096, 32 << 20, 0.995
#: Links up to which a vector's recall is averaged apart from that of members of larger groups.
FEW = 8
#: Vectors of a block in which a component's links are counted.
COUNT_BLOCK = 512
#: Vectors of a block where all are compared, and rows of a slice of it.
EXACT_BLOCK, EXACT_ROWS = 4096, 512
SEED = 11


def _valid(embeddings: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """``(vec_id, raw)``: the vector as float64 bytes; null where it is null, zero, or holds null or non-finite values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for v in b.column("v").to_pylist():
                x = None if v is None or None in v else np.array(v, np.float64)
                good = x is not None and len(x) and np.isfinite(x).all() and x.any()
                out.append(x.tobytes() if good else None)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(out, pa.binary())], ["vec_id", "raw"])
    return embeddings.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")) \
        .mapInArrow(run, "vec_id long, raw binary")


def _unit(raws: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), -1)
    x = x / np.abs(x).max(1, keepdims=True)  # the largest and smallest doubles have no square
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str], most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Rows of sorted batches with equal keys, together; at most ``most`` at once."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b] if held is None else [held, b]).combine_chunks().to_batches()
        if not t:
            continue
        t = t[0]
        cols = [t.column(k).to_numpy(zero_copy_only=False) for k in keys]
        new = np.zeros(t.num_rows, bool)
        new[0] = True
        for c in cols:
            new[1:] |= c[1:] != c[:-1]
        starts = np.flatnonzero(new)
        for s, e in zip(starts, starts[1:]):
            yield from (t.slice(k, min(most or e - s, e - k)) for k in range(s, e, most or e - s))
        held = t.slice(starts[-1])
        while most and held.num_rows >= 2 * most:
            yield held.slice(0, most)
            held = held.slice(most)
    if held is not None and held.num_rows:
        yield held


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], ["u", "v", "sim"])


def _top(sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of each row's ``k`` highest entries above -1."""
    k = min(k, sims.shape[1])
    cols = np.argpartition(-sims, k - 1, axis=1)[:, :k]
    rows = np.repeat(np.arange(len(sims)), k)
    cols = cols.ravel()
    ok = sims[rows, cols] > -1
    return rows[ok], cols[ok]


def _trees(n: int, threshold: float) -> int:
    """Trees in one of which a pair at the threshold shares a block with the probability RECALL.

    A block is told apart by about log2(n / BLOCK) signs; a pair has each alike but for its angle's share of the half circle.
    """
    alike = 1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi
    meet = alike ** max(0.0, math.log2(max(n, 1) / BLOCK))
    return min(MOST_TREES, max(TREES, math.ceil(math.log(1 - RECALL) / math.log1p(-min(meet, 0.99)))))


def _forest(vectors: DataFrame, dims: int, trees: range) -> DataFrame:
    """Edges to each vector's best of its block in each of the trees."""
    def code(batches):
        for b in batches:
            x = _unit(b.column("raw").to_pylist())
            for tree in trees:
                planes = np.random.default_rng([SEED, tree, dims]).normal(size=(dims, BITS))
                bits = (x @ planes > 0) @ (1 << np.arange(BITS)[::-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree), pa.int32()), pa.array(bits, pa.int64()), b.column("cid"), b.column("raw")],
                    ["tree", "code", "cid", "raw"])

    def blocks(batches):
        for b in _runs(batches, ["tree"], BLOCK):
            x, ids = _unit(b.column("raw").to_pylist()), b.column("cid").to_numpy()
            if len(ids) > 1:
                sims = x @ x.T
                np.fill_diagonal(sims, -2)
                r, c = _top(sims, LIST)
                yield _edges(ids[r], ids[c], sims[r, c])

    coded = vectors.select("cid", "raw").mapInArrow(code, "tree int, code long, cid long, raw binary")
    return (coded.repartitionByRange("tree", "code", "cid").sortWithinPartitions("tree", "code", "cid")
            .mapInArrow(blocks, "u long, v long, sim double"))


def _best(edges: DataFrame, threshold: float, size: int, long_size: int) -> DataFrame:
    """The highest ``size`` neighbours of each vector, and links beyond them up to ``long_size``. ``fresh``: not there before."""
    once = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("fresh").alias("fresh"))
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    ranked = once.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= long_size)
    return ranked.where((F.col("rank") <= size) | (F.col("sim") >= threshold)).select("u", "v", "sim", "fresh", "rank")


def _meet(graph: DataFrame, vectors: DataFrame, size: int) -> DataFrame:
    """Edges proposed by comparing the lists that meet at each vector."""
    near = graph.where(F.col("rank") <= size)
    back = near.select(F.col("v").alias("u"), F.col("u").alias("v"), "fresh")
    some = Window.partitionBy("u").orderBy(F.desc("fresh"), F.xxhash64("u", "v"))
    back = back.withColumn("k", F.row_number().over(some)).where(F.col("k") <= SAMPLE).drop("k")
    lists = near.select("u", "v", "fresh").union(back).groupBy("u", "v").agg(F.max("fresh").alias("fresh"))
    least = near.groupBy("u").agg(F.count(F.lit(1)).alias("n"), F.min("sim").alias("least"))
    known = vectors.select("cid", "raw").join(least, F.col("cid") == F.col("u"), "left").select(
        "cid", "raw", F.when(F.col("n") >= size, F.col("least")).otherwise(-1.0).alias("least"))
    rows = lists.join(known, F.col("v") == F.col("cid")).select("u", "v", "fresh", "raw", "least")

    def run(batches):
        for b in _runs(batches, ["u"]):
            fresh = b.column("fresh").to_numpy(zero_copy_only=False) > 0
            if b.num_rows < 2 or not fresh.any():
                continue
            x, ids, least = _unit(b.column("raw").to_pylist()), b.column("v").to_numpy(), b.column("least").to_numpy()
            sims = x @ x.T
            np.fill_diagonal(sims, -2)
            sims[~(fresh[:, None] | fresh[None, :])] = -2
            sims[sims <= least[:, None]] = -2
            r, c = _top(sims, PROPOSE)
            if len(r):
                yield _edges(ids[r], ids[c], sims[r, c])
    return rows.repartition("u").sortWithinPartitions("u", "v").mapInArrow(run, "u long, v long, sim double")


def _links(graph: DataFrame, threshold: float) -> DataFrame:
    return graph.where(F.col("sim") >= threshold).select(F.greatest("u", "v").alias("a"), F.least("u", "v").alias("b")).distinct()


def _counts(vectors: DataFrame, comps: DataFrame, threshold: float) -> DataFrame:
    """``(cid, linked)``: rows that each class links with inside its component, other classes only."""
    sizes = comps.groupBy("component").agg(F.count(F.lit(1)).alias("g"))
    members = comps.join(sizes, "component").select(
        "node", "component", F.ceil(F.col("g") / COUNT_BLOCK).cast("int").alias("blocks"))
    members = members.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = vectors.join(members, F.col("cid") == F.col("node")).select(
        "cid", "raw", "weight", "component", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    rows = rows.select("cid", "raw", "weight", "component", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"))

    def run(batches):
        for b in _runs(batches, ["component", "lo", "hi"]):
            x, own = _unit(b.column("raw").to_pylist()), b.column("own").to_numpy()
            w, ids = b.column("weight").to_numpy(), b.column("cid").to_numpy()
            lo, hi = b.column("lo")[0].as_py(), b.column("hi")[0].as_py()
            if lo == hi:
                hit = x @ x.T >= threshold
                np.fill_diagonal(hit, False)
                n = hit @ w
            else:
                left, right = own == lo, own == hi
                hit = x[left] @ x[right].T >= threshold
                n = np.zeros(len(ids), np.int64)
                n[left], n[right] = hit @ w[right], hit.T @ w[left]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64())], ["cid", "linked"])

    return (rows.repartition("component", "lo", "hi").sortWithinPartitions("component", "lo", "hi", "cid")
            .mapInArrow(run, "cid long, linked long").groupBy("cid").agg(F.sum("linked").alias("linked")))


def _audit(vectors: DataFrame, counted: DataFrame, dims: int, threshold: float) -> float | None:
    """Mean share of a linked vector's true links that ``counted`` has, of vectors with few links or of others, the lower.

    Null if none of the most vectors that may be sampled is linked, though others may be.
    """
    n = vectors.count()
    most = max(1, min(n, AUDIT_BYTES // (8 * dims)))
    size = min(AUDIT, most)
    while True:
        true, found = _sampled(vectors, counted, size, threshold)
        if size == most or ((true > 0) & (true <= FEW)).sum() >= LINKED:
            break
        size = min(4 * size, most)
    share = np.minimum(true, found) / np.maximum(true, 1)
    means = [share[m].mean() for m in ((true > 0) & (true <= FEW), true > FEW) if m.any()]
    return min(means) if means else 1.0 if size == n else None


def _sampled(vectors: DataFrame, counted: DataFrame, size: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """True links of a sample of vectors and those that ``counted`` has."""
    sample = vectors.orderBy(F.xxhash64("cid", F.lit(SEED)), "cid").limit(size).select("cid", "raw").collect()
    if not sample:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    x = vectors.sparkSession.sparkContext.broadcast(_unit([r.raw for r in sample]))
    ids = np.array([r.cid for r in sample])

    def run(batches):
        total = np.zeros(len(ids), np.int64)
        for b in batches:
            for k in range(0, b.num_rows, 4096):
                part = b.slice(k, 4096)
                y, cid, weight = _unit(part.column("raw").to_pylist()).T, part.column("cid").to_numpy(), part.column("weight").to_numpy()
                for s in range(0, len(ids), EXACT_ROWS):
                    hit = x.value[s:s + EXACT_ROWS] @ y >= threshold
                    hit &= ids[s:s + EXACT_ROWS, None] != cid[None, :]
                    total[s:s + EXACT_ROWS] += hit @ weight
        some = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(ids[some], pa.int64()), pa.array(total[some], pa.int64())], ["cid", "true"])

    true = vectors.mapInArrow(run, "cid long, true long").groupBy("cid").agg(F.sum("true").alias("true"))
    got = true.join(counted, "cid", "left").select("true", F.coalesce("linked", F.lit(0)).alias("found")).toPandas()
    return got["true"].to_numpy(np.int64), got["found"].to_numpy(np.int64)


def _joined(hit: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that join what the symmetric matrix joins: each one's first member with the others."""
    todo, first, others = hit.any(1), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(todo):
        if not todo[k]:
            continue
        found = np.zeros(len(ids), bool)
        front = np.array([k])
        while len(front):
            found[front] = True
            front = np.flatnonzero(hit[front].any(0) & ~found)
        todo &= ~found
        found[k] = False
        others.append(ids[found])
        first.append(np.full(len(others[-1]), ids[k]))
    return np.concatenate(first), np.concatenate(others)


def _compared(vectors: DataFrame, n: int, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` that join all components: every vector compared with every other, block by block."""
    blocks = -(-n // EXACT_BLOCK)
    own, other = F.pmod(F.xxhash64("cid", F.lit(SEED)), F.lit(blocks)).cast("int"), F.col("other")
    rows = vectors.select("cid", "raw", own.alias("own"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("other"))
    if blocks > 1:  # each block meets itself where it meets any other
        rows = rows.where("own != other")
    rows = rows.select("cid", "raw", F.least("own", other).alias("lo"), F.greatest("own", other).alias("hi"))

    def run(batches):
        for b in _runs(batches, ["lo", "hi"]):
            x, ids = _unit(b.column("raw").to_pylist()), b.column("cid").to_numpy()
            hit = np.zeros((len(ids), len(ids)), bool)
            for k in range(0, len(ids), EXACT_ROWS):
                hit[k:k + EXACT_ROWS] = x[k:k + EXACT_ROWS] @ x.T >= threshold
            np.fill_diagonal(hit, False)
            u, v = _joined(hit | hit.T, ids)
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["a", "b"])

    return rows.repartition("lo", "hi").sortWithinPartitions("lo", "hi").mapInArrow(run, "a long, b long")


def _search(vectors: DataFrame, dims: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """``(components, counts)`` of the vectors of one length."""
    n = vectors.count()
    size, long_size, trees = LIST, LONG_LIST, _trees(n, threshold)
    graph = written(_best(_forest(vectors, dims, range(trees)).withColumn("fresh", F.lit(1)), threshold, size, long_size), "neighbours")
    done, rounds = 0, ROUNDS
    while True:
        while done < rounds:
            proposed = _meet(graph, vectors, size).withColumn("fresh", F.lit(1))
            old = graph.select("u", "v", "sim", F.lit(0).alias("fresh"))
            graph = written(_best(old.union(proposed), threshold, size, long_size), "neighbours")
            done += 1
            if not graph.where("fresh = 1").limit(1).count():
                break
        comps = written(components(_links(graph, threshold)), "components")
        counted = written(_counts(vectors, comps, threshold), "link-counts")
        recall = _audit(vectors, counted, dims, threshold)
        if recall is not None and recall >= RECALL:
            return comps, counted
        if rounds >= ROUNDS + EXTRA_ROUNDS:
            comps = written(components(_compared(vectors, n, threshold)), "components")
            return comps, written(_counts(vectors, comps, threshold), "link-counts")
        # as many fresh trees again and longer lists: everything is new
        done, rounds, size, long_size = rounds, rounds + 1, size * 2, long_size * 2
        fresh = _forest(vectors, dims, range(trees, 2 * trees)).union(graph.select("u", "v", "sim"))
        graph, trees = written(_best(fresh.withColumn("fresh", F.lit(1)), threshold, size, long_size), "neighbours"), 2 * trees


def near_duplicates(embeddings: DataFrame, threshold: float = 0.95, id_col: str = "vec_id",
                    vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per input row.

    Vectors link at a cosine of at least ``threshold`` (double precision) and
    equal length. Null and zero vectors and those with null or non-finite
    values link with nothing. ``n_links`` counts the other rows linked
    directly, equal vectors included; ``component_id`` is the smallest
    ``vec_id`` that links reach (null ids passed over, a null id alone keeps
    null), ``kept`` marks rows that carry it. Repeated rows are rows of their
    own, other columns are ignored, an empty table gives no rows.
    """
    rows = written(_valid(embeddings, id_col, vec_col).withColumn("cid", F.xxhash64("raw")), "vectors")
    classes = written(rows.where("raw is not null").groupBy("cid", "raw")
                      .agg(F.count(F.lit(1)).alias("weight")), "vector-classes")
    found = [_search(classes.where(F.length("raw") == r.n), r.n // 8, threshold)
             for r in classes.select(F.length("raw").alias("n")).distinct().collect()]
    out = rows.join(classes.select("cid", "weight"), "cid", "left").where("raw is null or weight is not null") \
        if found else rows.withColumn("weight", F.lit(None).cast("long"))
    if found:
        comps, counted = found[0]
        for c, n in found[1:]:
            comps, counted = comps.union(c), counted.union(n)
        out = (out.join(comps.withColumnRenamed("node", "cid"), "cid", "left").join(counted, "cid", "left"))
    else:
        out = out.withColumn("component", F.lit(None).cast("long")).withColumn("linked", F.lit(None).cast("long"))
    out = out.select(
        "vec_id", (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("linked", F.lit(0))).alias("n_links"),
        F.when(F.col("raw").isNotNull(), F.coalesce("component", "cid")).alias("comp"))
    least = out.where("comp is not null").groupBy("comp").agg(F.min("vec_id").alias("least"))
    out = out.join(least, "comp", "left").select(
        "vec_id", "n_links", F.when(F.col("comp").isNull(), F.col("vec_id")).otherwise(F.col("least")).alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def query(spark, sf_dir: str) -> DataFrame:
    """op5: near-duplicate links and components of all vectors."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def brute_force(rows: list[tuple], threshold: float = 0.95) -> list[tuple]:
    """The contract's rows computed the plain way (vectors of one length), for tests."""
    good = [i for i, (_, v) in enumerate(rows)
            if v is not None and None not in v and len(v) and np.isfinite(v).all() and np.any(v)]
    x = np.array([rows[i][1] for i in good], np.float64)
    x = x / np.linalg.norm(x, axis=1, keepdims=True) if good else x
    links = x @ x.T >= threshold if good else np.zeros((0, 0), bool)
    comp = {i: i for i in range(len(rows))}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    n = dict.fromkeys(range(len(rows)), 0)
    for a in range(len(good)):
        for b in np.flatnonzero(links[a]):
            if a != b:
                n[good[a]] += 1
                p, q = sorted((root(good[a]), root(good[b])), key=lambda k: rows[k][0])
                comp[q] = p
    return [(rows[i][0], n[i], rows[root(i)][0], root(i) == i) for i in range(len(rows))]
