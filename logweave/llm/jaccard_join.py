"""N-gram Jaccard join by T-occurrence search.

A document is the set of its shingle hashes; documents with equal sets form
a class and are joined once. A class with n shingles must share
T = ceil(0.8 n) of them with any partner of at least its size, so the T - 1
most frequent inverted lists of a class are its long lists: a partner must
occur in one of the other n - T + 1 short lists. Frequencies come from a
hashed count table of fixed size; any order gives the same links.

1. Classes and shingle counts, in one pass over the texts.
2. Short lists with two or more classes (minimum and maximum class of each
   shingle, combined before the shuffle); other postings are let go by a
   Bloom filter of fixed size.
3. The most central class of each short list is the query, the others are
   its candidates. Queries and candidates meet as rows (query, candidate);
   their texts travel compressed. `divide_skip` heap-merges the query's short
   lists over a bounded block of candidates and probes the long ones by binary
   search in each candidate's sorted shingles, up to the required overlap.
4. Components of these links. Only pairs in one short list whose components
   still differ are candidates of a second search; with its links the
   components are final. Within a group of near copies this leaves a star
   instead of all pairs, and loses no link between components.

A candidate needs, at the places i and j of a shared shingle in the two
orders, min(n_a - i, n_b - j) to reach the required overlap; the first
shared shingle of a true pair always does.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import bloom_bits, in_bloom, text_key, texts_of, written
from logweave.llm.graph import components
from logweave.llm.wordhash import forget, hashed_words, mix, window_hashes

#: Buckets of the count table, whose size never depends on the data, and of one block of it.
BUCKET_BITS, BLOCK_BITS = 21, 15
#: Candidates of one query that are merged at once, and texts that are hashed together.
BLOCK = 256
SLICE_ROWS = 1000

LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))

class Shingles:
    """Distinct shingles of texts: 56 hash bits, with the frequency rank above them once ranks are known.

    Sorted, they then run from rare to frequent.
    """

    def __init__(self, width: int, percent: int, ranks: np.ndarray | None = None):
        self.width, self.percent, self.ranks = width, percent, ranks
        forget()

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """Sorted shingles of each text; distinct words are hashed once for all texts, together."""
        word, sizes = hashed_words(pc.ascii_lower(texts))
        borders = np.append(0, np.cumsum(sizes))
        all_windows = self._id(window_hashes(word, self.width))
        out = []
        for s, e in zip(borders[:-1].tolist(), borders[1:].tolist()):
            if 0 < e - s < self.width:
                found = self._id(window_hashes(word[s:e], e - s, e - s))
            else:
                found = np.sort(all_windows[s:max(s, e - self.width + 1)])
                if len(found):
                    found = found[np.append(True, found[1:] != found[:-1])]
            out.append(found)
        return out

    def _id(self, h: np.ndarray) -> np.ndarray:
        h = h >> np.uint64(8)
        return h if self.ranks is None else h | self.ranks[bucket(h)].astype(np.uint64) << np.uint64(56)

    def n_short(self, n: int) -> int:
        return n - (self.percent * n + 99) // 100 + 1


def bucket(h: np.ndarray) -> np.ndarray:
    """A shingle's place in the count table; the rank does not matter."""
    return (h >> np.uint64(56 - BUCKET_BITS)).astype(np.int64) & (1 << BUCKET_BITS) - 1


def class_of(found: np.ndarray) -> int:
    """Id of an equal-set class, whatever the order: a signed 64-bit sum over scrambled hashes and the size."""
    h = mix((found & np.uint64((1 << 56) - 1)) + np.uint64(0x632BE59BD9B4E019))
    return int((h.sum(dtype=np.uint64) + np.uint64(len(found))).view(np.int64))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(k, SLICE_ROWS) for b in batches for k in range(0, b.num_rows, SLICE_ROWS))


def _classes(width: int, percent: int):
    """``(doc_id, text_key, n, cls)`` per document, then the task's count table as ``(block, counts)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, counts = Shingles(width, percent), np.zeros(1 << BUCKET_BITS, np.int64)
        names = ["doc_id", "text_key", "n", "cls", "block", "counts"]
        for b in _slices(batches):
            sets = shingles.of(b.column("text"))
            np.add.at(counts, bucket(np.concatenate(sets)), 1)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("text_key"), pa.array(map(len, sets), pa.int64()),
                 pa.array(map(class_of, sets), pa.int64()), pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary())], names)
        for block, part in enumerate(counts.reshape(-1, 1 << BLOCK_BITS)):
            if part.any():
                none = pa.nulls(1, pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, none, none, *_block(block, part)], names)
    return run


def _block(block: int, counts: np.ndarray) -> list[pa.Array]:
    return [pa.array([block], pa.int32()), pa.array([pa.compress(counts.tobytes(), "zstd", asbytes=True)], pa.binary())]


def _counts(data: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(data, 8 << BLOCK_BITS, "zstd", asbytes=True), np.int64)


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted count blocks -> the sum of each, added up one by one."""
    block, total = None, None
    for b in batches:
        for at, data in zip(b.column("block").to_pylist(), b.column("counts").to_pylist()):
            if at != block:
                if block is not None:
                    yield pa.RecordBatch.from_arrays(_block(block, total), ["block", "counts"])
                block, total = at, np.zeros(1 << BLOCK_BITS, np.int64)
            total += _counts(data)
    if block is not None:
        yield pa.RecordBatch.from_arrays(_block(block, total), ["block", "counts"])


def _ranks(first: DataFrame) -> np.ndarray:
    """Frequency rank (a byte) of each bucket: 6 log2(count), from the tasks' tables."""
    kind = "block int, counts binary"
    blocks = first.where("block is not null").select("block", "counts").repartition("block").sortWithinPartitions("block")
    table = np.zeros(1 << BUCKET_BITS, np.uint8)
    for r in blocks.mapInArrow(_added, kind).collect():
        table[r.block << BLOCK_BITS:(r.block + 1) << BLOCK_BITS] = (6 * np.log2(_counts(r.counts) + 1.0)).clip(0, 255)
    return table


def _postings(width: int, percent: int, ranks, bits=None):
    """``(h, cls)`` of the short lists; with Bloom bits also ``n``, ``at`` and ``central``, only where they admit ``h``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, seen = Shingles(width, percent, ranks.value), set()
        for b in _slices(batches):
            out = []
            for found in shingles.of(b.column("text")):
                if not len(found) or (cls := class_of(found)) in seen:
                    continue
                seen.add(cls)  # one task gives a class once
                n = len(found)
                short = found[:shingles.n_short(n)].view(np.int64)
                at = np.arange(len(short))
                if bits is not None:
                    at = at[in_bloom(bits.value, short)]
                if len(at):
                    central = int((found >> np.uint64(56)).sum(dtype=np.uint64)) * 100 // n
                    out.append((short[at], at, len(at), cls, n, central))
            if out:
                reps = [x[2] for x in out]
                cols = [np.concatenate([x[0] for x in out]), np.repeat(np.array([x[3] for x in out]), reps)]
                if bits is not None:
                    cols += [np.repeat(np.array([x[4] for x in out]), reps), np.concatenate([x[1] for x in out]),
                             np.repeat(np.array([x[5] for x in out]), reps)]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                                 ["h", "cls", "n", "at", "central"][:len(cols)])
    return run


def _packed(bits):
    """``(text_key, size, packed)`` of the texts whose key the Bloom bits admit, compressed, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, codec = set(), pa.Codec("zstd")
        for b in batches:
            keys = b.column("text_key").to_numpy()
            at = [i for i in np.flatnonzero(in_bloom(bits.value, keys)).tolist() if keys[i] not in seen]
            seen.update(keys[at].tolist())
            texts = b.column("text").take(pa.array(at, pa.int64())).cast(pa.binary()).to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[at], pa.int64()), pa.array(map(len, texts), pa.int64()),
                 pa.array([codec.compress(t, asbytes=True) for t in texts], pa.binary())], ["text_key", "size", "packed"])
    return run


def required(n_a: int, n_b: int, percent: int) -> int:
    """The least overlap o with 100 o >= percent (n_a + n_b - o)."""
    return -(-percent * (n_a + n_b) // (100 + percent))


def divide_skip(query: np.ndarray, n_short: int, candidates: list[np.ndarray], percent: int) -> list[bool]:
    """Whether each candidate reaches the required overlap with ``query`` (both sorted from rare to frequent).

    The first ``n_short`` lists of the query are heap-merged; candidates met
    there are looked up in the long lists by binary search, which stops
    when what is left cannot reach the overlap.
    """
    lists = {}
    short = query[:n_short]
    for k, c in enumerate(candidates):
        at = np.searchsorted(c, short)
        for j in np.flatnonzero(c[np.minimum(at, len(c) - 1)] == short).tolist():
            lists.setdefault(j, []).append(k)
    met = [0] * len(candidates)
    for k in heapq.merge(*lists.values()):
        met[k] += 1
    out = []
    for c, overlap in zip(candidates, met):
        need, at = required(len(query), len(c), percent), n_short
        while overlap and overlap < need and overlap + len(query) - at >= need:
            probe = query[at:at + 256]
            place = np.searchsorted(c, probe)
            overlap += int((c[np.minimum(place, len(c) - 1)] == probe).sum())
            at += len(probe)
        out.append(overlap >= need)
    return out


def _search(width: int, percent: int, ranks):
    """Rows ``(a, size_a, text_a, b, size_b, text_b)``, those of a query together -> links ``(a, b)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, codec = Shingles(width, percent, ranks.value), pa.Codec("zstd")
        query = query_id = None
        for batch in (b.slice(k, BLOCK) for b in batches for k in range(0, b.num_rows, BLOCK)):
            ids, col = batch.column("a").to_pylist(), {c: batch.column(c).to_pylist() for c in ("size_a", "text_a", "size_b", "text_b")}
            texts = [codec.decompress(t, n, asbytes=True) for t, n in zip(col["text_b"], col["size_b"])]
            sets = shingles.of(pa.array(texts, pa.binary()).cast(pa.string()))
            good = []
            for a, rows in groupby(range(len(ids)), ids.__getitem__):
                rows = list(rows)
                if a != query_id:
                    text = codec.decompress(col["text_a"][rows[0]], col["size_a"][rows[0]], asbytes=True)
                    query_id, query = a, shingles.of(pa.array([text], pa.binary()).cast(pa.string()))[0]
                good += divide_skip(query, shingles.n_short(len(query)), [sets[k] for k in rows], percent)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(good, pa.bool_())) for c in ("a", "b")], ["a", "b"])
    return run


def linked(pairs: DataFrame, reps: DataFrame, own: DataFrame, search) -> DataFrame:
    """The pairs ``(a, b)`` of classes that link; ``a`` is the query. Only texts of these classes are moved, compressed."""
    pairs = written(pairs, "pairs")
    ends = pairs.select("a").union(pairs.select("b")).distinct().withColumnRenamed("a", "cls")
    keys = written(reps.join(ends, "cls"), "pair-texts")
    bits = own.sparkSession.sparkContext.broadcast(bloom_bits(keys, "text_key"))
    texts = (own.select("text_key", "text").mapInArrow(_packed(bits), "text_key long, size long, packed binary")
             .groupBy("text_key").agg(F.first("size").alias("size"), F.first("packed").alias("packed")))
    texts = written(texts.join(keys, "text_key").select("cls", "size", "packed"), "packed-texts")
    bits.destroy()
    a, b = (texts.select(F.col("cls").alias(x), F.col("size").alias(f"size_{x}"), F.col("packed").alias(f"text_{x}")) for x in "ab")
    rows = pairs.join(b, "b").join(a, "a").select("a", "size_a", "text_a", "b", "size_b", "text_b").sortWithinPartitions("a", "b")
    return written(rows.mapInArrow(search, "a long, b long"), "shingle-links")


def jaccard_components(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``(doc_id, text_key, n_shingles, component_id)``: one row per different (doc_id, text).

    Documents link when 100 * intersection >= ``percent`` * union of their
    shingle sets; ``component_id`` is the smallest ``doc_id`` that links
    reach. Fewer than ``width`` words are one shingle; without words, or with
    null or empty text, a document has no shingle, links with nothing and is
    its own component. Null ids are passed over in that minimum; a component
    of null ids only has a null id. Repeated rows change nothing, other
    columns are ignored, an empty table gives no rows.
    """
    sc = docs.sparkSession.sparkContext
    own = texts_of(docs).select("doc_id", text_key().alias("text_key"), F.coalesce("text", F.lit("")).alias("text"))
    first = written(own.mapInArrow(_classes(width, percent),
                                   "doc_id long, text_key long, n long, cls long, block int, counts binary"), "shingle-classes")
    ranks = sc.broadcast(_ranks(first))
    classes = first.where("block is null").select("doc_id", "text_key", "n", "cls")
    reps = classes.where("n > 0").groupBy("cls").agg(F.min("text_key").alias("text_key"))

    texts = own.select("text")
    lists = texts.mapInArrow(_postings(width, percent, ranks), "h long, cls long")
    several = written(lists.groupBy("h").agg(F.min("cls").alias("x"), F.max("cls").alias("y")).where("x < y").select("h"),
                      "shared-shingles")
    bits = sc.broadcast(bloom_bits(several, "h"))
    full = texts.mapInArrow(_postings(width, percent, ranks, bits), "h long, cls long, n long, at long, central long")
    shared = written(full.join(several, "h").distinct(), "short-lists")
    bits.destroy()

    fits = (F.least(F.col("p.n") - F.col("p.at"), F.col("q.n") - F.col("q.at")) * (100 + percent)
            >= percent * (F.col("p.n") + F.col("q.n")))
    heads = shared.groupBy("h").agg(F.max(F.struct("central", "cls", "n", "at")).alias("q")).select("h", "q.*").alias("q")
    stars = (shared.alias("p").join(heads, F.col("p.h") == F.col("q.h"))
             .where((F.col("p.cls") != F.col("q.cls")) & fits)
             .select(F.col("q.cls").alias("a"), F.col("p.cls").alias("b")).distinct())
    search = _search(width, percent, ranks)
    links = linked(stars, reps, own, search)
    comps = components(links)

    placed = written(shared.join(comps, shared["cls"] == comps["node"], "left")
                     .select(shared["*"], F.coalesce("component", "cls").alias("comp")), "placed-lists")
    sizes = placed.groupBy("h", "comp").agg(F.count(F.lit(1)).alias("c"))
    mixed = (sizes.groupBy("h").agg(F.count(F.lit(1)).alias("k"), F.max(F.struct("c", "comp")).alias("m"))
             .where("k > 1").select("h", F.col("m.comp").alias("main")))
    rest = written(placed.join(mixed, "h"), "mixed-lists")
    others, every = rest.where("comp != main").alias("p"), rest.alias("q")
    across = (others.join(every, F.col("p.h") == F.col("q.h"))
              .where((F.col("p.comp") != F.col("q.comp")) & fits
                     & ((F.col("q.comp") == F.col("q.main")) | (F.col("p.cls") < F.col("q.cls"))))
              .select(F.col("p.cls").alias("a"), F.col("q.cls").alias("b")).distinct())
    more = linked(across, reps, own, search)
    ranks.destroy()
    final = components(links.union(more))

    named = classes.join(final, (classes["cls"] == final["node"]) & (classes["n"] > 0), "left").select(
        "doc_id", "text_key", "n", F.when(F.col("n") > 0, F.coalesce("component", "cls")).alias("comp"))
    least = named.where("comp is not null").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "comp", "left").select(
        "doc_id", "text_key", F.col("n").alias("n_shingles"),
        F.when(F.col("comp").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id")).distinct()


def one_per_group(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that stand for their group: those with its smallest ``doc_id``.

    Rows without shingles all stay; of several other rows with that smallest id
    the one with the fewest shingles, then the smallest text hash, stays. Rows
    with a null id stay. Of rows equal in id and text one stays. Columns are
    unchanged.
    """
    got = jaccard_components(docs, width, percent)
    alone = F.when(F.col("doc_id").isNull() | (F.col("n_shingles") == 0), F.col("text_key"))
    stay = (got.where(F.col("doc_id").isNull() | (F.col("doc_id") == F.col("component_id")))
            .groupBy("doc_id", alone.alias("alone")).agg(F.min(F.struct("n_shingles", "text_key")).alias("s"))
            .select(F.coalesce("doc_id", F.lit(0)).alias("s_id"), F.col("doc_id").isNull().alias("s_null"), F.col("s.text_key").alias("s_key")))
    rows = docs.select(F.struct("*").alias("row"), F.coalesce("doc_id", F.lit(0)).alias("l_id"),
                       F.col("doc_id").isNull().alias("l_null"), text_key().alias("l_key"))
    # one of equal rows in each task before the shuffle, that the join uses too
    equal = Window.partitionBy("l_id", "l_null", "l_key").orderBy("l_key")
    left = rows.withColumn("number", F.row_number().over(equal)).where("number <= 1")
    kept = left.join(stay, (F.col("l_id") == F.col("s_id")) & (F.col("l_null") == F.col("s_null"))
                     & (F.col("l_key") == F.col("s_key")), "left_semi")
    return kept.select(*[F.col(f"row.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op3: near-duplicate component of every document."""
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet")).select(
        "doc_id", "n_shingles", "component_id")


def brute_force(docs: list[tuple], width: int = 5, percent: int = 80) -> list[tuple]:
    """The contract's rows computed the plain way, for tests."""
    sets = []
    for _, text in docs:
        words = (text or "").encode().translate(LOWER).split()
        n = min(width, len(words))
        sets.append({tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if words else set())
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(docs)):
        for j in range(i):
            o = len(sets[i] & sets[j])
            if o and 100 * o >= percent * (len(sets[i]) + len(sets[j]) - o):
                a, b = sorted((root(i), root(j)), key=lambda k: docs[k][0])
                parent[b] = a
    return [(d, len(s), docs[root(k)][0]) for k, ((d, _), s) in enumerate(zip(docs, sets))]
