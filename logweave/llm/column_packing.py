"""Packing by cutting-stock column generation: sequences of bounded length without padding.

One map-only step encodes the documents, cuts what is longer than a sequence
into full pieces, and ranks the rest of each among the rests of its length in
its partition. The histogram of rest lengths (at most one entry per length)
is what the linear program of :mod:`logweave.llm.cutting_stock` packs: its
rounded patterns say which sequences take how many rests of each length.
A rest finds its sequence and offset from its rank alone, by a table with a
few entries per pattern, so no document is moved to be packed. The few rests
that no pattern takes are cut: laid end to end they fill the gaps of the
patterns, then full sequences, and their end goes to powers of two.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.byte_bpe import ByteBpe, lots
from logweave.llm.common import texts_of, written
from logweave.llm.cutting_stock import Pattern, gap_of, solve
from logweave.llm.wordhash import worker_memo

#: Ranks within a length are below this.
RANKS = 1 << 44
ENCODED = pa.schema([("part", pa.int32()), ("pos", pa.int64()), ("doc_id", pa.int64()), ("doc_tokens", pa.int64()),
                     ("full_at", pa.int64()), ("full_crc32", pa.list_(pa.int64())), ("rest", pa.int32()),
                     ("rank", pa.int64()), ("rest_crc32", pa.int64()), ("rest_ids", pa.binary())])
ENCODED_SQL = ("part int, pos long, doc_id long, doc_tokens long, full_at long, full_crc32 array<long>, rest int,"
               " rank long, rest_crc32 long, rest_ids binary")
PLACED = "part int, pos long, doc_id long, doc_tokens long, rest int, rest_crc32 long, sequence_id long, offset long, cut_at long"
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int) -> DataFrame:
    """Each document's full pieces and its rest (0: none), with the rest's rank in (part, rest)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = worker_memo(tokenizer_path, lambda: ByteBpe(tokenizer_path))
        part, pos, fulls, ranks = TaskContext.get().partitionId(), 0, 0, [0] * capacity
        for rows, texts in lots(batches):
            out = []
            for doc, ids in zip(rows.column("doc_id").to_pylist(), bpe.encode(texts)):
                raw = np.array([*ids, end_id], "<u4").tobytes()
                n, cut = len(raw) // 4, len(raw) // 4 // capacity * 4 * capacity
                full = [zlib.crc32(raw[k:k + 4 * capacity]) for k in range(0, cut, 4 * capacity)]
                rest = n % capacity
                out.append((part, pos, doc, n, fulls, full, rest, ranks[rest], zlib.crc32(raw[cut:]), raw[cut:]))
                ranks[rest] += 1
                pos, fulls = pos + 1, fulls + len(full)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ENCODED)], schema=ENCODED)
    return texts_of(docs).mapInArrow(run, ENCODED_SQL)


@dataclass
class Plan:
    """Where the ranked rests go: arrays with a few entries for each pattern.

    Entry ``k`` holds ranks ``key[k] % RANKS`` up to the next entry of length
    ``key[k] // RANKS``: ``each[k]`` to a sequence from ``sequence[k]`` on, at
    ``offset[k]``; ``each[k] = 0`` marks rests to be cut, whose tokens lie at
    ``sequence[k]`` and on in the stream of those. That stream fills the gaps
    from ``gap_start`` on, then sequences of its own.
    """
    capacity: int
    key: np.ndarray
    each: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    gap_start: np.ndarray
    gap: np.ndarray
    gap_sequence: np.ndarray
    gap_offset: np.ndarray
    stream: int
    sequences: int

    @classmethod
    def of(cls, patterns: list[Pattern], left: np.ndarray, capacity: int) -> Plan:
        entries, gaps = [], []
        taken, first, filled = np.zeros(capacity + 1, np.int64), 0, 0
        for p in patterns:
            at = 0
            for length, count in zip(p.length.tolist(), p.count.tolist()):
                entries.append((length * RANKS + int(taken[length]), count, first, at))
                taken[length] += count * p.times
                at += length * count
            if gap := gap_of(p, capacity):
                gaps.append((filled, gap, first, p.fill))
                filled += gap * p.times
            first += p.times
        gaps.append((filled, capacity, first, 0))  # the sequences after the gaps
        stream = 0
        for length in np.flatnonzero(left).tolist():
            entries.append((length * RANKS + int(taken[length]), 0, stream, 0))
            stream += length * int(left[length])
        entries.sort()
        return cls(capacity, *(np.array(c, np.int64) for c in zip(*entries)) if entries else [np.zeros(0, np.int64)] * 4,
                   *(np.array(c, np.int64) for c in zip(*gaps)), stream, first)

    def place(self, rest: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sequence, offset and -1 of each rest, or -1, -1 and its place in the stream."""
        k = np.searchsorted(self.key, rest * RANKS + rank, "right") - 1
        nth, each = rest * RANKS + rank - self.key[k], self.each[k]
        cut, per = each == 0, np.maximum(each, 1)
        sequence = np.where(cut, -1, self.sequence[k] + nth // per)
        offset = np.where(cut, -1, self.offset[k] + nth % per * rest)
        return sequence, offset, np.where(cut, self.sequence[k] + nth * rest, -1)

    def cut(self, at: int, length: int) -> Iterator[tuple[int, int, int]]:
        """``(length, sequence, offset)`` of the pieces that the stream's tokens ``at..at + length`` fall into."""
        end = at + length
        own = int(self.gap_start[-1])  # from here on sequences of their own
        whole = own + (self.stream - own) // self.capacity * self.capacity
        while at < end:
            if at < whole:
                k = int(np.searchsorted(self.gap_start, at, "right")) - 1
                nth, within = divmod(at - int(self.gap_start[k]), int(self.gap[k]))
                room, sequence, offset = int(self.gap[k]) - within, int(self.gap_sequence[k]) + nth, int(self.gap_offset[k]) + within
            else:  # the last tokens, in powers of two, the largest first
                sequence, offset, room = self.sequences + (whole - own) // self.capacity, at - whole, 0
                for size in (1 << b for b in range(self.capacity.bit_length(), -1, -1)):
                    if (self.stream - whole) & size:
                        if offset < size:
                            room = size - offset
                            break
                        offset, sequence = offset - size, sequence + 1
            n = min(room, end - at)
            yield n, sequence, offset
            at += n


def _plan(histogram: DataFrame, capacity: int) -> Plan:
    """The plan for ``(rest, n)``, at most one row per length; the program is solved in a task of its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        need = np.zeros(capacity + 1, np.int64)
        for b in batches:
            need[b.column("rest").to_numpy()] = b.column("n").to_numpy()
        patterns, left = solve(need, capacity)
        rows = [(k, length, count, p.times) for k, p in enumerate(patterns) for length, count in zip(p.length.tolist(), p.count.tolist())]
        rows += [(-1, length, int(left[length]), 1) for length in np.flatnonzero(left).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], ["pattern", "length", "count", "times"])

    solved = histogram.repartition(1).mapInArrow(run, "pattern long, length long, count long, times long")
    patterns, left = {}, np.zeros(capacity + 1, np.int64)
    for k, length, count, times in solved.collect():
        if k < 0:
            left[length] = count
        else:
            patterns.setdefault(k, ([], [], times))
            patterns[k][0].append(length)
            patterns[k][1].append(count)
    return Plan.of([Pattern(np.array(a), np.array(b), t) for a, b, t in patterns.values()], left, capacity)


def _placed(rows: DataFrame, plan: Plan) -> DataFrame:
    kinds = [f.type for f in ENCODED if f.name in ("part", "pos", "doc_id", "doc_tokens", "rest", "rest_crc32")]
    names = ["part", "pos", "doc_id", "doc_tokens", "rest", "rest_crc32", "sequence_id", "offset", "cut_at"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                found = plan.place(b.column("rest").to_numpy().astype(np.int64), b.column("rank").to_numpy())
                cols = [b.column(n).cast(t) for n, t in zip(names, kinds)] + [pa.array(c, pa.int64()) for c in found]
                yield pa.RecordBatch.from_arrays(cols, names)
    return rows.mapInArrow(run, PLACED)


def _cut(rows: DataFrame, plan: Plan) -> DataFrame:
    fields = [(f.split()[0], pa.int64()) for f in PIECES.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for doc, total, rest, at, raw in zip(*(b.column(c).to_pylist() for c in ("doc_id", "doc_tokens", "rest", "cut_at", "rest_ids"))):
                start = 0
                for n, sequence, offset in plan.cut(at, rest):
                    out.append((doc, total - rest + start, n, zlib.crc32(raw[4 * start:4 * (start + n)]), total, sequence, offset))
                    start += n
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*out), fields)], schema=pa.schema(fields))
    return rows.mapInArrow(run, PIECES)


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 1) -> DataFrame:
    """``(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset)`` of every piece.

    A document is its ids, then ``end_id``. Sequences are filled from 0
    without gaps, to ``capacity`` or to a power of two. Null and empty texts
    are one piece with the end id. Repeated rows repeat, a null id stays
    null, other columns are ignored, an empty table gives no rows.
    """
    rows = written(encoded(docs, tokenizer_path, capacity, end_id), "encoded")
    rests = rows.where("rest > 0")
    # ranks of a length in one partition, moved behind those of the partitions before
    counts = written(rests.groupBy("rest", "part").agg(F.count(F.lit(1)).alias("n")), "rest-counts")
    before = Window.partitionBy("rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = counts.select("rest", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    plan = _plan(counts.groupBy("rest").agg(F.sum("n").alias("n")), capacity)
    slim = rests.select("part", "pos", "doc_id", "doc_tokens", "rest", "rank", "rest_crc32")
    ranked = slim.join(base, ["rest", "part"]).withColumn("rank", F.col("rank") + F.col("base")).drop("base")
    placed = written(_placed(ranked, plan), "placed")
    full = rows.select("*", F.posexplode("full_crc32").alias("nth", "ids_crc32")).select(
        "doc_id", (F.col("nth").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"),
        "ids_crc32", "doc_tokens", (-1 - F.col("part") * F.lit(1 << 36) - F.col("full_at") - F.col("nth")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"))
    whole = placed.where("cut_at < 0").select(
        "doc_id", (F.col("doc_tokens") - F.col("rest")).alias("start"), F.col("rest").cast("long").alias("length"),
        F.col("rest_crc32").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
    donors = placed.where("cut_at >= 0").select("part", "pos", "doc_id", "doc_tokens", "rest", "cut_at")
    cut = _cut(donors.join(rows.select("part", "pos", "rest_ids"), ["part", "pos"]), plan)
    return full.unionByName(whole).unionByName(cut)


def query(spark, sf_dir: str) -> DataFrame:
    """op13: every document packed into sequences of 2048 tokens, or of a power of two, without padding."""
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"), 2048)
