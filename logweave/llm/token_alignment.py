"""Alignment of two tokenizers by whitespace-token anchors.

Every text is tokenised in full by both tokenizers, and both token sequences
are verified to spell the same bytes. Byte offsets where a token of each
starts with a space, so that a token of each ends just before, split a
document into windows of token ids. Windows repeat like words do: one is
aligned once per worker and remembered by its two id tuples. A document is
then a row of window numbers, and its groups, links and pair counts are
gathered from the windows' own.

How many documents hold a pair linked is counted over all documents, with
counts combined in each task. The count table is read in blocks of bounded
size: each pass adds one block's share to every document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from logweave.llm.byte_bpe import ByteBpe, lots
from logweave.llm.common import removed, scratch_path, texts_of
from logweave.llm.wordhash import worker_memo

#: Windows that a Python worker remembers, and the longest that it does (tokens of both).
MEMO_WINDOWS, MEMO_LENGTH = 400_000, 128
#: Different pairs that a task counts before it sends them on, and pairs of one block of the count table.
TASK_PAIRS, BLOCK_PAIRS = 2_000_000, 4_000_000


class PieceBpe:
    """Ids and token bytes of a sentencepiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.sp.get_piece_size()
        pieces = [self.sp.id_to_piece(i) for i in range(n)]
        self.bytes_of = [bytes([int(p[3:5], 16)]) if self.sp.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.sp.encode(texts, num_threads=1, add_bos=False, add_eos=False)


#: One aligned window: its groups as text, their number, and its links as 64-bit codes in bytes. A plain tuple
#: without references to containers, which the garbage collector need not walk.
Aligned = tuple[str, int, bytes]
#: Marks the second tokenizer's ids in a window's key, which is the first's ids, then the second's.
SECOND = 1 << 31


def _gathered(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Places ``start[k] .. start[k] + n[k] - 1`` of every ``k``, one after another."""
    return np.repeat(start - np.cumsum(n) + n, n) + np.arange(int(n.sum()))


class Aligner:
    """Both tokenizers and the windows seen so far."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteBpe(path_a, plain_specials=True), PieceBpe(path_b)
        self.len_a, self.len_b = (np.array([len(t) for t in x.bytes_of]) for x in (self.a, self.b))
        self.marked = np.array([f"{i}{mark}" for size, marks in ((len(self.len_a), ",|"), (len(self.len_b), ",;")) for mark in marks
                                for i in range(size)], object)
        self.space_a, self.space_b = (np.array([t.startswith(b" ") for t in x.bytes_of]) for x in (self.a, self.b))
        self.width = len(self.len_b)
        self.memo: dict[bytes, Aligned] = {}

    def tokens(self, texts: list[str]) -> tuple[list, list]:
        """Ids of both for each text; none where the text is empty or a joined form differs from it."""
        whole = [" " + t for t in texts]
        a, b = self.a.encode(whole), self.b.encode(texts)
        for k, text in enumerate(whole):
            raw = text.encode()
            if len(raw) == 1 or any(b"".join(map(of.__getitem__, ids)) != raw for of, ids in ((self.a.bytes_of, a[k]), (self.b.bytes_of, b[k]))):
                a[k], b[k] = [], []
        return a, b

    def windows(self, keys: list[bytes]) -> list[Aligned]:
        """Every window's alignment; those not remembered are aligned together."""
        found = [self.memo.get(k) for k in keys]
        new = [k for k, f in zip(keys, found) if f is None]
        if new:
            fresh = iter(self.aligned(new))
            found = [next(fresh) if f is None else f for f in found]
            if len(self.memo) + len(new) > MEMO_WINDOWS:
                self.memo.clear()
            self.memo.update((k, f) for k, f in zip(keys, found) if len(k) <= 4 * MEMO_LENGTH)
        return found

    def aligned(self, keys: list[bytes]) -> list[Aligned]:
        """Groups and links of windows, each two id sequences that spell the same bytes, laid end to end."""
        ids = np.frombuffer(b"".join(keys), "<u4").astype(np.int64)
        n = np.fromiter(map(len, keys), np.int64, len(keys)) // 4
        second = ids >= SECOND
        ids_a, ids_b = ids[~second], ids[second] - SECOND
        n_b = np.diff(np.append(0, np.cumsum(second))[np.append(0, np.cumsum(n))])
        n_a = n - n_b
        end_a, end_b = np.cumsum(self.len_a[ids_a]), np.cumsum(self.len_b[ids_b])
        # the second's tokens that overlap each of the first's
        low = np.searchsorted(end_b, end_a - self.len_a[ids_a], "right")
        n = np.searchsorted(end_b - self.len_b[ids_b], end_a) - low
        codes = np.repeat(ids_a, n) * self.width + ids_b[_gathered(low, n)]
        borders_a = np.cumsum(n_a)
        cut = (8 * np.append(0, np.cumsum(n)[borders_a - 1])).tolist()
        shared = np.intersect1d(end_a, end_b, assume_unique=True)
        # ids in the order of the text: a group's of the first, then of the second, each with the mark after it
        side = np.concatenate([2 * np.searchsorted(shared, end_a), 2 * np.searchsorted(shared, end_b) + 1])
        order = np.argsort(side, kind="stable")
        last = np.append(side[order][1:] != side[order][:-1], True)
        entry = np.concatenate([ids_a, ids_b + 2 * len(self.len_a)])[order]
        entry[last] += np.where(side[order][last] % 2 == 0, len(self.len_a), len(self.len_b))
        marked = self.marked[entry].tolist()
        ends = np.cumsum(n_a + n_b).tolist()
        groups = np.diff(np.searchsorted(shared, end_a[borders_a - 1], "right"), prepend=0).tolist()
        raw = codes.astype("<i8").tobytes()
        return [("".join(marked[s:e])[:-1], g, raw[p:q]) for s, e, g, p, q in zip([0, *ends], ends, groups, cut, cut[1:])]

    def align(self, texts: list[str]) -> list[tuple]:
        """``(n_a, n_b, n_groups, n_links, groups_sha256, codes, times)`` of each text; codes are its different pairs."""
        a, b = self.tokens(texts)
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        ids_a, ids_b = (np.fromiter(chain.from_iterable(x), "u4", int(n.sum())) for x, n in ((a, n_a), (b, n_b)))
        del a, b
        # all texts end to end: both tokenizers' bytes are the same there
        start_a, start_b = (np.cumsum(size[ids]) - size[ids] for size, ids in ((self.len_a, ids_a), (self.len_b, ids_b)))
        there = n_a > 0
        first_a, first_b = (np.cumsum(n) - n for n in (n_a, n_b))
        anchors = np.intersect1d(start_a[self.space_a[ids_a]], start_b[self.space_b[ids_b]], assume_unique=True)
        borders = np.union1d(anchors, start_a[first_a[there]]) if there.any() else anchors
        cut_a = np.append(np.searchsorted(start_a, borders), len(ids_a))
        cut_b = np.append(np.searchsorted(start_b, borders), len(ids_b))
        both = np.empty(len(ids_a) + len(ids_b), "<u4")  # each window's ids of the first, then of the second
        both[np.arange(len(ids_a)) + np.repeat(cut_b[:-1], np.diff(cut_a))] = ids_a
        both[np.arange(len(ids_b)) + np.repeat(cut_a[1:], np.diff(cut_b))] = ids_b + np.uint32(SECOND)
        raw, cuts, number = both.tobytes(), (4 * (cut_a + cut_b)).tolist(), {}
        which = np.fromiter((number.setdefault(raw[s:e], len(number)) for s, e in zip(cuts, cuts[1:])), np.int64, len(borders))
        windows = self.windows(list(number))
        text, groups, own_codes = zip(*windows) if windows else ((), (), ())
        groups = np.array(groups, np.int64)
        links = np.fromiter(map(len, own_codes), np.int64, len(windows)) // 8
        codes = np.frombuffer(b"".join(own_codes), "<i8")
        at = np.cumsum(links) - links
        n_windows = np.zeros(len(texts), np.int64)
        if there.any():
            n_windows[there] = np.diff(np.append(np.searchsorted(borders, start_a[first_a[there]]), len(borders)))
        out, s = [], 0
        for k, n in enumerate(n_windows.tolist()):
            own = which[s:s + n]
            s += n
            if not n:
                out.append((0, 0, 0, 0, "", b"", b""))
                continue
            size = links[own]
            all_codes = codes[_gathered(at[own], size)]
            distinct, times = np.unique(all_codes, return_counts=True)
            sha = hashlib.sha256(";".join([text[w] for w in own.tolist()]).encode()).hexdigest()
            out.append((int(n_a[k]), int(n_b[k]), int(groups[own].sum()), len(all_codes), sha,
                        packed(distinct), times.astype("<u4").tobytes()))
        return out


def packed(codes: np.ndarray) -> bytes:
    """Sorted codes as their differences: small numbers in eight bytes, which Parquet's compression makes short."""
    return np.diff(codes, prepend=0).astype("<i8").tobytes()


def unpacked(raw: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, "<i8"))


STATS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
SUMS = "n_best long, count_sum long"
_STATS = {"doc_id": pa.int64(), "n_a": pa.int64(), "n_b": pa.int64(), "n_groups": pa.int64(), "n_links": pa.int64(), "groups_sha256": pa.string()}


def _aligned(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    kinds = [*_STATS.values(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = worker_memo(f"{path_a} {path_b}", lambda: Aligner(path_a, path_b))
        for rows, texts in lots(batches):
            cols = [rows.column("doc_id").cast(pa.int64()), *zip(*aligner.align(texts))]
            yield pa.RecordBatch.from_arrays([c if k == 0 else pa.array(c, t) for k, (c, t) in enumerate(zip(cols, kinds))],
                                             [*_STATS, "codes", "times"])
    return texts_of(docs).mapInArrow(run, f"{STATS}, codes binary, times binary")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of the task that hold each code, as ``(code, n)``."""
    codes, counts, held, size = np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def merged():
        both = np.concatenate([codes, *held])
        n = np.concatenate([counts, np.ones(len(both) - len(codes), np.int64)])
        found, place = np.unique(both, return_inverse=True)
        return found, np.bincount(place, n, len(found)).astype(np.int64)

    def sent():
        for k in range(0, len(codes), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[k:k + 100_000]) for x in (codes, counts)], ["code", "n"])

    for b in batches:
        for raw in b.column("codes").to_pylist():
            held.append(unpacked(raw))
            size += len(held[-1])
            if size >= TASK_PAIRS:
                codes, counts = merged()
                held, size = [], 0
                if len(codes) >= TASK_PAIRS:
                    yield from sent()
                    codes, counts = codes[:0], counts[:0]
    codes, counts = merged()
    yield from sent()


def _added(block, last: bool, names: list[str]):
    """Add to each document what its links find in one block of ``(code, count, best)``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, counts, best = block.value
        for b in batches:
            n_best, total = [], []
            for raw, times in zip(b.column("codes").to_pylist(), b.column("times").to_pylist()):
                own = unpacked(raw)
                at = np.minimum(np.searchsorted(codes, own), max(len(codes) - 1, 0))
                ok = codes[at] == own if len(codes) else np.zeros(len(own), bool)
                n, at = np.frombuffer(times, "<u4")[ok].astype(np.int64), at[ok]
                n_best.append(int(n[best[at]].sum()))
                total.append(int(n @ counts[at]))
            sums = [pa.array(np.array(new, np.int64) + b.column(c).to_numpy(), pa.int64()) for c, new in (("n_best", n_best), ("count_sum", total))]
            rest = [] if last else [b.column("codes"), b.column("times")]
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in _STATS), *sums, *rest], names)
    return run


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _blocks(sizes: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Ranges of first ids with at most about BLOCK_PAIRS pairs (an id alone has as many as the other vocabulary)."""
    out, low, held = [], 0, 0
    for i, n in sorted(sizes):
        if held and held + n > BLOCK_PAIRS:
            out.append((low, i))
            low, held = i, 0
        held += n
    return [*out, (low, 1 << 31)]


def align_tokens(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)``, one row per input row.

    ``path_a`` is a byte-level BPE file, ``path_b`` a sentencepiece model.
    Texts that are null, empty, or not the joined bytes of either's tokens
    have no tokens: zeros and ''. Repeated rows repeat and count as documents
    each, a null id stays null, other columns are ignored, an empty table
    gives no rows.
    """
    sc = docs.sparkSession.sparkContext
    rows = _written(_aligned(docs, path_a, path_b), "aligned")
    pairs = rows.where("n_links > 0").select("codes").mapInArrow(_counted, "code long, n long")
    width = PieceBpe(path_b).sp.get_piece_size()
    counts = pairs.groupBy("code").agg(F.sum("n").alias("n")).withColumn("a", F.expr(f"code div {width}"))
    highest = F.max("n").over(Window.partitionBy("a"))  # an id has at most as many rows as the other vocabulary
    counts = _written(counts.select("a", "code", "n", (F.col("n") == highest).alias("best")), "pair-counts")
    blocks = _blocks([tuple(r) for r in counts.groupBy("a").count().collect()])  # at most one row per vocabulary entry
    rows_now = rows.withColumns({"n_best": F.lit(0).cast("long"), "count_sum": F.lit(0).cast("long")})
    held = None
    for k, (low, high) in enumerate(blocks):
        last = k == len(blocks) - 1
        got = counts.where((F.col("a") >= low) & (F.col("a") < high)).select("code", "n", "best").toArrow().sort_by("code")
        block = sc.broadcast(tuple(got.column(c).to_numpy() for c in ("code", "n", "best")))
        kinds = f"{STATS}, {SUMS}" + ("" if last else ", codes binary, times binary")
        names = [f.split()[0] for f in kinds.split(", ")]
        rows_now = rows_now.mapInArrow(_added(block, last, names), kinds)
        if not last:
            rows_now = _written(rows_now, f"aligned-{k}")
            block.destroy()
            removed(held or rows)
            held = rows_now
    return rows_now.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def query(spark, sf_dir: str) -> DataFrame:
    """op11: every document's tokens of the byte-level and the piece vocabulary, aligned."""
    import public_tokenizers

    return align_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                        public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def brute_force(docs: list[tuple], path_a: str, path_b: str) -> list[tuple]:
    """The same rows by byte ranges of single tokens, without windows or a memory, for tests."""
    a, b = ByteBpe(path_a, plain_specials=True), PieceBpe(path_b)
    rows, holders = [], {}
    for doc, text in docs:
        raw = (" " + (text or "")).encode()
        ids_a = [e for e in a.tok.encode(raw.decode(), add_special_tokens=False).ids] if text else []
        ids_b = b.encode([text])[0] if text else []
        if any(b"".join(x.bytes_of[i] for i in ids) != raw for x, ids in ((a, ids_a), (b, ids_b))):
            ids_a, ids_b = [], []
        spans = []
        for x, ids in ((a, ids_a), (b, ids_b)):
            at, own = 0, []
            for i in ids:
                own.append((at, at + len(x.bytes_of[i]), i))
                at = own[-1][1]
            spans.append(own)
        links = [(i, j) for s, e, i in spans[0] for p, q, j in spans[1] if s < q and p < e]
        borders = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for end in borders:
            groups.append("|".join(",".join(str(i) for s, e, i in own if low <= s and e <= end) for own in spans))
            low = end
        for pair in set(links):
            holders[pair] = holders.get(pair, 0) + 1
        rows.append((doc, ids_a, ids_b, groups, links))
    top = {}
    for (i, _), n in holders.items():
        top[i] = max(top.get(i, 0), n)
    return [(doc, len(x), len(y), len(groups), len(links), sum(holders[p] == top[p[0]] for p in links), sum(holders[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc, x, y, groups, links in rows]
