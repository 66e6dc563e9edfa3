"""Benchmark decontamination with an FM-index per training shard.

Each task indexes shards of its documents (about ``SHARD_WORDS`` words) and
searches all benchmark windows in the index at once: backward search through
wavelet-tree ranks, positions by sampled suffixes, spans merged per document.
The index's alphabet is the benchmark's words; every other word is a
separator, which no window can cross, and stretches shorter than the
shortest window are left out, as no window fits into them.

A Spark job cuts the benchmark into its distinct windows with their items,
numbers them by a running count and writes them; the driver only ever holds
one block of bounded size. A block is broadcast and searched in one map-only
step, and each step adds to the spans and items that the rows carry. No
document is shuffled. After every ``CHAIN`` blocks the rows are written and
those blocks' broadcasts end, so what is broadcast at once does not grow with
the benchmark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import removed, texts_of, written
from logweave.llm.fm_index import FMIndex

#: Words of a shard that one index covers.
SHARD_WORDS = 4_000_000
#: Windows of one broadcast block (an item has about as many as words), and blocks that are broadcast at once.
BLOCK_WORDS, CHAIN = 500_000, 4
#: Windows that are sent on together.
WINDOW_ROWS = 10_000

#: Bytes of a text -> itself where it belongs to a word, A-Z lower-cased, else a space.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a UTF-8 text after lower-casing A-Z."""
    return text.translate(WORD_BYTES).split() if text else []


class Block:
    """Distinct windows, as right-aligned rows of symbols, with the items of each, from pairs of window and item."""

    def __init__(self, pairs: Iterable[tuple[bytes, str]], width: int):
        windows: dict[tuple[bytes, ...], set[str]] = {}
        for window, item in pairs:
            windows.setdefault(tuple(window.split(b" ")), set()).add(item)
        self.symbols = {w: k for k, w in enumerate(sorted({w for x in windows for w in x}), 1)}
        self.lengths = np.array([len(x) for x in windows], np.int64)
        self.patterns = np.zeros((len(windows), width), np.int64)
        for k, x in enumerate(windows):
            self.patterns[k, width - len(x):] = [self.symbols[w] for w in x]
        self.items = [sorted(x) for x in windows.values()]
        self.shortest = int(self.lengths.min(initial=width))

    def hits(self, shard: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """``(document, start, end, window)`` of every occurrence in a shard's symbol arrays."""
        parts, owner, places = [], [], []
        for d, symbols in enumerate(shard):
            known = np.flatnonzero(np.diff(np.concatenate(([0], symbols > 0, [0])).astype(np.int8)))
            for s, e in known.reshape(-1, 2):
                if e - s >= self.shortest:
                    parts += [symbols[s:e], [0]]
                    owner.append(np.full(e - s + 1, d))
                    places.append(np.arange(s, e + 1))
        if not parts:
            return
        index = FMIndex(np.concatenate(parts).astype(np.int64), len(self.symbols) + 1)
        low, high = index.search(self.patterns, self.lengths)
        found = np.flatnonzero(high > low)
        counts = (high - low)[found]
        window = np.repeat(found, counts)
        rows = np.repeat(low[found], counts) + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        at = index.locate(rows)
        doc, start = np.concatenate(owner)[at], np.concatenate(places)[at]
        yield from zip(doc.tolist(), start.tolist(), (start + self.lengths[window]).tolist(), window.tolist())


def windows_of(benchmark: DataFrame, width: int) -> DataFrame:
    """Distinct ``(item, window)``: the item's id as a string (null: empty) and its words joined by a space, as binary.

    An item of fewer than ``width`` words, but not none, is one window.
    """
    kinds = [("item", pa.string()), ("window", pa.binary())]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist()):
                words = words_of(text)
                n = max(1, len(words) - width + 1) if words else 0
                for s in range(0, n, WINDOW_ROWS):
                    rows = [b" ".join(words[i:i + width]) for i in range(s, min(n, s + WINDOW_ROWS))]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(rows), pa.string()), pa.array(rows, pa.binary())],
                                                     [c for c, _ in kinds])

    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(cut, "item string, window binary").distinct()


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their task and their place in it."""
    task, n = TaskContext.get().partitionId(), 0
    for b in batches:
        yield pa.RecordBatch.from_arrays(
            [*b.columns, pa.array([task] * b.num_rows, pa.int32()), pa.array(range(n, n + b.num_rows), pa.int64())], [*b.schema.names, "task", "n"])
        n += b.num_rows


def blocks(benchmark: DataFrame, width: int) -> Iterator[Block]:
    """The benchmark's windows in blocks of at most ``BLOCK_WORDS``; the driver holds one at a time.

    Windows of an item stay together where they can, so a block has few
    different words. A window that many items hold may be in several blocks,
    each with other items.
    """
    rows = windows_of(benchmark, width).repartitionByRange("item", "window").sortWithinPartitions("item", "window")
    table = written(rows.mapInArrow(_numbered, "item string, window binary, task int, n long"), "benchmark-windows")
    sizes = sorted(tuple(r) for r in table.groupBy("task").count().collect())  # a row for each task
    for k in range(-(-sum(n for _, n in sizes) // BLOCK_WORDS)):
        low, high, before, wanted = k * BLOCK_WORDS, (k + 1) * BLOCK_WORDS, 0, F.lit(False)
        for task, n in sizes:
            if before < high and low < before + n:
                wanted |= (F.col("task") == task) & F.col("n").between(low - before, high - before - 1)
            before += n
        got = table.where(wanted).select("window", "item").toArrow()
        yield Block(zip(got["window"].to_pylist(), got["item"].to_pylist()), width)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Union of half-open spans, in order."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = out[-1][0], max(e, out[-1][1])
        else:
            out.append((s, e))
    return out


SPANS = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", SPANS),
                      T.StructField("items", T.ArrayType(T.StringType()))])


def _step(sent, carry_text: bool, cut: bool = False):
    """One block's search; the last one may cut the spans out of the text at once, in the same Python worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: Block = sent.value
        get, held, shard, n = block.symbols.get, [], [], 0

        def answer():
            old = [r or {"spans": [], "items": []} for b in held for r in b.column("found").to_pylist()]
            spans = [[(x["start"], x["end"]) for x in r["spans"]] for r in old]
            items = [set(r["items"]) for r in old]
            for d, s, e, w in block.hits(shard):
                spans[d].append((s, e))
                items[d].update(block.items[w])
            k = 0
            for b in held:
                if cut:
                    yield _cut(b, [merged(spans[i]) for i in range(k, k + b.num_rows)])
                    k += b.num_rows
                    continue
                rows = [{"n_words": len(shard[i]), "spans": [{"start": s, "end": e} for s, e in merged(spans[i])],
                         "items": sorted(items[i])} for i in range(k, k + b.num_rows)]
                k += b.num_rows
                names = ["row", "text", "found"] if carry_text else ["row", "found"]
                cols = {"row": b.column("row"), "text": b.column("text"),
                        "found": pa.array(rows, b.schema.field("found").type)}
                yield pa.RecordBatch.from_arrays([cols[c] for c in names], names)

        for b in batches:
            held.append(b)
            for text in b.column("text").to_pylist():
                words = words_of(text)
                shard.append(np.fromiter(map(get, words, repeat(0)), np.int32, len(words)))
                n += len(words)
            if n >= SHARD_WORDS:
                yield from answer()
                held, shard, n = [], [], 0
        yield from answer()
    return run


def find_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10, carry_text: bool = False) -> DataFrame:
    """Struct ``row`` (the columns of ``docs`` but ``text``) and struct ``found``: ``n_words``, ``spans``, ``items``.

    A window is ``width`` consecutive words of an item, or all words of a
    shorter one; an item without words has none. ``spans`` are the merged
    word spans of all occurrences, ``items`` the ids (as strings, a null id
    as the empty string) of items with an occurring window. Every input row
    gives one row: null and empty texts have no words, repeated rows repeat,
    empty tables give no rows or no spans, other columns are kept inside
    ``row`` under any names. ``carry_text`` adds the text as binary ``text``.
    """
    out, last = _searched(docs, benchmark, width)
    kind = T.StructType([f for f in out.schema if carry_text or f.name != "text"])
    return out.mapInArrow(_step(last, carry_text), kind)


def _searched(docs: DataFrame, benchmark: DataFrame, width: int):
    """The rows as the search takes them after all blocks but the last, and the last one's broadcast (an empty block, if there is none)."""
    sc = docs.sparkSession.sparkContext
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    out = docs.select(rest.alias("row"), F.col("text").cast("string").cast("binary").alias("text"),
                      F.lit(None).cast(FOUND).alias("found"))
    sent, held = [], None
    for block in blocks(benchmark, width):
        if sent:
            out = out.mapInArrow(_step(sent[-1], True), out.schema)
        if len(sent) == CHAIN:
            out = written(out, "searched")
            for x in sent:
                x.destroy()
            if held is not None:
                removed(held)
            sent, held = [], out
        sent.append(sc.broadcast(block))
    return out, sent[-1] if sent else sc.broadcast(Block([], width))


def cut_spans(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """``text`` without what lies between the first and the last word of each span of words."""
    ends, at = [], 0
    mask = text.translate(WORD_BYTES)
    for w in mask.split():
        at = mask.index(w, at)
        ends.append((at, at + len(w)))
        at += len(w)
    out, at = [], 0
    for s, e in spans:
        out.append(text[at:ends[s][0]])
        at = ends[e - 1][1]
    return b"".join([*out, text[at:]])


def _cut(b: pa.RecordBatch, spans: list[list[tuple[int, int]]]) -> pa.RecordBatch:
    texts = [cut_spans(t, x) if x else t for t, x in zip(b.column("text").to_pylist(), spans)]
    return pa.RecordBatch.from_arrays([b.column("row"), pa.array(texts, pa.binary()).cast(pa.string())], ["row", "text"])


def remove_contamination(docs: DataFrame, benchmark: DataFrame, width: int = 10) -> DataFrame:
    """``docs`` with its columns, each hit span taken out of ``text`` (first to last word).

    Texts without a hit stay as they are, null stays null. ``n_chars``,
    where present, follows the new text.
    """
    out, last = _searched(docs, benchmark, width)
    out = out.mapInArrow(_step(last, False, True), T.StructType([out.schema["row"], T.StructField("text", T.StringType())]))
    return out.select(*[
        F.col("text") if c == "text" else
        F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else
        F.col(f"row.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op9: hit words and items per document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_contamination(texts_of(docs), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    n_hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, x: n + (x["end"] - x["start"]))
    return found.select(
        "row.doc_id", "found.n_words", n_hit.alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.sort_array("found.items"), ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"))


def brute_force(docs: list[tuple], items: list[tuple], width: int = 10) -> list[tuple]:
    """The contract's rows computed the plain way, for tests."""
    windows: dict[tuple, set[str]] = {}
    for item, text in items:
        words = words_of(text.encode() if text else None)
        for i in range(max(1, len(words) - width + 1) if words else 0):
            windows.setdefault(tuple(words[i:i + width]), set()).add("" if item is None else str(item))
    out = []
    for doc, text in docs:
        words, hit, names = words_of(text.encode() if text else None), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(words) - n + 1):
                if got := windows.get(tuple(words[i:i + n])):
                    hit.update(range(i, i + n))
                    names |= got
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc, len(words), len(hit), len(names), digest, bool(hit)))
    return out
