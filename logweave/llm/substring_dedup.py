"""Substring dedup by difference-cover anchors.

A window is 13 consecutive words; a window goes when its words also start in
a document with a smaller id. The residues {0, 1, 3} are a difference cover
modulo 7: whatever the places of two equal runs of words, within seven steps
both are at cover places. So two equal windows of 13 words share an anchor,
7 words hashed at a cover place of both, and only 3 of 7 places are hashed
and shuffled.

1. Anchors. Each task combines its own: a hash gives one row per chunk of
   documents, however many of them hold it; what a chunk shares within
   itself is known to be shared. Runs of equal hashes are then streamed in
   sorted partitions.
2. Extension. Documents meet their shared anchors, and the windows that hold
   one are hashed in full (95 bits). They are combined and streamed in the
   same way, and all but the smallest document's windows are covered.
3. Documents meet their covered windows; the text shuffle of step 2 serves
   again.

A row is named by a 64-bit hash of its id and text, so texts that share an id
are never mixed, and a group of the joins is never larger than one text.
Exact copies of a smaller document are settled before by a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import text_key, texts_of, written
from logweave.llm.wordhash import WordHashes, coded_words, mix, window_hashes

WINDOW = 13
#: A difference cover: every difference modulo PERIOD is one of two of its members.
PERIOD, COVER = 7, (0, 1, 3)
ANCHOR = WINDOW - PERIOD + 1
#: Words that a task combines at once.
CHUNK_WORDS = 2_000_000
#: Stands for a null id, which is smaller than every other.
NO_ID = -(1 << 63)
POSTING = "h long, row long, at long, sure boolean"
NAMES = ["h", "row", "at", "sure"]
#: Postings of whole windows carry the document's id too.
WINDOWS = POSTING + ", id long"
WINDOW_NAMES = [*NAMES, "id"]
#: The place that says: a copy of a smaller document.
COPY = -1
#: Bit of a place whose hash the document holds again.
REPEATED = 40
#: Rows of a batch that are taken together.
SLICE_ROWS = 2000
#: Kept from task to task by a Python worker.
_hashes = WordHashes()
#: Stands for all places of a text, and the bit of a start whose window the text holds again.
ALL = (1 << 31) - 1
MARK = 31
#: Bits of a window's start and mark; its second hash lies above them.
PLACE_BITS = 32


def _rows(h, rows, at, sure: bool, ids=None) -> pa.RecordBatch:
    columns = [h, rows, at] if ids is None else [h, rows, at, ids]
    columns = [pa.array(x, pa.int64()) for x in columns]
    columns.insert(3, pa.array(np.full(len(h), sure), pa.bool_()))
    return pa.RecordBatch.from_arrays(columns, NAMES if ids is None else WINDOW_NAMES)


def _scattered(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Keys that spread rows which need no partner over all partitions."""
    return (rows * np.int64(0x5851F42D4C957F2D) + at).view(np.int64)


def _groups(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by hash (stable), starts of the runs of equal hashes in it, and the run of each place."""
    order = np.argsort(h, kind="stable")
    new = np.append(True, h[order][1:] != h[order][:-1]) if len(h) else np.zeros(0, bool)
    return order, np.flatnonzero(new), np.cumsum(new) - 1


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with the hashes of all their words and how many each row has."""
    for b in batches:
        for k in range(0, b.num_rows, SLICE_ROWS):
            part = b.slice(k, SLICE_ROWS)
            yield part, *coded_words(part.column("text"), _hashes, np.uint64)


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, n = [], 0

    def combined():
        h, rows, at = (np.concatenate([p[k] for p in parts]) for k in range(3))
        order, starts, run = _groups(h)
        # a document's further places of a hash are found again by the first, which is marked
        by_doc = np.append(True, (run[1:] != run[:-1]) | (rows[order][1:] != rows[order][:-1]))
        firsts = order[by_doc]
        again = np.diff(np.append(np.flatnonzero(by_doc), len(order))) > 1
        run, doc = run[by_doc], rows[firsts]
        holders = np.bincount(run)
        shared = holders[run] > 1
        place = at[firsts] | again.astype(np.int64) << REPEATED
        back = np.argsort(firsts, kind="stable")  # in the order of documents again: it compresses
        firsts, doc, place, shared = firsts[back], doc[back], place[back], shared[back]
        alone = ~shared
        yield _rows(h[firsts][alone], doc[alone], place[alone], False)
        # what the chunk shares within itself: places that need no partner, and one notice per hash
        yield _rows(_scattered(doc, place)[shared], doc[shared], place[shared], True)
        notice = order[starts[holders > 1]]
        yield _rows(h[notice], rows[notice], at[notice], True)

    for b, words, sizes in _hashed(batches):
        ends = np.cumsum(sizes)
        at = np.arange(len(words)) - np.repeat(ends - sizes, sizes)
        size = np.repeat(sizes, sizes)
        good = np.flatnonzero((size >= WINDOW) & (at <= size - ANCHOR) & np.isin(at % PERIOD, COVER))
        h = window_hashes(words, ANCHOR)[good] & np.uint64((1 << 48) - 1) if len(good) else np.zeros(0, np.uint64)
        rows = np.repeat(b.column("row").to_numpy(), sizes)[good]
        parts.append((h.astype(np.int64), rows, at[good]))  # 48 bits: a filter only, and zero bytes compress
        n += len(words)
        if n >= CHUNK_WORDS:
            yield from combined()
            parts, n = [], 0
    if n:
        yield from combined()


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[list[np.ndarray]]:
    """Sorted batches as numpy columns, no run of equal ``h`` cut in two."""
    held = None
    for b in batches:
        now = [b.column(c).to_numpy(zero_copy_only=False) for c in columns]
        if held is not None:
            now = [np.concatenate(x) for x in zip(held, now)]
        if not len(now[0]):
            continue
        cut = int(np.searchsorted(now[0], now[0][-1]))
        held = [x[cut:] for x in now]
        if cut:
            yield [x[:cut] for x in now]
    if held is not None and len(held[0]):
        yield held


def _shared_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted postings, the places whose hash more than one row holds."""
    for h, rows, at, sure in _runs(batches, NAMES):
        _, starts, run = _groups(h)
        good = np.zeros(len(starts), bool)
        np.logical_or.at(good, run, sure | (rows != rows[starts][run]))
        keep = good[run]
        yield pa.RecordBatch.from_arrays([pa.array(rows[keep], pa.int64()), pa.array(at[keep], pa.int64())], ["row", "at"])


def _checks(words: np.ndarray) -> np.ndarray:
    """A second hash (31 bits) of each window, independent of the first."""
    n = max(0, len(words) - WINDOW + 1)
    total = np.zeros(n, np.uint64)
    for k in range(WINDOW):
        total += words[k:k + n] * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x2545F4914F6CDD1D & (1 << 64) - 1)
    return (mix(total) >> np.uint64(33)).astype(np.int64)


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full hashes of the windows that hold a shared anchor; copies are covered whole."""
    parts, whole, n = [], [], 0

    def combined():
        if whole:
            ids, rows = (np.array(x, np.int64) for x in zip(*whole))
            at = np.full(len(ids), ALL, np.int64)
            yield _rows(_scattered(rows, at), rows, at, True, ids)
        if not parts:
            return
        h, ids, rows, at = (np.concatenate([p[k] for p in parts]) for k in range(4))
        check = at >> PLACE_BITS
        order = np.lexsort((rows, ids, check, h))
        h, ids, rows, at, check = h[order], ids[order], rows[order], at[order], check[order]
        new = np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1]))
        least = ids[np.flatnonzero(new)][np.cumsum(new) - 1]
        later = ids > least
        # a text's further places of a window are found again by the first, which is marked
        first = new | np.append(True, rows[1:] != rows[:-1])
        again = np.diff(np.append(np.flatnonzero(first), len(h))) > 1
        order, h, ids, rows, at, later = (x[first] for x in (order, h, ids, rows, at, later))
        at = at | again.astype(np.int64) << MARK
        back = np.argsort(order, kind="stable")  # in the order of documents again: it compresses
        h, ids, rows, at, later = (x[back] for x in (h, ids, rows, at, later))
        yield _rows(h[~later], rows[~later], at[~later], False, ids[~later])
        yield _rows(_scattered(rows[later], at[later]), rows[later], at[later], True, ids[later])

    for b, hashed, sizes in _hashed(batches):
        ends = np.cumsum(sizes)
        found = []
        for ident, row, places, s, e in zip(*(b.column(c).to_pylist() for c in ("id", "row", "places")), ends - sizes, ends):
            size, places = e - s, np.array(places, np.int64)
            if size < WINDOW:
                continue
            if (places == COPY).any():
                whole.append((ident, row))
                continue
            marked, places = places >> REPEATED > 0, places & (1 << REPEATED) - 1
            inside = places <= size - ANCHOR
            marked, places = marked[inside], places[inside]
            if marked.any():
                anchors = window_hashes(hashed[s:e], ANCHOR)
                places = np.append(places, np.flatnonzero(np.isin(anchors, anchors[places[marked]])))
            n_windows = size - WINDOW + 1
            flags = np.zeros(n_windows + WINDOW, np.int32)
            np.add.at(flags, np.maximum(places - (WINDOW - ANCHOR), 0), 1)
            np.add.at(flags, np.minimum(places + 1, n_windows), -1)
            starts = np.flatnonzero(np.cumsum(flags)[:n_windows] > 0)
            if len(starts):
                found.append((ident, row, s, starts))
        if found:
            starts = np.concatenate([x[3] for x in found])
            at = starts + np.repeat([s for _, _, s, _ in found], [len(x[3]) for x in found])
            ids, rows = (np.repeat(np.array([x[k] for x in found], np.int64), [len(x[3]) for x in found]) for k in (0, 1))
            parts.append((window_hashes(hashed, WINDOW)[at].view(np.int64), ids, rows, _checks(hashed)[at] << PLACE_BITS | starts))
        n += len(hashed)
        if n >= CHUNK_WORDS:
            yield from combined()
            parts, whole, n = [], [], 0
    yield from combined()


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted window rows, those that a smaller document has too."""
    for h, rows, at, sure, ids in _runs(batches, WINDOW_NAMES):
        check = at >> PLACE_BITS
        order = np.lexsort((ids, check, h))
        h, ids, rows, at, sure, check = (x[order] for x in (h, ids, rows, at, sure, check))
        new = np.append(True, (h[1:] != h[:-1]) | (check[1:] != check[:-1]))
        # rows that are sure have keys of their own; should a key clash, they take no part in the minimum
        ranked = np.where(sure, np.iinfo(np.int64).max, ids)
        least = np.minimum.reduceat(ranked, np.flatnonzero(new))[np.cumsum(new) - 1]
        keep = sure | (ids > least)
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows[keep], pa.int64()), pa.array(at[keep] & ((1 << PLACE_BITS) - 1), pa.int64())], ["row", "at"])


def repeated_words(docs: DataFrame, keep_text: bool = False) -> DataFrame:
    """``(doc_id, n_words, n_removed, kept_sha256)`` per input row; with ``keep_text`` also ``kept``.

    Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a word goes if a window of 13
    words that covers it also starts in a document with a smaller id, judged
    on the input. Null and empty texts have no words. Rows with one id never
    cover each other, so repeated rows give equal rows; a null id is smaller
    than all others. Other columns are ignored; an empty table gives no rows.
    """
    own = texts_of(docs).select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), F.xxhash64("doc_id", text_key()).alias("row"),
        F.coalesce("text", F.lit("")).alias("text"))
    copies = (own.where(F.octet_length("text") > 2 * WINDOW - 2)
              .select("id", "row", F.xxhash64("text").alias("a"), F.unhex(F.md5("text")).alias("b")))
    first = copies.groupBy("a", "b").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most")
    copies = written(copies.join(written(first, "copied-texts"), ["a", "b"]).where("id > least")
                     .select("row", F.lit(COPY).cast("long").alias("at")), "copies")

    # sets: rows repeated in the table say the same, and add nothing
    anchors = own.select("row", "text").mapInArrow(_anchors, POSTING).repartition("h").sortWithinPartitions("h")
    places = written(anchors.mapInArrow(_shared_anchors, "row long, at long").union(copies)
                     .groupBy("row").agg(F.collect_set("at").alias("places")), "shared-anchors")
    windows = own.join(places, "row").select("id", "row", "text", "places").mapInArrow(_windows, WINDOWS)
    gone = (windows.repartition("h").sortWithinPartitions("h").mapInArrow(_covered, "row long, at long")
            .groupBy("row").agg(F.collect_set("at").alias("starts")))

    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * keep_text

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for ident, text, starts in zip(b.column("id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist(),
                                           b.column("starts").to_pylist()):
                words, removed = text.split(), 0
                starts = np.array(starts or [], np.int64)
                again, starts = starts >> MARK & 1 > 0, starts & ALL
                if len(starts) and starts.max() == ALL:
                    words, removed = [], len(words)
                elif len(starts):
                    if again.any():
                        windows = window_hashes(_hashes.of(words), WINDOW)
                        starts = np.append(starts, np.flatnonzero(np.isin(windows, windows[starts[again]])))
                    flags = np.zeros(len(words) + 1, np.int32)
                    starts = np.unique(starts)
                    np.add.at(flags, starts, 1)
                    np.add.at(flags, starts + WINDOW, -1)
                    hit = np.cumsum(flags)[:-1] > 0
                    removed = int(hit.sum())
                    words = [w for w, h in zip(words, hit.tolist()) if not h]
                kept = b" ".join(words)
                out.append((None if ident == NO_ID else ident, len(words) + removed, removed,
                            hashlib.sha256(kept).hexdigest(), *([kept.decode()] if keep_text else [])))
            if out:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)],
                                                 [x.split()[0] for x in kind.split(", ")])

    return own.join(gone, "row", "left").select("id", "text", "starts").mapInArrow(finish, kind)


def query(spark, sf_dir: str) -> DataFrame:
    """op6: repeated words per document, with the digest of the kept words."""
    return repeated_words(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def brute_force(docs: list[tuple]) -> list[tuple]:
    """The contract's rows computed the plain way, for tests."""
    least: dict[tuple, int] = {}
    rows = [(NO_ID if d is None else d, (t or "").encode().split()) for d, t in docs]
    for d, w in rows:
        for i in range(len(w) - WINDOW + 1):
            k = tuple(w[i:i + WINDOW])
            least[k] = min(d, least.get(k, d))
    out = []
    for d, w in rows:
        hit = set()
        for i in range(len(w) - WINDOW + 1):
            if least[tuple(w[i:i + WINDOW])] < d:
                hit.update(range(i, i + WINDOW))
        kept = b" ".join(x for i, x in enumerate(w) if i not in hit)
        out.append((None if d == NO_ID else d, len(w), len(hit), hashlib.sha256(kept).hexdigest()))
    return out
