"""Best-fit packing of tokenised documents into sequences of bounded length.

Hierarchical residual packing. Documents are tokenised and cut into pieces
in one map-only step. Groups of pieces are packed best-fit, longest first,
each in its own task; bins that are nearly full are final. Underfull bins go
on as items: the groups of a tree node come together and their bins are
packed best-fit again, round after round, until one group is left or a
round's items are too many for one node, which then stays split.
"""

from __future__ import annotations

import bisect
import itertools
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import texts_of, written
from logweave.llm.wordhash import worker_memo

#: Pieces that one group of the first round holds on average, and the most
#: underfull bins that a later group may hold on average.
GROUP_ITEMS = 20_000
#: A bin is final when at most this share of it is empty.
SLACK = 0.005
#: Groups that come together in the next round.
FAN_IN = 8
#: Texts that are encoded together, at most, and their bytes (a longer text is alone); words whose ids are put together.
LOT, LOT_BYTES = 5000, 15 << 20
RUN_WORDS = 1 << 18
#: Words, and bare words, whose ids a Python worker remembers before it lets those go that do not recur.
MEMO_WORDS = 100_000

#: Letters that stay single and composed under NFC and have a plain lower case, then
#: ASCII marks without an apostrophe: such a word is the letters' ids and the marks' ids.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


class WordEncoder:
    """Texts -> token ids, each distinct word encoded once (and kept as little-endian 32-bit ids).

    Exact for tokenizers that lower-case, drop white space, split letters
    from marks and never join characters across these borders (a test
    compares it with whole texts).
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.no_truncation()
        self.tok.no_padding()
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.is_end = np.zeros(self.tok.get_vocab_size(with_added_tokens=True), bool)
        self.is_end[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.words: dict[str, bytes] = {"": b""}
        self.parts: dict[str, bytes] = {"": b""}

    def _encode(self, words: list[str]) -> Iterator[bytes]:
        return (np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch(words, add_special_tokens=False))

    def _learn_letters(self, words: list[str]) -> None:
        """One call for many bare words: every word ends with an end-of-word token and holds no other."""
        ids = np.array(self.tok.encode(" ".join(words), add_special_tokens=False).ids, "<u4")
        ends = np.flatnonzero(self.is_end[ids]) + 1
        if len(ends) == len(words):
            starts = np.append(0, ends[:-1])
            raw = ids.tobytes()
            self.parts.update((w, raw[4 * s:4 * e]) for w, s, e in zip(words, starts.tolist(), ends.tolist()))
        else:
            self.parts.update(zip(words, self._encode(words)))

    def _learn(self, words: list[str]) -> None:
        plain, letters, marks, other = [], [], [], []
        for w in words:
            if m := _PLAIN.fullmatch(w):
                a = m[1].lower()
                plain.append(w)
                letters.append(w if a == w else a)  # one string in both memories
                marks.append(m[2])
            else:
                other.append(w)
        if len(self.parts) > MEMO_WORDS:
            self.parts = {"": b""} | {w: self.parts[w] for w in itertools.chain(letters, marks) if w in self.parts}
        new = list(dict.fromkeys(a for a in letters if a not in self.parts))
        for k in range(0, len(new), 5000):
            self._learn_letters(new[k:k + 5000])
        new = list(set(marks) - self.parts.keys())
        self.parts.update(zip(new, self._encode(new)))
        parts = self.parts
        self.words.update((w, parts[a] + parts[b] if b else parts[a]) for w, a, b in zip(plain, letters, marks))
        self.words.update(zip(other, self._encode(other)))

    def encode(self, texts: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all texts, one after another, and how many each has. A null has none."""
        for blank in "\n\t\r":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(pc.fill_null(texts, ""), " ")
        del texts
        coded = pc.dictionary_encode(split.flatten())
        borders = split.offsets.to_numpy() - split.offsets[0].as_py()
        words, at = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        del split, coded  # only the numbers are needed from here on
        if len(self.words) > MEMO_WORDS:
            self.words = {"": b""} | {w: self.words[w] for w in words if w in self.words}
        if new := [w for w in words if w not in self.words]:
            self._learn(new)
        known = [self.words[w] for w in words]
        del words
        size = np.fromiter(map(len, known), np.int32, len(known)) // 4
        start = np.cumsum(size) - size
        pool = np.frombuffer(b"".join(known), "<u4")
        del known
        ends = np.append(0, np.cumsum(size[at], dtype=np.int64))
        ids = np.empty(ends[-1], "<u4")
        for k in range(0, len(at), RUN_WORDS):
            some = at[k:k + RUN_WORDS]
            n, first = size[some], ends[k:k + len(some)]
            ids[first[0]:first[-1] + n[-1]] = pool[np.repeat(start[some] - first, n) + np.arange(first[0], first[-1] + n[-1])]
        return ids, np.diff(ends[borders])


def lots(texts: pa.StringArray) -> Iterator[tuple[int, int]]:
    """Where runs of texts begin and end that are encoded together."""
    borders = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64))
    k = 0
    while k < len(texts):
        end = max(k + 1, min(k + LOT, int(np.searchsorted(borders, borders[k] + LOT_BYTES, "right")) - 1))
        yield k, end
        k = end


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_pieces(docs: DataFrame, tokenizer_path: str, capacity: int, end_id: int = 0) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of every document (its ids, then ``end_id``)."""
    kinds = {"doc_id": pa.int64(), "piece": pa.int32(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = worker_memo(tokenizer_path, lambda: WordEncoder(tokenizer_path)), np.array([end_id], "<u4").tobytes()
        for b in batches:
            rows, docs = [], b.column("doc_id").to_pylist()
            for k, end_of_lot in lots(b.column("text")):
                ids, sizes = encoder.encode(b.column("text")[k:end_of_lot])
                raw, at = memoryview(ids.view(np.uint8)), 0
                for doc, n in zip(docs[k:end_of_lot], sizes.tolist()):
                    own = bytes(raw[4 * at:4 * (at + n)]) + end
                    at += n
                    for piece, s in enumerate(range(0, n + 1, capacity)):
                        part = own[4 * s:4 * (s + capacity)]
                        rows.append((doc, piece, s, len(part) // 4, zlib.crc32(part)))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], list(kinds))
    return texts_of(docs).mapInArrow(run, PIECES)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(bin of each item, offset of each item, fill of each bin)``: longest first, tightest bin that fits."""
    spare: dict[int, list[int]] = {}
    spares: list[int] = []  # the distinct spare lengths, in order
    where, offset, fills = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64), []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        k = bisect.bisect_left(spares, size)
        if k == len(spares):
            at, left = len(fills), capacity
            fills.append(0)
        else:
            left = spares[k]
            at = spare[left].pop()
            if not spare[left]:
                del spares[k], spare[left]
        where[i], offset[i] = at, fills[at]
        fills[at] += size
        if left := left - size:
            if left not in spare:
                bisect.insort(spares, left)
                spare[left] = []
            spare[left].append(at)
    return where, offset, np.array(fills, np.int64)


PACKED = PIECES + ", bin long, at long, fill long, node long"


def _pack(capacity: int, round_no: int):
    """Pack the items of one node: its pieces, or its bins of the round before with all their pieces."""
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(c, "ascending") for c in ("bin", "at", "doc_id", "piece", "start", "ids_crc32")])
        old, at, fill, node = (rows[c].to_numpy() for c in ("bin", "at", "fill", "node"))
        # the pieces of the first round are items each; later the pieces of a bin are one item
        first = np.arange(len(old)) if round_no == 1 else np.flatnonzero(np.append(True, old[1:] != old[:-1]))
        where, offset, fills = best_fit(fill[first], capacity)
        item = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(old))))
        new = {"bin": (round_no << 56) + (int(node[0]) << 28) + where[item], "at": at + offset[item],
               "fill": fills[where[item]]}
        for name, values in new.items():
            rows = rows.set_column(rows.schema.get_field_index(name), name, pa.array(values, pa.int64()))
        return rows
    return run


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)`` of every piece.

    Null and empty texts are one piece that holds only the end id. Rows are
    packed one by one: repeated rows repeat, a null id stays null, other
    columns are ignored, an empty table gives no rows. Every sequence is
    filled from 0 without gaps, up to ``capacity``.
    """
    pieces = written(cut_pieces(docs, tokenizer_path, capacity), "pieces")
    whole = pieces.where(F.col("length") == capacity)
    rest = pieces.where(F.col("length") < capacity)
    n = rest.count()
    nodes = max(1, -(-n // GROUP_ITEMS))
    todo = rest.select(
        "*", F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("at"), F.col("length").alias("fill"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(nodes)).alias("node"))
    done, round_no = [], 1
    full = int(capacity * (1 - SLACK))
    while True:
        packed = written(todo.groupBy("node").applyInArrow(_pack(capacity, round_no), PACKED), f"packed-{round_no}")
        if nodes == 1:
            done.append(packed)
            break
        done.append(packed.where(F.col("fill") >= full))
        left = packed.where(F.col("fill") < full)
        bins = left.select("bin").distinct().count()
        fewer = max(-(-nodes // FAN_IN), -(-bins // GROUP_ITEMS))
        if fewer >= nodes:
            done.append(left)  # nothing more comes together without overfilling a node
            break
        todo = left.withColumn("node", F.expr(f"node * {fewer} div {nodes}"))
        nodes, round_no = fewer, round_no + 1
    out = [whole.select("*", F.expr("-1 - monotonically_increasing_id()").alias("sequence_id"),
                        F.lit(0).cast("long").alias("offset"))]
    cols = ["doc_id", "piece", "start", "length", "ids_crc32"]
    out += [d.select(*cols, F.col("bin").alias("sequence_id"), F.col("at").alias("offset")) for d in done]
    result = out[0]
    for d in out[1:]:
        result = result.unionByName(d)
    return result


def query(spark, sf_dir: str) -> DataFrame:
    """op4: every document packed into sequences of 2048 tokens."""
    import public_tokenizers

    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("word_bpe_49k.json"), 2048)
