"""Toxicity: class-conditional Kneser-Ney models.

Two bigram models, of toxic and of ordinary text, are counted from the
labelled documents. Both back off to unigrams of their class and from there
to one distribution that they share: in how many different contexts a word
occurs at all. A rare word, unseen in one class, is thus no evidence by
itself. A document's evidence is its length-normalised log-likelihood ratio,
that of its most telling windows, and how many of its words exceed some levels
of evidence (a toxic passage in a long text would drown in the mean). A logistic curve over these, fitted on labelled
documents that were not counted, gives the score.

Words and distinct bigrams are counted exactly, under 64-bit keys, in written
tables that grow with the input. Up to ``MODEL_KEYS`` keys the tables are
broadcast as sorted arrays. Beyond that only the most frequent keys are. Texts
are dealt into chunks by a hash; a chunk asks the tables for its other distinct
keys, range by range of the keys, gets the counts back in the order asked, and
is scored with its own part of the tables: the same numbers by another way.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import bloom_bits, in_bloom, removed, texts_of, written, written_alone
from logweave.llm.wordhash import MASK, hashed_words, mix

#: The most words and bigrams whose counts are broadcast (16 bytes a bigram, 36 a word); the others are joined.
MODEL_KEYS = 1_000_000
DISCOUNT = 0.75
#: Words of the windows whose evidence counts beside the whole text's.
WINDOWS = (4, 24)
#: Levels of evidence (natural logarithm) that words are counted by.
LEVELS = (1.5, 2.5, 3.5, 4.5, 6)
N_FEATURES = 2 * (1 + len(WINDOWS) + 2 * len(LEVELS))
#: The most labelled documents that the logistic curve is fitted on.
MAX_FIT = 20_000
CHUNK_TOKENS, COUNT_TOKENS = 200_000, 1_500_000
#: Bytes of text that count as a word where chunks are sized.
WORD_SIZE = 6
#: Keys that are as frequent or more are broadcast together or not at all.
MAX_LEVEL = 100_000
#: Keys of a range that one group of the join holds, about.
RANGE_KEYS = 250_000
#: Joined documents are scored in so many parts, one after another: what one has shuffled goes before the next.
PASSES = 4
#: Rows of a batch that are taken together.
SLICE_ROWS = 500

WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def token_chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_TOKENS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """``(batches, word hashes, words of each row)``."""
    held, parts, sizes = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]

    def answer():
        return held, np.concatenate(parts), np.concatenate(sizes)

    for b in (x.slice(k, SLICE_ROWS) for x in batches for k in range(0, x.num_rows, SLICE_ROWS)):
        texts = pa.array([(t or b"").translate(WORD_BYTES) for t in b.column("text").to_pylist()], pa.binary())
        codes, lengths = hashed_words(texts.cast(pa.string()))
        held.append(b)
        parts.append(codes)
        sizes.append(lengths)
        if sum(map(len, parts)) >= most:
            yield answer()
            held, parts, sizes = [], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    if held:
        yield answer()


def pairs(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The word before each word; 0 at the beginning of a document."""
    before = np.zeros(len(words), np.uint64)
    before[1:] = words[:-1]
    before[(np.cumsum(sizes) - sizes)[sizes > 0]] = 0
    return before


def bigram_key(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return mix(mix(before + np.uint64(0x9E3779B97F4A7C15)) ^ words)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bigrams of a chunk with their counts in either class."""
    for held, words, sizes in token_chunks(batches, COUNT_TOKENS):
        toxic = np.repeat(np.concatenate([b.column("y").to_numpy() for b in held]), sizes)
        before = pairs(words, sizes)
        key, some, at = np.unique(bigram_key(before, words), return_index=True, return_inverse=True)
        n_toxic = np.bincount(at, toxic, len(key)).astype(np.int32)
        n_all = np.bincount(at, minlength=len(key)).astype(np.int32)
        order = np.argsort(before[some])  # equal first words together compress better
        yield pa.RecordBatch.from_arrays(
            [pa.array(x[order]) for x in (before[some].view(np.int64), words[some].view(np.int64), n_all - n_toxic, n_toxic)],
            ["first", "word", "ordinary", "toxic"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        first, word = (b.column(c).to_numpy().view(np.uint64) for c in ("first", "word"))
        yield pa.RecordBatch.from_arrays([pa.array(bigram_key(first, word).view(np.int64)), b.column("ordinary"), b.column("toxic")],
                                         ["key", "ordinary", "toxic"])


def _sorted(keys: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Keys in order and a row of numbers for each column; one place more, with zeros, for keys that are not there."""
    order = np.argsort(keys)
    out = np.zeros((len(values), len(keys) + 1), np.float32)
    for row, v in zip(out, values):
        row[:-1] = v[order]
    return np.append(keys[order], np.uint64(MASK)), out


def _places(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Where each wanted key is; the last place where it is not."""
    wanted, back = np.unique(wanted, return_inverse=True)
    at = np.searchsorted(keys[:-1], wanted)
    at[keys[at] != wanted] = len(keys) - 1
    return at[back]


def _distinct(keys: np.ndarray) -> np.ndarray:
    """The distinct keys in order; sorting takes a tenth of the time of ``np.unique``, which hashes."""
    keys = np.sort(keys)
    return keys[np.append(True, keys[1:] != keys[:-1])[:len(keys)]]


def _flat(lists: pa.ChunkedArray, dtype) -> np.ndarray:
    return np.concatenate([np.zeros(0, dtype), *(c.flatten().to_numpy() for c in lists.chunks)])


def _ranges(keys: np.ndarray, kind: int, shift: int) -> tuple[list[int], list[np.ndarray], list[slice]]:
    """Sorted keys by range: its number (of words, kind 0, below 0), its keys and where they are."""
    of = keys >> np.uint64(shift) if shift < 64 else np.zeros(len(keys), np.uint64)
    number, start = np.unique(of, return_index=True)
    at = [slice(s, e) for s, e in zip(start, np.append(start[1:], len(keys)))]
    return [n if kind else -1 - n for n in number.tolist()], [keys[x] for x in at], at


def _in_ranges(kind: int, shift: int) -> Callable:
    """Rows of the words (kind 0) or bigrams as rows of their ranges, with many keys each."""
    def run(batches):
        for b in _large(batches):
            names = ("first", "word") if kind else ("key",)
            keys = [b[c].to_numpy().view(np.uint64) for c in names]
            keys = bigram_key(*keys) if kind else keys[0]
            order = np.argsort(keys)
            values = np.column_stack([b[c].to_numpy().astype(np.float32) for c in b.column_names if c not in names])[order]
            number, parts, at = _ranges(keys[order], kind, shift)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int32()), pa.array([k.view(np.int64) for k in parts], pa.list_(pa.int64())),
                 pa.array([values[x].ravel() for x in at], pa.list_(pa.float32()))], ["range", "keys", "values"])
    return run


def _large(batches: Iterator[pa.RecordBatch], rows: int = 500_000) -> Iterator[pa.Table]:
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def _arrays(table: DataFrame) -> tuple[np.ndarray, list[np.ndarray]]:
    """Keys and values of the words or bigrams."""
    if "first" in table.columns:
        table = table.mapInArrow(_keyed, "key long, ordinary long, toxic long")
    t = table.select("key", *[F.col(c).cast("float") for c in table.columns if c != "key"]).toArrow()
    return t["key"].to_numpy().view(np.uint64), [t[c].to_numpy() for c in t.column_names if c != "key"]


def _level(table: DataFrame, weight: Column, most: int) -> int:
    """The lowest weight from which there are at most so many rows."""
    level, n = MAX_LEVEL + 1, 0
    for r in table.groupBy(F.least(weight, F.lit(MAX_LEVEL)).alias("w")).count().orderBy(F.desc("w")).collect():
        n += r["count"]
        if n > most:
            break
        level = r["w"]
    return level if level <= MAX_LEVEL else (1 << 62)


#: Of a word: counts and kinds of bigrams that it begins, counts, in either class (ordinary, toxic), and in how
#: many contexts it occurs. Of a bigram: the first two, its counts.
VALUES = ("ordinary", "toxic", "types_o", "types_t", "n_o", "n_t", "varied")


class Model:
    """Counts under sorted keys, of all words and bigrams or of those that some documents have."""

    def __init__(self, totals: dict, words: np.ndarray, word_values: list[np.ndarray], bigrams: np.ndarray, counts: list[np.ndarray]):
        self.words, table = _sorted(words, word_values)
        self.bigrams, self.bigram = _sorted(bigrams, counts)
        self.context, self.types, n, varied = table[:2], table[2:4], table[4:6], table[6]
        shared = (varied + 1) / (totals["varied"] + totals["words"] + 1)
        self.unigram = np.zeros((2, len(shared)), np.float32)
        for k, c in enumerate("ot"):
            total = max(totals["n_" + c], 1)
            back = DISCOUNT * totals["kinds_" + c] / total if totals["n_" + c] else 1
            self.unigram[k] = np.maximum(n[k] - DISCOUNT, 0) / total + back * shared

    def evidence(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """log P(word | word before, toxic) - log P(word | word before, ordinary), per word, and the same of unigrams."""
        before = pairs(words, sizes)
        at = _places(self.bigrams, bigram_key(before, words))
        word = _places(self.words, words)
        first = np.append(0, word[:-1])[:len(word)]
        first[before == 0] = _places(self.words, np.zeros(1, np.uint64))[0]
        logs = []
        for k in (0, 1):
            n = self.context[k][first]
            seen = np.maximum(n, 1)
            back = np.where(n > 0, DISCOUNT * self.types[k][first] / seen, 1)
            p = np.maximum(self.bigram[k][at] - DISCOUNT, 0) / seen + back * self.unigram[k][word]
            logs.append(np.log(np.maximum(p, 1e-12)))
        alone = np.log(self.unigram[1][word]) - np.log(self.unigram[0][word])
        return np.clip(logs[1] - logs[0], -12, 12), np.clip(alone, -12, 12)

    def features(self, words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Of bigram and of unigram evidence: the mean, the highest mean of a window, and how many words exceed each level."""
        width = N_FEATURES // 2
        out = np.zeros((len(sizes), N_FEATURES))
        full = np.flatnonzero(sizes > 0)
        if not len(full):
            return out
        starts = (np.cumsum(sizes) - sizes)[full]
        n = sizes[full]
        end = np.repeat(starts + n, n)
        for j, e in enumerate(self.evidence(words, sizes)):
            e = e.astype(np.float64)  # else sums would depend on the texts before
            cols = [np.add.reduceat(e, starts) / n]
            total = np.concatenate(([0], np.cumsum(e)))
            for w in WINDOWS:
                stop = np.minimum(np.arange(len(e)) + w, end)
                cols.append(np.maximum.reduceat((total[stop] - total[:-1]) / w, starts))
            for level in LEVELS:
                over = np.add.reduceat((e > level).astype(np.float64), starts)
                cols += [np.log1p(over), over / n]
            out[full, j * width:(j + 1) * width] = np.column_stack(cols)
        return out


def fold(id_col):
    """crc32 of the id as text, modulo 5; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(5))


def labelled(docs: DataFrame, labels: DataFrame, label: str, keep, most: int | None = None) -> DataFrame:
    """``(doc_id, text, y)``, a row for each label 0 or 1 of each document row with that id, where ``keep`` admits it.

    With ``most``, labels are a bounded sample chosen by a hash of the id, and
    are broadcast. Otherwise only documents that a Bloom filter of fixed size
    admits are shuffled to their labels.
    """
    y = labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y")).where(
        F.col("id").isNotNull() & F.col("y").isin(0, 1)).where(keep(F.col("id")))
    rows = texts_of(docs)
    if most is not None:
        y = F.broadcast(y.orderBy(F.xxhash64("id"), "id", "y").limit(most))
    else:
        y = written(y, "labels")
        bits = docs.sparkSession.sparkContext.broadcast(bloom_bits(y.select(F.xxhash64("id").alias("h")), "h"))

        def likely(batches):
            for b in batches:
                yield b.filter(pa.array(in_bloom(bits.value, b.column("h").to_numpy())))

        rows = rows.withColumn("h", F.xxhash64("doc_id")).mapInArrow(likely, "doc_id long, text string, h long")
        y = y.hint("merge")
    return rows.join(y, F.col("doc_id") == F.col("id")).select("doc_id", F.col("text").cast("binary").alias("text"), "y")


class Counts:
    """Written tables of the counts of the rows ``(text, y)``, and their model where it is small enough to broadcast."""

    def __init__(self, rows: DataFrame):
        counted = rows.select("text", "y").mapInArrow(_count, "first long, word long, ordinary int, toxic int")
        bigrams = written_alone(counted.repartition("first", "word").groupBy("first", "word").agg(
            F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).sortWithinPartitions("first"), "bigrams")
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        kinds = [(F.col(c) > 0).cast("long") for c in ("ordinary", "toxic")]
        begins = bigrams.select(F.col("first").alias("key"), "ordinary", "toxic", kinds[0].alias("types_o"), kinds[1].alias("types_t"),
                                zero.alias("n_o"), zero.alias("n_t"), zero.alias("varied"))
        ends = bigrams.select(F.col("word").alias("key"), zero, zero, zero, zero, "ordinary", "toxic", one)
        sums = [F.sum(c).alias(c) for c in VALUES]
        self.words = written_alone(begins.union(ends).groupBy("key").agg(*sums), "words")
        self.totals = self.words.agg(
            F.count(F.when(F.col("varied") > 0, 1)).alias("words"),
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("varied", "n_o", "n_t")],
            *[F.count(F.when(F.col("n_" + c) > 0, 1)).alias("kinds_" + c) for c in "ot"]).first().asDict()
        self.model, n_words, n_bigrams = None, self.words.count(), bigrams.count()
        broadcast = rows.sparkSession.sparkContext.broadcast
        if n_words + n_bigrams <= MODEL_KEYS:
            (words, word_values), (keys, counts) = map(_arrays, (self.words, bigrams))
            self.model = broadcast(Model(self.totals, words, word_values, keys, counts))
            return
        tables = self.words, bigrams
        weights = [reduce(Column.__add__, map(F.col, c)) for c in (("ordinary", "toxic", "n_o", "n_t"), ("ordinary", "toxic"))]
        levels = [_level(t, w, most) for t, w, most in zip(tables, weights, (MODEL_KEYS // 4, MODEL_KEYS - MODEL_KEYS // 4))]
        self.hot = broadcast([_sorted(*_arrays(t.where(w >= level))) for t, w, level in zip(tables, weights, levels)])
        #: a key's range is what is left of it after this shift
        self.shifts = [64 - max(0, math.ceil(math.log2(max(n, 1) / RANGE_KEYS))) for n in (n_words, n_bigrams)]
        self.ranges = written_alone(reduce(DataFrame.union, (
            t.where(w < level).mapInArrow(_in_ranges(kind, self.shifts[kind]), "range int, keys array<long>, values array<float>")
            for kind, (t, w, level) in enumerate(zip(tables, weights, levels)))), "ranges")
        for t in tables:
            removed(t)

    def applied(self, rows: DataFrame, finish: Callable, kind: T.DataType, passes: int = PASSES) -> DataFrame:
        """The rows ``(row, text)`` as ``row`` and ``out``: what ``finish`` makes of the features, of type ``kind``."""
        schema = T.StructType([rows.schema["row"], T.StructField("out", kind)])

        def rows_of(model, batches):
            for held, words, sizes in token_chunks(batches):
                got, k = finish(model.features(words, sizes)), 0
                for b in held:
                    yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(got[k:k + b.num_rows])], ["row", "out"])
                    k += b.num_rows

        if self.model is not None:
            model = self.model
            return rows.select("row", "text").mapInArrow(lambda batches: rows_of(model.value, batches), schema)

        parts = [written_alone(self._joined(texts, rows_of, schema), "scores") for texts in self._dealt(rows, passes)]
        return reduce(DataFrame.union, parts)

    def _dealt(self, rows: DataFrame, passes: int) -> Iterator[DataFrame]:
        """The rows in so many parts, each dealt to tasks by ``chunk``, which only depends on the row."""
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        each = math.ceil(size / (COUNT_TOKENS * WORD_SIZE * passes)) or 1
        plain = [F.col("row")[f.name] for f in rows.schema["row"].dataType if "map<" not in f.dataType.simpleString()]
        chunk = F.pmod(F.xxhash64("text", *plain), F.lit(each * passes))
        for k in range(passes):
            yield rows.select(chunk.alias("chunk"), "row", "text").where(F.col("chunk") % passes == k).repartition(2 * each, "chunk")

    def _joined(self, texts: DataFrame, rows_of: Callable, schema: T.StructType) -> DataFrame:
        hot, totals, shifts = self.hot, self.totals, self.shifts

        def asked(text: pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
            """Of words and of bigrams: the distinct keys of a chunk, their place among the frequent ones, whether they are not there."""
            found = ([np.zeros(1, np.uint64)], [])
            for _, words, sizes in token_chunks(iter(pa.table({"text": text}).to_batches())):
                for held, keys in zip(found, (words, bigram_key(pairs(words, sizes), words))):
                    held.append(_distinct(keys))
            out = []
            for held, (keys, _) in zip(found, hot.value):
                mine = _distinct(np.concatenate([np.zeros(0, np.uint64), *held]))
                at = np.searchsorted(keys[:-1], mine)
                at[keys[at] != mine] = len(keys) - 1
                out.append((mine, at, at == len(keys) - 1))
            return out

        def ask(chunk: pa.Table) -> pa.Table:
            ranges = [_ranges(keys[rare], kind, shifts[kind]) for kind, (keys, _, rare) in enumerate(asked(chunk["text"]))]
            number = [r for of, _, _ in ranges for r in of]
            return pa.table({"chunk": pa.array([chunk["chunk"][0].as_py()] * len(number), pa.int64()), "range": pa.array(number, pa.int32()),
                             "keys": pa.array([k.view(np.int64) for _, keys, _ in ranges for k in keys], pa.list_(pa.int64()))})

        def answer(questions: pa.Table, table: pa.Table) -> pa.Table:
            width = len(VALUES) if questions.num_rows and questions["range"][0].as_py() < 0 else 2
            keys = _flat(table["keys"], np.int64).view(np.uint64)
            keys, values = _sorted(keys, _flat(table["values"], np.float32).reshape(-1, width).T) if questions.num_rows else (keys, None)
            got = [values[:, _places(keys, q.values.to_numpy().view(np.uint64))].T.ravel() for q in questions["keys"]]
            return pa.table({"chunk": questions["chunk"], "range": questions["range"], "values": pa.array(got, pa.list_(pa.float32()))})

        def score(chunk: pa.Table, answers: pa.Table) -> pa.Table:
            args, numbers = [], answers["range"].to_numpy()
            order = np.argsort(np.where(numbers < 0, -1 - numbers, numbers), kind="stable")
            for kind, (keys, at, rare) in enumerate(asked(chunk["text"])):
                values = hot.value[kind][1][:, at]
                got = answers["values"].take(pa.array(order[(numbers[order] < 0) == (kind == 0)]))
                values[:, rare] = _flat(got, np.float32).reshape(-1, len(values)).T
                args += [keys, list(values)]
            model = Model(totals, *args)
            return pa.Table.from_batches(rows_of(model, iter(chunk.select(["row", "text"]).to_batches())))

        questions = texts.groupBy("chunk").applyInArrow(ask, "chunk long, range int, keys array<long>")
        answers = questions.groupBy("range").cogroup(self.ranges.groupBy("range")).applyInArrow(
            answer, "chunk long, range int, values array<float>")
        return texts.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(score, schema)


class Curve:
    """Logistic regression on standardised features, by Newton steps with a small ridge."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.constant = None
        if len(np.unique(y)) < 2:
            self.constant = float(y[0]) * 0.98 + 0.01 if len(y) else 0.5
            return
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        z = self._scaled(x)
        self.w = np.zeros(z.shape[1])
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(z @ self.w, -30, 30)))
            h = (z * (p * (1 - p))[:, None]).T @ z + np.eye(len(self.w)) * 0.1
            self.w += np.linalg.solve(h, z.T @ (y - p) - 0.1 * self.w)

    def _scaled(self, x):
        z = np.clip((x - self.mean) / self.std, -10, 10)
        return np.column_stack([z, np.ones(len(z))])

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self._scaled(x) @ self.w, -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_fit: int = MAX_FIT):
    """``(counts, curve)`` from labels of folds 1 to 4: folds 2 to 4 are counted, fold 1 fits the curve."""
    counts = Counts(labelled(docs, labels, label, lambda i: fold(i) >= 2))
    sample = labelled(docs, labels, label, lambda i: fold(i) == 1, max_fit).select(
        F.struct("doc_id", "y", F.xxhash64("doc_id", "text", "y").alias("h")).alias("row"), "text")
    got = counts.applied(sample, lambda x: list(map(bytes, np.ascontiguousarray(x))), T.BinaryType(), 1).select("row.*", "out")
    # many rows may have one id: as many as labels at the most
    got = got.orderBy("h", "doc_id", "y").limit(max_fit).toArrow().to_pandas()
    x = np.frombuffer(b"".join(got["out"]), np.float64).reshape(len(got), N_FEATURES)
    y = got["y"].to_numpy(np.int64)
    order = np.lexsort((y, got["doc_id"].to_numpy(np.int64)))
    return counts, Curve(x[order], y[order])


def score_documents(docs: DataFrame, fitted) -> DataFrame:
    """Struct ``row`` (all columns of ``docs`` but ``text``) and ``score``, one row per input row.

    A null or empty text has no evidence and the score that the curve gives
    it. Without labelled rows every score is 0.5; if all labels agree, 0.01
    or 0.99. Repeated rows score alike; an empty table gives no rows.
    """
    counts, curve = fitted
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    todo = docs.select(rest.alias("row"), F.col("text").cast("string").cast("binary").alias("text"))
    return counts.applied(todo, curve.scores, T.DoubleType()).withColumnRenamed("out", "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op1: toxicity score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))
    return scored.select(
        "row.doc_id", F.coalesce(fold(F.col("row.doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
