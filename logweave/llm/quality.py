"""Quality classifier: random-indexing word vectors, pooled, and a two-layer network.

Every word and every word shape has a fixed sparse random index vector. A
word's vector is the sum of the index vectors around its occurrences in all
documents, gathered in one pass: each task adds up a matrix of fixed size
and the matrices are summed by word bucket. Documents are pooled into means
and spreads of their word vectors and of the products of neighbours. A
network of two layers, trained with numpy on a bounded sample of labelled
documents, gives a logit whose temperature is calibrated on labelled
documents that it was not trained on.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logweave.llm.common import texts_of
from logweave.llm.wordhash import coded_words, worker_memo

#: Buckets of words, of word shapes, and dimensions of a vector.
WORDS, SHAPES, DIMS = 1 << 14, 1 << 10, 32
#: Non-zero entries of an index vector and words on either side that count as context.
NONZERO, REACH = 2, 2
#: The most labelled documents that the network is trained and calibrated on.
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, SEED = 32, 60, 7
#: Tokens that a task holds at once.
CHUNK_TOKENS, GATHER_TOKENS = 200_000, 1_000_000
#: Words that a Python worker remembers.
MEMO_WORDS = 1_200_000
#: Rows of a batch that are taken together.
SLICE_ROWS = 500

_STRIP = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
_RUNS = re.compile(r"(.)\1+")


class _ShapeLetters(dict):
    """Code point -> A, a, 0 or itself."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = shape = "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c
        return shape


class WordBuckets(dict):
    """Blank-separated word -> (bucket of the bare lower-cased word) * SHAPES + (bucket of its shape)."""

    letters = _ShapeLetters()

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        text = word.decode()
        shape = _RUNS.sub(r"\1", text.translate(self.letters))
        bare = text.lower().encode().strip(_STRIP)
        code = self[word] = (xxhash.xxh3_64_intdigest(bare) % WORDS) * SHAPES + xxhash.xxh3_64_intdigest(shape) % SHAPES
        return code


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each bucket's index vector (words, then shapes, then a bucket of zeros)."""
    rng = np.random.default_rng(SEED)
    n = WORDS + SHAPES + 1
    places = rng.integers(0, DIMS, (n, NONZERO))
    signs = rng.choice([-1.0, 1.0], (n, NONZERO))
    signs[-1] = 0
    return places, signs


def token_chunks(batches: Iterator[pa.RecordBatch], most: int = CHUNK_TOKENS) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """``(batches, codes of all their words, words of each row)``, about ``most`` words at a time."""
    buckets = worker_memo("quality", WordBuckets)
    held, parts, sizes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for b in (x.slice(k, SLICE_ROWS) for x in batches for k in range(0, x.num_rows, SLICE_ROWS)):
        codes, lengths = coded_words(b.column("text"), buckets)
        held.append(b)
        parts.append(codes)
        sizes.append(lengths)
        if sum(map(len, parts)) >= most:
            yield held, np.concatenate(parts), np.concatenate(sizes)
            held, parts, sizes = [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    if held:
        yield held, np.concatenate(parts), np.concatenate(sizes)


def _gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One matrix per task: the index vectors around each bucket."""
    places, signs = index_vectors()
    none = WORDS + SHAPES
    total = np.zeros((none + 1) * DIMS)
    for _, codes, sizes in token_chunks(batches, GATHER_TOKENS):
        # word and shape of each word in turn; documents apart by zero buckets
        gap = np.repeat(np.arange(len(sizes)), sizes) * REACH
        seq = np.full(2 * len(codes) + REACH * (len(sizes) + 1), none)
        at = 2 * np.arange(len(codes)) + gap
        seq[at], seq[at + 1] = codes // SHAPES, WORDS + codes % SHAPES
        for step in range(1, REACH + 1):
            for here, there in ((seq[:-step], seq[step:]), (seq[step:], seq[:-step])):
                for k in range(NONZERO):
                    total += np.bincount(here * DIMS + places[there, k], signs[there, k], len(total))
    rows = total.reshape(-1, DIMS)[:none]
    used = np.flatnonzero(np.abs(rows).any(axis=1))
    yield pa.RecordBatch.from_arrays(
        [pa.array(used, pa.int32()), *(pa.array(rows[used, d], pa.float64()) for d in range(DIMS))],
        ["bucket", *(f"d{d}" for d in range(DIMS))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vectors of all buckets from all documents: a matrix of fixed size (2 MB)."""
    kind = "bucket int, " + ", ".join(f"d{d} double" for d in range(DIMS))
    text = docs.select(F.col("text").cast("string").alias("text"))
    got = text.mapInArrow(_gather, kind).groupBy("bucket").agg(*(F.sum(f"d{d}").alias(f"d{d}") for d in range(DIMS))).toPandas()
    out = np.zeros((WORDS + SHAPES + 1, DIMS), np.float32)
    rows = got[[f"d{d}" for d in range(DIMS)]].to_numpy(np.float64)
    out[got["bucket"].to_numpy(np.int64)] = rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)
    return out


def pooled(codes: np.ndarray, sizes: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Features of each document: means of words, shapes, neighbour products and squares, and log length."""
    out = np.zeros((len(sizes), 4 * DIMS + 1), np.float32)
    out[:, -1] = np.log1p(sizes)
    word, shape = codes // SHAPES, WORDS + codes % SHAPES
    ends = np.cumsum(sizes).tolist()
    for k, (n, e) in enumerate(zip(sizes.tolist(), ends)):
        if n:
            x, ones = vectors[word[e - n:e]], np.full(n, 1 / n, np.float32)
            out[k, :DIMS] = ones @ x
            out[k, DIMS:2 * DIMS] = ones @ vectors[shape[e - n:e]]
            out[k, 2 * DIMS:3 * DIMS] = np.einsum("ij,ij->j", x[:-1], x[1:]) / n
            out[k, 3 * DIMS:4 * DIMS] = np.einsum("ij,ij->j", x, x) / n
    return out


class Network:
    """Standardised features -> tanh layer -> logit / temperature -> probability."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.constant = None
        if len(np.unique(y)) < 2:
            self.constant = float(y[0]) * 0.98 + 0.01 if len(y) else 0.5
            return
        self.mean, self.std = x.mean(0), x.std(0) + 1e-6
        held = np.arange(len(y)) % 5 == 0 if len(y) >= 50 else np.zeros(len(y), bool)
        z, t = self._scaled(x[~held]), y[~held].astype(np.float64)
        w = [rng.normal(0, 1 / np.sqrt(z.shape[1]), (z.shape[1], HIDDEN)), np.zeros(HIDDEN),
             rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
        m, v, step = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w], 0
        for _ in range(max(EPOCHS, 1)):
            for rows in np.array_split(rng.permutation(len(t)), max(1, len(t) // 64)):
                h = np.tanh(z[rows] @ w[0] + w[1])
                err = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -30, 30))) - t[rows]) / len(rows)
                back = np.outer(err, w[2]) * (1 - h * h)
                grads = [z[rows].T @ back + 1e-4 * w[0], back.sum(0), h.T @ err + 1e-4 * w[2], np.array([err.sum()])]
                step += 1
                for k, g in enumerate(grads):  # Adam
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] = w[k] - 0.003 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
        self.w, self.temperature = w, 1.0
        if held.any():
            logit, t = self.logit(x[held]), y[held]
            grid = np.geomspace(0.25, 8, 41)
            loss = [np.mean(np.logaddexp(0, -np.where(t == 1, logit, -logit) / g)) for g in grid]
            self.temperature = float(grid[int(np.argmin(loss))])

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.std, -8, 8).astype(np.float64)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._scaled(x) @ self.w[0] + self.w[1]) @ self.w[2] + self.w[3][0]

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -30, 30)))


def fold(id_col, folds: int):
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep, most: int) -> DataFrame:
    """``(doc_id, text, y, h)`` of at most ``most`` label rows that ``keep`` admits, chosen by a hash of the id.

    The labels are bounded by ``most``, so they are broadcast. Many rows may
    have one id; who collects them takes the first ``most`` by ``h``.
    """
    ids = (labels.select(F.col("doc_id").cast("long").alias("id"), F.col(label).cast("int").alias("y"))
           .where(F.col("id").isNotNull() & F.col("y").isin(0, 1)).where(keep(F.col("id")))
           .orderBy(F.xxhash64("id"), "id", "y").limit(most))
    return (texts_of(docs).join(F.broadcast(ids), F.col("doc_id") == F.col("id"))
            .select("doc_id", "text", "y", F.xxhash64("doc_id", "text", "y").alias("h")))


def fit(docs: DataFrame, labels: DataFrame, keep, label: str = "quality", max_train: int = MAX_TRAIN):
    """``(word vectors, network)``: vectors from all documents, labels only where ``keep(id column)`` holds."""
    vectors = word_vectors(docs)
    sent = docs.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches):
        for held, codes, sizes in token_chunks(batches):
            x = pooled(codes, sizes, sent.value)
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            y = pa.concat_arrays([b.column("y") for b in held])
            h = pa.concat_arrays([b.column("h") for b in held])
            yield pa.RecordBatch.from_arrays([ids, y, h, pa.array(map(bytes, x), pa.binary())], ["doc_id", "y", "h", "x"])

    rows = (labelled_sample(docs, labels, label, keep, max_train).mapInArrow(pool, "doc_id long, y int, h long, x binary")
            .orderBy("h", "doc_id", "y").limit(max_train).toArrow().to_pandas())
    x = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(len(rows), 4 * DIMS + 1)
    y = rows["y"].to_numpy(np.int64)
    order = np.lexsort((y, rows["doc_id"].to_numpy(np.int64)))
    return sent, Network(x[order], y[order])


def score_documents(docs: DataFrame, model, carry_text: bool = False) -> DataFrame:
    """Struct ``row`` (all columns of ``docs`` but ``text``) and ``score``; with ``carry_text`` ``text`` too.

    Every input row gives one row; a null or empty text has pooled values of
    zero and the score that the network gives them. Without labelled rows the
    score is 0.5; if all labels agree it is 0.01 or 0.99.
    """
    vectors, network = model
    rest = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != "text"])
    todo = docs.select(rest.alias("row"), F.col("text").cast("string").alias("text"))
    kind = T.StructType([*todo.schema[:2 if carry_text else 1], T.StructField("score", T.DoubleType())])

    def run(batches):
        for held, codes, sizes in token_chunks(batches):
            scores, k = network.scores(pooled(codes, sizes, vectors.value)), 0
            for b in held:
                own = pa.array(scores[k:k + b.num_rows], pa.float64())
                yield pa.RecordBatch.from_arrays([*b.columns[:len(kind) - 1], own], kind.names)
                k += b.num_rows
    return todo.mapInArrow(run, kind)


def filter_quality(docs: DataFrame, labels: DataFrame, keep, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns unchanged."""
    scored = score_documents(docs, fit(docs, labels, keep), carry_text=True).where(F.col("score") >= threshold)
    return scored.select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`")
                           for c in docs.columns])


def trainable(id_col):
    """Labels may be learned from ids whose crc32 modulo 3 is not 1."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(3)) != 1


def query(spark, sf_dir: str) -> DataFrame:
    """op7: quality score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_documents(docs, fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), trainable))
    return scored.select(
        "row.doc_id", F.coalesce(fold("row.doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
