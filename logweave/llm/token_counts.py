"""Token counts through a digest cache.

The cache is a Parquet table of (content digest, tokenizer digest, count).
Documents meet it by the digest of their normalised content; of the texts
that it does not hold each distinct one is encoded once, and the new counts
are appended, each run's in a folder of its own. Copies of a text are
combined before the shuffle, so a text that a third of all rows hold is one
row per task.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.llm.common import shared_path, texts_of

#: Texts are encoded in lots of about so many characters.
LOT_CHARS = 1_000_000
CACHE = "content binary, tokenizer binary, n_tokens long"


def normalised(text: Column) -> Column:
    """Content as it is counted: null is the empty text; the tokenizers here see all else."""
    return F.coalesce(text.cast("string"), F.lit(""))


def tokenizer_digest(path: str) -> bytes:
    """Names a tokenizer version: library, its version, and the vocabulary file's content."""
    if path.endswith(".model"):
        import sentencepiece as library
    else:
        import tokenizers as library
    h = hashlib.sha256(f"{library.__name__} {library.__version__}\n".encode())
    with open(path, "rb") as f:
        h.update(f.read())
    return h.digest()


def counter(path: str):
    """Function from texts to token counts, without special tokens, truncation or padding."""
    if path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(x) for x in sp.encode(texts, num_threads=1, add_bos=False, add_eos=False)]
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return lambda texts: [len(x) for x in tok.encode_batch(texts, add_special_tokens=False)]


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def cached(spark: SparkSession, cache: str, version: bytes) -> DataFrame:
    """``(content, n_tokens)`` that the cache holds for a tokenizer version, one row per content."""
    rows = (spark.read.schema(CACHE).option("recursiveFileLookup", "true").parquet(cache) if _exists(spark, cache)
            else spark.createDataFrame([], CACHE))
    return (rows.where((F.col("tokenizer") == F.lit(version)) & F.col("n_tokens").isNotNull()).groupBy("content").agg(F.max("n_tokens").alias("n_tokens")))


def count_tokens(docs: DataFrame, tokenizer_path: str, cache: str) -> DataFrame:
    """``(doc_id, n_bytes, n_tokens)``, one row per input row; the cache at ``cache`` gains the texts it missed.

    Null is the empty text with no bytes and no tokens. Repeated rows repeat,
    a null id stays null, other columns are ignored, an empty table gives no
    rows. Counts of other tokenizer versions, and rows of the cache without a
    count, are passed over. Runs may append at the same time: each writes a
    folder of its own (``run=<id>``), which counts once it is committed, and
    a text that two of them add has one count.
    """
    spark = docs.sparkSession
    version = tokenizer_digest(tokenizer_path)
    own = texts_of(docs).select("doc_id", normalised(F.col("text")).alias("text")).select(
        "doc_id", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("content"))
    texts = own.groupBy("content").agg(F.first("text").alias("text"))
    if _exists(spark, cache):
        texts = texts.join(cached(spark, cache, version), "content", "left_anti")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer_path)
        for b in batches:
            lot, size, counts = [], 0, []
            for text in b.column("text").to_pylist():
                lot.append(text)
                size += len(text)
                if size >= LOT_CHARS:
                    counts += count(lot)
                    lot, size = [], 0
            counts += count(lot) if lot else []
            yield pa.RecordBatch.from_arrays(
                [b.column("content"), pa.array([version] * len(counts), pa.binary()), pa.array(counts, pa.int64())],
                ["content", "tokenizer", "n_tokens"])

    texts.mapInArrow(encode, CACHE).write.parquet(f"{cache}/run={uuid.uuid4().hex}")
    sizes = own.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "content")
    return sizes.join(cached(spark, cache, version), "content").select("doc_id", "n_bytes", "n_tokens")


def query(spark, sf_dir: str) -> DataFrame:
    """op8: bytes and tokens of every document, by the cache in the shared folder, which keeps what earlier runs counted."""
    import public_tokenizers

    counts = count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                          public_tokenizers.path("piece_bpe_32k.model"), shared_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > 4096)
