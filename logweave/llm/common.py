"""Helpers shared by the operators: tables in the shared folder, bounded Bloom bits."""

from __future__ import annotations

import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logweave.session import shared_dir

#: Bits of the Bloom filter that `bloom_bits` broadcasts (8 MB): its size never
#: depends on the data. When it fills up it only lets more rows through.
BLOOM_BITS = 1 << 26

#: Characters that separate words in the contracts: space and \x09-\x0D.
BLANKS = " \t\n\x0b\x0c\r"


def shared_path(spark: SparkSession, name: str) -> str:
    """A path below ``spark.checkpoint.dir``.

    Where that is unset, as in tests, a local master gets a folder in ``/tmp``;
    on a cluster, whose machines would each write to their own, it is an error.
    """
    local = spark.conf.get("spark.master", "").startswith("local")
    return shared_dir(spark, name, "/tmp/logweave-checkpoints" if local else None)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below ``spark.checkpoint.dir``."""
    return shared_path(spark, f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs the running stage only,
    and a plan that uses the rows twice does not compute them twice.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def written_alone(df: DataFrame, name: str) -> DataFrame:
    """As :func:`written`; the files that were shuffled for it go as soon as the table is there.

    Else they stay until the driver happens to collect its garbage. Where
    another query uses ``df`` its stages run again.
    """
    conf, key = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(key, None)
    conf.set(key, "true")
    try:
        return written(df, name)
    finally:
        conf.unset(key) if before is None else conf.set(key, before)


def removed(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing needs any more."""
    spark = df.sparkSession
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(f)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def texts_of(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The two columns an operator needs, under fixed names; extra columns cannot clash."""
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def text_key(text="text"):
    """64-bit hash of a text; with the id it tells documents apart that share an id."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull())


def bloom_bits(keys: DataFrame, hash_col: str) -> np.ndarray:
    """Bit array (numpy uint64) of the 64-bit hashes in ``hash_col`` of a written table.

    16 bits a key, a power of two, at most ``BLOOM_BITS``. Bits are combined
    with ``bit_or`` per 64-bit word before the shuffle and after it, so at
    most ``BLOOM_BITS / 64`` rows reach the driver.
    """
    n = keys.count()
    size = min(BLOOM_BITS, max(1 << 12, 1 << (16 * n).bit_length()))
    at = [F.col(hash_col).bitwiseAND(F.lit(size - 1)), F.shiftright(hash_col, 32).bitwiseAND(F.lit(size - 1))]
    bits = keys.select(F.explode(F.array(*at)).alias("at"))
    words = (bits.groupBy(F.shiftright("at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits")))
    out = np.zeros(size // 64, np.uint64)
    got = words.toArrow()  # two columns of numbers; rows of Python objects would take the driver's memory many times over
    out[got["word"].to_numpy()] = got["bits"].to_numpy().view(np.uint64)
    return out


def in_bloom(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """For each 64-bit hash, whether it may be among those given to :func:`bloom_bits`."""
    h, low = hashes.astype(np.int64, copy=False), 64 * len(bits) - 1
    ok = np.ones(len(h), bool)
    for at in (h & low, h >> 32 & low):
        ok &= (bits[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return ok
