"""Line dedup: lines held by many documents stay in one of them.

Line hashes are range-partitioned together with their document, with a
secondary sort by document and position, so equal lines lie next to each
other and a line that a third of all documents hold is spread over several
ranges. One streaming pass over the sorted ranges gives one row per (line,
document) with its positions; counts per line are combined in each range
before they are shuffled. The result is a compressed keep bitmap per
document, not text: the flip positions of the bitmap (first kept run's
start and end, next kept run's start and end, ...) as big-endian 32-bit
integers. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import BLANKS, text_key, texts_of, written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line without blanks at its ends, A-Z lower-cased."""
    return F.translate(F.btrim(line, F.lit(BLANKS)), UPPER, LOWER)


def line_bitmaps(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """``(doc_id, text_key, n_lines, n_dropped, keep_bitmap)`` per document.

    Keys of at least ``min_chars`` code points found in at least ``min_docs``
    documents lose all their lines except in the largest ``doc_id`` holding
    them (there, repeated lines stay too). Null or empty text is one empty
    line, never dropped. Rows equal in ``doc_id`` and text are one document
    and give one row; rows with one ``doc_id`` but different texts are
    different documents. A null ``doc_id`` sorts below all others, so such a
    document keeps a shared line only if all its holders have a null id. An
    empty table gives no rows. Other columns are ignored.
    """
    own = texts_of(docs).withColumn("text_key", text_key())
    lines = (own.select("doc_id", "text_key", F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
             .withColumn("key", line_key(F.col("line")))
             .where(F.length("key") >= min_chars)
             .select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("2"), "key").alias("h2"),
                     "doc_id", "text_key", "pos"))
    held = written(
        lines.repartitionByRange("h1", "doc_id")
        .sortWithinPartitions("h1", "h2", "doc_id", "text_key", "pos")
        .groupBy("h1", "h2", "doc_id", "text_key")  # clustered by the range already: no second shuffle
        .agg(F.sort_array(F.collect_set("pos")).alias("at")),
        "line-holders")
    # a written table: both sides of the join below are then plain shuffles, whose hot keys Spark can split
    common = written(held.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("last"))
                     .where(F.col("n") >= min_docs).select("h1", "h2", "last"), "common-lines")
    drops = (held.join(common, ["h1", "h2"])
             .where(F.coalesce(F.col("doc_id") != F.col("last"), F.col("last").isNotNull()))
             .groupBy("doc_id", "text_key")
             .agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("gone")))
    all_docs = own.select("doc_id", "text_key", F.size(split_lines(F.col("text"))).alias("n_lines")).distinct()
    joined = (all_docs.alias("a").join(
        drops.alias("b"),
        F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.text_key") == F.col("b.text_key")), "left")
        .select("a.doc_id", "a.text_key", "n_lines", F.coalesce("gone", F.array().cast("array<int>")).alias("gone")))
    starts = F.expr("filter(gone, (x, i) -> i = 0 or gone[i - 1] != x - 1)")
    ends = F.expr("filter(gone, (x, i) -> i = size(gone) - 1 or gone[i + 1] != x + 1)")
    flips = F.concat(F.array(F.lit(0)), F.flatten(F.zip_with(starts, ends, lambda s, e: F.array(s, e + 1))),
                     F.array(F.col("n_lines")))
    return joined.select(
        "doc_id", "text_key", F.col("n_lines").cast("long").alias("n_lines"),
        F.size("gone").cast("long").alias("n_dropped"),
        F.unhex(F.array_join(F.transform(flips, lambda x: F.lpad(F.hex(x), 8, "0")), "")).alias("keep_bitmap"))


def kept_text(text: Column, bitmap: Column) -> Column:
    """The lines of ``text`` that its keep bitmap marks, joined by line feeds."""
    runs = F.transform(
        F.sequence(F.lit(0), (F.length(bitmap) / 8).cast("int") - 1),
        lambda k: F.struct(F.conv(F.hex(F.substring(bitmap, k * 8 + 1, F.lit(4))), 16, 10).cast("int").alias("s"),
                           F.conv(F.hex(F.substring(bitmap, k * 8 + 5, F.lit(4))), 16, 10).cast("int").alias("e")))
    lines = split_lines(text)
    return F.array_join(F.flatten(F.transform(runs, lambda r: F.slice(lines, r["s"] + 1, r["e"] - r["s"]))), "\n")


def with_bitmaps(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Every row of ``docs`` as struct ``row``, beside its bitmap row as struct ``lines``."""
    left = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("l_id"), text_key().alias("l_key"))
    right = bitmaps.select(F.struct("*").alias("lines"))
    return left.join(right, F.col("l_id").eqNullSafe(F.col("lines.doc_id"))
                     & (F.col("l_key") == F.col("lines.text_key"))).select("row", "lines")


def drop_lines(docs: DataFrame, min_docs: int = 5, min_chars: int = 40) -> DataFrame:
    """``docs`` with its columns, the dropped lines taken out of ``text``.

    A text that loses nothing is unchanged (null stays null). ``n_chars``,
    where present, follows the new text.
    """
    pairs = with_bitmaps(docs, line_bitmaps(docs, min_docs, min_chars))
    text = F.when(F.col("lines.n_dropped") > 0, kept_text(F.col("row.text"), F.col("lines.keep_bitmap"))) \
        .otherwise(F.col("row.text"))
    out = pairs.select(text.alias("__text"), F.col("row"))
    return out.select(*[
        F.col("__text").alias("text") if c == "text" else
        F.length("__text").cast(docs.schema["n_chars"].dataType).alias("n_chars") if c == "n_chars" else
        F.col(f"row.`{c}`") for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op2: lines dropped per document, with the digest of the kept text."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    pairs = with_bitmaps(docs.select("doc_id", "text"), line_bitmaps(docs))
    return pairs.select(
        "row.doc_id", "lines.n_lines", "lines.n_dropped",
        F.sha2(kept_text(F.col("row.text"), F.col("lines.keep_bitmap")).cast("binary"), 256).alias("kept_sha256"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
c AS (
  SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5)
SELECT k.doc_id, count(*) AS n_lines,
       count(*) FILTER (WHERE c.key IS NOT NULL AND k.doc_id <> c.last) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos)
              FILTER (WHERE c.key IS NULL OR k.doc_id = c.last), '')) AS kept_sha256
FROM k LEFT JOIN c ON k.key = c.key
GROUP BY k.doc_id
"""
