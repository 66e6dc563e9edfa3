"""The corpus pipeline: documents in, packed sequences of clean, distinct text out.

Each stage takes ``(spark, docs, sf_dir)`` and works on all that the stage
before kept. All but the last return the columns of ``documents``; the last
returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from logweave.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from logweave.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (7) does not reject."""
    return quality.filter_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), quality.trainable)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that at least five of them share (2), except in the last of those."""
    return line_dedup.drop_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (3)."""
    return jaccard_join.one_per_group(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages they share with the benchmark (9)."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens (4)."""
    import public_tokenizers

    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2048)


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

#: A trained classifier, connected components and best-fit packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
