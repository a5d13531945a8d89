"""The corpus pipeline: quality classifier, SimHash near-dedup, benchmark decontamination, piece encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; the last returns the encodings, the others whole documents.
Null texts count as empty, null ids stay and are no group's first document, rows that share an id are judged each by its own
text, equal rows share their fate, and an empty table stays empty. Extra columns are carried along up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billproof.llm import common, decontaminate, piece_lattice, quality, simhash


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.keep(docs, quality.fit(docs, common.table(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id: 4-word shingles, 4 bits."""
    return simhash.first_of_each(docs, words=4, seed=42, radius=4)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark: windows of 13 words, 5 per cent."""
    return decontaminate.clean(docs, common.table(spark, sf_dir, "benchmark"), words=13, least_share=20)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The encoding and two sampled segmentations of each document left."""
    found = piece_lattice.segment(docs, "piece_bpe_32k.model", k=2, cached=4_000_000)  # workers of earlier stages are still there
    return found.withColumnRenamed("key", "doc_id").withColumn("samples", F.transform("samples", lambda s: s.dropFields("ids")))


STAGES = [
    ("quality_classifier", quality_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("sentencepiece_encoding", encoding_stage),
]

ORACLE_SQL = None  # trained weights and sampled segmentations can't be said in SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return docs
