"""From raw documents to packed training sequences, in five stages.

Each stage takes the documents its predecessor kept and returns documents (the
last one: pieces of sequences).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketseq.llm import mixing, near_dedup, packing, pii, quality, registry
from basketseq.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or leave the compression bands go."""
    registry.ship_package(spark)
    return quality.keep_quality(docs.select(*COLUMNS))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group linked by five-word shingles, similarity 0.8, one stays."""
    registry.ship_package(spark)
    return near_dedup.one_of_each(docs.select(*COLUMNS), shingle=5, percent=80)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal numbers, dates and addresses become pseudonyms."""
    rewritten = pii.with_pseudonyms(docs.select(*COLUMNS)).drop("n_pseudonyms")
    return _measured(rewritten)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each time the mix takes a document; the last one of a source is cut."""
    return _measured(mixing.mixed_documents(docs.select(*COLUMNS)))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, with their token ids."""
    registry.ship_package(spark)
    return packing.pack(docs.select(*COLUMNS), registry.TOKENIZER)


def _measured(docs: DataFrame) -> DataFrame:
    length = F.length("text").cast("long")
    return docs.withColumn("n_chars", length).select(*COLUMNS)


STAGES = [
    ("quality rules", quality_stage),
    ("near-duplicates", near_dedup_stage),
    ("pii", pii_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]
# Compression, minwise tokens and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
