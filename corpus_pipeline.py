"""The corpus pipeline: quality classifier, exact dedup, n-gram Jaccard join,
benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's ``docs``. All but the last return
the columns of documents; the last returns the packed pieces.

Nulls, empty and repeated rows are as each operator defines them: a document
without words is rejected by the first stage, of rows that share id and text one
stays after the second, and an empty table runs through to an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import decontaminate, encoding, exact_dedup, jaccard_join, packing, quality
from tidewatch.llm.common import table, written
from tidewatch.session import configure


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on these documents, keeps."""
    return quality.kept(docs, quality.train(docs))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per distinct text (A-Z lower-cased): that with the largest id."""
    return exact_dedup.deduplicate(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of linked documents: that with the smallest id.

    Documents link from a Jaccard similarity of 0.8 of their five-word shingles on."""
    return jaccard_join.representatives(docs, shingle=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 1024 tokens."""
    return packing.pack(docs, encoding.public("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_stage),
    ("exact_dedup", dedup_stage),
    ("ngram_jaccard_join", near_copies_stage),
    ("benchmark_decontamination", decontaminate_stage),
    ("packing", packing_stage),
]
#: The classifier and the tokenizer have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
