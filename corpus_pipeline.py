"""A training-data pipeline: quality rules, toxicity, near-duplicates, packing.

Each stage takes the documents that its predecessor kept and, but for the last, returns
documents with the columns they had, whatever these are called.

Null and empty texts fail the quality rules, so no later stage meets them in a run. Rows with a null id take part in
all stages; a null language or source is a value like any other. A row is told by its id and text: of rows that repeat both, near
duplicates keep one. Ties between near copies go to the smallest id, null ids last. Texts of any length are
taken whole. Without documents all stages give none; without usable labels no document is toxic, but
that all are if all labels are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidebook.llm import near_copies, packing, quality_rules, toxicity
from tidebook.llm.common import materialize
from tidebook.llm.queries import tokenizer_path


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the rules, or a softer rule on a poor host, go."""
    return quality_rules.keep_good(docs)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the labels of those still there are learnt from."""
    return toxicity.keep_civil(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (5-word shingles, Jaccard 0.8 or more), the document with the smallest id stays.

    Candidates are those of SimHash fingerprints joined on blocks, as operator 8 has them, and of MinHash bands, as 64 bits reach few of this similarity; all are verified.
    """
    return near_copies.deduplicate(docs, width=5, similarity=0.8)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 2048 tokens."""
    return packing.pack_documents(docs, tokenizer_path("byte_bpe_50k.json"), capacity=2048)


STAGES = [
    ("quality_rules", quality_stage),
    ("toxicity", toxicity_stage),
    ("near_dedup", near_duplicate_stage),
    ("best_fit_packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents, each but the last written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: Shingle sets, the classifier and token ids are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None
