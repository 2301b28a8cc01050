"""The corpus pipeline: quality, near duplicates, secrets, mixing, packing.

``STAGES`` are (name, function) pairs; each function takes (spark, docs, sf_dir)
and works on all that its predecessor kept.  All but the last return the columns
of ``docs``.  The learned and iterative stages have no SQL form, so
``ORACLE_SQL`` is None; tests/llm compares the stages with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from perkspark.llm import op1_cube_mixing, op2_quality_cnn, op5_tensored_minhash, op7_packing, op9_secrets
from perkspark.llm.common import table, written

#: Words whose ids a task of packing keeps: fewer than op7 alone, since the workers of the stages before are still there.
CACHE_WORDS = 150_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the byte network accepts; it learns from the labels of the folds that are not held out."""
    return op2_quality_cnn.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of five-word shingles are 0.8 similar or more."""
    return op5_tensored_minhash.deduplicated(docs, width=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked."""
    return op9_secrets.redacted_documents(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the balanced sample takes it."""
    return op1_cube_mixing.mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return op7_packing.pack_documents(docs, cache_words=CACHE_WORDS)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents``; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
