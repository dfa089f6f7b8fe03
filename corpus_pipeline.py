"""Corpus pipeline: the stages, in order, and what runs them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from treeshred.llm import bpe, exact_dedup, mixing, near_dup, quality
from treeshred.llm.common import rows_per_batch
from treeshred.session import stage

BATCH_ROWS = 2000


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.

    Null texts and texts under 20 words get the share of good documents and stay. Rows are judged one by one, so equal
    rows, null ids and ties fare alike. An empty table stays empty.
    """
    return quality.keep_good(docs)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document for each text, A-Z lower-cased: the one of the largest doc_id.

    Null counts as empty, so of null and empty texts one row stays. Of rows that repeat id and text, and of a group without any id, the row
    whose columns have the largest digest stays. An empty table stays empty.
    """
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the smallest doc_id: shingles of five words, similarity 0.8.

    Texts without words, null among them, link with nothing and stay. Null ids stay only in groups without any id. Of rows that repeat id and
    text the one whose columns have the largest digest stays. An empty table stays empty.
    """
    return near_dup.drop_near_duplicates(docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; copies are rows like their original, with its id.

    Null is a source of its own, the last. Null and empty texts have no words; they are taken at the rate of their source, and a source
    without any words is left out. Equal sizes are ordered by a digest of the id. An empty table stays empty.
    """
    return mixing.mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each row, and whether decoding them gives its text: doc_id, ids, n_tokens, restored.

    Null counts as empty and has no ids. Every row has its own result, also copies and rows without id. An empty table stays empty.
    """
    return bpe.encode(docs)


STAGES = [("quality classifier", quality_stage), ("exact dedup", exact_stage), ("near dedup", near_stage),
          ("mix sources", mix_stage), ("encode", encode_stage)]

# The classifier's training and the near-duplicate components are not SQL: tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; what each one keeps is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    # Whole texts go to Python: smaller batches, so that memory beside the heap stays small in every task.
    with rows_per_batch(spark, BATCH_ROWS):
        for name, step in STAGES[:-1]:
            docs = stage(step(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
