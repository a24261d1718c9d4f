"""A training corpus from raw documents: quality, near duplicates, repeated passages, source mix, packing.

All stages but the last keep the columns of documents, whatever further columns there are, and take empty tables (which stay empty)
and texts of any length (which are read whole).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.mixing import mix
from tidemark.llm.packing import pack
from tidemark.llm.passages import remove_repeated
from tidemark.llm.quality import keep_good
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.shared import discard, materialize
from tidemark.llm.simhash import keep_one
from tidemark.llm.tokens import count_report


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier keeps. Null, empty and blank texts go; rows without a doc_id and repeated rows are judged like any other."""
    return keep_good(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity of 0.8 or more): the smallest doc_id, of repeated rows one.

    Rows without a doc_id all stay; texts without words are one group.
    """
    return keep_one(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one has; those left without words go.

    Rows without a doc_id, and texts that were null or empty, stay as they are; rows of one doc_id are cut each by its own text.
    """
    return remove_repeated(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them. Null sources form one; null texts weigh nothing; of equal rows as many are taken as the target asks for."""
    return mix(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all documents' tokens, each with an end token, in sequences. A null text is its end token alone; rows without a doc_id and repeated rows are packed each."""
    counted = count_report(docs, vocabulary()).withColumn("n_tokens", F.col("n_tokens") + 1)
    return pack(counted)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("substring dedup", repeated_passages),
    ("mixing sources to target weights", source_mix),
    ("best-fit packing", packing),
]

#: The classifier's training, signatures and alignment have no SQL form; the tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each one's result is written as Parquet and read as the next one's documents. An empty table gives an empty result."""
    docs, before = table(spark, sf_dir, "documents"), None
    for i, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if i == len(STAGES) - 1:
            return out
        docs, path = materialize(out, f"stage-{i}")
        if before:
            discard(spark, before)
        before = path
    return docs
