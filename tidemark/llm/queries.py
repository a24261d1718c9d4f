"""The queries of this subpackage, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judgement of every document; a document is a row, whatever its text. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.quality import quality_report

    return quality_report(table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text. Null is the empty text; repeated rows are each returned. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.fingerprints import fingerprint_report

    return fingerprint_report(table(spark, sf_dir, "documents"))


def op3_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest of every query vector, ties to the smaller vec_id; vectors without a direction take no part. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.ann import search

    return search(table(spark, sf_dir, "embeddings"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document. Null is the empty text; repeated rows are each returned. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.tokens import count_report

    return count_report(table(spark, sf_dir, "documents"), vocabulary())


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each repeated passage; null and short texts have none. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.passages import repeated_passages

    return repeated_passages(table(spark, sf_dir, "documents"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page. Null is the empty page; repeated rows are each returned. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.html import page_report

    return page_report(table(spark, sf_dir, "pages"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; texts without words have fingerprint zero and are linked like any other. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.simhash import simhash_report

    return simhash_report(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document; null texts weigh nothing, null sources are one, last. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.mixing import mix_report

    return mix_report(table(spark, sf_dir, "documents"))


def op9_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files written and read back; a null text is its end id alone, null ids come first, repeated rows are each written. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.tokenfile import read_token_file, write_token_file

    file, _ = write_token_file(table(spark, sf_dir, "documents"), vocabulary())
    return read_token_file(file)


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Places of every piece of every document; a null text is its end token alone, repeated rows are packed each. An empty table gives no rows; further columns play no part."""
    from tidemark.llm.packing import pack
    from tidemark.llm.tokens import count_report

    counted = count_report(table(spark, sf_dir, "documents"), vocabulary()).withColumn("n_tokens", F.col("n_tokens") + 1)
    return pack(counted)


QUERIES = {f.__name__: f for f in (op1_quality_classifier, op2_document_fingerprints, op3_nearest_neighbours, op4_token_counts, op5_substring_dedup, op6_html_extraction, op7_simhash_near_dedup, op8_source_mixing, op9_token_output, op10_best_fit_packing)}
ORACLES: dict[str, str] = {}
