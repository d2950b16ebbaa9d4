"""From raw documents to token files: five stages, each an operator's work.

Every stage reads what its predecessor wrote (Parquet in the shared folder) and
returns the rows it keeps; all but the last return the columns of documents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderflow.llm import contamination, mixing, neardup, quality, tokens
from orderflow.llm.queries import tokenizer
from orderflow.llm.shared import settle, table
from orderflow.session import shared_dir


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the perplexity bands reject go."""
    return quality.sound(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the smallest doc_id."""
    return neardup.one_of_each(docs)


def benchmark_free(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a test item go."""
    return contamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents are taken up to three times."""
    return mixing.mix(mixing.sized(docs)).select(*docs.columns)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and the index read back from them."""
    return tokens.token_index(docs, f"{shared_dir(spark)}/tokens", tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_free", benchmark_free),
    ("mixed_sources", mixed_sources),
    ("token_files", token_files),
]

# Perplexity, MinHash, BM25 and a tokenizer are beyond SQL; the stages are tested
# against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = settle(stage(spark, docs, sf_dir), name)
    return docs
