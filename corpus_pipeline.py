"""From raw documents to sequences of token ids, stage by stage; every stage is written and read again.

Texts, NULLs and repeated rows are treated as the operators' docstrings say. An
empty table passes through all stages and gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskloom.llm import decontam, mixing, quality, simhash, token_files
from riskloom.llm.catalog import tokenizer_path
from riskloom.llm.text import table
from riskloom.session import written


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed limits and the trees fitted on the labelled ones."""
    return quality.keep_good(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each near-duplicate component."""
    return simhash.keep_first(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed(docs, table(spark, sf_dir, "labels"))


def token_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequence files' documents, read back: doc_id, start, n_tokens, ids_crc32."""
    return token_files.encode_documents(docs, tokenizer_path())


STAGES = [
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("mixing", mixed_sources),
    ("token_files", token_sequences),
]

# Tokenizing and the trees have no SQL form; tests/llm/test_pipeline.py checks the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
