"""Registered queries of the text operators: each runs one operator over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import conversations, decontam, html_text, licenses, mixing, passages, ppm, quality, rollups, simhash, token_files, urls, vector_codes
from riskloom.llm.text import table
from riskloom.session import scratch_path, written

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function
    return add


def tokenizer_path() -> str:
    return public_tokenizers.path("word_bpe_49k.json")


@query("op8_token_files")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as read back from the sequence files it was written to."""
    return token_files.encode_documents(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op3_quality")
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by trees fitted on the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit_quality(docs, table(spark, sf_dir, "labels")))


@query("op9_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark hits of every document."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op2_simhash")
def simhash_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query("op4_source_mix")
def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix."""
    return mixing.mix_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_url_filter")
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url."""
    return urls.judge(table(spark, sf_dir, "pages"))


@query("op1_ppm_score")
def ppm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram base and trie score of every document."""
    return ppm.score(table(spark, sf_dir, "documents"))


@query("op6_paragraphs")
def repeated_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage and every line that repeats another, with where it stands first."""
    return passages.repeats(table(spark, sf_dir, "documents"))


@query("op7_licenses", licenses.find_sql())
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licenses, headers and notices in every document."""
    return licenses.find(table(spark, sf_dir, "documents"), licenses.known_texts(spark))


ALNUM_WORD = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


@query("op5_token_rollups", r"""
    WITH counted AS (
        SELECT doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '[0-9A-Za-z\x{80}-\x{10FFFF}]+')) AS words,
               strlen(coalesce(text, '')) AS bytes, text IS NOT NULL AND EXISTS (
                   SELECT 1 FROM documents e WHERE e.text = d.text AND e.doc_id < d.doc_id) AS copy
        FROM documents d),
    alive AS (SELECT * FROM counted WHERE NOT copy)
    SELECT source, lang, 'words-1' AS tokenizer_version, CAST(count(*) AS BIGINT) AS n_docs,
           CAST(sum(words) AS BIGINT) AS n_tokens FROM alive GROUP BY source, lang
    UNION ALL
    SELECT source, lang, 'bytes-2', CAST(count(*) AS BIGINT), CAST(sum(bytes) AS BIGINT) FROM alive GROUP BY source, lang""")
def token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents, one of them delivered twice.

    All documents are inserted with their white-space words, revised to the
    words of letters and digits, exact copies of earlier documents deleted, and
    what is left inserted under a second tokenizer version.
    """
    text = F.coalesce("text", F.lit(""))
    counted = written(table(spark, sf_dir, "documents").select(
        "doc_id", "source", "lang", mixing.word_count(text).alias("spaced"),
        F.regexp_count(text, F.lit(ALNUM_WORD)).cast("bigint").alias("words"),
        F.octet_length(text).cast("bigint").alias("bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("digest")), "counted")
    first = counted.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("first_id"))
    marked = written(counted.join(first, "digest", "left").withColumn(
        "copy", F.coalesce(F.col("first_id") < F.col("doc_id"), F.lit(False))), "marked")

    def changes(rows: DataFrame, version: str, old: Column, new: Column) -> DataFrame:
        return rows.select("source", "lang", F.lit(version).alias("tokenizer_version"),
                           old.cast("bigint").alias("old_tokens"), new.cast("bigint").alias("new_tokens"))

    none, alive = F.lit(None), marked.where(~F.col("copy"))
    revised = changes(marked.where("spaced <> words"), "words-1", F.col("spaced"), F.col("words"))
    store = scratch_path(spark, "rollups")
    rollups.commit(store, "0001-insert", changes(marked, "words-1", none, F.col("spaced")))
    rollups.commit(store, "0002-revise", revised)
    rollups.commit(store, "0003-delete", changes(marked.where("copy"), "words-1", F.col("words"), none))
    rollups.compact(spark, store)
    rollups.commit(store, "0002-revise", revised)
    rollups.commit(store, "0004-insert", changes(alive, "bytes-2", none, F.col("bytes")))
    return rollups.totals(spark, store)


@query("op12_conversations")
def repaired_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of every conversation after planted damage."""
    return conversations.damaged_and_repaired(table(spark, sf_dir, "conversations"))


@query("op11_vector_codes", vector_codes.codes_sql())
def compressed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every sound vector."""
    return vector_codes.with_label_errors(vector_codes.compress(table(spark, sf_dir, "embeddings")))


@query("op13_html_text", html_text.template_sql())
def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_text.extract(table(spark, sf_dir, "pages"))
