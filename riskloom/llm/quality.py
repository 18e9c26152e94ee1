"""Quality rules: fixed limits, then boosted trees over statistics of the whole text.

``fit_quality`` learns from at most ``SAMPLE_ROWS`` labelled documents, those
whose id has the smallest hash, so the sample does not depend on partitions.
The trees are a few kilobytes of node arrays that travel with the task.
``judge`` and ``keep_good`` read each text once and shuffle nothing.

A text without words (NULL, empty, white space) fails the fixed limits, as does
any with fewer than ``MIN_WORDS`` words or more than half of its words in
3-word windows that repeat. Labels that are NULL or belong to no document are
not used, a document labelled more than once counts as good only if all its
labels say so. Without labels of both kinds the verdict is the commoner label,
and good if there are none. Other columns, whatever their names, pass through
``keep_good`` untouched.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import boosted
from riskloom.llm.text import pieces
from riskloom.llm.words import NOT_WHITE, Words, byte_table, hashes, mix, split

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# Bound of the labelled documents that the trees are fitted on.
SAMPLE_ROWS = 20_000
GOOD = 0.5

SYMBOL = byte_table(lambda b: chr(b) in "#*$%&|<>" and b < 0x80)
UPPER = byte_table(lambda b: 65 <= b <= 90)
DIGIT = byte_table(lambda b: 48 <= b <= 57)
MARK = byte_table(lambda b: b < 0x80 and chr(b) in "!?.,;:'\"()[]{}")
EXCITED = byte_table(lambda b: b < 0x80 and chr(b) in "!?")
BEGINS = byte_table(lambda b: b & 0xC0 != 0x80)  # first byte of a character
NOT_BREAK = byte_table(lambda b: b != 0x0A)

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Statistics that the trees see, and how the chance of a good text may move with each.
FEATURES = {
    "log_words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1,
    "upper_share": -1, "digit_share": 0, "mark_share": 0, "excited_share": -1, "distinct_share": 0,
    "top_word_share": -1, "words_per_line": 0, "non_ascii_share": 0,
}


def _sum_by_text(flags: np.ndarray, texts: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[texts[1:]] - total[texts[:-1]]


def _by_text(keys: np.ndarray, text: np.ndarray) -> np.ndarray:
    """The keys, told apart by text."""
    out = keys ^ (text.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    out *= np.uint64(0xFF51AFD7ED558CCD)
    return out ^ (out >> np.uint64(33))


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of a first member, size) of each group of equal keys."""
    _, first, size = np.unique(keys, return_index=True, return_counts=True)
    return first, size


def statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(counts, features) per text of a string column; NULL counts as empty."""
    words = split(pc.fill_null(column, ""), NOT_WHITE, lower=False)
    n_texts, texts, data = len(words.texts) - 1, words.texts, words.data[:-8]
    n_words = words.counts()
    of = words.text_of()
    white = ~NOT_WHITE[data]
    word_chars = _sum_by_text(BEGINS[data] & ~white, texts)
    symbols = _sum_by_text(SYMBOL[data], texts)

    lines = split(pc.fill_null(column, ""), NOT_BREAK, lower=False)
    line_of = lines.text_of()
    has_word = np.searchsorted(words.starts, lines.ends) > np.searchsorted(words.starts, lines.starts)
    line_keys = _by_text(hashes(lines.data, lines.starts, lines.ends), line_of)[has_word]
    line_of = line_of[has_word]
    n_lines = np.bincount(line_of, minlength=n_texts)
    first, _ = _groups(line_keys)
    dup_lines = n_lines - np.bincount(line_of[first], minlength=n_texts)

    word_keys = hashes(words.data, words.starts, words.ends)
    repeated = _repeats(word_keys, of)
    repeat_words = np.bincount(of[repeated], minlength=n_texts)
    first, size = _groups(_by_text(word_keys, of))
    distinct = np.bincount(of[first], minlength=n_texts)
    top = np.zeros(n_texts, np.int64)
    np.maximum.at(top, of[first], size)

    counts = np.stack([n_words, word_chars, symbols, dup_lines, repeat_words], axis=1).astype(np.int64)
    chars, some, some_lines = np.maximum(word_chars, 1), np.maximum(n_words, 1), np.maximum(n_lines, 1)
    wide = _sum_by_text(BEGINS[data] & (data >= 0x80), texts)
    features = np.stack([
        np.log1p(n_words), word_chars / some, symbols / chars, dup_lines / some_lines, repeat_words / some,
        _sum_by_text(UPPER[data], texts) / chars, _sum_by_text(DIGIT[data], texts) / chars,
        _sum_by_text(MARK[data], texts) / chars, _sum_by_text(EXCITED[data], texts) / chars, distinct / some,
        top / some, n_words / some_lines, wide / chars], axis=1).astype(np.float64)
    return counts, features


def _repeats(word_keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each word lies in a 3-word window found twice or more in its text."""
    covered = np.zeros(len(word_keys), bool)
    if len(word_keys) < 3:
        return covered
    inside = np.flatnonzero(of[2:] == of[:-2])
    keys = _by_text(mix(word_keys, 3)[inside], of[inside])
    _, group, size = np.unique(keys, return_inverse=True, return_counts=True)
    twice = inside[size[group] > 1]
    for i in range(3):
        covered[twice + i] = True
    return covered


def base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


def fit_quality(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                label_column: str = "quality", sample_rows: int = SAMPLE_ROWS) -> boosted.Trees:
    """Trees fitted on at most ``sample_rows`` labelled documents."""
    key = F.col(id_column).cast("bigint").alias("_key")
    chosen = (labels.select(key, F.col(label_column).alias("_label")).where("_key IS NOT NULL AND _label IS NOT NULL")
              .groupBy("_key").agg((F.min("_label") > 0).cast("int").alias("_label"))
              .orderBy(F.xxhash64("_key"), "_key").limit(sample_rows))
    texts = docs.select(key, F.col(text_column).cast("string").alias("_text"))
    # At most sample_rows keys and labels: 16 bytes each.
    sample = texts.join(F.broadcast(chosen), "_key").select("_key", "_label", "_text")

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            _, features = statistics(piece.column("_text"))
            flat = pa.FixedSizeListArray.from_arrays(pa.array(features.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([piece.column("_key"), piece.column("_label"), flat], ["key", "label", "x"])

    rows = (sample.mapInArrow(measure, "key bigint, label int, x array<double>")
            .orderBy(F.xxhash64("key"), "key", F.col("x")).limit(sample_rows).collect())
    x = np.array([r["x"] for r in rows], np.float64).reshape(len(rows), len(FEATURES))
    y = np.array([r["label"] for r in rows], np.float64)
    if not len(rows):
        return boosted.constant(0.999)
    return boosted.fit(x, y, np.array(list(FEATURES.values())))


def _verdict(column: pa.Array, trees: boosted.Trees) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    counts, features = statistics(column)
    failed, score = base_failed(counts), trees.probability(features)
    return counts, failed, score, ~failed & (score >= GOOD)


def judge(docs: DataFrame, trees: boosted.Trees, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, counts, base_failed, kept, score) of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            counts, failed, score, kept = _verdict(piece.column("_text"), trees)
            yield pa.RecordBatch.from_arrays(
                [piece.column("_id"), *[pa.array(counts[:, j]) for j in range(len(COUNTS))], pa.array(failed),
                 pa.array(kept), pa.array(score)], [id_column, *COUNTS, "base_failed", "kept", "score"])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    kind = rows.schema["_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_column}` {kind}, " + ", ".join(f"{c} bigint" for c in COUNTS)
                           + ", base_failed boolean, kept boolean, score double")


def keep_good(docs: DataFrame, trees: boosted.Trees, text_column: str = "text") -> DataFrame:
    """The documents with a good verdict, all columns as they were."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, text_column):
            yield piece.filter(pa.array(_verdict(piece.column(text_column), trees)[3]))

    return docs.mapInArrow(run, docs.schema)
