"""Benchmark decontamination: windows of benchmark words looked up while training texts are scanned.

A word is a run of ASCII letters and digits, lower-cased, and of characters
beyond ASCII. A window is ``width`` consecutive words of an item; an item of
fewer words is one window. A document word is hit if it lies inside any
occurrence of a window.

The windows travel as a hash set. Its size is checked: a benchmark of more than
``block_words`` words is cut into blocks of windows, and the documents pass
through one block after the other, written in between. Window hits are verified
word for word; documents are never shuffled.

NULL texts and texts without words have no hits, items without words (or id)
have no windows (are not named but hit). Equal items are both found. Empty
tables give empty or clean results.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.text import pieces
from riskloom.llm.words import ALNUM, Words, hashes, split
from riskloom.session import written

WIDTH = 13
# Words of benchmark text whose windows one broadcast holds: about 200 MB of arrays at the limit.
BLOCK_WORDS = 1_000_000
# Words of an item that travel as one row; longer items are cut with an overlap of a window.
SEGMENT_WORDS = 4096
# 20 * hit >= words
CONTAMINATED = 20


@dataclass
class WindowSet:
    """Windows of one length as rows of word numbers, sorted by hash."""

    width: int
    rows: np.ndarray
    keys: np.ndarray
    items: list[tuple]  # ids of the items with the window
    pairs: np.ndarray  # flags by hash of the first two words


PAIR_BITS = 22
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _pair(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    mixed = (first.astype(np.uint64) * np.uint64(0x1000003) + second.astype(np.uint64)) * _ODD
    return (mixed >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def _row_keys(rows: np.ndarray) -> np.ndarray:
    h = np.full(len(rows), rows.shape[1], np.uint64)
    for j in range(rows.shape[1]):
        h ^= rows[:, j].astype(np.uint64)
        h *= _ODD
        h ^= h >> np.uint64(31)
    return h


class Windows:
    """The windows of a block of items: the vocabulary by hash and one set per window length."""

    def __init__(self, segments: list[tuple], width: int):
        """``segments``: (item id, text, whether it is the whole item)."""
        words = split(pa.array([t for _, t, _ in segments], pa.string()), ALNUM, lower=True)
        keys = hashes(words.data, words.starts, words.ends)
        self.vocabulary, first, number = np.unique(keys, return_index=True, return_inverse=True)
        self.checks = hashes(words.data, words.starts, words.ends, 1)[first]
        by_width: dict[int, dict[tuple, set]] = {}
        for k, (item, _, whole) in enumerate(segments):
            ids = number[words.first[k]:words.first[k + 1]].tolist()
            if not ids or (len(ids) < width and not whole):
                continue
            w = min(width, len(ids))
            known = by_width.setdefault(w, {})
            for i in range(len(ids) - w + 1):
                known.setdefault(tuple(ids[i:i + w]), set()).add(item)
        self.sets = []
        for w, known in sorted(by_width.items()):
            rows = np.array(list(known), np.int32).reshape(-1, w)
            row_keys = _row_keys(rows)
            order = np.argsort(row_keys, kind="stable")
            pairs = np.zeros(1 << PAIR_BITS, bool)
            if w > 1:
                pairs[_pair(rows[:, 0], rows[:, 1])] = True
            items = [tuple(known[tuple(r)]) for r in rows[order].tolist()]
            self.sets.append(WindowSet(w, rows[order], row_keys[order], items, pairs))

    def numbers(self, words: Words) -> np.ndarray:
        """Number of each word in the vocabulary, else -1."""
        if not len(self.vocabulary) or not len(words):
            return np.full(len(words), -1, np.int32)
        keys = hashes(words.data, words.starts, words.ends)
        at = np.minimum(np.searchsorted(self.vocabulary, keys), len(self.vocabulary) - 1)
        found = np.flatnonzero(self.vocabulary[at] == keys)
        out = np.full(len(words), -1, np.int32)
        same = hashes(words.data, words.starts[found], words.ends[found], 1) == self.checks[at[found]]
        out[found[same]] = at[found[same]]
        return out

    def find(self, words: Words) -> Iterator[tuple[int, int, tuple]]:
        """(first word, length, item ids) of each occurrence, texts kept apart."""
        numbers = self.numbers(words)
        known = numbers >= 0
        for s in self.sets:
            w = s.width
            if len(numbers) < w:
                continue
            # A window holds known words of one text only.
            breaks = np.where(known, -1, np.arange(len(numbers)))
            last = np.maximum.accumulate(breaks)
            of = np.searchsorted(words.first, np.arange(len(numbers)), "right")
            n = len(numbers) - w + 1
            at = np.flatnonzero((last[w - 1:] < np.arange(n)) & (of[w - 1:] == of[:n]))
            if w > 1:
                at = at[s.pairs[_pair(numbers[at], numbers[at + 1])]]
            if not len(at):
                continue
            rows = numbers[at[:, None] + np.arange(w)]
            keys = _row_keys(rows)
            first = np.searchsorted(s.keys, keys)
            for i, (k, j) in enumerate(zip(keys.tolist(), first.tolist())):
                while j < len(s.keys) and int(s.keys[j]) == k:
                    if np.array_equal(s.rows[j], rows[i]):
                        yield int(at[i]), w, s.items[j]
                    j += 1


def _segments(benchmark: DataFrame, item_column: str, text_column: str, width: int) -> DataFrame:
    """Rows (item, text, whole, n) of at most SEGMENT_WORDS words; neighbours share width - 1 words."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            words = split(pc.fill_null(piece.column("text"), ""), ALNUM, lower=True)
            rows = []
            for k, item in enumerate(piece.column("item").to_pylist()):
                a, b = int(words.first[k]), int(words.first[k + 1])
                for i in range(a, max(b - width + 1, a + 1) if b > a else a, SEGMENT_WORDS):
                    j = min(b, i + SEGMENT_WORDS + width - 1)
                    rows.append((item, b" ".join(words.word(x) for x in range(i, j)).decode("utf-8", "replace"),
                                 i == a and j == b, j - i))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
                 pa.array([r[2] for r in rows], pa.bool_()), pa.array([r[3] for r in rows], pa.int64())],
                ["item", "text", "whole", "n"])

    rows = benchmark.select(F.col(item_column).cast("string").alias("item"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(cut, "item string, text string, whole boolean, n bigint")


def window_blocks(benchmark: DataFrame, item_column: str = "item_id", text_column: str = "text", width: int = WIDTH,
                  block_words: int = BLOCK_WORDS) -> Iterator[Windows]:
    """The benchmark's windows in blocks of about ``block_words`` words; one block for all but huge benchmarks."""
    segments = written(_segments(benchmark, item_column, text_column, width), "benchmark")
    total = int(segments.agg(F.sum("n")).first()[0] or 0)
    blocks = max(1, -(-total // block_words))
    for k in range(blocks):
        part = segments.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k) if blocks > 1 else segments
        yield Windows([(r["item"], r["text"], r["whole"]) for r in part.orderBy("item", "text").collect()], width)


def _scan(words: Words, windows: Windows, before: tuple[list, list] | None) -> tuple[list, list]:
    """Merged hit ranges [start, end) in words of each text, and its item ids."""
    n = len(words.first) - 1
    ranges: list[list] = [list(map(list, r)) for r in before[0]] if before else [[] for _ in range(n)]
    items: list[set] = [set(i) for i in before[1]] if before else [set() for _ in range(n)]
    for at, width, names in windows.find(words):
        k = int(np.searchsorted(words.first, at, "right")) - 1
        start = at - int(words.first[k])
        ranges[k].append([start, start + width])
        items[k].update(x for x in names if x is not None)
    return [merge(r) for r in ranges], [sorted(i) for i in items]


def merge(ranges: list) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [tuple(r) for r in out]


def scan(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", item_column: str = "item_id",
         benchmark_text: str = "text", width: int = WIDTH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents, columns named c0, c1, ..., with _n_words, _spans (hit ranges of words) and _items (sorted ids)."""
    place = docs.columns.index(text_column)
    docs = out = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # no column can clash
    kept = docs.columns
    blocks = window_blocks(benchmark, item_column, benchmark_text, width, block_words)
    for k, windows in enumerate(blocks):
        shared = docs.sparkSession.sparkContext.broadcast(windows)
        again = k > 0

        def run(batches: Iterator[pa.RecordBatch], shared=shared, again=again) -> Iterator[pa.RecordBatch]:
            for piece in pieces(batches, place):
                words = split(pc.fill_null(piece.column(place).cast(pa.string()), ""), ALNUM, lower=True)
                before = None
                if again:
                    before = piece.column(len(kept) + 1).to_pylist(), piece.column(len(kept) + 2).to_pylist()
                spans, items = _scan(words, shared.value, before)
                new = [pa.array(words.counts().astype(np.int64)), pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                       pa.array(items, pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(piece.columns[:len(kept)] + new,
                                                 names=[*piece.schema.names[:len(kept)], "_n_words", "_spans", "_items"])

        source = written(out, "scanned") if again else out
        out = source.mapInArrow(run, _with_found(docs))
    return out


def _with_found(docs: DataFrame) -> T.StructType:
    return T.StructType([*docs.schema.fields, T.StructField("_n_words", T.LongType()),
                         T.StructField("_spans", T.ArrayType(T.ArrayType(T.IntegerType()))),
                         T.StructField("_items", T.ArrayType(T.StringType()))])


def hit_words() -> Column:
    return F.aggregate("_spans", F.lit(0).cast("bigint"), lambda total, r: total + r[1] - r[0])


def is_contaminated(share: int = CONTAMINATED) -> Column:
    return (hit_words() > 0) & (F.lit(share) * hit_words() >= F.col("_n_words"))


def report(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """(id, n_words, n_hit, n_items, items_sha256, contaminated) of every document."""
    text = options.get("text_column", "text")
    found = scan(docs.select(F.col(id_column), F.col(text)), benchmark, **options)
    return found.select(
        F.col("c0").alias(id_column), F.col("_n_words").alias("n_words"), hit_words().alias("n_hit"),
        F.size("_items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("_items", ",").cast("binary"), 256).alias("items_sha256"),
        is_contaminated().alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that are not contaminated, columns as they were."""
    found = scan(docs, benchmark, **options)
    return found.where(~is_contaminated()).drop("_n_words", "_spans", "_items").toDF(*docs.columns)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text_column: str = "text", **options) -> DataFrame:
    """All documents, hit words cut out of their texts with what stands between them."""
    found = scan(docs, benchmark, text_column=text_column, **options)
    place, kept_columns = docs.columns.index(text_column), len(docs.columns)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, place):
            column = piece.column(place).cast(pa.string())
            words = split(pc.fill_null(column, ""), ALNUM, lower=True)
            texts = column.to_pylist()
            for k, ranges in enumerate(piece.column(kept_columns + 1).to_pylist()):
                if ranges:
                    raw, base, first = texts[k].encode(), int(words.texts[k]), int(words.first[k])
                    kept, at = [], 0
                    for a, b in ranges:
                        kept.append(raw[at:int(words.starts[first + a]) - base])
                        at = int(words.ends[first + b - 1]) - base
                    texts[k] = b"".join([*kept, raw[at:]]).decode()
            columns = piece.columns[:kept_columns]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=piece.schema.names[:kept_columns])

    return found.mapInArrow(cut, docs.schema)


def item_digest(items: list[str]) -> str:
    """What ``items_sha256`` holds for the given item ids."""
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
