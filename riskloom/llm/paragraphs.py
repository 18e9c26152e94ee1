"""Repeated paragraphs across documents: MinHash bands, exact Jaccard, components.

A paragraph is a line of at least ``MIN_WORDS`` words; equal means equal words
after lower-casing A-Z. Each distinct paragraph gets ``BANDS`` keys, every one
made of ``ROWS`` minima of its 5-word shingles (``recall`` tells how surely a pair
at the threshold shares a key: 0.998 here). Paragraphs that share a key meet in a
task, which verifies their exact Jaccard similarity and returns a spanning
forest of the similar ones, not all pairs. Components over these edges are the
classes; the first paragraph of a class (by document, then place) stays.

Equal paragraphs are one entry with a count, however many documents have them.
A key with more than ``BUCKET`` distinct paragraphs is cut into blocks, and every
two blocks meet in a task of their own, so tasks stay small and no pair is lost.
Buckets with the same members are worked off once.

NULL and empty texts have no paragraphs. Rows with a NULL id take part; their
class sorts them last. Repeated rows repeat their paragraphs and are found. An
empty table gives an empty result. ``remove_repeats`` keeps all columns.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.text import pieces
from riskloom.llm.words import NOT_WHITE, byte_table, hashes, mix, split
from riskloom.session import written

MIN_WORDS = 20
SHINGLE = 5
SIMILAR = 0.8
BANDS, ROWS = 12, 4
BUCKET = 2048

NOT_BREAK = byte_table(lambda b: b != 0x0A)


def recall(similarity: float = SIMILAR, bands: int = BANDS, rows: int = ROWS) -> float:
    """Chance that two paragraphs of a similarity share a key."""
    return 1 - (1 - similarity ** rows) ** bands


def _multipliers(n: int) -> np.ndarray:
    """Odd numbers from SplitMix64."""
    x = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) | np.uint64(1)


class Lines:
    """The paragraphs of a batch of texts and their shingles."""

    def __init__(self, column: pa.Array, min_words: int):
        column = pc.fill_null(column, "")
        words = split(column, NOT_WHITE, lower=True)
        lines = split(column, NOT_BREAK, lower=False)
        first, last = np.searchsorted(words.starts, lines.starts), np.searchsorted(words.starts, lines.ends)
        of = lines.text_of()
        # Place among all lines of the text, empty ones included.
        breaks = np.concatenate([[0], np.cumsum(~NOT_BREAK[lines.data[:-8]])])
        place = breaks[lines.starts] - breaks[lines.texts[of]]
        long = (last - first) >= max(min_words, SHINGLE)
        self.text, self.place = of[long], place[long]
        self.first, self.last = first[long], last[long]
        self.words = self.last - self.first
        keys = hashes(words.data, words.starts, words.ends)
        self.shingle_counts = self.words - SHINGLE + 1
        every = mix(keys, SHINGLE)
        at = np.concatenate([[0], np.cumsum(self.shingle_counts)])
        self.bounds = at
        self.shingles = every[np.repeat(self.first - at[:-1], self.shingle_counts) + np.arange(int(at[-1]))]
        self.unit = self._units(keys)

    def _units(self, keys: np.ndarray) -> np.ndarray:
        """A hash of the words of each paragraph, in order."""
        rank = np.arange(len(keys), dtype=np.uint64)
        out = np.zeros(len(self.first), np.uint64)
        if len(out):
            flat = np.repeat(self.first - np.concatenate([[0], np.cumsum(self.words)])[:-1], self.words) + np.arange(int(self.words.sum()))
            inside = rank[flat] - np.repeat(self.first, self.words).astype(np.uint64)
            x = (keys[flat] ^ (inside * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(32)
            out = np.add.reduceat(x, np.concatenate([[0], np.cumsum(self.words)[:-1]]))
            out = (out ^ self.words.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))

    def band_keys(self, bands: int, rows: int) -> np.ndarray:
        """(paragraphs, bands) keys."""
        n = len(self.unit)
        out = np.zeros((n, bands), np.uint64)
        if not n:
            return out
        odd = _multipliers(bands * rows)
        for b in range(bands):
            key = np.full(n, b, np.uint64)
            for r in range(rows):
                x = self.shingles * odd[b * rows + r]
                x ^= x >> np.uint64(32)
                least = np.minimum.reduceat(x, self.bounds[:-1])
                key = (key ^ least) * np.uint64(0xC2B2AE3D27D4EB4F)
                key ^= key >> np.uint64(31)
            out[:, b] = key
        return out


def _paragraphs(docs: DataFrame, id_column: str, text_column: str, min_words: int, bands: int, rows: int) -> DataFrame:
    """(unit, doc, place, words, keys) of every paragraph."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            lines = Lines(piece.column("text"), min_words)
            keys = lines.band_keys(bands, rows)
            offsets = pa.array(np.arange(len(lines.unit) + 1, dtype=np.int32) * bands)
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.unit.view(np.int64)), piece.column("doc").take(pa.array(lines.text)),
                 pa.array(lines.place.astype(np.int64)), pa.array(lines.words.astype(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(keys.ravel().view(np.int64)))],
                ["unit", "doc", "place", "words", "keys"])

    source = docs.select(F.col(id_column).alias("doc"), F.col(text_column).cast("string").alias("text"))
    kind = source.schema["doc"].dataType.simpleString()
    return source.mapInArrow(run, f"unit bigint, doc {kind}, place bigint, words bigint, keys array<bigint>")


def _texts(docs: DataFrame, text_column: str, min_words: int) -> DataFrame:
    """(unit, shingles) of every paragraph."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            lines = Lines(piece.column("text"), min_words)
            offsets = pa.array(lines.bounds.astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [pa.array(lines.unit.view(np.int64)),
                 pa.ListArray.from_arrays(offsets, pa.array(lines.shingles.view(np.int64)))], ["unit", "shingles"])

    source = docs.select(F.col(text_column).cast("string").alias("text"))
    return source.mapInArrow(run, "unit bigint, shingles array<bigint>")


def similar_forest(sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """Edges that connect all sets whose Jaccard similarity reaches the threshold.

    Each set in turn is compared with those not yet in its class; a bucket whose
    members have become one class needs no further comparison.
    """
    sets = [np.unique(s) for s in sets]
    sizes = np.array([len(s) for s in sets])
    flat = np.concatenate(sets)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    label = np.arange(len(sets))
    edges = []
    for i in range(len(sets) - 1):
        if (label == label[0]).all():
            break
        shared = np.add.reduceat(np.isin(flat, sets[i], assume_unique=False).astype(np.int64), starts)
        near = shared >= threshold * (sizes + sizes[i] - shared) - 1e-9
        for j in np.flatnonzero(near & (label != label[i])).tolist():
            if label[j] != label[i]:
                edges.append((j, i))
                label[label == label[j]] = label[i]
    return edges


def _verify(threshold: float):
    def run(group: pa.Table) -> pa.Table:
        units = group.column("unit").to_pylist()
        sets = [np.array(s, np.int64) for s in group.column("shingles").to_pylist()]
        edges = similar_forest(sets, threshold)
        return pa.table({"a": pa.array([units[j] for j, _ in edges], pa.int64()),
                         "b": pa.array([units[i] for _, i in edges], pa.int64())})

    return run


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = MIN_WORDS,
            threshold: float = SIMILAR, bands: int = BANDS, rows: int = ROWS, bucket: int = BUCKET) -> DataFrame:
    """One row per paragraph that has an equal or similar one.

    Columns: id, paragraph (line number from 0), n_words, component_id and
    component_paragraph (the first paragraph of its class), n_paragraphs (of the
    class), removed (all but the first).
    """
    lines = written(_paragraphs(docs, id_column, text_column, min_words, bands, rows), "paragraphs")
    place = F.struct(F.col("doc").isNull().alias("none"), "doc", "place")
    units = written(lines.groupBy("unit").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("copies"),
                                              F.first("keys").alias("keys")), "units")

    keyed = units.select("unit", F.explode("keys").alias("key"))
    sized = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    members = written(keyed.join(sized, "key"), "members")
    # Buckets with the same members are one.
    same = F.sum(F.xxhash64("unit").cast("decimal(38,0)"))
    one = (members.groupBy("key").agg(same.alias("mark"), F.first("n").alias("n"))
           .groupBy("mark", "n").agg(F.min("key").alias("key")).select("key"))
    chosen = members.join(one, "key")
    blocks = F.ceil(F.col("n") * 2 / F.lit(bucket)).cast("int")
    own = F.pmod(F.xxhash64("unit", F.lit(1)), blocks).cast("int")
    meets = (chosen.withColumn("blocks", blocks).withColumn("own", own)
             .withColumn("other", F.explode(F.when(F.col("n") <= bucket, F.array(F.lit(0)))
                                            .otherwise(F.sequence(F.lit(0), F.col("blocks") - 1))))
             .select("unit", F.when(F.col("n") <= bucket, F.col("key")).otherwise(
                 F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other"))).alias("group")))
    wanted = meets.select("unit").distinct()
    shingles = (_texts(docs, text_column, min_words).join(wanted, "unit")
                .groupBy("unit").agg(F.first("shingles").alias("shingles")))
    edges = meets.join(shingles, "unit").groupBy("group").applyInArrow(_verify(threshold), "a bigint, b bigint")

    classes = components(edges)
    named = units.join(classes, units["unit"] == classes["node"], "left").select(
        "unit", "first", "copies", F.coalesce("component", "unit").alias("class"))
    whole = (named.groupBy("class").agg(F.min("first").alias("first"), F.sum("copies").alias("n_paragraphs"))
             .where("n_paragraphs > 1"))
    by_unit = named.select("unit", "class").join(whole, "class").select(
        F.col("unit").alias("_unit"), F.col("first").alias("_first"), "n_paragraphs")
    found = lines.join(by_unit, lines["unit"] == by_unit["_unit"])
    first = F.col("doc").eqNullSafe(F.col("_first.doc")) & (F.col("place") == F.col("_first.place"))
    return found.select(F.col("doc").alias(id_column), F.col("place").alias("paragraph"), F.col("words").alias("n_words"),
                        F.col("_first.doc").alias("component_id"), F.col("_first.place").alias("component_paragraph"),
                        "n_paragraphs", (~first).alias("removed"))


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """The documents without the paragraphs that repeat an earlier one; documents without id stay as they are."""
    found = repeats(docs, id_column, text_column, **options)
    # One number per removed line of a document.
    cut = (found.where(F.col("removed") & F.col(id_column).isNotNull()).groupBy(F.col(id_column).alias("_cut_id"))
           .agg(F.collect_set("paragraph").alias("_cut")))
    joined = docs.join(cut, docs[id_column] == cut["_cut_id"], "left")
    left = F.filter(F.split(docs[text_column], "\n", -1), lambda line, i: ~F.array_contains(cut["_cut"], i.cast("bigint")))
    text = F.when(cut["_cut"].isNull(), docs[text_column]).otherwise(F.array_join(left, "\n"))
    return joined.select(*[text.alias(c) if c == text_column else docs[c] for c in docs.columns])
