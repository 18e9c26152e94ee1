"""Repeated passages across documents, wherever lines begin and end: exact runs of words.

A passage is a run of at least ``PASSAGE`` words that another document also
has; words are equal after lower-casing A-Z and whatever white space separates
them. ``shared_passages`` finds every one, in full length:

* each run of ``PASSAGE`` words has an anchor, the least hash of the runs of
  ``ANCHOR`` words in it. Equal runs have equal anchors, and neighbouring runs
  mostly share one, so a document has about 5 anchors in 100 words. Runs whose
  anchor no other document has are dropped; nothing is sampled.
* the runs left are joined by their own hash. Those that two documents have are
  shared; neighbours that begin in the same document make one passage.

Equal texts are worked off once, with a count. Runs are told apart by a 64-bit
hash: among n of them about n^2 / 2^65 pairs would wrongly count as equal.

``remove_passages`` cuts them out of all documents but the first that has them.
``repeats`` adds the lines that are equal or similar as a whole (see
``paragraphs``), which may be shorter than a passage or edited.

NULL texts and texts of fewer words have no passages. Rows with a NULL id take
part and sort last. Rows with the same text hold it twice, whatever their ids.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import paragraphs
from riskloom.llm.text import pieces
from riskloom.llm.words import NOT_WHITE, hashes, mix, split
from riskloom.session import written

PASSAGE = 50
ANCHOR = 12


def _over(values: np.ndarray, width: int, combine) -> np.ndarray:
    """``combine`` of each run of ``width`` values, by runs of doubled length."""
    n, length = len(values) - width + 1, 1
    if n <= 0:
        return values[:0]
    while 2 * length <= width:
        values = combine(values[:-length], values[length:])
        length *= 2
    return combine(values[:n], values[width - length:width - length + n])


class Runs:
    """The runs of ``passage`` words of a batch of texts, with their anchors."""

    def __init__(self, column: pa.Array, passage: int, anchor: int):
        words = split(pc.fill_null(column, ""), NOT_WHITE, lower=True)
        self.words, self.passage = words, passage
        self.keys = hashes(words.data, words.starts, words.ends)
        counts = np.maximum(words.counts() - passage + 1, 0)
        at = np.concatenate([[0], np.cumsum(counts)])
        self.text = np.repeat(np.arange(len(counts)), counts)
        self.place = np.arange(int(at[-1])) - at[self.text]
        self.begin = words.first[self.text] + self.place
        width = min(anchor, passage)
        self.anchor = _over(mix(self.keys, width), passage - width + 1, np.minimum)[self.begin]

    def hashed(self) -> np.ndarray:
        """A hash of the words of each run, in order."""
        # Left and right half of a doubled run must not be swapped unnoticed.
        odd = np.uint64(0xD6E8FEB86659FD93)

        def join(left: np.ndarray, right: np.ndarray) -> np.ndarray:
            out = (left * odd) ^ (right + (left >> np.uint64(29)))
            out = (out ^ (out >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
            return out ^ (out >> np.uint64(31))

        return _over(self.keys, self.passage, join)[self.begin]

    def line(self) -> np.ndarray:
        """Number of the line, from 0, where each run begins."""
        breaks = np.concatenate([[0], np.cumsum(self.words.data[:-8] == 0x0A)])
        return breaks[self.words.starts[self.begin]] - breaks[self.words.texts[self.text]]


def _anchors(texts: DataFrame, passage: int, anchor: int) -> DataFrame:
    """(key, anchor) of every text, each anchor once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            runs = Runs(piece.column("text"), passage, anchor)
            new = np.ones(len(runs.text), bool)
            new[1:] = (runs.anchor[1:] != runs.anchor[:-1]) | (runs.text[1:] != runs.text[:-1])
            pairs = np.unique(np.stack([runs.text[new].astype(np.uint64), runs.anchor[new]]), axis=1)
            yield pa.RecordBatch.from_arrays([piece.column("key").take(pa.array(pairs[0].astype(np.int64))),
                                              pa.array(pairs[1].view(np.int64))], ["key", "anchor"])

    return texts.mapInArrow(run, "key bigint, anchor bigint")


def _runs(marked: DataFrame, passage: int, anchor: int) -> DataFrame:
    """(run, rank, copies, place, line) of the runs whose anchor is among the ``anchors`` of their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            runs = Runs(piece.column("text"), passage, anchor)
            lists = piece.column("anchors")
            ends = np.searchsorted(runs.text, np.arange(len(lists) + 1))
            keep = np.concatenate([np.zeros(0, bool)] + [
                np.isin(runs.anchor[a:b].view(np.int64), lists[i].values.to_numpy())
                for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist()))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(runs.hashed()[keep].view(np.int64)), *[piece.column(c).take(pa.array(runs.text[keep])) for c in ("rank", "copies")],
                 pa.array(runs.place[keep].astype(np.int32)), pa.array(runs.line()[keep].astype(np.int32))],
                ["run", "rank", "copies", "place", "line"])

    return marked.select("rank", "copies", "text", "anchors").mapInArrow(
        run, "run bigint, rank bigint, copies bigint, place int, line int")


def shared_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passage: int = PASSAGE,
                    anchor: int = ANCHOR) -> DataFrame:
    """One row per maximal passage of a document that begins in one and the same other document, or in itself.

    Columns: id, paragraph (line, from 0, where it begins), start (word, from 0),
    n_words, component_id, component_paragraph and component_start (where its
    first words stand in the first document that has them), n_paragraphs
    (documents that have them, at most), removed (this document is not the
    first). Every word of a run that another document has is in a row.
    """
    return _located(docs, id_column, text_column, passage, anchor).withColumnRenamed("doc", id_column).drop("key")


def _located(docs: DataFrame, id_column: str, text_column: str, passage: int, anchor: int) -> DataFrame:
    """``shared_passages`` with a hash of the text, which tells rows with one id apart."""
    text = F.col(text_column).cast("string")
    rows = docs.select(F.col(id_column).alias("doc"), F.xxhash64(text).alias("key"), text.alias("text")).where("text IS NOT NULL")
    anchors = written(_anchors(rows.select("key", "text"), passage, anchor), "anchors")
    common = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    marks = anchors.join(common, "anchor", "left_semi").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    # Texts are numbered in the order of their first documents.
    place = F.struct(F.col("doc").isNull().alias("none"), "doc")
    holders = rows.groupBy("key").agg(F.min(place).alias("holder"), F.count(F.lit(1)).alias("copies")).join(marks, "key")
    numbered = written(holders.orderBy("holder.none", "holder.doc", "key").select(
        "key", F.monotonically_increasing_id().alias("rank"), F.col("holder.doc").alias("o_doc"), "copies", "anchors"), "numbered")
    texts = rows.select("key", "text").dropDuplicates(["key"])
    runs = written(_runs(texts.join(numbered, "key"), passage, anchor), "runs")

    # The first text of each run that two documents have; a text that several have stands for a later one, too.
    later = F.when(F.col("copies") > 1, F.lit((1 << 63) - 1)).otherwise(F.col("rank"))
    shared = (runs.groupBy("run").agg(F.min(F.struct("rank", "place", "line")).alias("origin"), F.max(later).alias("last"),
                                      F.sum("copies").alias("n"))
              .where(F.col("last") > F.col("origin.rank"))
              .select("run", F.col("origin.rank").alias("o_rank"), F.col("origin.place").alias("o_place"),
                      F.col("origin.line").alias("o_line"), "n"))
    found = runs.select("run", "rank", "place", "line").join(shared, "run").drop("run")

    # Neighbours: place less rank is the same.
    order = Window.partitionBy("rank", "o_rank").orderBy("place")
    spans = (found.withColumn("island", F.col("place") - F.row_number().over(order))
             .groupBy("rank", "o_rank", "island").agg(
                 F.min(F.struct("place", "line", "o_place", "o_line")).alias("at"), F.max("place").alias("last"),
                 F.max("n").alias("n")))
    spans = written(spans, "spans")
    # Own passages stand where they are.
    own = F.col("rank") == F.col("o_rank")
    flat = spans.select(
        "rank", "o_rank", own.alias("own"), F.col("at.line").alias("line"), F.col("at.place").alias("start"),
        (F.col("last") - F.col("at.place") + passage).alias("n_words"),
        F.when(own, F.col("at.line")).otherwise(F.col("at.o_line")).alias("o_line"),
        F.when(own, F.col("at.place")).otherwise(F.col("at.o_place")).alias("o_place"), "n")
    origins = numbered.select(F.col("rank").alias("o_rank"), "o_doc")
    flat = flat.join(numbered.select("key", "rank"), "rank").join(origins, "o_rank")
    out = rows.select("doc", "key").join(flat, "key")
    first = F.col("own") & F.col("doc").eqNullSafe(F.col("o_doc"))
    return out.select(
        "doc", "key", F.col("line").cast("bigint").alias("paragraph"), F.col("start").cast("bigint").alias("start"),
        F.col("n_words").cast("bigint").alias("n_words"), F.col("o_doc").alias("component_id"),
        F.col("o_line").cast("bigint").alias("component_paragraph"), F.col("o_place").cast("bigint").alias("component_start"),
        F.col("n").cast("bigint").alias("n_paragraphs"), (~first).alias("removed"))


def repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """Passages (kind ``passage``) and lines that repeat one another as a whole (kind ``line``, without starts)."""
    spans = shared_passages(docs, id_column, text_column).withColumn("kind", F.lit("passage"))
    none = F.lit(None).cast("bigint")
    lines = paragraphs.repeats(docs, id_column, text_column, **options).withColumns(
        {"start": none, "component_start": none, "kind": F.lit("line")})
    return spans.unionByName(lines)


def _without(column: pa.Array, counts: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """The texts without spans of words; ``counts`` spans of each text, in order. White space around a span stays."""
    words = split(column, NOT_WHITE, lower=False)
    first = np.repeat(words.first[:-1], counts) + starts
    # Spans may overlap, so their ends are counted against their beginnings.
    depth = np.zeros(len(words.data) - 8 + 1, np.int32)
    np.add.at(depth, words.starts[first], 1)
    np.add.at(depth, words.ends[first + lengths - 1], -1)
    kept = np.cumsum(depth[:-1]) == 0
    places = np.concatenate([[0], np.cumsum(kept)])[words.texts]
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(column), [
        None, pa.py_buffer(places.astype(np.int64)), pa.py_buffer(words.data[:-8][kept])]).cast(pa.large_string()).cast(pa.string())


def remove_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", passage: int = PASSAGE,
                    anchor: int = ANCHOR) -> DataFrame:
    """The documents without the passages that an earlier document has, all other text as it is.

    Of every run of ``passage`` words the first document keeps it, and no word
    goes that does not stand in an earlier document. Documents without id and
    rows without such a passage stay as they are, as do repeated rows of the
    first document; all columns are kept. Spans of a document travel as one list,
    which is no longer than its text.
    """
    found = _located(docs, id_column, text_column, passage, anchor).where("removed AND doc IS NOT NULL")
    # Rows with the same id and text have the same spans.
    cut = (found.select("doc", "key", "start", "n_words").distinct().groupBy(F.col("doc").alias("_cut_id"), F.col("key").alias("_cut_key"))
           .agg(F.collect_list(F.struct("start", "n_words")).alias("spans")))
    whole = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_column].alias("id"),
                        docs[text_column].cast("string").alias("text"))
    marked = whole.withColumn("key", F.xxhash64("text")).join(
        cut, (F.col("id") == F.col("_cut_id")) & (F.col("key") == F.col("_cut_key")), "left").select(
        "row", "text", F.col("spans.start").alias("starts"), F.col("spans.n_words").alias("lengths"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "text"):
            lists, texts = piece.column("starts"), piece.column("text")
            hit = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            if hit.any():
                starts, lengths = (pc.list_flatten(piece.column(c)).to_numpy().astype(np.int64) for c in ("starts", "lengths"))
                # A NULL text has no spans and stays NULL.
                texts = pc.if_else(pc.is_null(texts), texts, _without(pc.fill_null(texts, ""), hit, starts, lengths))
            yield pa.RecordBatch.from_arrays([piece.column("row"), texts], ["row", "text"])

    kind = marked.schema["row"].dataType.simpleString()
    left = marked.mapInArrow(run, f"row {kind}, text string")
    return left.select(*[F.col("text").alias(c) if c == text_column else F.col("row").getField(c).alias(c) for c in docs.columns])
