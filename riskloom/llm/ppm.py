"""Prediction by partial matching: a byte trie over the corpus scores whole documents.

The model codes the same tokens as the unigram base: a document is its
lower-cased words, one space between them, and an end (byte 0). The trie holds,
for every context of up to ``ORDER`` bytes seen in training, how often each byte
followed it. A byte that the longest known context has not seen costs an escape
(method C: distinct followers / (followers + distinct followers)) and is looked
for in the next shorter context, where the bytes of the longer one are excluded
from the counts. Below the empty context all bytes left are equally likely. The
model is pretrained and does not change while it scores.

Neither the trie nor the word counts are broadcast or collected, both grow with
the corpus:

1. Documents are dealt into chunks of about ``CHUNK_BYTES``. A chunk names its
   distinct (context, byte) strings and words, these by a 64-bit hash, with their
   training counts.
2. Counts are summed by string or word. Tasks that own all strings sharing their last
   ``OWNED`` context bytes turn counts into code lengths: the longer contexts
   are theirs alone, those of up to two bytes come from a table of at most
   256 ** 3 entries (12 bytes each), the only broadcast.
3. The code lengths go back to the chunks that asked, sorted before their documents,
   which then pass by in pieces and add them up.

A task holds the distinct strings and words of one chunk, or the strings of one three-byte suffix (at most
2 ** 24), whatever the corpus.

NULL and empty texts are an end alone. Documents are dealt by id and text, so
NULL ids spread; a NULL id is a training document. Without training documents
all bytes are equally likely and no token is known. An empty table gives an
empty result. Only the id and text columns are read.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm.text import pieces, utf8
from riskloom.llm.words import NOT_WHITE, Words, hashes, split
from riskloom.session import parallelism, written

ORDER = 5
OWNED = 3
CHUNK_BYTES = 32 << 20
# Small corpora still make some chunks, of this size at least.
LEAST_CHUNKS, LEAST_CHUNK_BYTES = 8, 1 << 20
BLOCK = 1 << 20
# Bytes of text that a task turns into strings at a time; each takes about 100 bytes of arrays.
PIECE_BYTES = 1 << 20
LN10 = float(np.log(10.0))
# Marks the end token among the word hashes of a chunk.
END_HASH = np.uint64(0)


def held_out(id_column: Column) -> Column:
    """The fifth of the documents that the model does not learn from."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % 5 == 1, F.lit(False))


# ---- one batch of texts -------------------------------------------------------------------------------------


def stream(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, places to score, text of each of these): ORDER zeros, words with spaces between, end, per text."""
    n = len(words.first) - 1
    lengths = words.ends - words.starts
    total = np.concatenate([[0], np.cumsum(lengths)])
    counts = words.counts()
    sizes = total[words.first[1:]] - total[words.first[:-1]] + np.maximum(counts, 1) + ORDER  # spaces and the end
    begin = np.concatenate([[0], np.cumsum(sizes)])
    out = np.zeros(int(begin[-1]), np.uint8)
    of = words.text_of()
    rank = np.arange(len(words)) - words.first[of]
    at = begin[of] + ORDER + (total[:-1] - total[words.first[of]]) + rank
    shift = np.repeat(at - total[:-1], lengths)
    out[np.arange(int(total[-1])) + shift] = words.data[np.arange(int(total[-1])) + np.repeat(words.starts - total[:-1], lengths)]
    last = np.zeros(len(words), bool)
    last[words.first[1:][counts > 0] - 1] = True
    out[(at + lengths)[~last]] = 0x20
    scored = np.ones(len(out), bool)
    for i in range(ORDER):
        scored[begin[:-1] + i] = False
    return out, np.flatnonzero(scored), np.repeat(np.arange(n), sizes - ORDER)


def grams(text: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(context, byte) at each place as one number: nearest context byte first, farthest last, then the byte."""
    out = np.empty(len(places), np.uint64)
    for a in range(0, len(places), BLOCK):
        at = places[a:a + BLOCK]
        low = int(at[0]) - ORDER
        window = text[low:int(at[-1]) + 1].astype(np.uint64)
        key = window[ORDER:].copy()
        for back in range(1, ORDER + 1):
            key |= window[ORDER - back:len(window) - back] << np.uint64(8 * (ORDER - back + 1))
        out[a:a + BLOCK] = key[at - low - ORDER]
    return out


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and their total counts."""
    key, n = np.concatenate(keys), np.concatenate(counts)
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _gram_counts(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    words = split(piece.column("text"), NOT_WHITE, lower=True)
    text, places, of = stream(words)
    train = ~piece.column("held_out").to_numpy(zero_copy_only=False)[of]
    keys = grams(text, places)
    seen, n = np.unique(keys[train], return_counts=True)
    other = np.unique(keys[~train])
    return _summed([seen, other], [n.astype(np.int64), np.zeros(len(other), np.int64)])


def _word_counts(piece: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(hash, training count) of the distinct words of a piece."""
    words = split(piece.column("text"), NOT_WHITE, lower=True)
    unique, number = np.unique(hashes(words.data, words.starts, words.ends), return_inverse=True)
    train = ~piece.column("held_out").to_numpy(zero_copy_only=False)[words.text_of()]
    return unique, np.bincount(number, train, len(unique)).astype(np.int64)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch | None]]:
    """Pieces of each chunk of a partition sorted by chunk; (chunk, None) ends a chunk."""
    current = None
    for piece in pieces(batches, "text", PIECE_BYTES):
        chunk = piece.column("chunk").to_numpy()
        edges = np.concatenate([[0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(chunk)]])
        for a, b in zip(edges.tolist(), edges[1:].tolist()):
            if current is not None and current != int(chunk[a]):
                yield current, None
            current = int(chunk[a])
            yield current, piece.slice(a, b - a)
    if current is not None:
        yield current, None


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(chunk, is_gram, key, n): the distinct strings and words of each chunk."""
    held = {True: ([], []), False: ([], [])}
    count = {True: _gram_counts, False: _word_counts}
    for chunk, piece in _runs(batches):
        for is_gram, (keys, counts) in held.items():
            if piece is not None:
                k, n = count[is_gram](piece)
                keys.append(k), counts.append(n)
                if len(keys) < 8:
                    continue
            k, n = _summed(keys, counts)
            if piece is not None:
                held[is_gram] = [k], [n]
                continue
            held[is_gram] = [], []
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(k), chunk, np.int32)), pa.array(np.full(len(k), is_gram)),
                 pa.array(k.view(np.int64)), pa.array(n)], ["chunk", "is_gram", "key", "n"])


# ---- the trie -----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Level:
    """Contexts of one length: sorted (context, byte) pairs with counts, and totals by context."""

    pairs: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray

    @staticmethod
    def of(pairs: np.ndarray, counts: np.ndarray) -> Level:
        pairs, counts = _summed([pairs], [counts])
        contexts, first, distinct = np.unique(pairs >> np.uint64(8), return_index=True, return_counts=True)
        total = np.add.reduceat(counts, first) if len(first) else counts
        return Level(pairs, counts, contexts, total, distinct)

    def shorter(self) -> Level:
        """The level without the farthest context byte."""
        return Level.of((self.pairs >> np.uint64(16) << np.uint64(8)) | (self.pairs & np.uint64(255)), self.counts)

    def pair_counts(self, pairs: np.ndarray) -> np.ndarray:
        return _look(self.pairs, self.counts, pairs)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def code_lengths(gram: np.ndarray, n: np.ndarray, low: list[Level]) -> np.ndarray:
    """ln of the probability of each gram's byte after its context.

    ``gram`` ascends and holds every training gram of its last OWNED context
    bytes; ``low`` has the levels 0 .. OWNED - 1 of the whole corpus.
    """
    levels = {ORDER: Level.of(gram[n > 0], n[n > 0])}
    for order in range(ORDER - 1, OWNED - 1, -1):
        levels[order] = levels[order + 1].shorter()
    levels |= dict(enumerate(low))

    out = np.zeros(len(gram))
    open_ = np.arange(len(gram))  # grams whose byte is not found yet
    longer = np.zeros(len(gram), bool)  # whether the next longer context was seen
    for order in range(ORDER, -1, -1):
        level = levels[order]
        drop = np.uint64(8 * (ORDER - order))
        context = gram[open_] >> np.uint64(8) >> drop
        byte = gram[open_] & np.uint64(255)
        total, distinct = _look(level.contexts, level.total, context), _look(level.contexts, level.distinct, context)
        seen = total > 0
        if order < ORDER:
            # Bytes after the next longer context have been ruled out.
            above = levels[order + 1]
            base = (above.pairs >> np.uint64(16) << np.uint64(8)) | (above.pairs & np.uint64(255))
            starts = np.searchsorted(above.pairs >> np.uint64(8), above.contexts)
            ruled = np.add.reduceat(level.pair_counts(base), starts) if len(starts) else np.zeros(0, np.int64)
            wide = gram[open_] >> np.uint64(8) >> (drop - np.uint64(8))
            was = longer[open_]
            total = total - np.where(was, _look(above.contexts, ruled, wide), 0)
            distinct = distinct - np.where(was, _look(above.contexts, above.distinct, wide), 0)
        count = level.pair_counts((context << np.uint64(8)) | byte)
        whole = np.maximum(total + distinct, 1)
        found = count > 0
        out[open_[found]] += np.log(count[found] / whole[found])
        escapes = ~found & (total > 0)
        out[open_[escapes]] += np.log(distinct[escapes] / whole[escapes])
        longer[open_] = seen
        open_ = open_[~found]
    if len(open_):
        known = int(low[0].distinct[0]) if len(low[0].distinct) else 0
        out[open_] -= np.log(max(256 - known, 1))
    return out


def _low_levels(counts: DataFrame) -> list[Level]:
    """Levels 0 .. OWNED - 1 of the corpus; at most 256 ** OWNED rows reach the driver."""
    shift = 8 * (ORDER - OWNED + 1)
    pair = F.shiftright("gram", 8 + shift) * 256 + F.col("gram").bitwiseAND(F.lit(255))
    rows = (counts.where("n > 0").groupBy(pair.alias("pair")).agg(F.sum("n").alias("n"))
            .select("pair", "n").toArrow())
    top = Level.of(rows.column("pair").to_numpy().astype(np.uint64), rows.column("n").to_numpy().astype(np.int64))
    levels = [top]
    for _ in range(OWNED - 1):
        levels.append(levels[-1].shorter())
    return levels[::-1]


def trie(counts: DataFrame) -> DataFrame:
    """(gram, cost) of every (gram, n) row: ln of the probability of its byte."""
    low = counts.sparkSession.sparkContext.broadcast(_low_levels(counts))
    suffix = np.uint64(8 * (ORDER - OWNED + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            gram, n = batch.column("gram").to_numpy().view(np.uint64), batch.column("n").to_numpy()
            if rest is not None:
                gram, n = np.concatenate([rest[0], gram]), np.concatenate([rest[1], n])
            if not len(gram):
                continue
            # All but the last suffix are complete.
            cut = int(np.searchsorted(gram, gram[-1] >> suffix << suffix))
            if cut >= BLOCK:
                yield result(gram[:cut], n[:cut])
                gram, n = gram[cut:], n[cut:]
            rest = gram, n
        if rest is not None and len(rest[0]):
            yield result(*rest)

    def result(gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(code_lengths(gram, n, low.value))],
                                          ["gram", "cost"])

    owner = F.shiftright("gram", 8 * (ORDER - OWNED + 1))
    owned = counts.repartition(parallelism(counts.sparkSession), owner).sortWithinPartitions("gram")
    return owned.mapInArrow(run, "gram bigint, cost double")


# ---- scoring ------------------------------------------------------------------------------------------------


# Kinds of rows a chunk's task reads, in this order: answers first, so that the documents can pass by one piece at a time.
GRAM, WORD, DOCUMENT = 0, 1, 2


def _score_chunks(tokens: int, types: int):
    total = tokens + 0.5 * (types + 1)

    def scored(piece: pa.RecordBatch, gram: np.ndarray, cost: np.ndarray, word: np.ndarray, count: np.ndarray) -> pa.RecordBatch:
        words = split(piece.column("text"), NOT_WHITE, lower=True)
        n, of = len(piece), words.text_of()
        ends = float(count[0]) if len(word) and word[0] == END_HASH else 0.0
        c = _value(word, count, hashes(words.data, words.starts, words.ends))
        base = np.bincount(of, np.log10((c + 0.5) / total), n) + np.log10((ends + 0.5) / total)
        known = np.bincount(of, c > 0, n).astype(np.int64) + (ends > 0)
        text, places, at = stream(words)
        score = np.bincount(at, _value(gram, cost, grams(text, places)), n) / LN10
        return pa.RecordBatch.from_arrays(
            [piece.column("id"), pa.array(piece.column("key").to_numpy() != 0), pa.array(words.counts().astype(np.int64) + 1),
             pa.array(known), pa.array(np.full(n, tokens, np.int64)), pa.array(base), pa.array(score)],
            ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, held, answers = None, {GRAM: [], WORD: []}, None
        for batch in batches:
            place = batch.column("place").to_numpy()
            edges = np.concatenate([[0], np.flatnonzero(place[1:] != place[:-1]) + 1, [len(place)]])
            for a, b in zip(edges.tolist(), edges[1:].tolist()):
                if a == b:
                    continue
                part, (chunk, kind) = batch.slice(a, b - a), divmod(int(place[a]), 4)
                if chunk != current:
                    current, held, answers = chunk, {GRAM: [], WORD: []}, None
                if kind != DOCUMENT:
                    held[kind].append((part.column("key").to_numpy().copy(), part.column("value").to_numpy().copy()))
                    continue
                if answers is None:
                    answers = [*_answers(held.pop(GRAM)), *_answers(held.pop(WORD))]
                for piece in pieces(iter([part]), "text", PIECE_BYTES):
                    yield scored(piece, *answers)

    return run


def _answers(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0)
    return _sorted(np.concatenate([k for k, _ in parts]).view(np.uint64), np.concatenate([v for _, v in parts]))


def _sorted(key: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    return key[order], value[order]


def _value(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Values of keys that are all there; looked up once per distinct key."""
    if not len(wanted):
        return np.zeros(0)
    order = np.argsort(wanted, kind="stable")
    ranked = wanted[order]
    fresh = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    found = values[np.searchsorted(keys, ranked[fresh])]
    out = np.empty(len(wanted))
    out[order] = found[np.cumsum(fresh) - 1]
    return out


def release(spark) -> None:
    """Lets Spark's cleaner drop the shuffle files of jobs that are done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def score(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", chunk_bytes: int = CHUNK_BYTES,
          learn: Column | None = None) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every document.

    ``learn`` says which documents the model learns from (default: four fifths by id).
    """
    spark = docs.sparkSession
    out_of = held_out(F.col(id_column)) if learn is None else ~F.coalesce(learn, F.lit(False))
    size = docs.agg(F.sum(F.octet_length(F.col(text_column).cast("string")).cast("bigint"))).first()[0] or 0
    chunks = max(1, -(-size // chunk_bytes), min(LEAST_CHUNKS, -(-size // LEAST_CHUNK_BYTES)))
    dealt = docs.select(
        F.pmod(F.xxhash64(F.col(id_column), F.col(text_column)), F.lit(chunks)).cast("int").alias("chunk"),
        F.col(id_column).alias("id"), out_of.alias("held_out"), utf8(F.col(text_column).cast("string")).alias("text"))
    by_chunk = dealt.repartition(max(chunks, parallelism(spark)), "chunk").sortWithinPartitions("chunk")
    asked = written(by_chunk.mapInArrow(_ask, "chunk int, is_gram boolean, key bigint, n bigint"), "asked")
    release(spark)
    grams_asked = asked.where("is_gram").select("chunk", F.col("key").alias("gram"), "n")
    words_asked = asked.where("NOT is_gram").select("chunk", F.col("key").alias("word"), "n")

    costs = written(trie(grams_asked.groupBy("gram").agg(F.sum("n").alias("n"))), "trie")
    counts = written(words_asked.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    sums = counts.agg(F.sum("c").alias("tokens"), F.sum((F.col("c") > 0).cast("int")).alias("types")).first()
    trained = docs.where(~out_of).count()
    tokens, types = int(sums["tokens"] or 0) + trained, int(sums["types"] or 0) + (trained > 0)
    release(spark)

    kind = dealt.schema["id"].dataType.simpleString()

    def rows(df: DataFrame, of: int, key: Column, value: Column, row_id: Column = F.lit(None), text: Column = F.lit(None)) -> DataFrame:
        return df.select((F.col("chunk") * 4 + of).alias("place"), key.cast("bigint").alias("key"), value.alias("value"),
                         row_id.cast(kind).alias("id"), text.cast("binary").alias("text"))

    ends = spark.range(chunks).select(F.col("id").cast("int").alias("chunk"))
    passing = (rows(grams_asked.select("chunk", "gram").join(costs, "gram"), GRAM, F.col("gram"), F.col("cost"))
               .unionByName(rows(words_asked.select("chunk", "word").join(counts, "word"), WORD, F.col("word"), F.col("c").cast("double")))
               .unionByName(rows(ends, WORD, F.lit(0), F.lit(float(trained))))
               .unionByName(rows(dealt, DOCUMENT, F.col("held_out"), F.lit(0.0), F.col("id"), F.col("text"))))
    scored = passing.repartition(F.floor(F.col("place") / 4)).sortWithinPartitions("place").mapInArrow(
        _score_chunks(tokens, types), f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
        "base_score double, score double")
    return scored.withColumnRenamed("id", id_column)
