"""Token ids as Arrow files of equal-length sequences.

``write_sequences`` tokenises documents in ascending id order and writes one
Arrow IPC file per range of ids. A file holds record batches of

    ids      fixed_size_list<uint16 or uint32>[length]   token ids, 16 bits if the vocabulary allows
    mask     fixed_size_list<bool>[length]               false where the sequence is padded
    doc_ids  list<int64>                                 documents that end in the sequence, in order
    ends     list<int32>                                 place of the last token of each of them

so sequence ``i`` is a slice at a fixed offset of a memory-mapped file
(``sequences``). Documents run on across sequences; only the last sequence of a
file is padded. ``read_documents`` reads the files back.

A task may run twice. Each run writes a file of its own name, and only the
names in the manifest, a table that Spark commits, count.

NULL text is the empty text (its end id alone), NULL ids come first, equal ids
are ordered by their text, rows equal in both are interchangeable. An empty
table gives no file. Only the id and text columns are read.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm.text import pieces, utf8
from riskloom.llm.words import LOWERED, NOT_WHITE, Words, byte_table, hashes, split
from riskloom.session import parallelism, scratch_path, written

LENGTH = 2048
END_ID = 2
# Sequences per record batch: 256 of 2048 ids are 2.6 MB.
BATCH_SEQUENCES = 256
# Distinct words whose ids a worker remembers.
CACHE_WORDS = 2_000_000

# How the word-level vocabulary splits texts, and marks that are
# a pre-token of their own after a letter.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
MARKS = b".,!?;:*$%&#|"
MARK = byte_table(lambda b: b in MARKS)
LETTER = byte_table(lambda b: b < 0x80 and chr(b).isalpha())


@dataclass(frozen=True)
class Layer:
    """Words in the order of their keys, each with the place and number of its ids in a pool."""

    keys: np.ndarray
    checks: np.ndarray
    begin: np.ndarray
    length: np.ndarray
    pool: np.ndarray

    @staticmethod
    def empty() -> Layer:
        return Layer(np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4"))

    def at(self, keys: np.ndarray) -> np.ndarray:
        return np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)

    def has(self, keys: np.ndarray) -> np.ndarray:
        return self.keys[self.at(keys)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def merged(self, other: Layer) -> Layer:
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        return Layer(keys[order], np.concatenate([self.checks, other.checks])[order],
                     np.concatenate([self.begin, other.begin + len(self.pool)])[order],
                     np.concatenate([self.length, other.length]).astype(np.int32)[order], np.concatenate([self.pool, other.pool]))


class WordCache:
    """Token ids of texts, each distinct word encoded once per worker.

    White space separates words for the tokenizers ``drops_space`` accepts, so
    a text's ids are those of its words. Their lower case and the pre-tokens of
    ``SPLIT`` allow one step more: a word that ends in an ASCII letter and
    ``MARKS`` has the ids of the lower-cased part before them, then those of
    the marks. Other tokenizers encode whole texts. All ids come from the
    library. Words are told apart by 128 bits of hash; ``size`` words are kept,
    about 40 bytes each, and then forgotten all at once.
    """

    def __init__(self, path: str, size: int = CACHE_WORDS):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.vocabulary = self.tokenizer.get_vocab_size()
        self.by_word = drops_space(json.loads(self.tokenizer.to_str()))
        self.size = size
        self._forget()

    def _forget(self) -> None:
        # Learned words lie in sorted layers, the latest one small, so that a new word does not copy all others.
        self.layers = [Layer.empty(), Layer.empty()]

    def settle(self) -> None:
        """Drops what a worker need not keep between tasks: most of a full memory of words."""
        if 2 * self._count() > self.size:
            self._forget()

    def _count(self) -> int:
        return sum(len(layer.keys) for layer in self.layers)

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, place where each text's ids begin and the end) of a binary column."""
        if not self.by_word:
            encoded = [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(
                [t.decode() for t in column.to_pylist()], add_special_tokens=False)]
            return np.concatenate([np.zeros(0, "<u4"), *encoded]), np.cumsum([0, *map(len, encoded)])
        words = split(column, NOT_WHITE, lower=False)
        data, starts, ends, words_first = self._units(words)
        keys, checks = hashes(data, starts, ends), hashes(data, starts, ends, 1)
        order = np.argsort(keys, kind="stable")
        ranked = keys[order]
        fresh = np.ones(len(ranked), bool)
        fresh[1:] = (ranked[1:] != ranked[:-1]) | (checks[order][1:] != checks[order][:-1])
        group = np.empty(len(keys), np.int64)
        group[order] = np.cumsum(fresh) - 1
        some = order[fresh]  # a place of each distinct unit
        first, size = self._find(keys[some], checks[some])
        missing = np.flatnonzero(first < 0)
        if len(missing):
            if self._count() + len(missing) > self.size:
                self._forget()
                missing = np.arange(len(some))
            at = some[missing]
            self._learn(keys[at], checks[at], [data[a:b].tobytes() for a, b in zip(starts[at], ends[at])])
            first, size = self._find(keys[some], checks[some])
        sizes = size[group]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        source = np.repeat(first[group] - bounds[:-1], sizes)
        source += np.arange(bounds[-1])
        old, new = (layer.pool for layer in self.layers)
        if not len(new):
            return old[source], bounds[words_first]
        late = source >= len(old)
        ids = np.zeros(len(source), "<u4")
        ids[~late] = old[source[~late]]
        ids[late] = new[source[late] - len(old)]
        return ids, bounds[words_first]

    def _units(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words cut before their closing marks: (bytes, starts, ends, first unit of each text)."""
        data, starts, ends = words.data, words.starts, words.ends
        if not len(starts):
            return data, starts, ends, words.first
        angled = np.zeros(len(starts), bool)  # words with a mark of special tokens: left as they are
        places = np.flatnonzero(data == ord("<"))
        angled[np.searchsorted(starts, places, "right") - 1] = True
        stem, todo = ends.copy(), np.flatnonzero(~angled)
        while len(todo):
            todo = todo[MARK[data[stem[todo] - 1]] & (stem[todo] - 1 > starts[todo])]
            stem[todo] -= 1
        stem = np.where(LETTER[data[stem - 1]], stem, ends)
        lowered = LOWERED[data]
        for i in np.flatnonzero(angled).tolist():
            lowered[starts[i]:ends[i]] = data[starts[i]:ends[i]]
        tails = stem < ends
        shift = np.concatenate([[0], np.cumsum(tails)])
        at = np.arange(len(starts)) + shift[:-1]
        n = len(starts) + int(shift[-1])
        begin, end = np.empty(n, np.int64), np.empty(n, np.int64)
        begin[at], end[at] = starts, stem
        begin[at[tails] + 1], end[at[tails] + 1] = stem[tails], ends[tails]
        return lowered, begin, end, words.first + shift[words.first]

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the first id in all layers' pools, number of ids) of each unit; unknown ones have place -1."""
        first, size, behind = np.full(len(keys), -1), np.zeros(len(keys), np.int64), 0
        for layer in self.layers:
            if len(layer.keys):
                at = layer.at(keys)
                known = (layer.keys[at] == keys) & (layer.checks[at] == checks)
                at = at[known]
                first[known], size[known] = behind + layer.begin[at], layer.length[at]
            behind += len(layer.pool)
        return first, size

    def _learn(self, keys: np.ndarray, checks: np.ndarray, words: list[bytes]) -> None:
        ids, bounds = self._encode(words)
        order = np.argsort(keys, kind="stable")
        new = Layer(keys[order], checks[order], bounds[:-1][order], np.diff(bounds)[order], ids)
        self.layers[1] = self.layers[1].merged(new)
        if any(layer.has(keys).any() for layer in self.layers[:1]) or np.any(self.layers[1].keys[1:] == self.layers[1].keys[:-1]):
            raise ValueError("two words share a 64-bit hash; choose other multipliers")
        if 8 * len(self.layers[1].keys) > len(self.layers[0].keys):
            self.layers = [self.layers[0].merged(self.layers[1]), Layer.empty()]

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, which share texts and are told apart by the places of their characters."""
        plain = [w.decode() for w in words]
        groups = [plain[i:i + 64] for i in range(0, len(plain), 64)]
        found, sizes = [np.zeros(0, "<u4")], [np.zeros(1, np.int64)]
        for i in range(0, len(groups), 256):
            some = groups[i:i + 256]
            for group, e in zip(some, self.tokenizer.encode_batch([" ".join(g) for g in some], add_special_tokens=False)):
                places = np.array([o[0] for o in e.offsets], np.int64)
                bounds = np.cumsum([0, *[len(w) + 1 for w in group]])
                found.append(np.array(e.ids, "<u4"))
                sizes.append(np.diff(np.searchsorted(places, bounds)))
        return np.concatenate(found), np.cumsum(np.concatenate(sizes))


def drops_space(tokenizer: dict) -> bool:
    """Whether texts can be encoded word by word: lower case, NFC, white space dropped, pre-tokens by ``SPLIT``."""
    normal = (tokenizer.get("normalizer") or {}).get("normalizers") or []
    before = (tokenizer.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    return ([n["type"] for n in normal] == ["NFC", "Replace", "Lowercase"]
            and normal[1]["pattern"] == {"Regex": r"\s+"} and normal[1]["content"] == " "
            and before[0].get("pattern") == {"Regex": SPLIT} and before[0].get("behavior") == "Removed"
            and before[0].get("invert") is True
            and all(not re.search(r"\s", a["content"]) and a["content"].startswith("<") and not a["lstrip"] and not a["rstrip"]
                    for a in tokenizer.get("added_tokens") or []))


_CACHES: dict[str, WordCache] = {}


def word_cache(path: str) -> WordCache:
    if path not in _CACHES:
        _CACHES[path] = WordCache(path)
    return _CACHES[path]


def file_schema(length: int, vocabulary: int) -> pa.Schema:
    kind = pa.uint16() if vocabulary <= 1 << 16 else pa.uint32()
    return pa.schema([pa.field("ids", pa.list_(pa.field("item", kind, False), length), False),
                      pa.field("mask", pa.list_(pa.field("item", pa.bool_(), False), length), False),
                      pa.field("doc_ids", pa.list_(pa.int64()), False), pa.field("ends", pa.list_(pa.int32()), False)])


class SequenceWriter:
    """Packs the ids of documents into fixed-length sequences of one file."""

    def __init__(self, sink, schema: pa.Schema, batch_sequences: int = BATCH_SEQUENCES):
        self.schema = schema
        self.out = pa.ipc.new_file(sink, schema)
        self.length = schema.field("ids").type.list_size
        self.kind = schema.field("ids").type.value_type.to_pandas_dtype()
        self.step = self.length * batch_sequences
        self.parts: list[np.ndarray] = []
        self.ends: list[int] = []  # places of last tokens, counted from the first id held
        self.names: list[int | None] = []
        self.held = self.sequences = self.documents = self.total = 0

    def add(self, doc_id: int | None, ids: np.ndarray, end_id: int) -> None:
        self.parts += [ids, np.array([end_id], "<u4")]
        self.held += len(ids) + 1
        self.ends.append(self.held - 1)
        self.names.append(doc_id)
        self.documents += 1
        self.total += len(ids) + 1
        if self.held >= self.step:
            self._flush(self.held // self.step * self.step)

    def _flush(self, n: int) -> None:
        """Writes the first ``n`` ids held, a multiple of the length but for padding at the end of the file."""
        flat = np.concatenate(self.parts)
        here = int(np.searchsorted(self.ends, n))
        rows = -(-n // self.length)
        ids = np.zeros(rows * self.length, self.kind)
        ids[:n] = flat[:n]
        mask = np.arange(rows * self.length) < n
        ends = np.array(self.ends[:here], np.int64)
        offsets = pa.array(np.searchsorted(ends // self.length, np.arange(rows + 1)).astype(np.int32))
        whole = pa.record_batch(
            [pa.FixedSizeListArray.from_arrays(pa.array(ids), type=self.schema.field("ids").type),
             pa.FixedSizeListArray.from_arrays(pa.array(mask), type=self.schema.field("mask").type),
             pa.ListArray.from_arrays(offsets, pa.array(self.names[:here], pa.int64())),
             pa.ListArray.from_arrays(offsets, pa.array((ends % self.length).astype(np.int32)))], schema=self.schema)
        for first in range(0, rows, self.step // self.length):
            self.out.write_batch(whole.slice(first, self.step // self.length))
        self.parts, self.held = [flat[n:].copy()], len(flat) - n
        self.ends, self.names = [e - n for e in self.ends[here:]], self.names[here:]
        self.sequences += rows

    def close(self) -> None:
        if self.held:
            self._flush(self.held)
        self.out.close()


def file_system(path: str):
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        path = f"file://{path}"
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return fs.FileSystem.from_uri(path)


def write_sequences(docs: DataFrame, tokenizer: str, folder: str | None = None, length: int = LENGTH,
                    end_id: int = END_ID, id_column: str = "doc_id", text_column: str = "text",
                    parts: int | None = None) -> DataFrame:
    """Writes the files below ``folder`` (default: a new one in the shared folder) and returns their manifest.

    The manifest has one row per file: part, path, documents, sequences, ids,
    start (ids in all files before).
    """
    spark = docs.sparkSession
    folder = folder or scratch_path(spark, "sequences")
    _make(folder)
    order = [F.asc_nulls_first("_id"), F.asc("_tie")]
    rows = docs.select(F.col(id_column).cast("bigint").alias("_id"), F.xxhash64(F.col(text_column)).alias("_tie"),
                       utf8(F.col(text_column)).alias("_text"))
    ranged = rows.repartitionByRange(parts or parallelism(spark), *order).sortWithinPartitions(*order, "_text")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target = None
        words = word_cache(tokenizer)
        part = TaskContext.get().partitionId()
        for piece in pieces(batches, "_text"):
            if target is None:
                path = f"{folder.rstrip('/')}/part-{part:06d}-{uuid.uuid4().hex}.arrow"
                system, inner = file_system(path)
                sink = system.open_output_stream(inner)
                target = SequenceWriter(sink, file_schema(length, words.vocabulary))
            ids, bounds = words.texts(piece.column("_text"))
            for name, a, b in zip(piece.column("_id").to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                target.add(name, ids[a:b], end_id)
        if target is not None:
            target.close()
            sink.close()
            words.settle()
            yield pa.RecordBatch.from_pydict({"part": [part], "path": [path], "documents": [target.documents],
                                              "sequences": [target.sequences], "ids": [target.total]})

    files = written(ranged.mapInArrow(write, "part bigint, path string, documents bigint, sequences bigint, ids bigint"),
                    "manifest")
    # One row per file, so the window over all of them stays small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0).cast("bigint")))


def _make(folder: str) -> None:
    system, inner = file_system(folder)
    system.create_dir(inner, recursive=True)


def sequences(path: str) -> pa.Table:
    """A file's sequences without copying: buffers point into the mapped file."""
    system, inner = file_system(path)
    from pyarrow import fs
    if isinstance(system, fs.LocalFileSystem):
        return pa.ipc.open_file(pa.memory_map(inner)).read_all()
    return pa.ipc.open_file(system.open_input_file(inner)).read_all()


def file_documents(path: str) -> Iterator[tuple[list, list[bytes]]]:
    """Per record batch of a file: (document ids, their token ids as 32-bit bytes) of the documents that end in it."""
    system, inner = file_system(path)
    with system.open_input_file(inner) as source:
        reader = pa.ipc.open_file(source)
        open_part: list[bytes] = []  # of a document that began in an earlier batch
        for i in range(reader.num_record_batches):
            batch = reader.get_batch(i)
            length = batch.schema.field("ids").type.list_size
            filled = batch.column("mask").flatten().true_count  # padding stands last
            raw = memoryview(batch.column("ids").flatten().to_numpy()[:filled].astype("<u4")).cast("B")
            row = np.repeat(np.arange(batch.num_rows), batch.column("ends").value_lengths().to_numpy())
            found, begin = [], 0
            for end in (row * length + batch.column("ends").flatten().to_numpy() + 1).tolist():
                found.append(b"".join([*open_part, raw[4 * begin:4 * end]]))
                open_part, begin = [], end
            if begin < filled:
                open_part.append(bytes(raw[4 * begin:]))
            yield batch.column("doc_ids").flatten().to_pylist(), found


def read_documents(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files of ``manifest``."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column("path").to_pylist(), batch.column("start").to_pylist()):
                for names, texts in file_documents(path):
                    sizes = [len(t) // 4 for t in texts]
                    starts = start + np.cumsum([0, *sizes])
                    yield pa.RecordBatch.from_pydict({
                        "doc_id": pa.array(names, pa.int64()), "start": pa.array(starts[:-1], pa.int64()),
                        "n_tokens": pa.array(sizes, pa.int64()),
                        "ids_crc32": pa.array([zlib.crc32(t) for t in texts], pa.int64())})
                    start = int(starts[-1])

    files = manifest.select("part", "path", "start").repartition(parallelism(manifest.sparkSession), "part")
    return files.mapInArrow(read, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def encode_documents(docs: DataFrame, tokenizer: str, **options) -> DataFrame:
    """Writes ``docs`` as sequence files and reads every document back from them."""
    return read_documents(write_sequences(docs, tokenizer, **options))
