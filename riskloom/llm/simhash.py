"""SimHash near-duplicates by tables of distances to reference fingerprints.

Fingerprints: 64 bits, a bit is set if more than half of the text's shingle
hashes (3 words, repeats included) have it.

Links: pairs of distinct fingerprints that differ in at most ``RADIUS`` bits.
A table holds each fingerprint's Hamming distances to ``REFERENCES`` fixed
fingerprints, block of bits by block of bits. Two facts about two fingerprints
within the radius make it useful:

* they differ in at most RADIUS of the b blocks, so in some choice of
  b - RADIUS blocks all their distances are equal. Equal distances are the keys
  of the join; nothing else meets.
* by the triangle inequality no whole distance differs by more than RADIUS.
  Pairs with a larger coordinate difference are discarded before the
  fingerprints themselves are compared.

A key shared by more than ``BUCKET`` fingerprints is not worked off: its members
get the finer keys of the next entry of ``BLOCKS`` instead, which together find
every pair of theirs. With 16 blocks a key fixes 52 of 64 bits (REFERENCES
distances determine a block of 4 bits), so no bucket can exceed 4096. A bucket
gives the edges of a spanning forest, not its pairs.

Each distinct fingerprint is compared once, however many texts have it.

A NULL text is an empty one. Texts without words have fingerprint zero and are
linked like any other. NULL ids are left out of the results of ``fingerprints``
only if the caller drops them: rows keep their id as it is, and a component of
rows without any id has a NULL component. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm.components import components
from riskloom.llm.text import pieces
from riskloom.llm.words import NOT_WHITE, split
from riskloom.session import written

SHINGLE = 3
SEED = 42
RADIUS = 3
REFERENCES = 24
BLOCKS = (5, 8, 12, 16)
BUCKET = 4096
# Pairs that one step of a task holds.
SLAB = 1 << 19


def reference_fingerprints(n: int = REFERENCES) -> list[int]:
    """The fixed fingerprints that distances are measured to: the outputs of SplitMix64 from zero."""
    out, state, mask = [], 0, (1 << 64) - 1
    for _ in range(n):
        state = (state + 0x9E3779B97F4A7C15) & mask
        z = state
        z = ((z ^ (z >> 30)) * 0xBF58476D1CE4E5B9) & mask
        z = ((z ^ (z >> 27)) * 0x94D049BB133111EB) & mask
        out.append(z ^ (z >> 31))
    return out


def block_masks(blocks: int) -> list[int]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def _text_fingerprints(column: pa.Array) -> np.ndarray:
    import xxhash
    words = split(pc.fill_null(column.cast(pa.string()), ""), NOT_WHITE, lower=True)
    raw = words.data.tobytes()
    # One space between words: shingles are slices of the rewritten text.
    out = np.zeros(len(words.first) - 1, np.uint64)
    digest = xxhash.xxh64_intdigest
    for k in range(len(out)):
        a, b = int(words.first[k]), int(words.first[k + 1])
        if a == b:
            continue
        own = raw[int(words.starts[a]):int(words.ends[b - 1])].split()
        text = b" ".join(own)
        ends = np.cumsum([len(w) + 1 for w in own]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        n = max(len(own) - SHINGLE + 1, 1)
        last = ends[min(SHINGLE, len(own)) - 1:]
        hashed = np.fromiter((digest(text[i:j], SEED) for i, j in zip(starts[:n].tolist(), last.tolist())), np.uint64, n)
        out[k] = _majority(hashed)
    return out


def _majority(hashed: np.ndarray) -> np.uint64:
    """Bits set in over half of the hashes."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashed), 1 << 16):
        part = hashed[i:i + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * counts > len(hashed)).astype(np.uint8)
    return np.packbits(bits, bitorder="little").view("<u8")[0]


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, bits) of every document; bits is the fingerprint as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches, "_text"):
            bits = _text_fingerprints(piece.column("_text")).view(np.int64)
            yield pa.RecordBatch.from_arrays([piece.column("_id"), pa.array(bits)], [id_column, "bits"])

    rows = docs.select(F.col(id_column).alias("_id"), F.col(text_column).cast("string").alias("_text"))
    return rows.mapInArrow(run, f"`{id_column}` {rows.schema['_id'].dataType.simpleString()}, bits bigint")


def distances(bits: np.ndarray, blocks: int) -> np.ndarray:
    """The table: Hamming distance to each reference (first axis) in each block (second) of each fingerprint."""
    away = [bits ^ np.uint64(r) for r in reference_fingerprints()]
    return np.stack([[np.bitwise_count(x & np.uint64(m)) for m in block_masks(blocks)] for x in away])


def distance_keys(bits: np.ndarray, blocks: int) -> np.ndarray:
    """Keys of fingerprints (a row each): for each choice of blocks - RADIUS blocks, of the distances there."""
    odd = np.array(reference_fingerprints(REFERENCES + blocks), np.uint64) | np.uint64(1)
    by_block = (distances(bits, blocks).astype(np.uint64) * odd[:REFERENCES, None, None]).sum(axis=0, dtype=np.uint64)
    by_block = (by_block ^ (by_block >> np.uint64(31))) * odd[REFERENCES:, None]
    by_block ^= by_block >> np.uint64(29)
    left_out = np.array(list(combinations(range(blocks), RADIUS)))
    keys = by_block.sum(axis=0, dtype=np.uint64)[:, None] - sum(by_block[left_out[:, i]].T for i in range(RADIUS))
    return (keys + np.arange(len(left_out), dtype=np.uint64)) * odd[0]


def keyed(distinct: DataFrame, blocks: int) -> DataFrame:
    """(key, bits): every fingerprint with each of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            all_bits = batch.column("bits").to_numpy()
            for i in range(0, len(all_bits), 1024):
                bits = all_bits[i:i + 1024]
                keys = distance_keys(bits.view(np.uint64), blocks)
                yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)),
                                                  pa.array(np.repeat(bits, keys.shape[1]))], ["key", "bits"])

    return distinct.select("bits").mapInArrow(run, "key bigint, bits bigint")


def _bucket_forest(members: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(larger, smaller) edges that connect the linked fingerprints of each bucket."""
    sizes = np.array([len(m) for m in members])
    flat = np.concatenate(members).view(np.uint64)
    bucket = np.repeat(np.arange(len(members)), sizes)
    references = np.array(reference_fingerprints(), np.uint64)
    table = np.stack([np.bitwise_count(flat ^ r) for r in references]).astype(np.int16)
    # In each bucket by the first distance: partners stand within RADIUS of it.
    order = np.lexsort((flat, table[0], bucket))
    flat, bucket, table = flat[order], bucket[order], table[:, order]
    place = bucket * 1024 + table[0]
    stop = np.searchsorted(place, place + RADIUS, "right")
    count = stop - np.arange(len(flat)) - 1
    label = np.arange(len(flat))
    ahead = np.concatenate([[0], np.cumsum(count)])
    i = 0
    while i < len(flat):
        j = max(int(np.searchsorted(ahead, ahead[i] + SLAB, "right")) - 1, i + 1)
        n = count[i:j]
        a = np.repeat(np.arange(i, j), n)
        b = a + 1 + np.arange(len(a)) - np.repeat(ahead[i:j] - ahead[i], n)
        keep = label[a] != label[b]
        a, b = a[keep], b[keep]
        for row in table[1:]:
            near = np.abs(row[a] - row[b]) <= RADIUS
            a, b = a[near], b[near]
        near = np.bitwise_count(flat[a] ^ flat[b]) <= RADIUS
        _join(label, a[near], b[near])
        i = j
    moved = np.flatnonzero(label != np.arange(len(label)))
    return flat[moved].view(np.int64), flat[label[moved]].view(np.int64)


def _join(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Merges the classes of each pair; a class is named by its first place."""
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        if not len(a):
            return
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            further = label[label]
            if np.array_equal(further, label):
                break
            label[:] = further


def _forests(buckets: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("members")
            offsets = lists.offsets.to_numpy()
            flat = lists.values.to_numpy()
            members, held = [], 0
            for a, b in zip(offsets.tolist(), offsets[1:].tolist()):
                members.append(flat[a:b])
                held += b - a
                if held >= 1 << 16:
                    yield edges(members)
                    members, held = [], 0
            if members:
                yield edges(members)

    def edges(members: list[np.ndarray]) -> pa.RecordBatch:
        a, b = _bucket_forest(members)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return buckets.mapInArrow(run, "a bigint, b bigint")


def links(distinct: DataFrame, ladder: tuple[int, ...] = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between the distinct fingerprints ``bits`` that connect all pairs within RADIUS."""
    members, found = distinct.select("bits"), []
    for step, blocks in enumerate(ladder):
        by_key = keyed(members, blocks)
        sized = by_key.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
        last = step == len(ladder) - 1
        small = sized.where((F.col("n") > 1) & (F.lit(last) | (F.col("n") <= bucket))).select("key")
        # At most BUCKET longs a list.
        lists = by_key.join(small, "key").groupBy("key").agg(F.collect_list("bits").alias("members")).select("members")
        found.append(_forests(lists))
        if last:
            break
        crowded = by_key.join(sized.where(F.col("n") > bucket).select("key"), "key").select("bits").distinct()
        members = written(crowded, "crowded")
        if members.isEmpty():
            break
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    ladder: tuple[int, ...] = BLOCKS, bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) of every document; the component's id is the smallest in it."""
    marked = written(fingerprints(docs, id_column, text_column), "fingerprints")
    ids = F.min(F.col(id_column)).alias("least")
    distinct = written(marked.groupBy("bits").agg(ids), "distinct")
    classes = components(links(distinct, ladder, bucket))
    named = distinct.join(classes, distinct["bits"] == classes["node"], "left").select(
        "bits", "least", F.coalesce("component", "bits").alias("class"))
    least = named.groupBy("class").agg(F.min("least").alias("component_id"))
    by_bits = named.join(least, "class").select(F.col("bits").alias("_bits"), "component_id")
    # Fingerprints are unique on the right; a crowded one on the left is split by AQE's skew join.
    joined = marked.join(by_bits, marked["bits"] == by_bits["_bits"], "left")
    return joined.select(F.col(id_column), F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


def keep_first(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """One document of each component, the one with the smallest id; documents without id stay."""
    found = near_duplicates(docs, id_column, text_column, **options)
    spare = (found.where(F.col(id_column) != F.col("component_id")).select(F.col(id_column).alias("_spare")).distinct())
    return docs.join(spare, docs[id_column] == spare["_spare"], "left_anti")
