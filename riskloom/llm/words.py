"""Words of a batch of texts as arrays: places, documents and 64-bit hashes, without an object per word."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Odd multipliers of the word hash.
MULTIPLY = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))
LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def byte_table(keep) -> np.ndarray:
    """A flag per byte value."""
    return np.array([bool(keep(b)) for b in range(256)])


NOT_WHITE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
# Letters and digits of ASCII (upper case counts as lower case) and every byte of a character beyond it.
ALNUM = byte_table(lambda b: b >= 0x80 or chr(b).isalnum())
LOWERED = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


@dataclass(frozen=True)
class Words:
    data: np.ndarray  # bytes of all texts, then 8 zeros
    texts: np.ndarray  # place where each text begins, and the end of the last
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # number of the first word of each text, and the number of words

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def word(self, i: int) -> bytes:
        return self.data[self.starts[i]:self.ends[i]].tobytes()


def text_bytes(column: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(bytes with 8 zeros after them, places of the texts) of a binary or string column without NULLs."""
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.zeros(high - low + 8, np.uint8)
    if high > low:
        raw = np.frombuffer(column.buffers()[2], np.uint8)[low:high]
        data[:-8] = LOWERED[raw] if lower else raw
    return data, offsets - low


def split(column: pa.Array, keep: np.ndarray, lower: bool) -> Words:
    """Maximal runs of bytes flagged in ``keep``, cut where texts end."""
    data, texts = text_bytes(column, lower)
    size = len(data) - 8
    inside = keep[data[:size]]
    before, after = np.empty(size, bool), np.empty(size, bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    if size:
        edges = texts[(texts > 0) & (texts < size)]
        before[0] = after[-1] = False
        before[edges], after[edges - 1] = False, False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return Words(data, texts, starts, ends, np.searchsorted(starts, texts))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """A 64-bit hash of each byte range; ``which`` picks one of two that are independent."""
    eights = np.ndarray((max(len(data) - 7, 0),), "<u8", data, 0, (1,))
    times = MULTIPLY[which]
    left = ends - starts
    h = left.astype(np.uint64) * MULTIPLY[1 - which]
    at, todo, step = starts, None, 0
    while len(at):
        x = eights[at] & LOW_BYTES[np.minimum(left, 8)]
        part = (h if todo is None else h[todo]) ^ x
        part *= times
        part ^= part >> np.uint64(29)
        part *= times
        part ^= part >> np.uint64(32)
        if todo is None:
            h = part
        else:
            h[todo] = part
        more = np.flatnonzero(left > 8)
        todo = more if todo is None else todo[more]
        at, left, step = at[more] + 8, left[more] - 8, step + 1
    return h


def mix(hashed: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive word hashes."""
    n = max(len(hashed) - width + 1, 0)
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out ^= hashed[i:i + n]
        out *= MULTIPLY[0]
        out ^= out >> np.uint64(31)
    return out
