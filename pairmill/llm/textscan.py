"""Words of many texts at once, on the bytes of an Arrow string column.

A word is a longest run of word bytes. Each is named by a 64-bit hash of its bytes: a
sum of bytes times fixed multipliers by place, mixed at the end. Two different words
share a name with a chance of about 2**-57.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes hashed at a time, so that what a task holds beside its texts is bounded.
PIECE = 1 << 19


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    found = np.zeros(256, bool)
    for low, high in ranges:
        found[low : high + 1] = True
    return found


# [^\x20\x09-\x0D]+
SPACED = ~_byte_set((0x20, 0x20), (0x09, 0x0D))
# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased
LETTERS = _byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed)) | np.uint64(1)


def _names(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sizes = ends - starts
    before = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum()), dtype=np.int64) - np.repeat(before, sizes)
    values = data[place + np.repeat(starts, sizes)].astype(np.uint64)
    values += np.uint64(1)
    values *= multipliers(int(sizes.max()))[place]
    return mix(np.add.reduceat(values, before) + sizes.astype(np.uint64))


@dataclass(frozen=True)
class Scan:
    """Words of a batch of texts: names, byte places, and the first word of each text."""

    names: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    data: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())


def scan(texts: pa.Array, word_bytes: np.ndarray, lower: bool) -> Scan:
    """Words of all texts; a null text has none."""
    if not len(texts):
        none = np.empty(0, np.int64)
        return Scan(none.astype(np.uint64), none, none, np.zeros(1, np.int64), none.astype(np.uint8))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    low, high = int(offsets[0]), int(offsets[-1])
    data = np.frombuffer(raw, np.uint8)[low:high] if high > low else np.empty(0, np.uint8)
    offsets = offsets - low
    if lower:
        data = LOWER[data]
    inside = word_bytes[data]
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    filled = offsets[1:] > offsets[:-1]
    edge = offsets[:-1][filled]
    begins[edge] = inside[edge]
    edge = offsets[1:][filled] - 1
    stops[edge] = inside[edge]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    names = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        names[at:to] = _names(data, starts[at:to], ends[at:to])
        at = to
    return Scan(names, starts, ends, np.searchsorted(starts, offsets), data)


def windows(names: np.ndarray, k: int, seed: int = 2) -> np.ndarray:
    """Names of all runs of k words, by first word; they ignore where texts end."""
    n = max(0, len(names) - k + 1)
    total = np.zeros(n, np.uint64)
    for j, m in enumerate(multipliers(k, seed)):
        total += names[j : j + n] * m
    return mix(total + np.uint64(k))


def whole_windows(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of n word places start a run of k words inside one text."""
    ends = np.repeat(first[1:], np.diff(first))[:n]
    return np.arange(n) + k <= ends


def covered(hits: np.ndarray, k: np.ndarray | int, n: int) -> np.ndarray:
    """Which of n places lie in a run of k that starts at one of the hits."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, hits, 1)
    np.add.at(change, np.minimum(hits + k, n), -1)
    return np.cumsum(change[:-1]) > 0


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Batches cut so that the texts of one hold about `most` bytes; texts stay whole."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        upto = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            base = upto[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(upto, base + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
