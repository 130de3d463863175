"""Words of many texts as flat numpy arrays, for use inside tasks.

Texts are taken in chunks of about a quarter of a million bytes, so memory is bounded by the chunk and by the
longest single text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from contextlib import suppress
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 250_000
_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def release_memory() -> None:
    """Give memory that a task has freed back to the system: workers are kept for later tasks."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values; equal values stay equal, different ones stay different."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, salt: int = 0) -> np.ndarray:
    """n fixed odd 64-bit factors."""
    k = np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)
    return mixed(k * _ODD) | np.uint64(1)


def chunks(texts: pa.Array | list[str | None], size: int = CHUNK) -> Iterator[tuple[int, list[str]]]:
    """(index of the first text, texts) with about `size` bytes each; null becomes empty."""
    column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    for start, stop in parts(sizes, size):
        yield start, [text or "" for text in column.slice(start, stop - start).to_pylist()]


def parts(sizes: np.ndarray, limit: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows, in order, of about `limit` in all; a larger row is a range of its own."""
    ends = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield start, stop
        start = stop


@dataclass
class Words:
    """Words of some texts: word w spans [start[w], stop[w]) of its text's characters."""

    hash: np.ndarray  # 64-bit hash of each word
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray  # per text, its first word; one more entry at the end
    chars: np.ndarray  # code points of all texts, a line feed behind each
    offset: np.ndarray  # per text, where its characters begin


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed, and where each text begins."""
    sizes = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    joined = "\n".join(texts) + "\n"
    return np.frombuffer(joined.encode("utf-32-le"), np.uint32), np.cumsum(sizes) - sizes


def is_space(chars: np.ndarray) -> np.ndarray:
    return (chars == 32) | ((chars >= 9) & (chars <= 13))


def split_words(texts: list[str], lower: bool = True) -> Words:
    """Words between runs of blanks and the characters 9 to 13; A-Z lower-cased on demand."""
    chars, offset = code_points(texts)
    if lower:
        chars = chars + ((chars >= 65) & (chars <= 90)).astype(np.uint32) * np.uint32(32)
    inside = ~is_space(chars)
    edge = np.diff(inside.astype(np.int8), prepend=np.int8(0))
    start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)  # ends in a line feed
    first = np.append(np.searchsorted(start, offset), len(start))
    if not len(start):
        return Words(np.empty(0, np.uint64), start, stop, first, chars, offset)
    size = stop - start
    begins = np.cumsum(size) - size
    place = np.arange(size.sum()) - np.repeat(begins, size)
    code = chars[inside].astype(np.uint64) * _ODD
    code ^= code >> np.uint64(32)
    code *= multipliers(int(size.max()))[place]
    return Words(mixed(np.add.reduceat(code, begins) + size.astype(np.uint64)), start, stop, first, chars, offset)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n neighbouring word hashes; fewer words than n are one run."""
    if not len(words):
        return words
    if len(words) < n:
        n = len(words)
    factors = multipliers(n, salt=n)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        total += words[k : len(words) - n + 1 + k] * factors[k]
    return mixed(total)


class IntTable:
    """Places of known non-negative 64-bit keys; open addressing, looked up for whole arrays."""

    def __init__(self, keys: np.ndarray):
        bits = max(8, int(4 * max(1, len(keys)) - 1).bit_length())
        self.shift, self.last = np.uint64(64 - bits), (1 << bits) - 1
        self.key = np.full(1 << bits, -1, np.int64)
        self.place = np.full(1 << bits, -1, np.int64)
        for i, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            while self.key[slot] >= 0:
                slot = (slot + 1) & self.last
            self.key[slot], self.place[slot] = key, i

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * _ODD >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key among the known ones, or -1."""
        slot = self._slot(keys)
        held = self.key[slot]
        rest = np.flatnonzero((held != keys) & (held >= 0))
        while len(rest):  # the slot belongs to another key: look into the next one
            slot[rest] = (slot[rest] + 1) & self.last
            held[rest] = self.key[slot[rest]]
            rest = rest[(held[rest] != keys[rest]) & (held[rest] >= 0)]
        return np.where(held == keys, self.place[slot], -1)
