"""Whole Arrow batches of texts as numpy arrays: words, their hashes, windows.

A batch is read in small chunks so that a task holds a bounded amount next to its
batch; a text larger than a chunk is a chunk of its own."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# hashing takes some fifty bytes for each byte of a chunk, and a worker keeps them for its next stage
CHUNK_BYTES = 256 << 10

# the white space of the contracts: space, tab, line feed, vertical tab, form feed, carriage return
SPACES = np.zeros(256, bool)
SPACES[[9, 10, 11, 12, 13, 32]] = True

ASCII_LOWER = np.arange(256, dtype=np.uint8)
ASCII_LOWER[65:91] += 32

BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHasher:
    """64-bit hashes of the words of many texts at once: a polynomial in the
    bytes, read off prefix sums, so the cost does not depend on word lengths."""

    def __init__(self, separators: np.ndarray = SPACES, fold: np.ndarray = ASCII_LOWER):
        self.separators, self.fold = separators, fold
        self.up = self.down = np.empty(0, np.uint64)

    def _tables(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)
        return self.up, self.down

    def chunk(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(hash of every word in order, first word of each text and the end)."""
        raw, offsets = text_bytes(texts)
        if not len(raw):
            return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
        inside = ~self.separators[raw]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(raw)]
        before[edges] = False  # a word never crosses from one text into the next
        starts = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        lasts = edges[edges > 0] - 1
        after[lasts] = False
        ends = np.flatnonzero(inside & ~after) + 1
        up, down = self._tables(len(raw) + 1)
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[self.fold[raw]] * up[: len(raw)], out=sums[1:])
        hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
        return hashes, np.searchsorted(starts, offsets).astype(np.int64)

    def __call__(self, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """(position in ``texts``, word hashes) of every text, null as empty."""
        for first, part in chunks(texts):
            hashes, at = self.chunk(part)
            for i in range(len(part)):
                yield first + i, hashes[at[i] : at[i + 1]]


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts and where each begins (and the end)."""
    texts = pc.fill_null(texts, "")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.empty(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about ``limit`` bytes, with the position of their first text."""
    sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    first = 0
    while first < len(texts):
        done = sizes[first - 1] if first else 0
        stop = max(first + 1, int(np.searchsorted(sizes, done + limit, "right")))
        yield first, texts.slice(first, stop - first)
        first = stop


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` words; fewer words than ``k`` have none."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out *= np.uint64(0xD1342543DE82EF95)
        out += hashes[j : j + n]
    return mix(out)


def digest(hashes: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit hashes of a whole word sequence, as signed integers."""
    n = len(hashes)
    place = np.arange(1, n + 1, dtype=np.uint64)
    a = np.bitwise_xor.reduce(mix(hashes + place * np.uint64(BASE)), initial=np.uint64(n))
    b = np.add.reduce(mix(hashes ^ mix(place)), dtype=np.uint64)
    return signed(a), signed(b)


def signed(value) -> int:
    value = int(value)
    return value - (1 << 64) if value >> 63 else value
