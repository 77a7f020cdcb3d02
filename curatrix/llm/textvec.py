"""Vectorised text primitives for Arrow batches: whole batches are tokenised and hashed with numpy, not word by word.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` in the UTF-8 text, which is the same as the maximal run of
such characters, because UTF-8 never uses those bytes inside a longer sequence. A null text counts as empty here.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SUB_BATCH_BYTES = 2 << 20  # text handled at once; a longer single text is a sub-batch of its own

_U = np.uint64
_rng = np.random.Generator(np.random.PCG64(20240917))
_GRAM = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
_GRAM2 = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * _U(2) + _U(1)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_MASK = np.asarray([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
LONG_SPAN = 512  # bytes from which on a span is hashed on its own


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (public splitmix64 constants)."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def sub_batches(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = SUB_BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Slice batches so that each holds at most ``most`` bytes of text, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + most, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and len + 1 offsets from 0."""
    if texts.null_count:
        texts = texts.fill_null("" if not pa.types.is_binary(texts.type) else b"")
    texts = texts.cast(pa.large_binary()) if not pa.types.is_large_binary(texts.type) else texts
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bufs = texts.buffers()
    off = np.frombuffer(bufs[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(bufs[2], np.uint8) if bufs[2] is not None else np.zeros(0, np.uint8)
    return data[off[0] : off[-1]], off - off[0]


class Spans:
    """Hashable spans of a byte buffer. The hash depends on a span's bytes alone: eight bytes at a time are mixed in by a step
    that is not linear, so that no arrangement of equal parts cancels out; ``same`` compares the bytes themselves."""

    def __init__(self, buf: np.ndarray):
        self.buf = buf
        padded = np.zeros(len(buf) + 8, np.uint8)
        padded[: len(buf)] = buf
        self._eight = np.ndarray((len(buf) + 1,), np.dtype("<u8"), padded, strides=(1,)).astype(np.uint64)

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        h = mix(size.astype(np.uint64) * _U(0xD6E8FEB86659FD93) + _U(0xA0761D6478BD642F))
        long = size > LONG_SPAN
        h = mix(h ^ (self._eight[start] & _MASK[np.minimum(size, 8)]))
        rows, at = np.flatnonzero((size > 8) & ~long), 8
        while len(rows):
            left = size[rows] - at
            h[rows] = mix(h[rows] ^ (self._eight[start[rows] + at] & _MASK[np.minimum(left, 8)]))
            rows, at = rows[left > 8], at + 8
        for i in np.flatnonzero(long):
            h[i] = xxhash.xxh3_64_intdigest(self.buf[start[i] : end[i]].tobytes())
        return h

    def same(self, start: np.ndarray, end: np.ndarray, other: np.ndarray, other_end: np.ndarray) -> np.ndarray:
        """Whether each span has the bytes of another one."""
        size = end - start
        out = size == other_end - other
        rows, at = np.flatnonzero(out & (size > 0)), 0
        long = rows[size[rows] > LONG_SPAN]
        rows = rows[size[rows] <= LONG_SPAN]
        while len(rows):
            left = size[rows] - at
            mask = _MASK[np.minimum(left, 8)]
            ok = (self._eight[start[rows] + at] & mask) == (self._eight[other[rows] + at] & mask)
            out[rows[~ok]] = False
            rows, at = rows[ok & (left > 8)], at + 8
        for i in long:
            out[i] = np.array_equal(self.buf[start[i] : end[i]], self.buf[other[i] : other_end[i]])
        return out


class Words:
    """The words of a sub-batch: ``start``/``end`` byte positions, ``off`` (word offsets by document), ``doc`` (document of each word) and ``hash``."""

    def __init__(self, texts: pa.Array, lower: bool = False):
        buf, self.doc_off = utf8(texts)
        self.buf = buf = LOWER[buf] if lower else buf
        n, first = len(buf), self.doc_off[:-1]
        space = SPACE[buf]
        if n:
            inner = first[first < n]
            begins = np.empty(n, bool)
            begins[0], begins[1:] = True, space[:-1]
            begins[inner] = True
            ends = np.empty(n, bool)
            ends[-1], ends[:-1] = True, space[1:]
            ends[inner[inner > 0] - 1] = True
            solid = ~space
            self.start, self.end = np.flatnonzero(begins & solid), np.flatnonzero(ends & solid) + 1
        else:
            self.start = self.end = np.zeros(0, np.int64)
        self.off = np.searchsorted(self.start, self.doc_off)
        self.count = np.diff(self.off)
        self.doc = np.repeat(np.arange(len(first)), self.count)
        self.spans = Spans(buf)
        self.hash = self.spans.hash(self.start, self.end)

    def grams(self, n: int, wide: bool = False) -> tuple[np.ndarray, np.ndarray] | tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Positions of the first words of all n-word windows within a document, their hashes and, if wide, a second hash."""
        m = len(self.hash) - n + 1
        if m <= 0:
            none = np.zeros(0, np.uint64)
            return (np.zeros(0, np.int64), none, none) if wide else (np.zeros(0, np.int64), none)
        at = np.flatnonzero(self.doc[:m] == self.doc[n - 1 :])
        out = [at]
        for table in (_GRAM, _GRAM2)[: 1 + wide]:
            h = np.zeros(m, np.uint64)
            for k in range(n):
                h += self.hash[k : m + k] * table[k]
            out.append(mix(h[at]))
        return tuple(out)


def sequence_hash(h: np.ndarray) -> int:
    """A hash of a whole sequence of word hashes of any length."""
    return xxhash.xxh3_64_intdigest(np.ascontiguousarray(h).tobytes())


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
