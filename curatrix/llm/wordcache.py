"""Encoding of a batch word by distinct word: each distinct span is encoded once, and a bounded cache outlives the batch.

Spans are found by a 64-bit hash and taken for equal only when their bytes are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np

from . import textvec as tv

CACHE_WORDS = 1_500_000
Encode = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def stretches(pool: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches pool[at : at + size], one after another."""
    return pool[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class WordCache:
    """Span hash -> (bytes, ids), as sorted keys with offsets into pools. Beyond ``most`` it starts again, which changes no result.

    An entry takes some 50 bytes, and twice that while entries are added."""

    def __init__(self, most: int = CACHE_WORDS):
        self.most = most
        self.clear()

    def clear(self) -> None:
        self.keys, self.where = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.at, self.size, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint16)  # vocabularies have fewer than 2**16 ids
        self.raw_at, self.raw_size, self.raw = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.uint8)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the entries of keys, and whether they are there."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.where[i], self.keys[i] == keys

    def add(self, keys: np.ndarray, raw_size: np.ndarray, raw: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Sorted keys that are not there yet, with the bytes and ids of all of them one after another."""
        to = np.searchsorted(self.keys, keys)
        self.keys, self.where = np.insert(self.keys, to, keys), np.insert(self.where, to, len(self.at) + np.arange(len(keys), dtype=np.int32))
        self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(size) - size])
        self.raw_at = np.concatenate([self.raw_at, len(self.raw) + np.cumsum(raw_size) - raw_size])
        self.size, self.raw_size = np.concatenate([self.size, size.astype(np.int32)]), np.concatenate([self.raw_size, raw_size.astype(np.int32)])
        self.pool, self.raw = np.concatenate([self.pool, ids.astype(np.uint16)]), np.concatenate([self.raw, raw])


def encode_spans(cache: WordCache, spans: tv.Spans, start: np.ndarray, end: np.ndarray, encode: Encode) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all spans one after another, number of ids of each span). encode(starts, ends) -> (sizes, ids) of spans that the cache lacks."""
    keys, first, back = np.unique(spans.hash(start, end), return_index=True, return_inverse=True)
    s, e = start[first], end[first]
    i, there = cache.find(keys)
    old = i[there]
    alike = cache.raw_size[old] == (e - s)[there]
    if not alike.all() or not np.array_equal(stretches(cache.raw, cache.raw_at[old], cache.raw_size[old].astype(np.int64)), stretches(spans.buf, s[there], (e - s)[there])):
        cache.clear()  # a key of other bytes is held
        there[:] = False
    if not there.all():
        if len(cache.keys) + (~there).sum() > cache.most:
            cache.clear()
            there[:] = False
        new = ~there
        size, ids = encode(s[new], e[new])
        cache.add(keys[new], (e - s)[new], stretches(spans.buf, s[new], (e - s)[new]), size.astype(np.int64), ids)
        i, _ = cache.find(keys)
    at, size, pool = cache.at[i][back], cache.size[i].astype(np.int64)[back], cache.pool
    other = np.flatnonzero(~spans.same(start, end, s[back], e[back]))
    if len(other):  # spans of equal hash and other bytes: each is encoded for itself
        own, ids = encode(start[other], end[other])
        at[other], size[other] = len(pool) + np.cumsum(own) - own, own
        pool = np.concatenate([pool, ids.astype(np.uint16)])
    return stretches(pool, at, size), size


def slices(start: np.ndarray, end: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches (a, b) of adjoining spans that have at most ``most`` bytes, or are one span: a very long text is not encoded at once."""
    a = 0
    while a < len(start):
        b = max(a + 1, int(np.searchsorted(end, start[a] + most, side="right")))
        yield a, b
        a = b
