"""Exact removal of repeated word windows by difference-cover anchors.

D = {0, 1, 3, 9} is a difference cover modulo 13: for any two positions p and q some shift below 13 brings both to
residues in D. Two equal windows of 20 words at p and q therefore share an 8-word anchor that starts, in both, at a
position whose residue is in D. So only 4 of 13 positions are hashed and sent:

1. Anchors: each slice of texts sends its distinct anchor hashes, in one binary row for each bucket; the bucket answers
   which are found elsewhere too. Anchors that a slice itself holds twice need no answer.
2. Windows: documents with a repeated anchor extend it: each 20-word window around one is hashed (two hashes, 72 bits of which are sent besides the bucket), a slice sends
   each distinct window once with its first start, and the bucket answers which start is the first of all, its owner.
3. A candidate window that is not its owner starts earlier somewhere else, and its words go.

A window without a repeated anchor is found once only and is never sent. A bucket gets at most one entry for a hash from
each slice (64 MB of text), so a passage in a third of all documents is no more than a few bytes for each slice.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .neardup import _groups
from .storage import input_chars, table

WINDOW, PERIOD, COVER = 20, 13, (0, 1, 3, 9)
SLICE_BYTES = 64 << 20
BUCKET_CHARS = 32_000_000  # characters of input for each bucket
MOST_BUCKETS = 1 << 18  # so that a slice, of some 3 million anchors, has a dozen for each bucket and not a row for each anchor
_U = np.uint64


def cover(period: int, window: int) -> np.ndarray:
    """Which residues are anchored; checks that every difference occurs."""
    if {(a - b) % period for a in COVER for b in COVER} != set(range(period)) or window <= period:
        raise ValueError("not a difference cover of this period, or the window is too short for it")
    flag = np.zeros(period, bool)
    flag[list(COVER)] = True
    return flag


def _anchors(w: tv.Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, position in it, hash) of each anchor of the sub-batch, of texts long enough to hold a window."""
    at, h = w.grams(window - PERIOD + 1)
    pos = at - w.off[w.doc[at]]
    keep = cover(PERIOD, window)[pos % PERIOD] & (w.count[w.doc[at]] >= window)
    return w.doc[at[keep]], pos[keep], h[keep]


def _delta(x: np.ndarray) -> bytes:
    return np.diff(x, prepend=x.dtype.type(0)).tobytes()  # small numbers, which the shuffle's compression makes small


def _undelta(raw: bytes, kind) -> np.ndarray:
    return np.cumsum(np.frombuffer(raw, kind), dtype=kind)


def _blobs(ids: np.ndarray, doc: np.ndarray, pos: np.ndarray, hashes: list[np.ndarray], buckets: int, said: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each bucket: what is left of the hashes, documents, positions and what the slice knows already (a flag).

    The low 24 bits of a hash choose the bucket, and the 40 others are sent; of a second hash 32 bits.
    """
    bucket = ((hashes[0] & _U(0xFFFFFF)) % _U(buckets)).astype(np.int32)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order])) + 1
    rows: dict[str, list] = {k: [] for k in ("bucket", "hash", "doc", "pos", "said")}
    for i in np.split(order, cut) if len(order) else []:
        rows["bucket"].append(int(bucket[i[0]]))
        lanes = [(hashes[0][i] >> _U(24)).view(np.uint8).reshape(-1, 8)[:, :5].tobytes()]
        rows["hash"].append(b"".join(lanes + [h[i].view(np.uint8).reshape(-1, 8)[:, :4].tobytes() for h in hashes[1:]]))
        rows["doc"].append(_delta(ids[doc[i]].astype(np.int64)))
        rows["pos"].append(_delta(pos[i].astype(np.int32)))
        rows["said"].append(np.packbits(said[i]).tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(rows["bucket"], pa.int32()), *(pa.array(rows[k], pa.binary()) for k in ("hash", "doc", "pos", "said"))], list(rows))


_BLOBS = "bucket int, hash binary, doc binary, pos binary, said binary"


class _Slice:
    """What the texts of a slice sent so far: (document number, position, hashes)."""

    def __init__(self):
        self.ids, self.doc, self.pos, self.hashes, self.bytes, self.n = [], [], [], [], 0, 0

    def add(self, ids: np.ndarray, doc: np.ndarray, pos: np.ndarray, hashes: list[np.ndarray], size: int) -> bool:
        self.doc.append((doc + self.n).astype(np.int32))
        self.n += len(ids)
        self.ids.append(ids)
        self.pos.append(pos.astype(np.int32))
        self.hashes.append(hashes)
        self.bytes += size
        return self.bytes >= SLICE_BYTES

    def joined(self):
        return np.concatenate(self.ids), np.concatenate(self.doc), np.concatenate(self.pos), [np.concatenate(h) for h in zip(*self.hashes, strict=True)]


def _ids(b: pa.RecordBatch) -> np.ndarray:
    return b.column(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _send_anchors(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    def flush(s: _Slice):
        ids, doc, pos, (h,) = s.joined()
        _, first, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
        twice = count[back] > 1
        send = twice.copy()  # all places of a hash that the slice knows to be repeated, and one of each other
        send[first] = True
        yield from _blobs(ids, doc[send], pos[send], [h[send]], buckets, twice[send])

    s = _Slice()
    for b in tv.sub_batches(batches):
        w = tv.Words(b.column(1))
        doc, pos, h = _anchors(w, window)
        if s.add(_ids(b), doc, pos, [h], len(w.buf)):
            yield from flush(s)
            s = _Slice()
    if s.ids:
        yield from flush(s)


def group_of(ids: np.ndarray, groups: int) -> np.ndarray:
    """The group of each doc_id: pmod(xxhash64(doc_id), groups) as the engine computes it (public xxHash constants)."""
    p1, p2, p3, p4, p5 = map(_U, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    rotl = lambda x, r: (x << _U(r)) | (x >> _U(64 - r))
    h = rotl(ids.astype(np.int64).view(_U) * p2, 31) * p1
    h ^= np.asarray([42], _U) + p5 + _U(8)
    h = rotl(h, 27) * p1 + p4
    h ^= h >> _U(33)
    h *= p2
    h ^= h >> _U(29)
    h *= p3
    h ^= h >> _U(32)
    return np.mod(h.view(np.int64), groups)


_SAID = "grp int, kind int, doc_id long, text string, doc binary, pos binary"


def _marks(ids: np.ndarray, pos: np.ndarray, kind: int, groups: int) -> pa.RecordBatch:
    """An answer to each group of documents: its documents and their positions."""
    group = group_of(ids, groups)
    order = np.lexsort((pos, ids, group))
    ids, pos, group = ids[order], pos[order].astype(np.int32), group[order]
    cut = np.flatnonzero(np.diff(group)) + 1
    parts = [x for x in zip(np.split(ids, cut), np.split(pos, cut), strict=True) if len(x[0])]
    n = len(parts)
    first = np.concatenate([[0], cut])[:n].astype(np.int64)
    return pa.RecordBatch.from_arrays([pa.array(group[first], pa.int32()), pa.array([kind] * n, pa.int32()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.string()), pa.array([_delta(x) for x, _ in parts], pa.binary()), pa.array([_delta(y) for _, y in parts], pa.binary())], ["grp", "kind", "doc_id", "text", "doc", "pos"])


def _of(g: pa.Table, lanes: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    doc = [_undelta(x, np.int64) for x in g.column("doc").to_pylist()]
    pos = [_undelta(x, np.int32) for x in g.column("pos").to_pylist()]
    said = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(d)).astype(bool) for x, d in zip(g.column("said").to_pylist(), doc, strict=True)]
    raw = [np.frombuffer(x, np.uint8) for x in g.column("hash").to_pylist()]
    out, at = [], 0
    for width in (5, 4)[:lanes]:
        wide = np.zeros((sum(map(len, doc)), 8), np.uint8)
        wide[:, :width] = np.concatenate([x[at * len(d) : (at + width) * len(d)] for x, d in zip(raw, doc, strict=True)]).reshape(-1, width)
        out.append(wide.view(np.uint64)[:, 0])
        at += width
    return out, np.concatenate(doc), np.concatenate(pos), np.concatenate(said)


def _answer_anchors(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    for g in _groups(batches, ["bucket"]):
        (h,), doc, pos, said = _of(g, 1)
        order = np.argsort(h)
        same = h[order][1:] == h[order][:-1]
        twice = said
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        yield _marks(doc[twice], pos[twice], 0, groups)


class _Said:
    """The answers to a group of documents: positions by document."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.doc = self.pos = None

    def add(self, doc: bytes, pos: bytes) -> None:
        self.parts.append((_undelta(doc, np.int64), _undelta(pos, np.int32)))

    def of(self, ids: list) -> list[np.ndarray | None]:
        if self.doc is None:
            doc, pos = (np.concatenate(x) for x in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, np.int64), np.zeros(0, np.int32))
            order = np.lexsort((pos, doc))
            self.doc, self.pos, self.parts = doc[order], pos[order], []
        known = np.asarray([x if x is not None else 0 for x in ids], np.int64)
        lo, hi = np.searchsorted(self.doc, known), np.searchsorted(self.doc, known, side="right")
        return [self.pos[a:b] if x is not None and a < b else None for x, a, b in zip(ids, lo, hi, strict=True)]


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list, list]]:
    """(texts, anchors, owners) from rows sorted by (group, kind), in which a group's answers come before its texts."""
    group, said = None, (_Said(), _Said())
    for b in batches:
        if not b.num_rows:
            continue
        g, kind = b.column(0).to_numpy(), b.column(1).to_numpy()
        cut = np.flatnonzero((np.diff(g) != 0) | (np.diff(kind) != 0)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(g)], strict=True):
            if g[lo] != group:
                group, said = g[lo], (_Said(), _Said())
            part = b.slice(lo, hi - lo)
            if kind[lo] < 2:
                for d, p in zip(part.column(4).to_pylist(), part.column(5).to_pylist(), strict=True):
                    said[kind[lo]].add(d, p)
            else:
                for t in tv.sub_batches(iter([part])):
                    ids = t.column(2).to_pylist()
                    yield t, said[0].of(ids), said[1].of(ids)


def _candidates(w: tv.Words, marks: list[np.ndarray | None], window: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, start) of each window that holds a repeated anchor: window starts up to PERIOD - 1 words before one."""
    room = np.zeros(len(w.hash) + 1, np.int64)
    for d, a in enumerate(marks):
        if a is not None and w.count[d] >= window:
            lo, hi = np.maximum(0, a - (PERIOD - 1)), np.minimum(a, w.count[d] - window) + 1
            ok = lo < hi
            np.add.at(room, w.off[d] + lo[ok], 1)
            np.subtract.at(room, w.off[d] + hi[ok], 1)
    at = np.flatnonzero(np.cumsum(room[:-1]) > 0)
    return w.doc[at], at - w.off[w.doc[at]]


def _send_windows(batches: Iterator[pa.RecordBatch], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    def flush(s: _Slice):
        ids, doc, pos, (h, g) = s.joined()
        own = _first_of_each(h, g, ids[doc], pos)
        send = np.sort(own)  # in the order of documents again, which takes less room
        yield from _blobs(ids, doc[send], pos[send], [h[send], g[send]], buckets, np.zeros(len(send), bool))

    s = _Slice()
    for t, marks, _ in _answered(batches):
        if all(m is None for m in marks):
            continue
        w = tv.Words(t.column(3))
        doc, pos = _candidates(w, marks, window)
        at, h, g = w.grams(window, wide=True)
        i = np.searchsorted(at, w.off[doc] + pos)
        if s.add(t.column(2).fill_null(0).to_numpy(), doc, pos, [h[i], g[i]], len(w.buf)):
            yield from flush(s)
            s = _Slice()
    if s.ids:
        yield from flush(s)


def _first_of_each(h: np.ndarray, g: np.ndarray, ids: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """Of each (h, g) the entry with the smallest (id, position)."""
    order = np.lexsort((pos, ids, g, h))
    new = np.ones(len(order), bool)
    new[1:] = (h[order][1:] != h[order][:-1]) | (g[order][1:] != g[order][:-1])
    return order[new]


def _answer_windows(batches: Iterator[pa.RecordBatch], groups: int) -> Iterator[pa.RecordBatch]:
    for rows in _groups(batches, ["bucket"]):
        (h, g), doc, pos, _ = _of(rows, 2)
        own = _first_of_each(h, g, doc, pos)
        yield _marks(doc[own], pos[own], 1, groups)


def _cut(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    for b, marks, owners in _answered(batches):
        w = tv.Words(b.column(3))
        doc, pos = _candidates(w, marks, window)
        gone = np.zeros(len(w.hash) + 1, bool)
        gone[w.off[doc] + pos] = True
        for d, at in enumerate(owners):
            if at is not None:
                gone[w.off[d] + at] = False
        room = np.zeros(len(w.hash) + 1, np.int64)
        at = np.flatnonzero(gone[:-1])
        np.add.at(room, at, 1)
        np.subtract.at(room, at + window, 1)
        out = np.cumsum(room[:-1]) > 0
        n_removed = np.diff(np.concatenate([[0], np.cumsum(out)])[w.off])
        raw, kept = w.buf.tobytes(), []
        for d in range(b.num_rows):
            lo, hi = w.off[d], w.off[d + 1]
            if not n_removed[d]:
                kept.append(b" ".join(raw[w.doc_off[d] : w.doc_off[d + 1]].split()))
            else:
                stay = lo + np.flatnonzero(~out[lo:hi])
                kept.append(b" ".join([raw[s:e] for s, e in zip(w.start[stay].tolist(), w.end[stay].tolist(), strict=True)]))
        yield pa.RecordBatch.from_arrays([b.column(2), pa.array(w.count), pa.array(n_removed), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"])


def substring_dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept_text) for each row of docs (doc_id long, text string).

    A word goes if a window of ``window`` words over it also starts earlier, in a smaller doc_id or further up in the same
    document. Null and empty texts have no words. doc_id identifies a document: rows that repeat an id are compared by
    position only, as one document that was given several times, and the first of equal starts is kept in all of them; rows
    with a null doc_id lose nothing. Texts shorter than a window lose nothing. Other columns are not read; an empty table
    gives an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long"), "text")
    real = base.where("doc_id is not null")
    n = max(docs.sparkSession.sparkContext.defaultParallelism, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    buckets = max(n, min(MOST_BUCKETS, -(-input_chars(base) // BUCKET_CHARS)))
    groups = buckets
    dealt = lambda rows, *by: rows.repartition(n, by[0]).sortWithinPartitions(*by)
    group = F.pmod(F.xxhash64(F.when(F.col("doc_id").isNull(), F.hash("text").cast("long")).otherwise(F.col("doc_id"))), F.lit(groups)).cast("int")  # rows without an id, which get no answer, anywhere
    texts = base.select(group.alias("grp"), F.lit(2).alias("kind"), "doc_id", "text", F.lit(None).cast("binary").alias("doc"), F.lit(None).cast("binary").alias("pos"))
    sent = dealt(real.mapInArrow(partial(_send_anchors, window=window, buckets=buckets), _BLOBS), "bucket")
    marks = table(sent.mapInArrow(partial(_answer_anchors, groups=groups), _SAID), "marks")
    both = dealt(marks.unionByName(texts), "grp", "kind")
    sent = dealt(both.mapInArrow(partial(_send_windows, window=window, buckets=buckets), _BLOBS), "bucket")
    owners = sent.mapInArrow(partial(_answer_windows, groups=groups), _SAID)
    both = dealt(marks.unionByName(owners).unionByName(texts), "grp", "kind")
    return both.mapInArrow(partial(_cut, window=window), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept_text string")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d),
k AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS h FROM p),
f AS (SELECT h, min({'d': doc_id, 'i': i}) AS first FROM k GROUP BY h HAVING count(*) > 1),
g AS (SELECT doc_id, i FROM k JOIN f USING (h) WHERE doc_id <> first.d OR i <> first.i),
c AS (SELECT doc_id, list(DISTINCT x) AS gone FROM (SELECT doc_id, unnest(range(i, i + 20)) AS x FROM g) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(array_to_string(list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(coalesce(gone, []), x[2])), lambda x: x[1]), ' '), '')) AS kept_sha256
FROM d LEFT JOIN c USING (doc_id)
"""
