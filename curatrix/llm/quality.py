"""Quality rules: base counts of each whole text, and a calibrated n-gram classifier learned from labelled rows.

The classifier is a logistic regression over hashed frequencies of words, word pairs and code-point 1- to 3-grams, learned
in numpy from a bounded sample of labelled rows (``SAMPLE``, the rows with the smallest hash of doc_id, so that it is the
same in every run), and calibrated by Platt's method on a quarter of the sample that the weights have not seen. Texts are
scored in Arrow batches against the fixed threshold. Only the fit is bounded; every row is scored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv

SAMPLE = 4000  # labelled rows that the classifier is learned from, at most
WORD_BITS, CHAR_BITS = 15, 14
THRESHOLD = 0.5
RATE = 0.1
UNIT = 1 << 20  # weights are whole multiples of 1 / UNIT
BATCH_BYTES = 128 << 10  # text that is scored at once: its features take about 150 times as much
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_U = np.uint64
_PAIR, _CH = _U(0x9E3779B97F4A7C15), [_U(0x9FB21C651E98DF25), _U(0xC2B2AE3D27D4EB4F), _U(0xD6E8FEB86659FD93)]


@dataclass
class Model:
    """p = sigmoid(scale * (bias + mean word weight + mean character weight) + shift); weight holds weights times UNIT."""

    weight: np.ndarray
    bias: float
    scale: float
    shift: float
    threshold: float = THRESHOLD


def base_counts(w: tv.Words) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text of a sub-batch."""
    docs, buf = len(w.count), w.buf
    of_byte = lambda flag: np.diff(np.concatenate([[0], np.cumsum(flag)])[w.doc_off])
    out = {"n_words": w.count, "word_chars": of_byte(~tv.SPACE[buf] & ((buf & 0xC0) != 0x80)), "n_symbols": of_byte(_SYMBOL[buf])}
    cut = np.flatnonzero(buf == 10)
    begin = np.sort(np.concatenate([w.doc_off[:-1], cut + 1]))  # a text that ends in \n ends in an empty line, which has no word
    end = np.sort(np.concatenate([cut, w.doc_off[1:]]))
    worded = np.searchsorted(w.start, begin) < np.searchsorted(w.start, end)
    begin, end = begin[worded], end[worded]
    doc = np.searchsorted(w.doc_off, begin, side="right") - 1
    out["n_dup_lines"] = np.bincount(doc, minlength=docs) - np.bincount(_firsts(doc, w.spans.hash(begin, end)), minlength=docs)
    at, h = w.grams(5)
    cover = np.zeros(len(w.hash) + 1, np.int64)
    if len(at):
        key = h ^ tv.mix(w.doc[at].astype(np.uint64))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(at), bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        np.add.at(cover, at[twice], 1)
        np.subtract.at(cover, at[twice] + 5, 1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover[:-1]) > 0)])
    out["n_repeat_words"] = np.diff(covered[w.off])
    return out


def _firsts(doc: np.ndarray, h: np.ndarray) -> np.ndarray:
    """The document of each distinct (document, hash)."""
    order = np.lexsort((h, doc))
    d, x = doc[order], h[order]
    new = np.ones(len(d), bool)
    new[1:] = (d[1:] != d[:-1]) | (x[1:] != x[:-1])
    return d[new]


def _features(w: tv.Words) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Hashed feature ids in text order and their offsets by document: of words and word pairs, and of code-point n-grams."""
    one = (w.hash >> _U(64 - WORD_BITS)).astype(np.int64)
    before = np.zeros(len(w.hash), np.uint64)
    before[1:] = w.hash[:-1]
    before[w.off[:-1][w.count > 0]] = 0  # a text's first word has none before it
    two = ((w.hash * _PAIR + before) * _CH[0] >> _U(64 - WORD_BITS)).astype(np.int64)
    words = np.stack([one, two], 1).reshape(-1)
    lead = (w.buf & 0xC0) != 0x80
    code = np.frombuffer(w.buf.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
    off = np.concatenate([[0], np.cumsum(lead)])[w.doc_off]
    chars = np.zeros((len(code), 3), np.int64)
    h = np.zeros(len(code), np.uint64)
    first = off[:-1][np.diff(off) > 0]
    for k in range(3):  # a gram ends at its text's beginning
        back = np.zeros(len(code), np.uint64)
        back[k:] = (code[: len(code) - k] + _U(1)) * _CH[k]
        for j in range(k):
            back[first[first + j < len(code)] + j] = 0
        h += back
        chars[:, k] = ((h * _PAIR) >> _U(64 - CHAR_BITS)).astype(np.int64)
    return (words, 2 * w.off), (chars.reshape(-1) + (1 << WORD_BITS), 3 * off)


def _mean(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return (total[off[1:]] - total[off[:-1]]) / np.maximum(1, np.diff(off))


def score(w: tv.Words, m: Model) -> np.ndarray:
    """The calibrated probability that each text is good. Weights are summed as whole numbers, so that a text's score does not
    depend on the texts around it."""
    logit = sum(_mean(m.weight[ids], off) for ids, off in _features(w)) / UNIT + m.bias
    return 1 / (1 + np.exp(-np.clip(m.scale * logit + m.shift, -50, 50)))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in tv.sub_batches(batches, most=BATCH_BYTES):
        parts = _features(tv.Words(b.column(1)))
        ids, values = [], []
        for d in range(b.num_rows):
            own = [np.unique(x[off[d] : off[d + 1]], return_counts=True) for x, off in parts]
            ids.append(np.concatenate([i for i, _ in own]).astype(np.int32))
            values.append(np.concatenate([c / max(1, c.sum()) for _, c in own]).astype(np.float32))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(ids, pa.list_(pa.int32())), pa.array(values, pa.list_(pa.float32()))], ["doc_id", "label", "ids", "vals"])


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, epochs: int = 25, seed: int = 11) -> Model:
    """A model from labels (doc_id, quality: null is no label). Without both kinds of label it lets everything pass.

    The driver gets at most ``sample`` rows of at most 2**WORD_BITS + 2**CHAR_BITS numbers each: of documents that repeat an id, the text with
    the smallest hash.
    """
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.col("quality").cast("double")).alias("label"))
    some = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    rows = docs.select(F.col("doc_id").cast("long"), "text").where("text is not null").join(F.broadcast(some), "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"), F.first("label").alias("label"))
    got = rows.mapInArrow(_sample_features, "doc_id long, label double, ids array<int>, vals array<float>").toArrow()
    kinds = np.asarray([xxhash.xxh3_64_intdigest(x.values.to_numpy().tobytes()) for x in got.column("ids")], np.uint64)
    order = np.lexsort((kinds, got.column("doc_id").to_numpy()))
    y = (got.column("label").to_numpy()[order] > 0).astype(float)
    size = (1 << WORD_BITS) + (1 << CHAR_BITS)
    if not 0 < y.sum() < len(y):
        return Model(np.zeros(size, np.int64), 1.0, 1.0, 0.0)
    flat = lambda name: np.concatenate([c.flatten().to_numpy() for c in got.column(name).chunks])
    many = np.concatenate([c.value_lengths().to_numpy() for c in got.column("ids").chunks]).astype(np.int64)
    start, many = (np.cumsum(many) - many)[order], many[order]
    ids, vals = flat("ids"), flat("vals")
    del got
    pa.default_memory_pool().release_unused()
    held = np.arange(len(y)) % 4 == 3
    if not 0 < y[held].sum() < held.sum() or not 0 < y[~held].sum() < (~held).sum():
        held[:] = False

    def parts(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(rows, the row of each value among them, feature ids, values), 128 rows at a time: the driver's memory is small."""
        for k in range(0, len(rows), 128):
            r = rows[k : k + 128]
            n = many[r]
            at = np.repeat(start[r] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            yield r, np.repeat(np.arange(len(r)), n), ids[at], vals[at]

    balance = np.where(y > 0, 0.5 / y[~held].mean(), 0.5 / (1 - y[~held]).mean()) * ~held
    learned, rng = np.flatnonzero(~held), np.random.Generator(np.random.PCG64(seed))
    w, bias, t = np.zeros(size), 0.0, 0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for epoch in range(epochs):
        for r, row, i, x in parts(rng.permutation(learned)):
            err = (1 / (1 + np.exp(-np.bincount(row, w[i] * x, len(r)) - bias)) - y[r]) * balance[r] / len(r)
            g, gb, t = np.bincount(i, err[row] * x, size) + 1e-7 * w, err.sum(), t + 1
            m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
            step = RATE * (1 - 0.9 * epoch / epochs) * np.sqrt(1 - 0.99**t) / (1 - 0.9**t)
            w -= step * m / (np.sqrt(v) + 1e-10)
            bias -= step * mb / (np.sqrt(vb) + 1e-10)
    weight = np.round(w * UNIT).astype(np.int64)
    w = weight / UNIT
    z = np.concatenate([np.bincount(row, w[i] * x, len(r)) for r, row, i, x in parts(np.arange(len(y)))]) + bias
    part = held if held.any() else ~held
    scale, shift = _platt(z[part], y[part])
    return Model(weight, float(bias), scale, shift)


def _platt(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Newton steps for p = sigmoid(a z + b), with Platt's smoothed targets."""
    up, down = y.sum(), len(y) - y.sum()
    t = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    c = np.asarray([1.0, 0.0])
    x = np.stack([z, np.ones(len(z))], 1)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ c, -50, 50)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (p - t) + 1e-4 * (c - [1, 0]))
        c = c - step * min(1.0, 5 / (np.abs(step).max() + 1e-9))
    return float(c[0]), float(c[1])


def _judge(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    m = model.value
    for b in tv.sub_batches(batches, most=BATCH_BYTES):
        w = tv.Words(b.column(1))
        c = base_counts(w)
        p = score(w, m)
        failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        out = {"doc_id": b.column(0)} | {k: pa.array(x.astype(np.int64)) for k, x in c.items()}
        out |= {"base_failed": pa.array(failed), "p_good": pa.array(p), "kept": pa.array(~failed & (p >= m.threshold))}
        yield pa.RecordBatch.from_pydict(out)


def quality_rules(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """A row for each row of docs (doc_id, text): the base counts, base_failed, p_good and kept.

    A null or empty text has no word: its counts are 0 and it fails the base rules. A null doc_id stays null. Equal
    texts are judged alike, whatever stands around them; other columns are not read; an empty table gives an empty result.
    """
    m = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))  # a few hundred kB, fixed by WORD_BITS and CHAR_BITS
    kind = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, p_good double, kept boolean"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(partial(_judge, model=m), kind)


def _only_kept(batches: Iterator[pa.RecordBatch], model, column: str) -> Iterator[pa.RecordBatch]:
    m = model.value
    for b in tv.sub_batches(batches, column, BATCH_BYTES):
        w = tv.Words(b.column(b.schema.get_field_index(column)))
        c = base_counts(w)
        failed = (c["n_words"] < 10) | (100 * c["n_repeat_words"] > 20 * c["n_words"])
        yield b.filter(pa.array(~failed & (score(w, m) >= m.threshold)))


def keep_good(docs: DataFrame, labels: DataFrame, model: Model | None = None) -> DataFrame:
    """The rows of docs that quality_rules() keeps, with all their columns, in one pass without a join.

    A null, empty or wordless text fails the base rules and goes; repeated rows are judged alike; a null doc_id does not matter;
    empty in, empty out.
    """
    m = docs.sparkSession.sparkContext.broadcast(model or train(docs, labels))
    return docs.mapInArrow(partial(_only_kept, model=m, column="text"), docs.schema)
