"""Language identification by a bidirectional gated recurrent network over bytes, learned in numpy.

One recurrent network runs forwards over a text's bytes and one backwards; the two states at a byte give that byte's
probabilities of the languages, so that every byte of the whole text is labelled. A document's probabilities are the mean over
its bytes. The texts of a batch advance together, byte by byte. States are carried through the whole of a text up to ``SEGMENT``
bytes; a longer one is cut into segments of that length, each of which both networks enter ``WARM`` bytes early, so
that no byte has less than that before and after it but at the text's ends.

The network learns by backpropagation through time from windows of ``WINDOW`` bytes of a bounded sample of documents:
``PER_LANG`` of each language, those with the smallest hash of doc_id, whole or, beyond ``DOC_BYTES``, by windows spread evenly over the
whole text. Beyond ``MOST`` rows or ``MOST_BYTES`` in all, each language gives its first document before any gives its second, and so on.
Only documents outside the held-out fold (crc32 of doc_id modulo 4 is 2) are learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv

HIDDEN, SEGMENT, WARM, BLOCK = 8, 4096, 64, 64
PER_LANG, MOST, WINDOW = 120, 5_000, 96
DOC_BYTES, MOST_BYTES = 64 << 10, 16 << 20  # that are learned from, of a text and of all: the driver holds these
_f = np.float32


@dataclass
class Network:
    """Both directions are stacked on the first axis. Columns of ``x`` and ``u``: update gate, reset gate, candidate."""

    langs: list[str]
    x: np.ndarray  # (2, 256, 3 H): input weights of each byte, with the biases
    u: np.ndarray  # (2, H, 3 H)
    out: np.ndarray  # (2, H, C)
    bias: np.ndarray  # (C,)

    def params(self) -> list[np.ndarray]:
        return [self.x, self.u, self.out, self.bias]


def _gate(a: np.ndarray) -> np.ndarray:
    """The piecewise linear sigmoid: without exponentials, which would take most of the time."""
    a *= _f(0.25)
    a += _f(0.5)
    return np.clip(a, 0, 1, out=a)


def _step(net: Network, state: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, tuple]:
    """The state after one byte, and what the way back needs; a (2, n, 3 H) are the bytes' input weights."""
    h = HIDDEN
    b = state @ net.u
    gates = _gate(a[..., : 2 * h] + b[..., : 2 * h])
    z, r = gates[..., :h], gates[..., h:]
    cand = b[..., 2 * h :] * r
    cand += a[..., 2 * h :]
    cand /= np.abs(cand) + _f(1)
    return cand + z * (state - cand), (state, z, r, b[..., 2 * h :], cand)


def _softmax(logit: np.ndarray) -> np.ndarray:
    logit -= logit.max(-1, keepdims=True)
    np.exp(logit, out=logit)
    logit /= logit.sum(-1, keepdims=True)
    return logit


def forward(net: Network, piece: np.ndarray) -> tuple[np.ndarray, np.ndarray, list]:
    """For n windows (n, steps) of bytes: probabilities (steps, n, C) of each byte, the states, and what the way back needs."""
    n, steps = piece.shape
    h = HIDDEN
    state = np.zeros((2, n, h), net.u.dtype)
    states = np.empty((steps, 2, n, h), net.u.dtype)
    kept = []
    for t in range(steps):
        state, used = _step(net, state, np.stack([net.x[0][piece[:, t]], net.x[1][piece[:, steps - 1 - t]]]))
        kept.append(used)
        states[t] = state
    logit = states[:, 0].reshape(-1, h) @ net.out[0] + states[::-1, 1].reshape(-1, h) @ net.out[1]
    return _softmax(logit + net.bias).reshape(steps, n, -1), states, kept


def backward(net: Network, piece: np.ndarray, d_logit: np.ndarray, states: np.ndarray, kept: list) -> list[np.ndarray]:
    """Gradients of params() from those of the logits (steps, n, C), back through time."""
    steps, n, c = d_logit.shape
    h = HIDDEN
    flat = d_logit.reshape(-1, c)
    g_out = np.stack([states[:, 0].reshape(-1, h).T @ flat, states[::-1, 1].reshape(-1, h).T @ flat])
    d_states = np.stack([(flat @ net.out[0].T).reshape(steps, n, h), (flat @ net.out[1].T).reshape(steps, n, h)[::-1]], 1)
    g_x, g_u = np.zeros_like(net.x), np.zeros_like(net.u)
    d = np.zeros((2, n, h), _f)
    for t in range(steps - 1, -1, -1):
        before, z, r, b, cand = kept[t]
        d = d + d_states[t]
        d_z = d * (before - cand) * ((z > 0) & (z < 1)) * _f(0.25)
        d_c = d * (1 - z) * (1 - np.abs(cand)) ** 2
        d_r = d_c * b * ((r > 0) & (r < 1)) * _f(0.25)
        d_a = np.concatenate([d_z, d_r, d_c], 2)
        d_b = np.concatenate([d_z, d_r, d_c * r], 2)
        g_u += before.transpose(0, 2, 1) @ d_b
        np.add.at(g_x[0], piece[:, t], d_a[0])
        np.add.at(g_x[1], piece[:, steps - 1 - t], d_a[1])
        d = d * z + d_b @ net.u.transpose(0, 2, 1)
    return [g_x, g_u, g_out, flat.sum(0)]


def fit(pieces: np.ndarray, label: np.ndarray, langs: list[str], epochs: int = 2, batch: int = 128, seed: int = 5) -> Network:
    """Learn from windows (n, WINDOW) of bytes and their languages by Adam; the same in every run."""
    rng = np.random.Generator(np.random.PCG64(seed))
    c, h = len(langs), HIDDEN
    net = Network(langs, (rng.normal(size=(2, 256, 3 * h)) * 0.3).astype(_f), (rng.normal(size=(2, h, 3 * h)) / h**0.5).astype(_f), (rng.normal(size=(2, h, c)) / h**0.5).astype(_f), np.zeros(c, _f))
    first, second = [[np.zeros_like(p) for p in net.params()] for _ in range(2)]
    weight = (len(label) / c / np.maximum(1, np.bincount(label, minlength=c)))[label].astype(_f)
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(label))
        for at in range(0, len(order), batch):
            i = order[at : at + batch]
            p, states, kept = forward(net, pieces[i])
            d = p.copy()
            d[:, np.arange(len(i)), label[i]] -= 1
            d *= (weight[i] / (pieces.shape[1] * len(i)))[None, :, None]
            step += 1
            rate = 0.02 * (1 - 0.8 * epoch / epochs) * (1 - 0.99**step) ** 0.5 / (1 - 0.9**step)
            for q, g, m, v in zip(net.params(), backward(net, pieces[i], d, states, kept), first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                q -= (rate * m / (np.sqrt(v) + 1e-8)).astype(_f)
    return net


def _windows(buf: np.ndarray, off: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts as windows (n, size), the last of a text filled up with spaces, and the text of each."""
    long = np.diff(off)
    count = -(-long // size)
    room = np.full(count.sum() * size, 32, np.uint8)
    room[np.arange(len(buf)) + np.repeat((np.cumsum(count) - count) * size - off[:-1], long)] = buf
    return room.reshape(-1, size), np.repeat(np.arange(len(long)), count)


def _sample_windows(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Windows of each text, ``most`` of them spread evenly over it if it has more."""
    for b in tv.sub_batches(batches, most=256 << 10):
        windows, doc = _windows(*tv.utf8(b.column(1)), WINDOW)
        count = np.bincount(doc, minlength=b.num_rows)
        if count.max(initial=0) > most:
            first = np.cumsum(count) - count
            at = np.concatenate([f + (np.arange(n) if n <= most else np.linspace(0, n - 1, most).astype(int)) for f, n in zip(first, count, strict=True)])
            windows, doc = windows[at], doc[at]
        rows = pa.array(doc)
        flat = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WINDOW), len(windows), [None, pa.py_buffer(windows.tobytes())])
        yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(2).take(rows), flat.cast(pa.binary())], ["doc_id", "lang", "piece"])


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(True))


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Network | None:
    """A network from docs (doc_id, text, lang), None if no row can be learned from.

    Every language that a row outside the held-out fold has is learned, up to MOST of them. A document that is there several times
    counts once for each language; of different texts, the one with the smallest hash. The driver gets at most MOST_BYTES, and the
    first document of each language, DOC_BYTES at most, in any case.
    """
    d = docs.select(F.col("doc_id").cast("long"), "text", "lang").where(~held_out() & F.col("lang").isNotNull() & (F.length("text") > 0))
    ids = d.groupBy("doc_id", "lang").agg(F.min(F.struct(F.xxhash64("text").alias("h"), F.octet_length("text").alias("b"))).alias("_t"))  # no text is shuffled for the choice
    share = F.xxhash64(F.col("doc_id"), F.lit("lang"))
    first = lambda *by: F.row_number().over(Window.partitionBy("lang", *by).orderBy("_s", "doc_id"))
    chosen = ids.withColumn("_s", share).withColumn("_salt", F.pmod(F.shiftright("_s", 8), F.lit(64)))
    chosen = chosen.withColumn("_rank", first("_salt")).where(F.col("_rank") <= per_lang)  # so a frequent language is not ranked in one task
    chosen = chosen.withColumn("_rank", first()).where(F.col("_rank") <= per_lang).orderBy("_rank", "lang").limit(MOST)
    upto = F.sum(F.least(F.col("_t.b"), F.lit(DOC_BYTES)).cast("long")).over(Window.orderBy("_rank", "lang").rowsBetween(Window.unboundedPreceding, 0))  # over MOST rows
    chosen = chosen.withColumn("_upto", upto).where((F.col("_upto") <= MOST_BYTES) | (F.col("_rank") == 1))
    chosen = chosen.select(F.col("doc_id").alias("_d"), F.col("lang").alias("_l"), F.col("_t.h").alias("_h"))
    same = (F.col("doc_id") == F.col("_d")) & (F.col("lang") == F.col("_l")) & (F.xxhash64("text") == F.col("_h"))
    some = d.join(F.broadcast(chosen), same).select("doc_id", "text", "lang").dropDuplicates(["doc_id", "lang"])  # MOST rows at most; repeated ones once
    got = some.mapInArrow(partial(_sample_windows, most=max(1, DOC_BYTES // WINDOW)), "doc_id long, lang string, piece binary").toArrow().sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("piece", "ascending")])
    if not got.num_rows:
        return None
    langs, label = np.unique(np.asarray(got.column("lang").to_pylist(), object).astype(str), return_inverse=True)
    pieces = np.frombuffer(b"".join(got.column("piece").to_pylist()), np.uint8).reshape(-1, WINDOW)
    return fit(pieces, label, [str(x) for x in langs])


def has_letter(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    ascii_letter = ((buf | 32) >= 97) & ((buf | 32) <= 122)
    some = np.diff(np.concatenate([[0], np.cumsum(ascii_letter)])[off]) > 0
    for d in np.flatnonzero(~some & (np.diff(off) > 0)):
        some[d] = any(map(str.isalpha, buf[off[d] : off[d + 1]].tobytes().decode("utf-8", "replace")))
    return some


def document_probabilities(net: Network, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(documents, languages): the mean over all bytes of each text."""
    p, out = _softmax(byte_logits(net, buf, off)), np.zeros((len(off) - 1, len(net.langs)))
    full = np.flatnonzero(np.diff(off))
    if len(full):
        out[full] = np.add.reduceat(p, off[full], axis=0, dtype=np.float64) / np.diff(off)[full, None]
    return out


def byte_logits(net: Network, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """(bytes, languages): the logits of each byte of all texts."""
    long = np.diff(off)
    count = -(-long // SEGMENT)
    doc = np.repeat(np.arange(len(long)), count)
    start = off[doc] + (np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)) * SEGMENT
    end = np.minimum(start + SEGMENT, off[doc + 1])
    lo, hi = np.maximum(start - WARM, off[doc]), np.minimum(end + WARM, off[doc + 1])
    steps = np.maximum(end - lo, hi - start)
    order = np.argsort(-steps, kind="stable")
    start, end, lo, hi, steps = start[order], end[order], lo[order], hi[order], steps[order]
    both = np.zeros((2, len(buf) + 1, len(net.langs)), _f)  # what each network says of each byte; the last row takes what is outside of the segment
    state = np.zeros((2, len(order), HIDDEN), _f)
    for t0 in range(0, int(steps[0]) if len(steps) else 0, BLOCK):
        n = int(np.searchsorted(-steps, -t0, side="left"))  # the segments that are not at their end
        state = state[:, :n]
        t = np.arange(t0, t0 + BLOCK)[:, None]
        at = np.stack([np.minimum(lo[:n] + t, hi[:n] - 1), np.maximum(hi[:n] - 1 - t, lo[:n])], 1)  # (BLOCK, 2, n)
        states = np.empty((BLOCK, 2, n, HIDDEN), _f)
        a = np.empty((2, n, 3 * HIDDEN), _f)
        for k, own in enumerate(buf[at]):
            np.take(net.x[0], own[0], axis=0, out=a[0])
            np.take(net.x[1], own[1], axis=0, out=a[1])
            state, _ = _step(net, state, a)
            states[k] = state
        said = states @ net.out
        to = np.where((at >= start[:n]) & (at < end[:n]) & (t < (hi - lo)[:n])[:, None], at, len(buf))
        for way in range(2):
            both[way][to[:, way]] = said[:, way]
    logit = both[0, :-1]
    logit += both[1, :-1]
    logit += net.bias
    return logit


def _label(batches: Iterator[pa.RecordBatch], net) -> Iterator[pa.RecordBatch]:
    n = net.value
    for b in tv.sub_batches(batches):
        buf, off = tv.utf8(b.column(2))
        if n is None:
            lang, score = ["und"] * b.num_rows, np.zeros(b.num_rows)
        else:
            p = document_probabilities(n, buf, off)
            best, known = p.argmax(1), has_letter(buf, off)
            lang = [n.langs[i] if k else "und" for i, k in zip(best, known, strict=True)]
            score = np.where(known, np.round(np.clip(p.max(1), 0, 1), 5), 0.0)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()), pa.array(score)], ["doc_id", "held_out", "lang_pred", "score"])


def identify(docs: DataFrame, net: Network | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of docs (doc_id, text, and lang to learn from unless a network is given).

    lang_pred is ``und`` with score 0 for a null text, a text without a letter, or if there was nothing to learn from. A
    null doc_id counts as held out. Predictions read the text alone; equal texts get equal results (scores are rounded, as
    sums of single precision differ in the last digits from batch to batch); an empty table
    gives an empty result.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net or train(docs))  # about 60 kB, fixed by HIDDEN and the number of languages
    d = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    return d.mapInArrow(partial(_label, net=sent), "doc_id long, held_out boolean, lang_pred string, score double")
