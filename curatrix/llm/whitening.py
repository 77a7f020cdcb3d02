"""Whitening of embeddings by the principal components of their integer images.

An entry c becomes the whole number floor(256 * c), so that sums and means are exact whatever the order of tasks. The
components are fitted to the distinct vectors in two passes: whole sums, then sums of outer products of centred vectors, one
matrix product a batch, one small matrix a task, merged by treeAggregate. Only matrices of dim x dim reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import table
from .vectors import _bytes, matrix, plain, usual_dim

SCALE, COMPONENTS = 256, 4
_WIDTHS = (np.int8, np.int16, np.int32, np.int64)
_MOST = 1 << 62  # below this, sums of whole numbers stay within 64 bits


def _whole(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    """(vec_id, x): x in the narrowest width that holds it, so equal vectors have equal bytes."""
    for b in batches:
        x = np.floor(matrix(b.column(1), dim) * SCALE)
        most = np.abs(x).max(axis=1, initial=0)
        width = np.searchsorted([2.0**7, 2.0**15, 2.0**31, 2.0**63], most, side="right")  # beyond the last: no whole number of 64 bits
        for k, kind in enumerate(_WIDTHS):
            own = np.flatnonzero(width == k)
            if len(own):
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own)), _bytes(x[own].astype(kind))], ["vec_id", "x"])


def _numbers(a: pa.Array, dim: int) -> np.ndarray:
    """What _whole() made, as a matrix of int64."""
    size = np.asarray(pc.binary_length(a))
    out = np.zeros((len(a), dim), np.int64)
    for kind in _WIDTHS:
        own = np.flatnonzero(size == dim * np.dtype(kind).itemsize)
        out[own] = matrix(a.take(pa.array(own)), dim, kind)
    return out


def _exact_sum(x: np.ndarray) -> np.ndarray:
    """Column sums as Python's numbers, which have no bound."""
    small = len(x) * int(np.abs(x.astype(np.float64)).max(initial=0)) < _MOST
    return (x if small else x.astype(object)).sum(axis=0).astype(object)


def _sums(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    n, total = 0, np.zeros(dim, object)
    for b in batches:
        n, total = n + b.num_rows, total + _exact_sum(_numbers(b.column(0), dim))
    yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([" ".join(map(str, total))])], ["n", "sums"])


def _products(batches: Iterator[pa.RecordBatch], dim: int, mean: np.ndarray) -> Iterator[pa.RecordBatch]:
    total = np.zeros((dim, dim))
    for b in batches:
        c = _numbers(b.column(0), dim) - mean
        total += c.T @ c
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], ["products"])


def _moments(batches: Iterator[pa.RecordBatch], dim: int, mean: np.ndarray, turn: np.ndarray) -> Iterator[pa.RecordBatch]:
    got = (0, np.zeros(turn.shape[1]), np.zeros((turn.shape[1],) * 2))
    for b in batches:
        w = (_numbers(b.column(0), dim) - mean) @ turn
        if len(w):
            m = w.mean(axis=0)
            got = _joined(got, (len(w), m, (w - m).T @ (w - m)))
    yield pa.RecordBatch.from_arrays([pa.array([got[0]]), pa.array([got[1].tobytes()]), pa.array([got[2].tobytes()])], ["n", "mean", "products"])


def _joined(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets of rows together (Chan, Golub and LeVeque, 1979)."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return a if a[0] else b
    d = b[1] - a[1]
    return n, a[1] + d * (b[0] / n), a[2] + b[2] + np.outer(d, d) * (a[0] * b[0] / n)


def _merged(rows: DataFrame, zero, read, join):
    """One value of a row for each task, merged in a tree on the executors."""
    return rows.rdd.map(read).treeAggregate(zero, join, join)


def _deviation(x: np.ndarray, n: int, sums: np.ndarray) -> list:
    """sum((n * x - S)^2) of each row, exactly: n^2 sum(x^2) - 2 n sum(x S) + sum(S^2)."""
    most = int(np.abs(x.astype(np.float64)).max(initial=0))
    s_most = max((abs(s) for s in sums), default=0)
    dim = x.shape[1]
    wide = x.astype(object)
    squares = np.einsum("ij,ij->i", x, x).astype(object) if dim * most * most < _MOST else (wide * wide).sum(axis=1)
    mixed = (x @ sums.astype(np.int64)).astype(object) if dim * most * s_most < _MOST and s_most < _MOST else (wide * sums).sum(axis=1)
    return (n * n * squares - 2 * n * mixed + int((sums * sums).sum())).tolist()


def _project(batches: Iterator[pa.RecordBatch], dim: int, sent) -> Iterator[pa.RecordBatch]:
    n, sums, mean, turn, explained, error = sent.value
    k = turn.shape[1]
    for b in batches:
        if not b.num_rows:
            continue
        x = _numbers(b.column(1), dim)
        w = ((x - mean) @ turn).ravel()
        row, component = np.repeat(np.arange(len(x)), k), np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))
        far = [str(y) if len(str(y)) <= 38 else None for y in _deviation(x, n, sums)]
        share = np.tile(explained, len(x))
        rows = pa.array(row)
        same = [pa.array(np.full(len(row), n)), pa.array(far, pa.string()).take(rows)]
        fitted = [pa.array(x, mask=np.isnan(x)) for x in (w, share, np.full(len(row), error))]
        cols = [b.column(0).take(rows), pa.array(component), *same, *fitted]
        yield pa.RecordBatch.from_arrays(cols, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])


def fit(whole: DataFrame, dim: int, components: int = COMPONENTS) -> tuple:
    """(n, sums, mean, turn, explained, identity error) of the distinct vectors of (x binary).

    turn projects a centred vector on its first components over the square roots of their eigenvalues. A component without
    variance (up to rounding) has nulls: NaN in turn.
    """
    listed = table(whole.select("x").distinct(), "fit-list")
    rows = listed.mapInArrow(partial(_sums, dim=dim), "n long, sums string")
    n, sums = _merged(rows, (0, np.zeros(dim, object)), lambda r: (r.n, np.asarray([int(s) for s in r.sums.split()], object)), lambda a, b: (a[0] + b[0], a[1] + b[1]))
    mean = np.asarray([s / max(n, 1) for s in sums], np.float64)
    rows = listed.mapInArrow(partial(_products, dim=dim, mean=mean), "products binary")
    v = _merged(rows, np.zeros((dim, dim)), lambda r: np.frombuffer(bytes(r.products)).reshape(dim, dim), lambda a, b: a + b) / max(n, 1)
    e, u = np.linalg.eigh(v)
    e, u = e[::-1][:components], u[:, ::-1][:, :components]
    real = e > max(e[0], 0) * dim * np.finfo(float).eps
    trace = float(np.trace(v))
    turn = np.where(real, u / np.sqrt(np.where(real, e, 1)), np.nan)
    rows = listed.mapInArrow(partial(_moments, dim=dim, mean=mean, turn=turn[:, real]), "n long, mean binary, products binary")
    k = int(real.sum())
    read = lambda r: (r.n, np.frombuffer(bytes(r.mean)), np.frombuffer(bytes(r.products)).reshape(k, k))
    got = _merged(rows, (0, np.zeros(k), np.zeros((k, k))), read, _joined)
    error = float(np.abs(got[2] / max(got[0], 1) - np.eye(k)).max()) if k else np.nan
    return n, sums, mean, turn, np.where(trace > 0, e / (trace or 1), np.nan), error


def whiten(df: DataFrame, components: int = COMPONENTS, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): for each row of df that takes part, a row for each of the
    first ``components`` components (as many as a vector has entries, if fewer).

    Vectors that are null or empty, or hold nulls or non-finite entries, take no part; nor do vectors of another length than
    most have (the longest such length, if several are as frequent) and those with an entry whose image is beyond 64 bits.
    Repeated rows each get their result; the fit counts a vector once. Rows with a null vec_id are rows like others. Where a
    component has no variance, whitened is null; explained is null where no component has any, identity_error is over the
    components with variance and null without one. deviation is a decimal(38,0), null beyond that. An empty table
    gives an empty result. Signs of components are those of LAPACK's eigenvectors, the same for all rows.
    """
    kind = "vec_id long, component int, n long, deviation string, whitened double, explained double, identity_error double"
    d = table(plain(df, key, vector), "vectors")
    dim, rows, _ = usual_dim(d)
    if not rows:
        return df.sparkSession.createDataFrame([], kind.replace("deviation string", "deviation decimal(38,0)"))
    whole = table(d.where(F.col("dim") == dim).select("vec_id", "v").mapInArrow(partial(_whole, dim=dim), "vec_id long, x binary"), "whole")
    if whole.isEmpty():
        return df.sparkSession.createDataFrame([], kind.replace("deviation string", "deviation decimal(38,0)"))
    sent = df.sparkSession.sparkContext.broadcast(fit(whole, dim, components))  # dim x components numbers
    out = whole.mapInArrow(partial(_project, dim=dim, sent=sent), kind)
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
