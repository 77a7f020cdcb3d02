"""Embeddings as bytes: the rows of a table of vectors that take part, and the bytes back as matrices."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _bytes(m: np.ndarray) -> pa.Array:
    """The rows of a matrix as binary values."""
    m = np.ascontiguousarray(m)
    off = np.arange(len(m) + 1, dtype=np.int64) * m.shape[1] * m.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(m), [None, pa.py_buffer(off), pa.py_buffer(m.tobytes())]).cast(pa.binary())


def matrix(a: pa.Array, dim: int, kind: type = np.float64) -> np.ndarray:
    """Binary values of ``dim`` numbers each as rows of a matrix."""
    a = a.cast(pa.large_binary())
    off = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    if not len(a) or off[0] == off[-1]:
        return np.zeros((len(a), dim), kind)
    return np.frombuffer(a.buffers()[2], np.uint8)[off[0] : off[-1]].view(kind).reshape(len(a), dim)


def _plain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        rows = b.column(1)
        off, values = np.asarray(rows.offsets), np.asarray(rows.values.fill_null(np.nan))
        bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
        size = np.diff(off)
        ok = (bad[off[1:]] == bad[off[:-1]]) & (size > 0) & np.asarray(rows.is_valid())
        for dim in np.unique(size[ok]).tolist():
            own = np.flatnonzero(ok & (size == dim))
            v = values[off[own][:, None] + np.arange(dim)] + 0.0  # no negative zeros: equal vectors have equal bytes
            norm = np.sqrt(np.einsum("ij,ij->i", v, v))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(own)), pa.array(np.full(len(own), dim, np.int32)), pa.array(norm), _bytes(v)], ["vec_id", "dim", "norm", "v"])


def plain(df: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id long, dim int, norm double, v binary) of the rows whose vector is not null or empty and has neither nulls nor
    non-finite entries; v holds its entries as doubles. Other columns are not read."""
    d = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v"))
    return d.mapInArrow(_plain, "vec_id long, dim int, norm double, v binary")


def usual_dim(d: DataFrame) -> tuple[int, int, float]:
    """(dim, rows, largest norm) of the length that most rows of plain() have, the longest of these; (0, 0, 0.0) without rows."""
    got = d.groupBy("dim").agg(F.count("*").alias("n"), F.max("norm").alias("most")).orderBy(F.desc("n"), F.desc("dim")).first()
    return (got.dim, got.n, got.most) if got else (0, 0, 0.0)
