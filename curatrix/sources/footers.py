"""What the footers of Parquet files say, read by tasks from the files' ends: no page of data is touched."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import listed, opened

CHUNKS = (
    "file string, file_bytes long, file_rows long, created_by string, row_group int, group_rows long, column string, physical_type string, logical_type string, "
    "compression string, encodings array<string>, n_values long, n_nulls long, compressed_bytes long, plain_bytes long, least string, most string"
)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            store, at = opened(path)
            with store.open_input_file(at) as f:
                m = pq.ParquetFile(f).metadata
            own = {"file": path, "file_bytes": size, "file_rows": m.num_rows, "created_by": m.created_by}
            if not m.num_row_groups:
                rows.append(own)
            for g in range(m.num_row_groups):
                group = m.row_group(g)
                for c in range(group.num_columns):
                    x, kind = group.column(c), m.schema.column(c)
                    s = x.statistics
                    known = s is not None and s.has_null_count
                    bounds = s is not None and s.has_min_max
                    rows.append(
                        own
                        | {"row_group": g, "group_rows": group.num_rows, "column": x.path_in_schema, "physical_type": x.physical_type}
                        | {"logical_type": None if kind.logical_type.type == "NONE" else str(kind.logical_type), "compression": x.compression}
                        | {"encodings": list(x.encodings), "n_values": x.num_values, "n_nulls": s.null_count if known else None}
                        | {"compressed_bytes": x.total_compressed_size, "plain_bytes": x.total_uncompressed_size}
                        | {"least": str(s.min) if bounds else None, "most": str(s.max) if bounds else None}
                    )
        yield pa.RecordBatch.from_pylist(rows, _KIND)


_KIND = pa.schema(
    [("file", pa.string()), ("file_bytes", pa.int64()), ("file_rows", pa.int64()), ("created_by", pa.string()), ("row_group", pa.int32()), ("group_rows", pa.int64()), ("column", pa.string())]
    + [("physical_type", pa.string()), ("logical_type", pa.string()), ("compression", pa.string()), ("encodings", pa.list_(pa.string())), ("n_values", pa.int64()), ("n_nulls", pa.int64())]
    + [("compressed_bytes", pa.int64()), ("plain_bytes", pa.int64()), ("least", pa.string()), ("most", pa.string())]
)


def column_chunks(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column of each row group of the Parquet files under a path: see CHUNKS. A file without row groups has one row without
    a column. Nulls are counted where the writer has; bounds are text. Empty files and other names than *.parquet are passed over."""
    files = listed(spark, path).where(F.col("path").rlike(r"\.parquet$"))
    return files.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInArrow(_chunks, CHUNKS)


def columns(spark: SparkSession, path: str) -> DataFrame:
    """A row for each column of all files together: physical_type, n_files, n_row_groups, n_values, n_nulls (null if any chunk lacks it),
    compressed_bytes, plain_bytes, compressions and encodings."""
    d = column_chunks(spark, path).where("column is not null")
    nulls = F.when(F.count("*") == F.count("n_nulls"), F.sum("n_nulls"))
    return d.groupBy("column", "physical_type").agg(
        F.count_distinct("file").alias("n_files"),
        F.count("*").alias("n_row_groups"),
        F.sum("n_values").alias("n_values"),
        nulls.alias("n_nulls"),
        F.sum("compressed_bytes").alias("compressed_bytes"),
        F.sum("plain_bytes").alias("plain_bytes"),
        F.sort_array(F.collect_set("compression")).alias("compressions"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("encodings")))).alias("encodings"),
    )
