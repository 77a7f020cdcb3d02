"""Contiguous shards of near equal bytes by global prefix sums.

Rows are range-partitioned and sorted by doc_id once and written down; each partition's totals (a few numbers for each
partition) give the bytes and rows before it; a running sum within the partition then gives each row its global position,
and the row goes to the shard in whose equal share of all bytes its middle byte lies. No task sees more than a partition.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .storage import shared_dir

SHARDS = 16


def _running(batches: Iterator[pa.RecordBatch], before: dict[int, tuple[int, int]], total: int, shards: int) -> Iterator[pa.RecordBatch]:
    size0, row0 = before.get(TaskContext.get().partitionId(), (0, 0))
    for b in batches:
        if not b.num_rows:
            continue
        size = b.column(b.schema.get_field_index("size")).to_numpy()
        end = size0 + np.cumsum(size)
        middle = (end - size).astype(object) * 2 + size if total > 1 << 56 else 2 * (end - size) + size
        shard = np.minimum(shards - 1, middle * shards // (2 * total)).astype(np.int32)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(shard), pa.array(row0 + np.arange(b.num_rows))], [*b.schema.names, "shard", "_row"])
        size0, row0 = int(end[-1]), row0 + b.num_rows


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A row for each row of docs (doc_id, text): doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Shards are contiguous in the order of doc_id (null first), then size and checksum, which orders repeated rows; rows
    that are equal in all of these may change places. A null text has size 1 and the checksum of the empty text. Other
    columns are not read; an empty table gives an empty result. A shard's bytes differ from the equal share by less than
    two texts.
    """
    spark = docs.sparkSession
    d = docs.select(F.col("doc_id").cast("long"), (F.octet_length(F.coalesce("text", F.lit(""))) + F.lit(1)).cast("long").alias("size"), F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    d = d.repartitionByRange(n, "doc_id", "size", "text_crc32").sortWithinPartitions("doc_id", "size", "text_crc32").checkpoint()  # keeps its partitions and their order
    totals = d.groupBy(F.spark_partition_id().alias("p")).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).orderBy("p").collect()
    before, size0, row0 = {}, 0, 0
    for t in totals:
        before[t.p] = (size0, row0)
        size0, row0 = size0 + t.bytes, row0 + t["rows"]
    d = d.mapInArrow(partial(_running, before=before, total=max(1, size0), shards=shards), "doc_id long, size long, text_crc32 long, shard int, _row long")
    first = d.groupBy("shard").agg(F.min("_row").alias("_first"))  # at most ``shards`` rows
    out = d.join(F.broadcast(first), "shard")
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("_row") - F.col("_first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
