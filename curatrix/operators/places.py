"""Gapless places of rows, at any size: counts of partitions or of file ranges, summed up, and an offset within each."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import new_path

_HASHED = ("string", "bigint", "int", "smallint", "tinyint", "double", "float", "boolean", "date", "timestamp", "timestamp_ntz", "binary")


def fresh(columns: list[str], name: str) -> str:
    """A column name that is none of these, whatever their case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def _written(df: DataFrame) -> DataFrame:
    path = new_path(df.sparkSession, "places")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _numbered(d: DataFrame, group: list[str], id_: str, out: str, start: int, columns: list[str]) -> DataFrame:
    """Places from ids that rise by one within each group, groups in the order of their columns. There are few groups: one a partition."""
    counts = d.groupBy(*group).agg(F.min(id_).alias("_least"), F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy(*group).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    counts = counts.select(*(F.col(g).alias(f"_of{k}") for k, g in enumerate(group)), (before - F.col("_least") + start).alias("_shift"))
    same = F.lit(True)
    for k, g in enumerate(group):
        same &= d[g] == counts[f"_of{k}"]
    return d.join(F.broadcast(counts), same).select(*(d[f"`{c}`"] for c in columns), (d[id_] + F.col("_shift")).cast("long").alias(out))


def with_place(df: DataFrame, *order: str, out: str = "place", start: int = 0, tasks: int | None = None) -> DataFrame:
    """df with the place of each row by ``order`` (nulls first), counting from ``start`` without gaps or repeats.

    Rows are range-partitioned, sorted and written once; a partition's count is all that is summed up. Rows that are equal in
    ``order`` come by a hash of their other columns, so that they can be told apart in ranges, too; rows that are equal throughout
    may change places.
    """
    spark = df.sparkSession
    id_, tie = fresh(df.columns, "_id"), fresh(df.columns, "_tie")
    part = fresh(df.columns, "_part")
    hashed = [F.col(f"`{c}`") for c, kind in df.dtypes if kind in _HASHED] or [F.lit(0)]
    by = [*(F.col(c).asc_nulls_first() for c in order), F.col(tie)]
    n = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = df.withColumn(tie, F.xxhash64(*hashed)).repartitionByRange(n, *by).sortWithinPartitions(*by)
    d = _written(d.drop(tie).withColumn(id_, F.monotonically_increasing_id()).withColumn(part, F.shiftright(id_, 33)))
    return _numbered(d, [part], id_, out, start, df.columns)


def with_file_place(df: DataFrame, out: str = "place", start: int = 0) -> DataFrame:
    """df, as it is read from files, with the place of each row: by the files' names, then by the row's place in its file.

    Nothing is shuffled: the rows are written once as they are read, and rows of a file's ranges are counted.
    """
    id_, file, at = fresh(df.columns, "_id"), fresh(df.columns, "_file"), fresh(df.columns, "_at")
    d = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.file_block_start").alias(at), F.monotonically_increasing_id().alias(id_))
    return _numbered(_written(d), [file, at], id_, out, start, df.columns)
