"""Intermediate tables in the folder that the whole cluster shares."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.scratch import drop, made, new_path, shared_dir

__all__ = ["discard", "input_chars", "new_path", "shared_dir", "stage_table", "table"]


def table(df: DataFrame, name: str) -> DataFrame:
    """Write df once and read it back: its lineage ends here and lost executors can't take its rows with them."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.curatrix_path = path
    return out


def stage_table(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """table() of what make() gives; the tables that make() wrote on the way are deleted, as nothing needs them any more."""
    before = set(made())
    df = make()
    used = [x for x in made() if x not in before]
    out = table(df, name)
    drop(used)
    return out


def discard(df: DataFrame) -> None:
    """Delete what table() wrote for df."""
    drop([df.curatrix_path])


def input_chars(docs: DataFrame, column: str = "text") -> int:
    """Characters in a text column; sizes the number of buckets, never what is kept."""
    return int(docs.agg(F.sum(F.length(column).cast("long"))).first()[0] or 0)
