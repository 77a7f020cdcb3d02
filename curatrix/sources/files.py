"""Files that tasks read and write themselves: durable small tables, copies, and a sink of one file for each row with its own commit.

Paths are URIs of a store that all executors reach; a path without a scheme is a local one.
"""

from __future__ import annotations

import contextlib
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage


def opened(uri: str) -> tuple[pafs.FileSystem, str]:
    """The store of a path and the path in it."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), os.path.abspath(uri))


def hadoop(spark: SparkSession, path: str):
    """A path and its store, as the JVM has them."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, store = hadoop(spark, path)
    return store.exists(p)


def remove(spark: SparkSession, path: str) -> None:
    p, store = hadoop(spark, path)
    store.delete(p, True)


def make_folder(spark: SparkSession, path: str) -> str:
    p, store = hadoop(spark, path)
    store.mkdirs(p)
    return path


def add_table(folder: str, rows: pa.Table, name: str) -> None:
    """One more Parquet file in a folder, there in full or not at all: readers pass over names that begin with an underscore."""
    store, at = opened(folder)
    passing = f"{at}/_writing-{uuid.uuid4().hex}"
    with store.open_output_stream(passing) as f:
        pq.write_table(rows, f, compression="zstd")
    store.move(passing, f"{at}/{name}-{uuid.uuid4().hex}.parquet")


def _copy(batches: Iterator[pa.RecordBatch], root: str, to: str) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for path, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            (src, a), (dst, out) = opened(path), opened(to)
            inside = opened(path)[1].removeprefix(opened(root)[1]).lstrip("/") or os.path.basename(a)
            passing = f"{out}/_writing-{uuid.uuid4().hex}"
            dst.create_dir(os.path.dirname(f"{out}/{inside}"), recursive=True)
            copied = 0
            with src.open_input_stream(a) as f, dst.open_output_stream(passing) as g:
                while part := f.read(4 << 20):
                    g.write(part)
                    copied += len(part)
            if copied != size:
                raise OSError(f"{path} has changed while it was copied")
            dst.move(passing, f"{out}/{inside}")
        yield pa.RecordBatch.from_arrays([b.column(1)], ["length"])


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, length) of the files under a path, found by the engine, which passes over empty ones; no byte of them is read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")


def copy(spark: SparkSession, path: str, to: str) -> str:
    """A copy of a file, or of all files under a folder, byte for byte, made by tasks; a file is there in full or not at all.

    Empty files are left out. The copy is marked when it is whole. One that is whole stays as it is; one that isn't is done again. Never deletes ``path``.
    """
    mark = f"{to}/_COPIED"
    if not exists(spark, mark):
        p, store = hadoop(spark, path)
        root = path if store.getFileStatus(p).isDirectory() else os.path.dirname(path)
        make_folder(spark, to)
        files = listed(spark, path).repartition(max(1, spark.sparkContext.defaultParallelism))
        files.mapInArrow(partial(_copy, root=root, to=to), "length long").write.format("noop").mode("overwrite").save()
        q, store = hadoop(spark, mark)
        store.create(q, True).close()
    return to


@dataclass
class _Written(WriterCommitMessage):
    attempt: str
    part: int
    n: int


class _Writer(DataSourceArrowWriter):
    """Writes the files of a task into a folder of the attempt. Commit gives one attempt's folder of each part its name; what else there is goes."""

    def __init__(self, options: dict[str, str]):
        self.folder, self.run = options["path"], uuid.uuid4().hex

    def write(self, batches: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        from pyspark import TaskContext

        store, at = opened(self.folder)
        part = TaskContext.get().partitionId()
        attempt = f"{at}/_attempt-{self.run}/{part:05d}-{uuid.uuid4().hex}"
        n, made = 0, set()
        try:
            for b in batches:
                columns = (b.column(b.schema.get_field_index(c)).to_pylist() for c in ("folder", "name", "text"))
                for folder, name, text in zip(*columns, strict=True):
                    if folder not in made:
                        made.add(folder)
                        store.create_dir(f"{attempt}/{folder}", recursive=True)
                    with store.open_output_stream(f"{attempt}/{folder}/{name}") as f:
                        f.write(text.encode())
                    n += 1
        except BaseException:
            with contextlib.suppress(OSError):
                store.delete_dir(attempt)
            raise
        return _Written(attempt if n else "", part, n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, at = opened(self.folder)
        for m in messages:
            if m is not None and m.n:
                for x in store.get_file_info(pafs.FileSelector(m.attempt)):  # the folders of this part: one, or a few whose hashes met
                    store.move(x.path, f"{at}/{x.base_name}")
        self._clear(store, at)
        store.open_output_stream(f"{at}/_SUCCESS").close()

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        self._clear(*opened(self.folder))

    def _clear(self, store: pafs.FileSystem, at: str) -> None:
        with contextlib.suppress(OSError):
            store.delete_dir(f"{at}/_attempt-{self.run}")


class TextFiles(DataSource):
    """A sink for rows (folder, name, text): a file for each row, in folders that are there in full once the write is committed."""

    @classmethod
    def name(cls) -> str:
        return "curatrix_files"

    def schema(self) -> str:
        return "folder string, name string, text string"

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options)


def folder_of(name: str, folders: int) -> str:
    """The folder that write_text_files() puts a file into."""
    return f"part-{zlib.crc32(name.encode()) % folders:05d}"


def write_text_files(df: DataFrame, path: str, folders: int, stem: str = "stem") -> None:
    """A file for each row of df (stem, name, text), under ``path``/part-…, the part being that of the stem's checksum.

    Tasks write; one folder is the work of one task. Readers see all of a folder or nothing, and a write that fails leaves nothing. A
    folder that is there already is an error before anything is written.
    """
    spark = df.sparkSession
    spark.dataSource.register(TextFiles)
    p, store = hadoop(spark, make_folder(spark, path))
    if any(x.getPath().getName().startswith(("part-", "_SUCCESS")) for x in store.listStatus(p)):
        raise FileExistsError(f"{path} has files of an earlier write")
    part = F.pmod(F.crc32(F.encode(stem, "utf-8")), F.lit(folders))
    rows = df.select(F.concat(F.lit("part-"), F.lpad(part.cast("string"), 5, "0")).alias("folder"), "name", "text")
    rows.repartition(folders, "folder").write.format("curatrix_files").mode("append").option("path", path).save()
