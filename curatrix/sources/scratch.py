"""Folders for what is written on the way, in the folder that the whole cluster shares (``spark.checkpoint.dir``)."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession

_own: str | None = None
_made: list[tuple[SparkSession, str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``. Only where it is unset (one-machine tests) a temporary folder takes its place."""
    global _own
    if said := spark.conf.get("spark.checkpoint.dir", None):
        return said.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _own is None:
        _own = f"file://{tempfile.mkdtemp(prefix='curatrix-')}"
    return _own


def new_path(spark: SparkSession, name: str) -> str:
    """A folder of its own, deleted when the program ends, or by drop()."""
    path = f"{shared_dir(spark)}/curatrix-{name}-{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


def made() -> list[str]:
    """The folders that new_path() gave and that are not dropped, in their order."""
    return [path for _, path in _made]


def drop(paths: list[str]) -> None:
    gone = set(paths)
    for spark, path in [x for x in _made if x[1] in gone]:
        _made.remove((spark, path))
        with contextlib.suppress(Exception):  # the session may be gone by then
            p = spark._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


atexit.register(lambda: drop(made()))
