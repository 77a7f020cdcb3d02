"""Answers that were paid for: an append-only ledger by request, from which a run that is started again takes what it has.

Tasks add small files to the ledger as answers come, long before their job ends, so a driver, an executor or a task that is lost takes
with it the calls in flight and the few that were not yet written. Nothing in a ledger is ever replaced or removed.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from datetime import UTC, datetime
from functools import partial

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.files import add_table, make_folder, opened
from .external import Generator, few

LEDGER = "digest string, response string, call_seconds double, start_time timestamp, written_at timestamp, started string"
_TIME = pa.timestamp("us", "UTC")
_SCHEMA = pa.schema(
    [("digest", pa.string()), ("response", pa.string()), ("call_seconds", pa.float64())]
    + [("start_time", _TIME), ("written_at", _TIME), ("started", pa.string())]
)
FLUSH_ROWS, FLUSH_SECONDS = 500, 30.0  # answers of a file, and the time that the first of them waits for it


def digest(model: str | None = None, effort: str | None = None) -> Column:
    """What a request asks for: its id, both prompts, the model and the effort."""
    return F.sha2(F.to_json(F.struct("custom_id", "system_prompt", "user_prompt", F.lit(model).alias("model"), F.lit(effort).alias("effort")), {"ignoreNullFields": "false"}), 256)


def entries(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a ledger, which has none if it isn't there."""
    return spark.read.schema(LEDGER).option("recursiveFileLookup", "true").parquet(make_folder(spark, path))


def answers(spark: SparkSession, path: str) -> DataFrame:
    """(digest, response, call_seconds, start_time): the first that was written for each request."""
    first = F.min_by(F.struct("response", "call_seconds", "start_time"), F.struct("written_at", "started", "response"))
    return entries(spark, path).groupBy("digest").agg(first.alias("_a")).select("digest", "_a.*")


class SlowDown(Exception):
    """What a generator raises when the service asks for a pause of so many seconds: all calls of the task wait, and this one is made again."""

    def __init__(self, seconds: float):
        super().__init__(seconds)
        self.seconds = seconds


class _Pace:
    """Lets calls begin at most ``rate`` times a second, and none before a pause is over."""

    def __init__(self, rate: float | None = None, sleep: Callable[[float], None] = time.sleep):
        self.every, self.next, self.sleep, self.lock = 1 / rate if rate else 0.0, 0.0, sleep, threading.Lock()

    def __call__(self) -> None:
        with self.lock:
            now = time.monotonic()
            wait = self.next - now
            self.next = max(now, self.next) + self.every if self.every else self.next
        if wait > 0:
            self.sleep(wait)

    def pause(self, seconds: float) -> None:
        with self.lock:
            self.next = max(self.next, time.monotonic() + seconds)


def in_order(rows: Iterator, call: Callable, window: int, pace: Callable[[], None] = lambda: None) -> Iterator[tuple]:
    """(row, call(row)) for each row, in order, with up to ``window`` calls under way. When one raises, those after it that are under way
    are still given before the error is raised: their answers are paid for."""

    def outcome(f) -> tuple[object, BaseException | None]:
        try:
            return f.result(), None
        except Exception as e:
            return None, e

    with ThreadPoolExecutor(window) as pool:
        waiting, failed = deque(), None
        rows = iter(rows)
        more = True
        while waiting or more:
            while more and failed is None and len(waiting) < window:
                r = next(rows, None)
                if r is None:
                    more = False
                    break
                pace()
                waiting.append((r, pool.submit(call, r)))
            if not waiting:
                break
            r, f = waiting.popleft()
            got, error = outcome(f)
            if error is None:
                yield r, got
            else:
                failed, more = failed or error, False
        if failed is not None:
            raise failed


PAUSES = 20  # that one call may be asked for


def _asked(row: tuple, call: Callable[..., str | None], pace: _Pace) -> tuple:
    for k in range(PAUSES + 1):
        began, t = datetime.now(UTC), time.monotonic()
        try:
            return call(*row[1:]), round(time.monotonic() - t, 2), began
        except SlowDown as e:
            if k == PAUSES:
                raise
            pace.pause(e.seconds)
            pace()
    raise AssertionError


def _known(folder: str) -> set[str]:
    """Requests that the files of a folder hold."""
    store, at = opened(folder)
    found = store.get_file_info(pafs.FileSelector(at, allow_not_found=True))
    files = [x.path for x in found if x.base_name.endswith(".parquet")]
    return {d for f in files for d in pq.read_table(store.open_input_file(f), columns=["digest"]).column(0).to_pylist()}


def _ask(batches: Iterator[pa.RecordBatch], call: Callable[..., str | None], folder: str, started: str, window: int, rate: float | None, flush: int) -> Iterator[pa.RecordBatch]:
    """Call with each row's columns after the first, which is its digest."""
    own = f"{folder}/{started}/{TaskContext.get().partitionId():06d}"  # of all attempts at this task
    known, (store, at) = _known(own), opened(own)
    store.create_dir(at, recursive=True)
    held, since, n = [], time.monotonic(), 0

    def write() -> None:
        if held:
            now = datetime.now(UTC)
            add_table(own, pa.Table.from_pylist([dict(zip(_SCHEMA.names, (*x, now, started), strict=True)) for x in held], _SCHEMA), "answers")
            held.clear()

    def rows() -> Iterator[tuple]:
        for b in few(batches):
            for r in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if r[0] not in known:
                    yield r

    try:
        pace = _Pace(rate)
        for r, (text, took, began) in in_order(rows(), partial(_asked, call=call, pace=pace), window, pace):
            n += 1
            if text is not None:  # a call without an answer is made again when the run is
                since = since if held else time.monotonic()
                held.append((r[0], text, took, began))
            if len(held) >= flush or held and time.monotonic() - since >= FLUSH_SECONDS:
                write()
    finally:
        write()
    yield pa.RecordBatch.from_arrays([pa.array([n])], ["calls"])


def fill(todo: DataFrame, call: Callable[..., str | None], path: str, window: int = 1, rate: float | None = None, flush: int = FLUSH_ROWS) -> None:
    """Call with the columns of todo (digest, what is called with ...) for each row that the ledger lacks, and add what comes back."""
    spark = todo.sparkSession
    key = todo.columns[0]
    have = answers(spark, path).select(F.col("digest").alias("_have"))
    todo = todo.join(have, todo[key] == have["_have"], "left_anti")
    share = rate / spark.sparkContext.defaultParallelism if rate else None
    job = partial(_ask, call=call, folder=path, started=uuid.uuid4().hex, window=window, rate=share, flush=flush)
    todo.mapInArrow(job, "calls long").write.format("noop").mode("overwrite").save()


def ask(reqs: DataFrame, call: Generator, path: str, model: str | None = None, effort: str | None = None, window: int = 1, rate: float | None = None, flush: int = FLUSH_ROWS) -> DataFrame:
    """reqs (custom_id, system_prompt, user_prompt, ...) with response, call_seconds and start_time, from the ledger at ``path`` once all
    requests that it lacks were asked for.

    Each request that has no answer in the ledger is one call, unless its task dies between the call and the next file; a task that is
    run again reads what its earlier attempts have written first. Where two attempts answer the same request, the first one written
    counts. Calls that gave None have nulls. ``window`` calls are under way in a task; all tasks together begin at most ``rate`` a
    second: each of the cluster's slots has an equal share. A generator that raises SlowDown holds up its task's calls. reqs is evaluated twice and should be a written table.
    """
    d = reqs.drop("response", "call_seconds", "start_time").withColumn("_digest", digest(model, effort))
    fill(d.select("_digest", "system_prompt", "user_prompt"), call, path, window, rate, flush)
    have = answers(reqs.sparkSession, path)
    return d.join(have, d["_digest"] == have.digest, "left").drop("_digest", "digest")
