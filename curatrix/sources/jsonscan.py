"""One JSON document of many records, cut by the tasks that read it.

The engine reads the document as lines that end at ``}``, which it can do from any byte on. Whether a bracket counts depends on all
that comes before it: on whether a string is open, and on how many brackets are. A range of bytes is therefore summed up for
either start (outside a string, inside one): the state at its end, how the depth changes, and at which relative depths its
objects end. Such summaries compose, so the states at the starts of all ranges follow from one small row for each. With them
each task cuts its own records and knows their places; only what crosses a range's border meets others.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import new_path

_OPEN, _CLOSE = np.zeros(256, bool), np.zeros(256, bool)
_OPEN[[*b"{["]] = True
_CLOSE[[*b"}]"]] = True
BATCH_BYTES = 4 << 20


def _marks(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(strings that are open after each byte, mod 2, if none was before; +1, -1 or 0 for each byte that is a bracket)."""
    back = buf == 0x5C
    at = np.flatnonzero(back)
    escaped = np.zeros(len(buf) + 1, bool)
    if len(at):
        first = np.concatenate([[True], np.diff(at) != 1])  # of a run of backslashes; every second one of it escapes what follows
        start = at[first][np.cumsum(first) - 1]
        escaped[at[(at - start) % 2 == 0] + 1] = True
    quote = (buf == 0x22) & ~escaped[:-1]
    return np.cumsum(quote) & 1, _OPEN[buf].astype(np.int8) - _CLOSE[buf].astype(np.int8)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], np.ndarray, np.ndarray, int]]:
    """((file, start of the range), bytes of some of its lines with their ends, offsets of these, size of the file), in order."""
    for b in batches:
        text = b.column(0).cast(pa.large_binary())
        files, starts, sizes = b.column(1).to_pylist(), np.asarray(b.column(2)), b.column(3).to_pylist()
        n = b.num_rows
        change = [0, *(k for k in range(1, n) if starts[k] != starts[k - 1] or files[k] != files[k - 1]), n]
        for lo, hi in zip(change, change[1:], strict=False):
            off = np.frombuffer(text.buffers()[1], np.int64)[text.offset + lo : text.offset + hi + 1]
            while lo < hi:  # some lines at once
                take = max(1, int(np.searchsorted(off, off[0] + BATCH_BYTES, side="right")) - 1)
                own, off = off[: take + 1], off[take:]
                size = np.diff(own)
                end = np.cumsum(size + 1)
                buf = np.full(int(end[-1]), 0x7D, np.uint8)
                inside = np.ones(len(buf), bool)
                inside[end - 1] = False
                if own[-1] > own[0]:
                    buf[inside] = np.frombuffer(text.buffers()[2], np.uint8)[own[0] : own[-1]]
                yield (files[lo], int(starts[lo])), buf, end, sizes[lo]
                lo += take


_SUMMARY = (
    "file string, start long, size long, bytes long, rows long, turns int, first string, depth array<long>, "
    "ends array<array<struct<depth: long, n: long>>>, last array<long>"
)
_LONGS = pa.list_(pa.int64())
_SUMMED = pa.schema(
    [("file", pa.string()), *((c, pa.int64()) for c in ("start", "size", "bytes", "rows")), ("turns", pa.int32()), ("first", pa.string()), ("depth", _LONGS)]
    + [("ends", pa.list_(pa.list_(pa.struct([("depth", pa.int64()), ("n", pa.int64())])))), ("last", _LONGS)]
)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: dict | None = None

    def row(x: dict) -> dict:
        return x | {"ends": [[{"depth": d, "n": n} for d, n in sorted(c.items())] for c in x["ends"]]}

    done = []
    for key, buf, end, size in _blocks(batches):
        if now is None or (now["file"], now["start"]) != key:
            if now:
                done.append(row(now))
            now = {"file": key[0], "start": key[1], "size": size, "bytes": 0, "rows": 0, "turns": 0, "first": "", "depth": [0, 0], "ends": [Counter(), Counter()], "last": [None, None]}
        inside, step = _marks(buf)
        if not now["first"]:
            solid = buf[(buf > 0x20) & (buf < 0x80)]
            now["first"] = chr(solid[0]) if len(solid) else ""
        for s in (0, 1):  # the range begins outside a string, or inside one
            out = (inside ^ now["turns"] ^ s) == 0
            depth = now["depth"][s] + np.cumsum(np.where(out, step, 0), dtype=np.int64)
            at = end[out[end - 1]] - 1
            values, n = np.unique(depth[at], return_counts=True)
            now["ends"][s].update(dict(zip(values.tolist(), n.tolist(), strict=True)))
            now["last"][s] = int(depth[-1]) if out[-1] else None
            now["depth"][s] = int(depth[-1])
        now["turns"] ^= int(inside[-1])
        now["bytes"] += len(buf)
        now["rows"] += len(end)
    if now:
        done.append(row(now))
    if done:
        yield pa.RecordBatch.from_pylist(done, _SUMMED)


@dataclass
class _Start:
    """What a range begins with: its document, the depth between records, open string, depth, records before it; its rows, whether the last has
    no end, and the document's records."""

    doc: int
    base: int
    turned: int
    depth: int
    records: int
    rows: int
    bare: bool
    total: int = 0


def _starts(summaries: list, parts: bool) -> dict[tuple[str, int], _Start]:
    """The state at each range's start, by composing the summaries in order."""
    out, counts, totals = {}, [], Counter()
    for r in summaries:
        totals[r.file] += r.bytes
    lasts = {r.file: (r.file, r.start) for r in summaries}
    file, state = None, None
    for r in summaries:
        if r.file != file and not (parts and state):
            _closed(state, file)
            state = {"base": None, "turned": 0, "depth": 0}
            counts.append(0)
        file = r.file
        if state["base"] is None and r.first:
            if r.first not in "[{":
                raise ValueError(f"{file} is no JSON array or object")
            state["base"] = int(r.first == "[")
        more = totals[file] - r.size  # one byte for an end that isn't there, less three for a mark at the start, which the engine leaves out
        if more not in (0, 1, -3, -2):
            raise ValueError(f"{file} has changed while it was read")
        bare = lasts[file] == (file, r.start) and more in (1, -2)
        s = state["turned"]
        out[file, r.start] = _Start(len(counts) - 1, state["base"] or 0, s, state["depth"], counts[-1], r.rows, bare)
        ends = {e.depth: e.n for e in r.ends[s]}
        state["turned"] ^= r.turns
        depth = r.depth[s]
        if bare and r.last[s] is not None:  # the end of its last row is not there
            ends[r.last[s]] -= 1
            depth += 1
        counts[-1] += ends.get((state["base"] or 0) - state["depth"], 0)
        state["depth"] += depth
    _closed(state, file)
    for x in out.values():
        x.total = counts[x.doc]
    return out


def _closed(state: dict | None, file: str | None) -> None:
    if state and (state["turned"] or state["depth"] or state["base"] is None):
        raise ValueError(f"{file} is not a whole JSON document")


_WHOLE, _PIECE, _END = 0, 1, 2
_RECORDS = "doc int, base int, record long, part long, text string, kind int"


def _cut(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    """Records; pieces of those that cross a border: a range's text up to its first end, and after its last; and what follows the last record."""
    starts: dict[tuple[str, int], _Start] = sent.value
    order = {k: i for i, k in enumerate(sorted(starts))}
    names, kinds = ("doc", "base", "record", "part", "text", "kind"), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32())
    now, key, rest, rows, first = None, None, b"", 0, True

    def batch(found: list) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def tail() -> list:
        if now.rows != rows:
            raise ValueError(f"{key[0]} is read in other ranges than before")
        return [(now.doc, now.base, record, order[key], rest.decode(), _END if record == now.total else _PIECE)] if rest else []

    for k, buf, end, _ in _blocks(batches):
        if k != key:
            if now:
                yield batch(tail())
            if k not in starts:
                raise ValueError(f"{k[0]} is read in other ranges than before")
            now, key, rest, rows, first = starts[k], k, b"", 0, True
            turned, depth, record = now.turned, now.depth, now.records
        rows += len(end)
        ends = end - 1
        if now.bare and rows == now.rows:
            buf, ends = buf[:-1], ends[:-1]
        inside, step = _marks(buf)
        out = (inside ^ turned) == 0
        depths = depth + np.cumsum(np.where(out, step, 0), dtype=np.int64)
        raw, found, at = buf.tobytes(), [], 0
        for e in (ends[out[ends] & (depths[ends] == now.base)] + 1).tolist():
            crosses = first and (now.depth or now.turned)
            found.append((now.doc, now.base, record, order[key], (rest + raw[at:e]).decode(), _PIECE if crosses else _WHOLE))
            rest, at, record, first = b"", e, record + 1, False
        rest += raw[at:]
        if len(buf):
            turned, depth = turned ^ int(inside[-1]), int(depths[-1])
        yield batch(found)
    if now:
        yield batch(tail())


_BLANK = " \t\r\n\ufeff"


def json_records(spark: SparkSession, path: str, parts: bool = False) -> DataFrame:
    """(doc int, pos long, record string): the objects of JSON arrays, or single objects, pos counting from 1 in each document's order.

    Each file is a document; with ``parts`` all files are one, in the order of their names, as write_json_document() makes them. Tasks
    read ranges of bytes, as many as the engine makes (spark.sql.files.maxPartitionBytes); a row for each range goes through the
    driver, no text does. A document that is cut short, or is neither an array of objects nor an object, raises ValueError, or
    fails the job where only tasks can see it. The encoding is UTF-8, with or without a mark at its start. An empty array has
    no records, an empty file is passed over. No row or group holds more than a record.
    """
    lines = spark.read.option("lineSep", "}").text(path)
    lines = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("_metadata.file_size").alias("size"))
    rows = lines.mapInArrow(_summed, _SUMMARY).collect()  # one for each range
    sent = spark.sparkContext.broadcast(_starts(sorted(rows, key=lambda r: (r.file, r.start)), parts))
    at = new_path(spark, "records")
    lines.mapInArrow(partial(_cut, sent=sent), _RECORDS).write.option("compression", "zstd").partitionBy("kind").parquet(at)
    found = spark.read.schema(_RECORDS).parquet(at)
    pieces = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda x: x["text"]), "")
    joined = lambda kind: found.where(F.col("kind") == kind).groupBy("doc", "base", "record").agg(pieces.alias("text"))
    wrong = joined(_END).select("doc", F.regexp_replace("text", f"[{_BLANK}]", "").alias("text"), "base", "record")
    wrong = wrong.where(F.col("text") != F.when(F.col("base") == 0, "").when(F.col("record") == 0, "[]").otherwise("]")).limit(1).collect()
    if wrong:
        raise ValueError(f"{path} is no array of objects: {wrong[0].text[:200]!r}")
    both = found.where(F.col("kind") == _WHOLE).select("doc", "base", "record", "text").unionByName(joined(_PIECE))
    text = F.ltrim("text", F.lit(_BLANK))
    mark = F.when(F.col("base") == 0, F.lit("")).when(F.col("record") == 0, F.lit("[")).otherwise(F.lit(","))
    inner = F.ltrim(F.substr(text, F.length(mark) + 1), F.lit(_BLANK))
    sound = F.startswith(text, mark) & F.startswith(inner, F.lit("{"))
    record = F.when(sound, inner).otherwise(F.raise_error(F.concat(F.lit("no array of objects: "), F.substring("text", 1, 200))))
    return both.select("doc", (F.col("record") + 1).alias("pos"), record.alias("record"))
