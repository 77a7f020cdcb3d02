"""Reversible line deduplication: sharded cuckoo filters in front of exact reference-count tables.

A line's key is the line with white space stripped at both ends and A-Z lower-cased; it is stored as a 128-bit digest, and its
shard follows from the digest. A reference table holds a row (shard, key, doc_id, refs) for each document with the key, so
that deleting a document takes away exactly what inserting it gave, and the count and the largest holder of a key are known
again afterwards. Every shard has a cuckoo filter (Fan et al., 2014) of the keys that are repeated, 16-bit fingerprints in
buckets of four. A line that its shard's filter does not know is surely not repeated and stops there; a line that it may
know goes on to the exact table, so false positives of the filter never reach a result.

``LineIndex`` keeps both in the shared folder and changes, for a batch, only the shards that hold one of its keys: their
references are written anew, and keys that become repeated, or cease to be, are inserted into or deleted from the stored filter.
``line_dedup`` does the same for a whole table at once; there only keys that some rows repeat get references.

Lines meet small filters by broadcast, and filters of any size by shard: filter and lines are dealt out by (shard, salt), and
a shard gets as many salts, each with the filter, as its repeated lines need.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from . import textvec as tv
from .storage import new_path, table

MIN_CHARS, MIN_DOCS = 20, 3
SHARD_KEYS = 200_000  # repeated keys of a shard, about
FILTERS_MOST = 64 << 20  # bytes of filters that may be broadcast; beyond it, lines and filters meet by shard
PROBE_ROWS = 2_000_000  # repeated lines of a shard for each salt
GENERATIONS = 32  # of an index, beyond which it is written anew as one
_U = np.uint64
_LINES = "key binary, doc_id long"
_REFS = "shard int, key binary, doc_id long, refs long"
_FILTERS = "shard int, n_keys long, filter binary"


class CuckooFilter:
    """Set of 64-bit hashes with deletion: no false negatives, about 8 / 2**16 false positives. ``insert`` grows when full."""

    SLOTS, KICKS = 4, 500

    def __init__(self, expected: int):
        self.buckets = 1 << max(1, int(np.ceil(np.log2(max(1, expected) / (self.SLOTS * 0.85)))))
        self.table = np.zeros((self.buckets, self.SLOTS), np.uint16)
        self._pick = np.random.Generator(np.random.PCG64(7))

    def _places(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f = (h >> _U(48)).astype(np.uint16)
        f[f == 0] = 1
        one = (h & _U(self.buckets - 1)).astype(np.int64)
        return f, one, self._other(one, f)

    def _other(self, at: np.ndarray, f: np.ndarray) -> np.ndarray:
        return at ^ (tv.mix(f.astype(np.uint64)) & _U(self.buckets - 1)).astype(np.int64)

    def contains(self, h: np.ndarray) -> np.ndarray:
        f, one, two = self._places(h)
        return (self.table[one] == f[:, None]).any(1) | (self.table[two] == f[:, None]).any(1)

    def insert(self, h: np.ndarray) -> bool:
        """Insert each hash once (give no hash twice); False if it has no room, the table being as it was."""
        before = self.table.copy()
        f, one, two = self._places(h)
        left = np.arange(len(h))
        for places in (one, two):  # most find an empty slot in one of their buckets: all at once, one entry for a slot
            for s in range(self.SLOTS):
                free = left[self.table[places[left], s] == 0]
                _, first = np.unique(places[free], return_index=True)
                put = free[first]
                self.table[places[put], s] = f[put]
                left = np.setdiff1d(left, put, assume_unique=True)
        for i in left:
            at, x = int(one[i]), f[i]
            for _ in range(self.KICKS):
                empty = np.flatnonzero(self.table[at] == 0)
                if len(empty):
                    self.table[at, empty[0]] = x
                    break
                s = int(self._pick.integers(self.SLOTS))
                self.table[at, s], x = x, self.table[at, s]
                at = int(self._other(np.asarray([at]), np.asarray([x], np.uint16))[0])
            else:
                self.table = before
                return False
        return True

    def delete(self, h: np.ndarray) -> None:
        """Delete hashes that were inserted."""
        f, one, two = self._places(h)
        for x, *places in zip(f, one, two, strict=True):
            for at in places:
                hit = np.flatnonzero(self.table[at] == x)
                if len(hit):
                    self.table[at, hit[0]] = 0
                    break

    @classmethod
    def of(cls, h: np.ndarray) -> CuckooFilter:
        room = len(h)
        while not (made := cls(room)).insert(h):
            room = max(2, 2 * room)
        return made

    def tobytes(self) -> bytes:
        return self.table.tobytes()

    @classmethod
    def frombytes(cls, raw: bytes) -> CuckooFilter:
        made = cls(1)
        made.table = np.frombuffer(raw, np.uint16).reshape(-1, cls.SLOTS).copy()
        made.buckets = len(made.table)
        return made


def line_keys(text: bytes, least: int = MIN_CHARS) -> list[bytes | None]:
    """The 128-bit key of each \\n-split line, None where the key is shorter than ``least`` code points."""
    out: list[bytes | None] = []
    for line in text.split(b"\n"):
        key = line.strip().lower()  # of bytes: ASCII white space and A-Z only
        long = len(key) >= least and (len(key) >= 4 * least or len(key.decode("utf-8", "replace")) >= least)
        out.append(xxhash.xxh3_128_digest(key) if long else None)
    return out


def _raw(texts: pa.Array) -> list[bytes]:
    return [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]


def _hash64(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8")[1::2].astype(np.uint64)


def _shard64(keys: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(keys), ">u8")[0::2].astype(np.uint64)


def _known(f: CuckooFilter, keys: list[bytes]) -> np.ndarray:
    return f.contains(_hash64(keys))


def _keys_of(batches: Iterator[pa.RecordBatch], least: int, shards: int = 1, filters=None) -> Iterator[pa.RecordBatch]:
    """(key, doc_id) for each distinct long key of each row with a doc_id; with filters, only of keys that these may know."""
    known = {s: CuckooFilter.frombytes(x) for s, x in filters.value.items()} if filters is not None else None
    for b in tv.sub_batches(batches):
        keys, rows = [], []
        for i, (doc, text) in enumerate(zip(b.column(0).to_pylist(), _raw(b.column(1)), strict=True)):
            if doc is not None:
                own = {k for k in line_keys(text, least) if k}
                keys += own
                rows += [i] * len(own)
        rows = np.asarray(rows, np.int64)
        if known is not None and keys:
            shard, hit = (_shard64(keys) % _U(shards)).astype(np.int64), np.zeros(len(keys), bool)
            for s in np.unique(shard):
                if int(s) in known:
                    here = np.flatnonzero(shard == s)
                    hit[here] = _known(known[int(s)], [keys[i] for i in here])
            at = np.flatnonzero(hit)
            keys, rows = [keys[i] for i in at], rows[at]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column(0).take(pa.array(rows, pa.int64()))], ["key", "doc_id"])


def _lines(docs: DataFrame, least: int, shards: int = 1, filters=None) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(partial(_keys_of, least=least, shards=shards, filters=filters), _LINES)


def _shard(key: str | F.Column, shards: int) -> F.Column:
    """The shard of a key, as _keys_of() computes it: its first 8 bytes, unsigned, modulo the number of shards."""
    return (F.conv(F.substring(F.hex(key), 1, 16), 16, 10).cast("decimal(20,0)") % shards).cast("int")


def _make_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The filter of each shard from rows (shard, kind, filter, key, sign) sorted by (shard, kind): the filter as it was (kind 0), if
    there is one, and then keys to insert (sign 1) or delete (-1). A filter that is full is given as null."""
    from .neardup import _groups

    for g in _groups(batches, ["shard"]):
        rows = g.to_pylist()
        old = next((CuckooFilter.frombytes(r["filter"]) for r in rows if r["kind"] == 0), None)
        gone, new = ([r["key"] for r in rows if r["sign"] == sign] for sign in (-1, 1))
        if old is None:
            old = CuckooFilter.of(np.unique(_hash64(new)))
        else:
            if gone:
                old.delete(_hash64(gone))
            if new and not old.insert(_hash64(new)):
                old = None
        yield pa.RecordBatch.from_pydict({"shard": pa.array([rows[0]["shard"]], pa.int32()), "n_keys": pa.array([len(new) - len(gone)], pa.int64()), "filter": pa.array([old and old.tobytes()], pa.binary())})


def _filters(keys: DataFrame, shards: int, old: DataFrame | None = None) -> DataFrame:
    """Filters (shard, n_keys: the change of, filter) of keys (shard, key, sign), starting from old ones if they are given."""
    rows = keys.select("shard", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("filter"), "key", F.col("sign").cast("int").alias("sign"))
    if old is not None:
        rows = rows.unionByName(old.select("shard", F.lit(0).alias("kind"), "filter", F.lit(None).cast("binary").alias("key"), F.lit(0).alias("sign")))
    rows = rows.repartition(min(shards, 10_000), "shard").sortWithinPartitions("shard", "kind")
    return table(rows.mapInArrow(_make_filters, _FILTERS), "filters")


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines that their shard's filter may know, from rows (shard, salt, kind, filter, key, doc_id) in which a filter comes before its lines."""
    shard, known = None, None
    for b in batches:
        if not b.num_rows:
            continue
        own, kind = b.column(0).to_numpy(), b.column(2).to_numpy()
        cut = np.flatnonzero((np.diff(own) != 0) | (np.diff(kind) != 0)) + 1
        for lo, hi in zip([0, *cut], [*cut, len(own)], strict=True):
            if own[lo] != shard:
                shard, known = own[lo], None
            if kind[lo] == 0:
                known = CuckooFilter.frombytes(b.column(3)[int(lo)].as_py())
            elif known is not None:
                part = b.slice(lo, hi - lo)
                hit = pa.array(_known(known, part.column(4).to_pylist()))
                yield pa.RecordBatch.from_arrays([part.column(4).filter(hit), part.column(5).filter(hit)], ["key", "doc_id"])


def _passing(docs: DataFrame, least: int, filters: DataFrame, shards: int, rows: DataFrame) -> DataFrame:
    """(key, doc_id): the lines of docs that the filters may know. rows: (shard, rows), how many repeated lines a shard has."""
    spark = docs.sparkSession
    if (filters.agg(F.sum(F.length("filter").cast("long"))).first()[0] or 0) <= FILTERS_MOST:
        return _lines(docs, least, shards, spark.sparkContext.broadcast({r.shard: bytes(r.filter) for r in filters.collect()}))
    salts = rows.select("shard", F.ceil(F.col("rows") / PROBE_ROWS).cast("int").alias("salts")).where("salts > 1")  # few: at most rows / PROBE_ROWS
    n = F.coalesce("salts", F.lit(1))
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    own = filters.join(salts, "shard", "left").select("shard", F.explode(F.sequence(F.lit(0), n - 1)).alias("salt"), F.lit(0).alias("kind"), "filter", none("binary", "key"), none("long", "doc_id"))
    lines = _lines(docs, least).withColumn("shard", _shard("key", shards)).join(salts, "shard", "left")
    lines = lines.select("shard", F.pmod(F.xxhash64("doc_id"), n).cast("int").alias("salt"), F.lit(1).alias("kind"), none("binary", "filter"), "key", "doc_id")
    n_tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return own.unionByName(lines).repartition(n_tasks, "shard", "salt").sortWithinPartitions("shard", "salt", "kind").mapInArrow(_probe, _LINES)


def _cut(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """(row, n_lines, n_dropped, kept_sha256, kept_text) from (row, text, keys to drop)."""
    for b in tv.sub_batches(batches):
        n_lines, n_dropped, kept = [], [], []
        for text, drop in zip(_raw(b.column(1)), b.column(2).to_pylist(), strict=True):
            if not drop:
                n_lines.append(text.count(b"\n") + 1)
                n_dropped.append(0)
                kept.append(text)
                continue
            drop, lines = set(drop), text.split(b"\n")
            stay = [x for x, k in zip(lines, line_keys(text, least), strict=True) if k not in drop]
            n_lines.append(len(lines))
            n_dropped.append(len(lines) - len(stay))
            kept.append(b"\n".join(stay))
        made = [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in kept]), pa.array(kept, pa.binary()).cast(pa.string())]
        yield pa.RecordBatch.from_arrays([b.column(0), *made], ["row", "n_lines", "n_dropped", "kept_sha256", "kept_text"])


def _without(docs: DataFrame, refs: DataFrame, hot: DataFrame, least: int) -> DataFrame:
    """docs without the lines of hot keys (key, last_doc) that refs (key, doc_id) say they hold, but for those of last_doc."""
    new = ("n_lines", "n_dropped", "kept_sha256", "kept_text")
    own = [c for c in docs.columns if c.lower() not in new and c != "text"]
    hot = table(hot.select("key", "last_doc"), "hot")  # else the join would stand on the partitions of the count, and a hot key's could not be split
    lose = refs.join(hot, "key").where("doc_id <> last_doc")
    lose = lose.groupBy(F.col("doc_id").alias("_of")).agg(F.collect_set("key").alias("_drop"))
    row = F.struct(*(F.col(f"`{c}`").cast("long").alias(c) if c == "doc_id" else F.col(f"`{c}`") for c in own)).alias("_row")
    d = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.col("text").alias("_text"), row)
    d = d.join(lose, d._doc == lose._of, "left").select(F.col("_row").alias("row"), F.col("_text").alias("text"), F.col("_drop").alias("drop"))
    kind = StructType([d.schema["row"], *(StructField(k, LongType()) for k in new[:2]), *(StructField(k, StringType()) for k in new[2:])])
    return d.mapInArrow(partial(_cut, least=least), kind).select(*(F.col("row")[c].alias(c) for c in own), *new)


def line_dedup(docs: DataFrame, least: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """docs (doc_id long, text string, ...) with n_lines, n_dropped, kept_sha256 and kept_text in place of text.

    Lines whose key has at least ``least`` code points and is in at least ``min_docs`` documents go, but for those in the
    largest doc_id that holds it. A null or empty text is one empty line. Rows that share a doc_id are one document, of
    which every row loses the same keys; rows with a null doc_id are no document and lose nothing. Columns of docs with
    the name of a result column are replaced; others stay, whatever their names. An empty table gives an empty result.
    """
    keys = _lines(docs, least).groupBy("key").agg(F.count("*").alias("rows")).where(F.col("rows") >= min_docs)
    keys = table(keys, "maybe")
    shards = max(1, -(-keys.count() // SHARD_KEYS))
    keys = keys.withColumn("shard", _shard("key", shards))
    filters = _filters(keys.select("shard", "key", F.lit(1).alias("sign")), shards)
    lines = _passing(docs, least, filters, shards, keys.groupBy("shard").agg(F.sum("rows").alias("rows")))
    refs = table(lines.groupBy("key", "doc_id").agg(F.count("*").alias("refs")), "refs")
    return _without(docs, refs, _repeated(refs, min_docs), least)


def _repeated(refs: DataFrame, min_docs: int, *by: str) -> DataFrame:
    """(key, n_docs, last_doc) of the keys that min_docs documents or more hold; refs has a row for each key and document."""
    return refs.groupBy(*by, "key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_doc")).where(F.col("n_docs") >= min_docs)


class LineIndex:
    """The reference tables and filters of a set of documents. insert() and delete() give a new index; the old one stays valid.

    Each generation is a table of the shards that a batch changed; ``refs_of`` and ``filters_of`` say which generation a shard's
    rows are in. ``touched`` and ``refiltered`` are the shards that the last batch wrote. The number of shards is fixed when
    the index is made. Tables go to ``folder``, where save() leaves what load() needs; without one they go with the program.
    """

    def __init__(self, spark, shards: int = 64, least: int = MIN_CHARS, min_docs: int = MIN_DOCS, folder: str | None = None):
        self.spark, self.shards, self.least, self.min_docs, self.folder = spark, shards, least, min_docs, folder
        self.refs_of: dict[int, str] = {}
        self.filters_of: dict[int, str] = {}
        self.touched: list[int] = []
        self.refiltered: list[int] = []

    def _rows(self, where: dict[int, str], kind: str, shards: list[int] | None = None) -> DataFrame:
        """The rows of some shards (all if None); other shards' files are not read."""
        of: dict[str, list[int]] = {}
        for s in where if shards is None else shards:
            if s in where:
                of.setdefault(where[s], []).append(s)
        out = self.spark.createDataFrame([], kind)
        for path, own in of.items():
            out = out.unionByName(self.spark.read.schema(kind).parquet(path).where(F.col("shard").isin(own)))
        return out

    @property
    def refs(self) -> DataFrame:
        return self._rows(self.refs_of, _REFS)

    @property
    def filters(self) -> DataFrame:
        return self._rows(self.filters_of, _FILTERS)

    def _moved(self, docs: DataFrame, sign: int) -> LineIndex:
        lines = _lines(docs, self.least).select(_shard("key", self.shards).alias("shard"), "key", "doc_id", F.lit(sign).cast("long").alias("refs"))
        delta = table(lines.groupBy("shard", "key", "doc_id").agg(F.sum("refs").alias("refs")), "delta")
        new = self._empty()
        new.refs_of, new.filters_of = dict(self.refs_of), dict(self.filters_of)
        new.touched = sorted(r.shard for r in delta.select("shard").distinct().collect())  # as many as there are shards, at most
        if not new.touched:
            return new
        old = self._rows(self.refs_of, _REFS, new.touched)
        rows = old.unionByName(delta).groupBy("shard", "key", "doc_id").agg(F.sum("refs").alias("refs")).where("refs > 0")
        new._write(rows, new.refs_of, new.touched, "refs")
        now, moved = new._rows(new.refs_of, _REFS, new.touched), delta.select("key").distinct()
        was = _repeated(old.join(moved, "key", "left_semi"), self.min_docs, "shard").select("shard", "key", F.lit(-1).alias("sign"))
        is_now = _repeated(now.join(moved, "key", "left_semi"), self.min_docs, "shard").select("shard", "key", F.lit(1).alias("sign"))
        changed = table(was.unionByName(is_now).groupBy("shard", "key").agg(F.sum("sign").alias("sign")).where("sign <> 0"), "changed")
        new.refiltered = sorted(r.shard for r in changed.select("shard").distinct().collect())
        if new.refiltered:
            made = _filters(changed, self.shards, self._rows(self.filters_of, _FILTERS, new.refiltered))
            full = [r.shard for r in made.where("filter is null").select("shard").collect()]
            if full:  # these are made anew, larger
                keys = _repeated(new._rows(new.refs_of, _REFS, full), self.min_docs, "shard").select("shard", "key", F.lit(1).alias("sign"))
                made = made.where("filter is not null").unionByName(_filters(keys, self.shards))
            new._write(made, new.filters_of, new.refiltered, "filter-shards")
        return new.compact() if len({*new.refs_of.values()}) > GENERATIONS else new

    def _empty(self) -> LineIndex:
        return LineIndex(self.spark, self.shards, self.least, self.min_docs, self.folder)

    def compact(self) -> LineIndex:
        """The same index in one generation."""
        new = self._empty()
        new.touched, new.refiltered = self.touched, self.refiltered
        new._write(self.refs, new.refs_of, list(self.refs_of), "refs")
        new._write(self.filters, new.filters_of, list(self.filters_of), "filter-shards")
        return new

    def save(self) -> None:
        """Write down, in the folder, which tables make up the index."""
        state = {"shards": self.shards, "least": self.least, "min_docs": self.min_docs, "refs_of": self.refs_of, "filters_of": self.filters_of}
        self.spark.createDataFrame([(json.dumps(state),)], "value string").coalesce(1).write.mode("overwrite").text(f"{self.folder}/index")

    @classmethod
    def load(cls, spark, folder: str) -> LineIndex:
        state = json.loads(spark.read.text(f"{folder}/index").first().value)
        new = cls(spark, state["shards"], state["least"], state["min_docs"], folder)
        new.refs_of, new.filters_of = ({int(k): v for k, v in state[x].items()} for x in ("refs_of", "filters_of"))
        return new

    def _write(self, rows: DataFrame, where: dict[int, str], shards: list[int], name: str) -> None:
        path = f"{self.folder}/{name}-{uuid.uuid4().hex}" if self.folder else new_path(self.spark, name)
        rows.write.partitionBy("shard").parquet(path)
        where.update(dict.fromkeys(shards, path))

    def insert(self, docs: DataFrame) -> LineIndex:
        return self._moved(docs, 1)

    def delete(self, docs: DataFrame) -> LineIndex:
        """Take inserted documents out again: (doc_id, text) as they were inserted."""
        return self._moved(docs, -1)

    def apply(self, docs: DataFrame) -> DataFrame:
        """What line_dedup() gives for docs, by the keys of the index."""
        refs = self.refs
        per = refs.groupBy("shard").agg(F.count("*").alias("rows"))
        lines = _passing(docs, self.least, self.filters, self.shards, per).distinct()
        return _without(docs, lines, _repeated(refs, self.min_docs), self.least)


ORACLE_SQL = r"""
WITH l AS (SELECT doc_id, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM documents),
k AS (SELECT *, regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') AS raw FROM l),
n AS (SELECT doc_id, i, line, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM k),
h AS (SELECT key, max(doc_id) AS last_doc FROM n WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT n.*, h.key IS NOT NULL AND n.doc_id <> h.last_doc AS gone FROM n LEFT JOIN h ON n.key = h.key)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines, CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM j GROUP BY doc_id
"""
