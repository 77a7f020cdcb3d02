"""Near-duplicate documents by a signature-coordinate inverted join.

1. Every text becomes the set of its distinct word shingles and a MinHash signature. Equal sets form a class with one
   representative, so that exact copies of any number cost one row from here on.
2. Classes are posted under (coordinate, value) for the first K - T + 1 of their pairs, in an order in which very frequent
   pairs come last: two signatures that agree in at least T of K coordinates agree in one of those (prefix filter). Lists of
   one member go.
3. Within a list, collisions over all coordinates are counted by merging the members' own inverted lists: for a member, the
   T - 1 longest of its lists are left out of the merge, since a pair must meet in one of the others, and only whom these
   name is looked up in the long ones; members with too few shared lists are skipped. Pairs of T or more collisions are
   kept as a spanning forest, never as all pairs. The rows of a list beyond a size are dealt out and compared with a few
   leaders first; only those that don't hang together with most of it then meet in blocks.
4. The forests' components hold every possible link. Within each of them links are confirmed on the full sets, again
   with a pivot against all members not yet reached, again by leaders first beyond a size; the confirmed forests' components
   are the result.

With K = 64 and T = 36 a pair of similarity 0.85 agrees in 54.4 coordinates on average; fewer than 36 has a probability
of about 1e-8.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .graph import connected_components
from .storage import table

COORDINATES = 64
MATCHES = 36
LIST_BLOCK = 4096  # members of a list that are compared in one group
HOT_KEYS = 10_000  # a pair (coordinate, value) of more than 1 / HOT_KEYS of the classes comes last in the order of prefixes
LEADERS, LEADER, REACHED, REST = 8, 2, 0, 1
BATCH_BYTES = 512 << 10  # text whose shingles are hashed at once
SET_BLOCK = 2_000_000  # shingles of a candidate component that are compared in one group
_rng = np.random.Generator(np.random.PCG64(64))
_MUL = _rng.integers(1, 1 << 62, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def shingle_sets(texts: pa.Array, n: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text, lower-cased in A-Z; shorter texts have one shingle, empty ones none."""
    w = tv.Words(texts, lower=True)
    at, h = w.grams(n)
    off = np.searchsorted(at, w.off)
    out = []
    for d, count in enumerate(w.count):
        if count >= n:
            out.append(np.unique(h[off[d] : off[d + 1]]))
        elif count:
            out.append(np.asarray([tv.sequence_hash(w.hash[w.off[d] : w.off[d + 1]])], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of K 32-bit minima for each set; sets must not be empty."""
    sig = np.empty((len(sets), COORDINATES), np.uint32)
    if sets:
        x, off = np.concatenate(sets), np.cumsum([0, *(len(s) for s in sets[:-1])])
        for k in range(COORDINATES):
            sig[:, k] = np.minimum.reduceat((x * _MUL[k] + _ADD[k]) >> np.uint64(32), off)
    return sig


def _sketch(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in tv.sub_batches(batches, most=BATCH_BYTES):
        sets = shingle_sets(b.column(1), n)
        sizes = np.asarray([len(s) for s in sets], np.int64)
        full = np.flatnonzero(sizes)
        sig = signatures([sets[i] for i in full])
        keys, blobs = [None] * len(sets), [None] * len(sets)
        for i, row in zip(full, sig, strict=True):
            keys[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
            blobs[i] = row.tobytes()
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes), pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], ["doc_id", "n_shingles", "set_key", "sig"])


def _posting_keys(batches: Iterator[pa.RecordBatch], prefix: int, hot) -> Iterator[pa.RecordBatch]:
    """(key, rep): the first ``prefix`` (coordinate, value) pairs of each signature, those that are not hot before those that are."""
    salt = (np.arange(COORDINATES, dtype=np.uint64) + np.uint64(1)) << np.uint64(32)
    known = hot.value if hot is not None else np.zeros(0, np.uint64)
    for b in batches:
        if not b.num_rows:
            continue
        key = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint32).reshape(-1, COORDINATES).astype(np.uint64) | salt
        if len(known):
            late = known[np.minimum(np.searchsorted(known, key), len(known) - 1)] == key
            key = np.take_along_axis(key, np.argsort(late, axis=1, kind="stable"), 1)
        key = np.ascontiguousarray(key[:, :prefix]).reshape(-1)
        yield pa.RecordBatch.from_arrays([pa.array(tv.signed(key)), b.column(0).take(pa.array(np.repeat(np.arange(b.num_rows), prefix)))], ["key", "rep"])


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of the rows of one key each, from batches sorted by keys. Only one group is held at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy(zero_copy_only=False) for i in map(b.schema.get_field_index, keys)])
        cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1
        for lo, hi in zip([0, *cut], [*cut, b.num_rows], strict=True):
            this = tuple(k[:, lo])
            if held and this != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(b.slice(lo, hi - lo))
            last = this
    if held:
        yield pa.Table.from_batches(held)


def _forest(n: int, alike: Callable[[int, np.ndarray], np.ndarray], side: np.ndarray | None = None) -> Iterator[tuple[int, int]]:
    """Links among n members; alike(member, others) says which others it links.

    By side: leaders (LEADER) are compared with all others; members that hang together already (REACHED) with the rest, and a member
    of the rest only until one links it; and where there are neither, the rest gets a spanning forest.
    """
    rest = np.arange(n)
    if side is not None and (side == LEADER).any():
        for at in np.flatnonzero(side == LEADER):
            others = rest[rest != at]
            yield from ((int(at), int(x)) for x in others[alike(int(at), others)])
        return
    if side is not None and (side == REACHED).any():
        rest = np.flatnonzero(side == REST)
        for at in np.flatnonzero(side == REACHED):
            if not len(rest):
                break
            hit = alike(int(at), rest)
            yield from ((int(at), int(x)) for x in rest[hit])
            rest = rest[~hit]
        return
    while len(rest):
        todo, rest = [int(rest[0])], rest[1:]
        while todo and len(rest):
            at = todo.pop()
            hit = alike(at, rest)
            for x in rest[hit]:
                yield at, int(x)
                todo.append(int(x))
            rest = rest[~hit]


def _edges(found: list[tuple[int, int]]) -> pa.RecordBatch:
    e = np.asarray(found, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])


class _Lists:
    """The inverted lists of a group's signatures: for each coordinate, the members by value."""

    def __init__(self, sig: np.ndarray, matches: int):
        n, k = sig.shape
        self.sig, self.matches = sig, matches
        order = np.argsort(sig.T, axis=1, kind="stable")
        ranked = np.take_along_axis(sig.T, order, 1)
        new = np.ones((k, n), bool)
        new[:, 1:] = ranked[:, 1:] != ranked[:, :-1]
        self.members, self.start = order.reshape(-1), np.flatnonzero(new)
        self.size = np.diff(np.append(self.start, n * k))
        self.list_of = np.empty((k, n), np.int32)
        np.put_along_axis(self.list_of, order, (np.cumsum(new) - 1).astype(np.int32).reshape(k, n), 1)

    def alike(self, at: int, rest: np.ndarray) -> np.ndarray:
        """Which of rest collide with a member in ``matches`` coordinates or more.

        Lists of one member are skipped, and a member with too few others has no pair. The matches - 1 longest lists are not
        merged: a pair must meet in one of the others (prefix), whose members are counted; only those are looked up in the long ones.
        """
        lists = self.list_of[:, at]
        shared = np.flatnonzero(self.size[lists] > 1)
        if len(shared) < self.matches:
            return np.zeros(len(rest), bool)
        shared = shared[np.argsort(self.size[lists[shared]], kind="stable")]
        short, long = shared[: len(shared) - self.matches + 1], shared[len(shared) - self.matches + 1 :]
        start, size = self.start[lists[short]], self.size[lists[short]]
        merged = self.members[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        count = np.bincount(merged, minlength=self.sig.shape[0])[rest]
        hit = count > 0
        some = rest[hit]
        hit[hit] = count[hit] + (self.sig[some][:, long] == self.sig[at, long]).sum(1) >= self.matches
        return hit


def _complete(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows of whole keys, with the offsets of the keys, from batches sorted by keys: the last key of a batch waits for the next one."""
    held = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        k = np.stack([t.column(i).to_numpy() for i in keys])
        cut = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(0)) + 1
        held = t
        if len(cut):
            held = t.slice(int(cut[-1]))
            yield t.slice(0, int(cut[-1])), np.concatenate([[0], cut])
    if held is not None:
        yield held, np.asarray([0, held.num_rows])


def _list_links(batches: Iterator[pa.RecordBatch], matches: int) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    seen: set[tuple[int, int]] = set()  # the lists of a group of copies give the same links again and again
    for t, off in _complete(batches, ["key", "i", "j"]):
        rep, side = t.column("rep").to_numpy(), t.column("side").to_numpy()
        sig = tv.utf8(t.column("sig").combine_chunks())[0].view(np.uint32).reshape(-1, COORDINATES)
        size = np.diff(off)
        two = off[:-1][size == 2]  # most lists: their one pair is counted at once
        two = two[(sig[two] == sig[two + 1]).sum(1) >= matches]
        pairs = list(zip(rep[two].tolist(), rep[two + 1].tolist(), strict=True))
        for lo, hi in zip(off[:-1][size > 2].tolist(), off[1:][size > 2].tolist(), strict=True):
            ids, own = rep[lo:hi].tolist(), sig[lo:hi]
            if hi - lo <= 32:
                alike = lambda at, rest, own=own: (own[rest] == own[at]).sum(1) >= matches
            else:
                alike = _Lists(own, matches).alike
            pairs += [(ids[x], ids[y]) for x, y in _forest(hi - lo, alike, side[lo:hi])]
        for pair in pairs:
            if pair not in seen:
                seen.add(pair)
                found.append(pair)
        if len(found) > 50_000:
            yield _edges(found)
            found = []
            if len(seen) > 100_000:
                seen.clear()
    yield _edges(found)


def _common(own: np.ndarray, ident: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """How many members of each set (a stretch of ident, not empty) are flagged in own."""
    first = np.cumsum(size) - size
    return np.add.reduceat(own[ident[np.repeat(start - first, size) + np.arange(size.sum())]], first)


def _set_links(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    found: list[tuple[int, int]] = []
    for g in _groups(batches, ["cluster", "i", "j"]):
        ids = g.column("rep").to_numpy()
        raw, start = tv.utf8(g.column("shingles").combine_chunks())
        hashes, start = raw.view(np.uint64), start // 8
        size = np.diff(start)
        known = np.unique(hashes)
        ident = np.concatenate([np.searchsorted(known, hashes[i : i + 500_000]).astype(np.int32) for i in range(0, len(hashes), 500_000)])
        own = np.zeros(len(known), np.int32)
        del raw, hashes, known

        def alike(at: int, rest: np.ndarray, size=size, start=start, ident=ident, own=own) -> np.ndarray:
            near = (100 * np.minimum(size[rest], size[at]) >= percent * np.maximum(size[rest], size[at]))
            some = rest[near]
            if not len(some):
                return near
            mine = ident[start[at] : start[at + 1]]
            own[mine] = 1
            step = max(1, 500_000 // int(size[some].max()))  # sets whose members are looked up at once
            both = np.concatenate([_common(own, ident, start[some[i : i + step]], size[some[i : i + step]]) for i in range(0, len(some), step)])
            own[mine] = 0
            near[near] = 100 * both >= percent * (size[some] + size[at] - both)
            return near

        found += [(int(ids[x]), int(ids[y])) for x, y in _forest(len(ids), alike, g.column("side").to_numpy())]
        if len(found) > 50_000:
            yield _edges(found)
            found = []
    yield _edges(found)


def _linked(rows: DataFrame, weights: DataFrame, key: str, weight: F.Column, most: int, links) -> DataFrame:
    """(a, b): links among the rows (key, rep, ...) of each key, by links() in groups (key, i, j) of rows with a side.

    weights: (key, weight) of each key. A key of up to ``most`` is one group. The rows of a heavier one are first compared with
    LEADERS of them, dealt out by salt: in proportion to the rows. What then hangs together with most of the key needs no further
    look among itself; the others, usually few, are compared with it and with one another in blocks, every two rows
    meeting in one (i, j), so that only their number makes copies.
    """
    spark = rows.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = [key, "i", "j", "side", *(c for c in rows.columns if c != key)]
    run = lambda d: d.select(*order).repartition(n, key, "i", "j").sortWithinPartitions(key, "i", "j").mapInArrow(links, "a long, b long")
    one = lambda d: d.withColumns({"i": F.lit(0), "j": F.lit(0), "side": F.lit(REST)})
    heavy = table(weights.where(F.col("weight") > most).select(key, F.ceil(F.col("weight") / most).cast("int").alias("blocks")), "heavy")
    if heavy.isEmpty():
        return run(one(rows))
    own = table(rows.join(heavy, key), "heavy-rows")
    leaders = own.groupBy(key, F.pmod(F.xxhash64("rep", F.lit("leader")), F.lit(LEADERS)).alias("_k")).agg(F.min("rep").alias("rep")).drop("_k")
    block = lambda of: F.pmod(F.xxhash64("rep"), F.col(of)).cast("int")
    lead = own.join(leaders, [key, "rep"]).withColumn("i", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn("side", F.lit(LEADER))
    star = table(run(lead.unionByName(own.withColumn("i", block("blocks")).withColumn("side", F.lit(REST))).withColumn("j", F.lit(0))), "star")
    parts = table(own.select(key, "rep", weight.alias("_w")).join(connected_components(star).withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep")), "parts")
    largest = parts.groupBy(key, "component").agg(F.sum("_w").alias("_w")).groupBy(key).agg(F.max_by("component", F.struct("_w", "component")).alias("main"))
    parts = parts.join(largest, key).withColumn("side", F.when(F.col("component") == F.col("main"), F.lit(REACHED)).otherwise(F.lit(REST)))
    blocks = lambda side: F.coalesce(F.ceil(F.sum(F.when(F.col("side") == side, F.col("_w"))) / most), F.lit(0)).cast("int")
    counts = parts.groupBy(key).agg(blocks(REST).alias("_q"), blocks(REACHED).alias("_r")).where("_q > 0")
    d = own.join(parts.select(key, "rep", "side"), [key, "rep"]).join(counts, key)
    upto = lambda c, f: F.when(F.col(c) > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col(c) - 1, F.lit(0))), f)).otherwise(F.array().cast("array<struct<i:int,j:int>>"))
    ij = lambda i, j: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"))
    q, r = block("_q"), block("_r")
    rest = F.concat(upto("_q", lambda x: ij(F.least(x, q), F.greatest(x, q))), upto("_r", lambda y: ij(q, F.col("_q") + y)))
    d = d.withColumn("_g", F.explode(F.when(F.col("side") == REST, rest).otherwise(upto("_q", lambda x: ij(x, F.col("_q") + r)))))
    return run(one(rows.join(heavy, key, "left_anti"))).unionByName(star).unionByName(run(d.select("*", "_g.i", "_g.j")))


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 85, matches: int = MATCHES) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs (doc_id long, text string).

    Two documents are linked where 100 * intersection >= percent * union of their shingle sets. Null or wordless texts
    have n_shingles 0 and are linked with nothing. Rows of one doc_id count as one document of the component; a null
    doc_id is linked with nothing, has a null component_id and is kept. Other columns are not read; an empty table gives
    an empty result.
    """
    base = docs.select(F.col("doc_id").cast("long"), "text")
    sketch = table(base.mapInArrow(partial(_sketch, n=shingle), "doc_id long, n_shingles long, set_key binary, sig binary"), "sketch")
    real = sketch.where("n_shingles > 0 and doc_id is not null")
    classes = real.groupBy("set_key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n"))
    classes = table(classes, "classes")
    sigs = classes.select("rep", "sig")
    frequent = max(LIST_BLOCK, classes.count() // HOT_KEYS)
    keys = sigs.mapInArrow(partial(_posting_keys, prefix=COORDINATES, hot=None), "key long, rep long").groupBy("key").agg(F.count("*").alias("_c"))
    hot = np.asarray([r.key for r in keys.where(F.col("_c") > frequent).select("key").collect()], np.int64)  # at most COORDINATES x HOT_KEYS numbers
    sent = docs.sparkSession.sparkContext.broadcast(np.sort(hot.view(np.uint64)))
    posts = sigs.mapInArrow(partial(_posting_keys, prefix=COORDINATES - matches + 1, hot=sent), "key long, rep long")
    shared = table(posts.groupBy("key").agg(F.count("*").alias("weight")).where("weight > 1"), "lists")
    lists = posts.join(shared.select("key"), "key").join(sigs, "rep")
    maybe = connected_components(_linked(lists, shared, "key", F.lit(1), LIST_BLOCK, partial(_list_links, matches=matches)))
    maybe = table(maybe.select(F.col("node").alias("rep"), F.col("component").alias("cluster")), "clusters")
    weights = classes.select("rep", "n").join(maybe, "rep").groupBy("cluster").agg(F.sum("n").alias("weight"))
    sets = base.join(maybe.withColumnRenamed("rep", "doc_id"), "doc_id").select("doc_id", "text", "cluster").mapInArrow(partial(_sets, n=shingle), "rep long, cluster long, n long, shingles binary")
    links = connected_components(_linked(sets, weights, "cluster", F.col("n"), SET_BLOCK, partial(_set_links, percent=percent)))
    of_class = classes.join(links, classes.rep == links.node, "left").select("set_key", F.coalesce("component", "rep").alias("component"))
    out = sketch.join(of_class, "set_key", "left").select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.coalesce("component", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id"))).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def _sets(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for b in tv.sub_batches(batches, most=BATCH_BYTES):
        sets = shingle_sets(b.column(1), n)
        keep = pa.array([i for i, s in enumerate(sets) if len(s)], pa.int64())
        blobs = pa.array([s.tobytes() for s in sets if len(s)], pa.binary())
        yield pa.RecordBatch.from_arrays([b.column(0).take(keep), b.column(2).take(keep), pa.array([len(s) for s in sets if len(s)], pa.int64()), blobs], ["rep", "cluster", "n", "shingles"])


def drop_near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """docs without the rows that near_duplicates() does not keep; all their columns, unchanged.

    Rows with a null doc_id and wordless or null texts stay. All rows of a repeated doc_id stay or go together. Empty in, empty out.
    """
    gone = near_duplicates(docs, **how).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti")


#: All pairs that share a shingle, and reachability by recursion: for small tables.
ORACLE_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: md5(array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [md5(array_to_string(w, ' '))] ELSE [] END) AS h FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (h) WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
r AS (SELECT doc_id AS node, doc_id AS src FROM w UNION SELECT e.b, r.src FROM r JOIN e ON e.a = r.node),
c AS (SELECT node, min(src) AS component_id FROM r GROUP BY node)
SELECT c.node AS doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, c.node = component_id AS kept FROM c LEFT JOIN n ON n.doc_id = c.node
"""
