"""Nearest neighbours by a robust-pruned directed graph (Subramanya et al., 2019) for each shard of the vectors.

A graph grows by batches: a greedy walk on what stands proposes neighbours, pruning by relaxed distance keeps diverse ones, and
each edge is offered in both directions. Queries walk every shard with a beam; what they find is measured again on the original
vectors in double precision. Equal vectors are one node with its smallest ids, so that copies neither crowd a graph nor get lost.

Nearness is the inner product. The graph is built in Euclidean space, on vectors that get one more entry, which makes all of
them as long as the longest (Bachrach et al., 2014); for a query, whose further entry is 0, the nearest of these has the largest
inner product.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .storage import table
from .vectors import _bytes, matrix, plain, usual_dim

NEAREST, EVERY = 20, 20  # neighbours of a query; a row is a query if its id is divisible by EVERY
DEGREE, BUILD_BEAM, BEAM, RELAXED = 40, 80, 96, 1.2
STEP = 4  # nodes of a beam that are expanded at once
SHARD_ROOT = 32  # a shard has about SHARD_ROOT * sqrt(rows) nodes: building is linear, walks are rows / EVERY * shards
SEEN_BYTES, PRODUCTS = 32 << 20, 4 << 20  # bytes of marks, numbers of a batch of distance tables
PIECE_BYTES, QUERY_ROWS = 4 << 20, 256
SPREAD = 8  # partitions for each shard, so that few hold two: a shard is all that a task should build or search
_NONE = -1


def walk(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, q: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, list]:
    """For each row of q: nodes of its beam, best first, their products with it, and (nodes, products) of each step's expanded ones.

    x has n rows, graph n rows of neighbours, filled up with -1. All walks of a batch advance together.
    """
    n, b = len(x), len(q)
    ids = np.full((b, beam), _NONE, np.int32)
    near = np.full((b, beam), -np.inf, np.float32)
    done = np.ones((b, beam), bool)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # where filler points
    first = entries[:beam]
    dots = q @ x[first].T
    order = np.argsort(-dots, axis=1, kind="stable")
    ids[:, : len(first)], near[:, : len(first)], done[:, : len(first)] = first[order], np.take_along_axis(dots, order, 1), False
    seen[:, first] = True
    steps, live = [], np.arange(b)
    while len(live):
        at = np.argsort(done[live], axis=1, kind="stable")[:, :STEP]
        fresh = ~np.take_along_axis(done[live], at, 1)
        some = fresh[:, 0]
        live, at, fresh = live[some], at[some], fresh[some]
        if not len(live):
            break
        rows = live[:, None]
        nodes = np.where(fresh, ids[rows, at], _NONE)
        steps.append((live, nodes, np.where(fresh, near[rows, at], -np.inf)))
        done[rows, at] = True
        more = np.where((nodes == _NONE)[:, :, None], _NONE, graph[nodes]).reshape(len(live), -1)
        more = np.where((more == _NONE) | seen[rows, more], n, more)
        more.sort(axis=1)
        more[:, 1:][more[:, 1:] == more[:, :-1]] = n
        most = int((more < n).sum(axis=1).max(initial=0))
        if not most:
            continue
        more.sort(axis=1)
        more = more[:, :most]
        seen[rows, more] = True
        dots = np.matmul(x[np.minimum(more, n - 1)], q[live][:, :, None])[:, :, 0]
        dots[more == n] = -np.inf
        all_near = np.concatenate([near[live], dots], axis=1)
        top = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[live] = np.take_along_axis(all_near, top, 1)
        ids[live] = np.take_along_axis(np.concatenate([ids[live], np.where(more == n, _NONE, more)], axis=1), top, 1)
        done[live] = np.take_along_axis(np.concatenate([done[live], more == n], axis=1), top, 1)
    return ids, near, steps


def prune(x: np.ndarray, node: np.ndarray, candidates: np.ndarray, degree: int, relaxed: float) -> np.ndarray:
    """For each node at most ``degree`` of its candidates (filled up with -1), nearest first: one goes if a chosen one is nearer to it than
    the node is, by the factor ``relaxed``; places that stay free go to the nearest of these. Squared distances; all vectors are equally long, so these follow from products."""
    out = np.full((len(node), degree), _NONE, np.int32)
    size = np.einsum("ij,ij->i", x[:1], x[:1])[0] * 2
    width = candidates.shape[1]
    for lo in range(0, len(node), max(1, PRODUCTS // max(1, width * width))):
        own = slice(lo, lo + max(1, PRODUCTS // max(1, width * width)))
        c, p = candidates[own].copy(), node[own]
        c[c == p[:, None]] = _NONE
        c.sort(axis=1)
        c[:, 1:][c[:, 1:] == c[:, :-1]] = _NONE
        v = x[c]
        d = np.where(c == _NONE, np.inf, size - 2 * np.matmul(v, x[p][:, :, None])[:, :, 0])
        order = np.argsort(d, axis=1, kind="stable")
        c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
        v = np.take_along_axis(v, order[:, :, None], 1)
        between = relaxed * (size - 2 * np.matmul(v, v.transpose(0, 2, 1)))
        left, rows = c != _NONE, np.arange(len(p))
        spare, taken = left.copy(), np.zeros(len(p), np.int64)
        for k in range(degree):
            j = left.argmax(axis=1)
            has = left[rows, j]
            if not has.any():
                break
            out[rows[has] + lo, k] = c[rows, j][has]
            spare[rows[has], j[has]] = False
            taken += has
            left &= ~((between[rows, j] <= d) & has[:, None])
            left[rows, j] = False
        place = taken[:, None] + np.cumsum(spare, axis=1) - 1
        r, j = np.nonzero(spare & (place < degree))
        out[r + lo, place[r, j]] = c[r, j]
    return out


def _offer(x: np.ndarray, graph: np.ndarray, source: np.ndarray, target: np.ndarray, relaxed: float) -> None:
    """Edges source -> target into the graph; a node with more than its degree is pruned."""
    order = np.argsort(source, kind="stable")
    source, target = source[order], target[order]
    nodes, first, count = np.unique(source, return_index=True, return_counts=True)
    have = (graph[nodes] != _NONE).sum(axis=1)
    degree = graph.shape[1]
    for lo, hi in zip(*(lambda w: (w[:-1], w[1:]))(np.asarray([0, degree, 4 * degree, 16 * degree, len(x) * degree + 1])), strict=True):
        own = np.flatnonzero((count > lo) & (count <= hi))  # nodes with about as many offers share a table
        if not len(own):
            continue
        width = int(count[own].max())
        col = np.arange(width)
        new = np.where(col < count[own][:, None], target[np.minimum(first[own][:, None] + col, len(target) - 1)], _NONE)
        both = np.concatenate([graph[nodes[own]], new], axis=1)
        fits = have[own] + count[own] <= degree
        packed = np.take_along_axis(both[fits], np.argsort(both[fits] == _NONE, axis=1, kind="stable"), 1)
        graph[nodes[own][fits]] = packed[:, :degree]
        graph[nodes[own][~fits]] = prune(x, nodes[own][~fits], both[~fits], degree, relaxed)


def build(x: np.ndarray, degree: int = DEGREE, beam: int = BUILD_BEAM, relaxed: float = RELAXED) -> tuple[np.ndarray, np.ndarray]:
    """(graph, entries) of the rows of x, which are equally long. Every node can be reached from the entries."""
    n = len(x)
    graph = np.full((n, degree), _NONE, np.int32)
    middle = int(np.argmax(x @ x.mean(axis=0, dtype=np.float64).astype(x.dtype))) if n else 0
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate([[middle], order[order != middle]]).astype(np.int64)[:n]
    entries = order[:1].astype(np.int32)
    at = 1
    while at < n:
        own = order[at : at + int(np.clip(at, 1, max(64, n // 50)))]
        at += len(own)
        chosen = np.full((len(own), degree), _NONE, np.int32)
        for lo in range(0, len(own), width := max(1, SEEN_BYTES // (n + 1))):
            some = own[lo : lo + width]
            _, _, steps = walk(x, graph, entries, x[some], beam)
            met = np.full((len(some), STEP * len(steps)), _NONE, np.int32)
            for k, (rows, nodes, _) in enumerate(steps):
                met[rows, STEP * k : STEP * (k + 1)] = nodes
            chosen[lo : lo + width] = prune(x, some, met, degree, relaxed)
        graph[own] = chosen
        real = chosen != _NONE
        _offer(x, graph, chosen[real].astype(np.int64), np.repeat(own, degree).reshape(chosen.shape)[real], relaxed)
    return _reachable(x, graph, entries, beam), entries


def _reachable(x: np.ndarray, graph: np.ndarray, entries: np.ndarray, beam: int) -> np.ndarray:
    """The graph with an edge, from the nearest node that is reached and has a free place, to each part that no walk could enter."""
    n = len(x)
    seen = np.zeros(n, bool)

    def spread(front: np.ndarray) -> None:
        seen[front] = True
        while len(front):
            front = np.unique(graph[front])
            front = front[front != _NONE]
            front = front[~seen[front]]
            seen[front] = True

    spread(entries)
    while not seen.all():
        lost = int(np.argmin(seen))
        found = walk(x, graph, entries, x[lost][None], beam)[0][0]
        found = found[found != _NONE]
        row, col = np.nonzero(graph[found] == _NONE)  # nearest first
        if not len(row):
            graph = np.concatenate([graph, np.full((n, 1), _NONE, np.int32)], axis=1)
            row, col = [0], [graph.shape[1] - 1]
        graph[found[row[0]], col[0]] = lost
        spread(np.asarray([lost]))
    return graph


def _lengthened(v: np.ndarray, longest: float) -> np.ndarray:
    """Vectors over ``longest`` with the entry that makes each of them as long as 1."""
    u = v / longest
    rest = np.sqrt(np.maximum(0, 1 - np.einsum("ij,ij->i", u, u)))
    return np.concatenate([u, rest[:, None]], axis=1).astype(np.float32)


_PIECES = "shard int, kind int, piece int, ids binary, n_ids binary, vectors binary, graph binary"


def _build(key: tuple, nodes: pa.Table, dim: int, longest: float) -> pa.Table:
    """One shard's nodes (v, ids) as pieces of its index: vectors, ids and edges, in the order of the nodes; the first is the entry."""
    nodes = nodes.sort_by("v")
    v = matrix(nodes.column("v").combine_chunks(), dim)
    graph, entries = build(_lengthened(v, longest))
    ids = nodes.column("ids").combine_chunks()
    per = max(1, PIECE_BYTES // (8 * dim + 4 * graph.shape[1] + 64))
    rows = []
    for k, lo in enumerate(range(0, len(v), per)):
        own = ids.slice(lo, per)
        head = np.asarray([len(entries), graph.shape[1], *entries], np.int32).tobytes() if k == 0 else b""
        flat, n_ids = np.asarray(own.flatten(), np.int64), np.asarray(pc.list_value_length(own), np.int32)
        rows.append((key[0].as_py(), 0, k, flat.tobytes(), n_ids.tobytes(), v[lo : lo + per].tobytes(), head + graph[lo : lo + per].tobytes()))
    schema = pa.schema([("shard", pa.int32()), ("kind", pa.int32()), ("piece", pa.int32()), ("ids", pa.binary()), ("n_ids", pa.binary()), ("vectors", pa.binary()), ("graph", pa.binary())])
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


class _Shard:
    """A shard's index from its pieces."""

    def __init__(self, pieces: list[dict], dim: int):
        self.v = np.frombuffer(b"".join(p["vectors"] for p in pieces)).reshape(-1, dim)
        self.ids = np.frombuffer(b"".join(p["ids"] for p in pieces), np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.frombuffer(b"".join(p["n_ids"] for p in pieces), np.int32))])
        edges = np.frombuffer(b"".join(p["graph"] for p in pieces), np.int32)
        n, degree = int(edges[0]), int(edges[1])
        self.entries, self.graph = edges[2 : 2 + n], edges[2 + n :].reshape(-1, degree)

    def search(self, ids: np.ndarray, q: np.ndarray, longest: float, beam: int, nearest: int) -> Iterator[pa.RecordBatch]:
        x = (self.v / longest).astype(np.float32)
        for lo in range(0, len(q), width := max(1, SEEN_BYTES // (len(x) + 1))):
            own, qid = q[lo : lo + width], ids[lo : lo + width]
            most = np.abs(own).max(axis=1, keepdims=True)  # not 0: such vectors take no part
            found = walk(x, self.graph, self.entries, (own / most).astype(np.float32), beam)[0]
            score = np.where(found == _NONE, -np.inf, np.einsum("bkd,bd->bk", self.v[found], own))
            best = np.take_along_axis(found, order := np.argsort(-score, axis=1, kind="stable"), 1)
            score = np.take_along_axis(score, order, 1)
            row, col = np.nonzero(best != _NONE)
            node, count = best[row, col], np.diff(self.first)[best[row, col]]
            row, s = np.repeat(row, count), np.repeat(score[row, col], count)
            vec = self.ids[np.repeat(self.first[node], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)]
            keep = vec != qid[row]
            row, s, vec = row[keep], s[keep], vec[keep]
            order = np.lexsort((vec, -s, row))
            row, s, vec = row[order], s[order], vec[order]
            place = np.arange(len(row)) - np.searchsorted(row, row)
            keep = place < nearest
            yield pa.RecordBatch.from_arrays([pa.array(qid[row[keep]]), pa.array(vec[keep]), pa.array(s[keep])], ["query_id", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], dim: int, longest: float, beam: int, nearest: int) -> Iterator[pa.RecordBatch]:
    pieces, shard, at = [], None, None
    for b in batches:
        for r in range(b.num_rows):
            one = {c: b.column(k)[r].as_py() for k, c in enumerate(b.schema.names)}
            if one["kind"] == 0:
                pieces = [*pieces, one] if pieces and pieces[0]["shard"] == one["shard"] else [one]
                shard, at = None, one["shard"]
            elif at == one["shard"]:
                shard = shard or _Shard(pieces, dim)
                yield from shard.search(np.frombuffer(one["ids"], np.int64), np.frombuffer(one["vectors"]).reshape(-1, dim), longest, beam, nearest)


def _query_blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.RecordBatch]:
    for b in batches:
        v, ids = matrix(b.column(1), dim), np.asarray(b.column(0), np.int64)
        for lo in range(0, b.num_rows, QUERY_ROWS):
            yield pa.RecordBatch.from_arrays([pa.array([x[lo : lo + QUERY_ROWS].tobytes()], pa.binary()) for x in (ids, v)], ["ids", "vectors"])


def index(nodes: DataFrame, dim: int, longest: float, shards: int) -> DataFrame:
    """The index of (v binary, ids array<long>) as a table of pieces by shard: nodes are dealt by a hash of their vectors."""
    dealt = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), F.lit(shards)).cast("int"))
    dealt = dealt.select("shard", "v", "ids").repartition(SPREAD * shards, "shard")
    made = dealt.groupBy("shard").applyInArrow(lambda key, rows: _build(key, rows, dim, longest), _PIECES)
    return table(made, "graphs")


def nearest(df: DataFrame, k: int = NEAREST, every: int = EVERY, beam: int = BEAM, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows found for each row whose id is divisible by ``every``, by the largest inner product,
    ties to the smaller id; a query's own row is no candidate. score is the inner product in double precision.

    Vectors that are null, empty or zero or hold nulls or non-finite entries take no part, nor do rows without an id, nor vectors of
    another length than most have (the longest such length, if several are as frequent). Rows that repeat id and vector count
    once; of an id with several vectors each is a candidate, though not for one another, and the smallest by bytes is the query. With
    fewer candidates than k, all that are found are returned. An empty table gives an empty result.

    A shard has about SHARD_ROOT * sqrt(rows) nodes, at least 1024, so its build fits a task; at most k + 1 ids of equal vectors
    are kept, the smallest, as no query has use for more.
    """
    d = plain(df, key, vector).where("norm > 0 and vec_id is not null")
    d = table(d, "vectors")
    dim, rows, longest = usual_dim(d)
    if not rows:
        return df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    longest = longest * (1 + 1e-9)
    d = d.where(F.col("dim") == dim).select("vec_id", "v")
    smallest = F.dense_rank().over(Window.partitionBy("v").orderBy("vec_id"))
    nodes = d.withColumn("_r", smallest).where(F.col("_r") <= k + 1).groupBy("v").agg(F.sort_array(F.collect_set("vec_id")).alias("ids"))
    shards = max(1, int(rows / max(1024, SHARD_ROOT * rows**0.5) + 0.5))
    graphs = index(nodes, dim, longest, shards)
    queries = d.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    blocks = queries.mapInArrow(partial(_query_blocks, dim=dim), "ids binary, vectors binary")
    none = lambda c: F.lit(None).cast("binary").alias(c)
    asked = blocks.select(F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(1).alias("kind"), F.lit(0).alias("piece"), "ids", none("n_ids"), "vectors", none("graph"))
    both = graphs.unionByName(asked).repartition(SPREAD * shards, "shard").sortWithinPartitions("shard", "kind", "piece")
    found = both.mapInArrow(partial(_search, dim=dim, longest=longest, beam=max(beam, k + 1), nearest=k), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
