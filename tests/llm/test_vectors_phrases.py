"""Nearest neighbours, whitening and phrases against brute force, on small tables with awkward rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from curatrix.llm import phrases, vamana, whitening
from curatrix.llm import textvec as tv

SCHEMA = "vec_id long, embedding array<float>, label int, rank string, v int, n string, component int"


def _vectors(n=900, dim=12, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim)) * rng.uniform(0.2, 3, (n, 1))
    x[300:520] = x[300]  # copies
    x[520:700] = x[520] + rng.normal(size=(180, dim)) * 1e-4  # near copies
    rows = [(int(i), [float(np.float32(y)) for y in r]) for i, r in enumerate(x)]
    return rows


AWKWARD = [(None, [1.0] * 12), (2000, None), (2020, []), (2040, [0.0] * 12), (2060, [float("nan")] + [1.0] * 11), (2080, [float("inf")] + [1.0] * 11), (2100, [None] + [1.0] * 11), (2120, [1.0] * 5), (2140, [-0.0] + [1.0] * 11), (2160, [0.0] + [1.0] * 11)]


def _table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", 2, "y", 3) for r in rows], SCHEMA).repartition(4)


def _nearest(rows, k=20, every=20):
    own = [(i, np.asarray(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 12 and all(y is not None and np.isfinite(y) for y in v) and any(v)]
    ids, x = np.asarray([i for i, _ in own]), np.asarray([v for _, v in own])
    out = {}
    for i, v in own:
        if i % every == 0:
            s = x @ v
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != i][:k]
            out[i] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def test_nearest_neighbours(spark):
    rows = _vectors() + AWKWARD + _vectors()[:40]
    got = defaultdict(list)
    for r in vamana.nearest(_table(spark, rows)).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.rank, r.vec_id, r.score))
    want = _nearest(_vectors() + AWKWARD)
    assert set(got) == set(want) and all([x[0] for x in g] == list(range(1, 21)) for g in got.values())
    assert all(g == sorted(g, key=lambda x: (-x[2], x[1])) and q not in [x[1] for x in g] for q, g in got.items())
    score = {(q, i): s for q, w in want.items() for i, s in w}
    assert all(abs(s - score[q, i]) < 1e-9 for q, g in got.items() for _, i, s in g if (q, i) in score)
    assert np.mean([len({x[1] for x in got[q]} & {i for i, _ in w}) for q, w in want.items()]) >= 0.95 * 20
    assert [x[1] for x in got[400]] == [i for i, _ in want[400]]  # a copy: the smallest ids of the other copies


def test_few_neighbours(spark):
    got = vamana.nearest(_table(spark, _vectors()[:21:10])).collect()
    assert sorted((r.query_id, r.rank) for r in got) == [(0, 1), (0, 2), (20, 1), (20, 2)]
    assert vamana.nearest(_table(spark, AWKWARD[1:6])).count() == 0
    assert vamana.nearest(spark.createDataFrame([], SCHEMA)).columns == ["query_id", "rank", "vec_id", "score"]


def test_shards_are_searched_together(spark, monkeypatch):
    monkeypatch.setattr(vamana, "SHARD_ROOT", 1)  # the bound of 1024 rows then decides
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(5000, 6)).round(4).tolist())]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(set)
    for r in vamana.nearest(d, every=500).collect():
        got[r.query_id].add(r.vec_id)
    x = np.asarray([v for _, v in rows])
    hits = [len(got[q] & {int(i) for i in np.argsort(-(x @ x[q]), kind="stable")[:21] if i != q}) for q in range(0, 5000, 500)]
    assert np.mean(hits) >= 19 and all(len(g) == 20 for g in got.values())


def test_graph_reaches_all_and_prunes_by_relaxed_distance():
    rng = np.random.default_rng(2)
    x = vamana._lengthened(np.concatenate([rng.normal(size=(200, 5)), np.ones((1, 5)) + rng.normal(size=(400, 5)) * 1e-3]), 8.0)
    graph, entries = vamana.build(x, degree=6, beam=12)
    seen, front = set(entries.tolist()), entries.tolist()
    while front:
        front = [j for i in front for j in graph[i].tolist() if j >= 0 and j not in seen]
        seen |= set(front)
    assert len(seen) == 600
    node, cand = np.asarray([0]), np.arange(1, 60, dtype=np.int32)[None]
    got = vamana.prune(x, node, cand, 6, 1.2)[0]
    d = ((x[:, None].astype(float) - x[None]) ** 2).sum(2)
    left, want = sorted(range(1, 60), key=lambda j: d[0, j]), []
    while left and len(want) < 6:
        want.append(left.pop(0))
        left = [j for j in left if 1.2 * d[want[-1], j] > d[0, j]]
    rest = [j for j in sorted(range(1, 60), key=lambda j: d[0, j]) if j not in want]
    assert got.tolist() == (want + rest)[:6]


def _whitened(rows, k=4):
    own = [(i, np.floor(256 * np.asarray(v, float)).astype(int)) for i, v in rows if v is not None and len(v) == 12 and all(y is not None and np.isfinite(y) for y in v)]
    x = np.unique([v for _, v in own], axis=0)
    n, s = len(x), [int(c) for c in x.sum(0)]
    c = x - np.asarray(s) / n
    e, u = np.linalg.eigh(c.T @ c / n)
    e, u = e[::-1], u[:, ::-1]
    return {(i, j + 1): (n, sum((n * int(a) - b) ** 2 for a, b in zip(v, s, strict=True)), float((v - np.asarray(s) / n) @ u[:, j] / np.sqrt(e[j])), e[j] / e.sum()) for i, v in own for j in range(k)}


def test_whitening(spark):
    rows = _vectors() + AWKWARD + _vectors()[:7]
    got = whitening.whiten(_table(spark, rows)).collect()
    want = _whitened(rows)
    assert len(got) == 4 * (900 + 7 + 4) and {(r.vec_id, r.component) for r in got} == set(want)  # without an id, a zero vector and both signs of zero
    sign = {j: 1 if next(r for r in got if (r.vec_id, r.component) == (5, j)).whitened * want[5, j][2] > 0 else -1 for j in (1, 2, 3, 4)}
    for r in got:
        n, far, w, share = want[r.vec_id, r.component]
        assert (r.n, int(r.deviation)) == (n, far)
        assert abs(r.whitened * sign[r.component] - w) < 1e-9 and abs(r.explained / share - 1) < 1e-9 and r.identity_error < 1e-9


def test_whitening_of_few_and_large(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(_table(spark, [(1, None), (2, [float("nan")])])).count() == 0
    same = whitening.whiten(_table(spark, [(1, [0.5, 2.0])] * 3)).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, None, None, None)] * 6
    big = [(1, [1e15, -1.0, 3.0]), (2, [-3e15, 1.0, 3.0]), (3, [2.5, 0.0, 3.0]), (4, [1e30, 0.0, 3.0])]  # the last one's image is beyond 64 bits
    d = spark.createDataFrame(big, "vec_id long, embedding array<double>")
    got = whitening.whiten(d).collect()
    x = [[int(np.floor(256 * c)) for c in v] for _, v in big[:3]]
    s = [sum(c) for c in zip(*x, strict=True)]
    assert {(r.vec_id, r.component): int(r.deviation) for r in got} == {(i + 1, k): sum((3 * a - b) ** 2 for a, b in zip(v, s, strict=True)) for i, v in enumerate(x) for k in (1, 2, 3)}
    assert {r.component for r in got if r.whitened is None} >= {3}


VOCABULARY = ["a", "bb", "The", "été", "x#", "日本", "É", "z" * 30, *(f"w{i}" for i in range(9))]
SEPARATORS = [" ", "  ", "\t", " . ", ", ", "!", "\n", "; ", "\r\n", "?:"]


def _prose(rnd, n):
    return "".join(rnd.choice(VOCABULARY) + rnd.choices(SEPARATORS, [60, 3, 3, 1, 1, 1, 1, 1, 1, 1])[0] for _ in range(n))


def _counts(rows):
    f = defaultdict(Counter)
    for lang, text in rows:
        own = f["und" if lang is None else lang]
        own[()] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            own[()] += len(w)
            own.update(tuple(w[i : i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f


def _phrases(rows, least, percent, top):
    out = []
    for lang, c in _counts(rows).items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = {p[i : i + k] for p, a in cand.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= percent * cand[p[i : i + k]]}
        best = {p: min((2000000 * a // (c[p[:k]] + c[p[k:]]), k) for k in range(1, len(p))) for p, a in cand.items() if p not in gone}
        order = sorted(best, key=lambda p: (-best[p][0], -c[p], " ".join(p).encode()))
        out += [(lang, i, " ".join(p), c[p], c[p[: best[p][1]]], c[p[best[p][1] :]], c[()], best[p][0]) for i, p in enumerate(order[:top], 1)]
    return sorted(out)


@pytest.fixture(scope="module")
def prose():
    rnd = random.Random(5)
    rows = [(rnd.choice(["en", "de", "und", None, ""]), _prose(rnd, rnd.randrange(0, 60))) for _ in range(300)]
    return [*rows, ("en", _prose(rnd, 9000)), ("de", ""), ("fr", None), ("en", "q" * 30000), ("en", _prose(rnd, 5) + "q" * 9000 + " a b c"), ("hot", "p q r s t\n" * 500), ("hot", " . ; \t\n")]


@pytest.mark.parametrize("top_group", [200_000, 40])
def test_collocations(spark, prose, monkeypatch, top_group):
    monkeypatch.setattr(phrases, "TOP_GROUP", top_group)
    monkeypatch.setattr(phrases, "RANGE_BYTES", 2000)
    d = spark.createDataFrame([(*r, "x", 1, 2) for r in prose], "lang string, text string, phrase string, a int, rank int").repartition(3)
    for least, percent, top in ((30, 80, 2000), (3, 60, 15)):
        got = sorted(tuple(r) for r in phrases.collocations(d, least, percent, top).collect())
        assert got == _phrases(prose, least, percent, top)


def test_no_phrases(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, None), ("en", "")], "lang string, text string")).count() == 0


class _Sent:
    def __init__(self, value):
        self.value = value


@pytest.mark.parametrize(("buffer", "chunk", "n_cuts"), [(2 << 20, 1 << 21, 0), (4096, 2000, 7), (600, 900, 40), (5000, 1 << 21, 200)])
def test_tries_in_chunks_cut_anywhere(prose, monkeypatch, buffer, chunk, n_cuts):
    """Long texts in segments, many chunks, cuts of any path: all counts are those of plain loops, closed phrases come once, with their left parts."""
    monkeypatch.setattr(tv, "SUB_BATCH_BYTES", buffer)
    monkeypatch.setattr(tv.sub_batches, "__defaults__", ("text", buffer))
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    rows = [("und" if a is None else a, b or "") for a, b in prose]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], ["lang", "text"])
    sample = {tuple(c[i].as_py() for c in b.columns) for b in phrases._sampled(iter([batch]), 3) for i in range(b.num_rows)}
    cuts = sorted(random.Random(1).sample(sorted(sample), n_cuts))
    pieces = pa.Table.from_batches(list(phrases._tries(iter([batch]), _Sent(cuts)))).sort_by("range")
    want = {(lang, " ".join(p)): a for lang, c in _counts(rows).items() for p, a in c.items() if a}
    for least in (1, 8):
        got, closed = Counter(), set()
        for r in (r for b in phrases._merged(iter(pieces.to_batches()), _Sent(cuts), least) for r in b.to_pylist()):
            key = (r["lang"], r["phrase"])
            got[key] += r["a"]
            if not r["open"]:
                assert key not in closed
                closed.add(key)
                assert all(r[f"l{k}"] in (None, want[r["lang"], " ".join(r["phrase"].split(" ")[:k])]) for k in range(1, r["depth"]))
        assert {k: a for k, a in got.items() if a >= least or not k[1]} == {k: a for k, a in want.items() if a >= least or not k[1]}


def test_exact_scores_beyond_64_bits(spark):
    a, l, r = 9_000_000_000_000_001, 9_000_000_000_000_007, 9_000_000_000_000_011
    d = spark.createDataFrame([(a, l, r)], "a long, l1 long, r1 long")
    got = d.selectExpr(f"(cast(a as decimal(20,0)) * {phrases.SCALE}) div (cast(l1 as decimal(20,0)) + cast(r1 as decimal(20,0))) as s").first().s
    assert got == phrases.SCALE * a // (l + r)
