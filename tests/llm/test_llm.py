"""The corpus operators against brute force, round trips and held-out accuracy, on small fixtures with awkward rows."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from curatrix.llm import graph, langid, linededup, mixing, mpeg, neardup, pieces, quality, repair, sharding, substring, wordcache
from curatrix.llm import textvec as tv
from curatrix.llm.queries import vocabulary

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, kept boolean, key int"


def _words(t):
    return WORD.findall(t or "")


def _fold(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t)


def _texts():
    rnd = random.Random(3)
    vocab = ["the", "of", "ändern", "été", "niño", "x#y", "A", "b", "word", "line", "zeta", "omega", "日本", "q"]
    long = " ".join(rnd.choice(vocab) + str(rnd.randrange(300)) for _ in range(6000))
    base = [" ".join(rnd.choice(vocab) + str(rnd.randrange(50)) for _ in range(rnd.randrange(3, 120))) for _ in range(30)]
    passage = " ".join(f"p{i}" for i in range(60))
    out = [None, "", " \t\n ", "\n\n", "one two", "one two", "One two", "five words are just here", long, long + " more"]
    for i, b in enumerate(base):
        out.append(b)
        if i % 3 == 0:
            w = b.split()
            w[len(w) // 2] = "changed"
            out += [b, " ".join(w)]
        if i % 4 == 0:
            out.append(f"{b} {passage} {b[:20]}")
        out.append(f"A license line that repeats everywhere\n{b}\n  a LICENSE line that repeats everywhere \t\n short\n")
    out += ["a b c d e f " * 10, "no break spaces stay inside words", "<|endoftext|> 12 34 don't", "▁mark"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", "fr", None][i % 3], "hot" if i % 3 else [None, "a", "é"][i % 9 // 3], len(t or ""), "clash", None, 1) for i, t in enumerate(_texts())]
    return spark.createDataFrame(rows, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def texts():
    return dict(enumerate(_texts()))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _sql(docs, sql):
    con = duckdb.connect()
    con.register("documents", pa.Table.from_pandas(docs.select("doc_id", "text", "source").toPandas(), preserve_index=False))
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    return sorted(map(repr, (dict(sorted(zip(names, r, strict=True))) for r in got.fetchall())))


def _rows(df, *cols):
    return sorted(map(repr, (dict(sorted(r.asDict().items())) for r in df.select(*cols).collect())))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é\n\t\x0b #x ", max_size=40)), max_size=8))
def test_words(texts):
    w = tv.Words(pa.array(texts, pa.string()))
    raw = w.buf.tobytes()
    for d, t in enumerate(texts):
        assert [raw[s:e].decode() for s, e in zip(w.start[w.off[d] : w.off[d + 1]], w.end[w.off[d] : w.off[d + 1]], strict=True)] == _words(t)
    known = {}
    for s, e, h in zip(w.start, w.end, w.hash, strict=True):
        assert known.setdefault(raw[s:e], int(h)) == int(h)
    assert len(set(known.values())) == len(known)


def _base(t):
    w = _words(t)
    lines = [x for x in (t or "").split("\n") if _words(x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    again = {i + k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(5)}
    failed = len(w) < 10 or 100 * len(again) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(again), failed


def test_quality_counts(docs, texts, spark):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(0, 60, 2)] + [(1, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.quality_rules(docs, labels).collect()
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == {i: _base(t) for i, t in texts.items()}
    assert not any(r.kept and r.base_failed for r in got)


def _morse(n, a, b):
    """The Thue-Morse word of 2**n letters, on which polynomial hashes modulo powers of two fail, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(1 << n)]
    return [a if x == 0 else b for x in bits], [b if x == 0 else a for x in bits]


def test_hashes_tell_words_of_equal_parts_apart(spark):
    for n in (4, 9, 10, 12):
        words = ["".join(x) for x in _morse(n, "a", "b")]
        w = tv.Words(pa.array(words))
        assert w.hash[0] != w.hash[1] and not w.spans.same(w.start[:1], w.end[:1], w.start[1:], w.end[1:])[0]
        counts = quality.base_counts(tv.Words(pa.array(["\n".join(words), "\n".join([words[0]] * 2)])))
        assert counts["n_dup_lines"].tolist() == [0, 1]
    x, y = (" ".join(v) for v in _morse(11, "a", "b"))
    d = spark.createDataFrame([(1, words[0]), (2, words[1]), (3, x), (4, y)], "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(d).collect()}
    assert (got[1], got[2]) == (1, 2)
    assert [r.n_removed for r in substring.substring_dedup(d.where("doc_id < 3")).collect()] == [0, 0]
    assert _rows(substring.substring_dedup(d), "doc_id", "n_words", "n_removed", "kept_sha256") == _sql(d.selectExpr("*", "'' AS source"), substring.ORACLE_SQL)
    v = pieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    ids, off = v.encode(pa.array(words))
    assert [v.decode(ids[off[i] : off[i + 1]]) for i in range(2)] == words


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abé日", min_size=1, max_size=40), min_size=1, max_size=60), st.integers(1, 3))
def test_spans_of_equal_hash_are_told_apart(words, bits):
    class Weak(tv.Spans):
        def hash(self, start, end):
            return super().hash(start, end) & np.uint64(bits)

    def encode(s, e):
        got = [np.frombuffer(buf[i:j].tobytes(), np.uint8) for i, j in zip(s, e, strict=True)]
        return np.asarray([len(x) for x in got]), np.concatenate(got)

    cache = wordcache.WordCache()
    for part in (words, words[::-1]):
        buf, off = tv.utf8(pa.array(part))
        ids, size = wordcache.encode_spans(cache, Weak(buf), off[:-1], off[1:], encode)
        assert bytes(ids.astype(np.uint8)) == "".join(part).encode() and size.tolist() == np.diff(off).tolist()


def _p_good(text, m):
    """quality.score() for one text by plain loops."""
    u, mask = lambda x: x & (1 << 64) - 1, (1 << 64) - 1
    w = tv.Words(pa.array([text]))
    h = [int(x) for x in w.hash]
    pair, ch = int(quality._PAIR), [int(x) for x in quality._CH]
    words = []
    for i, x in enumerate(h):
        words += [x >> 64 - quality.WORD_BITS, u((u(x * pair) + (h[i - 1] if i else 0)) * ch[0]) >> 64 - quality.WORD_BITS]
    chars = []
    for i in range(len(text)):
        g = 0
        for k in range(3):
            if i >= k:
                g = u(g + (ord(text[i - k]) + 1) * ch[k])
            chars.append((u(g * pair) >> 64 - quality.CHAR_BITS) + (1 << quality.WORD_BITS))
    logit = sum(sum(int(m.weight[i]) for i in x) / max(1, len(x)) for x in (words, chars)) / quality.UNIT + m.bias
    return 1 / (1 + np.exp(-(m.scale * logit + m.shift)))


def test_quality_scores(docs, texts):
    weight = np.random.default_rng(3).integers(-(1 << 21), 1 << 21, (1 << quality.WORD_BITS) + (1 << quality.CHAR_BITS))
    m = quality.Model(weight, 0.1, 1.3, -0.2)
    got = {r.doc_id: r for r in quality.quality_rules(docs, None, m).collect()}
    assert all(got[i].p_good == pytest.approx(_p_good(t or "", m)) for i, t in texts.items())
    assert all(r.kept == (not r.base_failed and r.p_good >= 0.5) for r in got.values())
    again = {r.doc_id: r.p_good for r in quality.quality_rules(docs.repartition(13), None, m).collect()}
    assert again == {i: r.p_good for i, r in got.items()}
    of = defaultdict(set)
    for i, t in texts.items():
        of[t].add(got[i].p_good)
    assert all(len(x) == 1 for x in of.values())


def test_quality_learns(spark, empty):
    rnd = random.Random(1)
    good = [" ".join(rnd.choice(["river", "stone", "light", "wind"]) for _ in range(40)) for _ in range(120)]
    bad = [" ".join(rnd.choice(["CLICK!!", "buy$$$", "win###"]) for _ in range(40)) for _ in range(120)]
    d = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 120)) for i in range(240) if i % 3], "doc_id long, quality int")
    model = quality.train(d, labels)
    got = {r.doc_id: r.p_good for r in quality.quality_rules(d, labels, model).collect()}
    assert all((got[i] >= 0.5) == (i < 120) for i in range(0, 240, 3))
    assert quality.keep_good(d, labels, model).columns == d.columns
    assert quality.quality_rules(empty, labels.limit(0)).count() == 0


def _components(texts, percent):
    sets = {}
    for i, t in texts.items():
        w = _words(_fold(t or ""))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sets, {i: find(i) for i in sets}


@pytest.mark.parametrize("blocks", [None, 4])
def test_near_duplicates(docs, texts, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(neardup, "LIST_BLOCK", blocks)
        monkeypatch.setattr(neardup, "SET_BLOCK", 200)
    sets, want = _components(texts, 85)
    got = neardup.near_duplicates(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {i: (len(sets[i]), want[i], want[i] == i) for i in texts}


def test_near_duplicates_of_odd_rows(spark, empty):
    assert neardup.near_duplicates(empty).count() == 0
    d = spark.createDataFrame([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id or 0, r.kept) for r in neardup.near_duplicates(d).collect())
    assert got == [(0, 0, True), (1, 1, True), (1, 1, True), (3, 1, False)]
    assert neardup.drop_near_duplicates(d).count() == 3
    two = spark.createDataFrame([(1, "a b c d e f"), (1, "p q r s t u"), (2, "p q r s t u"), (3, "a b c d e f")], "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(two).collect()} == {(1, 1), (2, 1), (3, 1)}


def test_collisions_by_merged_lists():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 32, (6, neardup.COORDINATES)).astype(np.uint32)
    sig = base[rng.integers(0, 6, 150)]
    change = rng.random(sig.shape) < rng.choice([0.02, 0.2, 0.45], 150)[:, None]
    sig[change] = rng.integers(0, 40, change.sum())
    for matches in (20, 36, 64):
        lists = neardup._Lists(sig, matches)
        for at in range(150):
            rest = np.setdiff1d(np.flatnonzero(rng.random(150) < 0.7), [at])
            assert (lists.alike(at, rest) == ((sig[rest] == sig[at]).sum(1) >= matches)).all()


def test_near_duplicates_find_all_links(spark):
    """The recall of links over all pairs of the documents of a larger table, by SQL on all shingles."""
    d = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "source")
    rows = d.collect()
    sets, want = _components({r.doc_id: r.text for r in rows}, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in neardup.near_duplicates(d).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}


@pytest.mark.parametrize("split", [10**6, 0])
def test_components(spark, monkeypatch, split):
    monkeypatch.setattr(graph, "SPLIT", split)
    rnd = random.Random(2)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(40)] + [(rnd.randrange(200, 300), rnd.randrange(200, 300)) for _ in range(60)] + [(7, 7), (None, 1)]
    got = {r.node: r.component for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    near = defaultdict(set)
    for a, b in edges:
        if a is not None and a != b:
            near[a].add(b)
            near[b].add(a)
    for n in near:
        seen, todo = {n}, [n]
        while todo:
            todo += (new := near[todo.pop()] - seen)
            seen |= new
        assert got[n] == min(seen)
    assert len(got) == len(near)


def test_mixing(docs, empty):
    got = mixing.mix(docs)
    assert _rows(got, "doc_id", "size", "source_size", "target", "taken") == _sql(docs, mixing.ORACLE_SQL)
    rows = got.collect()
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r["size"] for r in own)
    assert mixing.mixed(docs).count() == sum(r.copies for r in rows) and mixing.mixed(docs).columns == docs.columns
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    names = ("_place", "_band", "bucket", "band", "_before", "u", "_u", "key", "row", "place", "digest", "spot", "n", "before")
    odd = docs.select("doc_id", "text", "source", *(F.lit(3).alias(x) for x in names))
    again = mixing.mix(odd)
    assert {tuple(r[x] for x in names) for r in again.collect()} == {(3,) * len(names)}
    assert _rows(again, "doc_id", "size", "taken") == _rows(got, "doc_id", "size", "taken") == _rows(mixing.mix(docs, keep=("doc_id",)), "doc_id", "size", "taken")
    assert sorted(r.doc_id for r in mixing.mixed(odd).collect()) == sorted(r.doc_id for r in rows for _ in range(r.copies)) and mixing.mixed(odd).columns == odd.columns


def test_mixing_in_many_buckets(docs, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 20)
    rows = mixing.mix(docs).collect()
    assert mixing.buckets_for(len(rows)) > 64
    for s in {r.source for r in rows}:
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - own[0].target) <= 2 * max(r["size"] for r in own)


def test_mixing_of_repeated_rows(spark):
    d = spark.createDataFrame([(1, "a b", "s"), (1, "a b", "s"), (None, "c", None), (None, None, None), (2, "a b c", "s")] * 3, "doc_id long, text string, source string")
    assert mixing.mix(d).count() == 15 and _rows(mixing.mix(d), "doc_id", "size", "taken") == _rows(mixing.mix(d.repartition(7)), "doc_id", "size", "taken")


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 1000, "c": 50}, {"a": 1, "b": 1, None: 1000}, {"a": 0, "b": 5}, {"x": 7}])
def test_targets(spark, sizes):
    rows = {r.source: r.target for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    names = sorted((k for k in sizes if k is not None)) + [None] * (None in sizes)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, free, want = 1.5 * sum(sizes.values()), set(sizes), {}
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] >= 2 * sizes[s]}
        if not over:
            want |= {s: level * weight[s] for s in free}
            break
        want |= {s: 2 * sizes[s] for s in over}
        left -= sum(2 * sizes[s] for s in over)
        free -= over
    assert rows == pytest.approx(want)


def test_line_dedup(docs, texts, empty, spark):
    got = linededup.line_dedup(docs)
    assert _rows(got, "doc_id", "n_lines", "n_dropped", "kept_sha256") == _sql(docs, linededup.ORACLE_SQL)
    assert {"size", "kept", "key"} <= set(got.columns)
    assert linededup.line_dedup(empty).count() == 0
    same = spark.createDataFrame([(i, "the very same line of text\nown " + "x" * i) for i in range(4)] + [(None, "the very same line of text")], "doc_id long, text string")
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_dropped) for r in linededup.line_dedup(same).collect()) == [(-1, 0), (0, 1), (1, 1), (2, 1), (3, 0)]


def test_line_dedup_of_repeated_ids_and_clashing_names(spark):
    line = "the very same line of text"
    rows = [(1, line), (1, line + "\nand its own line, which is long"), (2, line), (3, "x\nanother line that stands in three"), (4, "another line that stands in three"), (4, "another line that stands in three"), (5, "another line that stands in three")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.n_dropped) for r in linededup.line_dedup(d).collect()) == [(1, 0), (1, 0), (2, 0), (3, 1), (4, 1), (4, 1), (5, 0)]
    odd = d.where("doc_id > 2").select("doc_id", "text", *(F.lit(7).alias(x) for x in ("keys", "_keys", "_doc", "drop", "row", "_of", "key", "refs", "shard")))
    got = linededup.line_dedup(odd)
    assert {(r.doc_id, r.n_dropped, r["keys"], r["_doc"], r["row"]) for r in got.collect()} == {(3, 1, 7, 7, 7), (4, 1, 7, 7, 7), (5, 0, 7, 7, 7)}


def _index_state(index):
    """The references, and the keys that the filters may know, as plain data."""
    refs = sorted(map(tuple, index.refs.collect()))
    known = {r.shard: linededup.CuckooFilter.frombytes(r.filter) for r in index.filters.collect()}
    slots = {s: sorted(f.table[f.table > 0].tolist()) for s, f in known.items()}
    return refs, {s: x for s, x in slots.items() if x}


@pytest.mark.parametrize("most", [64 << 20, -1])
def test_line_index_is_reversible(spark, monkeypatch, most):
    monkeypatch.setattr(linededup, "FILTERS_MOST", most)
    line = "a line that is long enough to count"
    first = spark.createDataFrame([(i, f"{line}\nown line of document number {i}") for i in range(3)], "doc_id long, text string")
    more = spark.createDataFrame([(9, line.upper()), (10, line)], "doc_id long, text string")
    index = linededup.LineIndex(spark, shards=16).insert(first)
    before = {r.doc_id: r.n_dropped for r in index.apply(first).collect()}
    assert before == {0: 1, 1: 1, 2: 0} and 1 < len(index.touched) <= 4 and len(index.refiltered) == 1
    grown = index.insert(more)
    assert len(grown.touched) == 1 and grown.refiltered == []  # one key, which was repeated already: no other shard is written
    untouched = set(index.refs_of) - set(grown.touched)
    assert all(grown.refs_of[s] == index.refs_of[s] for s in untouched)
    assert {r.doc_id: r.n_dropped for r in grown.apply(first.unionByName(more)).collect()} == {0: 1, 1: 1, 2: 1, 9: 1, 10: 0}
    back = grown.delete(more)
    assert {r.doc_id: r.n_dropped for r in back.apply(first).collect()} == before
    assert _index_state(back) == _index_state(index)
    less = back.delete(first.limit(1))
    assert less.refiltered == index.refiltered and _index_state(less)[1] == {}  # the key left its shard's filter
    assert {r.doc_id: r.n_dropped for r in less.apply(first).collect()} == {0: 0, 1: 0, 2: 0}
    assert _index_state(less.insert(first.limit(1))) == _index_state(index)
    assert index.insert(first.limit(0)).touched == []


def test_line_index_as_the_whole_table(spark, docs):
    parts = [docs.where(f"doc_id % 3 = {k}") for k in range(3)]
    index = linededup.LineIndex(spark, shards=4)
    for part in parts:
        index = index.insert(part)
    cols = ("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert _rows(index.apply(docs), *cols) == _rows(linededup.line_dedup(docs), *cols)


def test_line_index_in_a_folder(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(linededup, "GENERATIONS", 2)
    d = spark.createDataFrame([(i, "a line that three documents hold" + "\nand a line of its own, number %d" % i) for i in range(5)], "doc_id long, text string")
    index = linededup.LineIndex(spark, shards=8, folder=str(tmp_path))
    for i in range(5):
        index = index.insert(d.where(f"doc_id = {i}"))
        assert len({*index.refs_of.values()}) <= 2
    index.save()
    again = linededup.LineIndex.load(spark, str(tmp_path))
    assert _index_state(again) == _index_state(index) and again.refs.count() == 10
    assert sorted((r.doc_id, r.n_dropped) for r in again.apply(d).collect()) == [(0, 1), (1, 1), (2, 1), (3, 1), (4, 0)]


def test_line_dedup_when_filters_are_not_sent(docs, monkeypatch):
    monkeypatch.setattr(linededup, "FILTERS_MOST", -1)
    monkeypatch.setattr(linededup, "SHARD_KEYS", 2)
    monkeypatch.setattr(linededup, "PROBE_ROWS", 5)
    assert _rows(linededup.line_dedup(docs), "doc_id", "n_lines", "n_dropped", "kept_sha256") == _sql(docs, linededup.ORACLE_SQL)


@settings(max_examples=20, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), min_size=1, max_size=400), st.integers(0, 100))
def test_cuckoo_filter(values, k):
    h = np.asarray(sorted(values), np.uint64)
    f = linededup.CuckooFilter.of(h)
    assert f.contains(h).all()
    gone = h[: min(k, len(h))]
    f.delete(gone)
    assert linededup.CuckooFilter.frombytes(f.tobytes()).contains(h[len(gone) :]).all()


def test_language(spark, docs, empty):
    rnd = random.Random(4)
    words = {"aa": ["kato", "mika", "tomi", "kiko"], "bb": ["zwer", "grum", "schlz", "brug"], "cc": ["été", "ça", "naïve", "œuvre"]}
    rows = [(i, " ".join(rnd.choice(words[c]) for _ in range(rnd.randrange(5, 60))), c) for i, c in enumerate(sorted(words) * 100)]
    d = spark.createDataFrame(rows + [(900, None, "aa"), (901, "123 456", "aa"), (902, "kato mika", None), (None, "zwer grum schlz", "bb")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(d).collect()}
    tested = [r for i, r in got.items() if i is not None and i < 900 and r.held_out]
    assert {r.doc_id for r in tested} == {i for i in range(300) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert sum(r.lang_pred == sorted(words)[r.doc_id % 3] for r in tested) / len(tested) > 0.95
    assert (got[900].lang_pred, got[900].score, got[901].lang_pred, got[None].held_out) == ("und", 0.0, "und", True)
    assert langid.identify(empty).count() == 0


def _sampled(monkeypatch, d, **bounds):
    for k, v in bounds.items():
        monkeypatch.setattr(langid, k, v)
    seen = []
    monkeypatch.setattr(langid, "fit", lambda pieces, label, langs: seen.append((pieces, label, langs)))
    langid.train(d)
    return seen[0]


def test_language_sample_is_bounded(spark, monkeypatch):
    """Long texts are learned from in windows that reach to their ends; each language has its share of what fits."""
    rows = [(i, "kato " * 20 + "mika " * (400 if i % 10 else 3) + "tomi " * 20, "aa" if i % 2 else "bb") for i in range(200)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces_, label, langs = _sampled(monkeypatch, d, DOC_BYTES=480, MOST_BYTES=4800)
    assert langs == ["aa", "bb"] and 0 < len(label) * langid.WINDOW <= 4800 + 20 * langid.WINDOW
    assert 0.3 < (label == 0).mean() < 0.7
    assert any(b"kato" in p.tobytes() for p in pieces_) and any(b"tomi" in p.tobytes() for p in pieces_)


def test_rare_languages_stay_in_the_sample(spark, monkeypatch):
    """Three frequent languages and one of five documents, with a bound that cuts: all five are learned from."""
    rows = [(i, f"{i} word " * 30, "abc"[i % 3]) for i in range(1500)] + [(5000 + i, f"{i} rare " * 30, "rare") for i in range(9) if zlib.crc32(str(5000 + i).encode()) % 4 != 2][:5]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    pieces_, label, langs = _sampled(monkeypatch, d, MOST_BYTES=12_000)
    assert langs == ["a", "b", "c", "rare"] and len({p.tobytes() for p in pieces_[label == 3] if b"rare" in p.tobytes()}) >= 5
    share = [(label == k).sum() for k in range(4)]
    assert max(share) <= 3 * min(share)


def test_samples_of_repeated_rows_are_bounded(spark, monkeypatch):
    """6,000 rows of one labelled id count as one document, whatever their texts."""
    rows = [(1, f"kato mika {i % 7} " * 9, "aa") for i in range(6000)] + [(i, f"brug {i} " * 9, "bb") for i in range(2, 40)]
    d = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    _, label, langs = _sampled(monkeypatch, d)
    assert langs == ["aa", "bb"] and (label == 0).sum() <= 2
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "_platt", lambda z, y: seen.append(len(z)) or (1.0, 0.0))
    quality.train(d, labels, sample=10, epochs=1)
    assert seen and seen[0] <= 10


def _a_network(langs, windows=40):
    rng = np.random.default_rng(0)
    return langid.fit(rng.integers(97, 110, (windows, 24)).astype(np.uint8), rng.integers(0, len(langs), windows), langs, epochs=2, batch=8)


def _slow(net, text, segment, warm):
    """Probabilities of each byte and their mean by plain loops over one text."""
    h, text = langid.HIDDEN, text.encode()

    def run(way, part):
        state, out = np.zeros(h), []
        for byte in part:
            a, b = net.x[way][byte].astype(float), state @ net.u[way].astype(float)
            z, r = (np.clip((a[k : k + h] + b[k : k + h]) / 4 + 0.5, 0, 1) for k in (0, h))
            c = b[2 * h :] * r + a[2 * h :]
            state = c / (1 + abs(c)) + z * (state - c / (1 + abs(c)))
            out.append(state)
        return out

    total = np.zeros(len(net.langs))
    for s in range(0, len(text), segment):
        e = min(len(text), s + segment)
        lo, hi = max(0, s - warm), min(len(text), e + warm)
        there, back = run(0, text[lo:e])[s - lo :], run(1, text[s:hi][::-1])[hi - e :][::-1]
        for x, y in zip(there, back, strict=True):
            p = np.exp(x @ net.out[0] + y @ net.out[1] + net.bias)
            total += p / p.sum()
    return total / max(1, len(text))


@pytest.mark.parametrize(("segment", "warm"), [(4096, 64), (10, 4), (7, 0)])
def test_pooled_probabilities(texts, monkeypatch, segment, warm):
    net = _a_network(["a", "b", "c"])
    some = [t or "" for t in texts.values() if len(t or "") < 700]
    monkeypatch.setattr(langid, "SEGMENT", segment)
    monkeypatch.setattr(langid, "WARM", warm)
    got = langid.document_probabilities(net, *tv.utf8(pa.array(some)))
    assert got == pytest.approx(np.asarray([_slow(net, t, segment, warm) for t in some]), abs=1e-4)


def test_backpropagation():
    rng = np.random.default_rng(0)
    piece, label = rng.integers(97, 110, (5, 40)).astype(np.uint8), np.asarray([0, 1, 2, 0, 1])
    net = _a_network(["a", "b", "c"])
    net.x, net.u, net.out, net.bias = (p.astype(np.float64) for p in net.params())

    def loss():
        return -np.log(langid.forward(net, piece)[0][:, np.arange(5), label]).sum()

    p, states, kept = langid.forward(net, piece)
    d = p.copy()
    d[:, np.arange(5), label] -= 1
    for q, g in zip(net.params(), langid.backward(net, piece, d, states, kept), strict=True):
        for i in np.argsort(-np.abs(g).reshape(-1))[:4]:
            old, eps = q.reshape(-1)[i], 1e-5
            q.reshape(-1)[i] = old + eps
            up = loss()
            q.reshape(-1)[i] = old - eps
            down = loss()
            q.reshape(-1)[i] = old
            assert (up - down) / (2 * eps) == pytest.approx(g.reshape(-1)[i], rel=1e-3, abs=1e-3)


def test_samples_are_whole_texts(texts):
    some = pa.array([t for t in texts.values()])
    buf, off = tv.utf8(some)
    windows, doc = langid._windows(buf, off, 16)
    for d in range(len(some)):
        assert windows[doc == d].tobytes().rstrip(b" ") == buf[off[d] : off[d + 1]].tobytes().rstrip(b" ")


@pytest.mark.parametrize("scores", ["zipf", "model"])
def test_viterbi(texts, scores):
    v = pieces.Pieces.load(vocabulary("piece_bpe_32k.model"), scores)
    score = {v.text[i]: s for keys, ids, ss, _ in v.by_length.values() for i, s in zip(ids, ss, strict=True)}
    some = [t for t in texts.values() if t and len(t) < 400]
    ids, off = v.encode(pa.array(some))
    for i, t in enumerate(some):
        t = pieces.MARK + t.replace(" ", pieces.MARK)
        best = [0.0] + [-1e18] * len(t)
        for e in range(1, len(t) + 1):
            for s in range(max(0, e - v.longest), e):
                gain = score.get(t[s:e], v.unknown if e - s == 1 else None)
                if gain is not None:
                    best[e] = max(best[e], best[s] + gain)
        own, got, run = ids[off[i] : off[i + 1]].tolist(), 0.0, 0
        for x in own:
            if x in v.byte:
                run += 1
            else:
                got += score[v.text[x]]
        unknown = [c for c in t if c not in score]
        assert run == sum(len(c.encode()) for c in unknown)
        assert got + v.unknown * len(unknown) == pytest.approx(best[-1])


def test_pieces_against_the_library(spark):
    """How near the search comes to the merges of the library's own encoder: words with the same pieces, and pieces a word."""
    import sentencepiece

    path = vocabulary("piece_bpe_32k.model")
    words = sorted({w for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect() for w in (r.text or "").split()})
    library = sentencepiece.SentencePieceProcessor(model_file=path).encode(words)
    ids, off = pieces.Pieces.load(path).encode(pa.array(words))
    same = sum(ids[off[i] : off[i + 1]].tolist() == x for i, x in enumerate(library))
    assert same / len(words) > 0.6 and 0.95 < len(ids) / sum(map(len, library)) < 1.02


def test_long_words_and_texts(texts, monkeypatch):
    v = pieces.Pieces(vocabulary("piece_bpe_32k.model"))
    some = pa.array([*(t for t in texts.values() if t), "ab1日é" * 300, " x" * 50, ""])
    ids, off = v.encode(some)
    monkeypatch.setattr(pieces, "BATCH_BYTES", 40)
    monkeypatch.setattr(pieces, "LONG_WORD", 3)
    v.cache.clear()
    again = v.encode(some)
    assert (off == again[1]).all() and (ids == again[0]).all()
    word = np.asarray([ord(c) for c in pieces.MARK + "unbelievably日" * 20], np.uint64)
    got, n = v.viterbi(word[None])
    assert all((got[0, -n[0] :] == v.viterbi_long(word, block)).all() for block in (1, 7, 100, 10_000))
    whole = repair.encode_texts(some, vocabulary("byte_bpe_50k.json"))
    monkeypatch.setattr(repair.tv, "SUB_BATCH_BYTES", 30)
    repair.tokenizer(vocabulary("byte_bpe_50k.json"))[1].clear()
    parts = repair.encode_texts(some, vocabulary("byte_bpe_50k.json"))
    assert all((x == y).all() for x, y in zip(whole, parts, strict=True))


def test_pieces_round_trip(docs, texts, empty):
    path = vocabulary("piece_bpe_32k.model")
    got = pieces.decode(pieces.encode(docs, path), path).collect()
    assert {r.doc_id: r.decoded for r in got} == {i: (t or "").replace("▁", " ") for i, t in texts.items()}
    bare = pieces.encode(docs, path, keep_text=False)
    assert bare.columns == [c for c in docs.columns if c != "text"] + ["piece_ids"]
    assert {r.doc_id: r.piece_ids for r in bare.collect()} == {r.doc_id: r.piece_ids for r in got}
    r = {x.doc_id: x for x in pieces.round_trip(docs, path).collect()}
    assert all(x.restored == ("▁" not in (texts[i] or "")) for i, x in r.items())
    assert r[0].n_pieces == r[1].n_pieces == 0 and pieces.round_trip(empty, path).count() == 0


def test_substrings(docs, empty, monkeypatch):
    cols = ("doc_id", "n_words", "n_removed", "kept_sha256")
    want = _sql(docs, substring.ORACLE_SQL)
    assert _rows(substring.substring_dedup(docs), *cols) == want
    monkeypatch.setattr(substring, "SLICE_BYTES", 500)  # defaults of the workers are as they were; the driver's part is not
    monkeypatch.setattr(substring, "BUCKET_CHARS", 2000)
    assert _rows(substring.substring_dedup(docs), *cols) == want
    assert substring.substring_dedup(empty).count() == 0


def test_groups_as_the_engine(spark):
    ids = [0, 1, -1, 2**62, -(2**63), 12345678901]
    got = [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(ids)], "i int, x long").orderBy("i").select(F.pmod(F.xxhash64("x"), F.lit(97))).collect()]
    assert got == substring.group_of(np.asarray(ids, np.int64), 97).tolist()


def test_cover():
    assert substring.cover(13, 20).sum() == 4
    with pytest.raises(ValueError, match="difference cover"):
        substring.cover(17, 20)


def test_shards(docs, texts, empty, spark):
    got = sharding.shard(docs).orderBy("doc_id").collect()
    size = {i: len((t or "").encode()) + 1 for i, t in texts.items()}
    assert {r.doc_id: (r["size"], r.text_crc32) for r in got} == {i: (size[i], zlib.crc32((t or "").encode())) for i, t in texts.items()}
    total, at, slots = sum(size.values()), 0, Counter()
    for r in got:
        assert r.shard == (2 * at + r["size"]) * 16 // (2 * total) and r.slot == slots[r.shard] and r.grown_shard is None
        at += r["size"]
        slots[r.shard] += 1
    assert sharding.shard(empty).count() == 0
    same = spark.createDataFrame([(1, "x")] * 40 + [(None, None)], "doc_id long, text string")
    rows = sharding.shard(same).collect()
    assert sorted((r.shard, r.slot) for r in rows) == [(s, k) for s in range(16) for k in range(Counter(r.shard for r in rows)[s])]


def test_media(docs, texts, empty):
    got = {r.doc_id: r for r in mpeg.media_column(docs).collect()}
    for i, t in texts.items():
        raw = (t or "").encode()
        p = raw + b"\xff" * (max(576, -(-len(raw) // 576) * 576) - len(raw))
        r = got[i]
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
        assert r.media_sha256 == hashlib.sha256(mpeg.pack(p)).hexdigest() and r.samples == len(p) // 576 * 1152 and len(r.frame_offsets) == len(p) // 576
        assert r.index_right and r.hz == 44100 and r.frame_offsets == mpeg.parse(mpeg.pack(p)).offsets.tolist() and "counts=right" in r.feature
    assert mpeg.media_column(empty).count() == 0
    long = docs.sparkSession.createDataFrame([(1, "é" * 700_000), (None, None)], "doc_id long, text string")
    assert {(r.doc_id, r.n_bytes, r.index_right, len(r.frame_offsets)) for r in mpeg.media_column(long).collect()} == {(1, 1_400_000, True, 2431), (None, 0, True, 1)}


def test_mpeg_streams():
    p = bytes(range(256)) * 9
    p = mpeg.pad_payload(p)
    m = mpeg.pack(p)
    s = mpeg.parse(m)
    assert (len(s.offsets), s.bad, s.skipped, s.table, s.table_frames, s.tags) == (4, 0, 0, "Info", 4, ("ID3v2.4",))
    assert s.seconds * 44100 == 4 * 1152 and s.seek(1152) == s.offsets[1] and mpeg.unpack(m) == p
    assert s.table_right and mpeg.parse(m[: s.offsets[-1]]).table_right is False and mpeg.parse(m[s.offsets[0] :]).table_right is None
    wrong = bytearray(m)
    wrong[wrong.index(b"Info") + 11] += 1
    assert mpeg.parse(bytes(wrong)).table_right is False
    dirty = b"junk\xff\xfb" + m + b"TAG" + bytes(125)
    t = mpeg.parse(dirty)
    assert mpeg.unpack(dirty) == p and t.skipped > 0 and "ID3v1" in t.tags
    cut = m[: s.offsets[1]] + b"\x00noise\xff\xe0" + m[s.offsets[1] :]
    assert mpeg.unpack(cut) == p and mpeg.parse(cut).skipped == 8
    broken = bytearray(m)
    broken[s.offsets[2] + 8] ^= 1
    assert mpeg.parse(bytes(broken)).bad == 1
    assert mpeg.parse(b"").samples == 0 and mpeg.parse(b"\xff" * 5000).samples == 0 and mpeg.unpack(b"x") == b""
    assert mpeg.crc16(np.frombuffer(b"123456789", np.uint8)[None])[0] == 0xAEE7
    assert mpeg.header(b"\xff\xfb\x90\x00").size == 417 and mpeg.header(b"\xff\xf3\x40\xc4").samples == 576 and mpeg.header(b"\xff\xff\x90\x00").layer == 1


def test_token_files(docs, texts, empty):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    got = {r.doc_id: r for r in repair.token_files(docs, path).collect()}
    at = 0
    for i in sorted(texts):
        ids = [*t.encode(texts[i] or "", add_special_tokens=False).ids, 0]
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (at, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes()))
        at += len(ids)
    assert repair.token_files(empty, path).count() == 0
    assert repair.encode_texts(pa.array(["a <|endoftext|> b"]), path)[0].tolist() == [64, 220, 50256, 275]


_PARTS = ["a", "Z", "é", "×", "÷", "ß", "Ω", "日", "'", "'s", "'re", " ", "\n", "\t", "\xa0", "\u2003", "\u3000", "1", "٣", ".", "_", "-", "<|", "|>", "<|endoftext|>", "endoftext", "\u0301", "\x1c", "Ɛ", "ɐ", "don't"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(_PARTS), max_size=30).map("".join), max_size=6))
def test_chunks_do_not_change_ids(texts):
    from tokenizers import Tokenizer

    path = vocabulary("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    ids, off = repair.encode_texts(pa.array(texts, pa.string()), path)
    for i, x in enumerate(texts):
        assert ids[off[i] : off[i + 1]].tolist() == t.encode(x, add_special_tokens=False).ids


@settings(max_examples=25, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=3000), st.integers(0, 3000), st.integers(0, 3000))
def test_grammar(ids, a, b):
    x = np.asarray(ids, np.uint32)
    symbols, _ = repair.compress(x, 50257)
    places = Counter(zip(symbols[:-1].tolist(), symbols[1:].tolist(), strict=True)) if len(symbols) else {}
    assert all(n < (2 * repair.LEAST if p[0] == p[1] else repair.LEAST) for p, n in places.items())  # no pair is frequent any more
    block = repair.Block(repair.to_block(x, 50257, [None, 4], np.asarray([0, len(x)]), 11))
    assert block.decode().tolist() == ids and block.doc_ids == [None, 4] and block.before == 11
    lo, hi = min(a, b, len(ids)), min(max(a, b), len(ids))
    assert block.decode_range(lo, hi).tolist() == ids[lo:hi]


def test_pipeline(spark, docs, tmp_path):
    rnd = random.Random(6)
    junk = {1000 + i: " ".join(rnd.choice(["CLICK!!", "buy$$$", "win###"]) + str(rnd.randrange(30)) for _ in range(40)) for i in range(40)}
    texts = dict(enumerate(_texts())) | junk
    more = spark.createDataFrame([(i, t, "en", "hot", len(t)) for i, t in junk.items()], docs.select(*corpus_pipeline.COLUMNS).schema)
    docs = docs.select(*corpus_pipeline.COLUMNS).unionByName(more)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, int(i < 1000), 0) for i in texts if i % 2 == 0], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    good = corpus_pipeline.quality_rules(spark, d, str(tmp_path))
    model = quality.train(d, spark.read.parquet(str(tmp_path / "labels.parquet")))
    kept = {i for i, t in texts.items() if not _base(t)[5] and _p_good(t, model) >= model.threshold}
    assert {r.doc_id for r in good.collect()} == kept
    assert 0 < len(kept) < sum(not _base(t)[5] for t in texts.values())  # the model, too, rejects some
    cut = corpus_pipeline.line_dedup(spark, good, str(tmp_path))
    assert cut.columns == list(corpus_pipeline.COLUMNS) and cut.where("n_chars <> length(text)").count() == 0
    rest = {r.doc_id: r.text for r in cut.collect()}
    single = {r.doc_id for r in corpus_pipeline.near_dedup(spark, cut, str(tmp_path)).collect()}
    assert single == {i for i, c in _components(rest, 80)[1].items() if i == c}
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in out} <= single and all(r.n_pieces == len(r.piece_ids) for r in out)
    v = pieces.Pieces.load(vocabulary("piece_bpe_32k.model"))
    assert all(v.decode(np.asarray(r.piece_ids)) == rest[r.doc_id] for r in out)
    counts, sources = Counter(r.doc_id for r in out), {r.doc_id: r.source for r in docs.collect()}
    mix = mixing.mix(spark.createDataFrame([(i, rest[i], sources[i]) for i in single], "doc_id long, text string, source string"))
    assert {r.doc_id: r.copies for r in mix.collect() if r.copies} == counts
    assert not {i for i in kept if i >= 1000} and len(kept) > 60


def test_pipeline_of_nothing(spark, empty, tmp_path):
    empty.select(*corpus_pipeline.COLUMNS).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_sends_texts_in_small_batches(spark, docs, tmp_path):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    had = spark.conf.getAll.get(key)
    spark.conf.unset(key)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    long = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("word "), 20_000).alias("text"))  # 30 MB
    sizes = lambda batches: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in batches)
    most = lambda: max(r.n for r in long.mapInArrow(sizes, "n long").collect())
    try:
        corpus_pipeline.quality_rules(spark, docs, str(tmp_path))
        assert most() < 5e6
        spark.conf.set(key, "16m")  # a session's own size stays
        corpus_pipeline.sentencepiece(spark, docs, str(tmp_path))
        assert 15e6 < most() < 20e6
    finally:
        spark.conf.unset(key) if had is None else spark.conf.set(key, had)
