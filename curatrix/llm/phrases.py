"""Phrases of two to four words that stand together more often than their parts, for each language.

Every task counts its words in tries of depth four, one for each chunk of at most 2^21 words: all windows of four words, sorted
once, are the trie in order. It is cut at the same paths everywhere and written down sorted, level by level, so a range of
paths meets the same range of all other tries in one task and is merged there from the root down; what lies under a phrase that is too
rare is never looked at. Paths are ordered by their words' bytes; cuts come from a sample, which only decides how even the
ranges are. A phrase that begins a cut path may have windows on both sides of the cut; it is open, and its counts are summed up
after the merge.

The walk down a merged trie gives a phrase's left parts. A phrase's suffix link is the phrase without its first word; following
links gives its right parts.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import textvec as tv
from .storage import table

DEPTH, LEAST, PERCENT, TOP, SCALE = 4, 30, 80, 2000, 2_000_000
CHUNK_WORDS = 1 << 20  # of a trie; three of their numbers fit 64 bits
RANGE_BYTES = 8 << 20  # text whose windows are about one range
MOST_RANGES = 1 << 18  # cuts that are sent to all tasks, some 10 MB; beyond 2 TB of text, ranges grow
SAMPLE_TEXTS, SAMPLE_PATHS = 20_000, 256  # texts that cuts come from; paths for each range
TOP_GROUP = 200_000  # phrases that are ranked in one task

HARD = np.zeros(256, bool)
HARD[[*b".,;:!?", 10, 11, 12, 13]] = True
SEPARATOR = HARD.copy()
SEPARATOR[[0x20, 0x09]] = True
_AHEAD = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % (DEPTH - 1))


class _Tokens:
    """Words of a buffer with the documents in it, and how many words follow each in its piece (DEPTH - 1 at most)."""

    def __init__(self, buf: np.ndarray, ends: np.ndarray):
        buf = tv.LOWER[buf]
        sep = SEPARATOR[buf]
        begin, stop = ~sep, ~sep
        inner = ends[:-1][(ends[:-1] > 0) & (ends[:-1] < len(buf))]
        start = begin.copy()
        start[1:] &= sep[:-1]
        start[inner] = begin[inner]
        last = stop.copy()
        last[:-1] &= sep[1:]
        last[inner - 1] = stop[inner - 1]
        self.start, end = np.flatnonzero(start), np.flatnonzero(last) + 1
        off = np.concatenate([[0], np.cumsum(end - self.start)])
        self.words = pa.Array.from_buffers(pa.large_binary(), len(end), [None, pa.py_buffer(off), pa.py_buffer(buf[~sep].tobytes())])
        self.doc = np.searchsorted(ends, self.start, side="right")
        piece = np.cumsum(HARD[buf], dtype=np.int32)[self.start] if len(buf) else np.zeros(0, np.int32)
        self.follow = np.zeros(len(end), np.int8)
        joined = (piece[1:] == piece[:-1]) & (self.doc[1:] == self.doc[:-1])
        for _ in range(DEPTH - 1):
            self.follow[:-1] = np.where(joined, self.follow[1:] + 1, 0)
        np.minimum(self.follow, DEPTH - 1, out=self.follow)


def _segments(raw: bytes, most: int) -> Iterator[tuple[bytes, int]]:
    """A long text as (bytes, bytes of its own): cut between words; what follows are the words that windows reach into."""
    at = 0
    while at < len(raw):
        to = at + most
        if to < len(raw):
            part = np.frombuffer(raw, np.uint8, min(most, len(raw) - at), at)
            seps = np.flatnonzero(SEPARATOR[part])
            if len(seps):
                to = at + int(seps[-1]) + 1
            else:
                found = re.compile(rb"[ \t.,;:!?\n-\r]").search(raw, to)
                to = found.end() if found else len(raw)
        to = min(to, len(raw))
        yield raw[at : _AHEAD.match(raw, to).end()], to - at
        at = to


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, _Tokens]]:
    """(langs of the documents, whether each word is the buffer's own, tokens) of (lang, text), a buffer at a time."""
    for b in tv.sub_batches(batches):
        buf, off = tv.utf8(b.column(1))
        if len(buf) <= 2 * tv.SUB_BATCH_BYTES:
            t = _Tokens(buf, off[1:])
            yield b.column(0), np.ones(len(t.start), bool), t
            continue
        raw = buf.tobytes()  # one text
        for part, own in _segments(raw, tv.SUB_BATCH_BYTES):
            t = _Tokens(np.frombuffer(part, np.uint8), np.asarray([len(part)]))
            yield b.column(0), t.start < own, t


def _ranked(a: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Each value's rank among the distinct ones, and these in the order of their bytes."""
    d = a.dictionary_encode()
    order = pc.sort_indices(d.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[np.asarray(order)] = np.arange(len(order))
    return rank[np.asarray(d.indices)], d.dictionary.take(order)


def _levels(path: list[np.ndarray], count: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sorted distinct paths (a list of columns) as a trie: labels of each level's nodes, and how many children each has; the last: counts."""
    change = np.zeros(len(count), bool)
    change[:1] = True
    labels, first = [], []
    for c in path:
        change[1:] |= c[1:] != c[:-1]
        first.append(np.flatnonzero(change))
        labels.append(c[first[-1]])
    fans = [np.diff(np.searchsorted(b, np.append(a, len(count)))) for a, b in zip(first, first[1:], strict=False)]
    return labels, [*fans, count]


def _packed(*columns: np.ndarray) -> bytes:
    """Columns of whole numbers below 2^32, byte by byte of all numbers together, compressed."""
    sizes = np.asarray([len(c) for c in columns], "<u4")
    planes = [np.ascontiguousarray(np.asarray(c, "<u4").view(np.uint8).reshape(-1, 4).T).tobytes() for c in columns]
    return zstandard.ZstdCompressor(1).compress(b"".join([np.uint32(len(columns)).tobytes(), sizes.tobytes(), *planes]))


def _unpacked(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    sizes, at, out = np.frombuffer(raw, "<u4", n, 4), 4 + 4 * n, []
    for s in sizes.tolist():
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, 4 * s, at).reshape(4, s).T).view("<u4").ravel())
        at += 4 * s
    return out


def _texts_packed(a: pa.Array) -> bytes:
    buf, off = tv.utf8(a)
    return zstandard.ZstdCompressor(1).compress(np.uint32(len(a)).tobytes() + np.diff(off).astype("<u4").tobytes() + buf.tobytes())


def _texts_unpacked(data: bytes) -> pa.Array:
    raw = zstandard.ZstdDecompressor().decompress(data)
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    off = np.concatenate([[0], np.cumsum(np.frombuffer(raw, "<u4", n, 4).astype(np.int64))])
    return pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(off), pa.py_buffer(raw[4 + 4 * n :])])


def _trie(parts: list, cuts: list[tuple]) -> Iterator[tuple[int, bytes, bytes, bytes]]:
    """A chunk's trie, cut: (range, trie, words, langs) of each range that has something."""
    word, words = _ranked(pa.concat_arrays([t.words for _, _, t in parts]))
    langs = [x.cast(pa.large_binary()) for x, _, _ in parts]
    base = np.cumsum([0, *(len(x) for x in langs)])
    lang_of, langs = _ranked(pa.concat_arrays(langs))
    lang = lang_of[np.concatenate([t.doc + b for b, (_, _, t) in zip(base, parts, strict=False)])]
    own, follow = np.concatenate([o for _, o, _ in parts]), np.concatenate([t.follow for _, _, t in parts])
    word = np.append(word + 1, np.zeros(DEPTH, np.int64)).astype(np.uint64)  # 0: no word
    at = np.flatnonzero(own)
    w = [word[at], *(np.where(follow[at] >= k, word[at + k], np.uint64(0)) for k in range(1, DEPTH))]
    bits = np.uint64(len(words).bit_length())
    pair, row = np.unique((((lang[at].astype(np.uint64) << bits) | w[0]) << bits) | w[1], return_inverse=True)
    paths, count = np.unique((((row.astype(np.uint64) << bits) | w[2]) << bits) | w[3], return_counts=True)
    del w, row
    listed, lang_list = words.to_pylist(), langs.to_pylist()

    def place(cut: tuple) -> int:
        got, exact = [], True
        for k, x in enumerate(cut):
            among = listed if k else lang_list
            i = bisect_left(among, x) if exact else 0
            got.append((i + (k > 0) if exact and (x or not k) else 0))
            exact = exact and (not x and k > 0 or i < len(among) and among[i] == x)
        key = (((got[0] << int(bits)) | got[1]) << int(bits)) | got[2]
        i = int(np.searchsorted(pair, np.uint64(key)))
        same = i < len(pair) and int(pair[i]) == key
        tail = (got[3] << int(bits)) | got[4] if same else 0
        return int(np.searchsorted(paths, np.uint64((i << 2 * int(bits)) | tail)))

    mask = np.uint64((1 << int(bits)) - 1)
    bounds = [0, *(place(c) for c in cuts), len(paths)]
    for r, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False)):
        if lo == hi:
            continue
        p = paths[lo:hi]
        head = pair[(p >> (bits * np.uint64(2))).astype(np.int64)]
        columns = [head >> (bits * np.uint64(2)), (head >> bits) & mask, head & mask, (p >> bits) & mask, p & mask]
        used = np.zeros(len(listed) + 1, bool)
        for c in columns[1:]:
            used[c.astype(np.int64)] = True
        used[0] = False
        new = np.cumsum(used)
        labels, fans = _levels([columns[0], *(np.where(c > 0, new[c.astype(np.int64)], 0) for c in columns[1:])], count[lo:hi])
        some = np.flatnonzero(used) - 1
        lang_used, labels[0] = labels[0].astype(np.int64), np.arange(len(labels[0]))
        yield r, _packed(*labels, *fans), _texts_packed(words.take(pa.array(some))), _texts_packed(langs.take(pa.array(lang_used)))


_PIECE = pa.schema([("range", pa.int32()), ("trie", pa.binary()), ("words", pa.binary()), ("langs", pa.binary())])


def _tries(batches: Iterator[pa.RecordBatch], sent) -> Iterator[pa.RecordBatch]:
    held, n = [], 0

    def flush():
        for row in _trie(held, sent.value) if n else ():
            yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(row, _PIECE, strict=True)], schema=_PIECE)

    for part in _texts(batches):
        if n and n + len(part[1]) > CHUNK_WORDS:
            yield from flush()
            held, n = [], 0
        held.append(part)
        n += len(part[1])
    yield from flush()


def _merge(pieces: list[tuple], bounds: tuple, least: int) -> pa.RecordBatch:
    """One range's tries merged from the root down: rows of _NODES. A cut at either end of the range opens the phrases that it begins with."""
    tries = [_unpacked(p[0]) for p in pieces]
    words, langs = [_texts_unpacked(p[1]) for p in pieces], [_texts_unpacked(p[2]) for p in pieces]
    rank, texts = _ranked(pa.concat_arrays(words))
    lang_rank, lang_texts = _ranked(pa.concat_arrays(langs))
    listed, lang_list = texts.to_pylist(), lang_texts.to_pylist()
    depth = DEPTH + 1
    label, fan, count = [], [], [None] * depth
    at = np.cumsum([0, *(len(w) for w in words)])
    lang_at = np.cumsum([0, *(len(x) for x in langs)])
    for k in range(depth):
        if k == 0:
            label.append(np.concatenate([lang_rank[a + t[0].astype(np.int64)] for a, t in zip(lang_at, tries, strict=False)]))
        else:
            label.append(np.concatenate([np.where(t[k] > 0, np.append(rank[a:b], 0)[t[k].astype(np.int64) - 1] + 1, 0) for a, b, t in zip(at, at[1:], tries, strict=False)]))
        fan.append(np.concatenate([t[depth + k] for t in tries]).astype(np.int64))
    del tries, words, langs, rank
    count[-1] = fan[-1]
    for k in range(depth - 2, -1, -1):  # a node's count is that of what lies below
        count[k] = np.add.reduceat(count[k + 1], np.cumsum(fan[k]) - fan[k])
    parent = np.zeros(len(label[0]), np.int64)
    alive = np.ones(len(label[0]), bool)
    phrase, left, is_open, out = None, [], np.ones(1, bool), []
    path_of = {c: 0 for c in bounds if c is not None}  # where each cut's path stands in the level above
    for k in range(depth):
        own = np.flatnonzero(alive)
        if not len(own):
            break
        key, back = np.unique((parent[own] << 32) | label[k][own], return_inverse=True)
        total = np.bincount(back, count[k][own], len(key)).astype(np.int64) if count[k][own].sum() < 1 << 53 else np.asarray([int(x) for x in _object_sum(back, count[k][own], len(key))])
        up, name = key >> 32, key & 0xFFFFFFFF
        opened = np.zeros(len(key), bool)
        for c, i in list(path_of.items()):
            among = listed if k else lang_list
            j = bisect_left(among, c[k])
            path_of.pop(c)
            if (c[k] or not k) and j < len(among) and among[j] == c[k]:
                want = (i << 32) | (j + (k > 0))
                p = int(np.searchsorted(key, want))
                if p < len(key) and key[p] == want:
                    opened[p] = True
                    path_of[c] = p
        keep = ((total >= least) | opened | (k == 0)) & ((name > 0) | (k == 0))
        new = np.cumsum(keep) - 1
        up, name, total, opened = up[keep], name[keep], total[keep], opened[keep]
        path_of = {c: int(new[p]) for c, p in path_of.items()}
        if k == 0:
            lang_now, phrase = lang_texts.take(pa.array(name)), pa.array([b""] * len(name), pa.large_binary())
        else:
            lang_now = lang_now.take(pa.array(up))
            own_word = texts.take(pa.array(name - 1))
            phrase = own_word if k == 1 else pc.binary_join_element_wise(phrase.take(pa.array(up)), own_word, pa.scalar(b" ", pa.large_binary()))
            left = [(v[up], m[up]) for v, m in left]
        out.append((lang_now, phrase, np.full(len(name), k, np.int32), total, list(left), opened if k else np.ones(len(name), bool)))
        if k:
            left.append((total, opened))
        survives = np.zeros(len(label[k]), bool)
        survives[own] = keep[back]
        if k + 1 < depth:
            merged = np.full(len(label[k]), -1, np.int64)
            merged[own] = np.where(keep[back], new[back], -1)
            parent = np.repeat(merged, fan[k])
            alive = parent >= 0
    text = lambda a: a.cast(pa.binary()).cast(pa.string())
    batches = []
    for lang, phrase, at_depth, a, above, o in out:
        lefts = [pa.array(above[i][0], mask=above[i][1]) if i < len(above) else pa.nulls(len(a), pa.int64()) for i in range(DEPTH - 1)]
        batches.append(pa.RecordBatch.from_arrays([text(lang), text(phrase), pa.array(at_depth), pa.array(a), *lefts, pa.array(o)], schema=_NODES))
    return pa.Table.from_batches(batches).combine_chunks().to_batches()


def _object_sum(back: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, object)
    np.add.at(out, back, count.astype(object))
    return out


_NODES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("depth", pa.int32()), ("a", pa.int64()), *((f"l{k}", pa.int64()) for k in range(1, DEPTH)), ("open", pa.bool_())])
_NODE_COLUMNS = "lang string, phrase string, depth int, a long, " + ", ".join(f"l{k} long" for k in range(1, DEPTH)) + ", open boolean"


def _merged(batches: Iterator[pa.RecordBatch], sent, least: int) -> Iterator[pa.RecordBatch]:
    cuts, held, at = sent.value, [], None

    def flush():
        bounds = (cuts[at - 1] if at > 0 else None, cuts[at] if at < len(cuts) else None)
        yield from _merge(held, bounds, least)

    for b in batches:
        for r in range(b.num_rows):
            key = b.column(0)[r].as_py()
            if held and key != at:
                yield from flush()
                held = []
            at = key
            held.append(tuple(b.column(k)[r].as_py() for k in (1, 2, 3)))
    if held:
        yield from flush()


def _sampled(batches: Iterator[pa.RecordBatch], every: int) -> Iterator[pa.RecordBatch]:
    """The path of each ``every``-th word: lang and words, empty after a piece's end."""
    past = 0
    for langs, own, t in _texts(batches):
        at = np.flatnonzero(own)[(-past) % every :: every]
        past += int(own.sum())
        words = pa.concat_arrays([t.words, pa.array([b""], pa.large_binary())])
        cols = [langs.cast(pa.large_binary()).take(pa.array(t.doc[at]))]
        cols += [words.take(pa.array(np.where(t.follow[at] >= k, np.minimum(at + k, len(t.words)), len(t.words)))) for k in range(DEPTH)]
        yield pa.RecordBatch.from_arrays([c.cast(pa.binary()) for c in cols], ["lang", *(f"w{k}" for k in range(DEPTH))])


def cut_paths(texts: DataFrame) -> list[tuple]:
    """Paths (lang and DEPTH words as bytes) that cut (lang, text) into ranges of about RANGE_BYTES of text, from a sample."""
    size, rows = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.count("*")).first()
    ranges = int(min(MOST_RANGES, max(8, -(-size // RANGE_BYTES))))
    share = min(1.0, SAMPLE_TEXTS / max(rows, 1))
    every = max(1, int(size * share / 6 / (SAMPLE_PATHS * ranges)))
    kind = "lang binary, " + ", ".join(f"w{k} binary" for k in range(DEPTH))
    found = texts if share == 1 else texts.sample(share, seed=11)
    paths = sorted(tuple(map(bytes, r)) for r in found.mapInArrow(partial(_sampled, every=every), kind).toLocalIterator())
    if not paths:
        return []
    return sorted({paths[len(paths) * k // ranges] for k in range(1, ranges)})


def frequent(docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """((lang, phrase, depth, a, l1, l2, l3) of all phrases of up to DEPTH words that come ``least`` times, lk being the count of their first k
    words; (lang, n) with n all words of a language)."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(text, F.lit("")).alias("text"))
    cuts = cut_paths(texts)
    sent = spark.sparkContext.broadcast(cuts)
    pieces = texts.mapInArrow(partial(_tries, sent=sent), "range int, trie binary, words binary, langs binary")
    dealt = pieces.repartition(max(len(cuts) + 1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "range").sortWithinPartitions("range")
    nodes = table(dealt.mapInArrow(partial(_merged, sent=sent, least=least), _NODE_COLUMNS), "phrases")
    lefts = [f"l{k}" for k in range(1, DEPTH)]
    opened = table(nodes.where("open").groupBy("lang", "phrase", "depth").agg(F.sum("a").alias("a")), "open-phrases")
    words = opened.where("depth = 0").select("lang", F.col("a").alias("n"))
    opened = opened.where((F.col("depth") > 0) & (F.col("a") >= least))
    none = [F.lit(None).cast("long").alias(c) for c in lefts]
    rows = nodes.where("not open").drop("open").unionByName(opened.select("lang", "phrase", "depth", "a", *none))
    missing = F.lit(False)
    for k, c in enumerate(lefts, 1):
        missing |= (F.col("depth") > k) & F.col(c).isNull()
    rest = rows.where(missing)
    for k, c in enumerate(lefts, 1):
        above = opened.where(F.col("depth") == k).select(F.col("lang").alias("_lang"), F.col("phrase").alias("_first"), F.col("a").alias("_a"))
        rest = rest.join(above, (F.col("lang") == F.col("_lang")) & (F.substring_index("phrase", " ", k) == F.col("_first")) & (F.col("depth") > k) & F.col(c).isNull(), "left")
        rest = rest.withColumn(c, F.coalesce(c, "_a")).drop("_lang", "_first", "_a")
    return table(rows.where(~missing).unionByName(rest), "frequent"), words


def _after_first() -> F.Column:
    return F.expr("substring(phrase, instr(phrase, ' ') + 1)")


def collocations(docs: DataFrame, least: int = LEAST, percent: int = PERCENT, top: int = TOP, lang: str = "lang", text: str = "text") -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language.

    Words are lower-cased (A-Z), pieces end at any of ``.,;:!?`` and line ends. A phrase of two to four words that comes a >= ``least`` times is
    scored at the cut with the lowest floor(SCALE * a / (l + r)), the first of these; it goes if a longer phrase around it comes at
    least ``percent`` times in a hundred as often. Order: score, a (both falling), phrase. A null language is ``und``, a
    null text is empty, a repeated row counts again, languages without such a phrase have no rows, an empty table gives an
    empty result. Long texts are read in segments, whose windows reach into the next.
    """
    rows, words = frequent(docs, least, lang, text)
    level = {k: rows.where(F.col("depth") == k) for k in range(1, DEPTH + 1)}
    links, done = level[1].select("lang", "phrase", "a"), []
    for k in range(2, DEPTH + 1):
        to = links.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_rest"), F.col("a").alias("r1"), *(F.col(f"r{i}").alias(f"r{i + 1}") for i in range(1, k - 1)))
        links = level[k].join(to, (F.col("lang") == F.col("_lang")) & (_after_first() == F.col("_rest"))).drop("_lang", "_rest")
        links = table(links, f"linked-{k}")
        done.append(links)
    scored = []
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    for k, d in enumerate(done, 2):
        score = lambda i: F.expr(f"(cast(a as decimal(20,0)) * {SCALE}) div (cast(l{i} as decimal(20,0)) + cast(r{i} as decimal(20,0)))")
        cuts = [F.struct(score(i).alias("score"), F.lit(i).alias("k"), F.col(f"l{i}").alias("l"), F.col(f"r{i}").alias("r")) for i in range(1, k)]
        d = d.withColumn("_cut", F.array_min(F.array(*cuts)))
        if k < DEPTH:  # a phrase around it that is longer by more has one between them that comes as often
            around = level[k + 1]
            most = around.select("lang", F.substring_index("phrase", " ", k).alias("_in"), "a").unionByName(around.select("lang", _after_first().alias("_in"), "a"))
            most = most.groupBy(F.col("lang").alias("_lang"), "_in").agg(F.max("a").alias("_most"))
            d = d.join(most, (F.col("lang") == F.col("_lang")) & (F.col("phrase") == F.col("_in")), "left")
            d = d.where(F.col("_most").isNull() | (exact("_most") * 100 < exact("a") * percent))
        scored.append(d.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score"))
    every = scored[0]
    for d in scored[1:]:
        every = every.unionByName(d)
    return _first_of(table(every, "scored"), top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _first_of(d: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their rank: first of groups of about TOP_GROUP rows, until one group is left."""
    order = [F.desc("score"), F.desc("a"), "phrase"]
    groups = -(-d.count() // TOP_GROUP)
    while groups > 1:
        place = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(groups))).orderBy(*order))
        d = table(d.withColumn("_place", place).where(F.col("_place") <= top).drop("_place"), "first")
        groups = min(groups - 1, -(-groups * top // TOP_GROUP))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return d.withColumn("rank", rank).where(F.col("rank") <= top)


_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ORACLE_SQL = rf"""
WITH p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_FOLD}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
n AS (SELECT lang, sum(len(w))::BIGINT AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, range(1, 5) AS r(k))),
f AS (SELECT lang, phrase, k, count(*)::BIGINT AS a FROM g GROUP BY lang, phrase, k HAVING count(*) >= {LEAST}),
c AS (SELECT lang, phrase, k, a, unnest(range(1, k)) AS cut, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
s AS (SELECT c.*, x.a AS l, y.a AS r, ((2000000::HUGEINT * c.a) // (x.a + y.a))::BIGINT AS score FROM c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:cut], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[cut + 1:], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
o AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most FROM (
  SELECT lang, a, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM (SELECT lang, a, string_split(phrase, ' ') AS w, unnest(range(2, k)) AS m FROM f WHERE k > 2)) GROUP BY ALL),
z AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.phrase = b.phrase WHERE coalesce(o.most, 0)::HUGEINT * 100 < {PERCENT} * b.a::HUGEINT)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM z) z
JOIN n ON n.lang = z.lang WHERE rank <= {TOP}
"""
