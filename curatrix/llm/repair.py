"""Token ids in files compressed by Re-Pair grammars (Larsson and Moffat, 1999), with random access.

Documents are range-partitioned by doc_id, so that file order is doc_id order; a partition is a shard. A shard's ids are
written in blocks of about ``BLOCK`` ids, one binary value each, with a grammar of its own: so memory is bounded and a
block can be read alone. In a block the most frequent adjacent pairs are replaced by new symbols round after round, until
no pair has ``LEAST`` places. Symbols stay below 2**16, so the sequence takes two bytes for each; larger vocabularies are
refused. A block holds, little-endian:

    magic "RPG1", u32 base (first rule symbol), u32 rules, u32 symbols, u32 documents, u64 ids before the block in its shard
    u16 left and right of each rule | u32 expansion length of each rule | u16 symbols
    u32 ids before every SAMPLE-th symbol | i64 doc_id of each document (u8 null flags) | u32 ids of each document

The expansion lengths and sampled positions let ``decode_range`` start in the middle of a block.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import partial
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .storage import new_path
from .wordcache import WordCache, encode_spans, slices, stretches

BLOCK, SAMPLE, LEAST, ROUND_RULES, SLOT_BITS = 1 << 19, 1024, 8, 4096, 16
END_ID = 0
_tokenizers: dict[str, tuple] = {}


def _slots(pair: np.ndarray) -> np.ndarray:
    return (pair * np.uint32(0x9E3779B1)) >> np.uint32(32 - SLOT_BITS)


def _without_overlap(at: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Which of the places (ascending) of ranked pairs are taken: of overlapping ones the pair of the lowest rank has all of its own."""
    near = np.diff(at) == 1
    run = np.ones(len(at), bool)
    run[1:] = ~near | (rank[1:] != rank[:-1])  # in a run of one pair, as in aaaa, every second place comes first
    prior = 2 * rank + ((at - at[run][np.cumsum(run) - 1]) & 1)
    taken, most = np.zeros(len(at), bool), np.int32(1 << 30)
    for _ in range(3):
        left, right = np.full(len(at), most), np.full(len(at), most)
        left[1:][near], right[:-1][near] = prior[:-1][near], prior[1:][near]
        new = (prior < left) & (prior < right)
        taken |= new
        prior[new] = most
        prior[1:][near & new[:-1]] = prior[:-1][near & new[1:]] = most
    return taken


def compress(ids: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """(symbols, rules (n, 2)): rule k stands for symbol base + k and holds ids and earlier rules only.

    A round counts the pairs and replaces the most frequent one and those not much rarer, up to ROUND_RULES; rare pairs wait, as a
    frequent one may take their ids. It ends when no pair has LEAST places that don't overlap, or symbols run out. A pair that
    is too rare never becomes frequent again, since its own symbols only get fewer: its places are not looked at any more.
    """
    s, rules, room = ids.astype(np.uint32), np.zeros((0, 2), np.uint32), (1 << 16) - base
    live = np.ones(len(s), bool)  # places whose pair may be frequent
    while len(s) > 1 and len(rules) < room:
        live[-1] = False
        where = np.flatnonzero(live)
        pair = s[where] << np.uint32(16) | s[where + 1]
        ordered = np.sort(pair)
        start = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(pair) else where
        count, key = np.diff(np.append(start, len(pair))), ordered[start]
        full = np.flatnonzero(count >= np.where(key >> np.uint32(16) == key & np.uint32(0xFFFF), 2 * LEAST, LEAST))  # half the places of aa may overlap
        if not len(full):
            break
        full = full[np.argsort(-count[full], kind="stable")]
        own = key[full]
        most = min(room - len(rules), ROUND_RULES, int(np.searchsorted(-count[full], -count[full[0]] / 16, side="right")))
        table = np.full(1 << SLOT_BITS, -1, np.int32)  # pairs share it; one that loses its slot to a more frequent one waits
        table[_slots(own)[::-1]] = np.arange(len(own), dtype=np.int32)[::-1]
        rank = table[_slots(pair)]
        live[where[rank < 0]] = False
        chosen = np.flatnonzero((rank >= 0) & (rank < most))
        at, rule = where[chosen], rank[chosen]
        same = own[rule] == pair[chosen]
        at, rule = at[same], rule[same]
        taken = _without_overlap(at, rule)
        at, rule = at[taken], rule[taken]
        good = np.bincount(rule, minlength=most) >= LEAST  # so it is for the first
        number = np.cumsum(good) - 1
        at, rule = at[good[rule]], number[rule[good[rule]]]
        s[at] = base + len(rules) + rule
        stay = np.ones(len(s), bool)
        stay[at + 1] = False
        live[at] = True
        live[np.maximum(at - 1, 0)] = True
        s, live = s[stay], live[stay]
        rules = np.concatenate([rules, np.stack([own[:most][good] >> np.uint32(16), own[:most][good] & np.uint32(0xFFFF)], 1)])
    return s, rules


def rule_sizes(rules: np.ndarray, base: int) -> np.ndarray:
    """How many ids each rule stands for."""
    size: list[int] = []
    for left, right in rules.tolist():
        size.append((size[left - base] if left >= base else 1) + (size[right - base] if right >= base else 1))
    return np.asarray(size, np.int64)


def expansions(rules: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(length of each symbol's expansion, its place in the pool, the pool of ids)."""
    parts: list[np.ndarray] = []
    for left, right in rules.tolist():
        parts.append(np.concatenate([parts[x - base] if x >= base else np.asarray([x], np.uint32) for x in (left, right)]))
    size = np.concatenate([np.ones(base, np.int64), np.asarray([len(p) for p in parts], np.int64)])
    return size, np.cumsum(size) - size, np.concatenate([np.arange(base, dtype=np.uint32), *parts])


def _expand(symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray, np.ndarray]) -> np.ndarray:
    size, place, pool = table
    n = size[symbols]
    return pool[np.repeat(place[symbols] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def to_block(ids: np.ndarray, base: int, doc_ids: list, lengths: np.ndarray, before: int) -> bytes:
    s, rules = compress(ids, base)
    size = np.concatenate([np.ones(base, np.int64), rule_sizes(rules, base)])
    position = np.concatenate([[0], np.cumsum(size[s])])[:-1][::SAMPLE]
    null = np.asarray([d is None for d in doc_ids], np.uint8)
    doc = np.asarray([d or 0 for d in doc_ids], "<i8")
    head = b"RPG1" + struct.pack("<IIIIQ", base, len(rules), len(s), len(doc_ids), before)
    return b"".join([head, rules.astype("<u2").tobytes(), size[base:].astype("<u4").tobytes(), s.astype("<u2").tobytes(), position.astype("<u4").tobytes(), doc.tobytes(), null.tobytes(), lengths.astype("<u4").tobytes()])


class Block:
    """A block read back."""

    def __init__(self, raw: bytes):
        if raw[:4] != b"RPG1":
            raise ValueError("not a block of this format")
        self.base, rules, symbols, docs, self.before = struct.unpack_from("<IIIIQ", raw, 4)
        at = 4 + struct.calcsize("<IIIIQ")

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            out = np.frombuffer(raw, kind, n, at)
            at += out.nbytes
            return out

        self.rules = take("<u2", 2 * rules).reshape(-1, 2)
        self.rule_size, self.symbols = take("<u4", rules), take("<u2", symbols)
        self.position = take("<u4", -(-symbols // SAMPLE))
        doc, null = take("<i8", docs), take("u1", docs)
        self.doc_ids = [None if x else int(d) for d, x in zip(doc, null, strict=True)]
        self.lengths = take("<u4", docs).astype(np.int64)
        self.table = expansions(self.rules, self.base)

    def decode(self) -> np.ndarray:
        return _expand(self.symbols, self.table)

    def decode_range(self, start: int, stop: int) -> np.ndarray:
        """ids[start:stop] of the block, expanding only the symbols from the sampled position before on."""
        lo = max(0, int(np.searchsorted(self.position, start, side="right")) - 1)
        hi = int(np.searchsorted(self.position, stop, side="left"))
        first = int(self.position[lo]) if len(self.position) else 0
        return _expand(self.symbols[lo * SAMPLE : hi * SAMPLE], self.table)[start - first : stop - first]


def chunk_starts(buf: np.ndarray, off: np.ndarray, added: tuple[bytes, ...] = ()) -> np.ndarray:
    """Byte positions at which a byte-level BPE text can be cut without changing its ids.

    The pattern never joins a character that is not white space to white space after it, and a cut there leaves no look-ahead
    short: so before each ASCII white space that follows a visible ASCII character or a letter of U+00C0 to U+07FF. Nor
    does it join ASCII letters, digits and other visible ASCII characters to one another, but for what follows an
    apostrophe. The names of added tokens are not cut.
    """
    n = len(buf)
    begins = np.zeros(n + 1, bool)
    if n > 1:
        kind = _KIND[buf]
        begins[1:n] = tv.SPACE[buf[1:]] & _safe_end(buf)[:-1]
        begins[1:n] |= (kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0) & (buf[:-1] != 39)
        raw = buf.tobytes() if added else b""
        for name in added:
            at = -1
            while (at := raw.find(name, at + 1)) >= 0:
                begins[at + 1 : at + len(name)] = False
    begins[off] = True
    return np.flatnonzero(begins[:-1])


#: ASCII letters, digits, other visible characters; 0: all else.
_KIND = np.zeros(256, np.uint8)
_KIND[33:127] = 3
_KIND[48:58] = 2
_KIND[65:91] = _KIND[97:123] = 1


def tokenizer(path: str):
    if path not in _tokenizers:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        if t.get_vocab_size() >= 1 << 16:
            raise ValueError("vocabularies of 65536 ids or more are not supported")
        added = t.get_added_tokens_decoder()
        if any(x.lstrip or x.rstrip or x.single_word for x in added.values()):
            raise ValueError("added tokens that take in what stands around them are not supported")
        width = np.zeros(t.get_vocab_size(), np.int64)  # of byte-level tokens, a character stands for a byte
        for token, i in t.get_vocab().items():
            width[i] = len(token.encode()) if i in added else len(token)
        _tokenizers[path] = t, WordCache(), width, tuple(x.content.encode() for x in added.values())
    return _tokenizers[path]


def _safe_end(buf: np.ndarray) -> np.ndarray:
    """Where white space may follow in a new chunk: visible ASCII and the last byte of a letter of U+00C0 to U+07FF."""
    ok = (buf > 32) & (buf < 127)
    ok[1:] |= ((buf[1:] & 0xC0) == 0x80) & (buf[:-1] >= 0xC3) & (buf[:-1] <= 0xDF)
    return ok


def _words(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Which chunks are a run of letters (ASCII and U+00C0 to U+024F but for two signs) with or without a space in front: one word of the pattern."""
    sign = np.zeros(len(buf), bool)
    sign[1:] = (buf[:-1] == 0xC3) & ((buf[1:] == 0x97) | (buf[1:] == 0xB7))
    other = np.zeros(len(buf) + 1, np.int32)
    np.cumsum(~_LETTER[buf] | sign, out=other[1:])
    first = s + (buf[s] == 32)
    return (first < e) & (other[np.minimum(first, e)] == other[e])


#: Bytes of such letters: ASCII letters, leading bytes 0xC3 to 0xC9, continuation bytes.
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0x80:0xC0] = _LETTER[0xC3:0xCA] = True


def _byte_letters() -> str:
    """The character that stands for each byte in byte-level vocabularies: itself where it is printable, else the next free one from U+0100."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(hidden)) for b in range(256))


_LETTERS = _byte_letters()


def _encode_chunks(t, width: np.ndarray, buf: np.ndarray, raw: bytes, s: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each chunk, all ids).

    A chunk that is one word of the pattern goes to the library's model, which spares it the pattern. Others that can stand
    one after another are encoded as texts of some kB, as a call costs more than a chunk.
    """
    size, parts = np.zeros(len(s), np.int64), []
    word = _words(buf, s, e)
    joins = tv.SPACE[buf[s]] & _safe_end(buf)[e - 1] & ~word
    order = np.concatenate([np.flatnonzero(word), np.flatnonzero(joins), np.flatnonzero(~joins & ~word)])
    if word.any():
        long = (e - s)[word]
        letters, tokens = stretches(buf, s[word], long).tobytes().decode("latin-1").translate(_LETTERS), t.model.tokenize
        cut = [0, *np.cumsum(long).tolist()]
        got = [[x.id for x in tokens(letters[i:j])] for i, j in pairwise(cut)]
        size[word] = [len(x) for x in got]
        parts.append(np.fromiter(chain.from_iterable(got), np.int64))
    rest = order[word.sum() :]
    n = int(joins.sum())
    a, z = s[rest[:n]].tolist(), e[rest[:n]].tolist()
    texts = [b"".join([raw[i:j] for i, j in zip(a[k : k + 512], z[k : k + 512], strict=True)]) for k in range(0, n, 512)]
    texts += [raw[i:j] for i, j in zip(s[rest[n:]].tolist(), e[rest[n:]].tolist(), strict=True)]
    parts += [np.asarray(x.ids, np.int64) for x in t.encode_batch_fast([x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    own = ids[size.sum() :]
    begin = np.cumsum(width[own]) - width[own]  # byte at which each token begins
    size[rest] = np.diff(np.concatenate([[0], np.searchsorted(begin, np.cumsum((e - s)[rest]))]))
    at = np.empty(len(s), np.int64)
    at[order] = np.cumsum(size[order]) - size[order]
    return size, stretches(ids, at, size)


def encode_texts(texts: pa.Array, path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, offsets by text), each distinct chunk being encoded by the tokenizers library once."""
    t, cache, width, added = tokenizer(path)
    buf, off = tv.utf8(texts)
    if not len(buf):
        return np.zeros(0, np.uint16), np.zeros(len(off), np.int64)
    start = chunk_starts(buf, off, added)
    end = np.append(start[1:], len(buf))
    parts = []
    for a, b in slices(start, end, tv.SUB_BATCH_BYTES):
        own, at = buf[start[a] : end[b - 1]], start[a]
        encode = partial(_encode_chunks, t, width, own, own.tobytes())
        parts.append(encode_spans(cache, tv.Spans(own), start[a:b] - at, end[a:b] - at, encode))
    ids, size = map(np.concatenate, zip(*parts, strict=True))
    return ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, off)]


def _write(batches: Iterator[pa.RecordBatch], path: str, base: int) -> Iterator[pa.RecordBatch]:
    shard, before, block = TaskContext.get().partitionId(), 0, 0
    docs: list = []
    parts: list[np.ndarray] = []
    held = 0

    def flush() -> pa.RecordBatch:
        nonlocal docs, parts, held, before, block
        lengths = np.asarray([len(p) for p in parts], np.int64)
        raw = to_block(np.concatenate(parts), base, docs, lengths, before)
        out = pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([block], pa.int32()), pa.array([len(docs)], pa.int64()), pa.array([held], pa.int64()), pa.array([raw], pa.binary())], ["shard", "block", "n_docs", "n_ids", "data"])
        before, block, docs, parts, held = before + held, block + 1, [], [], 0
        return out

    for b in tv.sub_batches(batches):
        ids, off = encode_texts(b.column(1), path)
        for i, doc in enumerate(b.column(0).to_pylist()):
            docs.append(doc)
            parts.append(np.append(ids[off[i] : off[i + 1]], END_ID).astype(np.uint32))
            held += len(parts[-1])
            if held >= BLOCK:
                yield flush()
    if docs:
        yield flush()


_FILE = "shard int, block int, n_docs long, n_ids long, data binary"


def write_ids(docs: DataFrame, tokenizer_path: str, path: str) -> None:
    """Write the ids of docs (doc_id, text) with an end id after each, shards and blocks in ascending doc_id order (null first)."""
    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    base = tokenizer(tokenizer_path)[0].get_vocab_size()
    d = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange(n, "doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary"))).sortWithinPartitions("doc_id", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    d.mapInArrow(partial(_write, path=tokenizer_path, base=base), _FILE).write.option("compression", "zstd").parquet(path)


def _read(batches: Iterator[pa.RecordBatch], first: dict[int, int]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for shard, raw in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            k = Block(raw)
            ids = k.decode().astype("<u4")
            off = np.concatenate([[0], np.cumsum(k.lengths)])
            crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(off[:-1], off[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(k.doc_ids, pa.int64()), pa.array(first[shard] + k.before + off[:-1]), pa.array(k.lengths), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_ids(spark, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from written files; the driver sees one total for each shard."""
    files = spark.read.schema(_FILE).parquet(path)
    first, total = {}, 0
    for r in files.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():
        first[r.shard] = total
        total += r.n
    return files.select("shard", "data").mapInArrow(partial(_read, first=first), "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_files(docs: DataFrame, tokenizer_path: str, path: str | None = None) -> DataFrame:
    """write_ids() and read_ids(). A null or empty text has its end id only; rows that share a doc_id follow one another in
    the order of their texts' checksums; a null doc_id comes first; other columns are not read; empty in, empty out."""
    path = path or new_path(docs.sparkSession, "token-files")
    write_ids(docs, tokenizer_path, path)
    return read_ids(docs.sparkSession, path)
