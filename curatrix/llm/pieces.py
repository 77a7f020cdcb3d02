"""SentencePiece encoding and decoding by a batched numpy Viterbi search.

The pieces of a model file are read as a unigram model: the segmentation with the largest sum of scores wins, of equal
ones that whose last piece is longer. With scores "model" a piece has the score in the file, which is right for unigram
models; with "zipf", for BPE model files whose scores are ranks of merges, it is minus the logarithm of the rank and a cost
for each piece, which is closest to what merging in the order of ranks gives (see the README for how close). A character that no piece covers counts as unknown at ten below the lowest
score and is written as its UTF-8 bytes. No piece of a model holds a space mark after another character, so a text falls
apart into words that start at spaces; a model for which that is not so is refused. Characters of no piece stand alone.

Distinct words of equal length advance together: the hashes of all substrings of a length are looked up in the sorted
hashes of the pieces of that length at once, and the maxima over lengths are kept as back pointers.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from . import textvec as tv
from .wordcache import WordCache, encode_spans, slices

MARK = "▁"
_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)
SCORES = "zipf"
PIECE_COST = 6.0  # with "zipf", what each piece costs besides: fewer, longer pieces, as merges make them
BATCH_BYTES = 512 << 10  # text that is encoded at once: its tables of 64-bit numbers take about 70 times as much
PIECE_WORDS = 500_000  # distinct words that are remembered from batch to batch
LONG_WORD = 1 << 16  # characters of a word beyond which it is searched piece by piece: the tables take about 200 bytes a character
_loaded: dict[tuple[str, str], Pieces] = {}


class Pieces:
    """The vocabulary of a SentencePiece model file with byte fallback."""

    def __init__(self, path: str, scores: str = SCORES):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        if n >= 1 << 16:
            raise ValueError("vocabularies of 65536 pieces or more are not supported")
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.byte = np.full(256, -1, np.int64)
        normal = []
        for i, piece in enumerate(self.text):
            if sp.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                normal.append(i)
        if (self.byte < 0).any() or any(not re.fullmatch(f"{MARK}*[^{MARK}]*", self.text[i]) for i in normal):
            raise ValueError("a model with byte fallback whose pieces have space marks only in front is needed")
        score = np.asarray([sp.get_score(i) for i in range(n)])
        if scores == "zipf":
            rank = np.argsort(np.argsort(-score[normal], kind="stable"))
            score[normal] = -np.log(rank + 1.0) - PIECE_COST
        self.unknown = float(score[normal].min()) - 10
        self.longest = max(len(self.text[i]) for i in normal)
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = {}
        for length in range(1, self.longest + 1):
            ids = np.asarray([i for i in normal if len(self.text[i]) == length], np.int64)
            if len(ids):
                codes = np.asarray([[ord(c) for c in self.text[i]] for i in ids], np.uint64)
                keys = self._hash(codes, length)[:, 0]
                order = np.argsort(keys)
                maybe = np.zeros(1 << 18, bool)
                maybe[(keys >> _U(46)).astype(np.int64)] = True
                self.by_length[length] = keys[order], ids[order], score[ids[order]], maybe
        self.alone = bytes(b for b in range(128) if b != 32 and not any(chr(b) in self.text[i] for i in normal))
        self.raw = [bytes([int(x[3:5], 16)]) if sp.is_byte(i) else b"" if sp.is_control(i) else x.replace(MARK, " ").encode() for i, x in enumerate(self.text)]
        self.cache = WordCache(PIECE_WORDS)

    @classmethod
    def load(cls, path: str, scores: str = SCORES) -> Pieces:
        if (path, scores) not in _loaded:
            _loaded[path, scores] = cls(path, scores)
        return _loaded[path, scores]

    @staticmethod
    def _hash(codes: np.ndarray, length: int) -> np.ndarray:
        """Hashes of all windows of a length in each row."""
        n = codes.shape[1] - length + 1
        h = np.zeros((codes.shape[0], n), np.uint64)
        for k in range(length):
            h = h * _BASE + codes[:, k : k + n] + _U(1)
        return tv.mix(h)

    def _gains(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The score and id of the piece of each length that begins at each character of each word (n, L): (lengths, n, L)."""
        n, length = codes.shape
        most = min(self.longest, length)
        gain = np.full((most + 1, n, length), -np.inf, np.float64)  # by piece length and first character
        ident = np.full((most + 1, n, length), -1, np.int32)
        rolling = np.zeros_like(codes)
        for k in range(1, most + 1):
            width = length - k + 1
            rolling = rolling[:, :width] * _BASE + codes[:, k - 1 : k - 1 + width] + _U(1)
            if k in self.by_length:
                keys, ids, score, maybe = self.by_length[k]
                h = tv.mix(rolling)
                at = np.flatnonzero(maybe[(h >> _U(46)).astype(np.int64)].reshape(-1))
                h = h.reshape(-1)[at]
                i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                hit = keys[i] == h
                row, col = at[hit] // width, at[hit] % width
                gain[k, row, col], ident[k, row, col] = score[i[hit]], ids[i[hit]]
        lone = ident[1] < 0
        gain[1][lone] = self.unknown
        return gain, ident

    def viterbi_long(self, word: np.ndarray, block: int = LONG_WORD) -> np.ndarray:
        """The ids that viterbi() gives for one word, the tables being those of ``block`` characters at a time."""
        n, most = len(word), self.longest
        best, back, ident = np.full(n + most + 1, -np.inf), np.zeros(n + most + 1, np.int16), np.full(n + most + 1, -1, np.int32)
        best[0], lengths = 0, np.arange(1, most + 1, dtype=np.int16)
        for lo in range(0, n, block):
            gain, ids = self._gains(word[None, lo : lo + block + most - 1])
            gain, ids = np.ascontiguousarray(gain[1:, 0].T), np.ascontiguousarray(ids[1:, 0].T)
            k = gain.shape[1]
            for s in range(lo, min(n, lo + block)):
                option = best[s] + gain[s - lo]
                better = option > best[s + 1 : s + 1 + k]  # earlier starts have longer pieces, which stay if equal
                best[s + 1 : s + 1 + k][better] = option[better]
                back[s + 1 : s + 1 + k][better] = lengths[:k][better]
                ident[s + 1 : s + 1 + k][better] = ids[s - lo][better]
        out, at = [], n
        while at:
            out.append(int(ident[at]))
            at -= int(back[at])
        return np.asarray(out[::-1], np.int64)

    def viterbi(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For n words of equal length (n, L): ids in (n, L), filled from the right; an unknown character is -1. And how many."""
        n, length = codes.shape
        most = min(self.longest, length)
        gain, ident = self._gains(codes)
        best = np.empty((length + 1, n))
        best[0] = 0
        back = np.empty((length + 1, n), np.int16)
        for e in range(1, length + 1):
            ks = np.arange(min(most, e), 0, -1)  # the longest first: the first of equal maxima is taken
            option = best[e - ks] + gain[ks, :, e - ks]
            pick = option.argmax(0)
            best[e], back[e] = option[pick, np.arange(n)], ks[pick]
        out, count, at, rows = np.empty((n, length), np.int64), np.zeros(n, np.int64), np.full(n, length), np.arange(n)
        while len(rows):
            k = back[at[rows], rows]
            at[rows] -= k
            count[rows] += 1
            out[rows, length - count[rows]] = ident[k, rows, at[rows]]
            rows = rows[at[rows] > 0]
        return out, count

    def encode_words(self, codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each word, all ids one after another); words are stretches of a text's code points, spaces as marks."""
        size, parts = np.zeros(len(start), np.int64), []
        order = np.argsort(length, kind="stable")
        for lo, hi in self._runs(length[order]):
            rows = order[lo:hi]
            own = codes[start[rows][:, None] + np.arange(length[rows[0]])]
            if own.shape[1] > LONG_WORD:  # a run of one word
                got = self.viterbi_long(own[0])[None]
                count = np.asarray([got.shape[1]])
            else:
                got, count = self.viterbi(own)
            real = np.arange(got.shape[1]) >= got.shape[1] - count[:, None]
            unknown = ((got < 0) & real).any(1)
            if unknown.any():
                lists = [g[r] for g, r in zip(got, real, strict=True)]
                for j in np.flatnonzero(unknown):
                    lists[j] = self._with_bytes(own[j], lists[j])
                count = np.asarray([len(x) for x in lists])
                parts.append(np.concatenate(lists))
            else:
                parts.append(got[real])
            size[rows] = count
        if not parts:
            return size, np.zeros(0, np.int64)
        ordered, ids = size[order], np.concatenate(parts)
        at = np.empty(len(order), np.int64)
        at[order] = np.cumsum(ordered) - ordered
        return size, ids[np.repeat(at - (np.cumsum(size) - size), size) + np.arange(size.sum())]

    def _runs(self, lengths: np.ndarray) -> Iterator[tuple[int, int]]:
        """Stretches of equal length, short enough for the tables of one search to stay small."""
        cut = [0, *(np.flatnonzero(np.diff(lengths)) + 1), len(lengths)]
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            step = max(1, 1_000_000 // int(max(1, lengths[lo]) * self.longest)) if hi > lo and lengths[lo] <= LONG_WORD else 1
            for at in range(lo, hi, step):
                yield at, min(hi, at + step)

    def _with_bytes(self, word: np.ndarray, ids: np.ndarray) -> np.ndarray:
        out, at = [], 0
        for i in ids:
            if i >= 0:
                out.append(int(i))
                at += len(self.text[i])
            else:
                out += [int(self.byte[b]) for b in chr(int(word[at])).encode("utf-8", "replace")]
                at += 1
        return np.asarray(out, np.int64)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(all ids, offsets by text). A text that is not empty gets one space in front, like the library's dummy prefix."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        none, space = pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string())
        texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(space, texts, none))
        buf, off = tv.utf8(texts)
        if not len(buf):
            return np.zeros(0, np.int64), np.zeros(len(off), np.int64)
        space = buf == 32
        begins = np.zeros(len(buf) + 1, bool)
        begins[1:-1] = space[1:] & ~space[:-1]
        lone = np.isin(buf, np.frombuffer(self.alone, np.uint8))
        begins[:-1] |= lone
        begins[1:] |= lone
        begins[off] = True
        begins = begins[:-1]
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(buf))
        parts = []
        for a, b in slices(start, end, BATCH_BYTES):
            own, s, e = buf[start[a] : end[b - 1]], start[a:b] - start[a], end[a:b] - start[a]
            codes = np.frombuffer(own.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).astype(np.uint64)
            codes[codes == 32] = ord(MARK)
            char = np.concatenate([[0], np.cumsum((own & 0xC0) != 0x80)])
            words = lambda s, e, codes=codes, char=char: self.encode_words(codes, char[s], char[e] - char[s])
            parts.append(encode_spans(self.cache, tv.Spans(own), s, e, words))
        ids, size = map(np.concatenate, zip(*parts, strict=True))
        return ids, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(start, off)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of a document's ids: space marks are spaces, byte pieces are joined, the space in front goes."""
        raw = self.raw
        out = b"".join([raw[i] for i in ids.tolist()]).decode("utf-8", "replace")
        return out[1:] if out[:1] == " " else out


def _encode(batches: Iterator[pa.RecordBatch], path: str, column: str, keep_text: bool) -> Iterator[pa.RecordBatch]:
    pieces = Pieces.load(path)
    for b in tv.sub_batches(batches, column, BATCH_BYTES):
        at = b.schema.get_field_index(column)
        ids, off = pieces.encode(b.column(at))
        lists = pa.ListArray.from_arrays(pa.array(off, pa.int32()), pa.array(ids.astype(np.int32)))
        back = [i for i in range(b.num_columns) if keep_text or i != at]
        yield pa.RecordBatch.from_arrays([*map(b.column, back), lists], [*(b.schema.names[i] for i in back), "piece_ids"])


def encode(docs: DataFrame, path: str, column: str = "text", keep_text: bool = True) -> DataFrame:
    """docs with piece_ids array<int>, in place of any such column, and without the texts unless keep_text.

    A null or empty text has no ids; repeated rows have equal ids; empty in, empty out.
    """
    d = docs.drop("piece_ids")
    kept = [f for f in d.schema.fields if keep_text or f.name != column]
    return d.mapInArrow(partial(_encode, path=path, column=column, keep_text=keep_text), StructType([*kept, StructField("piece_ids", ArrayType(IntegerType()))]))


def _decode(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = Pieces.load(path)
    for b in batches:
        made = [None if x is None else pieces.decode(np.asarray(x, np.int64)) for x in b.column(b.schema.get_field_index("piece_ids")).to_pylist()]
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(made, pa.string())], [*b.schema.names, "decoded"])


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """encoded (piece_ids, ...) with decoded, the text again (U+2581, which the format uses for spaces, comes back as a space).

    No ids are an empty text, null ids a null one. Other columns stay, but for one that is named decoded; repeated rows are
    decoded each; empty in, empty out.
    """
    d = encoded.drop("decoded")
    return d.mapInArrow(partial(_decode, path=path), StructType([*d.schema.fields, StructField("decoded", StringType())]))


def _digest(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    pieces = Pieces.load(path)
    for b in batches:
        lists = b.column(2)
        flat, off = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum(pc.fill_null(lists.value_lengths(), 0).to_numpy())])
        crc, sha, back = [], [], []
        for i, text in enumerate(b.column(1).to_pylist()):
            own = flat[off[i] : off[i + 1]]
            got = pieces.decode(own)
            crc.append(zlib.crc32(own.astype("<u4").tobytes()))
            sha.append(hashlib.sha256(got.encode("utf-8", "surrogatepass")).hexdigest())
            back.append(got == (text or ""))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(crc, pa.int64()), pa.array(sha), pa.array(back)], ["doc_id", "n_pieces", "ids_crc32", "decoded_sha256", "restored"])


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, decoded_sha256, restored): encode() and then decode() of each whole text, as digests."""
    d = encode(docs.select(F.col("doc_id").cast("long"), "text"), path)
    return d.mapInArrow(partial(_digest, path=path), "doc_id long, n_pieces long, ids_crc32 long, decoded_sha256 string, restored boolean")
