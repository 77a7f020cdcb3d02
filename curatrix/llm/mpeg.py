"""MPEG audio as a media column: a lossless container of bytes in Layer III frames, and a parser of such streams.

``pack`` writes an ID3v2 tag, an Info frame (frame and byte counts, a table of 100 seek points) and one MPEG-1 Layer III
frame for each 576 bytes: mono, 44.1 kHz, 192 kbit/s, with a checksum. The side information is that of silence with the
frame's number in its private bits, and the bytes stand in the frame's ancillary data, where players skip them.

``parse`` takes any bytes: it skips tags at either end, looks for the next frame header wherever the stream breaks off (a
header counts if another, or the end, follows at its frame's end), checks the checksums of Layer III frames that have
one, reads Xing, Info and VBRI tables, and gives the exact duration as samples over rate, and the offset of each frame.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .storage import new_path

UNIT = 576
# Fixed values of the MPEG audio header: kbit/s by index, by (version 1, layer) and (versions 2 and 2.5, layer); Hz by version.
_RATES = {
    (1, 1): (0, 32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (0, 32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (0, 32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (0, 32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (0, 8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
_RATES[2, 3] = _RATES[2, 2]
_HZ = {1.0: (44100, 48000, 32000), 2.0: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}


@dataclass
class Header:
    version: float
    layer: int
    crc: bool
    kbps: int
    hz: int
    mono: bool
    size: int
    samples: int

    @property
    def side(self) -> int:
        """Bytes of side information of Layer III."""
        return (17 if self.mono else 32) if self.version == 1 else (9 if self.mono else 17)


def header(b: bytes, at: int = 0) -> Header | None:
    """The frame header at a position; None if there is none, or one of free format."""
    if at + 4 > len(b) or b[at] != 0xFF or b[at + 1] & 0xE0 != 0xE0:
        return None
    version = {0: 2.5, 2: 2.0, 3: 1.0}.get(b[at + 1] >> 3 & 3)
    layer = 4 - (b[at + 1] >> 1 & 3)
    rate, hz = b[at + 2] >> 4, b[at + 2] >> 2 & 3
    if version is None or layer == 4 or rate in (0, 15) or hz == 3 or b[at + 3] & 3 == 2:
        return None
    kbps, hz, pad = _RATES[1 if version == 1 else 2, layer][rate], _HZ[version][hz], b[at + 2] >> 1 & 1
    samples = 384 if layer == 1 else 576 if layer == 3 and version > 1 else 1152
    size = (12000 * kbps // hz + pad) * 4 if layer == 1 else samples * 125 * kbps // hz + pad
    return Header(version, layer, not b[at + 1] & 1, kbps, hz, b[at + 3] >> 6 == 3, size, samples)


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint16) << np.uint16(8)
    for _ in range(8):
        t = (t << np.uint16(1)) ^ np.where(t & 0x8000, np.uint16(0x8005), np.uint16(0))
    return t


_CRC = _crc_table()


def crc16(rows: np.ndarray) -> np.ndarray:
    """The MPEG checksum (polynomial 0x8005, start 0xFFFF) of each row of bytes."""
    c = np.full(len(rows), 0xFFFF, np.uint16)
    for column in rows.T:
        c = (c << np.uint16(8)) ^ _CRC[(c >> np.uint16(8)) ^ column]
    return c


_HEAD = np.frombuffer(b"\xff\xfa\xb0\xc4", np.uint8)  # version 1, Layer III, checksum; 192 kbit/s, 44.1 kHz; mono, original
_FRAME = header(_HEAD.tobytes()).size
_DATA = 4 + 2 + 17  # header, checksum, side information
_ID3 = b"ID3\x04\x00\x00" + bytes([0, 0, 0, 21]) + b"TSSE" + bytes([0, 0, 0, 11]) + b"\x00\x00\x03" + b"ancillary\x00"


def pad_payload(text: bytes) -> bytes:
    return text + b"\xff" * (max(UNIT, -(-len(text) // UNIT) * UNIT) - len(text))


def pack(payload: bytes) -> bytes:
    """A stream that holds a payload of a multiple of 576 bytes."""
    n = len(payload) // UNIT
    frames = np.zeros((n + 1, _FRAME), np.uint8)
    frames[:, :4] = _HEAD
    frames[1:, 7] = (np.arange(n) % 32) << 2  # private bits 3 to 7 of the 9 + 5 first bits of mono side information
    frames[:, 4:6] = crc16(np.concatenate([frames[:, 2:4], frames[:, 6:23]], 1)).astype(">u2").view(np.uint8).reshape(-1, 2)
    frames[1:, _DATA : _DATA + UNIT] = np.frombuffer(payload, np.uint8).reshape(n, UNIT)
    toc = bytes(min(255, int(i * 256 / 100)) for i in range(100))
    info = b"Info" + (7).to_bytes(4, "big") + n.to_bytes(4, "big") + ((n + 1) * _FRAME).to_bytes(4, "big") + toc
    frames[0, _DATA : _DATA + len(info)] = np.frombuffer(info, np.uint8)
    return _ID3 + frames.tobytes()


@dataclass
class Stream:
    """samples / hz is the exact duration; offsets are byte positions of the frames; a table frame is not among them."""

    hz: int = 0
    samples: int = 0
    offsets: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    checked: int = 0
    bad: int = 0
    skipped: int = 0
    table: str = ""
    table_frames: int | None = None
    table_bytes: int | None = None
    table_at: int = 0
    toc: bytes = b""
    end: int = 0
    tags: tuple[str, ...] = ()

    @property
    def seconds(self) -> Fraction:
        return Fraction(self.samples, self.hz) if self.hz else Fraction(0)

    @property
    def table_right(self) -> bool | None:
        """Whether the table's counts, where it has any, are those of what was found: frames after it, and bytes from it to the last frame's end."""
        if not self.table:
            return None
        return self.table_frames in (None, len(self.offsets)) and self.table_bytes in (None, self.end - self.table_at)

    def seek(self, sample: int) -> int:
        """The offset of the frame that holds a sample, from frames of equal length."""
        return int(self.offsets[min(len(self.offsets) - 1, max(0, sample * len(self.offsets) // max(1, self.samples)))])


def _table(b: bytes, at: int, h: Header) -> tuple[str, int | None, int | None, bytes] | None:
    if h.layer != 3:
        return None
    i = at + 4 + 2 * h.crc + h.side
    if b[i : i + 4] in (b"Xing", b"Info") and i + 8 <= at + h.size:
        flags, j = b[i + 7], i + 8
        n = int.from_bytes(b[j : j + 4], "big") if flags & 1 else None
        j += 4 * (flags & 1)
        size = int.from_bytes(b[j : j + 4], "big") if flags & 2 else None
        j += 2 * (flags & 2)
        return b[i : i + 4].decode(), n, size, b[j : j + 100] if flags & 4 else b""
    i = at + 36
    if b[i : i + 4] == b"VBRI":
        return "VBRI", int.from_bytes(b[i + 14 : i + 18], "big"), int.from_bytes(b[i + 10 : i + 14], "big"), b""
    return None


def parse(b: bytes) -> Stream:
    s, tags, at, end = Stream(), [], 0, len(b)
    while b[at : at + 3] == b"ID3" and at + 10 <= end and not any(x & 0x80 for x in b[at + 6 : at + 10]):
        size = b[at + 6] << 21 | b[at + 7] << 14 | b[at + 8] << 7 | b[at + 9]
        tags.append(f"ID3v2.{b[at + 3]}")
        at = min(end, at + 10 + size + 10 * bool(b[at + 5] & 0x10))
    if end - at >= 128 and b[end - 128 : end - 125] == b"TAG":
        tags.append("ID3v1")
        end -= 128
    offsets: list[np.ndarray] = []
    synced = False
    while at < end:
        h = header(b, at)
        whole = h is not None and at + h.size <= end
        if not whole or not (synced or at + h.size == end or header(b, at + h.size) is not None):
            after = b.find(b"\xff", at + 1, end)
            s.skipped += (after if after >= 0 else end) - at
            at, synced = after if after >= 0 else end, False
            continue
        synced = True
        if not len(offsets) and not s.table and (t := _table(b, at, h)):
            s.table, s.table_frames, s.table_bytes, s.toc = t
            s.hz, s.table_at = h.hz, at
            at += h.size
            s.end = at
            continue
        # frames with the same four bytes that follow without a gap are taken together
        n = 1
        if (most := (end - at) // h.size) > 1:
            view = np.frombuffer(b, np.uint8, most * h.size, at).reshape(most, h.size)
            other = np.flatnonzero((view[:, :4] != view[0, :4]).any(1))
            n = int(other[0]) if len(other) else most
        if h.crc and h.layer == 3 and h.size >= 6 + h.side:
            view = np.frombuffer(b, np.uint8, n * h.size, at).reshape(n, h.size)
            want = view[:, 4].astype(np.uint16) << np.uint16(8) | view[:, 5]
            s.checked += n
            s.bad += int((crc16(np.concatenate([view[:, 2:4], view[:, 6 : 6 + h.side]], 1)) != want).sum())
        offsets.append(at + h.size * np.arange(n))
        s.hz, s.samples = h.hz, s.samples + n * h.samples
        at += n * h.size
        s.end = at
    s.offsets = np.concatenate(offsets) if offsets else s.offsets
    s.tags = tuple(tags)
    return s


def unpack(b: bytes, s: Stream | None = None) -> bytes:
    """The payload of a stream that pack() made, from its frames' offsets."""
    s = s or parse(b)
    a = np.frombuffer(b, np.uint8)
    return a[s.offsets[:, None] + np.arange(_DATA, _DATA + UNIT)].tobytes() if len(s.offsets) else b""


_STORED = "doc_id long, n_bytes long, media binary, samples long, hz int, frame_offsets array<long>"
_LONGS = pa.list_(pa.int64())


def _stored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in tv.sub_batches(batches):
        texts = [x or b"" for x in b.column(1).cast(pa.large_binary()).to_pylist()]
        media = [pack(pad_payload(x)) for x in texts]
        found = [parse(x) for x in media]
        columns = [b.column(0), pa.array([len(x) for x in texts], pa.int64()), pa.array(media, pa.binary()), pa.array([s.samples for s in found], pa.int64()), pa.array([s.hz for s in found], pa.int32()), pa.array([s.offsets for s in found], _LONGS)]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "media", "samples", "hz", "frame_offsets"])


def store(docs: DataFrame, path: str) -> None:
    """Write (doc_id, n_bytes, media, samples, hz, frame_offsets): each whole text, null as empty, as an MPEG audio stream, with
    its exact duration (samples / hz) and the byte offset of each frame."""
    d = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_stored, _STORED)
    d.write.option("compression", "zstd").parquet(path)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "index_right"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.bool_()]
    for b in tv.sub_batches(batches, "media", 8 << 20):
        out: list[list] = [[] for _ in names]
        stored = b.column(5)
        flat, size = stored.flatten().to_numpy(), stored.value_lengths().to_numpy()
        for raw, samples, hz, offsets in zip(b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist(), np.split(flat, np.cumsum(size)[:-1]), strict=True):
            s = parse(raw)
            p = unpack(raw, s)
            right = (samples, hz) == (s.samples, s.hz) and np.array_equal(offsets, s.offsets) and s.table_right is not False
            seek = zlib.crc32(s.offsets.astype("<u4").tobytes())
            feature = f"{s.table} frames={len(s.offsets)} of {s.table_frames} bytes={s.table_bytes} counts={'right' if s.table_right else 'wrong'} samples={s.samples} hz={s.hz} crc={s.checked - s.bad}/{s.checked} skipped={s.skipped} tags={'+'.join(s.tags)} seek={seek:08x}"
            for x, y in zip(out, (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]), len(raw), hashlib.sha256(raw).hexdigest(), feature, right), strict=True):
                x.append(y)
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(x, k) for x, k in zip(out, kinds, strict=True)), *(b.column(i) for i in (3, 4, 5))], ["doc_id", "n_bytes", *names, "samples", "hz", "frame_offsets"])


def read(spark, path: str) -> DataFrame:
    """What is stored, read back and parsed: digests of payload and stream, a feature text, the stored duration and frame offsets, and
    whether these and the counts in the stream's table are what the parser finds."""
    kinds = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, index_right boolean, samples long, hz int, frame_offsets array<long>"
    return spark.read.schema(_STORED).parquet(path).mapInArrow(_features, kinds)


def media_column(docs: DataFrame, path: str | None = None) -> DataFrame:
    """store() and read() of docs (doc_id, text). Null and empty texts make one unit of padding; repeated rows and equal
    texts give equal values; other columns are not read; an empty table gives an empty result."""
    path = path or new_path(docs.sparkSession, "media")
    store(docs, path)
    return read(docs.sparkSession, path)
