"""Media columns by signature sniffing.

An Aho-Corasick automaton finds every magic byte string in a blob in one pass; the validator of its format then
walks the structure (chunks, blocks, sizes, checksums) and gives the length, or rejects the hit. The largest valid
item at byte 0 gives the type of the blob, whatever was declared; valid items elsewhere are embedded media, which
carve() cuts out. encode_pcm() stores bytes losslessly as 8-bit mono samples of a WAV file.

Nulls: a null blob has a null type and nothing to carve; a null text is an empty one. Empty and very long blobs are
ordinary. Repeated rows are kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.llm.shared import write_table
from strandmill.llm.words import chunks

RATE = 8000


def _u32(b: bytes, at: int, order: str = "<") -> int:
    return struct.unpack_from(order + "I", b, at)[0]


def _riff(b: bytes, at: int) -> int | None:
    """Length of a RIFF file whose chunks fill its declared size exactly."""
    if at + 12 > len(b):
        return None
    end, pos = at + 8 + _u32(b, at + 4), at + 12
    if end > len(b) or end < pos:
        return None
    while pos + 8 <= end:
        pos += 8 + _u32(b, pos + 4) + (_u32(b, pos + 4) & 1)
    return end - at if pos == end else None


def _wav(b: bytes, at: int) -> int | None:
    return _riff(b, at) if b[at + 8 : at + 16] == b"WAVEfmt " else None


def _webp(b: bytes, at: int) -> int | None:
    return _riff(b, at) if b[at + 8 : at + 15] == b"WEBPVP8" else None


def _avi(b: bytes, at: int) -> int | None:
    return _riff(b, at) if b[at + 8 : at + 12] == b"AVI " else None


def _png(b: bytes, at: int) -> int | None:
    """Chunks with right checksums, IHDR first, up to IEND."""
    pos, first = at + 8, True
    while pos + 12 <= len(b):
        size, kind = _u32(b, pos, ">"), b[pos + 4 : pos + 8]
        if pos + 12 + size > len(b) or zlib.crc32(b[pos + 4 : pos + 8 + size]) != _u32(b, pos + 8 + size, ">") or first != (kind == b"IHDR"):
            return None
        pos, first = pos + 12 + size, False
        if kind == b"IEND":
            return pos - at
    return None


def _gif(b: bytes, at: int) -> int | None:
    """Screen, extensions and images, each of length-prefixed blocks, up to the trailer."""

    def blocks(pos: int) -> int | None:
        while pos < len(b):
            if not b[pos]:
                return pos + 1
            pos += 1 + b[pos]
        return None

    if at + 13 > len(b):
        return None
    pos, seen = at + 13 + (3 << ((b[at + 10] & 7) + 1) if b[at + 10] & 128 else 0), False
    while pos is not None and pos < len(b):
        if b[pos] == 0x3B:
            return pos + 1 - at if seen else None
        if b[pos] == 0x21:
            pos = blocks(pos + 2)
        elif b[pos] == 0x2C and pos + 10 <= len(b):
            seen, pos = True, blocks(pos + 11 + (3 << ((b[pos + 9] & 7) + 1) if b[pos + 9] & 128 else 0))
        else:
            return None
    return None


def _jpeg(b: bytes, at: int) -> int | None:
    """Marker segments, with entropy-coded data after each start of scan, up to the end marker."""
    pos, scans = at + 2, 0
    while pos + 2 <= len(b) and b[pos] == 0xFF:
        mark = b[pos + 1]
        if mark == 0xD9:
            return pos + 2 - at if scans else None
        if mark == 0xFF:
            pos += 1
            continue
        if mark == 1 or 0xD0 <= mark <= 0xD8 or mark == 0 or pos + 4 > len(b):
            return None
        pos += 2 + max(2, struct.unpack_from(">H", b, pos + 2)[0])
        if mark == 0xDA:
            scans += 1
            while (pos := b.find(b"\xff", pos)) >= 0 and pos + 1 < len(b) and (b[pos + 1] == 0 or 0xD0 <= b[pos + 1] <= 0xD7):
                pos += 2
            if pos < 0:
                return None
    return None


def _bmp(b: bytes, at: int) -> int | None:
    if at + 26 > len(b):
        return None
    size, start, header = _u32(b, at + 2), _u32(b, at + 10), _u32(b, at + 14)
    return size if header in (12, 40, 52, 56, 108, 124) and 14 + header <= start <= size <= len(b) - at and not _u32(b, at + 6) else None


def _mp4(b: bytes, at: int) -> int | None:
    """Boxes of known kinds from ftyp on; the hit stands 4 bytes into the file."""
    begin = pos = at - 4
    if begin < 0:
        return None
    while pos + 8 <= len(b) and b[pos + 4 : pos + 8] in (b"ftyp", b"moov", b"mdat", b"free", b"skip", b"moof", b"mfra", b"sidx", b"styp", b"uuid", b"meta", b"wide"):
        size = _u32(b, pos, ">")
        if size < 8 or pos + size > len(b):
            return None
        pos += size
    return pos - begin if pos - begin > _u32(b, begin, ">") else None


#: Type, magic bytes, offset of the magic bytes in the file, validator.
FORMATS: list[tuple[str, bytes, int, Callable[[bytes, int], int | None]]] = [
    ("audio/wav", b"RIFF", 0, _wav),
    ("image/webp", b"RIFF", 0, _webp),
    ("video/avi", b"RIFF", 0, _avi),
    ("image/png", b"\x89PNG\r\n\x1a\n", 0, _png),
    ("image/gif", b"GIF87a", 0, _gif),
    ("image/gif", b"GIF89a", 0, _gif),
    ("image/jpeg", b"\xff\xd8\xff", 0, _jpeg),
    ("image/bmp", b"BM", 0, _bmp),
    ("video/mp4", b"ftyp", 4, _mp4),
]


def automaton() -> ahocorasick.Automaton:
    """Magic bytes as text of one character a byte, each with its formats."""
    out = ahocorasick.Automaton()
    for magic in sorted({m for _, m, _, _ in FORMATS}):
        out.add_word(magic.decode("latin-1"), (len(magic), [f for f in FORMATS if f[1] == magic]))
    out.make_automaton()
    return out


def sniff(blob: bytes, machine: ahocorasick.Automaton) -> list[tuple[int, int, str]]:
    """(offset, length, type) of every valid item that isn't inside an earlier one, ascending.

    Items inside a container (a picture in a film) belong to it; peel() looks into a known payload.
    """
    found, over = [], 0
    for end, (size, formats) in machine.iter(blob.decode("latin-1")):
        at = end + 1 - size
        if at - formats[0][2] < over:
            continue
        for kind, _, shift, check in formats:
            length = check(blob, at)
            if length:
                found.append((at - shift, length, kind))
                over = at - shift + length
                break
    return found


def sniff_media(blobs: DataFrame, blob: str = "blob", declared: str = "declared", key: str = "id") -> DataFrame:
    """Per row: key, declared type, the type found at byte 0 (the declared one if none is valid), and whether it was wrong."""
    return _each(blobs, blob, declared, key, False)


def carve(blobs: DataFrame, blob: str = "blob", declared: str = "declared", key: str = "id") -> DataFrame:
    """One row per valid item: key, offset, length, type, bytes. An item at byte 0 that fills the blob is the blob itself."""
    return _each(blobs, blob, declared, key, True)


def _each(blobs: DataFrame, blob: str, declared: str, key: str, parts: bool) -> DataFrame:
    kind = blobs.schema[key].dataType.simpleString()
    schema = f"key {kind}, offset bigint, length bigint, type string, bytes binary" if parts else f"key {kind}, declared string, type string, corrected boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            rows = []
            for k, b, said in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                items = sniff(b, machine) if b is not None else []
                if parts:
                    rows += [(k, at, n, what, b[at : at + n]) for at, n, what in items]
                else:
                    real = next((what for at, _, what in items if at == 0), said)
                    rows.append((k, said, real, real is not None and real != said))
            names = [x.split(" ")[0] for x in schema.split(", ")]
            types = [batch.schema.field(0).type, *((pa.int64(), pa.int64(), pa.string(), pa.binary()) if parts else (pa.string(), pa.string(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return blobs.select(F.col(key).alias("key"), F.col(blob).cast("binary"), F.col(declared).cast("string")).mapInArrow(work, schema)


def padded(data: bytes, unit: int = 64) -> bytes:
    """data and zero bytes up to a positive multiple of unit."""
    return data + bytes(max(unit, -(-len(data) // unit) * unit) - len(data))


def encode_pcm(data: bytes) -> bytes:
    """A WAV file whose 8-bit mono samples are the bytes; their number is even here, so no chunk needs padding."""
    body = data + b"\x80" * (len(data) & 1)
    return b"RIFF" + struct.pack("<I", 36 + len(body)) + b"WAVEfmt " + struct.pack("<IHHIIHH", 16, 1, 1, RATE, RATE, 1, 8) + b"data" + struct.pack("<I", len(data)) + body


def decode_pcm(media: bytes) -> bytes:
    """The samples of the first data chunk."""
    pos = 12
    while pos + 8 <= len(media):
        size = _u32(media, pos + 4)
        if media[pos : pos + 4] == b"data":
            return media[pos + 8 : pos + 8 + size]
        pos += 8 + size + (size & 1)
    raise ValueError("no data chunk")


STORED_SCHEMA = "doc_id bigint, n_bytes bigint, media binary"
FEATURE_SCHEMA = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def store_texts(docs: DataFrame) -> DataFrame:
    """doc_id, bytes of the text, and the text's padded bytes as a WAV file."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chunks(batches, "text"):
            texts = [t or b"" for t in part.column(1).cast(pa.binary()).to_pylist()]
            media = pa.array([encode_pcm(padded(t)) for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([len(t) for t in texts], pa.int64()), media], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(work, STORED_SCHEMA)


def stored_features(stored: DataFrame) -> DataFrame:
    """Reads stored media back: the sniffed item at byte 0 is decoded, its payload digested; the feature tells types and sample statistics."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton()
        for batch in batches:
            rows = []
            for size, media in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                at, length, kind = next((x for x in sniff(media, machine)), (-1, 0, "none"))
                if (at, length) != (0, len(media)):
                    raise ValueError("stored media can't be read back whole")
                payload = decode_pcm(media)
                inside = sniff(payload[:size], machine)
                samples = np.frombuffer(payload, np.uint8)
                level = np.bincount(samples, minlength=256)
                mean = int((level * np.arange(256)).sum()) * 1000 // len(samples)
                feature = f"{kind};rate={RATE};samples={len(samples)};mean_milli={mean};levels={int((level > 0).sum())};embedded={','.join(f'{k}@{a}+{n}' for a, n, k in inside)}"
                rows.append((len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-64:]), len(media), hashlib.sha256(media).hexdigest(), feature))
            cols = list(zip(*rows, strict=True)) or [[]] * 6
            types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            names = [x.split(" ")[0] for x in FEATURE_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *(pa.array(list(c), t) for c, t in zip(cols, types, strict=True))], names)

    return stored.mapInArrow(work, FEATURE_SCHEMA)


def op10_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text stored as audio samples, sniffed and read back."""
    stored, _ = write_table(store_texts(spark.read.parquet(f"{sf_dir}/documents.parquet")), "op10-media")
    return stored_features(stored)
