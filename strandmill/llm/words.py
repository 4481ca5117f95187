"""Words of UTF-8 text as numpy arrays, without a Python object per word.

Texts arrive as Arrow string columns; their bytes are classified by a 256-entry table, and each word gets a
64-bit hash: a polynomial over its bytes (A-Z folded) modulo 2**64, mixed with its length. Equal words have equal
hashes; two given different words share one with a probability of about 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BLOCK = 1 << 18

FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32
#: [^\x20\x09-\x0D]+
SPACED = np.ones(256, bool)
SPACED[[0x20, 9, 10, 11, 12, 13]] = False
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after folding A-Z
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_powers = np.ones(1, U), np.ones(1, U)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 2 * _BLOCK)
        out = []
        for base in (_BASE, _INVERSE):
            x = np.full(n, base, U)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers = tuple(out)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> U(33))
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


@dataclass
class Words:
    """Words of a run of documents: byte ranges and hashes; document i has words first[i] to first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int64 if large else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about limit bytes of text each; a longer text is a slice of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def split_words(data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = ALNUM) -> Words:
    """Maximal runs of bytes of the kind, within each document."""
    n = len(data)
    mask = kind[data]
    if not mask.any():
        none = np.zeros(0, np.int64)
        return Words(none, none, np.zeros(0, U), np.zeros(len(offsets), np.int64))
    edge = np.flatnonzero(mask[1:] != mask[:-1]) + 1
    inner = np.unique(offsets[(offsets > 0) & (offsets < n)])
    cut = inner[mask[inner] & mask[inner - 1]]
    start, end = edge[mask[edge]], edge[~mask[edge]]
    if mask[0]:
        start = np.concatenate([[0], start])
    if mask[-1]:
        end = np.concatenate([end, [n]])
    if len(cut):
        start, end = np.sort(np.concatenate([start, cut])), np.sort(np.concatenate([end, cut]))
    return Words(start, end, hashed(data, start, end), np.searchsorted(start, offsets))


def hashed(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray = FOLD) -> np.ndarray:
    """The hash of each byte range; ranges are in order and don't overlap."""
    out = np.empty(len(start), U)
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(start, start[at] + _BLOCK)))
        low, high = int(start[at]), int(end[to - 1])
        power, inverse = _power_tables(high - low + 1)
        total = np.empty(high - low + 1, U)
        total[0] = 0
        np.cumsum((fold[data[low:high]].astype(U) + U(1)) * power[: high - low], out=total[1:])
        a, b = start[at:to] - low, end[at:to] - low
        out[at:to] = (total[b] - total[a]) * inverse[a] + (b - a).astype(U) * U(0xD6E8FEB86659FD93)
        at = to
    return mix(out)


def shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every run of k words; a document of fewer words, but not none, has the whole run as one."""
    n, count = len(words.hash), np.diff(words.first)
    docs, parts = [], []
    if n >= k:
        total = np.zeros(n - k + 1, U)
        for j in range(k):
            total = total * U(0x100000001B3) + words.hash[j : n - k + 1 + j]
        doc = words.doc
        whole = doc[: n - k + 1] == doc[k - 1 :]
        docs.append(doc[: n - k + 1][whole])
        parts.append(mix(total[whole] + U(k)))
    for d in np.flatnonzero((count > 0) & (count < k)):
        total = U(0)
        with np.errstate(over="ignore"):
            for h in words.hash[words.first[d] : words.first[d + 1]]:
                total = total * U(0x100000001B3) + h
            docs.append(np.array([d]))
            parts.append(mix(np.array([total + U(count[d])])))
    if not docs:
        return np.zeros(0, np.int64), np.zeros(0, U)
    return np.concatenate(docs), np.concatenate(parts)


def bucketed(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64)
