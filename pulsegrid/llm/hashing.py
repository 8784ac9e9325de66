"""Word and word-run hashes in numpy, and compact columns of them for shuffles.

Documents are handled in blocks of some hundred. What a block sends to the task that owns a range of
hashes is one row of packed columns, not a row per hash; answers come back to the block the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_M1, _M2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
_MASK = (1 << 64) - 1


_BLANK = np.zeros(256, bool)
_BLANK[[32, *range(9, 14)]] = True
_WITHIN = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)  # the first n bytes of eight
#: Words of more bytes are hashed one by one, so that a text without blanks takes no step for each eight bytes of it.
_LONG = 64


def words_of(text: str | None, lower: bool) -> list[bytes]:
    """Runs of characters other than space and the controls 9 to 13; A-Z lowered if asked; none for null."""
    if not text:
        return []
    raw = text.encode()
    return (raw.translate(_LOWER) if lower else raw).split()


class Block:
    """Word hashes of some documents, one after the other. Null has no words."""

    def __init__(self, texts: pa.Array | list[str | None], lower: bool):
        if not isinstance(texts, pa.Array):
            texts = pa.array(texts, pa.large_string())
        texts = pa.compute.fill_null(texts, "").cast(pa.large_string())
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        data = texts.buffers()[2] if bounds[-1] > bounds[0] else None
        raw = memoryview(data)[bounds[0] : bounds[-1]].tobytes() if data is not None else b""
        bounds = bounds - bounds[0]
        first, last = _word_bounds(raw, bounds)
        self.words = _word_hashes(raw.translate(_LOWER) if lower else raw, first, last)
        begun = np.searchsorted(first, bounds)
        self.starts, self.ends = begun[:-1], begun[1:]
        self.lengths = self.ends - self.starts
        self.doc = np.repeat(np.arange(len(texts), dtype=np.int64), self.lengths)

    def runs(self, size: int, multiplier: int = _M1) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each run of size words within a document, its first word's place among all)."""
        h = mix(rolling(self.words, size, multiplier))
        at = np.arange(len(h))
        inside = at + size <= self.ends[self.doc[: len(h)]]
        return h[inside], at[inside]


def _word_bounds(raw: bytes, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first byte, one past the last byte) of each word; no word reaches over the bounds of documents."""
    blank = _BLANK[np.frombuffer(raw, np.uint8)]
    edges = bounds[(bounds > 0) & (bounds < len(raw))]
    begins = ~blank
    ends = begins.copy()
    begins[1:] &= blank[:-1]
    ends[:-1] &= blank[1:]
    begins[edges] = ~blank[edges]
    ends[edges - 1] = ~blank[edges - 1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def _word_hashes(raw: bytes, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time; words of more than _LONG bytes by xxhash."""
    size = last - first
    eights = np.ndarray(len(raw) + 1, "<u8", raw + bytes(8), strides=(1,))  # eight bytes from each place on
    h = size.astype(np.uint64) * np.uint64(_M1)
    at = np.flatnonzero(size <= _LONG)
    read = 0
    while len(at):
        piece = eights[first[at] + read] & _WITHIN[np.minimum(size[at] - read, 8)]
        h[at] = mix((h[at] ^ piece) * np.uint64(_M2))
        read += 8
        at = at[size[at] > read]
    for k in np.flatnonzero(size > _LONG).tolist():
        h[k] = xxhash.xxh3_64_intdigest(raw[first[k] : last[k]])
    return h


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64 bits evenly."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def rolling(h: np.ndarray, size: int, multiplier: int) -> np.ndarray:
    """Polynomial hash of every run of size values, by doubling."""
    if len(h) < size:
        return np.empty(0, np.uint64)
    out, width, piece, span, power = None, 0, h, 1, multiplier
    while True:
        if size & 1:
            if out is None:
                out, width = piece, span
            else:
                n = len(h) - width - span + 1
                out = out[:n] * np.uint64(power) + piece[width : width + n]
                width += span
        size >>= 1
        if not size:
            return out[: len(h) - width + 1]
        n = len(piece) - span
        piece = piece[:n] * np.uint64(power) + piece[span : span + n]
        span, power = 2 * span, power * power & _MASK


def slices(batches: Iterator[pa.RecordBatch], rows: int, chars: int = 4_000_000) -> Iterator[pa.RecordBatch]:
    """Batches of at most so many rows and about so many characters of the column text."""
    for whole in batches:
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(whole["text"]), 0)).astype(np.int64)
        at = 0
        while at < whole.num_rows:
            some = sizes[at : at + rows].cumsum()
            n = max(1, int(np.searchsorted(some, chars, "right")))
            yield whole.slice(at, min(n, rows))
            at += min(n, rows)


def bucket_bounds(buckets: int) -> np.ndarray:
    """First 56-bit hash of each bucket but the first."""
    return np.array([k * (1 << 56) // buckets for k in range(1, buckets)], np.uint64)


def pack(values: np.ndarray) -> bytes:
    """Values byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1, write_content_size=True).compress(planes.tobytes())


def unpack(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending 64-bit values as differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return unpack(data, np.uint64).cumsum(dtype=np.uint64)
