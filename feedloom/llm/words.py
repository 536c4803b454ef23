"""Word tables of Arrow text batches, in numpy, for code that runs in tasks.

A chunk of texts becomes one byte buffer with a space after each text; words
are (start, length) pairs into it, and ``bounds[d]:bounds[d+1]`` are the words
of text ``d``. A null text has no words. No text is ever cut: a text longer
than the chunk size is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
#: Words are runs of bytes other than space and 0x09-0x0D, A-Z lower-cased.
SPACE_WORDS = bytes(32 if 9 <= b <= 13 else b for b in _LOWER)
#: Words are runs of 0-9, a-z and everything beyond ASCII, A-Z lower-cased.
ALNUM_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in _LOWER)

_LANE_MASK = np.array([(1 << (8 * n)) - 1 for n in range(8)] + [(1 << 64) - 1], dtype=np.uint64)
_LONG_WORD = 64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finalizer on uint64 (xor-shift and odd multiplications)."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@dataclass
class Words:
    buf: np.ndarray        # uint8, after the byte table
    starts: np.ndarray     # int64, first byte of each word
    lens: np.ndarray       # int64
    bounds: np.ndarray     # int64, words of text d are bounds[d]:bounds[d+1]
    offsets: np.ndarray    # int64, text d begins at byte offsets[d]

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def doc_of(self) -> np.ndarray:
        """The text index of every word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def texts_of(batch: pa.RecordBatch, column: str) -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(column)).cast(pa.binary()).to_pylist()


def split(texts: list[bytes | None], table: bytes) -> Words:
    raw = [t or b"" for t in texts]
    buf = np.frombuffer(b" ".join(raw).translate(table) + b" " * 9, dtype=np.uint8)
    sizes = np.fromiter((len(t) for t in raw), dtype=np.int64, count=len(raw))
    offsets = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum(sizes + 1, out=offsets[1:])
    inside = np.empty(len(buf) + 1, dtype=np.int8)
    inside[0] = 0
    np.not_equal(buf, 32, out=inside[1:].view(np.bool_))
    edge = np.diff(inside)
    starts = np.flatnonzero(edge == 1)
    lens = np.flatnonzero(edge == -1) - starts
    bounds = np.searchsorted(starts, offsets)
    return Words(buf, starts, lens, bounds, offsets)


def hash_words(w: Words) -> np.ndarray:
    """A 64-bit hash of each word, eight bytes at a time."""
    lanes = np.ndarray(shape=(len(w.buf) - 7,), dtype="<u8", buffer=w.buf, strides=(1,))
    h = w.lens.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    active = np.flatnonzero(w.lens <= _LONG_WORD)
    at = 0
    while len(active):
        left = np.minimum(w.lens[active] - at, 8)
        h[active] = mix(h[active] ^ (lanes[w.starts[active] + at] & _LANE_MASK[left]))
        at += 8
        active = active[w.lens[active] > at]
    for i in np.flatnonzero(w.lens > _LONG_WORD):
        s = w.starts[i]
        h[i] = xxhash.xxh3_64_intdigest(w.buf[s:s + w.lens[i]].tobytes())
    return h


def hash_bytes(word: bytes) -> int:
    """``hash_words`` of one word (already lower-cased)."""
    n = len(word)
    buf = np.frombuffer(word + b" " * 9, dtype=np.uint8)
    w = Words(buf, np.array([0]), np.array([n]), np.array([0, 1]), np.array([0, n]))
    return int(hash_words(w)[0])


_SHINGLE = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0x27D4EB2F165667C5, 0x85EBCA77C2B2AE63], dtype=np.uint64)


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of ``n`` consecutive entries (texts not told apart)."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = np.full(m, n, dtype=np.uint64)
    for k in range(n):
        out = mix(out * _SHINGLE[k % 5] + h[k:k + m])
    return out


def find(sorted_keys: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Index of each key in a sorted array without repeats, else -1."""
    if not len(sorted_keys):
        return np.full(len(keys), -1, dtype=np.int64)
    at = np.searchsorted(sorted_keys, keys)
    at[at == len(sorted_keys)] = 0
    return np.where(sorted_keys[at] == keys, at, -1)


def chunks(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``max_bytes`` of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column)).cast(pa.binary())), 0)
        total = np.cumsum(size.to_numpy(zero_copy_only=False).astype(np.int64) + 1)
        at = 0
        while at < batch.num_rows:
            base = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, base + max_bytes, side="right")))
            yield batch.slice(at, to - at)
            at = to


def segments_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of values[bounds[d]:bounds[d+1]]; empty segments are 0."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.float64 if values.dtype.kind == "f" else np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]
