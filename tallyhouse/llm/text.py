"""Words of UTF-8 texts as numpy arrays: the shared groundwork of the text operators.

All functions work on the bytes of an Arrow batch at once, in slices of about a megabyte, so
memory follows the slice (or the longest single text) and not the table. A null text is an
empty one. Words are runs of bytes of a class; both classes keep every byte of a non-ASCII
character, so runs of bytes are runs of characters.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
#: Powers of a base that a worker keeps; the table of a longer text goes with it.
MOST_POWERS = 1 << 21

#: words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z
ALNUM = np.zeros(256, bool)
ALNUM[ord("0") : ord("9") + 1] = True
ALNUM[ord("a") : ord("z") + 1] = True
ALNUM[128:] = True
#: words ``[^\x20\x09-\x0D]+``
SOLID = np.ones(256, bool)
SOLID[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE = np.random.default_rng(20117).integers(1, 2**63, 256, dtype=np.uint64)
_BASES = (0x9E3779B97F4A7C15 | 5, 0xD1342543DE82EF95 | 5)


_tables: dict[tuple[int, bool], np.ndarray] = {}


def powers(base: int, size: int, inverse: bool = False) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below size. One table a base is kept, of ``MOST_POWERS`` at most."""
    known = _tables.get((base, inverse))
    if known is None or len(known) < size:
        known = np.full(1 << max(10, (size - 1).bit_length()), pow(base, -1, 1 << 64) if inverse else base, np.uint64)
        known[0] = 1
        np.cumprod(known, out=known)
        if len(known) <= MOST_POWERS:
            _tables[base, inverse] = known
    return known[:size]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """A 64-bit hash of each ``values[start:end]``; equal sequences have equal hashes."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    out = sums[ends]
    out -= sums[starts]
    out *= powers(base, len(values) + 1, inverse=True)[starts]
    return mix(out)


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts in one array, and the n + 1 offsets of the texts in it."""
    texts = pc.fill_null(texts, "") if texts.null_count else texts
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in pieces of about ``limit`` bytes of text."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(ends):
        used = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, used + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


class Words:
    """The words of a slice: byte ranges, hashes, and which words belong to which text."""

    def __init__(self, texts: pa.Array, kind: np.ndarray, lower: bool = True):
        raw, self.offsets = utf8(texts)
        self.raw = _LOWER[raw] if lower else raw
        inside = kind[self.raw]
        before = np.zeros(len(inside) + 1, bool)
        before[1:] = inside
        before[self.offsets] = False  # no word runs on into the next text
        self.starts = np.flatnonzero(inside & ~before[:-1])
        after = np.zeros(len(inside) + 1, bool)
        after[:-1] = inside
        after[self.offsets] = False
        self.ends = np.flatnonzero(inside & ~after[1:]) + 1
        #: text i has the words first[i] up to first[i + 1]
        self.first = np.searchsorted(self.starts, self.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def of_text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self, which: int = 0) -> np.ndarray:
        values = _BYTE[self.raw]
        if which:
            values = mix(values + np.uint64(which))
        return range_hash(values, self.starts, self.ends, _BASES[which])

    def windows(self, size: int) -> np.ndarray:
        """Starts of all runs of ``size`` words that lie in one text."""
        if len(self.starts) < size:
            return np.zeros(0, np.int64)
        start = np.arange(len(self.starts) - size + 1)
        return start[self.first[np.searchsorted(self.first, start, "right")] - start >= size]

    def word(self, i: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[i]].tobytes()


def window_hashes(hashes: np.ndarray, starts: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Hash of the word sequence of each window of ``size`` words."""
    return range_hash(hashes, starts, starts + size, _BASES[which] ^ 0x5DEECE66C0)


def cover(starts: np.ndarray, ends: np.ndarray, size: int) -> np.ndarray:
    """Which of ``size`` places lie in at least one of the ranges."""
    step = np.bincount(starts, minlength=size + 1) - np.bincount(ends, minlength=size + 1)
    return np.cumsum(step[:size]) > 0


def per_text(first: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Number of set flags among the words of each text."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
