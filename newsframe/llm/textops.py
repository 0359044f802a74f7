"""Vectorised word and n-gram hashing over Arrow text columns.

A word is a maximal run of bytes other than ASCII space and U+0009..U+000D;
these bytes never occur inside a multi-byte UTF-8 sequence, so words can be
found on the raw column buffer. A word's 64-bit hash is a polynomial over its
bytes (longer words than ``LONG_WORD``: BLAKE2b) followed by a finaliser; n-gram
hashes combine word hashes in order. Everything is a pure function of the
text, so lost tasks recompute the same values.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
LONG_WORD = 4096
BLOCK = 1 << 18
#: Bytes of text handled at once within a task (one longer text is handled alone).
SLICE_BYTES = 4 << 20
#: The same where a slice has no rows of its own that it adds up: arrays of such slices stay in the processor's cache.
SMALL_SLICE_BYTES = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_tables: list[np.ndarray] = []


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser (splitmix64), as a new array."""
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _tables:
        for base in (_BASE, pow(_BASE, -1, 1 << 64)):
            p = np.full(BLOCK + 1, base, dtype=U64)
            p[0] = 1
            _tables.append(np.multiply.accumulate(p))
    return _tables[0], _tables[1]


class Words:
    """Words of a slice of texts: hash, byte range and document of each."""

    __slots__ = ("data", "hash", "start", "end", "doc", "first", "n_docs")

    def __init__(self, data, hashes, start, end, doc, n_docs):
        self.data, self.hash, self.start, self.end, self.doc, self.n_docs = data, hashes, start, end, doc, n_docs
        self.first = np.searchsorted(doc, np.arange(n_docs + 1))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def ngrams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all k-word windows and the index of each one's first word."""
        n = len(self.hash)
        if n < k:
            return np.zeros(0, U64), np.zeros(0, np.int64)
        at = np.flatnonzero(self.doc[: n - k + 1] == self.doc[k - 1:])
        h = np.full(len(at), k, dtype=U64)
        for j in range(k):
            h = mix(h * U64(0x9FB21C651E98DF25) + self.hash[at + j])
        return h, at


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and the n + 1 offsets into them (null: empty)."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset: col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    raw = col.buffers()[2] if len(col) else None
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[off[0]: off[-1]], off - off[0]


def words(col: pa.Array, lower: bool) -> Words:
    data, off = buffers(col)
    n_docs = len(off) - 1
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[off] = True
    start = ~space
    end = start.copy()
    start[1:] &= space[:-1] | edge[1:-1]
    end[:-1] &= space[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    doc = np.searchsorted(off[1:], s, side="right")
    return Words(data, _hash_words(data, s, e, lower), s, e, doc, n_docs)


def _hash_words(data, s, e, lower) -> np.ndarray:
    up, down = _powers()
    out = np.empty(len(s), dtype=U64)
    long = np.flatnonzero(e - s > LONG_WORD)
    i = 0
    while i < len(s):
        j = i + 1  # a long word is no reason to pass over those behind it
        if e[i] - s[i] <= LONG_WORD:
            j = max(j, int(np.searchsorted(e, s[i] + BLOCK, side="right")))
            lo, hi = int(s[i]), int(e[j - 1])
            b = data[lo:hi]
            v = (_LOWER[b] if lower else b).astype(U64) + U64(1)
            v *= up[: len(v)]
            p = np.zeros(len(v) + 1, dtype=U64)
            np.cumsum(v, out=p[1:])
            a, z = s[i:j] - lo, e[i:j] - lo
            out[i:j] = mix((p[z] - p[a]) * down[a] + (z - a).astype(U64) * U64(0xD6E8FEB86659FD93))
        i = j
    for k in long:
        b = data[s[k]:e[k]]
        out[k] = int.from_bytes(hashlib.blake2b((_LOWER[b] if lower else b).tobytes(), digest_size=8).digest(), "little")
    return out


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows with at most ``most`` bytes of text each
    (a single longer text forms its own run): bounds a task's working memory."""
    for b in batches:
        if not b.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(text)), 0).to_numpy(zero_copy_only=False).astype(np.int64) + 64)
        i = 0
        while i < b.num_rows:
            j = int(np.searchsorted(size, (size[i - 1] if i else 0) + most, side="right"))
            j = max(j, i + 1)
            yield b.slice(i, j - i)
            i = j


def per_doc_unique(h: np.ndarray, doc: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of ``h`` within each document, and n_docs + 1 bounds."""
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    parts = [np.unique(h[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    bounds = np.zeros(n_docs + 1, dtype=np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    return (np.concatenate(parts) if parts else np.zeros(0, U64)), bounds


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))
