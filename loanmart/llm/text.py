"""Words and their hashes over whole Arrow columns, for the operators that run in ``mapInArrow``.

All functions work on the bytes of many texts at once, so there is no Python loop over words. A word's hash is a
polynomial over its bytes modulo 2^64, mixed; equal words have equal hashes, and different ones differ but for chance.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_R = np.uint64(0x9E3779B97F4A7C15)
_R_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xD6E8FEB86659FD93)
_POWERS: dict[str, np.ndarray] = {}

#: Bytes worked on at once; a longer text is worked on alone.
CHUNK = 1 << 20


def _lower() -> np.ndarray:
    t = np.arange(1, 257, dtype=np.uint16)
    t[65:91] += 32
    return t


def spaced_codes() -> np.ndarray:
    """Codes by byte for words between white space (\\x20 and \\x09-\\x0D), A-Z lower-cased; 0 separates."""
    t = _lower()
    t[[32, 9, 10, 11, 12, 13]] = 0
    return t


def word_codes() -> np.ndarray:
    """Codes by byte for words of 0-9, A-Z lower-cased, a-z and every character beyond ASCII; 0 separates."""
    t = _lower()
    for a, b in ((0x00, 0x30), (0x3A, 0x41), (0x5B, 0x61), (0x7B, 0x80)):
        t[a:b] = 0
    return t


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        size = max(n, CHUNK + 1)
        for key, r in (("up", _R), ("down", _R_INVERSE)):
            p = np.full(size, r, dtype=np.uint64)
            p[0] = 1
            _POWERS[key] = np.cumprod(p)
    return _POWERS["up"], _POWERS["down"]


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    h = (h ^ (h >> np.uint64(29))) * _R
    return h ^ (h >> np.uint64(32))


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column's texts end to end, and where each begins (one offset more than texts); null is empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_string())
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches, column: str = "text") -> Iterator[pa.RecordBatch]:
    """The batches cut into runs of rows of about ``CHUNK`` bytes of text, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, done + CHUNK, side="right")))
            yield batch.slice(at, to - at)
            at = to


@dataclass
class Words:
    """Words of many texts: byte range, number of the text, hash; ``bounds[i]:bounds[i+1]`` are the words of text i."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def place(self) -> np.ndarray:
        """Number of each word in its text, from 0."""
        return np.arange(len(self.doc)) - self.bounds[self.doc]


def words(data: np.ndarray, offsets: np.ndarray, codes: np.ndarray) -> Words:
    code = codes[data]
    inside = code > 0
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edge = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))]
    begin[edge] = inside[edge]
    end[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    bounds = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    return Words(starts, ends, doc, span_hashes(code, starts, ends), bounds)


def span_hashes(code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    up, down = _powers(len(code) + 1)
    total = np.zeros(len(code) + 1, dtype=np.uint64)
    np.cumsum(code.astype(np.uint64) * up[:len(code)], out=total[1:])
    return mixed((total[ends] - total[starts]) * down[starts])


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every run of ``k`` words of one text."""
    n = len(w.doc) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h += w.hash[j:j + n] * np.uint64(pow(int(_R), j + 1, 1 << 64))
    first = np.flatnonzero(w.doc[:n] == w.doc[k - 1:])
    return first, mixed(h[first] + np.uint64(k))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of ``values`` between neighbouring bounds; 0 for an empty range."""
    total = np.zeros(len(values) + 1)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
