"""Words and word shingles of whole texts as 64-bit hashes, straight from Arrow's UTF-8 buffers.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r, with A-Z lowered. A shingle is ``k`` words in a row; a
text of fewer words has its whole sequence as its one shingle; a text without words (or NULL) has none. Texts are worked
on in chunks of about half a megabyte, so memory follows the longest text, not the batch. Two different shingles of a
corpus get the same hash with a chance of about one in 2^64 per pair, which all users of this module neglect.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19
K = 5

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; NULL is empty."""
    column = column.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    return (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets from 0) of consecutive rows of about CHUNK_BYTES, one row at least."""
    if len(column) == 0:
        return
    data, offsets = utf8(column)
    row = 0
    while row < len(column):
        last = int(np.searchsorted(offsets, offsets[row] + CHUNK_BYTES, side="right")) - 1
        last = min(max(last, row + 1), len(column))
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


class Words:
    """Tables for splitting and hashing; made once per task."""

    def __init__(self, k: int = K):
        self.k = k
        self.space = np.zeros(256, bool)
        self.space[[32, 9, 10, 11, 12, 13]] = True
        lower = np.arange(256)
        lower[65:91] += 32
        self.codes = mix(lower.astype(np.uint64) + np.uint64(0x51ED270B))
        self.factors = mix(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
        self._grow(CHUNK_BYTES)

    def _grow(self, n: int) -> None:
        """The first ``n`` powers of the hash base and of its inverse modulo 2^64."""
        self.up, self.down = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
        self.up[0] = self.down[0] = 1
        self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)

    def spans(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begin, end and row of every word of a chunk."""
        word = ~self.space[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[offsets] = True
        before = np.r_[False, word[:-1]] & ~edge[:-1]
        after = np.r_[word[1:], False] & ~edge[1:]
        begin = np.flatnonzero(word & ~before)
        end = np.flatnonzero(word & ~after) + 1
        return begin, end, np.searchsorted(offsets, begin, side="right") - 1

    def hashes(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        if len(data) == 0:
            return np.zeros(0, np.uint64)
        if len(data) > len(self.up):
            self._grow(1 << int(len(data)).bit_length())
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.codes[data] * self.up[: len(data)], out=sums[1:])
        return mix((sums[end] - sums[begin]) * self.down[begin] + (end - begin).astype(np.uint64))

    def shingles(self, hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
        """Shingle hashes in text order, and the offsets of the ``rows`` texts among them."""
        k = self.k
        n = np.bincount(row, minlength=rows)
        first = np.r_[0, np.cumsum(n)]
        out, owner = [], []
        if len(hashes) >= k:
            here = np.flatnonzero(row[: len(row) - k + 1] == row[k - 1 :])
            total = np.zeros(len(here), np.uint64)
            for j in range(k):
                total += hashes[here + j] * self.factors[j]
            out.append(mix(total))
            owner.append(row[here])
        for m in range(1, k):
            here = np.flatnonzero(n == m)
            if len(here):
                total = np.full(len(here), m, np.uint64)
                for j in range(m):
                    total += hashes[first[here] + j] * self.factors[j]
                out.append(mix(total))
                owner.append(here)
        if not out:
            return np.zeros(0, np.uint64), np.zeros(rows + 1, np.int64)
        values, owners = np.concatenate(out), np.concatenate(owner)
        if len(out) > 1:
            order = np.argsort(owners, kind="stable")
            values, owners = values[order], owners[order]
        return values, np.r_[0, np.cumsum(np.bincount(owners, minlength=rows))]

    def chunk_shingles(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, shingle hashes, offsets) per chunk."""
        for row, data, offsets in chunks(column):
            begin, end, owner = self.spans(data, offsets)
            yield row, *self.shingles(self.hashes(data, begin, end), owner, len(offsets) - 1)

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The sorted distinct shingle hashes of each row."""
        for _, values, offsets in self.chunk_shingles(column):
            for i in range(len(offsets) - 1):
                yield np.unique(values[offsets[i] : offsets[i + 1]])


def lists(arrays: list[np.ndarray]) -> pa.Array:
    """Arrays of 64-bit hashes as an Arrow column of array<bigint>."""
    offsets = np.r_[0, np.cumsum([len(a) for a in arrays])].astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))
