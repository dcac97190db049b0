"""Flat numpy views of Arrow string columns: words, hashes and shingles of whole texts.

A word is a run of bytes other than 0x20 and 0x09-0x0D (the pattern
``[^\\x20\\x09-\\x0D]+``). All hashes are unsigned 64 bit, the same in every
process. Words are compared by their hash; two different words share one with
a probability of about 2**-63.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
_PHI = U64(0x9E3779B97F4A7C15)
#: Odd multipliers of the two polynomials: bytes of a word, words of a shingle.
_P, _K = U64(0x2545F4914F6CDD1D), U64(0xD1342543DE82EF95)
CHUNK_BYTES = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser (xor-shift and multiply) of unsigned 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x = x * U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


_BYTE = mix((np.arange(256, dtype=U64) + U64(1)) * _PHI)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_INV = U64(pow(int(_P), -1, 1 << 64))
_pow = np.ones(1, U64)
_inv = np.ones(1, U64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, n at least; those of longer texts than a chunk are not kept."""
    global _pow, _inv
    if len(_pow) >= n:
        return _pow, _inv
    up, down = np.full(n, _P), np.full(n, _INV)
    up[0] = down[0] = 1
    np.multiply.accumulate(up, out=up)
    np.multiply.accumulate(down, out=down)
    if n <= 2 * CHUNK_BYTES:
        _pow, _inv = up, down
    return up, down


@dataclass
class Words:
    """Words of some texts: buf holds the texts' bytes, text i is buf[edge[i]:edge[i + 1]]."""

    buf: np.ndarray
    edge: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray  # words of text i are first[i]:first[i + 1]

    def __len__(self) -> int:
        return len(self.edge) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self)), self.counts)

    def span_hashes(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """A 64-bit hash of the bytes of each span of buf."""
        up, down = _powers(len(self.buf) + 1)
        if not hasattr(self, "_total"):
            self._total = np.zeros(len(self.buf) + 1, U64)
            np.cumsum(_BYTE[self.buf] * up[:len(self.buf)], out=self._total[1:])
        return mix((self._total[end] - self._total[start]) * down[start])

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        return self.span_hashes(self.start, self.end)


def strings(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """The column as one string array without nulls (a null is empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, one row at least."""
    edge = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    lo = 0
    while lo < len(column):
        hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + limit, "right")) - 1)
        yield lo, min(hi, len(column))
        lo = hi


def words(column: pa.Array, fold: bool = True, apart: np.ndarray = _SPACE) -> Words:
    """Words of each text of a ``strings()`` array; ``fold`` lower-cases A-Z, ``apart`` marks the bytes between words."""
    n = len(column)
    edge = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[edge[0]:edge[-1]] if data and edge[-1] > edge[0] else np.zeros(0, np.uint8)
    edge = edge - edge[0]
    buf = _FOLD[raw] if fold else raw
    inside = np.zeros(len(buf) + 1, bool)
    inside[:-1] = ~apart[buf]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    closes = ~inside
    closes[1:] &= inside[:-1]
    closes[0] = False
    cut = edge[1:-1]
    cut = np.unique(cut[(cut > 0) & (cut < len(buf))])
    opens[cut] = inside[cut]       # a text ends the word of the text before it
    closes[cut] = inside[cut - 1]
    start, end = np.flatnonzero(opens), np.flatnonzero(closes)
    return Words(buf, edge, start, end, np.searchsorted(start, edge))


def shingles(w: Words, k: int, hashes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(text index, hash) of the k-word shingles of each text, in text order.

    A text of fewer words has one shingle, its whole sequence; one without
    words has none.
    """
    h = w.hashes() if hashes is None else hashes
    n, doc = w.counts, w.doc
    if not len(h):
        return np.zeros(0, np.int64), np.zeros(0, U64)
    size = np.minimum(k, n)[doc]                      # words of the shingle that starts here
    place = np.arange(len(h)) - w.first[:-1][doc]
    starts = np.flatnonzero(place <= np.maximum(n[doc] - k, 0))
    out, factor = np.zeros(len(starts), U64), U64(1)
    room = size[starts]
    padded = np.concatenate([h, np.zeros(k, U64)])
    for j in range(k):
        out += np.where(room > j, padded[starts + j], U64(0)) * factor
        factor = U64(int(factor) * int(_K) & (1 << 64) - 1)
    return doc[starts], mix(out + room.astype(U64) * _PHI)
