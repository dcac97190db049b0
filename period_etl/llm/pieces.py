"""Cuts texts into the pieces of a byte-pair pre-tokeniser and remembers the ids of each distinct piece.

The pieces are runs of letters, of numbers, of other characters or of white
space, and contractions after an apostrophe. They are found on the code points
of many texts at once, and told apart by a 64-bit hash.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

import numpy as np
import regex

from period_etl.llm.textnp import U64, _powers, mix

SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
#: Endings that form a piece with the apostrophe before them (fixed values).
ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Bytes that a worker's memory of pieces may take before it starts anew.
CACHE_BYTES = 32 << 20


@cache
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            out[ord(m[0][0]):ord(m[0][-1]) + 1] = kind
    return out


@cache
def _symbols() -> np.ndarray:
    return mix((np.arange(0x110000, dtype=U64) + U64(1)) * U64(0x9E3779B97F4A7C15))


def cut(texts: list[str], attach_space: bool) -> tuple[str, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(all texts, where pieces start, where they end, their hashes, pieces of each text).

    With ``attach_space`` a space belongs to the run after it, numbers form
    runs, and the rest of the white space is pieces too; without it, white
    space is dropped and each number character is a piece.
    """
    whole = "".join(texts)
    size = np.array([len(t) for t in texts], np.int64)
    if not whole:
        return whole, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, U64), np.zeros(len(texts), np.int64)
    code = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    kind = classes()[code]
    n = len(code)
    opens = np.zeros(n, bool)                # a text begins here
    first = np.cumsum(size) - size
    opens[first[size > 0]] = True
    start = opens.copy()
    start[1:] |= kind[1:] != kind[:-1]
    closes = np.append(opens[1:], True)      # a text's last character
    blank = kind == SPACE
    # an apostrophe that is a run by itself, with an ending after it
    quote = np.flatnonzero((code == ord("'")) & start & ~closes)
    quote = quote[kind[quote + 1] == LETTER]
    if attach_space:
        quote = quote[opens[quote] | (code[quote - 1] != 32)]
        run_ends = blank & ~closes
        run_ends[:-1] &= ~blank[1:]          # the last white space before a word is a piece, or the word's head
        space_head = run_ends & (code == 32)
        start |= run_ends
        start[1:] &= ~space_head[:-1]
    else:
        start |= kind == NUMBER
    if len(quote):
        tail = np.append(code, [0, 0])
        after = np.append(opens, [True, True])
        one = np.isin(tail[quote + 1], [ord(e) for e in ENDINGS if len(e) == 1])
        two = np.zeros(len(quote), bool)
        for e in (e for e in ENDINGS if len(e) == 2):
            two |= (tail[quote + 1] == ord(e[0])) & (tail[quote + 2] == ord(e[1])) & ~after[quote + 2]
        length = np.where(one, 1, np.where(two, 2, 0))
        quote, length = quote[length > 0], length[length > 0]
        start[quote + 1] = False
        rest = quote + 1 + length
        start[rest[rest < n]] = True
    if attach_space:
        begin = np.flatnonzero(start)
        end = np.append(begin[1:], n)
    else:
        begin = np.flatnonzero(start & ~blank)
        stop = np.append(np.flatnonzero(start), n)
        end = stop[np.searchsorted(stop, begin, "right")]
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(_symbols()[code] * up[:n], out=total[1:])
    hashes = mix((total[end] - total[begin]) * down[begin])
    return whole, begin, end, hashes, np.diff(np.searchsorted(begin, np.append(first, n)))


class PieceCache:
    """Ids of texts from the ids of their pieces; ``encode`` gives those of new pieces, one after the other, and their edges."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], attach_space: bool, limit: int = CACHE_BYTES):
        self.encode, self.attach_space, self.limit = encode, attach_space, limit
        self.clear()

    def clear(self) -> None:
        # two sorted tables hash -> piece number: new hashes go to the small one, which is merged when it has grown
        self.tables = [(np.zeros(0, U64), np.zeros(0, np.int64))] * 2
        self.flat, self.used, self.at, self.count = np.zeros(1 << 16, np.uint32), 0, np.zeros(1 << 14, np.int64), 0

    @property
    def size(self) -> int:
        """The bytes of all tables."""
        return self.flat.nbytes + self.at.nbytes + sum(keys.nbytes + numbers.nbytes for keys, numbers in self.tables)

    @staticmethod
    def _room(array: np.ndarray, n: int) -> np.ndarray:
        return array if len(array) >= n else np.concatenate([array, np.zeros(max(n, 2 * len(array)) - len(array), array.dtype)])

    def _numbers(self, hashes: np.ndarray) -> np.ndarray:
        """The piece number of each hash, -1 for a new one."""
        out = np.full(len(hashes), -1, np.int64)
        for keys, numbers in self.tables:
            if len(keys):
                i = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[i] == hashes, numbers[i], out)
        return out

    def _add(self, hashes: np.ndarray, pieces: list[str]) -> None:
        ids, at = self.encode(pieces)
        n = len(pieces)
        self.flat, self.at = self._room(self.flat, self.used + len(ids)), self._room(self.at, self.count + n + 1)
        self.flat[self.used:self.used + len(ids)] = ids
        self.at[self.count + 1:self.count + n + 1] = self.used + at[1:]
        (keys, numbers), (new, more) = self.tables
        new, more = np.concatenate([new, hashes]), np.concatenate([more, np.arange(self.count, self.count + n)])
        if big := 2 * len(new) > len(keys):
            new, more = np.concatenate([keys, new]), np.concatenate([numbers, more])
        order = np.argsort(new)
        self.tables = [(new[order], more[order]), (keys[:0], numbers[:0])] if big else [(keys, numbers), (new[order], more[order])]
        self.used, self.count = self.used + len(ids), self.count + n

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        if self.size > self.limit:
            self.clear()
        whole, begin, end, hashes, each = cut(texts, self.attach_space)
        distinct, where, piece = np.unique(hashes, return_index=True, return_inverse=True)
        number = self._numbers(distinct)
        new = np.flatnonzero(number < 0)
        if len(new):
            number[new] = np.arange(self.count, self.count + len(new))
            self._add(distinct[new], [whole[a:b] for a, b in zip(begin[where[new]].tolist(), end[where[new]].tolist(), strict=True)])
        i = number[piece]
        size = self.at[i + 1] - self.at[i]
        edge = np.cumsum(size)
        ids = self.flat[np.arange(edge[-1] if len(edge) else 0) + np.repeat(self.at[i] - (edge - size), size)]
        stops = np.append(0, edge)[np.cumsum(each)]
        return np.split(ids, stops[:-1]) if len(texts) else []
