"""Words of many texts at once, as 64-bit hashes, in numpy."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

#: Bytes that are hashed together.
PIECE = 1 << 18

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype="uint8")
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits whose output bits depend on all input bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


#: A number for each byte, for rolling hashes.
VALUE = mix(np.arange(1, 257, dtype="uint64") * _U(_BASE))


@lru_cache(maxsize=2)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first powers of the base of rolling hashes, and of its inverse."""
    up = np.full(n, _BASE, "uint64")
    down = np.full(n, pow(_BASE, -1, 1 << 64), "uint64")
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _hash_piece(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    space = np.concatenate(([True], _SPACE[data], [True]))
    edge = np.flatnonzero(space[1:] != space[:-1])
    begin, end = edge[::2], edge[1::2]
    room = max(PIECE, 1 << (len(data)).bit_length()) + 1
    up, down = powers(room)
    total = np.zeros(len(data) + 1, "uint64")
    np.cumsum(VALUE[_LOWER[data]] * up[: len(data)], out=total[1:])
    return mix((total[end] - total[begin]) * down[begin] + (end - begin).astype("uint64")), begin, end


class Words:
    """``hashes`` of all words of all texts; text ``i`` has ``bounds[i]:bounds[i + 1]``.

    Words are runs of bytes other than space, tab, line feed, vertical tab, form feed and
    carriage return; A-Z count as a-z.  ``data`` holds the texts' bytes, each followed by
    a space; ``begin`` and ``end`` are the words' places there.
    """

    def __init__(self, texts):
        coded = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = np.frombuffer(b" ".join([*coded, b""]), "uint8")
        lengths = np.fromiter(map(len, coded), "int64", len(coded)) + 1
        self.offsets = np.concatenate(([0], np.cumsum(lengths)))
        found, at, size = [], 0, len(self.data)
        while at < size:
            stop = min(size, at + PIECE)
            while stop < size:  # up to a space
                spaces = np.flatnonzero(_SPACE[self.data[stop : stop + 4096]])
                if len(spaces):
                    stop += int(spaces[0]) + 1
                    break
                stop += 4096
            stop = min(stop, size)
            hashes, begin, end = _hash_piece(self.data[at:stop])
            found.append((hashes, begin + at, end + at))
            at = stop
        empty = [np.zeros(0, t) for t in ("uint64", "int64", "int64")]
        self.hashes, self.begin, self.end = map(np.concatenate, zip(*found)) if found else empty
        self.bounds = np.searchsorted(self.begin, self.offsets[: len(coded) + 1])
        if len(self.bounds) == 0:
            self.bounds = np.zeros(1, "int64")


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """The sorted distinct ``n``-word shingles of each text, as hashes.

    A text with fewer words has one shingle, the sequence of all; one without words none.
    """
    h = words.hashes
    scale = mix(np.arange(1, n + 1, dtype="uint64") + _U(77)) | _U(1)
    rolled = np.zeros(max(0, len(h) - n + 1), "uint64")
    for k in range(n):
        rolled += h[k : k + len(rolled)] * scale[k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(words.bounds[:-1].tolist(), words.bounds[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(rolled[a : b - n + 1]))
        elif b > a:
            short = (h[a:b] * scale[: b - a]).sum(dtype="uint64") + _U(b - a)
            out.append(mix(np.array([short], "uint64")))
        else:
            out.append(h[:0])
    return out
