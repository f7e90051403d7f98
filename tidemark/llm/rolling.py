"""Hashes of words, and Rabin-Karp hashes of word windows, for many texts at once."""

from __future__ import annotations

import numpy as np

_PIECE_BYTES = 1 << 20
_PIECE_WORDS = 1 << 16
#: Words of a window, at most; two words in a pattern of 64 lose 27 of the 64 bits.
MOST_WORDS = 64
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class RollingHash:
    """Hashes of words, and Rabin-Karp hashes modulo 2**64 of runs of words from running sums.

    A word's hash adds up one random-like number for each byte and its place. A polynomial of the bytes would
    not do: modulo 2**64, strings of 1,024 bytes exist that every odd base confuses. Of runs of words such a
    polynomial is safe as long as they are short (``MOST_WORDS``): a sum of ``value * base**position`` over a
    range, divided by ``base**start``, does not depend on where the range stands; the base is odd, so the
    division is exact.
    """

    def __init__(self, seed: int):
        self.seed = _U(seed << 56)
        self.base = int(_mixed(np.array([seed], np.uint64) + _U(1 << 40))[0]) & ~7 | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self._grow(1 << 12)

    def _grow(self, n: int) -> None:
        for name, base in (("up", self.base), ("down", self.inverse)):
            factors = np.full(n, base, np.uint64)
            factors[0] = 1
            setattr(self, name, np.cumprod(factors, dtype=np.uint64))

    def ranges(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if values.size >= self.up.size:
            self._grow(2 * values.size + 1)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values * self.up[:values.size], dtype=np.uint64)))
        return _mixed((sums[ends] - sums[starts]) * self.down[starts])

    def words(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words that stand in the bytes ``raw`` from ``starts`` to ``ends``, in order and apart."""
        begins = np.zeros(raw.size, np.int64)
        begins[starts[1:]] = np.diff(starts)
        place = np.arange(raw.size) - np.cumsum(begins) - (starts[0] if starts.size else 0)
        values = _mixed((place.astype(np.uint64) << _U(8)) + raw + self.seed)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        return _mixed(sums[ends] - sums[starts] + (ends - starts).astype(np.uint64))

    def windows(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, words: int) -> np.ndarray:
        """Hashes of the windows that begin at the words ``first``; words are ranges of the bytes ``raw``."""
        return self.ranges(self.words(raw, starts, ends), first, first + words)


_HASHES: list[RollingHash] = []


def _of_pieces(pieces: list[list[bytes]], words: int, sides: int) -> list[np.ndarray]:
    if not _HASHES:
        _HASHES.extend((RollingHash(1), RollingHash(2)))
    raw = np.frombuffer(b" ".join(b" ".join(p) for p in pieces), np.uint8)
    gaps = np.flatnonzero(raw == 32)
    starts, ends = np.concatenate(([0], gaps + 1)), np.concatenate((gaps, [raw.size]))
    is_start = np.ones(starts.size, bool)
    for end in np.cumsum([len(p) for p in pieces]).tolist():
        is_start[end - words + 1:end] = False
    first = np.flatnonzero(is_start)
    return [h.windows(raw, starts, ends, first, words) for h in _HASHES[:sides]]


def window_hashes(found: list[list[bytes]], words: int, sides: int = 1) -> list[np.ndarray]:
    """Hashes of every window of ``words`` words of every text, text by text in order.

    ``sides`` independent hash functions (two at most) give an array each. Long texts are hashed in pieces
    that overlap by a window, so the memory needed besides the result does not grow with a text. Windows have
    ``MOST_WORDS`` words at most.
    """
    if words > MOST_WORDS:
        raise ValueError(f"windows of more than {MOST_WORDS} words")
    made: list[list[np.ndarray]] = []
    pieces, size = [], 0
    for w in found:
        for at in range(0, len(w) - words + 1, _PIECE_WORDS):
            pieces.append(w[at:at + _PIECE_WORDS + words - 1])
            size += sum(map(len, pieces[-1])) + len(pieces[-1])
            if size > _PIECE_BYTES:
                made.append(_of_pieces(pieces, words, sides))
                pieces, size = [], 0
    if pieces:
        made.append(_of_pieces(pieces, words, sides))
    return [np.concatenate([np.empty(0, np.uint64), *(m[i] for m in made)]) for i in range(sides)]
