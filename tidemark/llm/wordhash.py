"""Hashes of words and word shingles, computed for many texts at once.

Words are the runs of bytes other than the six ASCII white-space bytes, with A-Z in lower case.  A word's hash is a
polynomial over 64 random bits per byte, taken from one running sum over the whole buffer; a shingle's hash mixes
the hashes of its words in order.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads every bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


def _spread(count: int, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


_BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse
_INVERSE = pow(_BASE, -1, 1 << 64)
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
BYTE_BITS = _spread(256, 7)
LOWER_BITS = BYTE_BITS[_LOWER]

_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base ** 0 .. base ** (count - 1) modulo 2 ** 64, kept between calls."""
    have = _powers.get(base)
    if have is None or len(have) < count:
        size = max(count, 1 << 20)
        have = np.full(size, base, _U)
        have[0] = 1
        with np.errstate(over="ignore"):
            have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _powers[base] = have
    return have[:count]


def running(values: np.ndarray) -> np.ndarray:
    """Sums from which ``window_hash`` takes the hash of any range."""
    with np.errstate(over="ignore"):
        return np.concatenate([np.zeros(1, _U), np.cumsum(values * powers(_BASE, len(values)), dtype=_U)])


def window_hash(sums: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (sums[stop] - sums[start]) * powers(_INVERSE, len(sums))[start]


def word_bounds(data: np.ndarray, offsets: np.ndarray, blank: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the buffer's texts; ``blank`` marks the bytes outside words."""
    size = len(data)
    if size == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ink = ~blank[data]
    begins, ends = ink.copy(), ink.copy()
    begins[1:] &= ~ink[:-1]
    ends[:-1] &= ~ink[1:]
    inner = offsets[(offsets > 0) & (offsets < size)]
    begins[inner] = ink[inner]          # a text's first byte starts a word
    ends[inner - 1] = ink[inner - 1]    # and its last byte ends one
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def words(data: np.ndarray, offsets: np.ndarray, bits: np.ndarray = LOWER_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of the buffer, and for each text the range of its words."""
    if len(data) == 0:
        return np.zeros(0, _U), np.zeros(len(offsets), np.int64)
    start, stop = word_bounds(data, offsets)
    sums = running(bits[data])
    with np.errstate(over="ignore"):
        hashed = mix(window_hash(sums, start, stop) + (stop - start).astype(_U))
    return hashed, np.searchsorted(start, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its ``width``-word shingles.

    A text with fewer words has its whole word sequence as the only one; a text without words has none.
    """
    hashed, bounds = words(data, offsets)
    full = len(hashed) - width + 1
    with np.errstate(over="ignore"):
        rolled = hashed[:max(full, 0)] * _U(3)
        for k in range(1, width):
            rolled = mix(rolled) * _U(_BASE) + hashed[k:k + max(full, 0)]
        rolled = mix(rolled + _U(width))
    out = []
    for begin, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if end - begin >= width:
            own = np.sort(rolled[begin:end - width + 1])
            keep = np.ones(len(own), bool)
            keep[1:] = own[1:] != own[:-1]
            out.append(own[keep])
        elif end > begin:
            with np.errstate(over="ignore"):
                one = hashed[begin:begin + 1] * _U(3)
                for k in range(begin + 1, end):
                    one = mix(one) * _U(_BASE) + hashed[k:k + 1]
                out.append(mix(one + _U(end - begin)))
        else:
            out.append(np.zeros(0, _U))
    return out


def set_digest(tokens: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums that name a set of tokens."""
    with np.errstate(over="ignore"):
        first = int(np.sum(mix(tokens), dtype=_U))
        second = int(np.sum(mix(tokens ^ _U(0xA5A5A5A5C3C3C3C3)), dtype=_U))
    return first - (1 << 63), second - (1 << 63)
