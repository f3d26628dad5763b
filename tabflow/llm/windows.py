"""Stretches of equal-length windows of a byte string, cut by content.

A window of ``LENGTH`` bytes has a fingerprint: the least hash of its ``GRAM``-byte
pieces. A segment is a maximal stretch of neighbouring windows with one fingerprint.
Two equal windows, wherever they are, have the same fingerprint, so they can only
meet in segments of one fingerprint.
"""

from __future__ import annotations

import numpy as np

LENGTH = 100
GRAM = 24

_RANDOM = np.random.Generator(np.random.PCG64(11)).integers(0, 1 << 64, 256, np.uint64)
_BASE = np.uint64(0xD1342543DE82EF95)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Hashes:
    """Hashes of any piece of a byte string, from prefix sums modulo 2 to the 64."""

    def __init__(self, data: bytes) -> None:
        flat = np.frombuffer(data, np.uint8)
        n = len(flat)
        powers = np.full(n + 1, _BASE, np.uint64)
        powers[0] = 1
        np.multiply.accumulate(powers, out=powers)
        back = np.full(n + 1, _INVERSE, np.uint64)
        back[0] = 1
        np.multiply.accumulate(back, out=back)
        self.back = back
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_RANDOM[flat] * powers[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(raw + (ends - starts).astype(np.uint64))

    def grams(self, size: int) -> np.ndarray:
        """Of all pieces of one size, by their start."""
        n = len(self.sums) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self.sums[size:] - self.sums[:n]) * self.back[:n])


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    span, out = 1, values
    while 2 * span <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def segments(sizes: np.ndarray, hashes: Hashes) -> tuple[np.ndarray, ...]:
    """Segments of several texts that stand one after the other.

    Returns, per segment: number of the text, offset of its first window in the
    text, number of windows, fingerprint, hash of all its bytes, and whether the
    fingerprint's piece occurs in it more than once, so that windows within the
    segment may be equal.
    """
    pieces = LENGTH - GRAM + 1
    grams = hashes.grams(GRAM)
    ends = np.cumsum(sizes)
    begins = ends - sizes
    total = int(ends[-1]) if len(ends) else 0
    if total < LENGTH:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    least = _least(grams, pieces)  # by window start, over all texts
    owner = np.repeat(np.arange(len(sizes)), sizes)[: len(least)]
    inside = np.arange(len(least)) + LENGTH <= ends[owner]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | ~inside[:-1]
    new &= inside
    starts = np.flatnonzero(new)
    last = np.ones(len(least), bool)
    last[:-1] = new[1:] | ~inside[1:]
    stops = np.flatnonzero(last & inside)
    text = owner[starts]
    value = least[starts]
    # pieces that are fingerprints are few; count those of the segment that equal its own
    at = np.flatnonzero(_hits(grams, least, pieces))
    low, high = np.searchsorted(at, starts), np.searchsorted(at, stops + pieces)
    many = high - low
    each = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    same = grams[at[np.repeat(low, many) + each]] == np.repeat(value, many)
    repeated = np.bincount(np.repeat(np.arange(len(starts)), many), same, len(starts)) > 1
    whole = hashes.of(starts, stops + LENGTH)
    return text, starts - begins[text], stops - starts + 1, value, whole, repeated


def _hits(grams: np.ndarray, least: np.ndarray, pieces: int) -> np.ndarray:
    """Marks pieces that are the fingerprint of a window which holds them."""
    wide = np.concatenate((least, np.repeat(least[-1:], len(grams) - len(least))))
    before = np.concatenate((np.repeat(least[:1], pieces - 1), least))[: len(grams)]
    return (grams == wide) | (grams == before)
