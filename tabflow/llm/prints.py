"""Fingerprints of the words of many texts at once, from their bytes, with numpy.

The fingerprint of a word is a polynomial of its bytes modulo 2^64, cut out of running sums
over all bytes, and mixed; a second one adds the word's length, its outer bytes and a
polynomial modulo a prime, for there are words whose polynomials modulo 2^64 are equal
whatever the factor.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Bytes whose fingerprints are made at a time.
WINDOW = 1 << 20
# Odd factors: of the polynomial, and of what the second fingerprint adds.
_WORD, _OUTER = 0x9E3779B97F4A7C15, 0x165667B19E3779F9
# Terms of the polynomial modulo the prime that can be added up before they are reduced.
_UNREDUCED = 1 << 24
# The prime, and the factor of the polynomial modulo it.
_PRIME, _FACTOR = (1 << 31) - 1, 0x2545F491


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64, then the same of a number modulo
    the prime, as many as were asked for."""

    def __init__(self) -> None:
        self.factors = (_WORD, pow(_WORD, -1, 1 << 64))
        self.prime_factors = (_FACTOR, pow(_FACTOR, -1, _PRIME))
        self.made = (np.empty(0, np.uint64),) * 4

    def upto(self, n: int) -> tuple[np.ndarray, ...]:
        if len(self.made[0]) < n:
            rows = []
            for factor in self.factors:
                row = np.full(n, factor, np.uint64)
                row[0] = 1
                rows.append(np.multiply.accumulate(row))
            for factor in self.prime_factors:
                row = np.ones(n, np.uint64)
                done = 1
                while done < n:
                    more = row[done : 2 * done]
                    more[:] = row[: len(more)] * np.uint64(pow(factor, done, _PRIME)) % np.uint64(_PRIME)
                    done *= 2
                rows.append(row)
            self.made = tuple(rows)
        return tuple(row[:n] for row in self.made)


def word_prints(data: np.ndarray, ends: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """Starts, ends and both fingerprints of the words of some bytes; ``ends`` marks bytes between words."""
    parts = [_part(data, ends, low, high, powers) for low, high in _windows(ends)]
    starts, stops, one, other = (np.concatenate(p) for p in zip(*parts or [_part(data, ends, 0, 0, powers)]))
    outer = data[starts].astype(np.uint64) << np.uint64(8) | data[stops - 1]
    sizes = (stops - starts).astype(np.uint64) << np.uint64(16)
    return starts, stops, one, mixed(one + (sizes | outer) * np.uint64(_OUTER) + mixed(other))


def _windows(between: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts of about ``WINDOW`` bytes after the end of a word."""
    low, size = 0, len(between)
    while low < size:
        high = min(low + WINDOW, size)
        if high < size:
            ends = np.flatnonzero(between[low:high])
            if not len(ends):  # a word that is longer
                ends = np.flatnonzero(between[low:])
            high = low + int(ends[-1 if ends[-1] < WINDOW else 0]) + 1 if len(ends) else size
        yield low, high
        low = high


def _part(
    data: np.ndarray, between: np.ndarray, low: int, high: int, powers: Powers
) -> tuple[np.ndarray, ...]:
    """Starts and ends of the words of a cut, their polynomials, mixed, and those modulo the prime."""
    inside = np.concatenate(([False], ~between[low:high], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    up, down, prime_up, prime_down = powers.upto(high - low + 1)
    values = data[low:high].astype(np.uint64) + np.uint64(1)
    sums = np.zeros(high - low + 1, np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    one = mixed((sums[ends] - sums[starts]) * down[starts])
    # sums of numbers below 2^40, of up to 2^24, stay below 2^64; more are reduced to below 2^31
    prime = np.uint64(_PRIME)
    values *= prime_up[:-1]
    np.cumsum(values if len(values) <= _UNREDUCED else values % prime, out=sums[1:])
    other = (sums[ends] - sums[starts]) % prime * prime_down[starts] % prime
    return starts + low, ends + low, one, other


def grouped(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal pairs stand together, and where in it each pair begins."""
    order = np.argsort(one)
    new = np.ones(len(one), bool)
    new[1:] = _changes(one[order])
    if (_changes(two[order]) & ~new[1:]).any():
        order = np.lexsort((two, one))
        new[1:] = _changes(one[order]) | _changes(two[order])
    return order, np.flatnonzero(new)


def _changes(values: np.ndarray) -> np.ndarray:
    return values[1:] != values[:-1]
