"""Hashes of the words of a text, computed without an object per word."""

from __future__ import annotations

import numpy as np

MIX = np.uint64(0x9E3779B97F4A7C15)


def random_numbers(n: int) -> np.ndarray:
    """``n`` fixed 64-bit numbers without a pattern."""
    with np.errstate(over="ignore"):
        x = np.arange(1, n + 1, dtype=np.uint64) * MIX
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return x ^ (x >> np.uint64(31))


PLACES = 64  # byte positions of a word with numbers of their own
_INSIDE = ~np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])
_LOWER = np.where(np.isin(np.arange(256), range(0x41, 0x5B)), np.arange(256) | 0x20, np.arange(256))
_NUMBERS = random_numbers(PLACES * 256).reshape(PLACES, 256)[:, _LOWER].ravel()


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of every word, in order: the sum of a number per byte and position.

    Words are cut at the six ASCII white characters, and A-Z count as lower case.
    """
    raw = np.frombuffer(b" " + text + b" ", np.uint8)
    inside = _INSIDE[raw]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, length = edges[::2], edges[1::2] - edges[::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    ends = np.cumsum(length)
    place = np.arange(ends[-1], dtype=np.int32) - np.repeat(
        (ends - length).astype(np.int32), length)
    numbers = _NUMBERS[(place & (PLACES - 1)) << 8 | raw[inside]]
    if length.max() > PLACES:
        numbers *= np.power(MIX, (place // PLACES).astype(np.uint64))
    total = np.add.reduceat(numbers, ends - length) + length.astype(np.uint64)
    return (total ^ (total >> np.uint64(32))) * MIX
