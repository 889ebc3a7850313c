"""Words, lines and their 64-bit hashes of many texts at once, as numpy arrays.

A word is ``[^\\x20\\x09-\\x0D]+``. Hashes are polynomials over random 64-bit byte values
modulo 2**64, mixed with the length; equal strings have equal hashes and different ones
collide with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_STEP = 1 << 21

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = np.asarray(x, _U)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_VALUES = mix(np.arange(1, 257, dtype=_U) * _U(0x9E3779B97F4A7C15))


def _powers_of(base: int, n: int) -> np.ndarray:
    out = np.ones(n, _U)
    if n > 1:
        out[1:] = _U(base)
        np.multiply.accumulate(out, out=out)
    return out


_KEPT: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if n not in _KEPT:
        _KEPT.clear()
        _KEPT[n] = _powers_of(_BASE, n), _powers_of(pow(_BASE, -1, 1 << 64), n)
    return _KEPT[n]


def range_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``data[s:e]`` for ascending, disjoint ranges; memory bounded by ranges' step."""
    out = np.empty(len(starts), _U)
    i, n = 0, len(starts)
    while i < n:  # runs of ranges of about _STEP bytes
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _STEP, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        size = b - a
        up, down = _powers(max(_STEP, 1 << size.bit_length()) + 1)
        sums = np.zeros(size + 1, _U)
        np.cumsum(_VALUES[data[a:b]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * down[s] + (e - s).astype(_U) * _U(0xD1B54A32D192ED03))
        i = j
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text index)`` of every word; a word never spans two texts."""
    if not len(data):
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    first[cuts] = inside[cuts]
    last[cuts - 1] = inside[cuts - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


def line_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(starts, ends, text index)`` of every ``\\n``-split line, without its newline.

    An empty text has one empty line, as ``split`` gives.
    """
    nl = np.flatnonzero(data == 10)
    starts = np.sort(np.concatenate([offsets[:-1], nl + 1]), kind="stable")
    ends = np.sort(np.concatenate([offsets[1:], nl]), kind="stable")
    per = 1 + np.searchsorted(nl, offsets[1:]) - np.searchsorted(nl, offsets[:-1])
    return starts, ends, np.repeat(np.arange(len(offsets) - 1), per)


def counts_by(index: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    return np.bincount(index, weights, minlength=n).astype(np.int64)


def windows(hashes: np.ndarray, text: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """``(first word position, hash)`` of every window of ``size`` words inside one text."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(text[:n] == text[size - 1:])
    h = np.zeros(len(at), _U)
    for k in range(size):
        h = mix(h * _U(0x2545F4914F6CDD1D) + hashes[at + k])
    return at, h


def repeated(keys: np.ndarray) -> np.ndarray:
    """For each key, whether it occurs twice or more."""
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    return count[inverse] > 1


def seen_before(keys: np.ndarray) -> np.ndarray:
    """For each key, whether an earlier one equals it."""
    out = np.ones(len(keys), bool)
    out[np.unique(keys, return_index=True)[1]] = False
    return out
