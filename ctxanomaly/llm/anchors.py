"""Winnowed anchors: places in a sequence that equal windows choose alike.

Every window of ``span`` units picks the leftmost of its ``size``-grams with
the smallest hash.  The choice depends on the window's content only, so two
equal windows pick anchors of equal content at equal offsets.  Consecutive
windows that pick the same anchor are its territory.
"""

from __future__ import annotations

import numpy as np

_POSITION_BITS = 28
_SLICE = 1 << 22  # windows at a time, so that memory is bounded for any length
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(33))
    x = x * _MIX
    return x ^ (x >> np.uint64(29))


def gram_hashes(units: np.ndarray, size: int, base: int) -> np.ndarray:
    """Polynomial hash (modulo 2**64) of every run of ``size`` units, by
    doubling: a run of 2m units is two runs of m."""
    if units.size < size:
        return np.empty(0, np.uint64)
    block, length, power = units.astype(np.uint64), 1, np.uint64(base)
    out, have, left = None, 0, size
    with np.errstate(over="ignore"):
        while True:
            if left & 1:  # append a block to what there is
                out = block if out is None else _joined(out, block, have, power)
                have += length
            left >>= 1
            if not left:
                return out
            block = _joined(block, block, length, power)
            length, power = 2 * length, power * power


def _joined(a: np.ndarray, b: np.ndarray, length: int, power: np.uint64) -> np.ndarray:
    """Hashes of a's runs (of ``length`` units) followed by b's, whose runs'
    place value is ``power``."""
    m = min(a.size, b.size - length)
    return a[:m] * power + b[length : length + m]


def _window_minima(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    have = 1
    while 2 * have <= width:
        v, have = np.minimum(v[:-have], v[have:]), 2 * have
    rest = width - have
    return np.minimum(v[: v.size - rest], v[rest:]) if rest else v


def territories(grams: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, last window) of each run of windows with the
    same anchor; a window has ``width`` grams.  Sequences of any length are
    done in slices, so a territory may come in two parts."""
    found = []
    mask = np.uint64((1 << _POSITION_BITS) - 1)
    for at in range(0, grams.size - width + 1, _SLICE):
        part = grams[at : at + _SLICE + width - 1]
        packed = (part & ~mask) | np.arange(part.size, dtype=np.uint64)
        chosen = (_window_minima(packed, width) & mask).astype(np.int64)
        first = np.r_[0, np.flatnonzero(np.diff(chosen)) + 1]
        last = np.r_[first[1:], chosen.size] - 1
        found.append((chosen[first] + at, first + at, last + at))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def merge_spans(starts: list[int], ends: list[int]) -> list[tuple[int, int]]:
    """Union of half-open spans, as maximal runs in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(zip(starts, ends, strict=True)):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out
