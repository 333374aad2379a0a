"""Recompression of token sequences: globally consistent names for runs and pairs.

Round 0 names every maximal run of one word.  Each later round splits the names
into two sides by a hash and replaces every adjacent (left, right) pair by one
new name.  A name is a fingerprint of what it stands for, so all tasks give equal
content equal names without a dictionary, and whether a pair is replaced depends
on the pair alone.  Every symbol carries the span of words that settles its
existence: two occurrences of the same text agree on all symbols whose spans lie
inside it.
"""

from __future__ import annotations

import numpy as np

ROUNDS = 2
_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)
_S = np.uint64(32)
OUTSIDE = np.int64(1) << 40
#: Base of the rolling names of spans, and its inverse modulo 2^64.
_P = np.uint64(0x5851F42D4C957F2D)
_INVERSE = np.uint64(pow(int(_P), -1, 1 << 64))


def mix(x):
    """Bijective scrambling of 64-bit numbers (an array of them)."""
    x = x * _A
    x = (x ^ (x >> _S)) * _B
    return x ^ (x >> _S)


def runs(words: np.ndarray):
    """(name, lo, hi) of the maximal runs: a run is settled by its neighbours."""
    n = len(words)
    start = np.flatnonzero(np.r_[True, words[1:] != words[:-1]])
    length = np.diff(np.r_[start, n])
    name = np.where(length > 1, mix(words[start] + mix(length.astype(np.uint64))), words[start])
    lo, hi = start - 1, start + length + 1
    lo[0], hi[-1] = -OUTSIDE, OUTSIDE
    return name, lo, hi


def pairs(name, lo, hi, salt: int):
    """The next round: (name, lo, hi, whether the symbol is a new pair)."""
    left = (mix(name ^ mix(np.array([salt], np.uint64))) >> np.uint64(63)).astype(bool)
    glue = np.r_[left[:-1] & ~left[1:], False]
    tail = np.r_[False, glue[:-1]]
    # a left symbol stays single because of its right neighbour, a right one because of its left
    right_hi, left_lo = np.r_[hi[1:], OUTSIDE], np.r_[-OUTSIDE, lo[:-1]]
    new_hi = np.where(glue | left, np.maximum(hi, right_hi), hi)
    new_lo = np.where(~left & ~tail, np.minimum(lo, left_lo), lo)
    new_name = name.copy()
    at = np.flatnonzero(glue)
    new_name[at] = mix(mix(name[at]) + name[at + 1] + np.uint64(salt))
    keep = ~tail
    return new_name[keep], new_lo[keep], new_hi[keep], glue[keep]


def anchors(words: np.ndarray, window: int, rounds: int = ROUNDS) -> np.ndarray:
    """For every window of ``window`` words the name of one symbol settled by the
    window alone: of the latest round that has one, the one with the least name.
    An anchor is named by all words of its span, which the window holds too.
    Windows without a settled pair fall back to their word of least hash, so equal
    windows always have equal anchors."""
    n = len(words) - window + 1
    best = np.zeros(max(n, 0), np.uint64)
    if n <= 0:
        return best
    levels = []
    symbols = runs(words)
    for r in range(1, rounds + 1):
        name, lo, hi, new = pairs(*symbols, r)
        symbols = name, lo, hi
        levels.append((name[new], lo[new], hi[new]))
    open_ = np.ones(n, bool)
    none = np.uint64(0xFFFFFFFFFFFFFFFF)
    power = np.full(len(words), _P)
    power[0] = 1
    power = np.multiply.accumulate(power)
    total = np.append(np.uint64(0), np.cumsum(mix(words) * power))
    shift = np.full(len(words), _INVERSE)
    shift[0] = 1
    shift = np.multiply.accumulate(shift)
    for name, lo, hi in reversed(levels):
        least = np.full(n, none)
        room = window - (hi - lo)
        fit = (room >= 0) & (lo >= 0)
        name, lo, hi, room = name[fit], lo[fit], hi[fit], room[fit]
        hi = np.minimum(hi, len(words))
        name = mix((total[hi] - total[lo]) * shift[lo] + mix(name))
        for k in range(int(room.max(initial=-1)) + 1):
            on = room >= k
            at = lo[on] - k
            ok = (at >= 0) & (at < n)
            np.minimum.at(least, at[ok], name[on][ok])
        found = open_ & (least != none)
        best[found] = least[found]
        open_ &= ~found
    if open_.any():
        w = mix(words)
        least = w[:n].copy()
        for k in range(1, window):
            np.minimum(least, w[k:k + n], out=least)
        best[open_] = least[open_]
    return best


def window_names(words: np.ndarray, window: int) -> np.ndarray:
    """A fingerprint of every window."""
    n = len(words) - window + 1
    x = np.zeros(max(n, 0), np.uint64)
    for k in range(window if n > 0 else 0):
        x = mix(x + words[k:k + n])
    return x
