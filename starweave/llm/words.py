"""Word and shingle hashes over whole columns of UTF-8 text, as array operations.

A word is a maximal run of bytes other than \\x20 and \\x09-\\x0D. Its hash is a polynomial over a fixed table of
64-bit values, read off one running sum, so a task hashes all words of a slice of texts at once. Equal words have
equal hashes in every process.
"""

from __future__ import annotations

import numpy as np

from .common import SLICE_BYTES, mix64

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_VALUES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_FOLDED = _VALUES.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _VALUES[ord("a") : ord("z") + 1]

_powers: dict[str, np.ndarray] = {}


def _power(name: str, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64 (or of the inverse), kept for the next slice."""
    have = _powers.get(name)
    if have is None or len(have) < n:
        step = np.full(max(n, SLICE_BYTES + 1), _BASE if name == "up" else _INVERSE, dtype=np.uint64)
        step[0] = 1
        have = _powers[name] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def word_hashes(raw: np.ndarray, offsets: np.ndarray, fold: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the texts ``raw[offsets[i]:offsets[i+1]]`` in order, and the words per text.
    ``fold`` lower-cases A-Z. A text longer than a slice is read piece by piece, cut at white space."""
    if len(offsets) == 2 and offsets[1] - offsets[0] > 2 * SLICE_BYTES:
        parts, at, end = [], int(offsets[0]), int(offsets[1])
        while at < end:
            to = min(at + SLICE_BYTES, end)
            while to < end:  # on to the next white space
                gap = np.flatnonzero(_SPACE[raw[to : to + SLICE_BYTES]])
                if len(gap):
                    to += int(gap[0])
                    break
                to = min(to + SLICE_BYTES, end)
            parts.append(_hashes(raw[at:to], np.array([0, to - at]), fold)[0])
            at = to
        found = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return found, np.array([len(found)])
    return _hashes(raw[offsets[0] : offsets[-1]], offsets - offsets[0], fold)


def _hashes(raw: np.ndarray, offsets: np.ndarray, fold: bool) -> tuple[np.ndarray, np.ndarray]:
    n = len(raw)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
    word = ~_SPACE[raw]
    edge = np.zeros(n + 1, dtype=bool)  # a text begins here
    edge[offsets] = True
    start = word.copy()
    start[1:] &= ~word[:-1] | edge[1:n]
    last = word.copy()
    last[:-1] &= ~word[1:] | edge[1:n]
    first, end = np.flatnonzero(start), np.flatnonzero(last)
    sums = np.empty(n + 1, dtype=np.uint64)
    sums[0] = 0
    np.cumsum((_FOLDED if fold else _VALUES)[raw] * _power("up", n), dtype=np.uint64, out=sums[1:])
    found = mix64((sums[end + 1] - sums[first]) * _power("down", n)[first])
    return found, np.diff(np.searchsorted(first, offsets))


def shingle_hashes(words: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` consecutive words of each text in order, and the runs per text; a text of 1 to
    k-1 words has one, of its whole sequence."""
    ends = np.cumsum(counts)
    begins = ends - counts
    runs = np.where(counts >= k, counts - k + 1, np.minimum(counts, 1))
    multiplier = mix64(np.arange(1, k + 1, dtype=np.uint64)) | np.uint64(1)
    total = int(runs.sum())
    if not total:
        return np.zeros(0, np.uint64), runs
    # the first word of every run
    at = np.arange(total) + np.repeat(begins - (np.cumsum(runs) - runs), runs)
    left = np.repeat(ends, runs)
    out = np.zeros(total, dtype=np.uint64)
    for j in range(k):
        there = at + j < left
        out += np.where(there, words[np.minimum(at + j, len(words) - 1)] * multiplier[j], np.uint64(0))
    return mix64(out), runs


def sorted_sets(values: np.ndarray, counts: np.ndarray) -> list[np.ndarray]:
    """The distinct values of each text, sorted."""
    out, at = [], 0
    for c in counts.tolist():
        v = np.sort(values[at : at + c])
        at += c
        out.append(v[np.concatenate(([True], v[1:] != v[:-1]))] if c > 1 else v)
    return out
