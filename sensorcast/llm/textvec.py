"""Words and word shingles of many texts at once, in numpy.

A word is a run of bytes other than the ASCII white space ``0x20`` and
``0x09``-``0x0D``, after lower-casing A-Z; with ``alnum`` it is a run of
ASCII letters, digits and non-ASCII bytes.  Words and shingles are represented
by 64-bit fingerprints.
"""

from __future__ import annotations

import numpy as np

_MULT = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_INVERSE = pow(_MULT, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power_table(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 20)
        steps = np.full(size, base, dtype=np.uint64)
        steps[0] = 1
        made = np.multiply.accumulate(steps)
        if size > 1 << 24:
            return made
        _powers[base] = have = made
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _separators(alnum: bool) -> np.ndarray:
    code = np.arange(256)
    if not alnum:
        return (code == 32) | ((code >= 9) & (code <= 13))
    return ~((code >= 128) | ((code >= 48) & (code <= 57)) | ((code >= 97) & (code <= 122)))


_IS_SEPARATOR = {flag: _separators(flag) for flag in (False, True)}


def words(data: np.ndarray, offsets: np.ndarray, alnum: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all words of a run of texts, and per text the index of
    its first word (with one more entry, the number of words)."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)
    space = _IS_SEPARATOR[alnum][low]
    after = np.empty(n, bool)
    after[0] = True
    after[1:] = space[:-1]
    heads = offsets[:-1]
    after[heads[heads < n]] = True
    starts = np.flatnonzero(~space & after)
    before = np.searchsorted(starts, offsets, side="left")
    if len(starts) == 0:
        return np.zeros(0, np.uint64), before
    parts = low.astype(np.uint64)
    parts += np.uint64(1)
    parts[space] = 0
    parts *= _power_table(_MULT, n)
    sums = np.add.reduceat(parts, starts)
    return mix(sums * _power_table(_INVERSE, n)[starts]), before


def ngrams(hashes: np.ndarray, width: int, gap: int = 1) -> np.ndarray:
    """Fingerprint of every run of ``width`` words ``gap`` apart, by its first word."""
    n = len(hashes) - (width - 1) * gap
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        factor = ((2 * j + 3) * 0xD1342543DE82EF95 + 0x632BE59BD9B4E019 * gap) & _MASK | 1
        total += mix(hashes[j * gap:j * gap + n] * np.uint64(factor))
    return mix(total + np.uint64(width))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = 5) -> list[np.ndarray]:
    """Per text the sorted distinct fingerprints of its ``width``-word
    shingles; of fewer words the whole sequence is one; of no words, none."""
    hashes, before = words(data, offsets)
    grams = ngrams(hashes, width)
    out = []
    for s, e in zip(before[:-1].tolist(), before[1:].tolist()):
        if e - s >= width:
            run = np.sort(grams[s:e - width + 1])
            keep = np.empty(len(run), bool)
            keep[0] = True
            np.not_equal(run[1:], run[:-1], out=keep[1:])
            out.append(run[keep])
        elif e > s:
            out.append(ngrams(hashes[s:e], e - s))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
