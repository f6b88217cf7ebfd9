"""Content-chosen anchors of byte strings: equal strings of ``length`` bytes hold an equal anchor at the same place."""

from __future__ import annotations

import numpy as np

from ledgerlake.llm.hashing import _powers, mix

_PLACE_BITS = np.uint64(24)
SEGMENT = (1 << 24) - 1  # longer blocks are cut, overlapping by one string


def gram_hashes(a: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each ``k`` bytes in a row."""
    n = len(a) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    power, inverse = _powers(len(a) + 1)
    sums = np.zeros(len(a) + 1, np.uint64)
    np.cumsum((a.astype(np.uint64) + np.uint64(1)) * power[: len(a)], out=sums[1:])
    return mix((sums[k:] - sums[:n]) * inverse[:n])


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each ``w`` values in a row, from running minima of blocks of ``w``."""
    n = len(x) - w + 1
    padded = np.full(-(-len(x) // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(x)] = x
    rows = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[w - 1 : w - 1 + n])


def anchors(a: np.ndarray, off: np.ndarray, length: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the anchors of the texts a[off[i]:off[i + 1]].

    Of the ``k``-byte grams of a string the one with the smallest hash is its anchor (the first, if equal).
    Strings don't cross texts.
    """
    places, hashes = [], []
    step = SEGMENT - length
    for lo in range(0, max(len(a) - length + 1, 0), step):
        part = a[lo : lo + SEGMENT]
        h = gram_hashes(part, k)
        if len(h) < length - k + 1:
            break
        keyed = ((h >> _PLACE_BITS) << _PLACE_BITS) | np.arange(len(h), dtype=np.uint64)
        least = _sliding_min(keyed, length - k + 1)
        # strings that start in one text and end in another don't count
        ok = np.ones(len(least), bool)
        for e in off[(off > lo) & (off < lo + len(part))] - lo:
            ok[max(0, int(e) - length + 1) : int(e)] = False
        found = least[ok] & ((np.uint64(1) << _PLACE_BITS) - np.uint64(1))
        at = np.unique(found[np.flatnonzero(np.r_[True, found[1:] != found[:-1]])] if len(found) else found).astype(np.int64)
        places.append(at + lo)
        hashes.append(h[at])
    if not places:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    at, first = np.unique(np.concatenate(places), return_index=True)
    return at, np.concatenate(hashes)[first]
