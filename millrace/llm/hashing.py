"""Vectorised word and n-gram hashing over the raw bytes of many texts at once.

A word's hash is a polynomial over random 64-bit byte values, taken from prefix sums modulo 2**64 and mixed;
an n-gram's hash is the same polynomial over word hashes. No per-word Python objects are made.
"""

from __future__ import annotations

import numpy as np

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_Q = np.uint64(0xD6E8FEB86659FD93)


def _inverse(x: int) -> int:
    return pow(int(x), -1, 1 << 64)


def _powers(base: np.uint64, n: int, _kept: dict = {}) -> np.ndarray:  # noqa: B006 - a cache
    have = _kept.get(int(base))
    if have is None or len(have) < n + 1:
        size = max(n + 1, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 1 << 21:
            _kept[int(base)] = have
    return have[: n + 1]


_BYTE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256)
_LOWER[65:91] += 32
_BYTE = _BYTE[_LOWER]  # A-Z hash as a-z

#: Words are runs of all bytes but space, tab, LF, VT, FF and CR.
SPACED = np.ones(256, bool)
SPACED[[9, 10, 11, 12, 13, 32]] = False
#: Words are runs of digits, letters a-z (A-Z lower-cased) and all bytes of characters beyond ASCII.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[97:123] = ALNUM[65:91] = ALNUM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def word_bounds(raw: np.ndarray, offs: np.ndarray, table: np.ndarray, cuts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start byte, end byte and text number of every word; no word crosses from one text into the next.
    cuts: further bytes at which a word ends and another begins."""
    n = len(raw)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    inside = np.zeros(n + 1, bool)
    inside[:n] = table[raw]
    edge = inside.copy()
    edge[1:] ^= inside[:-1]
    edge[n] = inside[n - 1]
    cut = offs[1:-1] if cuts is None else np.concatenate([offs[1:-1], cuts])
    cut = cut[(cut > 0) & (cut < n)]
    cut = np.unique(cut[inside[cut] & inside[cut - 1]]) if len(cut) else cut
    at = np.flatnonzero(edge)
    if len(cut):
        at = np.sort(np.concatenate([at, cut, cut]))
    start, end = at[0::2], at[1::2]
    return start, end, np.searchsorted(offs, start, side="right") - 1


def word_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, A-Z taken as a-z."""
    n = len(raw)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[raw] * _powers(_P, n)[:n], out=prefix[1:])
    back = _powers(np.uint64(_inverse(_P)), n)
    return mix((prefix[end] - prefix[start]) * back[start] + (end - start).astype(np.uint64) * _Q)


def gram_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k consecutive entries, by the index of the first; the caller drops those that cross texts."""
    n = len(words)
    if n < k:
        return np.zeros(0, np.uint64)
    if k <= 8:
        out = words[: n - k + 1].copy()
        power = _Q
        with np.errstate(over="ignore"):
            for j in range(1, k):
                out += words[j : n - k + 1 + j] * power
                power = np.uint64((int(power) * int(_Q)) & (2**64 - 1))
        return mix(out)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(words * _powers(_Q, n)[:n], out=prefix[1:])
    return mix((prefix[k:] - prefix[:-k]) * _powers(np.uint64(_inverse(_Q)), n)[: n - k + 1])


def sequence_hash(words: np.ndarray) -> np.uint64:
    """Hash of one whole sequence; as gram_hashes gives for k = its length."""
    return gram_hashes(words, len(words))[0]


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w consecutive entries, by doubling."""
    out, have = x, 1
    while have * 2 <= w:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < w:
        out = np.minimum(out[: len(x) - w + 1], out[w - have : len(x) - have + 1])
    return out
