"""Word shingles of whole Arrow batches of texts as 64-bit hashes, and min-max signatures over them."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
_A, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = (x ^ (x >> np.uint64(30))) * _A
    x = (x ^ (x >> np.uint64(27))) * _B
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a string array without nulls, A-Z lower-cased, and each text's bounds among them."""
    texts = texts.cast(pa.large_string())
    _, off, data = texts.buffers()
    off = np.frombuffer(off, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    if len(off) == 0 or data is None or off[-1] == off[0]:
        return np.empty(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    raw = _LOWER[np.frombuffer(data, np.uint8)[off[0]:off[-1]]]
    off = off - off[0]
    blank = _BLANK[raw]
    start = np.empty(len(raw), bool)
    start[0] = True
    start[1:] = blank[:-1]
    start[off[:-1][off[:-1] < len(raw)]] = True
    start &= ~blank
    at = np.flatnonzero(start)
    inside = np.flatnonzero(~blank)
    word = np.cumsum(start)[inside] - 1
    h = mix(raw[inside].astype(np.uint64) + (inside - at[word] + 1).astype(np.uint64) * np.uint64(256))
    first = np.searchsorted(inside, at)
    words = np.add.reduceat(h, first) if len(at) else np.empty(0, np.uint64)
    return mix(words), np.searchsorted(at, off)


def shingle_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted, one text after the other, and each text's bounds among them.

    Texts of fewer words have their whole sequence as one shingle, texts without words none.
    """
    w, bounds = word_hashes(texts)
    sets, ends = [], [0]
    chain = w[:max(0, len(w) - size + 1)].copy()
    for i in range(1, size):
        chain = mix(chain * np.uint64(0x9E3779B97F4A7C15) + w[i:i + len(chain)])
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        n = b - a
        if n >= size:
            s = np.sort(chain[a:b - size + 1])
            s = s[np.concatenate([[True], s[1:] != s[:-1]])]
        elif n:
            one = np.uint64(n)
            for x in w[a:b]:
                one = mix(np.array([one], np.uint64) * np.uint64(0x9E3779B97F4A7C15) + x)[0]
            s = np.array([one], np.uint64)
        else:
            s = np.empty(0, np.uint64)
        sets.append(s)
        ends.append(ends[-1] + len(s))
    return (np.concatenate(sets) if sets else np.empty(0, np.uint64)), np.array(ends, np.int64)


def signatures(sets: np.ndarray, ends: np.ndarray, permutations: int) -> np.ndarray:
    """Minimum and maximum of every permutation over each non-empty set: (2 x permutations, sets), minima first.

    All sets must have a member.
    """
    seeds = mix(np.arange(1, 2 * permutations + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = np.empty((2 * permutations, len(ends) - 1), np.uint64)
    for p in range(permutations):
        x = sets * seeds[2 * p]
        x ^= x >> np.uint64(29)
        x *= seeds[2 * p + 1]
        np.minimum.reduceat(x, ends[:-1], out=out[p])
        np.maximum.reduceat(x, ends[:-1], out=out[permutations + p])
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key per band of ``rows`` signature values and set: (sets, bands)."""
    n = len(signature) // rows
    keys = []
    for b in range(n):
        k = np.full(signature.shape[1], b + 1, np.uint64)
        for r in range(rows):
            k = mix(k * np.uint64(0x9E3779B97F4A7C15) + signature[b * rows + r])
        keys.append(k)
    return np.stack(keys, axis=1)
