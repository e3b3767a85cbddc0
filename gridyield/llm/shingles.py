"""Hashes of word shingles of many texts at once."""

from __future__ import annotations

import numpy as np

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_draw = np.random.Generator(np.random.PCG64(20240607))
BYTE = _draw.integers(0, 2**64, 256, dtype=np.uint64)  # a random number for each byte
STEP = np.uint64(0x9E3779B97F4A7C15 | 1)
BACK = np.uint64(pow(int(STEP), -1, 2**64))
_powers = np.ones(1, np.uint64)
_backs = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers (finalizer of a public hash)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """STEP and its inverse to the powers 0 to n - 1, modulo 2**64."""
    global _powers, _backs
    if len(_powers) < n:
        size = max(n, 2 * len(_powers))
        grow = np.full(size, STEP)
        grow[0] = 1
        _powers = np.multiply.accumulate(grow)
        grow = np.full(size, BACK)
        grow[0] = 1
        _backs = np.multiply.accumulate(grow)
    return _powers[:n], _backs[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """n + 1 sums from which ``span_hash`` takes the hash of any span of the bytes."""
    forward, _ = powers(len(data) + 1)
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * forward[:-1], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    _, backs = powers(len(sums))
    return (sums[end] - sums[start]) * backs[start]


def shingle_sets(texts: list[bytes], words: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(shingles, borders): the distinct 64-bit shingle hashes of text i, ascending, at borders[i] to borders[i + 1].

    A-Z count as a-z, words are split at the six ASCII white-space bytes. A text with fewer words has its whole
    word sequence as one shingle, one without words none.
    """
    n = len(texts)
    data = LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
    ends_of = np.cumsum([len(t) + 1 for t in texts])
    white = WHITE[data]
    inside = ~white
    start = np.flatnonzero(inside & np.concatenate([[True], white[:-1]]))
    end = np.flatnonzero(white & np.concatenate([[False], inside[:-1]]))
    of = np.searchsorted(ends_of, start, "right")
    word = mix(span_hash(prefix_hashes(data), start, end) + (end - start).astype(np.uint64))
    count = np.bincount(of, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    # A shingle of a text with at least ``words`` words starts at each word that has enough words behind it.
    which = np.arange(len(word))
    full = which + words <= first[of + 1] if len(word) else np.zeros(0, bool)
    at = which[full]
    value = np.full(len(at), words, np.uint64)
    for k in range(words):
        value = mix(value * STEP + word[at + k])
    owner = of[full]
    short = np.flatnonzero((count > 0) & (count < words))
    extra = np.zeros(len(short), np.uint64)
    for j, i in enumerate(short):
        value_j = np.array([count[i]], np.uint64)
        for k in range(first[i], first[i + 1]):
            value_j = mix(value_j * STEP + word[k:k + 1])
        extra[j] = value_j[0]
    value, owner = np.concatenate([value, extra]), np.concatenate([owner, short])
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    if len(value):
        new = np.concatenate([[True], (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])])
        value, owner = value[new], owner[new]
    return value, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))]).astype(np.int64)
