"""Words and hashes of many texts at once, on one buffer of UTF-8 bytes (numpy)."""

from __future__ import annotations

import numpy as np

_rng = np.random.Generator(np.random.PCG64(20240229))
#: One random 64-bit number for each byte value.
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of an odd number modulo 2**64."""
    global _powers
    if len(_powers) < n:
        full = np.full(max(n, 2 * len(_powers)), np.uint64(0xD1342543DE82EF95), np.uint64)
        full[0] = 1
        _powers = np.cumprod(full, dtype=np.uint64)
    return _powers[:n]


_inverse_powers = np.ones(1, np.uint64)


def inverse_powers(n: int) -> np.ndarray:
    """What the numbers of :func:`powers` are multiplied by to give 1."""
    global _inverse_powers
    if len(_inverse_powers) < n:
        full = np.full(max(n, 2 * len(_inverse_powers)), np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64)), np.uint64)
        full[0] = 1
        _inverse_powers = np.cumprod(full, dtype=np.uint64)
    return _inverse_powers[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def byte_classes(pattern_is_word) -> np.ndarray:
    return np.array([bool(pattern_is_word(b)) for b in range(256)])


#: Bytes that are not one of the blanks 0x20 and 0x09 to 0x0D.
NOT_BLANK = byte_classes(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: Digits, letters a to z and A to Z, and all bytes of other characters.
ALNUM = byte_classes(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: A to Z in lower case, all else unchanged.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], np.uint8)


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and for each row the index of its first word (one more entry at the end)."""
    inside = is_word[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[(offsets > 0) & (offsets < len(data))]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[edge - 1] = inside[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each of the ascending, disjoint spans of bytes."""
    if not len(starts):
        return np.empty(0, np.uint64)
    length = ends - starts
    total = int(length.sum())
    head = np.cumsum(length) - length
    within = np.arange(total) - np.repeat(head, length)
    at = np.repeat(starts, length) + within
    sums = np.add.reduceat(_BYTE[data[at]] * powers(int(length.max()))[within], head)
    return mix(sums + length.astype(np.uint64) * _STEP)


def run_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words inside each row, and how many each row has.

    ``first`` is as from :func:`word_spans`.  A row of fewer words, but not none,
    has one run of all its words; its hash depends on the number of words.
    """
    count = np.diff(first)
    n = np.where(count >= size, count - size + 1, np.minimum(count, 1))
    total = int(n.sum())
    if not total:
        return np.empty(0, np.uint64), n
    head = np.cumsum(n) - n
    at = np.repeat(first[:-1] - head, n) + np.arange(total)
    left = np.repeat(first[1:], n) - at
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    out = np.zeros(total, np.uint64)
    for k in range(size):
        part = padded[at + k] * powers(size + 2)[k + 1] + _BYTE[k]
        out += np.where(k < left, part, np.uint64(0)) if k else part
    return mix(out + np.minimum(left, size).astype(np.uint64) * _STEP), n
