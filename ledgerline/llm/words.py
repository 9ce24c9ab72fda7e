"""Words and hashes of many texts at once, as arrays.

A word is a longest run of bytes other than the six ASCII white-space bytes, A-Z taken as a-z. In UTF-8
no other character holds these bytes, so bytes and code points give the same words.
"""

from __future__ import annotations

import numpy as np

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_BASE = np.uint64(0x9E3779B97F4A7C15)
_SEGMENT = 1 << 18
_POWERS: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each 64-bit number (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def codes(values: np.ndarray) -> np.ndarray:
    """A code for each byte or code point, for hashes of stretches of them."""
    return mix((values.astype(np.uint64) + np.uint64(1)) * _BASE)


_PLAIN = codes(np.arange(256))
_FOLDED = _PLAIN.copy()
_FOLDED[ord("A") : ord("Z") + 1] = _PLAIN[ord("a") : ord("z") + 1]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_POWERS.get("up", ())) < n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        for name, base in (("up", int(_BASE)), ("down", inverse)):
            steps = np.full(max(n, _SEGMENT + 1), base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"][:n], _POWERS["down"][:n]


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each word in an array of bytes."""
    space = np.ones(len(data) + 2, dtype=bool)
    space[1:-1] = SPACE[data]
    edge = np.flatnonzero(space[1:] != space[:-1])
    return edge[0::2], edge[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    """A 64-bit hash of each stretch of bytes or code points: a polynomial in their codes, mixed. Worked out over
    some whole stretches at a time, so memory does not follow the length of a text. fold: A-Z counts as a-z (bytes)."""
    table = (_FOLDED if fold else _PLAIN) if data.dtype == np.uint8 else None
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + _SEGMENT, side="right")))
        low, high = int(starts[first]), int(ends[last - 1])
        up, down = _powers(high - low + 1)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        own = data[low:high]
        np.cumsum((codes(own) if table is None else table[own]) * up[:-1], out=total[1:])
        a, b = starts[first:last] - low, ends[first:last] - low
        out[first:last] = mix((total[b] - total[a]) * down[a] + (b - a).astype(np.uint64))
        first = last
    return out


def batches(values: list[bytes], most: int = 1 << 21):
    """(first, last) of stretches of texts of about `most` bytes; a longer text stands alone."""
    first = size = 0
    for i, value in enumerate(values):
        if i > first and size + len(value) > most:
            yield first, i
            first, size = i, 0
        size += len(value)
    if first < len(values):
        yield first, len(values)


def joined(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one array with a space after each, and where each text starts (one more at the end)."""
    data = np.frombuffer(b" ".join(values) + b" ", dtype=np.uint8)
    offsets = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum([len(v) + 1 for v in values], out=offsets[1:])
    return data, offsets


def word_hashes(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the position of each text's first word (one more at the end)."""
    data, offsets = joined(values)
    starts, ends = spans(data)
    return hashes(data, starts, ends), np.searchsorted(starts, offsets)
