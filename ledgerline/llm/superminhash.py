"""Shingle sets and their SuperMinHash signatures, for many texts at once."""

from __future__ import annotations

import numpy as np

from ledgerline.llm.words import mix, word_hashes

_STEP = np.uint64(0xD1B54A32D192ED03)
_MASK = (1 << 64) - 1
_FRACTION = np.uint64(8)
UNSET = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_sets(values: list[bytes], width: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the word shingles of each text; of fewer words the whole sequence is
    one shingle; without words there are none."""
    words, first = word_hashes(values)
    sets = []
    rolled = np.zeros(0, dtype=np.uint64)
    if len(words) >= width:
        rolled = np.zeros(len(words) - width + 1, dtype=np.uint64)
        for k in range(width):
            rolled = mix(rolled + words[k : k + len(rolled)] + np.uint64((k + 1) * int(_STEP) & _MASK))
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            sets.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            one = np.full(1, b - a, dtype=np.uint64) * _STEP
            for k in range(a, b):
                one = mix(one + words[k : k + 1] + np.uint64(1))
            sets.append(one)
        else:
            sets.append(np.zeros(0, dtype=np.uint64))
    return sets


def identity(elements: np.ndarray) -> tuple[int, int]:
    """Two 64-bit sums that equal sets share, as signed numbers."""
    with np.errstate(over="ignore"):
        a, b = np.sum(elements, dtype=np.uint64), np.sum(mix(elements ^ _STEP), dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def signatures(sets: list[np.ndarray], registers: int = 128, at_once: int = 1 << 16) -> np.ndarray:
    """SuperMinHash signatures, one row per set.

    Each element walks a random permutation of the registers and offers step + fraction to the
    register that it meets at each step, so its ranks are correlated: an element meets every register
    once. A register keeps the least offer. Steps beyond the largest whole part that any register of
    the set still holds cannot change it, so a set stops there. All sets go through a step together;
    this changes only the order of offers. A value is (step << 56) | fraction.
    """
    out = np.full((len(sets), registers), UNSET, dtype=np.uint64)
    first = 0
    while first < len(sets):
        last, size = first, 0
        while last < len(sets) and (last == first or size + len(sets[last]) <= at_once):
            size += len(sets[last])
            last += 1
        _walk(sets[first:last], out[first:last], registers)
        first = last
    return out


def _walk(sets: list[np.ndarray], out: np.ndarray, registers: int) -> None:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    elements = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    order = None  # each element's permutation so far; the first step needs none
    flat = out.reshape(-1)
    for step in range(registers):
        drawn = mix(elements + np.uint64((step + 1) * int(_STEP) & _MASK))
        pick = step + ((drawn & np.uint64(0xFFFFFFFF)) * np.uint64(registers - step) >> np.uint64(32)).astype(np.int64)
        offer = (np.uint64(step) << np.uint64(56)) | (mix(drawn) >> _FRACTION)
        if order is None:
            met = pick
        else:
            rows = np.arange(len(elements))
            met = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, step]
        np.minimum.at(flat, owner * registers + met, offer)
        going = (out.max(axis=1) >> np.uint64(56)) > step
        keep = going[owner]
        if not keep.any():
            return
        if order is None:
            kept_pick = pick[keep]
            order = np.tile(np.arange(registers, dtype=np.uint16), (len(kept_pick), 1))
            order[np.arange(len(kept_pick)), kept_pick] = 0
        else:
            order = order[keep]
        owner, elements = owner[keep], elements[keep]


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A 64-bit key per band of each signature: equal keys mean equal values in that band."""
    keys = np.zeros((len(signature), bands), dtype=np.uint64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=np.uint64) * _STEP
        for row in range(band * rows, (band + 1) * rows):
            key = mix(key + signature[:, row])
        keys[:, band] = key
    return keys.view(np.int64)
