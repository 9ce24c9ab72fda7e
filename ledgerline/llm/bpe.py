"""Byte-pair merging of many short sequences at once, and the ragged arrays that it needs."""

from __future__ import annotations

import numpy as np

NONE = np.int64(1 << 40)
_EMPTY = np.int64(-1)


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions starts[k] .. starts[k] + lengths[k] - 1 of every k, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


class Ragged:
    """Rows of unequal length in one array."""

    def __init__(self, flat: np.ndarray, lengths: np.ndarray) -> None:
        self.flat, self.lengths = flat, np.asarray(lengths, dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths

    def take(self, rows: np.ndarray) -> Ragged:
        return Ragged(self.flat[expand(self.starts[rows], self.lengths[rows])], self.lengths[rows])

    @staticmethod
    def of(rows: list[bytes]) -> Ragged:
        return Ragged(np.frombuffer(b"".join(rows), dtype=np.uint8), np.array([len(r) for r in rows], dtype=np.int64))


class Pairs:
    """Which two symbols merge, into which symbol, and at which rank; looked up for arrays of pairs."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray, rank: np.ndarray) -> None:
        bits = max(4, int(len(left) * 4).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, _EMPTY)
        self.merged, self.rank = np.zeros(1 << bits, dtype=np.int64), np.full(1 << bits, NONE)
        key = (np.asarray(left, dtype=np.int64) << 32) | np.asarray(right, dtype=np.int64)
        at, todo = self._slot(key), np.arange(len(key))
        while len(todo):
            free = self.keys[at[todo]] == _EMPTY
            _, first = np.unique(at[todo[free]], return_index=True)
            put = todo[free][first]
            self.keys[at[put]], self.merged[at[put]], self.rank[at[put]] = key[put], merged[put], rank[put]
            todo = np.setdiff1d(todo, put, assume_unique=True)
            at[todo] = (at[todo] + 1) & (len(self.keys) - 1)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The slot of each pair; a slot without a pair has the rank NONE."""
        key = (left << 32) | right
        at = self._slot(key)
        while True:
            held = self.keys[at]
            missed = np.flatnonzero((held != key) & (held != _EMPTY))
            if not len(missed):
                return at
            at[missed] = (at[missed] + 1) & (len(self.keys) - 1)


def merge(symbols: Ragged, pairs: Pairs, ties: int | None = None) -> Ragged:
    """Every sequence merged until no pair is left: the pair of least rank first, the leftmost of equals.

    All sequences go through a round together; each has its pair of lowest rank merged at all its places.
    Where such a merge brings up a pair of no higher rank beside it, order matters, and that sequence merges its
    leftmost place alone. A sequence without pairs leaves. ties: the last rank, shared by many pairs that
    bring up no others; a sequence with nothing else left takes them from left to right at once.
    """
    n = len(symbols.lengths)
    done_rows, done_flat, done_lengths = [], [], []

    def leave(rows: np.ndarray, flat: np.ndarray, lengths: np.ndarray) -> None:
        done_rows.append(rows), done_flat.append(flat), done_lengths.append(lengths)

    some = symbols.lengths > 0
    rows, lengths, flat = np.flatnonzero(some), symbols.lengths[some], symbols.flat.astype(np.int64)
    leave(np.flatnonzero(~some), flat[:0], symbols.lengths[~some])
    rank, merged = _ranks(flat, lengths, pairs)
    while len(rows):
        starts = np.cumsum(lengths) - lengths
        least = np.minimum.reduceat(rank, starts)
        if ties is not None and (tied := least == ties).any():
            own = Ragged(flat, lengths).take(np.flatnonzero(tied))
            for row, start, length in zip(rows[tied], own.starts, own.lengths):
                ended = _leftmost(own.flat[start : start + length].tolist(), pairs)
                leave(np.array([row]), np.array(ended), np.array([len(ended)]))
        stay = (least < NONE) & ((least != ties) if ties is not None else True)
        if not stay.all():
            over, keep = least == NONE, np.repeat(stay, lengths)
            leave(rows[over], flat[np.repeat(over, lengths)], lengths[over])
            rows, lengths, least = rows[stay], lengths[stay], least[stay]
            flat, rank, merged = flat[keep], rank[keep], merged[keep]
            if not len(rows):
                break
            starts = np.cumsum(lengths) - lengths
        owner = np.repeat(np.arange(len(rows)), lengths)
        at = np.flatnonzero(rank == least[owner])
        # of places in a row that overlap, every second one
        head = np.ones(len(at), dtype=bool)
        head[1:] = at[1:] != at[:-1] + 1
        place = np.arange(len(at))
        at = at[(place - np.maximum.accumulate(np.where(head, place, 0))) % 2 == 0]
        at = at[_safe(at, flat, owner, merged, least, pairs)]
        flat[at] = merged[at]
        keep = np.ones(len(flat), dtype=bool)
        keep[at + 1] = False
        lengths = lengths - np.bincount(owner[at], minlength=len(rows))
        new = np.zeros(len(flat), dtype=bool)
        new[at] = True
        flat, rank, merged, owner, new = flat[keep], rank[keep], merged[keep], owner[keep], new[keep]
        touched = new.copy()
        touched[:-1] |= new[1:]
        touched = np.flatnonzero(touched)
        inside = touched[(touched + 1 < len(flat))]
        inside = inside[owner[inside] == owner[inside + 1]]
        rank[touched] = NONE
        slot = pairs.find(flat[inside], flat[inside + 1])
        rank[inside], merged[inside] = pairs.rank[slot], pairs.merged[slot]
    order = np.argsort(np.concatenate(done_rows), kind="stable")
    out = Ragged(np.concatenate(done_flat), np.concatenate(done_lengths)).take(order)
    assert len(out.lengths) == n
    return out


def _ranks(flat: np.ndarray, lengths: np.ndarray, pairs: Pairs) -> tuple[np.ndarray, np.ndarray]:
    rank, merged = np.full(len(flat), NONE), np.zeros(len(flat), dtype=np.int64)
    if len(flat) > 1:
        slot = pairs.find(flat[:-1], flat[1:])
        rank[:-1], merged[:-1] = pairs.rank[slot], pairs.merged[slot]
        rank[np.cumsum(lengths) - 1] = NONE
    return rank, merged


def _safe(at: np.ndarray, flat: np.ndarray, owner: np.ndarray, merged: np.ndarray, least: np.ndarray, pairs: Pairs) -> np.ndarray:
    """Which places may merge now: all of a sequence, or its first where a new neighbour pair ranks no higher."""
    own, limit, bad = owner[at], least[owner[at]], np.zeros(len(at), dtype=bool)
    repeated = np.zeros(len(at), dtype=bool)
    repeated[1:] = own[1:] == own[:-1]
    repeated[:-1] |= repeated[1:]

    def test(k: np.ndarray, left: np.ndarray, right: np.ndarray) -> None:
        bad[k] |= pairs.rank[pairs.find(left, right)] <= limit[k]

    k = np.flatnonzero(repeated)
    before = k[(at[k] > 0)]
    before = before[owner[at[before] - 1] == own[before]]
    test(before, flat[at[before] - 1], merged[at[before]])
    after = k[at[k] + 2 < len(flat)]
    after = after[owner[at[after] + 2] == own[after]]
    test(after, merged[at[after]], flat[at[after] + 2])
    twin = k[:-1][(at[k[1:]] == at[k[:-1]] + 2) & (own[k[1:]] == own[k[:-1]])] if len(k) else k
    test(twin, merged[at[twin]], merged[at[twin]])
    ok = np.ones(len(at), dtype=bool)
    if bad.any():
        risky = np.zeros(len(least), dtype=bool)
        risky[own[bad]] = True
        first = np.ones(len(at), dtype=bool)
        first[1:] = own[1:] != own[:-1]
        ok = first | ~risky[own]
    return ok


def _leftmost(symbols: list[int], pairs: Pairs) -> list[int]:
    """Merges of one rank from left to right: what stands to the left has no pair left."""
    known: dict[tuple[int, int], int | None] = {}

    def joined(a: int, b: int) -> int | None:
        if (a, b) not in known:
            slot = pairs.find(np.array([a]), np.array([b]))[0]
            known[a, b] = int(pairs.merged[slot]) if pairs.rank[slot] < NONE else None
        return known[a, b]

    out: list[int] = []
    for symbol in symbols:
        out.append(symbol)
        while len(out) > 1 and (one := joined(out[-2], out[-1])) is not None:
            out[-2:] = [one]
    return out


class Known:
    """What distinct pre-tokens came to, by 64-bit hash: number of tokens, and the tokens where asked for.
    It starts anew beyond a number of entries, so its memory is bounded."""

    def __init__(self, most: int = 1_000_000) -> None:
        self.most, self.held = most, {}

    def look_up(self, keys: np.ndarray, make) -> list:
        """The value of each distinct key; make(positions) gives the values of those not held."""
        if len(self.held) > self.most:
            self.held.clear()
        listed = keys.tolist()
        values = list(map(self.held.get, listed))
        missing = [i for i, v in enumerate(values) if v is None]
        if missing:
            for i, value in zip(missing, make(np.array(missing))):
                values[i] = self.held[listed[i]] = value
        return values
