"""Byte-level BPE: pre-tokens by an associative scan of transition functions, cached merging, decoding."""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import Known, Pairs, Ragged, expand, merge
from ledgerline.llm.token_counts import text_batches
from ledgerline.llm.words import hashes

# fixed values: the code points of white space in the split pattern
WHITE = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# fixed values: the contractions of the split pattern, by their length after the apostrophe
SHORT, LONG = ("s", "t", "m", "d"), ("re", "ve", "ll")

# code points that text_digests encodes at once, about; its arrays are many times as large
LETTERS_HELD = 1 << 17

# classes of a code point; those of white space and apostrophes look at what follows
LETTER, NUMBER, OTHER, BLANK, LAST, INNER, SHORT_MARK, LONG_MARK = range(8)
# what the code point before leaves open: a run of one kind, a blank that joins what follows, white space,
# nothing, or one or two more letters of a contraction
IN_LETTERS, IN_NUMBERS, IN_OTHER, AFTER_BLANK, IN_WHITE, ENDED, ONE_MORE, TWO_MORE = range(8)


def _step(state: int, kind: int) -> tuple[int, bool]:
    """The state after a code point, and whether a pre-token starts at it."""
    if state == TWO_MORE:
        return ONE_MORE, False
    if state == ONE_MORE:
        return ENDED, False
    if kind in (SHORT_MARK, LONG_MARK):
        if state in (IN_OTHER, AFTER_BLANK):
            return IN_OTHER, False
        return (ONE_MORE if kind == SHORT_MARK else TWO_MORE), True
    if kind == BLANK:
        return AFTER_BLANK, True
    if kind == LAST:
        return ENDED, True
    if kind == INNER:
        return IN_WHITE, state != IN_WHITE
    run = {LETTER: IN_LETTERS, NUMBER: IN_NUMBERS, OTHER: IN_OTHER}[kind]
    return run, state not in (run, AFTER_BLANK)


def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All functions from state to state that runs of classes compose, with the identity (number 0) and the constant
    ones (numbers 1 to 8): the table of each, the number of each class's own function, the composition of any two."""
    table: list[tuple[int, ...]] = []
    number: dict[tuple[int, ...], int] = {}

    def named(f: tuple[int, ...]) -> int:
        if f not in number:
            number[f] = len(table)
            table.append(f)
        return number[f]

    named(tuple(range(8)))
    for state in range(8):
        named((state,) * 8)
    base = [named(tuple(_step(s, k)[0] for s in range(8))) for k in range(8)]
    for f in table:  # grows on the way
        for g in base:
            named(tuple(table[g][s] for s in f))
    then = [[number[tuple(g[s] for s in f)] for g in table] for f in table]
    return np.array(table, dtype=np.uint8), np.array(base, dtype=np.uint16), np.array(then, dtype=np.uint16)


IDENTITY, CONSTANT = 0, 1
TABLE, BASE, THEN = _functions()
STARTS = np.array([[_step(s, k)[1] for k in range(8)] for s in range(8)])


@lru_cache(maxsize=1)
def _kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, dtype=np.uint8)
    for point in range(0x110000):
        major = unicodedata.category(chr(point))[0]
        if major == "L":
            kinds[point] = LETTER
        elif major == "N":
            kinds[point] = NUMBER
    kinds[WHITE] = INNER
    return kinds


def boundaries(points: np.ndarray, begins: np.ndarray, width: int = 128) -> np.ndarray:
    """Where pre-tokens start, over code points of several texts that begin at `begins`.

    Each code point's class is a function of the state; composing functions is associative, so a scan needs no
    order: rows of `width` code points are composed side by side, then the rows' totals, and each row's
    states follow from the state that reaches it. A text's end counts as white space that nothing follows.
    """
    n = len(points)
    raw = _kinds()[points]
    last = np.zeros(n, dtype=bool)
    last[begins[1:] - 1] = True
    last[-1] = True
    white = raw == INNER
    ahead = np.zeros(n, dtype=bool)  # something else than white space follows in the text
    ahead[:-1] = ~white[1:]
    ahead &= ~last
    kind = raw.copy()
    kind[white & ahead] = LAST
    kind[(points == 0x20) & ahead] = BLANK
    mark = np.flatnonzero((points == 0x27) & ~last)
    kind[mark[np.isin(points[mark + 1], [ord(c) for c in SHORT])]] = SHORT_MARK
    mark = mark[mark + 2 < n]
    mark = mark[~last[mark + 1]]
    for a, b in LONG:
        kind[mark[(points[mark + 1] == ord(a)) & (points[mark + 2] == ord(b))]] = LONG_MARK

    # a text's first code point starts anew: its function is that of its class after nothing
    rows = -(-n // width)
    grid = np.full(rows * width, IDENTITY, dtype=np.uint16)
    grid[:n] = BASE[kind]
    grid[begins] = CONSTANT + TABLE[BASE[kind[begins]], ENDED]
    grid = np.ascontiguousarray(grid.reshape(rows, width).T)
    for k in range(1, width):
        grid[k] = THEN[grid[k - 1], grid[k]]
    total = grid[-1].copy()
    shift = 1
    while shift < rows:
        total[shift:] = THEN[total[:-shift], total[shift:]]
        shift *= 2
    reached = np.full(rows, ENDED, dtype=np.uint8)
    reached[1:] = TABLE[total[:-1], ENDED]
    after = np.ascontiguousarray(TABLE[grid, reached[None, :]].T).reshape(-1)[:n]
    before = np.full(n, ENDED, dtype=np.uint8)
    before[1:] = after[:-1]
    before[begins] = ENDED
    return STARTS[before, kind]


class ByteEncoder:
    """A file of base64 tokens and ranks as arrays; the rank is the id. What only encoding needs is made when it is first asked for."""

    def __init__(self, path: str) -> None:
        self.path = path
        ranks = self._ranks()
        size = max(ranks.values()) + 1
        tokens = [b""] * size
        for token, i in ranks.items():
            tokens[i] = token
        self.tokens = Ragged.of(tokens)
        self.decimals = Ragged.of([b"%d " % i for i in range(size)])
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        self.known = Known()

    def _ranks(self) -> dict[bytes, int]:
        with open(self.path, "rb") as lines:
            return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}

    @cached_property
    def pairs(self) -> Pairs:
        ranks = self._ranks()
        flat = (x for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks for x in (ranks[t[:k]], ranks[t[k:]], i))
        left, right, merged = np.fromiter(flat, dtype=np.int64).reshape(-1, 3).T
        return Pairs(left, right, merged, merged)

    def encode(self, texts: list[str]) -> tuple[Ragged, Ragged]:
        """Ids of each text, and the byte at which each of its pre-tokens ends."""
        data = np.frombuffer("".join(texts).encode("utf-8", "surrogatepass"), dtype=np.uint8)
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        if not len(points):
            none = Ragged(np.zeros(0, dtype=np.int64), np.zeros(len(texts)))
            return none, none
        begins = np.cumsum(sizes) - sizes
        edge = boundaries(points, begins[sizes > 0])
        width = 1 + (points >= 0x80).astype(np.int64) + (points >= 0x800) + (points >= 0x10000)
        byte_at = np.concatenate([[0], np.cumsum(width)])
        at = np.flatnonzero(edge)
        starts = byte_at[at]
        ends = np.append(starts[1:], len(data))
        keys, first, back = np.unique(hashes(data, starts, ends, fold=False), return_index=True, return_inverse=True)
        values = self.known.look_up(keys, lambda k: self._merge(data, starts[first[k]], ends[first[k]]))
        own = Ragged(np.frombuffer(b"".join(values), dtype=np.int32), np.array([len(v) // 4 for v in values]))
        ids = own.take(back)
        where = np.searchsorted(at, np.append(begins, len(points)))
        pieces = where[1:] - where[:-1]
        total = np.concatenate([[0], np.cumsum(ids.lengths)])
        text_ends = Ragged(ends - np.repeat(byte_at[begins], pieces), pieces)
        return Ragged(ids.flat, total[where[1:]] - total[where[:-1]]), text_ends

    def _merge(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
        out = merge(Ragged(self.byte[data[expand(starts, ends - starts)]], ends - starts), self.pairs)
        flat = out.flat.astype(np.int32).tobytes()
        return [flat[4 * a : 4 * (a + n)] for a, n in zip(out.starts.tolist(), out.lengths.tolist())]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.tokens.take(ids).flat.tobytes()

    def decimal(self, ids: np.ndarray) -> bytes:
        """The ids in decimal, joined by one space."""
        return self.decimals.take(ids).flat[:-1].tobytes()


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def encode(docs: DataFrame, path: str, offsets: bool = True, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids, and with offsets the byte at which each pre-token ends; one row per given row.

    path: a file of base64 tokens and ranks. Null and empty texts have no ids. Special strings are text.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            for first, last in text_batches(texts):
                ids, ends = own.encode(texts[first:last])
                columns = [part.column(0).slice(first, last - first), _lists(ids)] + ([_lists(ends)] if offsets else [])
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "ends"][: len(columns)])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, ids array<int>" + (", ends array<int>" if offsets else ""))


def _lists(rows: Ragged) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum(rows.lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(rows.flat.astype(np.int32)))


def _rows(column: pa.Array) -> Iterator[np.ndarray]:
    flat, offsets = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b in zip(offsets[:-1], offsets[1:]):
        yield flat[a:b]


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts:
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([own.decode(ids) for ids in _rows(part.column(1))], pa.binary())], ["doc_id", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, data binary")


def digests(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, and SHA-256 of the ids as text and of the bytes that they decode to."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts:
            yield _digested(own, part.column(0), _rows(part.column(1)))

    return encoded.select("doc_id", "ids").mapInArrow(run, DIGESTS)


def text_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``digests(encode(docs, path), path)`` from one pass, in which the ids stay in the worker that made them."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            for first, last in text_batches(texts, LETTERS_HELD):
                ids, _ = own.encode(texts[first:last])
                rows = (ids.flat[a : a + n] for a, n in zip(ids.starts, ids.lengths))
                yield _digested(own, part.column(0).slice(first, last - first), rows)

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, DIGESTS)


DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digested(own: ByteEncoder, doc_id: pa.Array, rows: Iterator[np.ndarray]) -> pa.RecordBatch:
    found = [(len(ids), hashlib.sha256(own.decimal(ids)).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()) for ids in rows]
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array([r[0] for r in found], pa.int64()),
         pa.array([r[1] for r in found], pa.string()), pa.array([r[2] for r in found], pa.string())],
        ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])
