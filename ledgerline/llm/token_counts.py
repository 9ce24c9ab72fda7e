"""Token counts of a piece vocabulary (SentencePiece BPE with byte fallback), by rank-synchronous merging."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import Known, Pairs, Ragged, expand, merge
from ledgerline.llm.words import hashes

SPACE_MARK = "▁"
CODE_POINTS = 0x110000
LETTERS_AT_ONCE = 1 << 19


class PieceCounter:
    """The vocabulary file as arrays. Piece scores fall with rank; equal scores share a rank."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = [i for i in range(model.vocab_size()) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
        pieces = {model.id_to_piece(i): i for i in ids}
        level = {s: n for n, s in enumerate(sorted({model.get_score(i) for i in ids}, reverse=True))}
        rank = {p: level[model.get_score(i)] for p, i in pieces.items()}
        # a code point without a piece of its own merges with nothing and counts its bytes
        self.symbol = np.arange(CODE_POINTS, dtype=np.int64) + model.vocab_size()
        self.weight = 1 + (np.arange(CODE_POINTS) >= 0x80).astype(np.int64)
        self.weight += (np.arange(CODE_POINTS) >= 0x800).astype(np.int64) + (np.arange(CODE_POINTS) >= 0x10000)
        for piece, i in pieces.items():
            if len(piece) == 1:
                self.symbol[ord(piece)], self.weight[ord(piece)] = i, 1
        self.of_symbol = np.ones(model.vocab_size(), dtype=np.int64)
        self.vocab = model.vocab_size()

        def symbol(text: str) -> int | None:
            return pieces.get(text, int(self.symbol[ord(text)]) if len(text) == 1 else None)

        rows = [(left, right, i, rank[p]) for p, i in pieces.items() for k in range(1, len(p))
                if (left := symbol(p[:k])) is not None and (right := symbol(p[k:])) is not None]
        left, right, merged, ranks = (np.array(c, dtype=np.int64) for c in zip(*rows))
        self.pairs = Pairs(left, right, merged, ranks)
        last = int(ranks.max())
        tied = np.unique(merged[ranks == last])
        brings = np.isin(left, tied) | np.isin(right, tied)
        self.ties = last if len(tied) > 1 and (ranks[brings] == last).all() else None
        # classes: 0 joins others, 1 space mark, 2 in no longer piece
        self.kind = np.full(CODE_POINTS, 2, dtype=np.uint8)
        for piece in pieces:
            if len(piece) > 1:
                self.kind[[ord(c) for c in piece]] = 0
        self.kind[ord(SPACE_MARK)] = 1
        self.inner_mark = any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces)
        self.known = Known()

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text: a mark before it, marks for spaces, then merges within pre-tokens. A pre-token
        ends before a mark that follows another code point, for no piece goes on over it."""
        marked = [SPACE_MARK + t.replace(" ", SPACE_MARK) if t else "" for t in texts]
        sizes = np.array([len(m) for m in marked], dtype=np.int64)
        points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if not len(points):
            return np.zeros(len(texts), dtype=np.int64)
        kind = self.kind[points]
        edge = np.zeros(len(points), dtype=bool)
        edge[1:] = (kind[1:] == 2) | (kind[:-1] == 2)
        if not self.inner_mark:
            edge[1:] |= (kind[1:] == 1) & (kind[:-1] != 1)
        begins = np.cumsum(sizes) - sizes
        edge[begins[sizes > 0]] = True
        starts = np.flatnonzero(edge)
        ends = np.append(starts[1:], len(points))
        keys, first, back = np.unique(hashes(points, starts, ends), return_index=True, return_inverse=True)
        values = self.known.look_up(keys, lambda at: self._merge(points, starts[first[at]], ends[first[at]]))
        each = np.array(values, dtype=np.int64)[back]
        total = np.concatenate([[0], np.cumsum(each)])
        where = np.searchsorted(starts, np.append(begins, len(points)))
        return total[where[1:]] - total[where[:-1]]

    def _merge(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[int]:
        own = points[expand(starts, ends - starts)]
        left = merge(Ragged(self.symbol[own], ends - starts), self.pairs, self.ties)
        weights = np.where(left.flat < self.vocab, 1, self.weight[np.maximum(left.flat - self.vocab, 0)])
        return np.add.reduceat(weights, left.starts).tolist()


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def text_batches(texts: list[str], most: int = LETTERS_AT_ONCE):
    """(first, last) of stretches of texts of about `most` code points; a longer text stands alone."""
    first = size = 0
    for i, text in enumerate(texts):
        if i > first and size + len(text) > most:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, repeated rows each, in any order.

    path: a SentencePiece BPE model whose normaliser changes nothing but spaces. Null and empty texts have no
    tokens and no bytes. Ids are passed on as they are, null too.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(path)
        for part in parts:
            texts = [t or "" for t in part.column(2).to_pylist()]
            counts = [counter.count(texts[a:b]) for a, b in text_batches(texts)]
            tokens = np.concatenate(counts) if counts else np.zeros(0, dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                        F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
