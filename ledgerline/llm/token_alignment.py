"""Alignment of two tokenizers' tokens by the byte offsets where both end, and how often an id pair ends together."""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from hashlib import sha256
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.bpe import Known, Pairs, Ragged
from ledgerline.llm.byte_bpe import ByteEncoder
from ledgerline.llm.tables import cut
from ledgerline.llm.token_counts import SPACE_MARK, text_batches

ENTRIES = 1 << 18


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: printable Latin-1 letters are their own byte, the other
    bytes follow in order from code point 256."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + n): b for n, b in enumerate(hidden)}


@lru_cache(maxsize=1)
def unassigned() -> np.ndarray:
    """Code points that Python's tables do not know yet."""
    return np.array([unicodedata.category(chr(c)) == "Cn" for c in range(0x110000)])


class FileEncoder(ByteEncoder):
    """Byte-level BPE of a `tokenizers` file, its merges in the order that the file lists them. Texts with code points newer than
    Python's tables, which the library may class otherwise, are left to the library."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        letters, ids = byte_letters(), model["vocab"]
        self.bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab().items():
            self.bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.byte = np.array([ids[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        rows = [(ids[a], ids[b], ids[a + b], rank) for rank, (a, b) in enumerate(merges)]
        self.pairs = Pairs(*(np.array(c, dtype=np.int64) for c in zip(*rows)))
        self.known = Known(ENTRIES)

    def ids(self, texts: list[str]) -> Ragged:
        points = [np.frombuffer(t.encode("utf-32-le"), dtype=np.uint32) for t in texts]
        new = [i for i, p in enumerate(points) if unassigned()[p].any()]
        known, _ = super().encode(["" if i in new else t for i, t in enumerate(texts)] if new else texts)
        if not new:
            return known
        rows = np.split(known.flat, np.cumsum(known.lengths)[:-1])
        for i, found in zip(new, self.library.encode_batch_fast([texts[i] for i in new], add_special_tokens=False)):
            rows[i] = np.array(found.ids, dtype=np.int64)
        return Ragged(np.concatenate(rows), np.array([len(r) for r in rows]))


@dataclass
class Aligned:
    """Groups of several texts: each text's numbers of tokens and groups, the ids, and the token after each group's last one."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    a: np.ndarray
    b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray


class Pair:
    """Tokenizer A (a byte-level file of `tokenizers`, given a space before the text) and B (a SentencePiece model, which adds
    that space itself), with the bytes of every id."""

    def __init__(self, path_a: str, path_b: str) -> None:
        import sentencepiece

        self.a = FileEncoder(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_a = self.a.bytes
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        if not (all(self.bytes_a) and all(self.bytes_b)):
            raise ValueError("a vocabulary holds a token of no bytes")
        self.own, self.other = Ragged.of(self.bytes_a), Ragged.of(self.bytes_b)
        self.decimals = Ragged.of([b"%d," % i for i in range(max(len(self.bytes_a), len(self.bytes_b)))])

    def encode(self, texts: list[str]) -> tuple[Ragged, Ragged]:
        """Ids of A and B for each text; none where either's bytes aren't those of space+text."""
        spaced = [" " + t if t else "" for t in texts]
        listed = self.b.encode(texts, num_threads=1)
        a, b = self.a.ids(spaced), Ragged(np.fromiter(chain.from_iterable(listed), dtype=np.int64), np.array([len(x) for x in listed]))
        want = [t.encode() for t in spaced]
        same = np.ones(len(texts), dtype=bool)
        for ids, table in ((a, self.own), (b, self.other)):
            data = table.take(ids.flat).flat.tobytes()
            ends = np.concatenate([[0], np.cumsum(table.lengths[ids.flat])])[np.concatenate([[0], np.cumsum(ids.lengths)])].tolist()
            same &= [data[i:j] == w for i, j, w in zip(ends, ends[1:], want)]
        return tuple(Ragged(ids.flat[np.repeat(same, ids.lengths)], ids.lengths * same) for ids in (a, b))

    def align(self, texts: list[str]) -> Aligned:
        """Cuts the texts where tokens of both end. Every token has bytes, so no offset of one text, counted on from text to text,
        is another's, and of a group only the last token of either side end together."""
        a, b = self.encode(texts)
        ends_a, ends_b = (np.cumsum(table.lengths[ids.flat]).tolist() for ids, table in ((a, self.own), (b, self.other)))
        index_a, index_b = dict(zip(ends_a, range(1, len(ends_a) + 1))), dict(zip(ends_b, range(1, len(ends_b) + 1)))
        common = sorted(index_a.keys() & index_b.keys())
        at_a, at_b = (np.fromiter(map(index.__getitem__, common), dtype=np.int64, count=len(common)) for index in (index_a, index_b))
        groups = np.searchsorted(at_a, np.cumsum(a.lengths), side="right")
        return Aligned(a.lengths, b.lengths, np.diff(groups, prepend=0), a.flat, b.flat, at_a, at_b)

    def digests(self, found: Aligned) -> list[str]:
        """The hash of each text's groups in decimal; empty without tokens."""
        before = np.concatenate([[0], found.at_b])[:-1]
        place_a = np.arange(len(found.a)) + np.repeat(before, np.diff(found.at_a, prepend=0))
        place_b = np.arange(len(found.b)) + np.repeat(found.at_a, np.diff(found.at_b, prepend=0))
        ids = np.empty(len(found.a) + len(found.b), dtype=np.int64)
        ids[place_a], ids[place_b] = found.a, found.b
        written = self.decimals.take(ids)
        flat, ends = written.flat, np.cumsum(written.lengths)
        flat[ends[place_a[found.at_a - 1]] - 1] = ord("|")
        flat[ends[place_b[found.at_b - 1]] - 1] = ord(";")
        data = flat.tobytes()
        last = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(found.n_a + found.n_b)])].tolist()
        return [sha256(data[i : j - 1]).hexdigest() if j > i else "" for i, j in zip(last, last[1:])]

    def links(self, found: Aligned) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct linked pairs: where they start, their ids of A and of B, and how often they are linked."""
        text = np.repeat(np.arange(len(found.n_a)), found.n_groups)
        size_a, size_b = len(self.bytes_a), len(self.bytes_b)
        code, n = np.unique((text * size_a + found.a[found.at_a - 1]) * size_b + found.b[found.at_b - 1], return_counts=True)
        starts = np.searchsorted(code, np.arange(len(found.n_a) + 1) * (size_a * size_b))
        return starts, code // size_b % size_a, code % size_b, n


@lru_cache(maxsize=1)
def pair_of(path_a: str, path_b: str) -> Pair:
    return Pair(path_a, path_b)


GROUPED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, a array<int>, b array<int>, n array<long>"


def groups(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's token and group numbers, its groups' digest, and its distinct linked pairs a[i], b[i] with their number n[i]."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(path_a, path_b)
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            for first, last in text_batches(texts):
                found = pair.align(texts[first:last])
                starts, a, b, n = pair.links(found)
                lists = [pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(v, t)) for v, t in ((a, pa.int32()), (b, pa.int32()), (n, pa.int64()))]
                numbers = [pa.array(v, pa.int64()) for v in (found.n_a, found.n_b, found.n_groups)]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(first, last - first), *numbers, pa.array(pair.digests(found), pa.string()), *lists],
                                                 [c.split()[0] for c in GROUPED.split(", ")])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, GROUPED)


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row, repeated rows each, in any order.

    Texts are encoded once, into a written table that holds each text's linked pairs; the pairs' numbers are summed over all texts.
    Of two tokens that end together the shorter one's bytes end the longer's, so the pairs number at most the bytes of both
    vocabularies' tokens (times the ids of equal bytes), whatever the corpus: that table alone goes to every task. n_best counts
    links whose pair is the most frequent of its B id, ties included. Null and empty texts, and texts that a tokenizer
    changes, have no tokens. Ids are passed on as they are, null too; extra columns are not read.
    """
    given = cut(groups(docs, path_a, path_b, id_col, text_col))
    counted = given.select(F.inline(F.arrays_zip("a", "b", "n"))).groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    pairs, numbers = counted["a"].to_numpy().astype(np.int64) << 32 | counted["b"].to_numpy(), counted["n"].to_numpy()
    order = np.argsort(pairs)
    highest = np.zeros(int(counted["b"].to_numpy().max(initial=-1)) + 1, dtype=np.int64)
    np.maximum.at(highest, counted["b"].to_numpy(), numbers)
    shared = docs.sparkSession.sparkContext.broadcast((pairs[order], numbers[order], highest))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, numbers, highest = shared.value
        for part in parts:
            a, b, n = (part.column(c).flatten().to_numpy(zero_copy_only=False) for c in ("a", "b", "n"))
            each = numbers[np.searchsorted(pairs, a.astype(np.int64) << 32 | b)]
            sizes = part.column("a").value_lengths().to_numpy(zero_copy_only=False)
            ends = np.cumsum(sizes)
            sums = [np.concatenate([[0], np.cumsum(v, dtype=np.int64)]) for v in (n * (each == highest[b]), n * each)]
            best, total = (pa.array(s[ends] - s[ends - sizes], pa.int64()) for s in sums)
            # a group holds one link
            yield pa.RecordBatch.from_arrays([*(part.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_groups")), best, total, part.column("groups_sha256")],
                                             ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return given.mapInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")
