"""Toxicity by compression distance: which of two zstandard dictionaries shortens a window more."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SHORTEST, LONGEST = 4, 8
GAINS = (2, 4, 6, 8)
# a piece must stand in one of so many surroundings of its class
RARE = 16_000


@dataclass(frozen=True)
class Model:
    """Contents of the two dictionaries, how often a window's bytes are repeated, words in a window, and the
    weights that turn a document's gains into a score."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]
    width: int = 1
    repeat: int = 3

    def packed(self, windows: list[bytes], content: bytes) -> np.ndarray:
        """Compressed length of each window."""
        wide = [np.repeat(np.frombuffer(w, dtype=np.uint8), self.repeat).tobytes() for w in windows]
        content = np.repeat(np.frombuffer(content, dtype=np.uint8), self.repeat).tobytes()
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY2, min_match=7, window_log=17, hash_log=16, chain_log=16, search_log=8,
            target_length=64, write_content_size=False, write_checksum=False, write_dict_id=False)
        own = zstandard.ZstdCompressor(
            compression_params=settings, dict_data=zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT))
        ends = np.cumsum([len(w) for w in wide], dtype=np.uint64)
        parts = np.stack([np.concatenate([[np.uint64(0)], ends[:-1]]), np.diff(ends, prepend=np.uint64(0))], axis=1)
        packed = own.multi_compress_to_buffer(zstandard.BufferWithSegments(b"".join(wide), np.ascontiguousarray(parts).tobytes()))
        return np.array([len(p) for p in packed], dtype=np.int64)

    def gains(self, windows: list[bytes]) -> np.ndarray:
        """Bytes that the toxic dictionary saves over the ordinary one, for each window."""
        if not windows:
            return np.zeros(0, dtype=np.int64)
        return self.packed(windows, self.ordinary) - self.packed(windows, self.toxic)


class Gains(dict):
    """Gains of distinct windows; starts anew beyond a number of entries, so its memory is bounded."""

    def __init__(self, model: Model, most: int = 1_500_000) -> None:
        super().__init__()
        self.model, self.most = model, most

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: how many windows gain at least so much (log), and the largest gain."""
        if len(self) > self.most:
            self.clear()
        cut = [windows(t, self.model.width) for t in texts]
        new = list({w for own in cut for w in own if w not in self})
        for first in range(0, len(new), 50_000):
            some = new[first : first + 50_000]
            self.update(zip(some, self.model.gains(some).tolist()))
        out = np.zeros((len(texts), len(GAINS) + 2))
        out[:, 0] = 1
        for row, own in zip(out, cut):
            gained = np.fromiter(map(self.__getitem__, own), dtype=np.int64, count=len(own))
            row[1:-1] = [np.log1p(np.count_nonzero(gained >= g)) for g in GAINS]
            row[-1] = max(0, gained.max(initial=0)) / 10
        return out


def windows(text: bytes, width: int) -> list[bytes]:
    """Stretches of `width` words of the whole text, A-Z as a-z, with a space before and after."""
    words = text.lower().split()
    if width == 1:
        return [b" %b " % w for w in words]
    return [b" %b " % b" ".join(words[i : i + width]) for i in range(0, len(words), width)]


def _contexts(texts: list[bytes]) -> Counter:
    """In how many different surroundings each word stands; copies of a text count once."""
    seen = {}
    for text in texts:
        words = text.lower().split()
        for before, word, after in zip([b"", *words], words, [*words[1:], b""]):
            seen[before, word, after] = b" %b " % word
    return Counter(seen.values())


def _pieces(word: bytes) -> set[bytes]:
    return {word[i : i + k] for k in range(SHORTEST, LONGEST + 1) for i in range(len(word) - k + 1)}


def _counted(words: Counter) -> Counter:
    out: Counter = Counter()
    for word, n in words.items():
        for piece in _pieces(word):
            out[piece] += n
    return out


def cover(own: Counter, other: Counter, most: int, ratio: float = 8.0) -> list[bytes]:
    """Pieces for a dictionary, best first: the piece that covers most bytes of words not covered yet, among
    pieces that stand in the class's own text `ratio` times as often as in the other's, and in enough surroundings."""
    n_own, n_other = max(1, sum(own.values())), max(1, sum(other.values()))
    least = max(12, n_own // RARE)
    count, against = _counted(own), _counted(other)
    fit = {p for p, n in count.items() if n >= least and n / n_own > ratio * (against[p] + 1) / n_other}
    holders = defaultdict(list)
    for word in own:
        for piece in _pieces(word) & fit:
            holders[piece].append(word)
    left = dict(own)
    value = lambda p: sum(left[w] for w in holders[p]) * (len(p) - SHORTEST + 1)
    heap = [(-count[p] * (len(p) - SHORTEST + 1), p) for p in fit]
    heapify(heap)
    chosen: list[bytes] = []
    size = 0
    while heap and size < most:
        piece = heappop(heap)[1]
        now = value(piece)
        if heap and now < -heap[0][0]:
            if now > 0:
                heappush(heap, (-now, piece))
            continue
        if now < least * (len(piece) - SHORTEST + 1):
            continue
        chosen.append(piece)
        size += len(piece)
        for word in holders[piece]:
            left[word] = 0
    return chosen


def fit(toxic: list[bytes], ordinary: list[bytes], width: int = 1, base: int = 16384, special: int = 2048) -> Model:
    """Dictionaries from two thirds of the texts of each class, weights from the rest.

    The ordinary dictionary holds frequent ordinary words. The toxic one holds them too, at the same distances, so both shorten
    ordinary windows alike; before them stand the pieces that cover what toxic text has and ordinary text lacks.
    """
    learn = [[t for i, t in enumerate(c) if i % 3] or c for c in (toxic, ordinary)]
    own, other = (_contexts(c) for c in learn)
    common = b" ".join(w.strip() for w, _ in sorted(other.items(), key=lambda x: (-x[1], x[0]))[:5000])[:base] + b" "
    marks = b"".join(reversed(cover(own, other, special)))
    model = Model(bytes(len(marks)) + common, marks + common, (), width)
    rest = [[t for i, t in enumerate(c) if i % 3 == 0] for c in (toxic, ordinary)]
    known = Gains(model)
    x = np.concatenate([known.features(c) for c in rest])
    y = np.repeat([1.0, 0.0], [len(c) for c in rest])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w += np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w)), x.T @ (y - p) - 0.1 * w)
    return Model(model.ordinary, model.toxic, tuple(w.tolist()), width)


def held_out(doc_id: str = "doc_id", parts: int = 5):
    """Whether crc32 of the id as text leaves no remainder; false without an id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, most: int = 1200) -> Model | None:
    """A model from at most `most` labelled documents of each class that are not held out, by the hash of the id. None
    where a class has none. Rows without an id, label or text teach nothing; of several labels the largest counts."""
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where(~held_out())
    classes = []
    for label in (1, 0):
        ids = marked.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")
        rows = docs.select("doc_id", "text").where("text IS NOT NULL").join(F.broadcast(ids), "doc_id")
        classes.append([r.text.encode() for r in sorted(rows.collect(), key=lambda r: (r.doc_id * 0x9E3779B1 % 2**32, r.doc_id, r.text))[: 2 * most]])
    return fit(*classes) if all(classes) else None


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for each row, repeated rows each. The score is a function of the text alone; null
    and blank texts score as texts without gains. Without a model all score 0."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Gains(model) if model is not None else None
        for part in parts:
            texts = [t or b"" for t in part.column(2).to_pylist()]
            scores = np.zeros(len(texts))
            for first in range(0, len(texts) if known is not None else 0, 64):
                x = known.features(texts[first : first + 64])
                scores[first : first + 64] = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "held_out", "score", "predicted"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    return given.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(
        run, "doc_id long, held_out boolean, score double, predicted int")


def keep_ordinary(docs: DataFrame, model: Model | None, text_col: str = "text", bound: float = 0.5, held: int = 250_000) -> DataFrame:
    """The rows of docs whose score is below the bound, with all their columns. Without a model all stay. A task holds the gains
    of at most about `held` windows and the texts of 64 rows, and lets go of them when it ends, for its worker goes on to later stages."""
    if model is None:
        return docs

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Gains(model, held)
        try:
            for part in parts:
                column = part.column(part.schema.get_field_index(text_col))
                for first in range(0, part.num_rows, 64):
                    x = known.features([(t or "").encode() for t in column.slice(first, 64).to_pylist()])
                    keep = 1 / (1 + np.exp(-np.clip(x @ np.array(model.weights), -30, 30))) < bound
                    yield part.slice(first, len(keep)).filter(pa.array(keep))
        finally:
            known.clear()
            pa.default_memory_pool().release_unused()

    return docs.mapInArrow(run, docs.schema)
