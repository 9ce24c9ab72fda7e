"""Fingerprints by locally consistent parsing: equal stretches of text get equal names wherever they stand."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.words import codes, hashes, mix

LEVELS = (2, 3)
KEPT = 64
_LAST_ID = (1 << 63) - 1


def _tables() -> tuple[np.ndarray, np.ndarray]:
    """The place of the only bit set, by a product's top bits; a coin toss of two labels below 64."""
    place = np.zeros(32, dtype=np.uint8)
    for bit in range(32):
        place[((1 << bit) * 0x077CB531 & 0xFFFFFFFF) >> 27] = bit
    toss = np.zeros((64, 64), dtype=np.uint8)
    for a in range(64):
        for b in range(64):
            low = ((a ^ b) & -(a ^ b)).bit_length() - 1 if a != b else 0
            toss[a, b] = 2 * low + (a >> low & 1)
    return place, toss.reshape(-1)


PLACE, TOSS = _tables()


def _left(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The value before each; before a text stands 0."""
    out = np.empty_like(values)
    out[1:] = values[:-1]
    out[begins] = 0
    return out


def _starts(symbols: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where phrases start. A symbol's label is the lowest bit in which it differs from its left neighbour, with that
    bit; four tosses leave six labels, and a phrase starts where a label is larger than both beside it. So a start
    depends on a few neighbours only, and two starts are a few symbols apart."""
    short = (symbols ^ symbols >> np.uint64(32)).astype(np.uint32)
    differ = short ^ _left(short, begins)
    low = differ & (~differ + np.uint32(1))
    place = PLACE[low * np.uint32(0x077CB531) >> np.uint32(27)]
    label = (place << 1 | (short >> place & 1).astype(np.uint8)).astype(np.uint16)
    for _ in range(3):
        label = TOSS[label << 6 | _left(label, begins)].astype(np.uint16)
    peak = np.zeros(len(label), dtype=bool)
    peak[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    peak[begins[1:] - 1] = False  # a text's last symbol has no right neighbour
    peak[begins] = True
    return np.flatnonzero(peak)


def _next_level(symbols: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of phrases and where each text begins among them. A run of one symbol is first one symbol with its length."""
    change = np.ones(len(symbols), dtype=bool)
    change[1:] = symbols[1:] != symbols[:-1]
    change[begins] = True
    at = np.flatnonzero(change)
    length = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    begins = np.searchsorted(at, begins)
    symbols = symbols[at]
    many = length > 1
    if many.any():
        symbols[many] = mix(symbols[many] + mix(length[many]))
    starts = _starts(symbols, begins)
    names = hashes(symbols, starts, np.append(starts[1:], len(symbols)), fold=False)
    return names, np.searchsorted(starts, begins)


def sketches(texts: list[str]) -> list[np.ndarray]:
    """The KEPT least distinct 32-bit names of the phrases of LEVELS of each whole text, with one name for the text's
    last level, so every text has some; an empty text has none."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    full = np.flatnonzero(sizes)
    out = [np.zeros(0, dtype=np.uint32)] * len(texts)
    if not len(full):
        return out
    begins = (np.cumsum(sizes) - sizes)[full]
    symbols, held = codes(points), []
    for level in range(1, max(LEVELS) + 1):
        symbols, begins = _next_level(symbols, begins)
        if level in LEVELS:
            held.append((mix(symbols + np.uint64(level)), np.append(begins, len(symbols))))
    for k, i in enumerate(full.tolist()):
        names = np.concatenate([v[b[k] : b[k + 1]] for v, b in held]) >> np.uint64(32)
        out[i] = np.unique(names)[:KEPT].astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of common names among the least names of both, an estimate of the Jaccard likeness. Two empty texts are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.union1d(a, b)[:KEPT]
    return float(np.isin(both, np.intersect1d(a, b)).sum() / len(both))


def text(sketch: np.ndarray) -> str:
    return sketch.astype(">u4").tobytes().hex()


def parsed(value: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(value), dtype=">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint of every row: hexadecimal names of 8 digits each, in ascending order; empty for null and empty texts."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            found = [text(s) for a, b in _batches(texts) for s in sketches(texts[a:b])]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, "doc_id long, fingerprint string")


def _batches(texts: list[str]):
    from ledgerline.llm.token_counts import text_batches

    return text_batches(texts, 1 << 18)


def neighbours(docs: DataFrame) -> DataFrame:
    """Rows (part, tail, doc_id, text) such that each part, sorted, holds a stretch of the ids and, marked as tail, what follows it.

    Parts begin at ids of the table (quantiles of the ids), so the row that follows a part is known without looking into
    others; after the last id comes the first. Rows without an id come last. Only the cut ids reach the driver."""
    spark = docs.sparkSession
    keyed = docs.withColumn("key", F.coalesce("doc_id", F.lit(_LAST_ID)))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = ", ".join(repr(k / n) for k in range(n))
    found = keyed.agg(F.expr(f"percentile_approx(key, array({shares}), 10000)").alias("cuts"), F.min("key").alias("first")).first()
    cuts = sorted({c for c in found.cuts or [] if c > found.first})
    ids = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    part = F.size(F.filter(ids, lambda c: c <= F.col("key")))
    at = lambda where, tail: F.struct(where.alias("part"), F.lit(tail).alias("tail"))
    places = (F.when(F.col("key") == F.lit(found.first), F.array(at(part, False), at(F.lit(len(cuts)), True)))
              .when(F.array_contains(ids, F.col("key")), F.array(at(part, False), at(part - 1, True)))
              .otherwise(F.array(at(part, False))))
    return (keyed.select(F.explode(places).alias("p"), "key", "doc_id", "text").select("p.part", "p.tail", "key", "doc_id", "text")
            .repartition(n, "part").sortWithinPartitions("part", "tail", "key", "text"))


def edited(own: str, following: str) -> str:
    """The text whose last quarter is replaced by as many first code points of the following text."""
    n = len(own) // 4
    return own[: len(own) - n] + following[:n]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is that of the next row by id, then text; rows without an id come last, and after the last row the
    first follows. Null and empty texts have an empty fingerprint; equal texts have equal ones."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
        held: list[tuple] = []  # (part, tail, doc_id, text) in order; the last waits for the row that follows
        size = 0

        def out() -> pa.RecordBatch:
            texts = [h[3] for h in held]
            changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
            own, new = sketches(texts), sketches(changed)
            rows = []
            for i, (a, b) in enumerate(zip(held, held[1:])):
                if not a[1] and a[0] == b[0]:
                    rows.append((a[2], len(a[3]), hashlib.sha256(changed[i].encode()).hexdigest(), text(own[i]), text(new[i]),
                                 likeness(own[i], new[i]), likeness(own[i], own[i + 1])))
            columns = list(zip(*rows)) or [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

        for batch in parts:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                held.append(row)
                size += len(row[3])
                if size > 1 << 17 and len(held) > 1:
                    yield out()
                    held, size = held[-1:], len(row[3])
        if len(held) > 1:
            yield out()

    return neighbours(docs).select("part", "tail", "doc_id", "text").mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
