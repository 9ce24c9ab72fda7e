"""Hard negatives: exact integer scores of anchors by subset-sum tables (four Russians) over candidates' packed bit planes."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.tables import cut

ANCHORS, CANDIDATES, AT_ONCE = 512, 4096, 512
NONE = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Shape:
    """How components are packed: `bits` planes in two's complement, `groups` bytes a plane of eight dimensions each."""

    bits: int
    groups: int

    def pack(self, rows: list[np.ndarray]) -> list[bytes]:
        """Each row's planes, the sign's first. Dimensions that a row lacks are zero."""
        whole = np.zeros((len(rows), 8 * self.groups), dtype=np.int64)
        for own, row in zip(whole, rows):
            own[: len(row)] = row
        planes = (whole[:, None, :] >> np.arange(self.bits - 1, -1, -1)[None, :, None]) & 1
        return [p.tobytes() for p in np.packbits(planes.astype(np.uint8), axis=2, bitorder="little")]

    def bytes_of(self, packed: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(packed), dtype=np.uint8).reshape(len(packed), self.bits, self.groups)

    def unpack(self, packed: list[bytes]) -> np.ndarray:
        planes = np.unpackbits(self.bytes_of(packed), axis=2, bitorder="little").astype(np.int64)
        weights = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        weights[0] = -weights[0]
        return np.einsum("nbd,b->nd", planes, weights)


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """[group, byte, anchor]: the sum of those of the group's eight components whose bit is set in the byte."""
    groups = anchors.shape[1] // 8
    parts = anchors.T.reshape(groups, 8, len(anchors))
    sums = np.zeros((groups, 256, len(anchors)), dtype=anchors.dtype)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + parts[:, k : k + 1]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[anchor, candidate]: inner products. Each plane's bytes look up the tables; planes are added by shifting."""
    total = np.zeros((len(planes), sums.shape[2]), dtype=sums.dtype)
    found = np.empty_like(total)
    for plane in range(planes.shape[1]):
        if plane == 1:
            np.negative(total, out=total)  # the sign plane counts below zero
        if plane:
            np.left_shift(total, 1, out=total)
        for group in range(planes.shape[2]):
            np.take(sums[group], planes[:, plane, group], axis=0, out=found)
            total += found
    return np.ascontiguousarray((-total if planes.shape[1] == 1 else total).T).astype(np.int64, copy=False)


def first(score: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(anchors, candidates, scores) of the k greatest of each row, one place at a time; the leftmost of equal ones comes first. NONE never counts."""
    score = score.copy()
    rows = np.arange(len(score))
    for _ in range(min(k, score.shape[1])):
        best = score.argmax(axis=1)
        value = score[rows, best]
        there = value > NONE
        if not there.any():
            return
        yield rows[there], best[there], value[there]
        score[rows, best] = NONE


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(vec_id, label, q): rows with an id, a label and finite components only, components floored after scaling; one row an id."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    ok = given.where("vec_id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    shifted = F.expr("CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END")
    one = ok.groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("r")).select("vec_id", "r.label", "r.v")
    return one.select("vec_id", shifted.alias("label"), F.expr(f"transform(v, x -> floor({scale} * x))").alias("q"))


def hard_negatives(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", every: int = 50,
                   positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor (a row whose id is divisible by
    `every`) and each of its first `positives` other rows of the same label, the first `negatives` rows of other labels that score
    between `least` and `most` percent of the positive. Scores are exact inner products of floor(scale * component); higher ones come
    first, ties by the smaller id. Labels of ids divisible by 7 are moved on by one of ten first.

    Anchors meet every row in blocks of bounded size: each block of anchors makes its tables once, blocks of one label give the
    positives, blocks of all rows the negatives, and a block returns a bounded number of rows an anchor. A label that holds a third
    of all rows is many blocks. Rows without an id, label or vector, or with a null or non-finite component, take no part;
    repeated ids count once (least label, then least vector); shorter vectors lack only zeros; extra columns are not read.
    Scores that no long can hold are refused with an error.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col, label_col, scale)
    seen = rows.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("d"), F.min(F.array_min("q")).alias("lo"), F.max(F.array_max("q")).alias("hi"),
                    F.count_if(F.col("vec_id") % every == 0).alias("asked")).first()
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not seen.asked:
        return spark.createDataFrame([], schema)
    lo, hi = int(seen.lo or 0), int(seen.hi or 0)
    shape = Shape(max(hi.bit_length(), (-lo - 1).bit_length() if lo < 0 else 0) + 1, max(1, -(-seen.d // 8)))
    bound = 8 * shape.groups << 2 * shape.bits  # no sum on the way is larger
    if bound * 100 >= 1 << 63:
        raise ValueError(f"components from {lo} to {hi}: scores may not fit a long")
    kind = np.int32 if bound < 1 << 31 else np.int64

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"vec_id": batch["vec_id"], "label": batch["label"], "planes": shape.pack(list(batch["q"]))})

    packed = cut(rows.mapInPandas(pack, "vec_id long, label long, planes binary"))
    # columns of their own, for anchors meet the table that they come from
    anchors = packed.where(F.col("vec_id") % every == 0).select(*(F.col(c).alias(c) for c in packed.columns))

    def met(asked: pd.DataFrame, held: pd.DataFrame) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(scores, ids, labels) of the block's candidates in order of their ids, AT_ONCE at a time."""
        held = held.sort_values("vec_id", kind="stable")
        sums = subset_sums(shape.unpack(list(asked["planes"])).astype(kind))
        for at in range(0, len(held), AT_ONCE):
            part = held.iloc[at : at + AT_ONCE]
            yield scores(sums, shape.bytes_of(list(part["planes"]))), part["vec_id"].to_numpy(), part["label"].to_numpy()

    def nearest(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for score, ids, _ in met(asked, held) if len(asked) and len(held) else ():
            score[asked["vec_id"].to_numpy()[:, None] == ids[None, :]] = NONE
            out += [pd.DataFrame({"anchor_id": asked["vec_id"].to_numpy()[a], "positive_id": ids[c], "positive_score": s}) for a, c, s in first(score, positives)]
        return _top(out, ["anchor_id"], "positive_score", "positive_id", positives)

    def hard(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        for score, ids, labels in met(asked, held) if len(asked) and len(held) else ():
            score[asked["label"].to_numpy()[:, None] == labels[None, :]] = NONE
            for place in range(max(map(len, asked["positives"]))):
                own = [p[place] if place < len(p) else None for p in asked["positives"]]
                bar = np.array([p["positive_score"] if p else -1 for p in own], dtype=np.int64)
                low, high = -(-least * bar // 100), most * bar // 100
                fits = np.where((score >= low[:, None]) & (score <= high[:, None]) & np.array([p is not None for p in own])[:, None], score, NONE)
                out += [pd.DataFrame({"anchor_id": asked["vec_id"].to_numpy()[a], "positive_id": [own[i]["positive_id"] for i in a], "positive_score": bar[a],
                                      "negative_id": ids[c], "negative_score": s}) for a, c, s in first(fits, negatives)]
        return _top(out, ["anchor_id", "positive_id"], "negative_score", "negative_id", negatives, ["positive_score"])

    def blocks(count: str, size: int) -> F.Column:
        return F.expr(f"1 + ({count} - 1) DIV {size}")

    sizes = packed.groupBy("label").agg(blocks(f"count_if(vec_id % {every} = 0)", ANCHORS).alias("p"), blocks("count(*)", CANDIDATES).alias("m"))
    sizes = sizes.where("p > 0")
    i, j = F.expr("pmod(xxhash64(vec_id), p)").alias("i"), F.expr("pmod(xxhash64(vec_id, 1), m)").alias("j")
    all_i, all_j = F.expr("explode(sequence(0L, p - 1))").alias("i"), F.expr("explode(sequence(0L, m - 1))").alias("j")
    asked = anchors.join(sizes, "label").select("label", "vec_id", "planes", i, all_j)
    held = packed.join(sizes, "label").select("label", "vec_id", "planes", all_i, j)
    found = asked.groupBy("label", "i", "j").cogroup(held.groupBy("label", "i", "j")).applyInPandas(nearest, "anchor_id long, positive_id long, positive_score long")
    place = F.row_number().over(Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    best = found.withColumn("place", place).where(F.col("place") <= positives)
    best = best.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))

    p, m = 1 + (seen.asked - 1) // ANCHORS, 1 + (seen.n - 1) // CANDIDATES
    whole = {"p": F.lit(p).cast("long"), "m": F.lit(m).cast("long")}
    asked = anchors.join(best.withColumnRenamed("anchor_id", "vec_id"), "vec_id").withColumns(whole).select("vec_id", "label", "planes", "positives", i, all_j)
    held = packed.withColumns(whole).select("vec_id", "label", "planes", all_i, j)
    found = asked.groupBy("i", "j").cogroup(held.groupBy("i", "j")).applyInPandas(
        hard, "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select(*(c.split()[0] for c in schema.split(", ")))


def _top(parts: list[pd.DataFrame], keys: list[str], score: str, tie: str, k: int, others: list[str] = []) -> pd.DataFrame:
    """The first k rows a key of what a block's pieces gave."""
    if not parts:
        return pd.DataFrame({c: np.zeros(0, dtype=np.int64) for c in [*keys, tie, score, *others]})
    rows = pd.concat(parts).sort_values([*keys, score, tie], ascending=[*(True for _ in keys), False, True])
    return rows.groupby(keys, sort=False).head(k)


ORACLE = """
WITH usable AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, c.vec_id AS other_id, a.label = c.label AS same, CAST(list_inner_product(a.q, c.q) AS BIGINT) AS score
    FROM usable a JOIN usable c ON a.vec_id % 50 = 0 AND a.vec_id <> c.vec_id
), positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) AS INTEGER) AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, other_id) <= 3
"""
