"""Approximate nearest neighbours by learned partitions."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgerline.llm.tables import cut

BLOCK = 4096
# up to TRIVIAL rows all are compared; beyond, there are FEW partitions at least
TRIVIAL, FEW = 256, 4


@dataclass(frozen=True)
class Router:
    """A small network that tells the partition of a unit vector, and how many partitions a query visits."""

    hidden: np.ndarray
    out: np.ndarray
    probes: int

    def odds(self, unit: np.ndarray) -> np.ndarray:
        h = np.maximum(_biased(unit) @ self.hidden, 0)
        return _biased(h) @ self.out


def _biased(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.ones((len(x), 1))], axis=1)


def partition(near: np.ndarray, unit: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """A balanced partition of the neighbour graph: halves along principal directions, then vertices move to the part that
    most of their neighbours are in, while no part outgrows the mean by a twentieth."""
    order = [np.arange(len(unit))]
    while len(order) < parts:
        own = order.pop(int(np.argmax([len(o) for o in order])))
        axis = np.linalg.svd(unit[own] - unit[own].mean(axis=0), full_matrices=False)[2][0]
        ranked = own[np.argsort(unit[own] @ axis, kind="stable")]
        order += [ranked[: len(own) // 2], ranked[len(own) // 2 :]]
    part = np.empty(len(unit), dtype=np.int64)
    for k, own in enumerate(order):
        part[own] = k
    most = int(np.ceil(1.05 * len(unit) / parts))
    rng = np.random.default_rng(3)
    size = np.bincount(part, minlength=parts)
    for _ in range(rounds):
        moved = 0
        for v in rng.permutation(len(unit)):
            votes = np.bincount(part[near[v]], minlength=parts)
            votes[(size >= most) & (np.arange(parts) != part[v])] = -1
            to = int(np.argmax(votes))
            if votes[to] > votes[part[v]]:
                size[part[v]] -= 1
                size[to] += 1
                part[v] = to
                moved += 1
        if not moved:
            break
    return part


def fit(sample: np.ndarray, parts: int, k: int = 5, graph: int = 10, recall: float = 0.94, hidden: int = 96, steps: int = 1500) -> Router:
    """Partitions the neighbour graph of the sample's unit vectors and trains the router on where neighbours lie, on four rows of
    five. The others are queries the router has not seen: probes is the least number of most probable partitions in which `recall`
    of their k nearest of the sample lie, with two standard errors of that share as margin, and one more."""
    rng = np.random.default_rng(5)
    whole, asked = sample, np.arange(len(sample)) % 5 == 0
    sample = whole[~asked]
    near = np.empty((len(sample), min(graph, len(sample) - 1)), dtype=np.int32)
    for first in range(0, len(sample), 500):
        likeness = sample[first : first + 500] @ sample.T
        likeness[np.arange(len(likeness)), first + np.arange(len(likeness))] = -np.inf
        near[first : first + 500] = np.argsort(-likeness, axis=1, kind="stable")[:, : near.shape[1]]
    part = partition(near, sample, parts)
    share = np.zeros((len(sample), parts))
    np.add.at(share, (np.arange(len(sample))[:, None], part[near]), 1.0)
    share[np.arange(len(sample)), part] += 1
    share /= share.sum(axis=1, keepdims=True)
    x = _biased(sample)
    w = [rng.normal(0, (2 / x.shape[1]) ** 0.5, (x.shape[1], hidden)), np.zeros((hidden + 1, parts))]
    first, second = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(x), 256)
        h = np.maximum(x[pick] @ w[0], 0)
        odds = _biased(h) @ w[1]
        p = np.exp(odds - odds.max(axis=1, keepdims=True))
        d = (p / p.sum(axis=1, keepdims=True) - share[pick]) / len(pick)
        grads = [x[pick].T @ ((d @ w[1][:-1].T) * (h > 0)), _biased(h).T @ d]
        for q, g, a, b in zip(w, grads, first, second):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            q -= 0.003 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-9)
    router = Router(w[0], w[1], 1)
    home = router.odds(whole).argmax(axis=1)
    ranks = []
    queries = np.flatnonzero(asked)
    for first in range(0, len(queries), 500):
        own = queries[first : first + 500]
        likeness = whole[own] @ whole.T
        likeness[np.arange(len(own)), own] = -np.inf
        best = np.argsort(-likeness, axis=1, kind="stable")[:, : min(k, len(whole) - 1)]
        order = np.argsort(-router.odds(whole[own]), axis=1, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(parts)[None, :], axis=1)
        ranks.append(rank[np.arange(len(own))[:, None], home[best]].ravel())
    needed = np.sort(np.concatenate(ranks))
    share = min(1.0, recall + 2 * (recall * (1 - recall) / len(queries)) ** 0.5)
    probes = int(needed[min(len(needed) - 1, int(share * len(needed)))]) + 2
    return Router(w[0], w[1], min(parts, probes))


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, v): rows with an id whose vector has the table's usual length, is not zero and holds finite numbers only."""
    given = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    ok = given.where("vec_id IS NOT NULL AND size(v) > 0 AND NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity')) AND exists(v, x -> x <> 0)")
    usual = ok.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return ok.where(F.size("v") == (usual.n if usual else 0))


def search(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50, k: int = 5, sample: int = 3000,
           rows_per_part: int = 4000, largest: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id is divisible by `every`, the k nearest other rows found by cosine.

    The router is fitted on at most `sample` rows, by the hash of the id; every row is indexed by its most probable
    partition and each query visits its most probable ones. Partitions grow in number with the rows, from FEW to `largest`; only TRIVIAL rows or fewer are one.
    A partition is searched in blocks of a bounded number of rows and of queries, so one that holds a third of all rows is
    many tasks' work, and each block returns k rows a query. Scores are cosines of the original vectors in double
    precision; ties go to the smaller id. Rows that `usable` leaves out are neither queries nor candidates. Rows that repeat
    an id are each a candidate for other ids.
    """
    rows = usable(vectors, id_col, vector_col)
    n = rows.count()
    some = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).collect()
    schema = "query_id long, rank int, vec_id long, score double"
    if n < 2:
        return vectors.sparkSession.createDataFrame([], schema)
    matrix = np.array([r.v for r in some])
    parts = 1 if n <= TRIVIAL else max(1, min(largest, max(FEW, n // rows_per_part), len(matrix) // 40))
    unit = _unit(matrix)
    router = fit(unit, parts) if parts > 1 else Router(np.zeros((unit.shape[1] + 1, 1)), np.zeros((2, 1)), 1)

    def route(blocks):
        for block in blocks:
            if len(block):
                odds = router.odds(_unit(np.stack(block["v"])))
                order = np.argsort(-odds, axis=1, kind="stable")[:, : router.probes]
                yield pd.DataFrame({"vec_id": block["vec_id"], "v": block["v"], "parts": order.tolist()})

    indexed = cut(rows.mapInPandas(route, "vec_id long, v array<double>, parts array<int>"))
    homes = indexed.select(F.col("parts")[0].alias("part"), "vec_id", "v")
    sizes = homes.groupBy("part").agg(F.expr(f"1 + count(*) DIV {BLOCK}").alias("m"), F.expr(f"1 + count_if(vec_id % {every} = 0) * 8 DIV {BLOCK}").alias("q"))
    sizes = F.broadcast(cut(sizes))  # a row per partition: `largest` at most
    asked = (indexed.where(F.col("vec_id") % every == 0).select(F.explode("parts").alias("part"), "vec_id", "v").join(sizes, "part")
             .select("part", F.expr("pmod(xxhash64(vec_id), q) AS i"), F.expr("explode(sequence(0L, m - 1)) AS j"), "vec_id", "v", F.lit(True).alias("asks")))
    held = (homes.join(sizes, "part")
            .select("part", F.expr("explode(sequence(0L, q - 1)) AS i"), F.expr("pmod(xxhash64(vec_id, v), m) AS j"), "vec_id", "v", F.lit(False).alias("asks")))

    def nearest(block: pd.DataFrame) -> pd.DataFrame:
        ask, own = block[block["asks"]], block[~block["asks"]]
        out = []
        if len(ask) and len(own):
            ids, q_ids = own["vec_id"].to_numpy(), ask["vec_id"].to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, mine, theirs = ids[order], np.stack(own["v"])[order], np.stack(ask["v"])
            score = _cosine(theirs, mine)
            score[q_ids[:, None] == ids[None, :]] = -np.inf
            best = np.argsort(-score, axis=1, kind="stable")[:, :k]
            out = [(q, ids[c], score[r, c]) for r, q in enumerate(q_ids.tolist()) for c in best[r] if score[r, c] > -np.inf]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = asked.union(held).groupBy("part", "i", "j").applyInPandas(nearest, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _unit(matrix: np.ndarray) -> np.ndarray:
    scaled = matrix / np.abs(matrix).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines in double precision; a vector has cosine 1 with its copy up to rounding, and equal vectors equal cosines."""
    return np.clip(_unit(a) @ _unit(b).T, -1.0, 1.0)
