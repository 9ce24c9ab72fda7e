"""Nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np

from ledgerline.llm import neighbours
from ledgerline.llm.neighbours import fit, search


def brute(rows, k=5):
    ok = [(i, np.array(v, dtype=float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and any(v)]
    ids = np.array([i for i, _ in ok])
    unit = np.stack([v / np.linalg.norm(v) for _, v in ok])
    out = {}
    for i in sorted({i for i in ids.tolist() if i % 50 == 0}):
        score = unit @ unit[int(np.flatnonzero(ids == i)[0])]
        order = [j for j in np.lexsort((ids, -np.round(score, 12))) if ids[j] != i][:k]
        out[i] = [(int(ids[j]), round(float(score[j]), 9)) for j in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, round(r.score, 9)))
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(220)]
    rows += [(300, None), (350, []), (400, [0.0] * 8), (450, [1.0] * 7 + [None]), (500, [float("nan")] * 8), (550, [float("inf")] * 8), (None, [1.0] * 8), (600, [1.0] * 3)]
    rows += [(1000 + i, rows[50][1]) for i in range(8)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, rank int")
    want = brute([r for r in rows if r[0] != 600])
    assert result(search(table)) == want and [v for v, _ in want[50]] == [1000, 1001, 1002, 1003, 1004]
    assert search(table.limit(0)).count() == 0


def test_recall_over_learned_partitions(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(30, 24))
    rows = [(i, (centres[i % 30] + 0.7 * rng.normal(size=24)).tolist()) for i in range(6000)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4)
    got, want = result(search(table, rows_per_part=500, sample=1500)), brute(rows)
    assert got.keys() == want.keys() and all(len(v) == 5 for v in got.values())
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.9


def test_router_visits_few_partitions_of_clustered_rows():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(16, 24))
    x = np.repeat(centres, 60, axis=0) + 0.3 * rng.normal(size=(960, 24))
    router = fit(x / np.linalg.norm(x, axis=1, keepdims=True), 8)
    assert router.probes <= 4


def test_small_tables_are_routed_and_probes_hold_for_unseen_queries(spark, monkeypatch):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(8, 16))
    rows = [(i, (centres[i % 8] + 0.5 * rng.normal(size=16)).tolist()) for i in range(500)]
    made = []
    monkeypatch.setattr(neighbours, "fit", lambda unit, parts: made.append(fit(unit, parts)) or made[-1])
    got, want = result(search(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))), brute(rows)
    assert len(made) == 1 and made[0].out.shape[1] == neighbours.FEW
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 5 for q in want]) >= 0.94
    x = rng.normal(size=(1500, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sample, unseen = x[:600], x[600:]
    router = fit(sample, 12)
    home = router.odds(sample).argmax(axis=1)
    visited = np.argsort(-router.odds(unseen), axis=1, kind="stable")[:, : router.probes]
    best = np.argsort(-(unseen @ sample.T), axis=1)[:, :5]
    assert np.mean([np.isin(home[b], v).mean() for b, v in zip(best, visited)]) >= 0.94
