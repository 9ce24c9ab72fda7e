"""Hard negatives against a plain loop in Python integers."""

from __future__ import annotations

import math

import numpy as np
import pytest

from ledgerline.llm import hard_negatives as hn


def plain(rows, every=50):
    ok = {}
    for i, v, label in sorted((r for r in rows if r[0] is not None and r[2] is not None and r[1] is not None), key=lambda r: r[0]):
        if None not in v and all(map(math.isfinite, v)):
            ok.setdefault(i, ((label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]))
    out = set()
    for a, (label, q) in ok.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(q, r)), i, own == label) for i, (own, r) in ok.items() if i != a)
        for p, positive, _ in [s for s in scored if s[2]][:5]:
            fits = [(i, -n) for n, i, same in scored if not same and 50 * -p <= 100 * -n <= 95 * -p][:3]
            out |= {(a, positive, rank, i, -p, n) for rank, (i, n) in enumerate(fits, 1)}
    return out


def result(df):
    rows = [tuple(r) for r in df.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


TABLE = "vec_id long, embedding array<double>, label int, anchor_id string, i int, positives int"


def made(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], TABLE).repartition(3)


@pytest.mark.parametrize(("dims", "size", "scale"), [(64, 400, 0.2), (5, 300, 3.0), (8, 120, 1e6)])
def test_scores_are_exact_inner_products(dims, size, scale):
    rng = np.random.default_rng(dims)
    q = np.floor(256 * scale * rng.normal(size=(size, dims))).astype(np.int64)
    bits = int(np.abs(q).max()).bit_length() + 1
    shape = hn.Shape(bits, -(-dims // 8))
    packed = shape.pack(list(q))
    assert (shape.unpack(packed)[:, :dims] == q).all()
    assert (hn.scores(hn.subset_sums(shape.unpack(packed[:50])), shape.bytes_of(packed)) == q[:50] @ q.T).all()
    assert (hn.Shape(1, 1).unpack(hn.Shape(1, 1).pack([np.array([-1, 0])]))[0, :2] == [-1, 0]).all()


@pytest.mark.parametrize("blocks", [(512, 4096, 512), (3, 40, 7)])
def test_against_plain_loop(spark, monkeypatch, blocks):
    for name, value in zip(("ANCHORS", "CANDIDATES", "AT_ONCE"), blocks):
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(4, 12))
    labels = [3 if rng.random() < 0.4 else int(rng.integers(0, 10)) for _ in range(700)]
    rows = [(i, np.round(0.3 * (centres[i % 4] + 0.4 * rng.normal(size=12)), 2).tolist(), labels[i]) for i in range(700)]
    rows += [(1000 + i, rows[50][1], i % 3) for i in range(60)]  # ties
    rows += [rows[100], rows[100], rows[33]]  # repeated rows
    rows += [(2000, None, 1), (2050, rows[3][1], None), (2100, [0.1] * 11 + [None], 1), (2150, [0.1] * 11 + [float("nan")], 1),
             (2200, [float("-inf")] * 12, 1), (None, rows[2][1], 1), (2250, [], 4), (2300, [0.0] * 12, 4), (2350, [0.5, -0.25], 3), (-50, rows[7][1], 5)]
    got = result(hn.hard_negatives(made(spark, rows)))
    assert got == plain(rows) and len(got) > 100


def test_small_tables(spark):
    assert result(hn.hard_negatives(made(spark, []))) == set()
    assert result(hn.hard_negatives(made(spark, [(50, [1.0], 1)]))) == set()
    few = [(50, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [0.9, 9.0], 2), (5, [0.4, 1.0], 2), (6, [0.5, 1.0], 2)]
    assert result(hn.hard_negatives(made(spark, few))) == {(50, 3, 1, 4, 65536, 58880), (50, 3, 2, 6, 65536, 32768)}
    with pytest.raises(ValueError, match="fit a long"):
        hn.hard_negatives(made(spark, [(50, [1e18], 1), (51, [1.0], 1)]))
