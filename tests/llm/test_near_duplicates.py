"""Near duplicates against brute force over all pairs."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pytest

from ledgerline.llm.components import components
from ledgerline.llm.near_duplicates import near_duplicates
from ledgerline.llm.superminhash import shingle_sets, signatures
from ledgerline.llm.words import word_hashes


def shingles(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute(docs):
    sets = {i: shingles(t) for i, t in docs}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    return {i: (len(sets[i]), root(i), root(i) == i) for i in ids}


def result(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    assert result(near_duplicates(docs)) == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_near_copies_in_a_hot_group(spark):
    rng = np.random.default_rng(5)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        for k in rng.integers(0, 120, size=rng.integers(0, 5)):
            words[k] = f"x{rng.integers(0, 50)}"
        rows.append((i + 1, " ".join(words)))
    rows += [(1000 + i, rows[7][1]) for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert result(near_duplicates(docs)) == brute(rows)


def test_edges(spark):
    long = " ".join(f"v{k}" for k in range(60_000))
    rows = [(1, None, 0), (2, "", 0), (3, " \t\n", 0), (4, "one two", 0), (5, "ONE\ttwo ", 0), (6, "one", 0), (7, long, 0),
            (8, long + " end", 0), (9, "É a b c d", 0), (10, "é a b c d", 0), (None, "one two", 0), (11, "a\x0bb c d e", 0), (12, "a b c d e", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id int")
    got = result(near_duplicates(docs))
    assert got.pop(None) == (1, None, True)
    assert got == brute([r[:2] for r in rows if r[0] is not None])
    assert got[2] == (0, 2, True) and got[5] == (1, 4, False) and got[8][1] == 7 and got[10][1] == 10


def test_repeated_ids_are_one_document(spark):
    rows = [(5, "a b c d e f"), (5, "g h i j k l"), (3, "g h i j k l"), (9, "a b c d e f"), (5, "a b c d e f")]
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(3, 3), (5, 3), (5, 3), (5, 3), (9, 3)]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200), (200, 300)], "a long, b long")
    got = {r.id: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(61)}, 100: 100, 200: 100, 300: 100}


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(1)
    errors = []
    for _ in range(200):
        pool = rng.integers(0, 1 << 63, size=rng.integers(20, 2000), dtype=np.uint64)
        cut = int(len(pool) * rng.uniform(0.3, 1))
        sets = [np.unique(pool[:cut]), np.unique(pool[len(pool) - cut :])]
        true = len(np.intersect1d(*sets)) / len(np.union1d(*sets))
        a, b = signatures(sets)
        errors.append((a == b).mean() - true)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.045


@pytest.mark.parametrize("text", ["a b", "  A\n\x0b b", "x" * 700_000 + " y"])
def test_word_hashes(text):
    hashes, first = word_hashes([text.encode(), b"", b"a"])
    words = text.encode().lower().split()
    assert first.tolist() == [0, len(words), len(words), len(words) + 1]
    assert len(set(hashes.tolist())) == len(set(words) | {b"a"})


def test_short_sequences_differ_from_each_other():
    sets = shingle_sets([b"a", b"a a", b"a a a", b"a a a a", b"a a a a a", b"A a"])
    assert len({s.tobytes() for s in sets}) == 5 and sets[1].tolist() == sets[5].tolist()
