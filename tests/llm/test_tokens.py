"""Tokens against the public libraries, and round trips."""

from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken

from ledgerline.llm.bpe import Pairs, Ragged, merge
from ledgerline.llm.byte_bpe import decode, digests, encode, encoder, text_digests
from ledgerline.llm.token_counts import PieceCounter, token_counts

BYTES, PIECES = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")
EDGES = [None, "", " ", "\n", "'s", " 's", "\n's", "\n 's", "''s", "don't 'tis 're'lly x'd's", "a  b   \n\n c ", "<|endoftext|> <s>hi</s>",
         "a▁b  ▁▁ c", "\x00\x1c\x85\xa0　x", "é① ½ 한국 😀", "the" * 3000, " " * 500 + "a", "-" * 700, "x" + " " * 31 + "the"]


@pytest.fixture(scope="module")
def library():
    with open(BYTES, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def texts(seed, letters):
    rng = random.Random(seed)
    return ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]


def test_ids_equal_the_library(library):
    given = [t or "" for t in EDGES] + texts(1, "aab  \n\t\r.é😀①'''sstrvelmd're've'll123½ 　\x1c\x85\xa0한")
    ids, ends = encoder(BYTES).encode(given)
    assert [ids.flat[a : a + n].tolist() for a, n in zip(ids.starts, ids.lengths)] == library.encode_ordinary_batch(given)
    sizes = [len(t.encode()) for t in given]
    assert [int(ends.flat[a + n - 1]) if n else 0 for a, n in zip(ends.starts, ends.lengths)] == sizes


def test_counts_equal_the_library(pieces):
    given = [t or "" for t in EDGES] + texts(2, "aab  ▁  \n\t\r.é😀①ththe ing<s>_-00 　한국zz")
    assert PieceCounter(PIECES).count(given).tolist() == [len(x) for x in pieces.encode(given)]


def test_tables(spark, library, pieces):
    rows = [(i, t, "x") for i, t in enumerate(EDGES)] + [(3, "tie", "y"), (3, "tie", "y"), (None, "none", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = {(r.doc_id, r.ids_sha256): r for r in digests(encode(docs, BYTES, offsets=False), BYTES).collect()}
    for i, t, _ in rows:
        ids = library.encode_ordinary(t or "")
        row = got[i, hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()]
        assert row.n_tokens == len(ids) and row.decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()
    data = sorted((r.doc_id or -1, bytes(r.data)) for r in decode(encode(docs, BYTES), BYTES).collect())
    assert data == sorted((i or -1, (t or "").encode()) for i, t, _ in rows)
    counts = sorted((r.doc_id or -1, r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts(docs, PIECES, limit=500).collect())
    want = [(i or -1, len((t or "").encode()), n := len(pieces.encode(t or "")), n > 500) for i, t, _ in rows]
    assert counts == sorted(want)


def test_whole_tables(spark, library, pieces):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: list(r.ids) for r in encode(docs, BYTES).collect()}
    counts = {r.doc_id: r.n_tokens for r in token_counts(docs, PIECES).collect()}
    for r in docs.collect():
        assert got[r.doc_id] == library.encode_ordinary(r.text) and counts[r.doc_id] == len(pieces.encode(r.text))


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert token_counts(none, PIECES).count() == 0 and digests(encode(none, BYTES), BYTES).count() == 0


def test_merging_in_an_order_that_matters():
    # a+b before ab+a: merging every a+b at once would leave no a for ab+a, whose rank is lower
    pairs = Pairs(np.array([0, 2]), np.array([1, 0]), np.array([2, 3]), np.array([5, 1]))
    out = merge(Ragged(np.array([0, 1, 0, 1, 0, 0]), np.array([5, 0, 1])), pairs)
    assert out.flat.tolist() == [3, 1, 0, 0] and out.lengths.tolist() == [3, 0, 1]


def test_one_pass_gives_the_digests_of_two(spark):
    rows = [(1, "Hello  wörld, it's 12 o'clock"), (2, None), (3, ""), (None, "a b\n c" * 50_000), (1, "Hello")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ask = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert ask(text_digests(docs, BYTES)) == ask(digests(encode(docs, BYTES, offsets=False), BYTES))
    plan = text_digests(docs, BYTES)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_decoding_makes_no_table_of_merges():
    from ledgerline.llm.byte_bpe import ByteEncoder

    own = ByteEncoder(BYTES)
    ids, _ = own.encode(["some text"])
    other = ByteEncoder(BYTES)
    assert other.decode(ids.flat) == b"some text" and "pairs" in vars(own) and "pairs" not in vars(other)
