"""Alignment against a plain version that walks byte ranges."""

from __future__ import annotations

import hashlib
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerline.llm.queries import vocabulary
from ledgerline.llm.token_alignment import align, byte_letters, pair_of

A, B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")
TEXTS = ["a plain sentence, and another one.", "a plain sentence, and another one.", "", None, " ", "  two  spaces\tand\n\n lines ", "Überraschung für naïve cafés ☕️🎉 漢字かな",
         "<|endoftext|> and <s> </s> <0x41> are plain", "a ▁ mark of the pieces", "\x00\x01 control", "x", "1234567 + 89", "ﬁ ligature ①", "zz" * 3000, "new letters \U000105c0\u1c89 it's", "the cat sat on the mat. " * 4000]


def ranges(ids, size):
    out, at = [], 0
    for i in ids:
        out.append((i, at, at + size(i)))
        at += size(i)
    return out


def plain(texts):
    tok, sp = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    tok.encode_special_tokens = True
    letters = byte_letters()
    vocab = {i: bytes(letters[c] for c in t) for t, i in tok.get_vocab().items()}
    pieces = {i: bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).replace("▁", " ").encode() for i in range(sp.vocab_size())}
    rows, links = [], []
    for text in texts:
        want = (" " + (text or "")).encode()
        a, b = (tok.encode(" " + text, add_special_tokens=False).ids, sp.encode(text)) if text else ([], [])
        if b"".join(vocab[i] for i in a) != want or b"".join(pieces[i] for i in b) != want:
            a, b = [], []
        ra, rb = ranges(a, lambda i: len(vocab[i])), ranges(b, lambda i: len(pieces[i]))
        by_end = {}
        for i, _, end in rb:
            by_end.setdefault(end, []).append(i)
        links.append([(i, j) for i, _, end in ra for j in by_end.get(end, [])])
        cuts = sorted({end for _, _, end in ra} & {end for _, _, end in rb})
        parts, low = [], 0
        for end in cuts:
            inside = [",".join(str(i) for i, first, last in r if low <= first and last <= end) for r in (ra, rb)]
            parts.append("|".join(inside))
            low = end
        rows.append((len(a), len(b), len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest() if a else ""))
    seen = Counter(x for own in links for x in own)
    top = {}
    for (_, j), n in seen.items():
        top[j] = max(top.get(j, 0), n)
    return [(n_a, n_b, n, len(own), sum(seen[x] == top[x[1]] for x in own), sum(seen[x] for x in own), sha) for (n_a, n_b, n, sha), own in zip(rows, links)]


@pytest.mark.parametrize("texts", [TEXTS, [*TEXTS[:13], "la casa de la ñ " * 30, "der Überbau " * 30], [None, ""], []])
def test_against_walk_over_ranges(spark, texts):
    if texts == TEXTS:
        texts = [t if t is None or len(t) < 5000 else t[:3000] for t in texts]  # the plain version is quadratic
    table = spark.createDataFrame([(i if i != 5 else None, t, "x", i) for i, t in enumerate(texts)], "doc_id long, text string, a string, n long").repartition(3)
    got = {(r.doc_id if r.doc_id is not None else 5): tuple(r)[1:] for r in align(table, A, B).collect()}
    assert got == dict(enumerate(plain(texts)))


def test_very_long_text_is_whole(spark):
    text = "the cat sat on the mat; " * 60_000
    row = align(spark.createDataFrame([(1, text)], "doc_id long, text string"), A, B).first()
    pair = pair_of(A, B)
    assert len(text) > 1_000_000 and row.n_links == row.n_groups > 300_000
    assert sum(len(pair.bytes_b[i]) for i in pair.b.encode(text)) == len(text) + 1 and row.n_b == len(pair.b.encode(text))


def test_linked_pairs_are_bounded_by_the_vocabularies():
    pair = pair_of(A, B)
    assert sum(map(len, pair.bytes_a)) + sum(map(len, pair.bytes_b)) < 700_000
    assert max(Counter(pair.bytes_a).values()) == 1 and max(Counter(pair.bytes_b).values()) <= 2
