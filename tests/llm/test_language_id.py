"""Language identification against a plain version, and its accuracy on rows it did not learn from."""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest

from ledgerline.llm import language_id as li
from ledgerline.llm.queries import op13_language_id

SF = Path("/root/testdata/sf0.01")
ROWS = [
    ("en", "The cat sat on the mat and the dog sat on the log. The end"), ("en", "Weather in the north is cold, and the wind is strong"),
    ("de", "Die Katze sitzt auf der Matte und der Hund auf dem Stamm"), ("de", "Das Wetter im Norden ist kalt und der Wind ist stark; Straße, Öl"),
    ("fr", "Le chat est assis sur le tapis et le chien est là"), ("fr", "Il fait froid dans le nord, l'été est loin"),
    (None, "the the the"), ("en", None), ("fr", ""), ("de", "12 %% ..."),
]
ASKED = ["the dog and the cat", "der Hund ist kalt", "le chien et le chat", "strongest northerner", "Hundewetter", "chiens", "x² y₂ 5", "漢字", "123 !?", "", None, " \n", "The " * 5000, "z" * 5000, "Straße", "ÖL und ÖL"]


def plain_words(text):
    return "".join(c if c.isalpha() else " " for c in text.lower()).split()


def plain_model(rows, longest=5, share=1 << 16):
    n = defaultdict(Counter)
    for lang, text in rows:
        if lang is not None and text is not None:
            for w in plain_words(text):
                n[lang, 0][w] += 1
                for size in range(1, longest + 1):
                    marked = w if size == 1 else f" {w} "
                    for i in range(len(marked) - size + 1):
                        n[lang, size][marked[i : i + size]] += 1
    langs = sorted({lang for lang, _ in n})
    levels = []
    for k in range(longest + 1):
        known = {e for lang in langs for e, c in n[lang, k].items() if c * share >= n[lang, k].total()}
        levels.append({e: [math.log((n[lang, k][e] + 0.5) / (n[lang, k].total() + 0.5 * max(1, len(known)))) for lang in langs] for e in known})
    return langs, levels


def plain_predict(model, text):
    langs, levels = model
    words = plain_words(text or "")
    if not words:
        return "und", 0.0
    logs = np.zeros(len(langs))
    for w in words:
        if w in levels[0]:
            logs += levels[0][w]
            continue
        for size in range(len(levels) - 1, 0, -1):
            marked = w if size == 1 else f" {w} "
            found = [levels[size][g] for i in range(len(marked) - size + 1) if (g := marked[i : i + size]) in levels[size]]
            if found:
                logs += np.mean(found, axis=0)
                break
    return langs[int(np.argmax(np.round(logs, 9)))], float(1 / np.exp(logs - logs.max()).sum())


@pytest.mark.parametrize(("longest", "share", "entries"), [(5, 1 << 16, 1 << 18), (3, 25, 20)])
def test_against_plain_version(spark, monkeypatch, longest, share, entries):
    monkeypatch.setattr(li, "ENTRIES", entries)
    learned = spark.createDataFrame([(*r, "x", 0) for r in ROWS], "lang string, text string, entry string, level int").repartition(3)
    model = li.train(learned, longest=longest, share=share)
    want = plain_model(ROWS, longest, share)
    assert model.langs == want[0] == ["de", "en", "fr"]
    for level, entries_of in enumerate(want[1]):
        assert model.rows[level].keys() == entries_of.keys()
        for entry, logs in entries_of.items():
            assert np.allclose(model.logs[level][model.rows[level][entry]], logs)
    asked = spark.createDataFrame([(i if i != 1 else None, t, 0.5, "zz") for i, t in enumerate(ASKED)] * 2, "doc_id long, text string, score double, lang_pred string").repartition(3)
    got = li.identify(asked, model).collect()
    assert len(got) == 2 * len(ASKED)
    for r in got:
        lang, score = plain_predict(want, ASKED[1 if r.doc_id is None else r.doc_id])
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-6)


def test_tables_without_rows_or_languages(spark):
    schema = "doc_id long, text string, lang string"
    assert li.languages(spark.createDataFrame([], schema)).collect() == []
    got = li.languages(spark.createDataFrame([(1, "a word", None), (None, "other", None)], schema)).collect()
    assert {(r.doc_id, r.held_out, r.lang_pred, r.score) for r in got} == {(1, zlib.crc32(b"1") % 4 == 2, "und", 0.0), (None, False, "und", 0.0)}


def test_never_learns_from_held_out_rows(spark):
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 4 == 2][:5]
    rows = [(i, "qqq zzz", "xx") for i in ids] + [(i, "the cat", "en") for i in range(100, 140) if zlib.crc32(str(i).encode()) % 4 != 2]
    assert {r.lang_pred for r in li.languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()} == {"en"}


def test_accuracy_on_held_out_documents(spark):
    if not SF.exists():
        pytest.skip("no test tables")
    docs = spark.read.parquet(str(SF / "documents.parquet"))
    want = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    got = op13_language_id(spark, str(SF)).collect()
    assert len(got) == len(want) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    unseen = [r.lang_pred == want[r.doc_id] for r in got if r.held_out and want[r.doc_id] is not None]
    assert len(unseen) > 200 and np.mean(unseen) >= 0.97
