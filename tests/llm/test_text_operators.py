"""Fingerprints, mixing, toxicity, secrets, language model and main text against plain versions."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import fingerprints, language_model, main_text, mixing, secrets, toxicity

DOCS = "/root/testdata/sf0.001/documents.parquet"
EDGES = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, "é 한 😀 " * 9), (6, "word " * 20_000), (None, "no id")]


@pytest.fixture(scope="module")
def edges(spark):
    rows = [(i, t, "en", "s" if i else None, len(t or ""), 7) for i, t in EDGES]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def held(i, parts):
    return i is not None and zlib.crc32(str(i).encode()) % parts == 0


# fingerprints


def test_equal_stretches_share_names():
    rng = np.random.default_rng(2)
    words = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 9))) for _ in range(400)]
    stretch = " ".join(words[:300])
    a, b, other = fingerprints.sketches(["x" * 7 + stretch, "other start " + stretch + " and an end", " ".join(words[300:])])
    assert fingerprints.likeness(a, b) > 0.7 and fingerprints.likeness(a, other) < 0.1
    assert fingerprints.parsed(fingerprints.text(a)).tolist() == a.tolist()
    alone, together = fingerprints.sketches(["abcabcabd " * 9]), fingerprints.sketches(["q", "abcabcabd " * 9, "aaaaaaaa"])
    assert alone[0].tolist() == together[1].tolist() and all(len(s) for s in together)


def test_next_documents(spark, edges, none):
    for docs in (edges, spark.read.parquet(DOCS)):
        rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        want = Counter()
        for (i, own), (_, following) in zip(rows, rows[1:] + rows[:1]):
            changed = fingerprints.edited(own, following)
            a, b, c = fingerprints.sketches([own, changed, following])
            want[i, len(own), hashlib.sha256(changed.encode()).hexdigest(), fingerprints.text(a), fingerprints.text(b),
                 fingerprints.likeness(a, b), fingerprints.likeness(a, c)] += 1
        assert Counter(tuple(r) for r in fingerprints.compare_with_next(docs).collect()) == want
    assert fingerprints.compare_with_next(none).count() == 0


# mixing


def test_poisson_inverts_the_distribution(spark):
    from pyspark.sql import functions as F

    for mean in (0.0, 0.3, 2.5, 100.0):
        got = [r.k for r in spark.range(4000).select(mixing.poisson(F.lit(mean), F.lit(3), F.col("id")).alias("k")).collect()]
        assert abs(np.mean(got) - mean) < 5 * math.sqrt(mean / 4000) + 1e-9
        assert abs(np.var(got) - mean) < 0.15 * mean + 1e-9
    rows = spark.range(300).select(mixing.uniform(F.lit(3), F.col("id"), F.lit(1)).alias("u"), mixing.poisson(F.lit(2.5), F.lit(3), F.col("id")).alias("k")).collect()
    for r in rows:
        upto, k = math.exp(-2.5), 0
        while r.u >= upto:
            k += 1
            upto += math.exp(-2.5) * 2.5**k / math.factorial(k)
        assert r.k == k


def test_mixing_meets_its_weights(spark, edges, none):
    rows = [(i, "x" * 10, "en", "big" if i < 3000 else "small", 10) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    got = [(r.doc_id, r.source) for r in mixing.mix(docs, {"big": 1.0, "small": 3.0}).collect()]
    share = sum(s == "small" for _, s in got) / len(got)
    assert abs(share - 0.75) < 0.03 and abs(len(got) - 4000) < 300
    again = [(r.doc_id, r.source) for r in mixing.mix(docs.repartition(3), {"big": 1.0, "small": 3.0}).collect()]
    assert Counter(got) == Counter(again)
    assert np.corrcoef(np.arange(len(got)), [i for i, _ in got])[0, 1] ** 2 < 0.2
    assert mixing.mix(none).count() == 0 and mixing.mix(docs, {}).count() == 0
    kept = mixing.mix(edges, total=3.0)
    assert kept.columns == [*edges.columns, "copy_number", "shuffle_key"] and kept.count() > 0


# toxicity


def test_toxicity_tells_held_out_documents(spark, none):
    rng = np.random.default_rng(4)
    parts = ["ba", "de", "fi", "gor", "lu", "men", "pa", "ri", "sto", "tan", "ve", "zi"]
    word = lambda: "".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(1, 5)))
    rows, marks = [], []
    for i in range(900):
        words = [word() for _ in range(rng.integers(30, 200))]
        if i % 3 == 0:
            for k in rng.integers(0, len(words), 3):
                words[k] = rng.choice(["idiot", "scum", "worthless"])
        rows.append((i, " ".join(words)))
        marks.append((i, 1, int(i % 3 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([*marks, (None, 1, 1), (5000, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.train(docs, labels)
    got = toxicity.score(docs, model).collect()
    assert all(r.held_out == held(r.doc_id, 5) and r.predicted == (r.score >= 0.5) for r in got)
    test = [(r.predicted, int(r.doc_id % 3 == 0)) for r in got if r.held_out]
    assert sum(p == y for p, y in test) / len(test) > 0.95
    assert toxicity.keep_ordinary(docs, model).count() == sum(not r.predicted for r in got)
    assert toxicity.train(none, labels) is None and toxicity.score(none, model).count() == 0
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}


def test_toxicity_of_edges(edges):
    model = toxicity.fit([b"bad scum here and there " * 3] * 30, [b"fine day out and about " * 3] * 30)
    got = toxicity.score(edges, model).collect()
    assert len(got) == len(EDGES) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.keep_ordinary(edges, model).columns == edges.columns


# secrets


def plain(text):
    found = [(m.start(), 0, m.end()) for m in re.finditer(
        r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text, re.A) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


def test_secrets_keep_the_base_spans(spark, edges, none):
    odd = ["token=secret = abcdefgh1", "token: a secret=abcdefghij", "é😀 PassWord : 'hunter2hunter2' api-key=x apikey=\"ABCD1234efgh\"", "tokeN==abcdefgh",
           "AKIA123 AKIAABCDEFGHIJKL0 xAKIAAKIA12345678901", "deadbeef" * 4 + "g" + "0" * 31, "ſecret=abcdefgh12 toKen=abcdefgh12", "token = " + "a" * 50_000]
    docs = spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string").union(edges.select("doc_id", "text")).union(
        spark.read.parquet(DOCS).selectExpr("doc_id + 1000 AS doc_id", "text"))
    texts = Counter()
    for r in docs.collect():
        spans = plain(r.text or "")
        name = ",".join(f"{secrets.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        texts[r.doc_id, *[sum(s[1] == k for s in spans) for k in range(3)], hashlib.sha256(name.encode()).hexdigest()] += 1
    got = secrets.digest(docs).collect()
    assert Counter((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in got) == texts
    assert secrets.digest(none).count() == 0


def test_markov_models_find_random_strings(spark):
    rng = np.random.default_rng(6)
    random = lambda n: "".join(rng.choice(list("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"), n))
    names = ["customer_account_number", "index_of_last_element", "maximum_retry_interval", "configuration_directory", "response_time_average"]
    rows = [(i, f"the {names[i % 5]} of {names[i * 7 % 5]} token = {random(36)} is set") for i in range(300)]
    bare = random(40)
    rows += [(1000, f"found {bare} near {names[0]}_{names[1]}"), (1001, f"plain {names[2]}_{names[3]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = secrets.train(docs)
    scanned = secrets.scan(docs, *model)
    found = {r.doc_id: [m.value for m in r.markov] for r in scanned.collect()}
    assert found[1000] == [bare] and found[1001] == []
    clean = {r.doc_id: r.t for r in scanned.select("doc_id", secrets.redact(scanned).alias("t")).collect()}
    assert bare not in clean[1000] and clean[1001] == rows[-1][1] and "[secret]" in clean[0]


# language model


def test_scores(spark, edges, none):
    for docs in (edges, spark.read.parquet(DOCS)):
        rows = [(r.doc_id, (r.text or "").encode().lower().split() + [None]) for r in docs.collect()]
        count = Counter(w for i, own in rows if not held(i, 10) for w in own)
        n = sum(count.values())
        want = sorted((i or -1, held(i, 10), len(own), sum(count[w] > 0 for w in own), n,
                       round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (len(count) + 1))) for w in own), 5)) for i, own in rows)
        got = language_model.score(docs).collect()
        assert sorted((r.doc_id or -1, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
        assert all(r.score < 0 for r in got)
    test = [r for r in got if r.held_out]
    assert sum(r.score for r in test) > 1.01 * sum(r.base_score for r in test)
    assert language_model.score(none).count() == 0


def test_class_probabilities_add_up_to_one():
    unigram = np.array([0.4, 0.3, 0.1, 0.2])
    triples = np.array([[4, 4, 0], [4, 0, 1], [0, 1, 2], [0, 1, 3]])
    net = language_model.train_nce(language_model.start(unigram, 8), triples, np.array([5.0, 5, 1, 4]), unigram, 1, steps=300)
    (pair, ahead), norm = net.tables()
    odds = np.exp(pair[None, :, :] + ahead[:, None, :] - norm[:, :, None])
    assert np.allclose(odds.sum(axis=2), 1) and odds[4, 0].argmax() == 1 and odds[0, 1].argmax() == 3


def test_every_triple_is_learned_from(spark):
    unigram = np.array([0.4, 0.3, 0.1, 0.2])
    first = language_model.start(unigram, 8)
    net = language_model.train_nce(first, np.array([[4, 4, 0], [4, 1, 2]]), np.array([1e7, 1]), unigram, 1)
    assert not np.allclose(net.near[1], first.near[1]) and not np.allclose(net.near[4], first.near[4])
    pairs = ["red car", "blue sky", "green tree", "old house"]
    rng = np.random.default_rng(8)
    docs = spark.createDataFrame([(i, " ".join(rng.choice(pairs, 60))) for i in range(300)], "doc_id long, text string")
    test = [r for r in language_model.score(docs).collect() if r.held_out]
    assert sum(r.score for r in test) > 0.75 * sum(r.base_score for r in test)


def test_each_trainer_has_a_task_of_its_own(spark):
    dealt = spark.range(0, 3000, 1, 7).selectExpr("id AS code", "CAST(id % 12 AS int) AS part")
    parts = language_model.apart(dealt, 12).groupBy(F.spark_partition_id().alias("task")).agg(F.collect_set("part").alias("parts")).collect()
    assert sorted(r.parts for r in parts) == [[k] for k in range(12)]
    trained = language_model.apart(dealt, 12).groupBy("part").applyInPandas(lambda block: block[:1], dealt.schema)
    assert trained.count() == 12 and str(trained._jdf.queryExecution().executedPlan()).count("Exchange") == 1


def test_words_are_those_of_bytes():
    rng = np.random.default_rng(4)
    parts = [b"a", b"B", "é".encode(), "İ".encode(), b"\x1c", b"\x85", "\xa0".encode(), "\u2028".encode(), b"\xff", b"\0", *(bytes([c]) for c in b" \t\n\v\f\r")]
    texts = [None, b"", b" \n", *(b"".join(parts[k] for k in rng.integers(0, len(parts), rng.integers(0, 40))) for _ in range(500))]
    want = [(t or b"").lower().split() for t in texts]
    index = pa.array([b"a", b"b", b"ab"], pa.binary())
    for kind in (pa.binary(), pa.large_binary()):
        at, lengths, words, place = language_model._indexed(pa.array([b"x", *texts], kind)[1:], index, 3, 4)
        assert lengths.tolist() == [len(w) + 1 for w in want] and words.view(pa.binary()).to_pylist() == [w for own in want for w in own]
        assert at.tolist() == [k for own in want for k in [*({b"a": 0, b"b": 1, b"ab": 2}.get(w, 3) for w in own), 4]] and (at[place] < 4).all()
    slices = list(language_model._stretches(pa.array([b"x" * language_model.STRETCH * 2, None, b"y"], pa.binary())))
    assert [len(s) for s in slices] == [1, 2]


# main text

PAGE = """<html><head><title>t</title><style>p{{}}</style><script>var a="</p><p>no";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use</div><{holder}><h2>Head&nbsp;{n}</h2><p>First&amp;<b>bold</b>
 text {n}<p>Second<br>third<form><input value=x>send</form><div id="comments"><p>me too</p></div></{holder}><aside>more</aside><p>Thanks for reading all of it</p><footer>&copy;</footer>"""


def test_main_text(spark):
    rows = [(n, f"https://a.org/{n}", PAGE.format(holder="article", n=n)) for n in range(5)]
    rows += [(10 + n, f"https://b.org/{n}", PAGE.format(holder='div class="text"', n=n).replace('</div class="text">', "</div>")) for n in range(5)]
    rows += [(20, None, None), (21, "https://c.org", ""), (22, "https://c.org", "just text &lt; <b>bold"), (22, "https://c.org", "a" * 200_000)]
    got = sorted((r.page_id, r.text, r.n_chars) for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect())
    assert all(len(t) == n for _, t, n in got)
    want = [f"Head {n} First&bold text {n} Second third" for n in range(5)]
    assert [t for i, t, _ in got if i < 5] == want and [t for i, t, _ in got if 10 <= i < 20] == want
    assert [t for i, t, _ in got if i >= 20] == ["", "", "a" * 200_000, "just text < bold"]
    assert main_text.extract(spark.createDataFrame([], "page_id string, url string, html string")).count() == 0


def test_template_decides_before_tags(spark):
    body = lambda n: " ".join(f"w{n}x{k}" for k in range(60))
    page = "<body><div class=story><p>{}</p></div><div class=more><article>teaser {}</article></div></body>"
    rows = [(n, f"https://a.org/{n}", page.format(body(n), n)) for n in range(6)]
    rows += [(10 + n, f"https://b.org/{n}", f"<body><main><div class=top>Our house style</div><p>{body(n)}</p><p>Call us on any working day</p></main></body>") for n in range(6)]
    rows += [(20 + n, f"https://c.org/{n}", f"<body><article><p>{body(0)}</p><p>copied {min(n, 1)}</p></article></body>") for n in range(6)]
    rows += [(30, "https://d.org/", "<body><p>around</p><article>alone</article></body>")]
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[n] for n in range(6)] == [body(n) for n in range(6)]
    assert [got[10 + n] for n in range(6)] == [body(n) for n in range(6)]
    assert [got[20 + n] for n in range(6)] == [f"{body(0)} copied {min(n, 1)}" for n in range(6)]
    assert got[30] == "alone"


def test_names_vote_and_layouts_have_templates(spark):
    body = lambda n: " ".join(f"w{n}x{k}" for k in range(60))
    marks = ["<body class='no-sidebar'>{}", "<body><div class='content with-sidebar'>{}</div>", "<body><article class='post comments-open'>{}</article>",
             "<body><main id='search-results'>{}</main>", "<body class=search>{}", "<body><div id=search>{}</div>"]
    rows = [(n, f"https://h{n}.org/", m.format(f"<p>{body(n)}</p>")) for n, m in enumerate(marks)]
    for kind in range(3):  # three layouts of a third each: menus and boilerplate without a known name
        rows += [(100 + 10 * kind + n, f"https://l.org/{n}", f"<body><div class=k{'abc'[kind]}><p>menu of {'abc'[kind]} pages</p></div>"
                  f"<div class=t{'abc'[kind]}><p>{body(10 * kind + n)}</p></div></body>") for n in range(4)]
    long = "x" * 45
    rows += [(200 + n, f"https://m.org/{n}", f"<body><div class={long}a><p>links {n}</p></div><div class='{long}b'><p>{body(n)}</p></div></body>") for n in range(4)]
    got = {r.page_id: r.text for r in main_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[n] for n in range(len(marks))] == [body(n) for n in range(len(marks))]
    assert all(got[100 + 10 * k + n] == body(10 * k + n) for k in range(3) for n in range(4))
    assert all(got[200 + n] == body(n) for n in range(4))
    short = main_text.extract(spark.createDataFrame([(1, None, f"<article>short</article><div id=comments>{body(1)}</div>")], "page_id long, url string, html string"))
    assert short.first().text == "short"
