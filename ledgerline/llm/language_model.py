"""Log-bilinear language model: counts and training over the whole corpus, scores of whole texts.

Words beyond the `classes` most frequent form one class, inside which a word's share is its smoothed
count. The model predicts the class from the two classes before it: their position-dependent vectors add up to a predicted
vector, whose products with all class vectors, plus biases, are normalised.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import cut
from ledgerline.llm.toxicity import held_out

SMOOTH = 0.1
# words whose share of all tokens is at least 1/HOT go to every task: HOT words at most
HOT = 1 << 16
FLUSH = 400_000
# bytes of texts taken apart at once; a longer text stands alone
STRETCH = 1 << 21
# occurrences that one visit of a triple stands for, at most
VISIT = 4
LN10 = np.log(10)


@dataclass(frozen=True)
class Net:
    """Vectors of the class before (near), of the one before that (far), of the predicted class, and biases.
    Classes: words 0 .. n - 1, then the end, then all other words; before a text stands one more."""

    near: np.ndarray
    far: np.ndarray
    out: np.ndarray
    bias: np.ndarray

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Log-probability of a class is pair[h1, w] + ahead[h2, w] - norm[h2, h1]: the first two as products of all
        vectors, the last by adding up every context's exponentials, a batch of contexts at a time."""
        pair, ahead = self.near @ self.out.T + self.bias, self.far @ self.out.T
        norm = np.empty((len(ahead), len(pair)))
        for h2 in range(len(ahead)):
            score = pair + ahead[h2]
            top = score.max(axis=1)
            norm[h2] = top + np.log(np.exp(score - top[:, None]).sum(axis=1))
        return np.stack([pair, ahead]), norm


def start(unigram: np.ndarray, size: int) -> Net:
    rng = np.random.default_rng(7)
    n = len(unigram)
    near, far, out = (rng.normal(0, 0.1, (rows, size)) for rows in (n + 1, n + 1, n))
    return Net(near, far, out, np.log(unigram))


def train_nce(net: Net, triples: np.ndarray, weights: np.ndarray, unigram: np.ndarray, seed: int, noise: int = 25,
              drawn: int = 100, batch: int = 512, steps: int = 500, rate: float = 0.1) -> Net:
    """Noise-contrastive estimation over (far, near, word) triples, by Adagrad. A pass visits every triple once for each VISIT of its
    occurrences or part of them, in random order, and weights the visits so that each occurrence counts the same. There is
    one whole pass, and more where that is fewer than `steps` batches.

    A batch shares its noise words, so scores are products of matrices. Each triple is told from `noise` draws of the
    unigram distribution, of which the `drawn` shared words are an estimate."""
    rng = np.random.default_rng(seed)
    near, far, out, bias = (p.astype(np.float32) for p in (net.near, net.far, net.out, net.bias))
    past = [np.full(p.shape, 1e-4, dtype=np.float32) for p in (near, far, out, bias)]
    shift = np.log(noise * unigram).astype(np.float32)
    times = np.ceil(weights / VISIT).astype(np.int64)
    visits = rng.permutation(np.repeat(np.arange(len(triples), dtype=np.int32), times))
    weights = (weights / times * len(visits) / weights.sum()).astype(np.float32)
    share = np.cumsum(unigram)
    share /= share[-1]
    sig = lambda x: 1 / (1 + np.exp(-np.clip(x, -30, 30)))

    def added(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
        """The sum of the rows that belong to each of n classes."""
        wide = rows.shape[1]
        cells = (at[:, None] * wide + np.arange(wide)).ravel()
        return np.bincount(cells, rows.ravel(), n * wide).reshape(n, wide).astype(np.float32)

    for step in range(max(steps, -(-len(visits) // batch))):
        own = visits[np.arange(step * batch, (step + 1) * batch) % len(visits)]
        (h2, h1, word), weight = triples[own].T, weights[own][:, None]
        seen = share.searchsorted(rng.random(drawn), side="right")
        r, out_true, out_seen = near[h1] + far[h2], out[word], out[seen]
        true = sig((r * out_true).sum(axis=1) + bias[word] - shift[word])[:, None]
        false = sig(r @ out_seen.T + (bias[seen] - shift[seen]))
        d_true = (true - 1) * weight / batch
        d_false = false * (weight * (noise / drawn / batch))
        d_r = d_true * out_true + d_false @ out_seen
        words, rows = np.concatenate([word, seen]), np.concatenate([d_true * r, d_false.T @ r])
        d_out = added(words, rows, len(out))
        d_bias = added(words, np.concatenate([d_true, d_false.sum(axis=0)[:, None]]), len(out))[:, 0]
        d_near, d_far = added(h1, d_r, len(near)), added(h2, d_r, len(far))
        for p, d, g in zip((near, far, out, bias), (d_near, d_far, d_out, d_bias), past):
            g += d * d
            p -= rate * d / np.sqrt(g)
    return Net(near, far, out, bias)


def _stretches(texts: pa.Array) -> Iterator[pa.Array]:
    """Texts, as bytes, in slices of about STRETCH bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first = 0
    while first < len(texts):
        before = int(upto[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(upto, before + STRETCH, side="right")))
        yield texts.slice(first, last - first)
        first = last


def _split(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts in order, A-Z as a-z, and how many each text has. Words are cut at ASCII white space alone and bytes
    from 0x80 on stay as they are, so texts pass as UTF-8 unchecked."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.cast(pa.binary()).view(pa.utf8()).fill_null("")))
    flat, upto = lists.flatten(), np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))])
    real = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    met = np.concatenate([[0], np.cumsum(real)])
    return flat.filter(pa.array(real)), np.diff(met[upto])


def _summed(held: list[pa.Table]) -> pa.Table:
    """(word, c) with each word once."""
    all_of = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("c", "sum")])
    return pa.table({"word": all_of["word"], "c": all_of["c_sum"]})


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) over all texts, words as bytes; null stands for the end of a text. Counted per task first."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, ends = [], 0, 0
        for part in parts:
            for texts in _stretches(part.column(0)):
                met = pc.value_counts(_split(texts)[0])
                held.append(pa.table({"word": met.field("values").view(pa.binary()), "c": met.field("counts")}))
                rows += len(met)
                ends += len(texts)
                if rows > FLUSH:
                    held = [_summed(held)]
                    rows = len(held[0])
                    if 2 * rows > FLUSH:
                        yield from held[0].to_batches()
                        held, rows = [], 0
        if held:
            yield from _summed(held).to_batches()
        if ends:
            yield pa.RecordBatch.from_arrays([pa.array([None], pa.binary()), pa.array([ends], pa.int64())], ["word", "c"])

    return docs.select("text").mapInArrow(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _indexed(texts: pa.Array, index: pa.Array, other: int, end: int) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Place in the index of each token of each text with its end, tokens per text, the words of all texts, and each word's place
    among the tokens."""
    words, n = _split(texts)
    place = np.arange(len(words)) + np.repeat(np.arange(len(n)), n)
    flat = np.full(len(words) + len(n), end, dtype=np.int64)
    flat[place] = pc.fill_null(pc.index_in(words, value_set=index.view(pa.utf8())), other).to_numpy(zero_copy_only=False)
    return flat, n + 1, words, place


def _tails(words: pa.Array, text: np.ndarray, texts: int) -> tuple[pa.Array, pa.Array]:
    """Offsets and (word, n) of each text's distinct words; text has the number of the text of each word."""
    coded = words.dictionary_encode()
    most = max(1, len(coded.dictionary))
    own, n = np.unique(text * most + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
    offsets = np.concatenate([[0], np.cumsum(np.bincount(own // most, minlength=texts))]).astype(np.int32)
    return pa.array(offsets), pa.StructArray.from_arrays([coded.dictionary.take(pa.array(own % most)).view(pa.binary()), pa.array(n, pa.int64())], ["word", "n"])


def _context(kinds: np.ndarray, lengths: np.ndarray, before: int) -> tuple[np.ndarray, np.ndarray]:
    """The class before each token and the one before that."""
    starts = np.cumsum(lengths) - lengths
    h1, h2 = np.roll(kinds, 1), np.roll(kinds, 2)
    h1[starts] = before
    h2[starts] = before
    second = starts[lengths > 1] + 1
    h2[second] = before
    return h1, h2


def triple_counts(docs: DataFrame, index: pa.Array, classes: int) -> DataFrame:
    """(code, n): how often each (far, near, word) of classes occurs; at most (classes + 3) ** 3 rows."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            codes, counts = [], []
            for texts in _stretches(part.column(0)):
                kinds, lengths, _, _ = _indexed(texts, index, classes + 1, classes)
                h1, h2 = _context(kinds, lengths, classes + 2)
                own, n = np.unique((h2 * (classes + 3) + h1) * (classes + 3) + kinds, return_counts=True)
                codes.append(own), counts.append(n)
            if codes:
                own, back = np.unique(np.concatenate(codes), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(n)], ["code", "n"])

    return docs.select("text").mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def apart(dealt: DataFrame, trainers: int) -> DataFrame:
    """Every part in a task of its own; parts dealt by their hashes would meet in some tasks and leave others idle."""
    return dealt.repartitionById(trainers, "part")


def fit(triples: DataFrame, unigram: np.ndarray, classes: int, size: int = 24, rounds: int = 3, trainers: int = 12) -> Net:
    """Rounds of NCE by `trainers` tasks, each over its share of the triples, averaged by their weights. What reaches the driver is
    `trainers` small nets a round, whatever the corpus."""
    shapes = [(classes + 3, size), (classes + 3, size), (classes + 2, size), (classes + 2,)]
    ends = np.cumsum([int(np.prod(s)) for s in shapes])
    net = start(unigram, size)
    dealt = cut(triples.withColumn("part", F.pmod(F.xxhash64("code"), F.lit(trainers)).cast("int")))

    def trainer(net: Net, turn: int):
        def run(block: pd.DataFrame) -> pd.DataFrame:
            block = block.sort_values("code")
            code, n = block["code"].to_numpy(), block["n"].to_numpy(dtype=float)
            base = classes + 3
            own = train_nce(net, np.stack([code // base // base, code // base % base, code % base], axis=1), n, unigram,
                            1000 * turn + int(block["part"].iloc[0]))
            flat = np.concatenate([p.ravel() for p in (own.near, own.far, own.out, own.bias)])
            return pd.DataFrame({"part": block["part"].iloc[:1], "n": [n.sum()], "net": [flat.tolist()]})

        return run

    for turn in range(rounds):
        got = apart(dealt, trainers).groupBy("part").applyInPandas(trainer(net, turn), "part long, n double, net array<double>").collect()
        if got:
            got.sort(key=lambda r: r.part)
            mean = np.average([r.net for r in got], axis=0, weights=[r.n for r in got])
            net = Net(*(p.reshape(s) for p, s in zip(np.split(mean, ends[:-1]), shapes)))
    return net


def score(docs: DataFrame, classes: int = 254, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row, repeated rows each.

    Learns from all rows but the held-out ones (crc32 of the id as text, modulo 10, is 0; a null id is none of them). Null and
    blank texts are the end alone. base_score adds up smoothed unigram log10 probabilities, score those of the model: of the
    class given the two before, and of the word in its class. Counts of words that are not hot are joined, not broadcast.
    Without training rows both scores are those of no knowledge, 0.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("text")).withColumn(
        "held_out", held_out(parts=10))
    learn = docs.where("NOT held_out")
    counts = cut(word_counts(learn))
    total = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n_all, v_all = int(total.n or 0), int(total.v)
    ends = counts.where("word IS NULL").first()
    n_end = int(ends.c) if ends else 0
    words = counts.where("word IS NOT NULL")
    hot = sorted(((bytes(r.word), int(r.c)) for r in words.where(F.col("c") * HOT >= n_all).collect()), key=lambda x: (-x[1], x[0]))
    classes = min(classes, len(hot))
    index = pa.array([w for w, _ in hot], pa.binary())
    known = np.array([c for _, c in hot] + [0, n_end], dtype=float)
    n_rare, v_rare = n_all - n_end - int(known[:classes].sum()), v_all - (1 if n_end else 0) - classes
    unigram = np.array([*known[:classes], n_end, n_rare]) + SMOOTH
    net = fit(triple_counts(learn, index[:classes], classes), unigram / unigram.sum(), classes) if n_all else None
    products, norm = net.tables() if net else (None, None)
    log_c = np.log10(known + SMOOTH)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, end = len(hot), len(hot) + 1
        kind_of = np.concatenate([np.arange(classes), np.full(len(hot) - classes, classes + 1), [classes + 1, classes]]).astype(np.int64)
        for part in parts:
            first = 0
            for texts in _stretches(part.column(3)):
                at, lengths, words, place = _indexed(texts, index, tail, end)
                starts, rest = np.cumsum(lengths) - lengths, at == tail
                add = lambda x: np.add.reduceat(x, starts)  # noqa: B023, E731
                kinds = kind_of[at]
                h1, h2 = _context(kinds, lengths, classes + 2)
                by_class = add(products[0][h1, kinds] + products[1][h2, kinds] - norm[h2, h1]) / LN10 if net else np.zeros(len(lengths))
                own = np.where(rest, 0.0, log_c[at])
                rare = kinds == classes + 1
                offsets, pairs = _tails(words.filter(pa.array(rest[place])), np.repeat(np.arange(len(lengths)), add(rest.astype(np.int64))), len(lengths))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(k).slice(first, len(lengths)) for k in range(3)), pa.array(lengths, pa.int64()),
                     pa.array(add((known[at] > 0).astype(np.int64)), pa.int64()), pa.array(add(rest.astype(np.int64)), pa.int64()), pa.array(add(own)), pa.array(by_class),
                     pa.array(add(rare.astype(np.int64)), pa.int64()), pa.array(add(np.where(rare, own, 0.0))), pa.ListArray.from_arrays(offsets, pairs)],
                    ["row", "doc_id", "held_out", "n_tokens", "n_known", "n_tail", "hot_sum", "class_sum", "n_rare", "rare_sum", "tail"])
                first += len(lengths)

    scored = cut(docs.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text").mapInArrow(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, n_tail long, hot_sum double, class_sum double, "
             "n_rare long, rare_sum double, tail array<struct<word: binary, n: long>>"))
    rest = (scored.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.n").join(words.where(F.col("c") * HOT < n_all), "word")
            .groupBy("row").agg(F.sum("n").alias("met"), F.sum(F.expr(f"n * log10(c + {SMOOTH}D)")).alias("met_sum")))
    base_all = float(np.log10(n_all + SMOOTH * (v_all + 1)))
    rare_all = float(np.log10(n_rare + SMOOTH * (v_rare + 1)))
    unmet = f"(coalesce(met_sum, 0D) + (n_tail - coalesce(met, 0)) * log10({SMOOTH}D))"
    base = f"hot_sum + {unmet} - n_tokens * {base_all!r}D"
    model = f"class_sum + rare_sum + {unmet} - n_rare * {rare_all!r}D" if net else base
    return scored.drop("tail").join(rest, "row", "left").select(
        "doc_id", "held_out", "n_tokens", F.expr("n_known + coalesce(met, 0)").alias("n_known"), F.lit(n_all).cast("long").alias("train_tokens"),
        F.expr(base).alias("base_score"), F.expr(model).alias("score"))
