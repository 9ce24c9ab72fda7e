"""Language identification: known words by per-language log frequency, unseen ones by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import cut
from ledgerline.llm.token_counts import text_batches

RUNS = re.compile(r"[^\W\d_]+")
ENTRIES, LETTERS, LONG = 1 << 18, 1 << 24, 40
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    """Runs of letters, in lower case. A run of the pattern may hold other numerals, such as a raised two; they part words too."""
    runs = RUNS.findall(text.lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


def grams_of(word: str, size: int) -> list[str]:
    """The word's n-grams, with a space for either edge."""
    marked = f" {word} "
    return [marked[i : i + size] for i in range(len(marked) - size + 1)] if size > 1 else list(word)


@dataclass
class Model:
    """Log frequencies of entries: level 0 holds words, level k n-grams of k letters. A row has a column per language.
    What unseen words came to is held in a cache of bounded size."""

    langs: list[str]
    rows: dict[int, dict[str, int]]
    logs: dict[int, np.ndarray]
    cached: dict[str, tuple[int, list[int]]] = field(default_factory=dict)

    def back_off(self, word: str) -> tuple[int, list[int]]:
        """The known n-grams of the greatest length of which any is known."""
        marked = f" {word} "
        for size in range(len(self.rows) - 1, 1, -1):
            get = self.rows[size].get
            if found := [p for i in range(len(marked) - size + 1) if (p := get(marked[i : i + size])) is not None]:
                return size, found
        get = self.rows[1].get
        found = [p for c in word if (p := get(c)) is not None]
        return (1, found) if found else (0, [])

    def evidence(self, words: list[str]) -> np.ndarray:
        """Summed log frequencies of all words; an unseen word counts with the mean of its n-grams'."""
        known, cached = self.rows[0], self.cached
        places, sizes, times = [[] for _ in self.rows], [[] for _ in self.rows], [[] for _ in self.rows]
        for word, n in Counter(words).items():
            if (place := known.get(word)) is not None:
                places[0].append(place)
                times[0].append(n)
                continue
            if (held := cached.get(word)) is None:
                held = self.back_off(word)
                if len(cached) >= ENTRIES:
                    cached.clear()
                if len(word) < LONG:
                    cached[word] = held
            size, found = held
            if found:
                places[size] += found
                sizes[size].append(len(found))
                times[size].append(n)
        total = np.zeros(len(self.langs))
        for level, at in enumerate(places):
            if at:
                weight = np.array(times[level], dtype=np.float64)
                total += (np.repeat(weight / sizes[level], sizes[level]) if level else weight) @ self.logs[level][at]
        return total

    def predict(self, text: str) -> tuple[str, float]:
        words = words_of(text)
        if not words or not self.langs:
            return UNKNOWN, 0.0
        logs = self.evidence(words)
        best = int(np.argmax(logs))
        return self.langs[best], float(1 / np.exp(logs - logs[best]).sum())


Counters = dict[tuple[str, int], Counter[str]]


def _rows(counters: Iterator[Counters]) -> Iterator[pa.RecordBatch]:
    for held in counters:
        for (lang, level), counts in held.items():
            n = len(counts)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * n, pa.string()), pa.array(np.full(n, level), pa.int32()), pa.array([*counts], pa.string()), pa.array([*counts.values()], pa.int64())],
                                             ["lang", "level", "entry", "n"])


def count_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's words by language, given up whenever they grow past a bound."""

    def counters() -> Iterator[Counters]:
        held: Counters = defaultdict(Counter)
        letters = 0
        for part in parts:
            for lang, text in zip(part.column(0).to_pylist(), part.column(1)):
                text = text.as_py()
                letters += len(text)
                held[lang, 0].update(words_of(text))
                if letters > LETTERS or sum(map(len, held.values())) > ENTRIES:
                    yield held
                    held, letters = defaultdict(Counter), 0
        yield held

    return _rows(counters())


def count_grams(longest: int):
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counters() -> Iterator[Counters]:
            held: Counters = defaultdict(Counter)
            for part in parts:
                for lang, word, n in zip(*(part.column(c).to_pylist() for c in ("lang", "entry", "n"))):
                    for size in range(1, longest + 1):
                        counts = held[lang, size]
                        for gram in grams_of(word, size):
                            counts[gram] += n
                    if sum(map(len, held.values())) > ENTRIES:
                        yield held
                        held = defaultdict(Counter)
            yield held

        return _rows(counters())

    return run


def train(labelled: DataFrame, longest: int = 5, share: int = 1 << 16, smooth: float = 0.5, lang_col: str = "lang", text_col: str = "text") -> Model:
    """Counts words of all rows with a language and a text, and from their numbers n-grams of up to `longest` letters. An entry is
    known where it makes up one in `share` or more of some language's words (or of its n-grams of that length), so a language
    knows `share` entries a level at most, at any size of the corpus; all languages' counts of known entries are kept."""
    schema = "lang string, level int, entry string, n long"
    given = labelled.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    key = ("lang", "level", "entry")
    words = cut(given.mapInArrow(count_words, schema).groupBy(*key).agg(F.sum("n").alias("n")))
    grams = words.mapInArrow(count_grams(longest), schema).groupBy(*key).agg(F.sum("n").alias("n"))
    counts = cut(words.union(grams))
    found = counts.groupBy("lang", "level").agg(F.sum("n").alias("total")).collect()  # a row per language and level
    total = {(r.lang, r.level): r.total for r in found}
    # as a local table, whose size Spark knows, the totals go to the counts, and no language's counts gather
    totals = labelled.sparkSession.createDataFrame(found, "lang string, level int, total long")
    frequent = counts.join(totals, ["lang", "level"]).groupBy("level", "entry").agg(
        F.max(F.col("n") * share >= F.col("total")).alias("known"), F.collect_list(F.struct("lang", "n")).alias("by")).where("known")
    langs = sorted({lang for lang, _ in total})
    entries: dict[int, list[tuple[str, list]]] = {k: [] for k in range(longest + 1)}
    for part in frequent.select("level", "entry", "by").toArrow().to_batches():
        for level, entry, by in zip(*(part.column(c).to_pylist() for c in ("level", "entry", "by"))):
            entries[level].append((entry, by))
    rows, logs = {}, {}
    for level, own in entries.items():
        own.sort(key=lambda e: e[0])
        n = np.zeros((len(own), len(langs)))
        for i, (_, by) in enumerate(own):
            for one in by:
                n[i, langs.index(one["lang"])] = one["n"]
        all_of = np.array([total.get((lang, level), 0) for lang in langs], dtype=np.float64)
        rows[level] = {entry: i for i, (entry, _) in enumerate(own)}
        logs[level] = np.log((n + smooth) / (all_of + smooth * max(1, len(own))))
    return Model(langs, rows, logs)


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score (the posterior of the language, all being equally likely before) of every row, in any order.
    Ties go to the first language by name. `und` and 0 for a null text, a text without a letter, or a model of no language."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for part in parts:
            texts = [t or "" for t in part.column(1).to_pylist()]
            for first, last in text_batches(texts):
                found = [model.predict(t) for t in texts[first:last]]
                yield pa.RecordBatch.from_arrays([part.column(0).slice(first, last - first), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                                 ["doc_id", "lang_pred", "score"])

    given = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return given.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(docs: DataFrame, id_col: str = "doc_id") -> F.Column:
    """Whether the id's crc32, as text, leaves 2 when divided by 4. A row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("long").cast("string")) % 4 == 2, F.lit(False))


def languages(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score: learned from text and language of the rows that aren't held out, for every row. Rows
    without an id aren't held out; repeated rows count as often as they occur; extra columns are not read."""
    found = identify(docs, train(docs.where(~held_out(docs))))
    return found.select("doc_id", held_out(found).alias("held_out"), "lang_pred", "score")
