"""Secrets in texts: fixed patterns, and character Markov models of random strings and of identifiers. Columns only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: the patterns; a match of assign needs 8 characters in its second group. Runs of hex digits and of
# key characters are taken whole, so a least length in the pattern finds the same matches as one asked for afterwards.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "markov")
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
IDENTIFIER = r"\b[A-Za-z_]{8,}\b"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."


def found(text: Column, pattern: str, group: int = 0) -> Column:
    """Array of (start, end, value) of the matches, leftmost first and not overlapping; value is the group. Positions
    count code points: what stands between matches is what splitting at them leaves."""
    between = F.split(text, pattern, -1)
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    each = F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("gap"), whole.alias("hit"),
                        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))
    none = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")

    def step(s: Column, x: Column) -> Column:
        start = s["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        return F.struct(end.cast("long").alias("at"), F.concat(s["out"], F.array(F.struct(
            start.cast("long").alias("start"), end.cast("long").alias("end"), x["value"].alias("value")))).alias("out"))

    first = F.struct(F.lit(0).cast("long").alias("at"), none.alias("out"))
    return F.when(text.rlike(pattern), F.aggregate(each, first, step, lambda s: s["out"])).otherwise(none)


def base(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs with assign, access and hex: arrays of the matches of each pattern."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.withColumns({
        "assign": F.filter(found(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= 8),
        "access": found(text, ACCESS), "hex": found(text, HEX)})


def _pairs(value: Column) -> Column:
    """Numbers of the neighbouring characters of a string; a character outside the alphabet counts as one more."""
    place = lambda i: F.position(F.substr(value, i, F.lit(1)), F.lit(LETTERS))
    return F.when(F.length(value) > 1, F.transform(
        F.sequence(F.lit(1), F.length(value) - 1), lambda i: place(i) * (len(LETTERS) + 1) + place(i + 1)))


def _mean_ratio(value: Column, ratios: Column) -> Column:
    """Log-likelihood ratio of a string per pair of characters."""
    pairs = _pairs(value)
    return F.aggregate(pairs, F.lit(0.0), lambda s, p: s + F.get(ratios, p)) / F.size(pairs)


def train(docs: DataFrame, sample: int = 2000, text_col: str = "text", id_col: str = "doc_id") -> tuple[list[float], float]:
    """Log ratios of neighbouring characters, and the ratio per pair from which a string counts as random.

    Labelled samples: strings that the fixed patterns find, as random, and words of eight or more letters and underscores beside them, as
    ordinary; each from at most `sample` documents, by the hash of the id. The counts have a row per pair of the alphabet
    at most. The bound lies between the classes: the middle of a low quantile of random strings and the median of ordinary ones,
    which a few secrets among the latter do not move.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    order = [F.xxhash64(id_col), F.xxhash64(text)]
    marked = docs.where(text.rlike(f"{ASSIGN}|{ACCESS}|{HEX}")).orderBy(*order).limit(sample)
    values = base(marked).select(F.explode(F.concat("assign", "access", "hex")).alias("m")).select(F.col("m.value").alias("value"))
    plain = docs.orderBy(*order).limit(sample).select(
        F.explode(F.regexp_extract_all(F.regexp_replace(text, f"{ASSIGN}|{ACCESS}|{HEX}", " "), F.lit(IDENTIFIER), F.lit(0))).alias("value"))
    labelled = values.where(F.length("value") >= 16).distinct().withColumn("label", F.lit(1)).union(plain.distinct().withColumn("label", F.lit(0)))
    counts = labelled.select("label", F.explode(_pairs(F.col("value"))).alias("pair")).groupBy("label", "pair").count().collect()
    size = len(LETTERS) + 1
    logs = []
    for label in (1, 0):
        own = [1.0] * (size * size)
        for row in counts:
            if row.label == label:
                own[row.pair] += row["count"]
        rows = [sum(own[k * size : (k + 1) * size]) for k in range(size)]
        logs.append([math.log(own[k] / rows[k // size]) for k in range(size * size)])
    ratios = [a - b for a, b in zip(*logs)]
    scored = labelled.select("label", _mean_ratio(F.col("value"), F.lit(ratios)).alias("r"))
    got = {r.label: r.q for r in scored.groupBy("label").agg(F.percentile_approx("r", [0.05, 0.5]).alias("q")).collect()}
    if 1 not in got or 0 not in got:
        return ratios, math.inf
    return ratios, (got[1][0] + got[0][1]) / 2


def scan(docs: DataFrame, ratios: list[float], bound: float, text_col: str = "text") -> DataFrame:
    """docs with assign, access, hex and markov: arrays of (start, end, value); value is the secret itself.

    markov: runs of 20 or more key characters whose log-likelihood ratio per pair exceeds the bound, outside the other
    matches. Null texts have none. Long texts are looked through whole.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    own = F.concat("assign", "access", "hex")
    likely = F.filter(found(text, CANDIDATE), lambda m: _mean_ratio(m["value"], F.lit(ratios)) > F.lit(bound))
    return base(docs, text_col).withColumn("markov", F.filter(
        likely, lambda m: ~F.exists(own, lambda b: (b["start"] < m["end"]) & (m["start"] < b["end"]))))


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of some kinds, by start, then kind as listed, joined by commas."""
    def marked(n: int, kind: str) -> Column:
        return F.transform(kind, lambda m: F.struct(
            m["start"], F.lit(n).alias("n"), F.concat_ws(":", F.lit(kind), m["start"].cast("string"), m["end"].cast("string")).alias("name")))

    return F.array_join(F.transform(F.array_sort(F.concat(*[marked(n, k) for n, k in enumerate(kinds)])), lambda m: m["name"]), ",")


def redact(scanned: DataFrame, text_col: str = "text", mark: str = "[secret]") -> Column:
    """The text with every found value replaced by a mark; texts without any stay as they are."""
    values = F.array_distinct(F.transform(F.concat(*KINDS), lambda m: m["value"]))
    longest = F.array_sort(values, lambda a, b: F.length(b) - F.length(a))
    return F.when(F.size(values) > 0, F.aggregate(longest, F.col(text_col), lambda t, v: F.replace(t, v, F.lit(mark)))).otherwise(F.col(text_col))


def digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans of every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    spans = scan(docs, *train(docs))
    return spans.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"), listed(KINDS).alias("spans"))
