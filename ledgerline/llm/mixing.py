"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import cut

# the largest mean of one draw; a larger mean is drawn in equal parts, for exp(-mean) must not vanish
LARGEST = 32.0


def uniform(*columns: Column) -> Column:
    """A number in [0, 1) that depends on the hashed values alone."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11).cast("double") / F.lit(float(1 << 53))


def poisson(mean: Column, *seeds: Column) -> Column:
    """The least k whose cumulative Poisson probability exceeds a hashed uniform number; a sum of such k for large means.
    Null or not positive means give 0."""
    mean = F.coalesce(mean, F.lit(0.0))
    parts = F.ceil(mean / LARGEST).cast("int")
    own = mean / parts

    def draw(part: Column) -> Column:
        u = uniform(*seeds, part)
        first = F.struct(F.exp(-own).alias("p"), F.exp(-own).alias("upto"), F.lit(0).alias("k"))
        most = F.ceil(own + 12 * F.sqrt(own) + 24).cast("int")

        def step(s: Column, i: Column) -> Column:
            p = s["p"] * own / i
            return F.struct(p.alias("p"), (s["upto"] + p).alias("upto"), F.when(u >= s["upto"], i).otherwise(s["k"]).alias("k"))

        return F.aggregate(F.sequence(F.lit(1), most), first, step, lambda s: s["k"])

    return F.when(mean > 0, F.aggregate(F.sequence(F.lit(1), parts), F.lit(0), lambda n, part: n + draw(part))).otherwise(F.lit(0))


def rates(docs: DataFrame, weights: Mapping[str, float] | None, temperature: float, total: float) -> DataFrame:
    """(mixed_source, rate): mean repetitions that bring each source to its share of `total` times the corpus's code points.

    The target share of a source is its weight over all weights; without weights its size to the power `temperature`, so a
    value below 1 lifts small sources. Sources without text, or not named in the weights, have the rate 0.
    """
    sizes = docs.groupBy(F.col("source").alias("mixed_source")).agg(F.sum(F.length("text")).cast("double").alias("size"))
    if weights is None:
        wanted = F.pow("size", F.lit(temperature))
    else:
        named = F.create_map(*[F.lit(x) for pair in weights.items() for x in pair]) if weights else F.create_map().cast("map<string,double>")
        wanted = F.coalesce(F.try_element_at(named, F.coalesce("mixed_source", F.lit(""))), F.lit(0.0))
    sizes = cut(sizes.withColumn("wanted", F.when(F.col("size") > 0, wanted).otherwise(0.0)))
    whole = sizes.agg(F.sum("size").alias("all_size"), F.sum("wanted").alias("all_wanted"))
    one = whole.first()
    if not one.all_wanted:
        return sizes.select("mixed_source", F.lit(0.0).alias("rate"))
    return cut(sizes.select("mixed_source", F.when(
        F.col("wanted") > 0, F.col("wanted") / one.all_wanted * one.all_size * total / F.col("size")).otherwise(0.0).alias("rate")))


COPY, KEY = "_mixing_copy", "_mixing_key"


def repeated(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5, total: float = 1.0, seed: int = 17) -> DataFrame:
    """The columns of docs as they are, COPY and KEY: the rows that `mix` gives, in its order, under names that no table has."""
    columns = docs.columns
    table = rates(docs, weights, temperature, total).toDF("_mixing_source", "_mixing_rate")
    given = docs.join(table, F.col("source").eqNullSafe(F.col("_mixing_source")), "left")
    name = [F.col("doc_id"), F.when(F.col("doc_id").isNull(), F.col("text"))]
    count = poisson(F.col("_mixing_rate"), F.lit(seed), *name)
    copies = given.withColumn(COPY, F.explode(F.when(count > 0, F.sequence(F.lit(1), count))))
    keyed = copies.withColumn(KEY, F.xxhash64(F.lit(seed + 1), *name, COPY))
    return keyed.select(*columns, COPY, KEY).repartition(KEY).sortWithinPartitions(KEY, COPY)


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, temperature: float = 0.5, total: float = 1.0, seed: int = 17) -> DataFrame:
    """The rows of docs, each as often as its Poisson number, with copy_number and shuffle_key, in an order without pattern.

    A row's number depends on the seed, its id and its source's rate, not on where it lies; rows that repeat an id
    repeat its number, and rows without an id go by their text. Rows with a null source are one source; null texts have no size.
    An empty table gives none. shuffle_key is a hash of id and
    copy: rows go to tasks by it and are sorted by it, so copies scatter over the whole output and no source fills a task.
    Rates come as a join on the source that Spark sizes itself: a large table of sources is not broadcast. Given columns named
    copy_number or shuffle_key make way for the operator's; all others stay as they are.
    """
    kept = [c for c in docs.columns if c not in ("copy_number", "shuffle_key")]
    rows = repeated(docs, weights, temperature, total, seed)
    return rows.select(*kept, F.col(COPY).alias("copy_number"), F.col(KEY).alias("shuffle_key"))
