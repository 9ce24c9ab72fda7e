"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.tables import cut


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
    return tuple(row)


def components(edges: DataFrame) -> DataFrame:
    """(id, component) for every id of the links (a, b): component is the least id that links reach.

    Union by alternating stars: every id passes its least neighbour to the larger neighbours (large
    star), then to itself and the smaller ones (small star), until nothing changes; a chain halves each
    time. Neighbours are never gathered: the least one is an aggregate that is joined back, so a
    hub of any size stays split. Rows without a and b and links of an id to itself give no row.
    """
    edges = cut(edges.where("a <> b").selectExpr("greatest(a, b) a", "least(a, b) b").distinct())
    mark = _mark(edges)
    while True:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.col("u"), F.min("b")).alias("m"))
        large = both.join(least, F.col("a") == F.col("u")).where("b > a").selectExpr("b AS a", "m AS b").distinct()
        least = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        small = large.join(least, F.col("a") == F.col("u"))
        small = small.selectExpr("b AS a", "m AS b").union(least.select("u", "m")).where("a <> b").distinct()
        edges = cut(small)
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).union(
        edges.select("b").distinct().select("b", "b"))
