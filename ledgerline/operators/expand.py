"""Statements that name several entities, and lists split into head and rest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import strip
from .selection import keep_first, total_order


def statement_id(idx: str = "idx", start: str = "period_start", end: str = "period_end") -> Column:
    """idx_start_end, null when one of them is null."""
    text = [F.col(c).cast("string") for c in (idx, start, end)]
    return F.concat(text[0], F.lit("_"), text[1], F.lit("_"), text[2])


def unique_statements(df: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """One row per idx and period; rows lacking a part all share one null id."""
    df = df.withColumn("statement_unique_id", statement_id())
    order = [F.desc_nulls_first("period_end"), *total_order(df, tiebreak)]
    return keep_first(df, ["statement_unique_id"], order)


def _named(c: str) -> Column:
    """A text for each value, and one for null."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def expand_entities(df: DataFrame, ids: str = "abn") -> DataFrame:
    """One row per id in the comma list of each unique statement.

    Adds the non-null ids of the whole idx, the 0-based position of the row in
    it, the group id and the primary flag. Positions are worked out per
    statement, before the lists are exploded: a running sum inside each
    (idx, period_start) plus the total of the earlier periods. One idx can
    therefore hold any share of the rows, as a window never sees more than the
    statements that start on one day, or one row per day. Days are told apart
    by two texts without nulls, so the running sum and the join share one
    partitioning and order.
    """
    listed = F.split(strip(F.col(ids).cast("string")), ",")
    sized = df.withColumns({
        "_ids": listed,
        "_rows": F.coalesce(F.size(listed), F.lit(1)).cast("bigint"),
        "_known": F.coalesce(F.size(listed), F.lit(0)).cast("bigint"),
        "_who": _named("idx"),
        "_since": _named("period_start"),
    }).withColumn("_rows", F.greatest("_rows", F.lit(1))).withColumn("_known", F.greatest("_known", F.lit(0)))

    per_day = sized.groupBy("_who", "_since").agg(
        F.sum("_rows").alias("_day_rows"), F.sum("_known").alias("_day_known"), F.max("period_start").alias("_start")
    )
    by_day = Window.partitionBy("_who").orderBy(F.asc_nulls_first("_start"))
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_who")
    offsets = per_day.select(
        "_who",
        "_since",
        F.coalesce(F.sum("_day_rows").over(earlier), F.lit(0)).alias("_offset"),
        F.sum("_day_known").over(whole).alias("group_entity_count"),
    )

    in_day = Window.partitionBy("_who", "_since").orderBy(F.asc_nulls_first("statement_unique_id"))
    placed = sized.withColumn(
        "_before",
        F.coalesce(F.sum("_rows").over(in_day.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    )
    joined = placed.join(offsets, ["_who", "_since"], "left")
    rest = [c for c in df.columns if c != ids]
    rows = joined.select(
        *rest,
        "group_entity_count",
        (F.col("_offset") + F.col("_before")).alias("_first"),
        F.posexplode_outer("_ids").alias("_pos", "_id"),
    )
    index = F.col("_first") + F.coalesce("_pos", F.lit(0))
    return rows.select(
        *rest,
        strip(F.col("_id")).alias(ids),
        "group_entity_count",
        index.alias("entity_index_in_group"),
        F.col("idx").alias("statement_group_id"),
        (index == 0).alias("is_primary_entity"),
    )


def head(items: Column) -> Column:
    return F.get(items, 0)


def rest(items: Column) -> Column:
    """Everything after the first item, null when there is nothing more."""
    return F.when(F.size(items) > 1, F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0))))
