"""One row per key, current rows, first-seen order and best detections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import non_blank


def filter_nonempty(df: DataFrame, key: str) -> DataFrame:
    return df.filter(non_blank(F.col(key)))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """First row per key in the given order; all null keys form one key.

    Written as row_number() <= 1, which Spark turns into a group limit before
    the shuffle: a key holding a third of the rows leaves each task as one row.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")


def total_order(df: DataFrame, tiebreak: list[str] | None = None) -> list[Column]:
    """Columns that settle ties: the given ones, else all of the table's by name.

    Name a unique column where there is one, as all others can then be pruned.
    """
    every = sorted(n for n, kind in df.dtypes if not kind.startswith("map"))
    return [F.col(c) for c in (tiebreak or every)]


def latest_per_key(
    df: DataFrame, key: str, year: str, tiebreak: list[str] | None = None, nulls_last: bool = False
) -> DataFrame:
    """Latest row of every non-empty key.

    A missing year sorts before all others unless ``nulls_last`` is set.
    """
    newest = F.desc_nulls_last(year) if nulls_last else F.desc_nulls_first(year)
    return keep_first(filter_nonempty(df, key), [key], [newest, *total_order(df, tiebreak)])


def prefer_current(df: DataFrame, key: str, indicator: str, current: str = "Y") -> DataFrame:
    """Rows marked current; keys that have none keep all their rows.

    The keys with a current row come from a partial aggregate and are joined
    back, so no key's rows are gathered in one window; null is a key too. A
    table without one of the columns comes back as it is.
    """
    if key not in df.columns or indicator not in df.columns:
        return df
    is_current = F.col(indicator) == current
    with_current = (
        df.filter(is_current).select(F.col(key).alias("_key")).distinct().withColumn("_has", F.lit(True))
    )
    joined = df.join(with_current, F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.filter(is_current | F.col("_has").isNull()).drop("_key", "_has")


def distinct_first_seen(df: DataFrame, value: str, seq: list[str]) -> DataFrame:
    """Distinct values with the position at which each was first seen."""
    first = F.min(F.struct(*seq))
    out = df.groupBy(value).agg(first.alias("_first"))
    return out.select(value, *[F.col("_first")[c].alias(c) for c in seq]).orderBy(*seq)


def select_detections(
    df: DataFrame,
    page: list[str],
    box: list[str],
    confidence: str = "confidence",
    threshold: float = 0.6,
    ensure_one: bool = True,
) -> DataFrame:
    """Flag the boxes to keep on each page.

    Boxes at or above the threshold are picked. A page without any gets its
    most confident box (the first in ``box`` order on ties) as a forced pick.
    The boxes of a page meet in one window, which ranks them once.
    """
    likely = F.coalesce(F.col(confidence) >= threshold, F.lit(False))
    flagged = df.withColumn("likely_signature", likely)
    if not ensure_one:
        return flagged.withColumn("picked", likely).withColumn("forced_pick", F.lit(False))
    # The first box of largest confidence, one row of the page even where boxes are equal.
    whole = Window.partitionBy(*page)
    first = F.row_number().over(whole.orderBy(F.col(confidence).desc_nulls_last(), *box)) == 1
    some = F.coalesce(F.max("likely_signature").over(whole), F.lit(False))
    forced = flagged.withColumn("forced_pick", first & ~some)
    return forced.withColumn("picked", F.coalesce("likely_signature", F.lit(False)) | F.col("forced_pick"))


def page_limit(df: DataFrame, n: int, page: str = "page_number") -> DataFrame:
    """The first n pages of every document."""
    return df.filter(F.col(page) <= n)


def latest_entries(df: DataFrame, n: int, seq: list[str]) -> DataFrame:
    """The last n entries, a per-task top-k followed by one merge."""
    return df.orderBy(*[F.desc(c) for c in seq]).limit(n)
