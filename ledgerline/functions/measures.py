"""Flags, scores and bands derived from statement and registry columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import replace_first

# Bands by the first text found, in this order. The "50-250" text
# also contains "0-25", so under these rules it is read as Micro.
TURNOVER_BANDS = [("0-25", "Micro"), ("25-50", "Small"), ("50-250", "Medium"), ("250", "Large")]

# Provinces and territories counted as major.
MAJOR_PROVINCES = ["ON", "QC", "BC", "AB"]


def years_between(later: Column, earlier: Column) -> Column:
    """Difference of calendar years."""
    return F.year(later) - F.year(earlier)


def period_days(start: Column, end: Column) -> Column:
    return F.datediff(end, start)


def list_length(c: Column, sep: str = ",") -> Column:
    """Items in a separated list, 0 when there is none."""
    separators = F.length(c) - F.length(F.replace(c, F.lit(sep), F.lit("")))
    return F.coalesce(separators + 1, F.lit(0))


def additive_score(*flags: Column) -> Column:
    """Number of true flags; null as soon as one flag is null."""
    total = flags[0].cast("int")
    for flag in flags[1:]:
        total = total + flag.cast("int")
    return total


def in_set(c: Column, values: list[str]) -> Column:
    """Membership, with null counting as no."""
    return F.coalesce(c.isin(values), F.lit(False))


def recency(year: Column, current_year: int) -> Column:
    """5 for the current year, one less per year before it, never below 0."""
    return F.coalesce(F.greatest(F.lit(0), F.lit(5) - (F.lit(current_year) - year)), F.lit(0))


def size_band(turnover: Column, corrected: bool = False) -> Column:
    """Size from turnover text; ``corrected`` tests the longest text first."""
    bands = sorted(TURNOVER_BANDS, key=lambda b: -len(b[0])) if corrected else TURNOVER_BANDS
    out = F.when(F.lit(False), F.lit(None).cast("string"))
    for text, band in bands:
        out = out.when(F.contains(turnover, F.lit(text)), F.lit(band))
    return out.otherwise("Unknown")


def joined_address(*parts: Column) -> Column:
    """Address parts with ', ' between them; null if one is null.

    The first empty part leaves ', ,', which is collapsed once.
    """
    pieces = [parts[0]]
    for part in parts[1:]:
        pieces += [F.lit(", "), part]
    return F.btrim(replace_first(F.concat(*pieces), ", ,", ","), F.lit(", "))
