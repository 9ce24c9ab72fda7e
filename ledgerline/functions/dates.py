"""Dates written as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import bound, non_blank, squeeze

# Formats tried in this order, month first before day first.
DATE_FORMATS = [
    "M/d/yyyy", "d/M/yyyy", "yyyy/M/d",
    "M-d-yyyy", "d-M-yyyy", "yyyy-M-d",
    "MMMM d, yyyy", "d MMMM yyyy",
]

# Further spellings met in free-form dates, tried after DATE_FORMATS.
FREE_FORMATS = [
    "MMMM d yyyy", "MMM d, yyyy", "MMM d yyyy", "d MMM yyyy", "d-MMM-yyyy",
    "d MMMM, yyyy", "d.M.yyyy", "yyyy.M.d", "yyyyMMdd",
    "M/d/yy", "d/M/yy", "M-d-yy", "d-M-yy", "d MMM yy", "d MMMM yy", "MMM d, yy", "MMMM d, yy",
]


def iso_date(c: Column) -> Column:
    """Date from yyyy-MM-dd text, null when it is anything else."""
    return F.try_to_date(c, "yyyy-M-d")


def day_first_date(c: Column) -> Column:
    """Date from d/M/yyyy text, null when it is anything else."""
    return F.try_to_date(c, "d/M/yyyy")


def parse_dates(df: DataFrame, columns: list[str], parser=iso_date) -> DataFrame:
    """Parse the named text columns that exist."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: parser(F.col(c)) for c in present}) if present else df


def _as_iso(text: Column, formats: list[str]) -> list[Column]:
    return [F.date_format(F.try_to_date(text, f), "yyyy-MM-dd") for f in formats]


def normalize_date(raw: Column, has_date: Column) -> Column:
    """ISO text where a known format fits, else the text as it was found.

    Text that already starts like an ISO date is kept whole.
    """
    parsed = bound(squeeze(raw), lambda text: F.coalesce(*_as_iso(text, DATE_FORMATS), raw))
    found = F.when(F.regexp_like(raw, F.lit(r"^\d{4}-\d{2}-\d{2}")), raw).otherwise(parsed)
    return F.when(F.coalesce(has_date, F.lit(False)) & non_blank(raw), found).otherwise("")


def normalize_free_date(raw: Column) -> Column:
    """As ``normalize_date`` for dates written freely: ordinals, ``3rd of May``, ``Sept``, times of day.

    Two-digit years are 2000 to 2099. A month without a day names no date and
    stays as it was written.
    """
    text = squeeze(F.btrim(raw))
    text = F.regexp_replace(text, r"(?i)\b(\d{1,2})(st|nd|rd|th)\b", "$1")
    text = F.regexp_replace(text, r"(?i)^(mon|tues?|wed(nes)?|thur?s?|fri|sat(ur)?|sun)(day)?,? ", "")
    text = F.regexp_replace(text, r"(?i)^(\d{1,2}) of ", "$1 ")
    text = F.regexp_replace(text, r"(?i)\bsept\b\.?", "Sep")
    text = F.regexp_replace(text, r"^(\d{4}-\d{1,2}-\d{1,2})[T ]\d{1,2}:\d{2}.*$", "$1")
    # Day first only where the month-first reading is impossible.
    formats = ["yyyy-M-d"] + [f for f in DATE_FORMATS if f != "yyyy-M-d"] + FREE_FORMATS
    found = bound(text, lambda t: F.coalesce(*_as_iso(t, formats), raw))
    return F.when(non_blank(raw), found).otherwise("")
