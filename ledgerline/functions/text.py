"""Text helpers whose rules differ from Spark's defaults."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every Unicode space; Spark's trim() alone removes U+0020 only.
SPACES = "".join(chr(i) for i in range(0x3001) if chr(i).isspace())

# A word character is a letter, a number or an underscore in any script.
WORD = r"\p{L}\p{N}_"


def strip(c: Column) -> Column:
    return F.btrim(c, F.lit(SPACES))


def squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+", " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def non_blank(c: Column) -> Column:
    """True when there is at least one character; null counts as blank."""
    return F.coalesce(c != "", F.lit(False))


def replace_first(c: Column, old: str, new: str) -> Column:
    return F.regexp_replace(c, "(?s)^(.*?)" + re.escape(old), "$1" + new)


def keep_word_chars(c: Column, also: str = "") -> Column:
    """Drop everything except word characters, spaces and ``also``."""
    return F.regexp_replace(c, rf"(?U)[^{WORD}\s{also}]", "")


def lines(c: Column) -> Column:
    return F.split(c, "\n")


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def any_of(c: Column, parts: list[str]) -> Column:
    """True when the text holds one of the parts."""

    def test(text):
        found = F.contains(text, F.lit(parts[0]))
        for part in parts[1:]:
            found = found | F.contains(text, F.lit(part))
        return found

    return bound(c, test)


def first_match(c: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, null (not '') when nothing matches."""
    return F.when(F.regexp_like(c, F.lit(pattern)), F.regexp_extract(c, pattern, group))


def clean_columns(df, columns, upper=(), lower=(), whole_numbers=()):
    """Strip text columns, fix their case and read whole numbers, in one projection.

    Columns the table lacks are skipped; text that is no number becomes null.
    """
    have = set(df.columns)
    new = {}
    for name in columns:
        if name in have:
            new[name] = strip(F.col(name).cast("string"))
    for name in upper:
        if name in have:
            new[name] = strip(F.upper(F.col(name)))
    for name in lower:
        if name in have:
            new[name] = strip(F.lower(F.col(name)))
    for name in whole_numbers:
        if name in have:
            new[name] = F.col(name).try_cast("bigint")
    return df.withColumns(new) if new else df
