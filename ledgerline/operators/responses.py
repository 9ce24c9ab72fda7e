"""Model responses per page: line rules shared by documents and signatures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import lines, strip

# Splits a response before each header line; not a character models write.
MARK = "\x01"


PAGE = ["source_id", "page_number"]


def _answer(value: Column, order: str | None) -> tuple[Column, Column]:
    """Aggregates: the answer that counts, and whether answers differ without an order to choose by.

    Nulls are no answers. With ``order`` the greatest one's answer counts, the greater text among equals.
    """
    if order:
        best = F.max(F.when(value.isNotNull(), F.struct(F.col(order), value.alias("answer"))))
        return best["answer"], F.lit(False)
    least, greatest = F.min(value), F.max(value)
    return F.when(least == greatest, least), F.coalesce(least != greatest, F.lit(False))


def _conflict(flags: dict[str, Column]) -> Column:
    """Text that names the kinds whose answers differ; null without any."""
    kinds = F.concat_ws(", ", *[F.when(flag, F.lit(kind)) for kind, flag in flags.items()])
    return F.when(kinds != "", F.concat(F.lit("several different answers: "), kinds))


def pages_wide(responses: DataFrame, kinds: list[str], order: str | None = None) -> DataFrame:
    """One row per page with a column per kind of response, from one partial aggregate.

    A page is asked once per kind, yet an answer may arrive more than once. ``order`` names the column, such as an
    arrival number, whose greatest value decides. Without it equal answers count once, and a page whose answers differ
    is an error row: these answers are null and a column ``error`` names their kinds.
    """
    found = {k: _answer(F.when(F.col("kind") == k, F.col("response")), order) for k in kinds}
    error = [] if order else [_conflict({k: clash for k, (_, clash) in found.items()}).alias("error")]
    return responses.groupBy(*PAGE).agg(*[answer.alias(k) for k, (answer, _) in found.items()], *error)


def sound_pages(wide: DataFrame) -> DataFrame:
    """The pages whose answers agree, without the ``error`` column."""
    return wide.filter(F.col("error").isNull()).drop("error")


def pair_pages(first: DataFrame, second: DataFrame, names: tuple[str, str] = ("detection", "extraction"),
               order: str | None = None) -> DataFrame:
    """The responses of two tables (source_id, page_number, response) side by side, one row per page.

    A page that only one table holds stays, with null for the other's response. Each table is cut to one answer per
    page first, as in ``pages_wide``, so pages never multiply; without ``order`` a column ``error`` tells of answers that differ.
    """

    def single(df, name):
        answer, clash = _answer(F.col("response"), order)
        return df.groupBy(*PAGE).agg(answer.alias(name), clash.alias(f"_{name}"))

    pairs = single(first, names[0]).join(single(second, names[1]), PAGE, "full_outer")
    error = [] if order else [_conflict({n: F.coalesce(F.col(f"_{n}"), F.lit(False)) for n in names}).alias("error")]
    return pairs.select(*PAGE, *names, *error)


def unpaired_pages(pairs: DataFrame, names: tuple[str, str] = ("detection", "extraction")) -> DataFrame:
    """(source_id, page_number, error) of the pages that cannot be read as a pair."""
    missing = F.concat_ws(" and ", *[F.when(F.col(n).isNull(), F.lit(f"no {n} response")) for n in names])
    known = [F.col("error")] if "error" in pairs.columns else []
    error = F.coalesce(*known, F.nullif(missing, F.lit("")))
    return pairs.select(*PAGE, error.alias("error")).filter(F.col("error").isNotNull())


def lower_lines(response: Column) -> Column:
    return lines(F.lower(response))


def last(items: Column) -> Column:
    return F.get(items, F.size(items) - 1)


def last_with(items: Column, key: str, before: tuple[str, ...] = (), also=None) -> Column:
    """Last line that holds ``key`` and none of the keys tested before it."""

    def test(line):
        ok = F.contains(line, F.lit(key))
        for other in before:
            ok = ok & ~F.contains(line, F.lit(other))
        return ok if also is None else ok & also(line)

    return last(F.filter(items, test))


def says(items: Column, key: str, before: tuple[str, ...] = (), word: str = "true") -> Column:
    """The last line with the key says ``word``; false without such a line."""
    return F.coalesce(F.contains(last_with(items, key, before), F.lit(word)), F.lit(False))


def keyed_lines(items: Column) -> Column:
    """array<struct<key, value>> of the lines with a colon, split at the first one; keys upper case."""
    with_colon = F.filter(items, lambda s: F.contains(s, F.lit(":")))
    return F.transform(
        with_colon,
        lambda s: F.struct(F.upper(F.substring_index(s, ":", 1)).alias("key"), after_colon(s).alias("value")),
    )


def value_of(entries: Column, keys: tuple[str, ...], n: int, also=None) -> Column:
    """Value of the last entry whose key holds keys[n] and none of the keys before it."""

    def test(entry):
        ok = F.contains(entry["key"], F.lit(keys[n]))
        for other in keys[:n]:
            ok = ok & ~F.contains(entry["key"], F.lit(other))
        return ok if also is None else ok & also(entry["value"])

    return last(F.filter(entries, test))["value"]


def after_colon(line: Column) -> Column:
    """Stripped text after the first colon."""
    return strip(F.substring(line, F.instr(line, ":") + 1, F.length(line)))


def number_in(line: Column) -> Column:
    return F.nullif(F.regexp_extract(line, r"(\d+)", 1), F.lit("")).try_cast("int")


def graded_confidence(items: Column, before: tuple[str, ...]) -> Column:
    """high or medium from the last line that names one, else low."""
    line = last_with(
        items, "confidence:", before,
        also=lambda s: F.contains(s, F.lit("high")) | F.contains(s, F.lit("medium")),
    )
    return F.when(line.isNull(), "low").when(F.contains(line, F.lit("high")), "high").otherwise("medium")


def blocks(response: Column, header: str) -> Column:
    """Text pieces that start at a header line; text before the first one is dropped."""
    safe = F.translate(response, MARK, " ")
    pieces = F.split(F.regexp_replace(safe, rf"(?dmU)^[^\S\n]*(?={header})", MARK), MARK)
    return F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0)))


def first_line(block: Column) -> Column:
    return F.substring_index(block, "\n", 1)


def body_lines(block: Column) -> Column:
    """Lines of a block after its header line."""
    all_lines = lines(block)
    return F.slice(all_lines, 2, F.greatest(F.size(all_lines) - 1, F.lit(0)))
