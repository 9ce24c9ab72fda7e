"""Signers named in plain page text (Spanish and English).

The lines of a page stay one array, so neighbouring lines are reached without a
window: no shuffle, and a page never has to be gathered again. Only lines that
hold a keyword carry their context on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import WORD, any_of, bound, non_blank

# Words around signatures, words that hint at a role, and how a
# name and a role line look.
SIGNATURE_WORDS = [
    "firma", "firmas", "firmó", "firmante",
    "suscribe", "suscrito", "suscrita",
    "signed", "signature", "signatory",
    "firma del", "firma de", "firmado por",
]
ROLE_HINTS = [
    "cargo", "posición", "puesto", "título", "role", "position", "title",
    "representante legal", "apoderado", "gerente", "director", "presidente",
    "secretario", "tesorero", "alcalde", "rector", "síndico", "abogado",
    "jefe", "coordinador", "líder", "manager", "chief", "officer",
]
ROLE_LABELS = ["cargo", "posición", "puesto", "título", "role", "position", "title"]
NAME_WORD = "(?:[A-ZÁÉÍÓÚÑ][a-záéíóúñ]+|[A-ZÁÉÍÓÚÑ]{2,})"

BREAKS = "\r\x0b\f\x1c\x1d\x1e\x85\u2028\u2029"
# Spaces other than U+0020 and tab, and bullets, which read as spaces.
GAPS = "\x1f\u00a0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u202f\u205f\u3000•·●"
# Most text has none of these characters, so one look saves replacing them all.
UNUSUAL = "[\\x0b-\\x1f\\x85\\u00a0\\u00b7\\u1680-\\u3000]"
SIGNATURE_LINE = rf"(?<![{WORD}])(?:{'|'.join(SIGNATURE_WORDS)})(?![{WORD}])"
# The look-ahead rules out most positions before the slower look-behind runs.
NAME = rf"(?=[A-ZÁÉÍÓÚÑ])(?<![{WORD}])({NAME_WORD}(?: {NAME_WORD}){{1,3}})(?![{WORD}])"
ROLE_LINE = rf"(?iu)(?:{'|'.join(ROLE_LABELS)}) *[:\-–] *(.+)$"
REACH = 5

# Cheap tests before the patterns: a line that holds none of these cannot match.
SIGNATURE_STEMS = ["firm", "suscri", "sign"]
PAGE_STEMS = SIGNATURE_STEMS + sorted({h.split()[0] for h in ROLE_HINTS})


def _plain(text: Column) -> Column:
    """Text whose line breaks are all newlines and whose gaps are single spaces."""
    full = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    for chars, to in ((BREAKS, "\n"), (GAPS, " ")):
        for char in chars:
            full = F.replace(full, F.lit(char), F.lit(to))
    usual = F.when(F.regexp_like(text, F.lit(UNUSUAL)), full).otherwise(text)
    return F.regexp_replace(usual, "[ \\t]{2,}|\\t", " ")


def clean_line(c: Column) -> Column:
    return F.trim(_plain(c))


def clean_lines(text: Column) -> Column:
    """Non-empty lines of a page without bullets and repeated spaces."""
    return F.filter(F.transform(F.split(_plain(text), "\n"), lambda s: F.trim(s)), lambda s: s != "")


def context(all_lines: Column, i: Column, reach: int = REACH) -> Column:
    """The lines from ``reach`` before position i to ``reach`` after it."""
    start = F.greatest(i - reach, F.lit(0))
    return F.slice(all_lines, start + 1, i + reach + 1 - start)


def line_context(pages: DataFrame, keys: list[str], text: str = "text") -> DataFrame:
    """Every non-empty line with the lines around it."""
    with_lines = pages.select(*keys, clean_lines(F.col(text)).alias("_lines"))
    rows = F.transform(
        "_lines",
        lambda s, i: F.struct(
            i.cast("bigint").alias("line_no"),
            s.alias("line"),
            F.array_join(context(F.col("_lines"), i), "\n").alias("context"),
        ),
    )
    return with_lines.select(*keys, F.inline(rows))


def _name_in(items: Column) -> Column:
    """First name in the first line that holds one."""
    return F.get(F.filter(F.transform(items, lambda s: F.regexp_extract(s, NAME, 1)), lambda n: n != ""), 0)


def _role_in(items: Column) -> Column:
    """Text after the first role label."""
    line = F.get(
        F.filter(items, lambda s: any_of(F.lower(s), ROLE_LABELS) & F.regexp_like(s, F.lit(ROLE_LINE))), 0
    )
    return F.when(line.isNotNull(), clean_line(F.regexp_extract(line, ROLE_LINE, 1)))


def _candidates(all_lines: Column) -> Column:
    """Keyword and role-hint lines with the lines each may draw on."""

    def marked(s, i):
        def kinds(low):
            signed = any_of(low, SIGNATURE_STEMS) & F.regexp_like(low, F.lit(SIGNATURE_LINE))
            return F.struct(signed.alias("signed"), any_of(low, ROLE_HINTS).alias("hinted"))

        found = bound(F.lower(s), kinds)
        return F.struct(i.alias("line_no"), s.alias("line"), found.alias("found"))

    wanted = F.filter(
        F.transform(all_lines, marked), lambda e: e["found"]["signed"] | e["found"]["hinted"]
    )
    return F.transform(
        wanted,
        lambda e: F.struct(
            e["line_no"].cast("bigint").alias("line_no"),
            e["line"].alias("line"),
            e["found"]["signed"].alias("signed"),
            F.when(e["found"]["signed"], context(all_lines, e["line_no"]))
            .otherwise(F.array(e["line"])).alias("around"),
        ),
    )


def _hits(all_lines: Column) -> Column:
    """array<struct<line_no, name, role, context>> of the lines that name someone, each (name, role) once."""

    def hit(e):
        own = F.array(e["line"])
        return F.struct(
            e["line_no"].alias("line_no"),
            F.coalesce(_name_in(own), _name_in(e["around"])).alias("name"),
            _role_in(e["around"]).alias("role"),
            F.array_join(e["around"], "\n").alias("context"),
            e["signed"].alias("signed"),
            F.startswith(F.lower(e["line"]), F.lit("firma:")).alias("label_only"),
        )

    def useful(h):
        near = (non_blank(h["name"]) | non_blank(h["role"])) & ~h["label_only"]
        return F.when(h["signed"], near).otherwise(h["name"].isNotNull() | h["role"].isNotNull())

    def first_of_each(found):
        def signer(h):
            return F.struct(h["name"], h["role"])

        return bound(
            F.transform(found, signer),
            lambda all_signers: F.filter(found, lambda h, i: F.array_position(all_signers, signer(h)) == i + 1),
        )

    return bound(F.filter(F.transform(_candidates(all_lines), hit), useful), first_of_each)


def _found(pages: DataFrame, keys: list[str], text: str, outer: bool) -> DataFrame:
    # Pages without any of the words are not cut into lines at all.
    wanted = F.when(any_of(F.lower(text), PAGE_STEMS), clean_lines(F.col(text)))
    listed = pages.select(
        *keys, F.length(text).cast("bigint").alias("raw_text_len"), wanted.alias("_lines")
    )
    explode = F.inline_outer if outer else F.inline
    return listed.select(*keys, "raw_text_len", explode(_hits(F.col("_lines")))).drop("signed", "label_only")


def signer_hits(pages: DataFrame, keys: list[str], text: str = "text", source: str = "pdf_text") -> DataFrame:
    """Names and roles near signature words, each (name, role) once per page."""
    return _found(pages, keys, text, outer=False).withColumn("source", F.lit(source)).drop("raw_text_len")


def signer_rows(pages: DataFrame, keys: list[str], text: str = "text", source: str = "pdf_text") -> DataFrame:
    """The hits of every page, and one empty row for a page without any."""
    return _found(pages, keys, text, outer=True).withColumn("source", F.lit(source)).drop("line_no")
