"""Page responses to page records and one markdown document per source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bound, non_blank, strip
from .responses import lower_lines, says

KINDS = ("text", "tables", "figures", "signatures")
# Note for content judged not worth parsing, rule between pages.
NOT_INFORMATIVE = "NOT_INFORMATIVE"
PAGE_RULE = "\n\n---\n\n"

ANALYSIS_KEYS = ("should_parse:", "has_text:", "has_tables:", "has_figures:", "has_signatures:")


def page_analysis(response: Column) -> Column:
    """Struct of the analysis flags; a line counts for the first key it holds."""

    def flags(found):
        return F.struct(*[
            says(found, key, ANALYSIS_KEYS[:n]).alias(key.rstrip(":")) for n, key in enumerate(ANALYSIS_KEYS)
        ])

    return bound(lower_lines(response), flags)


def with_analysis(pages: DataFrame, analysis: str = "analysis") -> DataFrame:
    flagged = pages.withColumn("_flags", page_analysis(F.col(analysis)))
    return flagged.select(*pages.columns, "_flags.*")


def required_extractors() -> Column:
    return F.array_compact(F.array(*[F.when(F.col(f"has_{k}"), F.lit(k)) for k in KINDS]))


def needs_processing() -> Column:
    any_kind = F.lit(False)
    for k in KINDS:
        any_kind = any_kind | F.col(f"has_{k}")
    return F.col("should_parse") & any_kind


def page_routing(pages: DataFrame) -> DataFrame:
    """Pages worth parsing with the extractors each one needs."""
    return pages.filter("should_parse").withColumns(
        {"extractors": required_extractors(), "needs_processing": needs_processing()}
    )


def sections(response: Column, kind: str) -> Column:
    """array<struct<id, content>> of the TABLE_n or FIGURE_n sections.

    Empty sections are dropped; of a repeated id the last content is kept.
    """
    pattern = rf"(?dms)^{kind}_\d+$.*?(?=^{kind}_\d+$|\z)"
    entries = F.transform(
        F.regexp_extract_all(response, F.lit(pattern), 0),
        lambda piece: F.struct(
            F.substring_index(piece, "\n", 1).alias("id"),
            strip(F.regexp_replace(piece, r"^[^\n]*", "")).alias("content"),
        ),
    )

    def last_of_each(filled):
        return F.transform(
            F.array_distinct(F.transform(filled, lambda e: e["id"])),
            lambda i: F.struct(
                i.alias("id"),
                F.element_at(F.filter(filled, lambda e: e["id"] == i), -1)["content"].alias("content"),
            ),
        )

    kept = bound(F.filter(entries, lambda e: e["content"] != ""), last_of_each)
    return F.coalesce(kept, F.array().cast("array<struct<id:string,content:string>>"))


def placeholder_ids(text: Column, kind: str) -> Column:
    found = F.regexp_extract_all(text, F.lit(rf"\[({kind}_\d+)\]"), 1)
    return F.coalesce(found, F.array().cast("array<string>"))


def placeholder_count(text: Column, kind: str) -> Column:
    """Occurrences of the opening of a placeholder."""
    mark = f"[{kind}_"
    removed = F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))
    return F.coalesce((removed / len(mark)).cast("bigint"), F.lit(0).cast("bigint"))


def _fill(text: Column, entries: Column, block) -> Column:
    """Replace the placeholder of each entry, literally, one after another."""
    return F.aggregate(
        entries,
        text,
        lambda t, e: F.replace(t, F.concat(F.lit("["), e["id"], F.lit("]")), block(e)),
    )


def _without_unless(kind: str, present: Column):
    """Drop the placeholders of a kind, unless the page has that kind."""
    return lambda text: F.when(present, text).otherwise(F.regexp_replace(text, rf"\[{kind}_\d+\]", ""))


def _framed(*parts: Column) -> Column:
    return F.concat(F.lit("\n\n"), *parts, F.lit("\n\n"))


def _content_block(word: str):
    def block(e):
        note = _framed(F.lit("["), e["id"], F.lit(f"] - {NOT_INFORMATIVE} {word.lower()} (not parsed)"))
        number = F.get(F.split(e["id"], "_"), 1)
        shown = _framed(F.lit(f"## {word} "), number, F.lit("\n\n"), e["content"])
        return F.when(strip(e["content"]) == NOT_INFORMATIVE, note).otherwise(shown)

    return block


def _signature_block(e):
    number = F.get(F.split(e["id"], "_"), 1)
    shown = _framed(F.lit("## Signature "), number, F.lit("\n\n"), e["content"])
    missing = _framed(F.lit("["), e["id"], F.lit("] - No signature data extracted"))
    return F.when(strip(e["content"]) != "", shown).otherwise(missing)


def squeeze_blank_lines(text: Column) -> Column:
    return F.regexp_replace(text, "\n{3,}", "\n\n")


def integrate(
    text: Column,
    tables: Column,
    figures: Column,
    signatures: Column | None = None,
    has_tables: Column | None = None,
    has_figures: Column | None = None,
    has_signatures: Column | None = None,
) -> Column:
    """Text with its placeholders replaced by the page's tables, figures and signatures.

    Placeholders of kinds the analysis did not see are removed; without an
    analysis tables and figures count as seen, signatures do not. ``signatures``
    is None when signatures stay placeholders.
    """
    out = text
    seen = {"TABLE": (has_tables, True), "FIGURE": (has_figures, True), "SIGNATURE": (has_signatures, False)}
    for kind, (flag, default) in seen.items():
        present = F.lit(default) if flag is None else flag
        out = bound(out, _without_unless(kind, present))
    out = _fill(out, tables, _content_block("Table"))
    out = _fill(out, figures, _content_block("Figure"))
    if signatures is not None:
        out = _fill(out, signatures, _signature_block)
    return F.when(non_blank(text), strip(squeeze_blank_lines(out))).otherwise("")


def signature_markdown(record) -> Column:
    """Markdown block of a signature record (a struct), null when there is no signature."""
    kinds = F.concat_ws(
        ", ",
        F.when(record["is_image_signature"], "Image signature"),
        F.when(record["is_scanned"], "Scanned signature"),
    )

    def row(label, value):
        return F.when(value != "", F.concat(F.lit(f"- **{label}:** "), value, F.lit("\n"))).otherwise("")

    return F.when(
        record["has_signature"],
        F.concat(
            F.lit("**Signature Information**\n"),
            row("Signatory", strip(F.coalesce(record["signatory_text"], F.lit("")))),
            row("Date", strip(F.coalesce(record["signature_date"], F.lit("")))),
            row("Type", kinds),
            row("Detection confidence", F.initcap(F.coalesce(record["confidence"], F.lit("low")))),
        ),
    )


def _is_parsed(pages: DataFrame) -> Column:
    parsed = F.coalesce("should_parse", F.lit(False))
    return parsed & F.col("error").isNull() if "error" in pages.columns else parsed


def page_contents(pages: DataFrame, signature_blocks: str | None = None) -> DataFrame:
    """Content of every parsed page: text, mappings and the integrated text.

    ``pages`` has analysis flags and the text, tables and figures responses.
    ``signature_blocks`` names a column of markdown blocks per page, used when
    signature data belongs in the document. Pages with an ``error`` are skipped.
    """
    return _with_contents(pages.filter(_is_parsed(pages)), signature_blocks)


def _with_contents(parsed: DataFrame, signature_blocks: str | None) -> DataFrame:
    empty = F.array().cast("array<struct<id:string,content:string>>")
    out = parsed.withColumns({
        "text_content": F.when(F.col("has_text"), F.col("text")),
        "table_mapping": F.when(F.col("has_tables"), sections(F.col("tables"), "TABLE")).otherwise(empty),
        "figure_mapping": F.when(F.col("has_figures"), sections(F.col("figures"), "FIGURE")).otherwise(empty),
    })
    signature_map = None
    if signature_blocks:
        one = F.array(F.struct(F.lit("SIGNATURE_1").alias("id"), F.col(signature_blocks).alias("content")))
        out = out.withColumn(
            "signature_mapping",
            F.when(F.col("has_signatures") & F.col(signature_blocks).isNotNull(), one).otherwise(empty),
        )
        signature_map = F.col("signature_mapping")
    else:
        out = out.withColumn("signature_mapping", empty)
    return out.withColumn(
        "integrated_content",
        integrate(
            F.col("text_content"), F.col("table_mapping"), F.col("figure_mapping"), signature_map,
            F.col("has_tables"), F.col("has_figures"), F.col("has_signatures"),
        ),
    )


def integration_check(contents: DataFrame) -> DataFrame:
    """Placeholders expected and left over per page, and the share replaced."""
    text, done = F.coalesce("text_content", F.lit("")), F.col("integrated_content")
    expected = {k: F.regexp_extract_all(text, F.lit(rf"(\[{k}_\d+\])"), 1) for k in ("TABLE", "FIGURE")}
    remaining = {k: F.regexp_extract_all(done, F.lit(rf"(\[{k}_\d+\])"), 1) for k in ("TABLE", "FIGURE")}
    total = (F.size(expected["TABLE"]) + F.size(expected["FIGURE"])).cast("bigint")
    left = (F.size(remaining["TABLE"]) + F.size(remaining["FIGURE"])).cast("bigint")

    def missing(k):
        return F.filter(expected[k], lambda p: F.array_contains(remaining[k], p))

    return contents.select(
        "source_id",
        "page_number",
        F.when(total == 0, 0.0).otherwise((total - left) / total * 100).alias("success_rate"),
        total.alias("total_placeholders"),
        left.alias("remaining_placeholders"),
        missing("TABLE").alias("missing_tables"),
        missing("FIGURE").alias("missing_figures"),
        F.transform("table_mapping", lambda e: e["id"]).alias("available_tables"),
        F.transform("figure_mapping", lambda e: e["id"]).alias("available_figures"),
    )


def _piece() -> Column:
    return F.coalesce(F.nullif("integrated_content", F.lit("")), F.nullif("text_content", F.lit("")))


def _markdown(piece: Column) -> Column:
    """Aggregate: the pieces in page order with a rule between; null pieces are left out."""
    ordered = F.array_sort(F.collect_list(F.when(piece.isNotNull(), F.struct("page_number", piece.alias("piece")))))
    joined = F.array_join(F.transform(ordered, lambda p: p["piece"]), PAGE_RULE)
    return strip(squeeze_blank_lines(joined))


def combine_pages(contents: DataFrame) -> DataFrame:
    """Pages of a source joined in order: one (source_id, markdown) per source with content.

    A document is one value, so its size is that of its own pages.
    """
    piece = _piece()
    return contents.filter(piece.isNotNull()).groupBy("source_id").agg(_markdown(piece).alias("markdown"))


def page_summary(contents: DataFrame) -> DataFrame:
    """One line per page that names what was extracted."""

    def counted(mapping, word):
        n = F.size(mapping)
        return F.when(n > 0, F.concat(n.cast("string"), F.lit(f" {word}(s)")))

    pending = F.when(
        F.col("has_signatures") & (F.size("signature_mapping") == 0), "signatures (placeholder mode)"
    )
    parts = F.concat_ws(
        ", ",
        F.when(non_blank(F.col("text_content")), "text"),
        counted("table_mapping", "table"),
        counted("figure_mapping", "figure"),
        F.coalesce(counted("signature_mapping", "signature"), pending),
    )
    found = F.when(parts == "", "no content").otherwise(parts)
    line = F.concat(F.lit("Page "), F.col("page_number").cast("string"), F.lit(": Extracted "), found)
    return contents.select("source_id", "page_number", line.alias("summary"))


def document_totals(pages: DataFrame, signature_blocks: str | None = None) -> DataFrame:
    """One row per source: totals of pages, tables, figures, placeholders and integrations, and the markdown.

    ``pages`` holds every page and is aggregated once; a page that is not
    parsed counts as skipped and gives no content.
    """
    parsed = _is_parsed(pages)

    def total(amount):
        return F.coalesce(F.sum(F.when(parsed, amount)), F.lit(0).cast("bigint"))

    placeholders = sum(placeholder_count(F.col("text_content"), kind) for kind in ("TABLE", "FIGURE"))
    sums = _with_contents(pages, signature_blocks).groupBy("source_id").agg(
        F.count("*").alias("total_pages"),
        F.count_if(parsed).alias("processed_pages"),
        F.count_if(~parsed).alias("skipped_pages"),
        total(F.size("table_mapping")).alias("total_tables"),
        total(F.size("figure_mapping")).alias("total_figures"),
        total(placeholders).alias("total_placeholders"),
        total((F.col("integrated_content") != "").cast("int")).alias("successful_integrations"),
        _markdown(F.when(parsed, _piece())).alias("final_markdown"),
    )
    return sums.withColumn("success_rate", F.col("processed_pages") / F.col("total_pages") * 100)


def document_stats(pages: DataFrame) -> DataFrame:
    """One row per source: pages, tables, figures, placeholders, integrations, rate."""
    return document_totals(pages).drop("final_markdown")


def build_documents(
    pages: DataFrame, signature_blocks: str | None = None, failed: DataFrame | None = None
) -> DataFrame:
    """Markdown and page totals, one row per source of any length.

    ``failed(source_id, error)`` lists sources that could not be read at all;
    each gives a row with no pages and the message as its text.
    """
    out = document_totals(pages, signature_blocks).select(
        "source_id", "total_pages", "processed_pages", "skipped_pages", "success_rate", "final_markdown"
    )
    if failed is None:
        return out
    zero = F.lit(0).cast("bigint")
    lost = failed.select(
        "source_id",
        *[zero.alias(c) for c in ("total_pages", "processed_pages", "skipped_pages")],
        F.lit(0.0).alias("success_rate"),
        F.concat(F.lit("Processing failed: "), "error").alias("final_markdown"),
    )
    return out.unionByName(lost)
