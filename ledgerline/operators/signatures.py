"""Page responses to signature records, and their summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import normalize_date, normalize_free_date
from ..functions.text import SPACES, bound, keep_word_chars, lines, squeeze, strip
from .responses import (
    after_colon, blocks, body_lines, first_line, graded_confidence, keyed_lines, last, last_with,
    lower_lines, number_in, says, value_of,
)

# Output columns of the consolidated table, in order.
OUTPUT_COLUMNS = [
    "Signature", "Signature_Yes_text", "Signature_Image",
    "Signature_scanned", "Presence_Signature_date", "Signature_Date",
]
# Words that mark a line as a title or a company.
TITLE_WORDS = [
    "director", "manager", "officer", "president", "ceo", "cfo",
    "secretary", "treasurer", "chairman", "vice president", "vp",
]
COMPANY_WORDS = ["ltd", "inc", "corp", "llc", "limited", "corporation"]
DATE_HINT = "[YYYY-MM-DD format if determinable]"

_GLOBAL_KEYS = ("has_signatures:", "signature_count:", "confidence:")
_BLOCK_KEYS = ("signature_type:", "is_image:", "is_scanned:", "signature_block_format:")


# --- two responses per page: detection with analysis, then extraction ---

def parse_detection(response: Column, numbered_only: bool = False) -> Column:
    """Struct of flags, count, confidence and the per-signature blocks of a detection response.

    Any line starting SIGNATURE_ with a colon opens a block, section titles
    included, so the first block of a usual response is the empty one under its
    title. ``numbered_only`` opens blocks at SIGNATURE_<n> alone.
    """
    name = r"SIGNATURE_\d+" if numbered_only else "SIGNATURE_"
    header = rf"{name}[^\n]*:)(?!(?iu:[^\n]*(?:{'|'.join(_GLOBAL_KEYS)}))"

    def fields(found):
        count = last_with(
            found, "signature_count:", _GLOBAL_KEYS[:1], also=lambda s: F.regexp_like(s, F.lit(r"\d"))
        )
        return F.struct(
            says(found, "has_signatures:").alias("has_signatures"),
            F.coalesce(number_in(count), F.lit(0)).alias("signature_count"),
            graded_confidence(found, _GLOBAL_KEYS[:2]).alias("confidence"),
            F.transform(blocks(response, header), _detection_block).alias("signatures_analysis"),
        )

    return bound(lower_lines(response), fields)


def _detection_block(block: Column) -> Column:
    def fields(body):
        def line(n):
            return last_with(body, _BLOCK_KEYS[n], _GLOBAL_KEYS + _BLOCK_KEYS[:n])

        def second_part(n, default):
            return F.coalesce(strip(F.get(F.split(line(n), ":"), 1)), F.lit(default))

        def true(n):
            return F.coalesce(F.contains(line(n), F.lit("true")), F.lit(False))

        return F.struct(
            second_part(0, "unknown").alias("signature_type"),
            true(1).alias("is_image"),
            true(2).alias("is_scanned"),
            second_part(3, "none").alias("signature_block_format"),
        )

    return bound(F.transform(body_lines(block), F.lower), fields)


def parse_extraction(response: Column) -> Column:
    """Struct of signatory texts, date entries and the date flag of an extraction response.

    Any line starting ``date_`` opens a date entry, the section title included.
    """

    def is_text(block):
        return F.startswith(F.lower(first_line(block)), F.lit("signatory_text_"))

    def kept_text(block):
        kept = F.filter(
            F.transform(body_lines(block), lambda s: F.rtrim(s, F.lit(SPACES))),
            lambda s: (s != "") & ~F.startswith(strip(s), F.lit("-")),
        )
        return F.array_join(kept, "\n")

    def fields(pieces):
        texts = F.filter(F.transform(F.filter(pieces, is_text), kept_text), lambda t: t != "")
        dates = F.transform(F.filter(pieces, lambda b: ~is_text(b)), _date_block)
        return F.struct(texts.alias("signatory_texts"), dates.alias("dates"))

    found = bound(blocks(response, r"(?iu:signatory_text_|date_)"), fields)
    return bound(
        found,
        lambda f: F.struct(
            f["signatory_texts"].alias("signatory_texts"),
            f["dates"].alias("dates"),
            F.coalesce(F.exists(f["dates"], lambda d: d["any_raw"]), F.lit(False)).alias("has_date"),
        ),
    )


_DATE_KEYS = (
    "raw_date_text:", "associated_signature:", "standardized_date:", "date_confidence:", "position_context:",
)


def _date_block(block: Column) -> Column:
    def holds(line, n):
        ok = F.contains(line["low"], F.lit(_DATE_KEYS[n]))
        for other in _DATE_KEYS[:n]:
            ok = ok & ~F.contains(line["low"], F.lit(other))
        return ok

    def fields(body):
        def value(n, default=""):
            line = last(F.filter(body, lambda s: holds(s, n)))
            return F.coalesce(after_colon(line["raw"]), F.lit(default)).alias(_DATE_KEYS[n].rstrip(":"))

        filled = F.exists(body, lambda s: holds(s, 0) & (after_colon(s["raw"]) != ""))
        return F.struct(value(0), value(1), value(2), value(3, "low"), value(4), filled.alias("any_raw"))

    both = F.transform(body_lines(block), lambda s: F.struct(s.alias("raw"), F.lower(s).alias("low")))
    return bound(both, fields)


def signature_record(detection: Column, extraction: Column) -> dict[str, Column]:
    """One record per page: texts joined, the first block's flags, the first date."""
    first = F.get(detection["signatures_analysis"], 0)
    date = F.get(extraction["dates"], 0)
    shown = F.coalesce(F.nullif(date["standardized_date"], F.lit("")), date["raw_date_text"], F.lit(""))
    return {
        "has_signature": F.lit(True),
        "signatory_text": F.coalesce(F.array_join(extraction["signatory_texts"], "\n\n"), F.lit("")),
        "is_image_signature": F.coalesce(first["is_image"], F.lit(False)),
        "is_scanned": F.coalesce(first["is_scanned"], F.lit(False)),
        "has_date": F.when(date.isNotNull(), shown != "").otherwise(extraction["has_date"]),
        "signature_date": shown,
        "confidence": detection["confidence"],
    }


def has_signatures(detection: Column) -> Column:
    """The detection response says there are signatures."""
    return says(lower_lines(detection), "has_signatures:")


def with_record(pages: DataFrame, numbered_only: bool = False) -> DataFrame:
    """Pages with their signature record as a struct column ``record``."""
    parsed = pages.withColumns({
        "_found": parse_detection(F.col("detection"), numbered_only),
        "_data": parse_extraction(F.col("extraction")),
    })
    fields = signature_record(F.col("_found"), F.col("_data"))
    record = F.struct(*[c.alias(n) for n, c in fields.items()])
    return parsed.withColumn("record", record).drop("_found", "_data")


def signature_pages(pages: DataFrame, numbered_only: bool = False) -> DataFrame:
    """Raw signature records of the pages whose detection response says there are some."""
    signed = with_record(pages.filter(has_signatures(F.col("detection"))), numbered_only)
    return signed.select(*pages.columns, "record.*")


# --- four responses per page ---

def four_prompt_record() -> dict[str, Column]:
    """Record from detection, analysis, signatory text and date responses."""
    found, shape = lower_lines(F.col("detection")), lower_lines(F.col("sig_analysis"))
    kind = last_with(shape, "signature_type:", also=lambda s: F.contains(s, F.lit("handwritten")) | F.contains(s, F.lit("typed")))
    text = F.col("sig_text")
    mark, following = "SIGNATORY_TEXT_1:", "SIGNATORY_TEXT_2:"
    tail = F.substring(text, F.instr(text, mark) + len(mark), F.length(text))
    dates = lines(F.col("sig_dates"))
    raw_key, std_key = "raw_date_text:", "standardized_date:"

    def part(line, key):
        return strip(F.get(F.split(line, key), 1))

    raws = F.filter(dates, lambda s: F.contains(s, F.lit(raw_key)))
    stds = F.filter(
        dates, lambda s: F.contains(s, F.lit(std_key)) & ~F.contains(s, F.lit(raw_key))
        & (part(s, std_key) != "") & (part(s, std_key) != DATE_HINT)
    )
    return {
        "has_signatures": says(found, "has_signatures:"),
        "has_signature": F.lit(True),
        "signatory_text": F.when(
            F.contains(text, F.lit(mark)), strip(F.substring_index(tail, following, 1))
        ).otherwise(strip(text)),
        "signature_count": F.coalesce(number_in(last_with(
            found, "signature_count:", _GLOBAL_KEYS[:1], lambda s: F.regexp_like(s, F.lit(r"\d")))), F.lit(0)),
        "signature_type": F.when(kind.isNull(), "unknown").when(F.contains(kind, F.lit("handwritten")), "handwritten").otherwise("typed"),
        "is_image_signature": says(shape, "is_image:", ("signature_type:",)),
        "is_scanned": says(shape, "is_scanned:", ("signature_type:", "is_image:")),
        "has_date": F.exists(raws, lambda s: part(s, raw_key) != ""),
        "raw_date_text": F.coalesce(part(last(raws), raw_key), F.lit("")),
        "signature_date": F.coalesce(part(last(stds), std_key), F.lit("")),
        "confidence": graded_confidence(found, _GLOBAL_KEYS[:2]),
    }


def four_prompt_signatures(pages: DataFrame) -> DataFrame:
    record = four_prompt_record()
    return pages.filter(record.pop("has_signatures")).withColumns(record)


# --- one record per signatory ---

_FIELD_KEYS = ("HAS_SIGNATURES", "SIGNATURE_COUNT", "SIGNATURE_TYPE", "IS_IMAGE", "IS_SCANNED", "CONFIDENCE")
_PERSON_KEYS = ("NAME", "TITLE", "COMPANY", "DATE")


def parse_person_detection(response: Column) -> Column:
    """Struct of the detection fields, the last line with a key deciding."""

    def whole(value):
        return F.regexp_like(value, F.lit(r"^[+-]?\d+$"))

    def fields(entries):
        def text(n, default):
            return F.coalesce(F.lower(value_of(entries, _FIELD_KEYS, n)), F.lit(default))

        def yes(n):
            return F.contains(text(n, ""), F.lit("yes"))

        count = F.coalesce(value_of(entries, _FIELD_KEYS, 1, whole).try_cast("int"), F.lit(0))
        return F.struct(
            yes(0).alias("has_signatures"),
            count.alias("signature_count"),
            text(2, "unknown").alias("signature_type"),
            yes(3).alias("is_image"),
            yes(4).alias("is_scanned"),
            text(5, "low").alias("confidence"),
        )

    return bound(keyed_lines(lines(response)), fields)


def parse_persons(response: Column) -> Column:
    """array<struct<name, title, company, date>>, empty when none were found."""

    def person(block):
        return bound(keyed_lines(body_lines(block)), lambda entries: F.struct(*[
            F.coalesce(value_of(entries, _PERSON_KEYS, n), F.lit("")).alias(key.lower())
            for n, key in enumerate(_PERSON_KEYS)
        ]))

    people = F.transform(blocks(response, "SIGNATORY_"), person)
    none = F.array().cast("array<struct<name:string,title:string,company:string,date:string>>")
    return F.when(F.contains(response, F.lit("NO_SIGNATURES_FOUND")), none).otherwise(F.coalesce(people, none))


def yes_no(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit(False)), "Yes").otherwise("No")


def joined_parts(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[F.nullif(p, F.lit("")) for p in parts])


def person_records(pages: DataFrame) -> DataFrame:
    """One record per signatory; a source whose first page has none gets one "No" record."""
    flags = ["has_signatures", "is_image", "is_scanned", "confidence"]
    parsed = pages.select(
        "source_id", "page_number", parse_persons(F.col("extraction")).alias("people"),
        parse_person_detection(F.col("detection")).alias("found"),
    )
    base = parsed.select("source_id", "page_number", "people", *[F.col(f"found.{f}") for f in flags])
    people = F.transform(
        "people",
        lambda p: F.struct(
            F.lit("Yes").alias("Signature"),
            joined_parts(p["name"], p["title"], p["company"]).alias("Signature_Yes_text"),
            yes_no(F.col("is_image")).alias("Signature_Image"),
            yes_no(F.col("is_scanned")).alias("Signature_scanned"),
            yes_no(p["date"] != "").alias("Presence_Signature_date"),
            normalize_free_date(p["date"]).alias("Signature_Date"),
            F.col("confidence").alias("confidence"),
        ),
    )
    blank = F.struct(*[
        F.lit(v).alias(c) for c, v in
        zip(OUTPUT_COLUMNS + ["confidence"], ["No", "", "No", "No", "No", "", "N/A"])
    ])
    rows = F.when(F.col("has_signatures"), people).when(F.col("page_number") == 1, F.array(blank))
    return base.select("source_id", "page_number", F.inline(rows))


# --- output records ---

def clean_signatory(c: Column) -> Column:
    """One line of word characters and plain punctuation; null gives ''."""
    return F.coalesce(keep_word_chars(squeeze(strip(c)), r".,\-()/"), F.lit(""))


def signatory_parts(text: Column) -> dict[str, Column]:
    """Name, title and company guesses from cleaned one-line text."""
    words = F.split(text, " ")
    capital = F.forall(words, lambda w: F.regexp_like(w, F.lit(r"^\p{Lu}")))
    name = F.when((F.size(words) >= 2) & (F.size(words) <= 4) & capital, text).otherwise("")
    low = F.lower(text)
    title = F.when(F.regexp_like(low, F.lit("|".join(TITLE_WORDS))), low).otherwise("")
    company = F.when(F.regexp_like(low, F.lit("|".join(COMPANY_WORDS))), text).otherwise("")
    return {"name": name, "title": title, "company": company}


def output_records(raw: DataFrame, parts: bool = False) -> DataFrame:
    """Raw signatures in the output columns; ``parts`` shows name | title | company."""
    text = clean_signatory(F.col("signatory_text"))
    if parts:
        guess = signatory_parts(F.col("_text"))
        text_out = joined_parts(guess["name"], guess["title"], guess["company"])
    else:
        text_out = F.col("_text")
    return raw.withColumn("_text", text).select(
        yes_no(F.col("has_signature")).alias("Signature"),
        text_out.alias("Signature_Yes_text"),
        yes_no(F.col("is_image_signature")).alias("Signature_Image"),
        yes_no(F.col("is_scanned")).alias("Signature_scanned"),
        yes_no(F.col("has_date")).alias("Presence_Signature_date"),
        normalize_date(F.col("signature_date"), F.col("has_date")).alias("Signature_Date"),
        F.coalesce("source_id", F.lit("")).alias("source_id"),
        F.coalesce(F.col("page_number").cast("bigint"), F.lit(0).cast("bigint")).alias("page_number"),
        F.coalesce("confidence", F.lit("low")).alias("confidence"),
    )


def error_records(failed: DataFrame, prefix: str = "Processing Error: ") -> DataFrame:
    """An output record for each (source_id, page_number, error)."""
    page = F.col("page_number").cast("bigint") if "page_number" in failed.columns else F.lit(0).cast("bigint")
    return failed.select(
        F.lit("Error").alias("Signature"),
        F.concat(F.lit(prefix), "error").alias("Signature_Yes_text"),
        *[F.lit("No").alias(c) for c in OUTPUT_COLUMNS[2:5]],
        F.lit("").alias("Signature_Date"),
        "source_id",
        F.coalesce(page, F.lit(0).cast("bigint")).alias("page_number"),
        F.lit("error").alias("confidence"),
    )


def consolidated(records: DataFrame) -> DataFrame:
    """Required columns first, '' where the records lack one, then the others."""
    have = records.columns
    first = [F.col(c) if c in have else F.lit("").alias(c) for c in OUTPUT_COLUMNS]
    return records.select(*first, *[c for c in have if c not in OUTPUT_COLUMNS])


def stamped(records: DataFrame, timestamp: str) -> DataFrame:
    """Records with the processing time, given by the caller so that runs repeat."""
    return records.withColumn("processing_timestamp", F.lit(timestamp))


def source_summary(records: DataFrame, sources: DataFrame | None = None) -> DataFrame:
    """Totals per source; ``sources`` adds those that gave no record.

    Pages are counted over (source, page) pairs first, so that one large source
    is spread over its pages until only counts are left.
    """
    yes = lambda c: F.count_if(F.col(c) == "Yes")
    per_page = records.groupBy("source_id", "page_number").agg(
        F.count("*").alias("total"),
        yes("Signature_Image").alias("image"),
        yes("Signature_scanned").alias("scanned"),
        yes("Presence_Signature_date").alias("dated"),
        F.max((F.col("Signature") == "Yes").cast("int")).alias("signed"),
    )
    out = per_page.groupBy("source_id").agg(
        F.sum("total").alias("total_signatures"),
        F.sum("image").alias("image_signatures"),
        F.sum("scanned").alias("scanned_signatures"),
        F.sum("dated").alias("signatures_with_dates"),
        F.sum("signed").alias("pages_with_signatures"),
    )
    if sources is None:
        return out
    counts = [c for c in out.columns if c != "source_id"]
    every = sources.select("source_id").distinct().join(out, "source_id", "left")
    return every.fillna(0, counts)


def corpus_summary(records: DataFrame, sources: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Sources, successes, signatures and sources with a signature, in one row."""
    per_source = records.groupBy("source_id").agg(
        F.count("*").alias("n"), F.max((F.col("Signature") == "Yes").cast("int")).alias("signed")
    )
    every = sources.select("source_id").distinct().join(per_source, "source_id", "left")
    lost = F.lit(False)
    if failed is not None:
        bad = failed.select("source_id").distinct().withColumn("lost", F.lit(True))
        every = every.join(bad, "source_id", "left")
        lost = F.coalesce("lost", F.lit(False))
    return every.agg(
        F.count("*").alias("total_sources"),
        F.count_if(~lost).alias("successful_sources"),
        F.coalesce(F.sum(F.when(~lost, F.col("n"))), F.lit(0)).alias("total_signatures"),
        F.count_if(~lost & (F.col("signed") == 1)).alias("sources_with_signatures"),
    )


def detection_summary(picked: DataFrame) -> DataFrame:
    """Boxes and distinct pages per source."""
    per_page = picked.groupBy("source_id", "page_number").agg(F.count("*").alias("n"))
    return per_page.groupBy("source_id").agg(
        F.sum("n").alias("signatures_found"), F.count("*").alias("pages_processed")
    )


def detection_totals(picked: DataFrame, sources: DataFrame, key: str = "source_id") -> DataFrame:
    """All sources, also those without a picked box, and the picked boxes of the whole run."""
    return sources.agg(F.count_distinct(key).alias("total_pdfs")).crossJoin(
        picked.agg(F.count("*").alias("total_signatures")))
