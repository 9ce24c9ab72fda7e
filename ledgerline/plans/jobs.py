"""Whole jobs: inputs in, tables or folders out.

A profile is read by several reports, so a job writes it once and the reports
start from the written table; a lost executor then costs a re-read, not a
re-run of the joins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import documents, html, pages, report, responses, schema, signatures
from ..sources import sinks
from ..streaming import result_log
from .profiles import build_profiles

# What identifies an entity and a statement in each country's standard profile.
KEYS = {
    "australia": ("abn", "statement_group_id"),
    "canada": ("organization_name", "organization_name"),
    "uk": ("company_number", "company_number"),
}
# Columns whose distribution a country's report shows.
DISTRIBUTIONS = {
    "australia": ["join_method"],
    "canada": ["province_state", "industry_sectors"],
    "uk": ["compliance_score", "company_status", "business_sector"],
}
# Score columns whose mean a report shows.
SCORES = {"canada": ["data_completeness_score"], "uk": ["compliance_score"]}


def _long(df: DataFrame, section: str) -> DataFrame:
    """A one-row table as (section, name, value) rows."""
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in df.columns])
    return wide.unpivot([], wide.columns, "name", "value").select(F.lit(section).alias("section"), "name", "value")


def quality_report(profile: DataFrame, country: str) -> DataFrame:
    """Every figure of a country's report as (section, name, value) rows.

    Pass a profile that was read back from storage: each section reads it.
    """
    entity, statement = KEYS[country]
    parts = [
        _long(report.basic_counts(profile, entity, statement), "basic"),
        report.completeness(profile, digits=1).select(
            F.lit("completeness").alias("section"), F.col("field").alias("name"), F.col("completeness").alias("value")),
    ]
    counted = report.distributions(profile, DISTRIBUTIONS[country])
    parts.append(counted.select(
        F.concat(F.lit("distribution."), "field").alias("section"),
        F.coalesce("value", F.lit("NO_MATCH")).alias("name"), F.col("count").cast("double").alias("value")))
    if country in SCORES:
        parts.append(_long(report.mean_scores(profile, SCORES[country]), "average"))
    if country == "australia":
        parts.append(_long(report.entity_structure(profile), "entities"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _summary_rows(profile: DataFrame, country: str) -> DataFrame:
    entity, statement = KEYS[country]
    fields = [f for f in report.KEY_FIELDS if f in profile.columns]
    return profile.select(
        *[F.col(f).cast("string").alias(f) for f in fields],
        "data_country",
        F.col(entity).cast("string").alias("entity_key"),
        F.col(statement).cast("string").alias("statement_key"),
        F.col("company_name").isNotNull().alias("is_matched"),
    )


def run_profiles(
    spark: SparkSession,
    inputs: dict[str, tuple[DataFrame, DataFrame]],
    output: str,
    current_year: int,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Build, write and report the profile of each country; the summary is returned.

    ``inputs`` maps a country to its statements and registry. Written are
    profiles/<country> (Parquet), reports/<country> and summary (JSON).
    """
    rows, fields = [], {}
    for country, (statements, registry) in inputs.items():
        path = f"{output}/profiles/{country}"
        build_profiles(statements, registry, country, current_year, tiebreak).write.mode("overwrite").parquet(path)
        profile = spark.read.parquet(path)
        sinks.write_json(quality_report(profile, country), f"{output}/reports/{country}")
        rows.append(_summary_rows(profile, country))
        fields[country] = [f for f in report.KEY_FIELDS if f in profile.columns]
    summary = report.country_summary(schema.align_union(*rows), fields=fields)
    sinks.write_json(summary, f"{output}/summary")
    return spark.read.json(f"{output}/summary")


def combined_profiles(spark: SparkSession, output: str, countries: list[str]) -> DataFrame:
    """The written profiles of several countries as one aligned table."""
    return schema.align_union(*[spark.read.parquet(f"{output}/profiles/{c}") for c in countries])


def extract_records(found: DataFrame, jurisdiction: str, country: str | None = None) -> DataFrame:
    """Records of a table of pages (page_id, url, html), optionally of one detected country."""
    if jurisdiction == "canadian":
        return pages.country_filter(pages.page_records(html.parse_pages(found), "CA"), country)
    if jurisdiction == "australian":
        elements = html.parse_pages(found, wanted=pages.needs("register_pdf_url"))
        urls = elements.select("page_id", "url", pages.register_pdf_url().alias("pdf_url"))
        return pages.clean_records(urls, ["pdf_url"], "url", "AU")
    raise ValueError(f"unsupported jurisdiction: {jurisdiction}")


def crawl_to_log(stream: DataFrame, path: str, jurisdiction: str = "canadian", country: str | None = None,
                 records: Callable[[DataFrame, str, str | None], DataFrame] = extract_records) -> None:
    """Records of a stream of pages, optionally of one detected country, appended to the result log as they come.

    Parsing, extraction, the country filter and the log are one streaming plan without state; a restart goes on from
    the checkpoint beside the log, so that a page is logged once.
    """
    result_log.append_log(result_log.log_lines(records(stream, jurisdiction, country), ["page_id"]), path)


DOCUMENT_KINDS = ["analysis", "text", "tables", "figures", "detection", "extraction"]


def build_documents(answers: DataFrame, with_signatures: bool = False, order: str | None = None) -> DataFrame:
    """Markdown and page totals per source from (source_id, page_number, kind, response).

    ``order`` decides between answers that came twice; without it a page whose answers differ is skipped.
    """
    wide = documents.with_analysis(responses.pages_wide(answers, DOCUMENT_KINDS, order))
    if not with_signatures:
        return documents.build_documents(wide)
    block = F.when(
        signatures.has_signatures(F.col("detection")), documents.signature_markdown(F.col("record")))
    marked = signatures.with_record(wide).withColumn("signature_block", block)
    return documents.build_documents(marked, "signature_block")


def build_signatures(answers: DataFrame, parts: bool = False, order: str | None = None) -> DataFrame:
    """Signature records from (source_id, page_number, kind, response).

    ``order`` decides between answers that came twice; without it a page whose answers differ gives an error record.
    """
    wide = responses.pages_wide(answers, ["detection", "extraction"], order)
    if order:
        return signatures.output_records(signatures.signature_pages(wide), parts)
    records = signatures.output_records(signatures.signature_pages(responses.sound_pages(wide)), parts)
    return records.unionByName(signatures.error_records(wide.filter(F.col("error").isNotNull())))


def build_person_signatures(detections: DataFrame, extractions: DataFrame, order: str | None = None) -> DataFrame:
    """One record per signatory from two response tables, and an error record per page that cannot be paired."""
    pairs = responses.pair_pages(detections, extractions, order=order)
    records = signatures.person_records(pairs)
    lost = signatures.error_records(responses.unpaired_pages(pairs))
    return records.unionByName(lost.withColumn("page_number", F.col("page_number").cast("int")))
