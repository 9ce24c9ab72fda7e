"""One runnable query per operator, each over whole tables of a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, measures, names, text, urls
from ..operators import (
    documents, expand, html, joins, pages, report, responses, schema, selection, signatures, signers,
)
from ..session import shared_dir
from ..sources import pdf_lists, register, sinks, tables
from ..streaming import result_log
from . import jobs, profiles
from .inputs import load, spread, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The year that recency counts from; a fixed parameter, so that results repeat.
CURRENT_YEAR = 2025
# The unique column that orders statements.
SEQ = ["statement_seq"]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _joined(c: str, sep: str = "|"):
    return F.array_join(F.col(c), sep).alias(c)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- sources ---

@query
def scan_glob(spark, folder):
    """Files of one pattern, read as one table; the second file lacks some columns."""
    path = _scratch(spark, "scan_glob")
    rows = load(spark, folder, "au_statements").drop("statement_seq")
    sinks.write_csv(rows, f"{path}/au_1.csv")
    sinks.write_csv(rows.drop("annual_revenue", "pdf_url"), f"{path}/au_2.csv")
    return tables.read_au_statements(spark, path)


@query
def scan_csv_permissive(spark, folder):
    path = _scratch(spark, "scan_csv")
    sinks.write_csv(load(spark, folder, "uk_statements"), f"{path}/StatementSummaries1.csv")
    return profiles.uk_clean_statements(tables.read_uk_statements(spark, path)).select(
        "CompanyNumber", F.col("StatementYear"), "Turnover", "Risk1"
    )


@query
def scan_tsv_ragged(spark, folder):
    """Tab-separated lines with one field too many or too few."""
    path = _scratch(spark, "scan_tsv")
    header = "Company Name\tABN \t Status"
    line = F.concat_ws(
        "\t", "c_name", F.col("c_custkey").cast("string"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")),
        F.when(F.col("c_custkey") % 3 == 1, F.lit("extra")),
    )
    # The header is repeated as the first line of every file.
    rows = table(spark, folder, "customer").select(line.alias(header))
    rows.write.option("header", True).option("quote", "").option("sep", "\x01").csv(f"{path}/registry.tsv")
    return tables.read_au_registry(spark, f"{path}/registry.tsv")


@query
def scan_uk_registry(spark, folder):
    """A registry file with dots in its header, one row a line, read in splits."""
    path = _scratch(spark, "scan_uk_registry")
    rows = load(spark, folder, "uk_registry")
    sinks.write_csv(rows.toDF(*[c.replace("RegAddress_", "RegAddress.").replace("Mortgages_", "Mortgages.") for c in rows.columns]), path)
    return tables.read_uk_registry(spark, path)


@query
def scan_ca_registry(spark, folder):
    path = _scratch(spark, "scan_ca_registry")
    sinks.write_csv(load(spark, folder, "ca_registry"), path)
    return tables.read_ca_registry(spark, path)


@query
def union_relaxed(spark, folder):
    """A whole-number key beside a text key of the same name."""
    numbers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"))
    words = table(spark, folder, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("key"), F.col("c_name").alias("name"))
    return tables.union_relaxed(numbers, words)


@query
def clean_names(spark, folder):
    dirty = table(spark, folder, "part").toDF(*[f" {c} " for c in table(spark, folder, "part").columns])
    return schema.clean_names(dirty)


@query
def select_existing(spark, folder):
    wanted = ["o_custkey", "not_there", "o_orderkey", "o_orderstatus"]
    return schema.select_existing(table(spark, folder, "orders"), wanted)


@query
def register_rows(spark, folder):
    return register.register_records(load(spark, folder, "register"), "Australia")


@query
def pdf_sources_csv(spark, folder):
    """A written CSV list, numbered by its lines."""
    path = _scratch(spark, "pdf_list")
    sinks.write_csv(load(spark, folder, "urls").select(F.col("value").alias("pdf_url"), "document_name"), path)
    return pdf_lists.read_csv_sources(spark, path)


@query
def pdf_sources_dir(spark, folder):
    """A listing of PDF files, numbered in path order."""
    listing = table(spark, folder, "customer").select(
        F.concat(F.lit("/data/in/"), F.lower("c_mktsegment"), F.lit("/"), "c_name", F.lit(".v1.pdf")).alias("path"),
        F.col("c_custkey").alias("length"),
    )
    return pdf_lists.directory_sources(pdf_lists.numbered(listing, "path"), "/data/in")


@query
def pdf_sources_urls(spark, folder):
    """A written text list, numbered by its lines that hold a URL."""
    path = _scratch(spark, "url_list")
    load(spark, folder, "urls").select("value").write.text(path)
    return pdf_lists.read_url_sources(spark, path)


@query
def url_validation(spark, folder):
    return pdf_lists.invalid_urls(pdf_lists.listed_urls(load(spark, folder, "urls").drop("document_name")))


@query
def url_filename(spark, folder):
    listed = pdf_lists.listed_urls(load(spark, folder, "urls").drop("document_name"))
    return listed.select("idx", urls.url_file_name(F.col("url")).alias("file_name"))


# --- sinks, written and read back ---

@query
def sink_csv(spark, folder):
    """Null, empty and blank text and line breaks come back from CSV as they were."""
    path = _scratch(spark, "sink_csv")
    sinks.write_records(load(spark, folder, "raw_records"), path, "csv")
    return tables.read_delimited(spark, path).withColumn("page_id", F.col("page_id").cast("bigint"))


@query
def sink_json(spark, folder):
    """Records with lists, as JSON lines."""
    path = _scratch(spark, "sink_json")
    rows = _records(spark, folder).select("page_id", "title", "year", "industry_sectors_additional", "subsidiary_companies")
    sinks.write_records(rows, path, "json")
    back = spark.read.schema(rows.schema).json(path)
    return back.select("page_id", "title", F.col("year").cast("bigint").alias("year"), _joined("industry_sectors_additional"), _joined("subsidiary_companies"))


@query
def sink_per_source(spark, folder):
    """Signature records in buckets of sources; the union of the buckets is the consolidated file."""
    path = _scratch(spark, "sink_per_source")
    rows = _output(spark, folder)
    sinks.write_per_source(rows, path, buckets=16)
    return signatures.consolidated(spark.read.schema(rows.schema).json(path)).select(*rows.columns)


@query
def sink_markdown(spark, folder):
    """One document per source; a source without content gets a note."""
    path = _scratch(spark, "sink_markdown")
    sinks.write_markdown(documents.build_documents(_page_table(spark, folder)), path, buckets=16)
    return spark.read.schema("source_id string, final_markdown string").json(path).drop("bucket")


@query
def sink_summary(spark, folder):
    path = _scratch(spark, "sink_summary")
    rows = country_summary(spark, folder)
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query
def sink_signers(spark, folder):
    """Signer rows as CSV and as JSON lines."""
    path = _scratch(spark, "sink_signers")
    written = f"{path}/rows"
    signer_rows(spark, folder).write.parquet(written)
    rows = spark.read.parquet(written)
    sinks.write_records(rows, f"{path}/csv", "csv")
    sinks.write_records(rows, f"{path}/json", "json")
    types = {f.name: f.dataType for f in rows.schema}
    text = tables.read_delimited(spark, f"{path}/csv")
    back = {"csv": text.select(*[F.col(c).cast(types[c]) for c in rows.columns]), "json": spark.read.schema(rows.schema).json(f"{path}/json")}
    return back["csv"].withColumn("format", F.lit("csv")).unionByName(back["json"].withColumn("format", F.lit("json")))


@query
def sink_links(spark, folder):
    """Distinct statement links and the lines of their header."""
    path = _scratch(spark, "sink_links")
    sinks.write_links(page_links(spark, folder), path, "ca", "2025-01-01 00:00:00", "statement_url")
    return spark.read.text(f"{path}/header").unionByName(spark.read.text(f"{path}/links")).withColumnRenamed("value", "line")


# --- cleaning and filters ---

@query
def clean_strings(spark, folder):
    cleaned = profiles.au_clean_registry(load(spark, folder, "au_registry"))
    return cleaned.select("registry_seq", "ABN", "Company_Name", "Status")


@query
def clean_typed(spark, folder):
    cleaned = profiles.ca_clean_statements(load(spark, folder, "ca_statements"))
    return cleaned.select("statement_seq", "organization", "year", "language")


@query
def clean_registry(spark, folder):
    cleaned = profiles.ca_clean_registry(load(spark, folder, "ca_registry"))
    return cleaned.select("idx", "business_name", "business_id_no", "prov_terr")


@query
def parse_dates_iso(spark, folder):
    parsed = profiles.au_clean_statements(load(spark, folder, "au_statements"))
    return parsed.select("statement_seq", "period_start", "period_end")


@query
def parse_dates_uk(spark, folder):
    parsed = profiles.uk_clean_registry(load(spark, folder, "uk_registry"))
    return parsed.select(
        "CompanyName", "CompanyNumber", "IncorporationDate", "DissolutionDate", "Mortgages_NumMortCharges")


@query
def null_if_empty(spark, folder):
    rows = load(spark, folder, "au_statements")
    return rows.select("statement_seq", text.blank_to_null(F.col("abn")).alias("abn"))


@query
def name_upper(spark, folder):
    rows = load(spark, folder, "au_statements")
    return rows.select("statement_seq", F.upper(text.strip(F.col("reporting_entities"))).alias("entity_name"))


@query
def filter_nonempty(spark, folder):
    cleaned = profiles.uk_clean_statements(load(spark, folder, "uk_statements"))
    return selection.filter_nonempty(cleaned, "CompanyNumber").select("statement_seq", "CompanyNumber")


@query
def clean_records(spark, folder):
    rows = load(spark, folder, "raw_records")
    return pages.clean_records(rows, ["title", "pdf_url", "pages"], "url", "CA")


@query
def required_fields(spark, folder):
    rows = load(spark, folder, "raw_records")
    return rows.filter(pages.has_required(rows, ["title", "pages"])).select("page_id", "title", "pages")


@query
def standardize(spark, folder):
    return schema.standardize(load(spark, folder, "ca_registry"), "canada")


@query
def snake_case(spark, folder):
    return schema.snake_case(load(spark, folder, "uk_registry"))


@query
def country_filter(spark, folder):
    return pages.country_filter(load(spark, folder, "ca_records"), "germany")


# --- profiles and joins ---

def _uk(spark, folder) -> DataFrame:
    return profiles.build_profiles(
        load(spark, folder, "uk_statements"), load(spark, folder, "uk_registry"), "uk", tiebreak=SEQ)


def _au(spark, folder) -> DataFrame:
    return profiles.build_profiles(
        load(spark, folder, "au_statements"), load(spark, folder, "au_registry"), "australia", tiebreak=SEQ)


def _ca(spark, folder) -> DataFrame:
    return profiles.build_profiles(
        load(spark, folder, "ca_statements"), load(spark, folder, "ca_registry"), "canada", CURRENT_YEAR, SEQ)


@query
def uk_profiles(spark, folder):
    return _uk(spark, folder)


@query
def au_profiles(spark, folder):
    return _au(spark, folder)


@query
def ca_profiles(spark, folder):
    return _ca(spark, folder)


def _ca_join(spark, folder, fuzzy, **options):
    statements = profiles.ca_latest(load(spark, folder, "ca_statements"), SEQ)
    registry = profiles.ca_clean_registry(load(spark, folder, "ca_registry"))
    joined = joins.one_row_per_parent(statements, registry, fuzzy, tiebreak=SEQ, **options)
    return joined.select("parent_company", "organization", "idx", "business_name", "statement_seq")


@query
def ca_direct_join(spark, folder):
    return _ca_join(spark, folder, False)


@query
def ca_fuzzy_join(spark, folder):
    return _ca_join(spark, folder, True)


@query
def join_stats(spark, folder):
    entities, companies = profiles.au_join_sides(
        load(spark, folder, "au_statements"), load(spark, folder, "au_registry"), SEQ)
    return joins.join_stats(entities, companies, "ABN", "ABN", "Company_Name")


@query
def register_with_pdf(spark, folder):
    rows = register.register_records(load(spark, folder, "register"))
    found = html.parse_pages(load(spark, folder, "register_pages", heavy=True))
    return pages.register_with_pdf(rows, found).select("idx", "statement_url", "pdf_url")


# --- one row per key ---

@query
def latest_per_key(spark, folder):
    return profiles.uk_latest(load(spark, folder, "uk_statements"), SEQ).select(
        "CompanyNumber", "StatementYear", "statement_seq")


@query
def unique_statements(spark, folder):
    cleaned = profiles.au_clean_statements(load(spark, folder, "au_statements"))
    return expand.unique_statements(cleaned, SEQ).select("statement_unique_id", "statement_seq")


@query
def unique_keep_first(spark, folder):
    latest = profiles.ca_latest(load(spark, folder, "ca_statements"), SEQ)
    order = [F.col("organization"), F.col("statement_seq")]
    return selection.keep_first(latest, ["parent_company"], order).select(
        "parent_company", "organization", "statement_seq")


@query
def prefer_current(spark, folder):
    return selection.prefer_current(load(spark, folder, "au_registry"), "ABN", "Current_Name_Indicator")


@query
def distinct_first_seen(spark, folder):
    links = pages.statement_links(
        html.parse_pages(load(spark, folder, "search_pages", heavy=True)), "https://www.example.ca/cnt/")
    return selection.distinct_first_seen(links, "statement_url", ["page_id", "position"])


@query
def detection_select(spark, folder):
    boxes = load(spark, folder, "detections")
    order = ["xmin", "ymin", "box_area"]
    return selection.select_detections(boxes, ["source_id", "page_number"], order, threshold=6.0).select(
        "source_id", "page_number", *order, "confidence", "likely_signature", "forced_pick", "picked")


# --- nested values ---

@query
def expand_entities(spark, folder):
    return profiles.au_entities(load(spark, folder, "au_statements"), SEQ).select(
        "statement_seq", "abn", "group_entity_count", "entity_index_in_group", "statement_group_id",
        "is_primary_entity", F.col("statement_year").cast("bigint"))


@query
def split_head_tail(spark, folder):
    rows = load(spark, folder, "au_statements").select(
        "statement_seq", F.transform(F.split("abn", ","), text.strip).alias("ids"))
    return rows.select(
        "statement_seq", expand.head(F.col("ids")).alias("first_id"),
        F.array_join(expand.rest(F.col("ids")), "|").alias("other_ids"))


@query
def sector_split(spark, folder):
    found = html.parse_pages(load(spark, folder, "statement_pages", heavy=True))
    subjects = pages._section("Subject", "anchors")
    rows = found.select("page_id", *[c.alias(n) for n, c in pages.sector_fields(subjects).items()])
    return rows.select(
        "page_id", "industry_sector", _joined("industry_sectors_additional"),
        "industry_subsector", _joined("industry_subsectors_additional"))


# --- reports ---

@query
def completeness(spark, folder):
    return report.completeness(_uk(spark, folder))


@query
def au_report_basic(spark, folder):
    return report.basic_counts(_au(spark, folder), "abn", "statement_group_id")


@query
def join_method_dist(spark, folder):
    method = F.when(F.col("company_name").isNotNull(), F.col("join_method"))
    return report.share_distribution(_au(spark, folder).withColumn("join_method", method), "join_method", "NO_MATCH")


@query
def entity_structure(spark, folder):
    return report.entity_structure(_au(spark, folder))


@query
def expansion_stats(spark, folder):
    entities = profiles.au_entities(load(spark, folder, "au_statements"), SEQ)
    return report.expansion_stats(entities).withColumn("statement_year", F.col("statement_year").cast("bigint"))


@query
def dist_by_key(spark, folder):
    return report.distributions(profiles.ca_latest(load(spark, folder, "ca_statements"), SEQ), ["year", "language"])


@query
def duplicate_keys(spark, folder):
    registry = profiles.ca_clean_registry(load(spark, folder, "ca_registry"))
    return report.duplicate_keys(registry, "business_name")


@query
def geo_dist(spark, folder):
    return report.distribution(_ca(spark, folder), "province_state", non_null=True)


@query
def top_sectors(spark, folder):
    return report.distribution(_ca(spark, folder), "industry_sectors", non_null=True, top=10)


@query
def status_dist(spark, folder):
    return report.distributions(_uk(spark, folder), ["company_status", "business_sector", "company_size"])


@query
def compliance_dist(spark, folder):
    return report.compliance_dist(_uk(spark, folder)).withColumn(
        "compliance_score", F.col("compliance_score").cast("bigint"))


@query
def mean_scores(spark, folder):
    return report.mean_scores(_ca(spark, folder), ["data_completeness_score", "recency_score"])


def _all_countries(spark, folder) -> DataFrame:
    return schema.align_union(_au(spark, folder), _ca(spark, folder), _uk(spark, folder))


@query
def country_summary(spark, folder):
    key = lambda *cols: F.coalesce(*[F.col(c) for c in cols])
    rows = _all_countries(spark, folder).withColumns({
        "entity_key": F.when(F.col("data_country") == "australia", F.col("abn"))
        .when(F.col("data_country") == "uk", F.col("company_number"))
        .otherwise(key("organization_name")),
        "statement_key": F.when(F.col("data_country") == "australia", F.col("statement_group_id"))
        .when(F.col("data_country") == "uk", F.col("company_number"))
        .otherwise(key("organization_name")),
        "is_matched": F.col("company_name").isNotNull(),
    })
    rows = rows.select(*report.KEY_FIELDS, "data_country", "entity_key", "statement_key", "is_matched")
    return report.country_summary(rows, fields={
        "australia": report.KEY_FIELDS,
        "canada": [f for f in report.KEY_FIELDS if f not in ("incorporation_date", "annual_revenue")],
        "uk": [f for f in report.KEY_FIELDS if f != "annual_revenue"],
    })


@query
def crawl_stats(spark, folder):
    found = html.parse_pages(load(spark, folder, "register_pages", heavy=True), wanted=pages.needs("register_pdf_url"))
    return report.crawl_stats(found, pages.register_pdf_url().isNotNull())


@query
def expected_vs_actual(spark, folder):
    return report.expected_vs_actual(
        register.register_records(load(spark, folder, "register")), "headquartered_countries")


@query
def all_countries(spark, folder):
    columns = [
        "data_country", "organization_name", "company_name", "company_status", "statement_year",
        "is_active", "industry_sectors", "statement_url",
    ]
    return _all_countries(spark, folder).select(*columns)


@query
def align_union(spark, folder):
    """Three tables that share a few columns, two of them with different types."""
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    nation = table(spark, folder, "nation").select(
        F.col("n_name").alias("name"), F.col("n_regionkey").alias("region"))
    part = table(spark, folder, "part").select(
        F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("id"), F.col("p_name").alias("name"))
    return schema.align_union(supplier, nation, part)


@query
def common_columns(spark, folder):
    """Rows of all countries over the columns every country has."""
    tables_ = [t.withColumnRenamed("statement_seq", "seq")
               for t in (_au(spark, folder), _ca(spark, folder), _uk(spark, folder))]
    shared = [c for c in schema.common_columns(*tables_)]
    return schema.align_union(*[t.select(*shared) for t in tables_])


# --- scalar functions ---

@query
def normalize_name(spark, folder):
    rows = load(spark, folder, "ca_statements")
    return rows.select("statement_seq", names.normalize_company_name(F.col("parent_company")).alias("name"))


@query
def match_key(spark, folder):
    rows = load(spark, folder, "ca_statements")
    return rows.select("statement_seq", names.match_key(F.col("parent_company")).alias("key"))


@query
def company_age(spark, folder):
    return profiles.uk_measures(
        profiles.uk_profiles(load(spark, folder, "uk_statements"), load(spark, folder, "uk_registry"), SEQ)
    ).select("CompanyNumber", "CompanyAgeAtStatement")


@query
def period_days(spark, folder):
    rows = profiles.au_clean_statements(load(spark, folder, "au_statements"))
    days = measures.period_days(F.col("period_start"), F.col("period_end"))
    return rows.select("statement_seq", days.cast("bigint").alias("days"))


@query
def count_matches(spark, folder):
    rows = load(spark, folder, "au_statements")
    return rows.select(
        "statement_seq", measures.list_length(F.col("headquartered_countries")).cast("bigint").alias("countries"))


@query
def flags(spark, folder):
    return profiles.uk_measures(
        profiles.uk_profiles(load(spark, folder, "uk_statements"), load(spark, folder, "uk_registry"), SEQ)
    ).select("CompanyNumber", *profiles.COMPLIANCE_FLAGS, "HasRisk1", "HasRisk2", "HasRisk3", "IsActive",
             "IsDissolved", "HasMortgageCharges")


@query
def scores(spark, folder):
    return profiles.uk_measures(
        profiles.uk_profiles(load(spark, folder, "uk_statements"), load(spark, folder, "uk_registry"), SEQ)
    ).select("CompanyNumber", F.col("ComplianceScore").cast("bigint"),
             F.col("RiskAssessmentCompleteness").cast("bigint"))


@query
def recency(spark, folder):
    rows = profiles.ca_clean_statements(load(spark, folder, "ca_statements"))
    return rows.select(
        "statement_seq", measures.recency(F.col("year"), CURRENT_YEAR).cast("bigint").alias("recency"))


@query
def size_band(spark, folder):
    rows = load(spark, folder, "uk_statements")
    return rows.select(
        "statement_seq", measures.size_band(F.col("Turnover")).alias("size"),
        measures.size_band(F.col("Turnover"), corrected=True).alias("corrected_size"))


@query
def full_address(spark, folder):
    rows = load(spark, folder, "uk_registry")
    parts = ["AddressLine1", "AddressLine2", "PostTown", "County", "PostCode"]
    return rows.select(
        "CompanyName", measures.joined_address(*[F.col(f"RegAddress_{p}") for p in parts]).alias("address"))


def _raw_dates(spark, folder) -> DataFrame:
    """Order dates in several spellings, one per order."""
    day = F.col("o_orderdate").cast("date")
    spelled = [F.date_format(day, f) for f in (
        "M/d/yyyy", "dd/MM/yyyy", "yyyy/MM/dd", "yyyy-MM-dd", "MMMM d, yyyy", "d MMMM yyyy")]
    kind = (F.col("o_orderkey") % 8).cast("int")
    raw = F.when(kind == 6, "soon").when(kind == 7, "")
    for n, c in enumerate(spelled):
        raw = raw.when(kind == n, c)
    return table(spark, folder, "orders").select(
        "o_orderkey", raw.alias("raw"), (F.col("o_orderkey") % 9 != 0).alias("has_date"))


@query
def normalize_date(spark, folder):
    rows = _raw_dates(spark, folder)
    return rows.select("o_orderkey", dates.normalize_date(F.col("raw"), F.col("has_date")).alias("date"))


@query
def normalize_date_v5(spark, folder):
    rows = _raw_dates(spark, folder)
    return rows.select("o_orderkey", dates.normalize_free_date(F.col("raw")).alias("date"))


@query
def clean_signatory(spark, folder):
    return spread(table(spark, folder, "documents")).select(
        "doc_id", signatures.clean_signatory(F.col("text")).alias("cleaned"))


def _short_texts(spark, folder) -> DataFrame:
    k = F.col("c_custkey")
    value = (
        F.when(k % 5 == 0, "John Smith").when(k % 5 == 1, F.concat(F.lit("Jane Doe, Managing Director "), "c_name"))
        .when(k % 5 == 2, F.concat(F.lit("Acme  Holdings\nLimited "), "c_name")).when(k % 5 == 3, "éva Young")
        .otherwise(F.lit(None).cast("string"))
    )
    return table(spark, folder, "customer").select(k, value.alias("signatory_text"))


@query
def signatory_parts(spark, folder):
    rows = _short_texts(spark, folder).withColumn("t", signatures.clean_signatory(F.col("signatory_text")))
    parts = signatures.signatory_parts(F.col("t"))
    return rows.select(
        "c_custkey", *[c.alias(n) for n, c in parts.items()], signatures.joined_parts(*parts.values()).alias("joined"))


@query
def absolute_urls(spark, folder):
    rows = load(spark, folder, "relative_urls")
    return rows.select("idx", urls.absolute_url(F.col("url"), F.col("base")).alias("url"))


@query
def generate_urls(spark, folder):
    """Search pages of several sites, each with its own range; bad ranges as error rows."""
    return urls.page_urls(load(spark, folder, "url_ranges"), chunk=50).select("range_id", "page", "url", "error")


@query
def file_type(spark, folder):
    return table(spark, folder, "pages").select("page_id", urls.file_type(F.col("url")).alias("file_type"))


@query
def log_lines(spark, folder):
    rows = load(spark, folder, "raw_records").withColumnRenamed("url", "source_url")
    return result_log.log_lines(rows, ["page_id"])


# --- pages ---

def _statement_pages(spark, folder, *rules: str) -> DataFrame:
    """Parsed statement pages: what the rules read, or all elements."""
    found = load(spark, folder, "statement_pages", heavy=True)
    return html.parse_pages(found, wanted=pages.needs(*rules)) if rules else html.parse_pages(found)


def _raw_pages(spark, folder, *rules: str) -> DataFrame:
    return html.parse_pages(spread(table(spark, folder, "pages")), wanted=pages.needs(*rules))


def _records(spark, folder) -> DataFrame:
    return pages.page_records(_statement_pages(spark, folder), "CA")


@query
def page_links(spark, folder):
    found = html.parse_pages(load(spark, folder, "search_pages", heavy=True), wanted=pages.needs("statement_links"))
    return pages.statement_links(found, "https://www.example.ca/cnt/").select(
        "page_id", F.col("position").cast("bigint"), "statement_url")


@query
def page_title(spark, folder):
    """Titles of the raw web pages."""
    return _raw_pages(spark, folder, "title").select("page_id", pages.title().alias("title"))


@query
def page_language(spark, folder):
    return _raw_pages(spark, folder, "language").select("page_id", pages.language().alias("language"))


@query
def page_pdf_url(spark, folder):
    return _statement_pages(spark, folder, "pdf_url").select("page_id", pages.pdf_url().alias("pdf_url"))


@query
def raw_pdf_url(spark, folder):
    """PDF links of the raw web pages, some of which end in one."""
    found = html.parse_pages(load(spark, folder, "linked_pages", heavy=True), wanted=pages.needs("pdf_url"))
    return found.select("page_id", pages.pdf_url().alias("pdf_url"))


def _anchors(root) -> list[str]:
    """A caller's link extractor: every address of the page, in order."""
    return [a.attrs["href"] for a in root.find_all("a") if "href" in a.attrs]


@query
def raw_links(spark, folder):
    """A caller's link extractor over the raw web pages."""
    found = html.links_with(load(spark, folder, "linked_pages", heavy=True), _anchors, "https://www.example.ca/")
    return found.select("page_id", "position", "href", "link")


@query
def lateral_links(spark, folder):
    """The same extractor as a table function, in a lateral call of SQL."""
    spark.udtf.register("links_of", html.link_table(_anchors))
    return spark.sql(
        "SELECT p.page_id, l.position, l.href, concat('https://www.example.ca', l.href) AS link FROM {linked} p, LATERAL links_of(p.html) l",
        linked=load(spark, folder, "linked_pages", heavy=True))


@query
def page_year(spark, folder):
    rows = pages.with_title(_statement_pages(spark, folder, "title", "year"))
    return rows.select("page_id", pages.year(F.col("title")).cast("bigint").alias("year"))


@query
def page_org(spark, folder):
    rows = pages.with_title(_statement_pages(spark, folder, "title"))
    return rows.select("page_id", "title", pages.organization(F.col("title")).alias("organization"))


@query
def page_legal(spark, folder):
    return _statement_pages(spark, folder, "sections").select(
        "page_id", *[c.alias(n) for n, c in pages.legal_fields().items()])


@query
def page_industry(spark, folder):
    return _records(spark, folder).select(
        "page_id", "industry_sector", _joined("industry_sectors_additional"), "industry_subsector")


@query
def page_company(spark, folder):
    rows = _statement_pages(spark, folder, "sections").select(
        "page_id", *[c.alias(n) for n, c in pages.company_fields().items()])
    return rows.withColumn("subsidiary_companies", _joined("subsidiary_companies"))


@query
def page_doctype(spark, folder):
    return _records(spark, folder).select("page_id", "document_type")


@query
def page_records(spark, folder):
    lists = ["industry_sectors_additional", "industry_subsectors_additional", "subsidiary_companies"]
    rows = _records(spark, folder)
    return rows.withColumns({c: F.array_join(c, "|") for c in lists}).withColumn(
        "year", F.col("year").cast("bigint"))


@query
def au_pdf_url(spark, folder):
    found = html.parse_pages(load(spark, folder, "register_pages", heavy=True), wanted=pages.needs("register_pdf_url"))
    return found.select("page_id", pages.register_pdf_url().alias("pdf_url"))


@query
def detect_country(spark, folder):
    return pages.detect_country(load(spark, folder, "ca_records")).select("page_id", "detected_country")


@query
def custom_extractor(spark, folder):
    """A caller's own function over the raw web pages."""

    def paragraphs(root) -> dict:
        first = next((b.tight_text() for b in root.find_all("h1")), None)
        return {"paragraphs": len(root.find_all("p")), "first_bold": first}

    found = spread(table(spark, folder, "pages"))
    return html.extract_with(found, paragraphs, "paragraphs bigint, first_bold string")


# --- documents ---

def _page_table(spark, folder) -> DataFrame:
    wide = responses.pages_wide(
        load(spark, folder, "responses"), ["analysis", "text", "tables", "figures", "detection", "extraction"])
    return documents.with_analysis(wide)


def _contents(spark, folder) -> DataFrame:
    return documents.page_contents(_page_table(spark, folder))


def _with_signature_block(pages_: DataFrame) -> DataFrame:
    block = F.when(
        signatures.has_signatures(F.col("detection")), documents.signature_markdown(F.col("record")))
    return signatures.with_record(pages_).withColumn("signature_block", block)


@query
def page_analysis(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'analysis'")
    return documents.with_analysis(rows, "response").drop("kind", "response")


@query
def page_routing(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'analysis'")
    routed = documents.page_routing(documents.with_analysis(rows, "response"))
    return routed.select("source_id", "page_number", _joined("extractors"), "needs_processing")


def _sections(spark, folder, kind, mark):
    rows = load(spark, folder, "responses").filter(F.col("kind") == kind)
    return rows.select(
        "source_id", "page_number", F.inline(documents.sections(F.col("response"), mark)))


@query
def table_sections(spark, folder):
    return _sections(spark, folder, "tables", "TABLE")


@query
def figure_sections(spark, folder):
    return _sections(spark, folder, "figures", "FIGURE")


@query
def placeholders(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'text'")
    return rows.select("source_id", "page_number", *[
        F.array_join(documents.placeholder_ids(F.col("response"), k), "|").alias(k.lower())
        for k in ("TABLE", "FIGURE", "SIGNATURE")])


@query
def placeholder_counts(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'text'")
    return rows.select("source_id", "page_number", *[
        documents.placeholder_count(F.col("response"), k).alias(k.lower())
        for k in ("TABLE", "FIGURE", "SIGNATURE")])


@query
def integrate_pages(spark, folder):
    return _contents(spark, folder).select("source_id", "page_number", "integrated_content")


@query
def integrate_with_signatures(spark, folder):
    rows = documents.page_contents(_with_signature_block(_page_table(spark, folder)), "signature_block")
    return rows.select("source_id", "page_number", "integrated_content")


@query
def integration_check(spark, folder):
    checked = documents.integration_check(_contents(spark, folder))
    lists = ["missing_tables", "missing_figures", "available_tables", "available_figures"]
    return checked.withColumns({c: F.array_join(c, "|") for c in lists})


@query
def combine_pages(spark, folder):
    return documents.combine_pages(_contents(spark, folder))


@query
def page_summary(spark, folder):
    return documents.page_summary(_contents(spark, folder))


@query
def signature_markdown(spark, folder):
    return _with_signature_block(_page_table(spark, folder)).select("source_id", "page_number", "signature_block")


@query
def document_stats(spark, folder):
    return documents.document_stats(_page_table(spark, folder))


@query
def document_result(spark, folder):
    return documents.build_documents(_page_table(spark, folder))


@query
def page_limit(spark, folder):
    return selection.page_limit(load(spark, folder, "responses"), 3).select("source_id", "page_number", "kind")


# --- signatures ---

def _signature_pages(spark, folder) -> DataFrame:
    wide = responses.pages_wide(load(spark, folder, "responses"), ["detection", "extraction"])
    return signatures.signature_pages(responses.sound_pages(wide))


def _output(spark, folder) -> DataFrame:
    return signatures.output_records(_signature_pages(spark, folder))


@query
def sig_detection(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'detection'")
    parsed = rows.select(
        "source_id", "page_number", signatures.parse_detection(F.col("response")).alias("p"))
    parsed = parsed.select("source_id", "page_number", "p.*")
    types = F.transform("signatures_analysis", lambda b: F.concat_ws(
        "/", b["signature_type"], b["is_image"].cast("string"), b["is_scanned"].cast("string"),
        b["signature_block_format"]))
    return parsed.withColumns({
        "signature_count": F.col("signature_count").cast("bigint"),
        "signatures_analysis": F.array_join(types, "|"),
    })


@query
def sig_extraction(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'extraction'")
    rows = rows.withColumn("p", signatures.parse_extraction(F.col("response")))
    shown = F.transform("p.dates", lambda d: F.concat_ws(
        "/", d["raw_date_text"], d["associated_signature"], d["standardized_date"], d["date_confidence"]))
    return rows.select(
        "source_id", "page_number", F.array_join("p.signatory_texts", "|").alias("signatory_texts"),
        F.array_join(shown, "|").alias("dates"), "p.has_date")


@query
def sig_records(spark, folder):
    return _signature_pages(spark, folder).drop("detection", "extraction")


@query
def sig_v2_records(spark, folder):
    rows = signatures.four_prompt_signatures(load(spark, folder, "four_responses"))
    return rows.drop("detection", "sig_analysis", "sig_text", "sig_dates")


@query
def sig_v5_parse(spark, folder):
    rows = load(spark, folder, "person_responses")
    parsed = signatures.parse_person_detection(F.col("detection")).alias("p")
    people = F.transform(
        signatures.parse_persons(F.col("extraction")),
        lambda p: F.concat_ws("/", p["name"], p["title"], p["company"], p["date"]))
    return rows.select(
        "source_id", "page_number", parsed, F.array_join(people, "|").alias("people"),
    ).select("source_id", "page_number", "p.*", "people").withColumn(
        "signature_count", F.col("signature_count").cast("bigint"))


@query
def sig_v5_records(spark, folder):
    """Records from the two response tables; a page that only one of them holds has no signatory."""
    return signatures.person_records(_person_pages(spark, folder))


def _person_pages(spark, folder) -> DataFrame:
    return responses.pair_pages(load(spark, folder, "person_detections"), load(spark, folder, "person_extractions"))


@query
def page_pairs(spark, folder):
    """Detection and extraction responses of each page, side by side."""
    return _person_pages(spark, folder)


@query
def unpaired_pages(spark, folder):
    """Pages that one of the two response tables lacks, as error records."""
    return signatures.error_records(responses.unpaired_pages(_person_pages(spark, folder)))


@query
def latest_answers(spark, folder):
    """Pages whose answers came more than once: the last one counts."""
    return responses.pages_wide(load(spark, folder, "delivered_responses"), ["text", "tables"], order="arrival")


@query
def answer_conflicts(spark, folder):
    """The same pages without an order: differing answers make a page an error."""
    return responses.pages_wide(load(spark, folder, "delivered_responses"), ["text", "tables"])


@query
def signature_records(spark, folder):
    return _output(spark, folder)


@query
def signature_records_parts(spark, folder):
    return signatures.output_records(_signature_pages(spark, folder), parts=True)


@query
def signature_errors(spark, folder):
    rows = load(spark, folder, "responses").filter("kind = 'analysis'").select(
        "source_id", "page_number", F.concat(F.lit("no image for "), "source_id").alias("error"))
    return signatures.error_records(rows)


@query
def concat_batches(spark, folder):
    """Results of several batches, one of them errors, as one table."""
    pages_ = _signature_pages(spark, folder)
    batches = [signatures.output_records(pages_.filter(F.col("page_number") % 2 == k)) for k in (0, 1)]
    return schema.align_union(*batches, signature_errors(spark, folder))


@query
def consolidated_signatures(spark, folder):
    records = _output(spark, folder).drop("Signature_scanned")
    return signatures.stamped(signatures.consolidated(records), "2025-09-20T18:18:25")


def _sources(spark, folder) -> DataFrame:
    return load(spark, folder, "responses").select("source_id")


@query
def source_summary(spark, folder):
    return signatures.source_summary(_output(spark, folder), _sources(spark, folder))


@query
def corpus_summary(spark, folder):
    return signatures.corpus_summary(_output(spark, folder), _sources(spark, folder))


def _picked_boxes(spark, folder):
    boxes = selection.select_detections(
        load(spark, folder, "detections"), ["source_id", "page_number"], ["xmin", "ymin", "box_area"], threshold=6.0)
    return boxes.filter("picked")


@query
def detection_summary(spark, folder):
    return signatures.detection_summary(_picked_boxes(spark, folder))


@query
def detection_totals(spark, folder):
    return signatures.detection_totals(_picked_boxes(spark, folder), load(spark, folder, "detections").select("source_id"))


@query
def line_context(spark, folder):
    return signers.line_context(spread(table(spark, folder, "documents")), ["doc_id"])


@query
def signer_hits(spark, folder):
    return signers.signer_hits(load(spark, folder, "signer_pages", heavy=True), ["doc_id", "page_number"])


@query
def signer_dedup(spark, folder):
    hits = signers.signer_hits(load(spark, folder, "signer_pages", heavy=True), ["doc_id", "page_number"])
    return hits.select("doc_id", "page_number", "name", "role", "line_no")


@query
def signer_rows(spark, folder):
    return signers.signer_rows(load(spark, folder, "signer_pages", heavy=True), ["doc_id", "page_number"])


# --- the result log ---

def _event_log(rows: DataFrame) -> DataFrame:
    records = rows.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("timestamp"),
        F.concat_ws(", ", "event_type", "props").alias("title"),
        F.when(F.col("event_id") % 4 != 0, F.concat(F.lit("https://e.example.org/"), "user_id")).alias("pdf_url"))
    return result_log.log_lines(records, ["event_id", "timestamp"])


@query
def stream_log(spark, folder):
    """Pages as a stream, each record logged as its page arrives."""
    path = result_log.new_log(spark, "stream_log")
    found = html.parse_pages(result_log.stream_table(spark, folder, "pages", heavy=True))
    records = pages.page_records(found, "CA")
    result_log.append_log(result_log.log_lines(records, ["page_id"]), path)
    return result_log.read_log(spark, path)


@query
def stream_count(spark, folder):
    path = result_log.new_log(spark, "stream_count")
    lines = _event_log(result_log.stream_table(spark, folder, "events"))
    result_log.running_count(lines, path)
    return result_log.read_count(spark, path)


@query
def stream_country_log(spark, folder):
    """Statement pages as a stream: only the records of one detected country reach the log."""
    path = result_log.new_log(spark, "stream_country")
    found = load(spark, folder, "statement_pages", customer=result_log.stream_table(spark, folder, "customer", heavy=True))
    jobs.crawl_to_log(found, path, "canadian", "united states")
    return result_log.read_log(spark, path)


@query
def latest_log(spark, folder):
    path = result_log.new_log(spark, "latest_log")
    result_log.append_log(_event_log(result_log.stream_table(spark, folder, "events")), path)
    return result_log.latest_log(result_log.read_log(spark, path), 5, ["timestamp", "event_id"])
