"""Statement and registry files.

Every column is read as text with an explicit schema, so no file is scanned
twice to guess types and a bad value cannot fail a read; the cleaning step
types what it needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.schema import align_union, clean_names, select_existing

# Columns of the source files, in order.
AU_STATEMENT_COLUMNS = [
    "idx", "period_start", "period_end", "statement_type", "headquartered_countries",
    "annual_revenue", "reporting_entities", "abn", "statement_url", "industry_sectors",
    "related_statements", "jurisdiction", "source_system", "country_filter", "pdf_url",
    "included_entities",
]
AU_REGISTRY_COLUMNS = [
    "Company Name", "ACN", "Type", "Class", "Sub Class", "Status", "Date of Registration",
    "Date of Deregistration", "Previous State of Registration", "State Registration number",
    "Modified since last report", "Current Name Indicator", "ABN", "Current Name",
    "Current Name Start Date",
]
CA_STATEMENT_COLUMNS = [
    "title", "statement_name", "pdf_url", "statement_url", "year", "organization", "language",
    "file_type", "reporting_law", "statement_type", "legal_framework", "industry_sector",
    "parent_company", "subsidiary_companies", "company_country", "document_type", "source_url",
    "jurisdiction", "industry_sectors_additional", "industry_subsector",
    "industry_subsectors_additional",
]
CA_REGISTRY_COLUMNS = [
    "idx", "business_name", "alt_business_name", "business_sector", "business_subsector",
    "business_description", "business_id_no", "licence_number", "licence_type", "derived_NAICS",
    "source_NAICS_primary", "source_NAICS_secondary", "NAICS_descr", "NAICS_descr2",
    "full_address", "city", "prov_terr", "total_no_employees", "status", "provider",
]
UK_STATEMENT_COLUMNS = [
    "StatementYear", "OrganisationName", "Address", "SectorType", "CompanyNumber", "LastUpdated",
    "GroupSubmission", "ParentName", "StatementURL", "StatementStartDate", "StatementEndDate",
    "ApprovingPerson", "DateApproved", "StatementIncludesOrgStructure",
    "StatementIncludesPolicies", "StatementIncludesRisksAssessment",
    "StatementIncludesDueDiligence", "StatementIncludesTraining", "StatementIncludesGoals",
    "OrganisationSectors", "Turnover", "YearsProducingStatements",
    "Risk1", "Risk1Area", "Risk1Location", "Risk1Mitigation",
    "Risk2", "Risk2Area", "Risk2Location", "Risk2Mitigation",
    "Risk3", "Risk3Area", "Risk3Location", "Risk3Mitigation",
    "DemonstrateProgress", "PDFURL",
]
UK_REGISTRY_COLUMNS = [
    "CompanyName", "CompanyNumber",
    "RegAddress.AddressLine1", "RegAddress.AddressLine2", "RegAddress.PostTown",
    "RegAddress.County", "RegAddress.Country", "RegAddress.PostCode",
    "CompanyCategory", "CompanyStatus", "CountryOfOrigin", "DissolutionDate",
    "IncorporationDate", "Accounts.NextDueDate", "Accounts.LastMadeUpDate",
    "Accounts.AccountCategory", "Mortgages.NumMortCharges", "Mortgages.NumMortOutstanding",
    "SICCode.SicText_1", "SICCode.SicText_2", "SICCode.SicText_3", "SICCode.SicText_4",
    "PreviousName_1.CompanyName", "PreviousName_2.CompanyName", "URI",
]


NULL_TEXT = "\x00"


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Matching files by path; an empty listing or a missing folder raises."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(path):
        raise FileNotFoundError(f"Path not found: {folder}")
    if not fs.getFileStatus(path).isDirectory():
        raise NotADirectoryError(f"Path must be a directory: {folder}")
    found = fs.globStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path, pattern))
    names = sorted(f.getPath().toString() for f in found or [])
    if not names:
        raise FileNotFoundError(f"no file like {pattern} in {folder}")
    return names


def _text_schema(header: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def first_lines(spark: SparkSession, paths: list[str]) -> list[str]:
    """The first line of each file, or of the first file of a folder. The driver opens the files; no job runs."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def first(name: str) -> str:
        path = jvm.org.apache.hadoop.fs.Path(name)
        fs = path.getFileSystem(conf)
        while fs.getFileStatus(path).isDirectory():
            inside = sorted(f.getPath().toString() for f in fs.listStatus(path) if f.getPath().getName()[0] not in "_.")
            if not inside:
                return ""
            path = jvm.org.apache.hadoop.fs.Path(inside[0])
        codec, stream = codecs.getCodec(path), fs.open(path)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    return [first(p) for p in paths]


def read_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Column names of one file, from its first line only."""
    first = spark.read.option("sep", sep).option("header", True).option("inferSchema", False)
    return first.csv(path).columns


def read_delimited(spark: SparkSession, paths: str | list[str], sep: str = ",", newlines: bool | None = None) -> DataFrame:
    """All text; short lines end in nulls, extra fields are dropped.

    An empty field is null and a quoted empty one is '': no field equals NULL_TEXT. With ``newlines`` (the default for
    commas) quoted fields may go over several lines, and a file is one task's work; without it large files are split.
    """
    paths = [paths] if isinstance(paths, str) else paths
    header = read_header(spark, paths[0], sep)
    reader = (
        spark.read.schema(_text_schema(header))
        .option("header", True).option("sep", sep).option("mode", "PERMISSIVE")
        .option("quote", '"').option("escape", '"').option("enforceSchema", True)
        .option("multiLine", sep == "," if newlines is None else newlines).option("nullValue", NULL_TEXT)
    )
    return reader.csv(paths)


def read_matching(spark: SparkSession, folder: str, pattern: str, columns: list[str], newlines: bool = True) -> DataFrame:
    """All matching CSV files as one table of the wanted columns.

    Files with the same first line share one scan, and only one of them is read for its header; different headers are aligned.
    """
    paths = list_files(spark, folder, pattern)
    by_header: dict[str, list[str]] = {}
    for path, line in zip(paths, first_lines(spark, paths)):
        by_header.setdefault(line, []).append(path)
    tables = [
        select_existing(clean_names(read_delimited(spark, same, newlines=newlines)), columns)
        for same in by_header.values()
    ]
    if len(tables) == 1:
        return tables[0]
    merged = align_union(*tables)
    return select_existing(merged, columns)


def read_au_statements(spark, folder, newlines=True):
    return read_matching(spark, folder, "au_*.csv", AU_STATEMENT_COLUMNS, newlines)


def read_uk_statements(spark, folder, newlines=True):
    return read_matching(spark, folder, "StatementSummaries*.csv", UK_STATEMENT_COLUMNS, newlines)


def _read_file(spark, path, columns, sep=",", newlines=False):
    """A registry holds one row a line, so that its large files are split."""
    table = clean_names(read_delimited(spark, path, sep, newlines))
    return clean_names(select_existing(table, columns), quote_free=True)


def read_ca_statements(spark, path, newlines=True):
    return _read_file(spark, path, CA_STATEMENT_COLUMNS, newlines=newlines)


def read_ca_registry(spark, path, newlines=False):
    return _read_file(spark, path, CA_REGISTRY_COLUMNS, newlines=newlines)


def read_uk_registry(spark, path, newlines=False):
    return _read_file(spark, path, UK_REGISTRY_COLUMNS, newlines=newlines)


def read_au_registry(spark, path):
    return _read_file(spark, path, AU_REGISTRY_COLUMNS, sep="\t")


def union_relaxed(*tables: DataFrame) -> DataFrame:
    """Rows of all tables; columns that differ in type become text."""
    return tables[0] if len(tables) == 1 else align_union(*tables)
