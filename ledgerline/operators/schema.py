"""One column vocabulary for every country."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.names import to_snake

# Standard names that snake case alone does not give.
STANDARD_NAMES = {
    "australia": {
        "idx": "statement_id",
        "period_start": "statement_start_date",
        "period_end": "statement_end_date",
        "Date of Registration": "incorporation_date",
        "Date of Deregistration": "dissolution_date",
        "reporting_entities": "organization_name",
        "Current Name": "current_company_name",
        "entity_name_normalized": "organization_name_normalized",
        "included_entities": "subsidiary_companies",
        "Status": "company_status",
        "is_deregistered": "is_dissolved",
        "Current Name Indicator": "is_current_name",
        "headquartered_countries": "headquarter_countries",
        "Previous State of Registration": "previous_state_registration",
        "State Registration number": "state_registration_number",
        "Type": "company_type",
        "Class": "company_class",
        "Sub Class": "company_sub_class",
        "source_system": "data_source",
        "Modified since last report": "modified_since_last_report",
    },
    "canada": {
        "idx": "registry_id",
        "business_id_no": "business_id",
        "year": "statement_year",
        "organization": "organization_name",
        "business_name": "company_name",
        "alt_business_name": "company_name_alt",
        "parent_company_match_key": "parent_company_normalized",
        "title": "statement_title",
        "status": "company_status",
        "IsActiveBusiness": "is_active",
        "company_country": "country",
        "prov_terr": "province_state",
        "industry_sector": "industry_sectors",
        "derived_NAICS": "naics_code",
        "source_NAICS_primary": "naics_primary",
        "source_NAICS_secondary": "naics_secondary",
        "NAICS_descr": "naics_description",
        "NAICS_descr2": "naics_description_secondary",
        "total_no_employees": "employee_count",
        "provider": "data_provider",
        "HasPDFUrl": "has_pdf_url",
        "MatchedToBizRegistry": "has_registry_match",
        "HasNAICSCode": "has_naics_code",
    },
    "uk": {
        "URI": "company_uri",
        "LastUpdated": "date_updated",
        "Accounts.LastMadeUpDate": "accounts_last_made_date",
        "OrganisationName": "organization_name",
        "ParentName": "parent_company",
        "PreviousName_1.CompanyName": "previous_name_1",
        "PreviousName_2.CompanyName": "previous_name_2",
        "StatementURL": "statement_url",
        "PDFURL": "pdf_url",
        "RegAddress.AddressLine1": "address_line_1",
        "RegAddress.AddressLine2": "address_line_2",
        "RegAddress.PostTown": "post_town",
        "RegAddress.County": "county",
        "RegAddress.Country": "country",
        "RegAddress.PostCode": "post_code",
        "FullRegisteredAddress": "full_address",
        "OrganisationSectors": "industry_sectors",
        "SectorType": "business_sector",
        "SICCode.SicText_1": "sic_code_1",
        "SICCode.SicText_2": "sic_code_2",
        "SICCode.SicText_3": "sic_code_3",
        "SICCode.SicText_4": "sic_code_4",
        "Mortgages.NumMortCharges": "mortgage_charges",
        "Mortgages.NumMortOutstanding": "mortgages_outstanding",
        "Accounts.AccountCategory": "account_category",
        "StatementIncludesRisksAssessment": "statement_includes_risks",
        "Risk1": "risk_1",
        "Risk1Area": "risk_1_area",
        "Risk1Location": "risk_1_location",
        "Risk1Mitigation": "risk_1_mitigation",
        "Risk2": "risk_2",
        "Risk2Area": "risk_2_area",
        "Risk2Location": "risk_2_location",
        "Risk2Mitigation": "risk_2_mitigation",
        "Risk3": "risk_3",
        "Risk3Area": "risk_3_area",
        "Risk3Location": "risk_3_location",
        "Risk3Mitigation": "risk_3_mitigation",
        "HasRisk1": "has_risk_1",
        "HasRisk2": "has_risk_2",
        "HasRisk3": "has_risk_3",
        "GroupSubmission": "is_group_submission",
        "DemonstrateProgress": "demonstrates_progress",
        "HasProgressDemonstration": "has_progress_demonstration",
    },
}


def plain_name(name: str) -> str:
    """Header text as a name usable without quoting."""
    return name.strip().replace(".", "_").replace(" ", "_")


def clean_names(df: DataFrame, quote_free: bool = False) -> DataFrame:
    """Header names without outer spaces; ``quote_free`` also drops dots and spaces."""
    tidy = plain_name if quote_free else str.strip
    return df.toDF(*[tidy(c) for c in df.columns])


def select_existing(df: DataFrame, columns: list[str]) -> DataFrame:
    """The wanted columns that the table has, in the wanted order."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{c}`") for c in columns if c in have])


def key_first(df: DataFrame, key: str) -> DataFrame:
    return df.select(key, *[c for c in df.columns if c != key])


def standard_name(name: str, country: str) -> str:
    names = STANDARD_NAMES[country]
    quote_free = {plain_name(k): v for k, v in names.items()}
    return to_snake(names.get(name) or quote_free.get(name) or name)


def snake_case(df: DataFrame) -> DataFrame:
    return df.toDF(*[to_snake(c) for c in df.columns])


def standardize(df: DataFrame, country: str, add_country: bool = True) -> DataFrame:
    """Standard names plus the country; one projection, no data moves."""
    if country not in STANDARD_NAMES:
        raise ValueError(f"unknown country: {country}")
    out = df.toDF(*[standard_name(c, country) for c in df.columns])
    return out.withColumn("data_country", F.lit(country)) if add_country else out


def common_columns(*tables: DataFrame) -> list[str]:
    shared = set.intersection(*[set(t.columns) for t in tables]) if tables else set()
    return sorted(shared)


def common_columns_table(*tables: DataFrame) -> DataFrame:
    spark = tables[0].sparkSession
    return spark.createDataFrame([(c,) for c in common_columns(*tables)], "column_name string")


def align(*tables: DataFrame) -> list[DataFrame]:
    """Every table with the sorted union of the columns, missing ones null.

    A column with different types becomes text in all tables, so that a text
    that is no number cannot fail the union.
    """
    seen: dict[str, set] = {}
    for table in tables:
        for field in table.schema:
            if not isinstance(field.dataType, T.NullType):
                seen.setdefault(field.name, set()).add(field.dataType)
    types = {c: (next(iter(t)) if len(t) == 1 else T.StringType()) for c, t in seen.items()}
    names = sorted({c for t in tables for c in t.columns})

    def column(table: DataFrame, name: str):
        target = types.get(name, T.StringType())
        have = name in table.columns
        return (F.col(f"`{name}`") if have else F.lit(None)).cast(target).alias(name)

    return [t.select(*[column(t, c) for c in names]) for t in tables]


def align_union(*tables: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionAll, align(*tables))
