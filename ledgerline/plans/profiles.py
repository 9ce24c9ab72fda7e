"""Company profiles of three countries: statements, registry, measures, one schema.

Each function takes and returns DataFrames, so a profile is one lazy plan; the
column names are those of the source files without dots and spaces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import day_first_date, iso_date, parse_dates
from ..functions.measures import (
    additive_score, in_set, joined_address, list_length, MAJOR_PROVINCES, period_days, recency,
    size_band, years_between,
)
from ..functions.text import blank_to_null, clean_columns, strip
from ..operators.expand import expand_entities, unique_statements
from ..operators.joins import best_parent_join, registry_join
from ..operators.schema import key_first, standardize
from ..operators.selection import latest_per_key, prefer_current


# --- Australia ---

def au_clean_statements(df: DataFrame) -> DataFrame:
    return parse_dates(clean_columns(df, ["acn", "abn"]), ["period_start", "period_end"])


def au_clean_registry(df: DataFrame) -> DataFrame:
    cleaned = clean_columns(df, ["ACN", "ABN", "Company_Name", "Current_Name"])
    return parse_dates(
        cleaned, ["Date_of_Registration", "Date_of_Deregistration", "Current_Name_Start_Date"], iso_date
    )


def au_entities(statements: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    """One row per entity of every unique statement."""
    unique = unique_statements(au_clean_statements(statements), tiebreak)
    return expand_entities(unique).withColumn("statement_year", F.year("period_end")).drop(
        "statement_unique_id"
    )


def au_join_sides(
    statements: DataFrame, registry: DataFrame, tiebreak: list[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Entities and companies, each with its key in ``ABN``."""
    entities = au_entities(statements, tiebreak).withColumns({
        "abn": blank_to_null(F.col("abn")),
        "entity_name_normalized": F.upper(strip(F.col("reporting_entities"))),
    }).withColumnRenamed("abn", "ABN")
    companies = au_clean_registry(prefer_current(registry, "ABN", "Current_Name_Indicator"))
    companies = companies.withColumns({
        "ABN": blank_to_null(F.col("ABN")),
        "company_name_normalized": F.upper(strip(F.col("Company_Name"))),
    })
    return entities, companies


def au_profiles(statements: DataFrame, registry: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    entities, companies = au_join_sides(statements, registry, tiebreak)
    # preferring current names loses no ABN
    abns = registry.select(blank_to_null(F.col("ABN").cast("string")).alias("ABN")) if "ABN" in registry.columns else None
    # expanding unique statements adds none
    listed = statements.select(F.explode(F.split(F.col("abn").cast("string"), ",")).alias("ABN")).distinct()
    joined = registry_join(entities, companies, "ABN", "ABN", "_asic", right_keys=abns,
                           left_keys=listed.select(blank_to_null(F.col("ABN")).alias("ABN")))
    return key_first(joined.withColumn("join_method", F.lit("ABN")), "ABN")


def au_measures(df: DataFrame) -> DataFrame:
    present = {
        "has_company_data": "Company_Name",
        "has_revenue_data": "annual_revenue",
        "has_statement_url": "statement_url",
        "has_pdf_url": "pdf_url",
        "has_industry_data": "industry_sectors",
    }
    has = {flag: F.col(c).isNotNull() for flag, c in present.items()}
    return df.withColumns({
        "company_age_at_statement": years_between(F.col("period_end"), F.col("Date_of_Registration")),
        "is_active": F.col("Status") == "Registered",
        "is_deregistered": F.col("Date_of_Deregistration").isNotNull(),
        "statement_period_days": period_days(F.col("period_start"), F.col("period_end")),
        "is_multi_entity_statement": F.col("group_entity_count") > 1,
        "num_headquarter_countries": list_length(F.col("headquartered_countries")),
        **has,
        "data_completeness_score": additive_score(
            *[has[f] for f in ("has_revenue_data", "has_statement_url", "has_pdf_url", "has_industry_data")]
        ),
    })


# --- Canada ---

def ca_clean_statements(df: DataFrame) -> DataFrame:
    return clean_columns(df, ["organization"], lower=["language"], whole_numbers=["year"])


def ca_clean_registry(df: DataFrame) -> DataFrame:
    return clean_columns(df, ["business_name", "business_id_no"], upper=["prov_terr"])


def ca_latest(statements: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    return latest_per_key(ca_clean_statements(statements), "organization", "year", tiebreak)


def ca_profiles(
    statements: DataFrame, registry: DataFrame, tiebreak: list[str] | None = None, **options
) -> DataFrame:
    return best_parent_join(
        ca_latest(statements, tiebreak), ca_clean_registry(registry), tiebreak=tiebreak, **options
    )


def ca_measures(df: DataFrame, current_year: int) -> DataFrame:
    present = {
        "HasPDFUrl": "pdf_url",
        "HasStatementUrl": "statement_url",
        "HasParentCompany": "parent_company",
        "HasSubsidiaries": "subsidiary_companies",
        "HasEmployeeCount": "total_no_employees",
        "HasNAICSCode": "derived_NAICS",
    }
    has = {flag: F.col(c).isNotNull() for flag, c in present.items()}
    return df.withColumns({
        **has,
        "IsActiveBusiness": F.col("status") == "Active",
        "InMajorProvince": in_set(F.col("prov_terr"), MAJOR_PROVINCES),
        "DataCompletenessScore": additive_score(
            *[has[f] for f in ("HasPDFUrl", "HasStatementUrl", "HasParentCompany", "HasNAICSCode")]
        ),
        "RecencyScore": recency(F.col("year"), current_year),
    })


# --- United Kingdom ---

UK_REGISTRY_DATES = ["DissolutionDate", "IncorporationDate", "Accounts_NextDueDate", "Accounts_LastMadeUpDate"]


def uk_clean_statements(df: DataFrame) -> DataFrame:
    return clean_columns(df, ["CompanyNumber"], whole_numbers=["StatementYear"])


def uk_clean_registry(df: DataFrame) -> DataFrame:
    cleaned = clean_columns(
        df, ["CompanyNumber"], whole_numbers=["Mortgages_NumMortCharges", "Mortgages_NumMortOutstanding"]
    )
    return parse_dates(cleaned, UK_REGISTRY_DATES, day_first_date)


def uk_latest(statements: DataFrame, tiebreak: list[str] | None = None) -> DataFrame:
    return latest_per_key(uk_clean_statements(statements), "CompanyNumber", "StatementYear", tiebreak)


def uk_profiles(
    statements: DataFrame, registry: DataFrame, tiebreak: list[str] | None = None
) -> DataFrame:
    numbers = clean_columns(statements.select("CompanyNumber"), ["CompanyNumber"])
    return registry_join(
        uk_latest(statements, tiebreak), uk_clean_registry(registry), "CompanyNumber", "CompanyNumber", "_ch",
        left_keys=numbers,
    )


# Compliance flags and the statement columns they read.
COMPLIANCE_FLAGS = {
    "HasOrgStructure": "StatementIncludesOrgStructure",
    "HasPolicies": "StatementIncludesPolicies",
    "HasRiskAssessment": "StatementIncludesRisksAssessment",
    "HasDueDiligence": "StatementIncludesDueDiligence",
    "HasTraining": "StatementIncludesTraining",
    "HasGoals": "StatementIncludesGoals",
}


def uk_measures(df: DataFrame, corrected_bands: bool = False) -> DataFrame:
    comply = {flag: F.col(c) == "Yes" for flag, c in COMPLIANCE_FLAGS.items()}
    risks = {f"HasRisk{i}": F.col(f"Risk{i}").isNotNull() for i in (1, 2, 3)}
    address = ["AddressLine1", "AddressLine2", "PostTown", "County", "PostCode"]
    return df.withColumns({
        "CompanyAgeAtStatement": F.col("StatementYear") - F.year("IncorporationDate"),
        **comply,
        **risks,
        "RiskAssessmentCompleteness": additive_score(*risks.values()),
        "ComplianceScore": additive_score(*comply.values()),
        "IsActive": F.col("CompanyStatus") == "Active",
        "IsDissolved": F.col("DissolutionDate").isNotNull(),
        "HasMortgageCharges": F.coalesce(F.col("Mortgages_NumMortCharges"), F.lit(0)) > 0,
        "FullRegisteredAddress": joined_address(*[F.col(f"RegAddress_{p}") for p in address]),
        "CompanySize": size_band(F.col("Turnover"), corrected_bands),
    })


# --- all of them ---

def build_profiles(
    statements: DataFrame,
    registry: DataFrame,
    country: str,
    current_year: int | None = None,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """The standard profile of a country: join, measures, standard names.

    ``current_year`` is needed for Canada, whose recency score counts from it.
    ``tiebreak`` names the statement columns that order equal rows, best a
    unique one; without it all columns do.
    """
    if country == "australia":
        out = au_measures(au_profiles(statements, registry, tiebreak))
    elif country == "canada":
        if current_year is None:
            raise ValueError("canada needs current_year")
        out = ca_measures(ca_profiles(statements, registry, tiebreak), current_year)
    elif country == "uk":
        out = uk_measures(uk_profiles(statements, registry, tiebreak))
    else:
        raise ValueError(f"unknown country: {country}")
    return standardize(out, country)
