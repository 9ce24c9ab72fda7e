"""The Australian register download, one row per statement."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import blank_to_null

# Register columns and the record fields they become.
REGISTER_FIELDS = {
    "IDX": "idx", "PeriodStart": "period_start", "PeriodEnd": "period_end", "Type": "statement_type",
    "HeadquarteredCountries": "headquartered_countries", "AnnualRevenue": "annual_revenue",
    "ReportingEntities": "reporting_entities", "IncludedEntities": "included_entities",
    "ABN": "abn", "ACN": "acn", "ARBN": "arbn", "Link": "statement_url",
    "IndustrySectors": "industry_sectors", "RelatedStatements": "related_statements",
}


def register_records(rows: DataFrame, country: str | None = None) -> DataFrame:
    """Rows of the register download as records of always the same fields.

    Blanks become null, and so do fields whose column the download lacks.
    """
    fields = [
        (blank_to_null(F.col(old).cast("string")) if old in rows.columns else F.lit(None).cast("string")).alias(new)
        for old, new in REGISTER_FIELDS.items()
    ]
    return rows.select(
        *fields,
        F.lit("AU").alias("jurisdiction"),
        F.lit("Australian Modern Slavery Register").alias("source_system"),
        F.lit(country).cast("string").alias("country_filter"),
    )
