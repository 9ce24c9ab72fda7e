"""Quality figures of a profile table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Fields whose completeness every report shows.
KEY_FIELDS = [
    "organization_name", "company_name", "incorporation_date",
    "company_status", "annual_revenue", "industry_sectors",
]


def _over_counts(total: Column) -> Column:
    """An aggregate beside every row of a table of counts, one row per value; the profile is planned and read once."""
    return total.over(Window.partitionBy(F.lit(1)))


def n_unique(name: str) -> Column:
    """Distinct values with null counted as one of them."""
    return F.count_distinct(F.col(name)) + F.coalesce(F.max(F.col(name).isNull().cast("int")), F.lit(0))


def _unpivot(df: DataFrame, columns: list[str], name: str, value: str) -> DataFrame:
    return df.unpivot([], columns, name, value)


def completeness(df: DataFrame, fields: list[str] = KEY_FIELDS, digits: int | None = None) -> DataFrame:
    """Share of non-null values per field in percent, all fields in one pass.

    Fields the table lacks are left out; on an empty table the share is null.
    """
    present = [f for f in fields if f in df.columns]
    total = F.nullif(F.count("*"), F.lit(0))

    def share(field: str) -> Column:
        raw = F.count(field) / total * 100
        return (F.bround(raw, digits) if digits is not None else raw).alias(field)

    return _unpivot(df.agg(*[share(f) for f in present]), present, "field", "completeness")


def mean_completeness(df: DataFrame, fields: list[str] = KEY_FIELDS) -> Column:
    """Mean of the fields' completeness as one aggregate expression."""
    present = [f for f in fields if f in df.columns]
    total = F.nullif(F.count("*"), F.lit(0))
    shares = sum((F.count(f) / total * 100 for f in present), F.lit(0.0))
    return shares / len(present) if present else F.lit(0.0)


def distribution(df: DataFrame, key: str, non_null: bool = False, top: int | None = None) -> DataFrame:
    """Rows per value, most frequent first, the value breaking ties."""
    rows = df.filter(F.col(key).isNotNull()) if non_null else df
    out = rows.groupBy(key).agg(F.count("*").alias("count"))
    if top is not None:
        return out.orderBy(F.desc("count"), F.asc(key)).limit(top)
    return out


def distributions(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows per value for several columns, in one pass and one shuffle."""
    pairs = F.array(*[F.struct(F.lit(k).alias("k"), F.col(k).cast("string").alias("v")) for k in keys])
    return (
        df.select(F.explode(pairs).alias("p"))
        .groupBy(F.col("p.k").alias("field"), F.col("p.v").alias("value"))
        .agg(F.count("*").alias("count"))
    )


def share_distribution(df: DataFrame, key: str, missing: str) -> DataFrame:
    """Rows and percentage per value, null shown as ``missing``."""
    counts = df.groupBy(F.coalesce(F.col(key), F.lit(missing)).alias(key)).agg(F.count("*").alias("count"))
    return counts.withColumn("percentage", F.col("count") / _over_counts(F.sum("count")) * 100)


def duplicate_keys(df: DataFrame, key: str, top: int = 5) -> DataFrame:
    counts = df.groupBy(key).agg(F.count("*").alias("count")).filter("count > 1")
    return counts.orderBy(F.desc("count"), F.asc(key)).limit(top)


def basic_counts(df: DataFrame, entity: str, statement: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_records"),
        n_unique(entity).alias("unique_entities"),
        n_unique(statement).alias("unique_statements"),
    )


def entity_structure(df: DataFrame) -> DataFrame:
    """Primary and subsidiary rows, single and multi entity rows, mean group size."""
    group = n_unique("statement_group_id")
    return df.agg(
        F.count_if("is_primary_entity").alias("primary_entities"),
        F.count_if(~F.col("is_primary_entity")).alias("subsidiary_entities"),
        F.count_if(F.col("group_entity_count") == 1).alias("single_entity_statements"),
        F.count_if(F.col("group_entity_count") > 1).alias("multi_entity_statements"),
        (F.count("*") / F.nullif(group, F.lit(0))).alias("avg_entities_per_statement"),
    )


def expansion_stats(df: DataFrame, entity: str = "abn", year: str = "statement_year") -> DataFrame:
    """Entities with and without an id, per statement year."""
    return df.groupBy(year).agg(
        F.count("*").alias("total_entities"),
        F.count(entity).alias("entities_with_id"),
        F.count_if(F.col(entity).isNull()).alias("entities_without_id"),
    )


def compliance_dist(df: DataFrame) -> DataFrame:
    """Rows per compliance score beside the mean over all rows."""
    counts = df.groupBy("compliance_score").agg(F.count("*").alias("count"))
    points = _over_counts(F.sum(F.col("compliance_score") * F.col("count")))
    scored = _over_counts(F.sum(F.when(F.col("compliance_score").isNotNull(), F.col("count"))))
    return counts.withColumn("average_score", points / scored)


def mean_scores(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """The mean of each score column, rounded half to even; null on an empty table."""
    return df.agg(*[F.bround(F.avg(c), digits).alias(c) for c in columns])


def country_summary(df: DataFrame, entity: str = "entity_key", statement: str = "statement_key",
                    matched: str = "is_matched", fields: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per country and one for all; the overall entities are the sum over countries.

    ``fields`` names the fields that each country's own profile has; a field that only other countries have must not count
    as empty. Without it every country is measured over all fields of the table.
    """
    completeness = mean_completeness(df) if fields is None else F.coalesce(
        *[F.when(F.col("data_country") == c, mean_completeness(df, own)) for c, own in fields.items()])
    per_country = df.groupBy("data_country").agg(
        F.count("*").alias("records"),
        n_unique(entity).alias("unique_entities"),
        n_unique(statement).alias("unique_statements"),
        completeness.alias("average_completeness"),
        (F.count_if(matched) / F.count("*") * 100).alias("join_success_rate"),
    )
    # Rolled up from the few country rows, so the profiles are read once.
    whole = F.grouping("data_country") == 1
    sums = [F.sum(c).alias(c) for c in ("records", "unique_entities", "unique_statements")]
    means = [
        F.when(~whole, F.max(c)).alias(c) for c in ("average_completeness", "join_success_rate")
    ]
    rolled = per_country.rollup("data_country").agg(*sums, *means, whole.alias("_whole"))
    country = F.when(F.col("_whole"), "all").otherwise(F.col("data_country"))
    return rolled.withColumn("data_country", country).drop("_whole")


def crawl_stats(df: DataFrame, ok: Column) -> DataFrame:
    """Extractions that worked and failed, and the rate (0 when there are none)."""
    good, total = F.count_if(ok), F.count("*")
    return df.agg(
        good.alias("successful_extractions"),
        (total - good).alias("failed_extractions"),
        total.alias("total_processed"),
        F.when(total > 0, good / total * 100).otherwise(0.0).alias("success_rate"),
    )


# Countries of the Australian register and the statements expected from each.
EXPECTED_STATEMENTS = [
    ("Australia", 11988),
    ("United States of America", 237),
    ("United Kingdom", 184),
    ("New Zealand", 128),
    ("Japan", 74),
    ("Germany", 52),
    ("Singapore", 43),
    ("Canada", 39),
    ("France", 39),
    ("Netherlands", 33),
]


def expected_vs_actual(df: DataFrame, country: str) -> DataFrame:
    """Expected and actual statements for each country of the register."""
    expected = df.sparkSession.createDataFrame(EXPECTED_STATEMENTS, "country string, expected bigint")
    actual = df.groupBy(F.col(country).alias("country")).agg(F.count("*").alias("n"))
    found = F.coalesce("n", F.lit(0))
    status = (
        F.when(found == 0, "no data").when(found == F.col("expected"), "match").otherwise("differs")
    )
    return expected.join(actual, "country", "left").select(
        "country", "expected", found.alias("actual"), status.alias("status")
    )
