"""Registry joins and their statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.names import match_key
from .selection import keep_first, total_order

# Tasks' worth of keys over which rows without a key are dealt.
SPREAD = 1024


def _renamed(right: DataFrame, right_key: str, taken: list[str], suffix: str) -> DataFrame:
    """Registry with its key as ``_rkey`` and colliding names suffixed."""
    lowered = {c.lower() for c in taken}

    def name(c: str) -> str:
        return "_rkey" if c == right_key else c + suffix if c.lower() in lowered else c

    return right.select(*[F.col(c).alias(name(c)) for c in right.columns])


def registry_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    suffix: str,
    unique_right: bool = False,
    right_keys: DataFrame | None = None,
    left_keys: DataFrame | None = None,
) -> DataFrame:
    """Left join to a registry; registry columns that collide get a suffix. Keys are compared as text.

    One inner join, of which the adaptive skew join splits a hot key on either
    side (of a left join only on the left), so that the left side is worked out
    once: the registry gets an empty row for each left key that it lacks. Rows
    without a key match nothing; they are dealt over ``SPREAD`` empty rows, so
    they never gather in one partition.
    ``unique_right`` promises one registry row per key; then only the left side
    can be hot, and one left join does. ``right_keys`` is a table with the keys of
    the registry in ``right_key`` where that is cheaper to read than the registry, such
    as the table from which a step that loses no key made it; ``left_keys`` likewise
    has every key of the left side in ``left_key``, and may have more.
    """
    registry = _renamed(right.filter(F.col(right_key).isNotNull()), right_key, left.columns, suffix)
    if unique_right:
        keyed, same = left.filter(F.col(left_key).isNotNull()), F.col(left_key) == F.col("_rkey")
        lost = left.filter(F.col(left_key).isNull())
        joined = keyed.join(registry, same, "left").unionByName(lost, allowMissingColumns=True)
    else:
        at = lambda key: F.concat(F.lit("="), F.col(key).cast("string"))
        known = registry.select(at("_rkey").alias("_at")) if right_keys is None else right_keys.select(at(right_key).alias("_at"))
        met = (left if left_keys is None else left_keys).select(at(left_key).alias("_at")).filter("_at IS NOT NULL")
        lacking = met.distinct().join(known.distinct(), "_at", "left_anti")
        empty = left.sparkSession.range(SPREAD).select(F.col("id").cast("string").alias("_at"))
        rows = registry.withColumn("_at", at("_rkey")).unionByName(lacking.unionByName(empty), allowMissingColumns=True)
        dealt = F.pmod(F.xxhash64(*[c for c, kind in left.dtypes if "map<" not in kind]), F.lit(SPREAD)).cast("string")
        joined = left.withColumn("_at", F.coalesce(at(left_key), dealt)).join(rows, "_at").drop("_at")
    return joined.drop("_rkey") if left_key == right_key else joined.withColumnRenamed("_rkey", right_key)


def first_registry_rows(registry: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """One registry row per key value."""
    keyed = registry.withColumn("_match", key).filter(F.col("_match").isNotNull())
    return keep_first(keyed, ["_match"], order)


def one_row_per_parent(
    statements: DataFrame,
    registry: DataFrame,
    fuzzy: bool | Column,
    suffix: str = "_biz",
    keep_null_keys: bool = False,
    tiebreak: list[str] | None = None,
) -> DataFrame:
    """Parents joined to the registry by name, then one row per parent company.

    Only the first (organization, idx) pair of a parent survives, so each side
    is cut to its first row per key before the join: no key multiplies. All
    statements without a parent count as one parent unless ``keep_null_keys``.
    ``fuzzy`` may be a column of one value, such as a scalar subquery.
    ``parent_company_match_key`` holds the parent's name key either way.
    """
    order = [F.col("organization"), *total_order(statements, tiebreak)]
    parents = keep_first(statements, ["parent_company"], order)
    if keep_null_keys:
        orphans = statements.filter("parent_company is null")
        parents = parents.filter("parent_company is not null").unionByName(orphans)
    chosen = fuzzy if isinstance(fuzzy, Column) else F.lit(fuzzy)

    def key(c):
        return F.when(chosen, match_key(c)).otherwise(c)

    named = first_registry_rows(
        registry, key(F.col("business_name")), [F.col("idx"), *total_order(registry, tiebreak and ["idx"])]
    )
    parent = F.col("parent_company")
    parents = parents.withColumns({"parent_company_match_key": match_key(parent), "_key": key(parent)})
    return registry_join(parents, named, "_key", "_match", suffix, unique_right=True).drop("_key", "_match")


def matched_parents(statements: DataFrame, registry: DataFrame) -> DataFrame:
    """Distinct parents found in the registry by exact name and by name key, in one row."""
    name, parent = F.col("business_name"), F.col("parent_company")
    names = registry.select(name.alias("_name")).distinct().withColumn("_direct", F.lit(1))
    keys = registry.select(match_key(name).alias("_match")).distinct().withColumn("_fuzzy", F.lit(1))
    parents = statements.select(parent, match_key(parent).alias("_key")).distinct()
    found = parents.join(names, parent == F.col("_name"), "left").join(
        keys, F.col("_key") == F.col("_match"), "left"
    )
    return found.agg(F.count("_direct").alias("direct"), F.count("_fuzzy").alias("fuzzy"))


def best_parent_join(statements: DataFrame, registry: DataFrame, **options) -> DataFrame:
    """Match by name key only when that finds strictly more parents.

    The choice is a scalar subquery of one row, part of the same lazy plan.
    """
    fuzzy = matched_parents(statements, registry).select(F.col("fuzzy") > F.col("direct")).scalar()
    return one_row_per_parent(statements, registry, fuzzy, **options)


def join_stats(left: DataFrame, right: DataFrame, left_key: str, right_key: str, match: str) -> DataFrame:
    """Totals of a left join, without joining rows: joined rows, matched source rows, and the rate.

    Both sides are cut to (key, rows) first, so nothing fans out. A registry
    row is a match when its ``match`` column has a value.
    ``successful_joins`` counts joined rows, so duplicates in the registry can
    push it past the total; ``matched_rows`` counts each source row once.
    """
    sizes = right.filter(F.col(right_key).isNotNull()).groupBy(F.col(right_key).alias("_rkey")).agg(
        F.count(match).alias("_rows"))
    keys = left.groupBy(F.col(left_key).alias("_lkey")).agg(F.count("*").alias("_n"))
    counts = keys.join(sizes, F.col("_lkey") == F.col("_rkey"), "left").agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.col("_n") * F.col("_rows")), F.lit(0)).alias("successful_joins"),
        F.coalesce(F.sum(F.when(F.col("_rows") > 0, F.col("_n"))), F.lit(0)).alias("matched_rows"),
    )
    rate = F.when(F.col("total_records") > 0, F.col("matched_rows") / F.col("total_records") * 100)
    return counts.withColumns({
        "failed_joins": F.col("total_records") - F.col("matched_rows"),
        "join_rate": F.coalesce(rate, F.lit(0.0)),
    })
