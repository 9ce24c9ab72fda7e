"""Selection, expansion, joins, schema and reports on small rows and on skewed ones."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import expand, joins, report, schema, selection
from ledgerline.plans import profiles

DAY = datetime.date


def rows(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


def test_latest_prefers_a_missing_year_unless_told_otherwise(spark):
    df = spark.createDataFrame(
        [("A", 2020, 1), ("A", 2022, 2), ("B", None, 3), ("B", 2021, 4), ("", 2021, 5), (None, 2021, 6)],
        "k string, year int, seq int")
    assert rows(selection.latest_per_key(df, "k", "year", ["seq"]), "k") == [("A", 2022, 2), ("B", None, 3)]
    assert rows(selection.latest_per_key(df, "k", "year", ["seq"], nulls_last=True), "k")[1] == ("B", 2021, 4)


def test_prefer_current(spark):
    df = spark.createDataFrame(
        [("11", "Y", 1), ("11", None, 2), ("11", "N", 3), ("22", "N", 4), ("22", None, 5), (None, "Y", 6),
         (None, "N", 7), ("33", "Y", 8), ("33", "Y", 9)], "abn string, ind string, seq int")
    kept = rows(selection.prefer_current(df, "abn", "ind").select("seq"), "seq")
    assert [r[0] for r in kept] == [1, 4, 5, 6, 8, 9]


def test_detections(spark):
    data = [("s", 1, 0, 0.9), ("s", 1, 1, 0.7), ("s", 1, 2, 0.2), ("s", 2, 0, 0.5), ("s", 2, 1, 0.4),
            ("s", 3, 0, 0.3), ("s", 3, 1, 0.3)]
    df = spark.createDataFrame(data, "source_id string, page_number int, box int, confidence double")
    picked = selection.select_detections(df, ["source_id", "page_number"], ["box"])
    assert rows(picked.filter("picked").select("page_number", "box", "forced_pick"), "page_number", "box") == [
        (1, 0, False), (1, 1, False), (2, 0, True), (3, 0, True)]
    none = selection.select_detections(df, ["source_id", "page_number"], ["box"], ensure_one=False)
    assert none.filter("picked").count() == 2
    equal = spark.createDataFrame([("s", 1, None, 0.2)] * 3, "source_id string, page_number int, box int, confidence double")
    assert selection.select_detections(equal, ["source_id", "page_number"], ["box"]).filter("forced_pick AND picked").count() == 1


def brute_expand(statements):
    """Plain Python for the same rule, as a check."""
    unique = {}
    for s in sorted(statements, key=lambda s: s[0]):
        seq, idx, start, end, abn = s
        uid = None if None in (idx, start, end) else f"{idx}_{start}_{end}"
        unique.setdefault(uid, s)
    groups = {}
    for uid, (seq, idx, start, end, abn) in sorted(unique.items(), key=lambda kv: (kv[0] is not None, kv[0] or "")):
        for one in [None] if abn is None else [p.strip() for p in abn.strip().split(",")]:
            groups.setdefault(idx, []).append((seq, one))
    out = []
    for idx, members in groups.items():
        known = sum(one is not None for _, one in members)
        out += [(seq, one, known, i, i == 0) for i, (seq, one) in enumerate(members)]
    return sorted(out, key=str)


def expanded(spark, statements):
    df = spark.createDataFrame(
        statements, "statement_seq int, idx string, period_start date, period_end date, abn string")
    made = expand.expand_entities(expand.unique_statements(df, ["statement_seq"]))
    return made.select("statement_seq", "abn", "group_entity_count", "entity_index_in_group", "is_primary_entity")


def test_expand_small_cases(spark):
    a, b = DAY(2020, 1, 1), DAY(2020, 12, 31)
    data = [(1, "1", a, b, "11, 22,33"), (2, "2", a, b, "44"), (3, "3", a, b, None), (4, "4", a, b, ""),
            (5, "5", a, b, "5"), (6, "5", DAY(2019, 1, 1), b, "6,7"), (7, "6", a, None, "9"), (8, "7", a, None, "8"),
            (9, "5", a, b, "99")]
    got = sorted([tuple(r) for r in expanded(spark, data).collect()], key=str)
    assert got == brute_expand(data)
    assert ("22", 3, 1, False) in [r[1:] for r in got] and (3, None, 0, 0, True) in got


def test_expand_one_idx_with_a_third_of_the_rows(spark):
    pick = random.Random(7)
    data = []
    for seq in range(1500):
        idx = "hot" if seq % 3 == 0 else str(pick.randrange(200))
        start = DAY(2018, 1, 1) + datetime.timedelta(days=pick.randrange(400))
        abn = pick.choice([None, "", "1", "1,2", " 3 , 4,5"])
        data.append((seq, idx, start, start + datetime.timedelta(days=pick.randrange(3)), abn))
    assert sorted([tuple(r) for r in expanded(spark, data).collect()], key=str) == brute_expand(data)


def test_registry_join_fans_out_and_never_matches_null(spark):
    left = spark.createDataFrame([(1, "33"), (2, None), (3, "44")], "seq int, abn string")
    right = spark.createDataFrame([("33", "a", 9), ("33", "b", 8), (None, "c", 7)], "abn string, name string, seq int")
    joined = joins.registry_join(left, right, "abn", "abn", "_r")
    assert joined.columns == ["seq", "abn", "name", "seq_r"]
    assert rows(joined, "seq", "name") == [(1, "33", "a", 9), (1, "33", "b", 8), (2, None, None, None),
                                          (3, "44", None, None)]
    stats = joins.join_stats(left, right, "abn", "abn", "name").first()
    assert tuple(stats)[:4] == (3, 2, 1, 2) and stats.join_rate == pytest.approx(100 / 3)


def test_parent_join_keeps_one_row_per_parent(spark):
    statements = spark.createDataFrame(
        [(1, "o1", "Acme Inc."), (2, "o2", "Acme Inc."), (3, "o3", None), (4, "o4", None), (5, "o5", "Zed")],
        "statement_seq int, organization string, parent_company string")
    registry = spark.createDataFrame(
        [(2, "Acme Ltd"), (1, "ACME"), (3, "Zed"), (4, None)], "idx int, business_name string")
    fuzzy = joins.one_row_per_parent(statements, registry, True)
    assert rows(fuzzy.select("parent_company", "organization", "idx"), "organization") == [
        ("Acme Inc.", "o1", 1), (None, "o3", None), ("Zed", "o5", 3)]
    assert joins.one_row_per_parent(statements, registry, True, keep_null_keys=True).count() == 4
    assert tuple(joins.matched_parents(statements, registry).first()) == (1, 2)
    best = joins.best_parent_join(statements, registry).select("parent_company", "business_name", "parent_company_match_key")
    assert rows(best.drop("parent_company_match_key"), "parent_company") == [(None, None), ("Acme Inc.", "ACME"), ("Zed", "Zed")]
    exact = joins.best_parent_join(statements, registry.filter("business_name = 'Zed'"))
    assert rows(exact.select("parent_company", "idx"), "parent_company") == [(None, None), ("Acme Inc.", None), ("Zed", 3)]
    assert exact.columns == joins.best_parent_join(statements, registry).columns


def test_standard_names(spark):
    df = spark.createDataFrame([("1", "A")], "ABN string, `Company Name` string")
    assert schema.standardize(df, "australia").columns == ["abn", "company_name", "data_country"]
    dotted = spark.createDataFrame([("x", "y")], "`RegAddress.PostTown` string, `Accounts.LastMadeUpDate` string")
    assert schema.standardize(dotted, "uk", add_country=False).columns == ["post_town", "accounts_last_made_date"]
    assert schema.standardize(schema.clean_names(dotted, quote_free=True), "uk", False).columns == [
        "post_town", "accounts_last_made_date"]
    with pytest.raises(ValueError):
        schema.standardize(df, "peru")


def test_align_is_free_of_order_and_safe_with_mixed_types(spark):
    a = spark.createDataFrame([(1, "x")], "id int, only_a string")
    b = spark.createDataFrame([("n/a", 2.5)], "id string, only_b double")
    one, two = schema.align_union(a, b), schema.align_union(b, a)
    assert one.schema == two.schema and one.columns == ["id", "only_a", "only_b"]
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert schema.common_columns(a, b) == ["id"] and schema.common_columns() == []
    assert rows(schema.common_columns_table(a, b)) == [("id",)]


def test_reports(spark):
    df = spark.createDataFrame([("a", None), (None, None), ("a", "x")], "organization_name string, company_name string")
    assert {r.field: r.completeness for r in report.completeness(df, digits=1).collect()} == {
        "organization_name": 66.7, "company_name": 33.3}
    assert df.agg(report.n_unique("organization_name")).first()[0] == 2
    assert report.completeness(df.limit(0)).filter("completeness is null").count() == 2
    top = report.duplicate_keys(df, "organization_name")
    assert rows(top) == [("a", 2)]
    shares = report.share_distribution(df, "company_name", "NO_MATCH")
    assert {r.company_name: r["count"] for r in shares.collect()} == {"NO_MATCH": 2, "x": 1}
    empty = report.crawl_stats(df.limit(0), F.col("company_name").isNotNull()).first()
    assert tuple(empty) == (0, 0, 0, 0.0)


def test_profile_needs_its_parameters(spark):
    with pytest.raises(ValueError):
        profiles.build_profiles(None, None, "peru")
    with pytest.raises(ValueError):
        profiles.build_profiles(None, None, "canada")


def test_distinct_first_seen(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 0), ("a", 5)], "u string, n int")
    assert rows(selection.distinct_first_seen(df, "u", ["n"])) == [("b", 0), ("a", 1)]


def test_registry_join_of_a_key_hot_on_both_sides(spark):
    """Same rows as a plain left join, also for rows without a key or match; planning runs no job."""
    left = spark.createDataFrame(
        [(i, None if i % 3 == 0 else "hot" if i % 3 == 1 else str(i)) for i in range(60)], "seq int, k string")
    right = spark.createDataFrame(
        [("hot", i) for i in range(50)] + [(str(i), i) for i in range(0, 60, 2)] + [(None, 1)], "k string, n int")
    plain = left.join(right, "k", "left").select("seq", "k", "n")
    spark.sparkContext.setJobGroup("planning", "")
    made = joins.registry_join(left, right, "k", "k", "_r").select("seq", "k", "n")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("planning")
    assert sorted(map(str, made.collect())) == sorted(map(str, plain.collect()))
    first = right.filter("k is not null").dropDuplicates(["k"]).withColumn("n", F.lit(1))
    made = joins.registry_join(left, first, "k", "k", "_r", unique_right=True).select("seq", "k", "n")
    assert sorted(map(str, made.collect())) == sorted(map(str, left.join(first, "k", "left").select("seq", "k", "n").collect()))


def test_a_hot_current_name_key(spark):
    data = [("hot" if i % 3 == 0 else str(i % 40), "Y" if i % 7 == 0 else "N", i) for i in range(900)]
    df = spark.createDataFrame(data, "abn string, ind string, seq int")
    with_y = {a for a, ind, _ in data if ind == "Y"}
    want = sorted(seq for a, ind, seq in data if ind == "Y" or a not in with_y)
    assert sorted(r.seq for r in selection.prefer_current(df, "abn", "ind").collect()) == want
