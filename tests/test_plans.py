"""Plans hold the shapes that let them grow."""

import io
from contextlib import redirect_stdout

import pytest

from ledgerline.operators import expand, selection
from ledgerline.plans import profiles
from ledgerline.plans.inputs import load, table
from ledgerline.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
# Queries that only project, filter or parse: nothing moves between tasks.
NARROW = [
    "clean_strings", "clean_typed", "parse_dates_iso", "normalize_name", "match_key", "size_band",
    "standardize", "detect_country", "country_filter", "normalize_date", "table_sections", "sig_detection",
    "sig_extraction", "sig_v2_records", "sig_v5_parse", "absolute_urls", "clean_records", "register_rows",
]


def plan(df) -> str:
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", NARROW)
def test_no_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Exchange" not in text and "Python" not in text and "InPandas" not in text


@pytest.mark.parametrize("name", ["uk_profiles", "au_profiles", "ca_fuzzy_join", "source_summary", "document_result",
                                  "all_countries", "signer_rows", "detection_select", "country_summary"])
def test_no_cartesian_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_top_row_is_cut_before_the_shuffle(spark):
    cleaned = profiles.uk_clean_statements(load(spark, FOLDER, "uk_statements"))
    text = plan(selection.latest_per_key(cleaned, "CompanyNumber", "StatementYear", ["statement_seq"]))
    assert text.count("WindowGroupLimit") >= 2 and text.count("+- Exchange") == 1


def test_unique_statements_are_cut_before_the_shuffle(spark):
    cleaned = profiles.au_clean_statements(load(spark, FOLDER, "au_statements"))
    assert plan(expand.unique_statements(cleaned, ["statement_seq"])).count("WindowGroupLimit") >= 2


def test_scan_reads_only_what_is_used(spark):
    text = plan(QUERIES["size_band"](spark, FOLDER))
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_filters_reach_the_scan(spark):
    text = plan(table(spark, FOLDER, "orders").filter("o_custkey = 5").select("o_orderkey"))
    assert "EqualTo(o_custkey,5)" in text


def test_signers_need_no_shuffle(spark):
    rows = load(spark, FOLDER, "signer_pages")
    from ledgerline.operators import signers

    text = plan(signers.signer_hits(rows, ["doc_id", "page_number"]))
    assert "Exchange" not in text and "collect_list" not in text


def test_registry_join_works_its_left_side_out_once(spark):
    text = plan(QUERIES["au_profiles"](spark, FOLDER)).split("\n(1) ")[0]
    assert text.count("Join") == 4 and text.count("Generate") == 2
