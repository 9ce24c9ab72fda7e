"""Answers that come twice, and pages whose responses come in two tables."""

from ledgerline.operators import responses as r
from ledgerline.operators import signatures
from ledgerline.plans import jobs

ANSWERS = "source_id string, page_number int, kind string, response string, arrival int"


def test_the_latest_answer_counts(spark):
    rows = spark.createDataFrame(
        [("s", 1, "text", "zz", 1), ("s", 1, "text", "aa", 2), ("s", 1, "tables", "t", 5), ("s", 2, "text", "same", 1),
         ("s", 2, "text", "same", 1), ("s", 3, "text", "b", 4), ("s", 3, "text", "a", 4), ("s", 4, "text", None, 9), ("s", 4, "text", "kept", 1),
         (None, 1, "other", "x", 1)], ANSWERS)
    got = {(x.source_id, x.page_number): (x.text, x.tables) for x in r.pages_wide(rows, ["text", "tables"], order="arrival").collect()}
    assert got == {("s", 1): ("aa", "t"), ("s", 2): ("same", None), ("s", 3): ("b", None), ("s", 4): ("kept", None), (None, 1): (None, None)}


def test_differing_answers_without_an_order_are_errors(spark):
    rows = spark.createDataFrame(
        [("s", 1, "text", "a", 1), ("s", 1, "text", "b", 2), ("s", 1, "tables", "t", 1), ("s", 2, "text", "a", 1), ("s", 2, "text", "a", 2),
         ("s", 3, "text", "a", 1), ("s", 3, "text", "b", 1), ("s", 3, "tables", "t", 1), ("s", 3, "tables", "u", 1)], ANSWERS)
    got = {x.page_number: (x.text, x.tables, x.error) for x in r.pages_wide(rows, ["text", "tables"]).collect()}
    assert got == {1: (None, "t", "several different answers: text"), 2: ("a", None, None), 3: (None, None, "several different answers: text, tables")}


def test_documents_skip_and_signatures_report_such_pages(spark):
    analysis = "should_parse: true\nhas_text: true"
    rows = spark.createDataFrame(
        [("s", 1, "analysis", analysis, 1), ("s", 1, "text", "one", 1), ("s", 2, "analysis", analysis, 1), ("s", 2, "text", "two", 1), ("s", 2, "text", "2", 2),
         ("s", 2, "detection", "has_signatures: true", 1), ("s", 2, "detection", "has_signatures: false", 2)], ANSWERS)
    doc = jobs.build_documents(rows).first()
    assert (doc.final_markdown, doc.processed_pages, doc.skipped_pages) == ("one", 1, 1)
    latest = jobs.build_documents(rows, order="arrival").first()
    assert latest.final_markdown.split() == ["one", "---", "2"]
    records = jobs.build_signatures(rows).collect()
    assert [(x.page_number, x.Signature, x.Signature_Yes_text) for x in records] == [
        (2, "Error", "Processing Error: several different answers: detection")]
    assert jobs.build_signatures(rows, order="arrival").count() == 0


def test_pages_are_paired_on_source_and_number(spark):
    one = "source_id string, page_number int, response string, arrival int"
    found = spark.createDataFrame([("s", 1, "HAS_SIGNATURES: yes", 1), ("s", 2, "HAS_SIGNATURES: yes", 1), ("s", 4, "HAS_SIGNATURES: no", 1),
                                   ("s", 4, "HAS_SIGNATURES: yes", 2), ("t", 1, "HAS_SIGNATURES: no", 1)], one)
    read = spark.createDataFrame([("s", 1, "SIGNATORY_1:\nNAME: Ann", 1), ("s", 3, "SIGNATORY_1:\nNAME: Bob", 1), ("s", 4, "SIGNATORY_1:\nNAME: Cy", 1),
                                  ("t", 1, "", 1)], one)
    pairs = {(x.source_id, x.page_number): (x.detection, x.extraction, x.error) for x in r.pair_pages(found, read).collect()}
    assert pairs == {
        ("s", 1): ("HAS_SIGNATURES: yes", "SIGNATORY_1:\nNAME: Ann", None), ("s", 2): ("HAS_SIGNATURES: yes", None, None),
        ("s", 3): (None, "SIGNATORY_1:\nNAME: Bob", None), ("s", 4): (None, "SIGNATORY_1:\nNAME: Cy", "several different answers: detection"),
        ("t", 1): ("HAS_SIGNATURES: no", "", None)}
    records = jobs.build_person_signatures(found, read).collect()
    assert sorted((x.source_id, x.page_number, x.Signature, x.Signature_Yes_text) for x in records) == [
        ("s", 1, "Yes", "Ann"), ("s", 2, "Error", "Processing Error: no extraction response"), ("s", 3, "Error", "Processing Error: no detection response"),
        ("s", 4, "Error", "Processing Error: several different answers: detection"), ("t", 1, "No", "")]
    latest = signatures.person_records(r.pair_pages(found, read, order="arrival")).collect()
    assert sorted((x.source_id, x.page_number, x.Signature_Yes_text) for x in latest) == [("s", 1, "Ann"), ("s", 4, "Cy"), ("t", 1, "")]


def test_a_source_with_most_pages_is_paired_by_page(spark):
    many = spark.range(20_000).selectExpr("'hot' AS source_id", "int(id) AS page_number", "'x' AS response")
    pairs = r.pair_pages(many, many.where("page_number % 2 = 0"))
    assert pairs.count() == 20_000 and pairs.where("extraction IS NULL").count() == 10_000
