from pyspark.sql import functions as F

from ledgerline.operators import documents as d
from ledgerline.operators import responses

ENTRIES = "array<struct<id:string,content:string>>"


def test_analysis_last_line_decides(values):
    text = ("PAGE_ANALYSIS:\n- should_parse: true\n- has_text: TRUE\n- has_tables: true\nhas_tables: no\n"
            "- has_figures: maybe\nshould_parse: has_signatures: true")
    found = values([text, "junk", None], d.page_analysis)
    assert found[0].asDict() == {
        "should_parse": True, "has_text": True, "has_tables": False, "has_figures": False, "has_signatures": False}
    assert not any(found[1]) and not any(found[2])


def entries(values, text, kind="TABLE"):
    return [tuple(e) for e in values([text], lambda c: d.sections(c, kind))[0]]


def test_sections(values):
    text = "intro\nTABLE_1\n| a | b |\n|---|---|\n\nTABLE_2\n  \nTABLE_3\nNOT_INFORMATIVE\nTABLE_1\nlast\n TABLE_9\nx TABLE_8"
    assert entries(values, text) == [("TABLE_1", "last\n TABLE_9\nx TABLE_8"), ("TABLE_3", "NOT_INFORMATIVE")]
    assert entries(values, "TABLE_1\nTABLE_2\nbody") == [("TABLE_2", "body")]
    assert entries(values, "FIGURE_12\n**Chart**", "FIGURE") == [("FIGURE_12", "**Chart**")]
    assert entries(values, "no sections") == [] and entries(values, None) == []


def integrated(spark, text, tables=(), figures=(), signatures=None, **flags):
    df = spark.createDataFrame([(text, list(tables), list(figures), list(signatures or []))],
                               f"t string, a {ENTRIES}, b {ENTRIES}, c {ENTRIES}")
    shown = d.integrate(
        F.col("t"), F.col("a"), F.col("b"), None if signatures is None else F.col("c"),
        **{k: F.lit(v) for k, v in flags.items()})
    return df.select(shown).first()[0]


def test_integration(spark):
    text = "# H\n\nBody [TABLE_1] [TABLE_2] [TABLE_9]\n\n\n\n[FIGURE_1][SIGNATURE_1]\n"
    tables = [("TABLE_1", "costs $1 \\2"), ("TABLE_2", " NOT_INFORMATIVE ")]
    out = integrated(spark, text, tables, [("FIGURE_1", "**C**")])
    assert out == ("# H\n\nBody \n\n## Table 1\n\ncosts $1 \\2\n\n \n\n"
                   "[TABLE_2] - NOT_INFORMATIVE table (not parsed)\n\n [TABLE_9]\n\n## Figure 1\n\n**C**")
    assert integrated(spark, text, has_tables=False, has_figures=False, has_signatures=True) == (
        "# H\n\nBody   \n\n[SIGNATURE_1]")
    assert integrated(spark, "", tables) == "" and integrated(spark, None, tables) == ""


def test_integration_twice_changes_nothing(spark):
    once = integrated(spark, "a [TABLE_1]\n\n\n\nb", [("TABLE_1", "x")])
    assert integrated(spark, once, [("TABLE_1", "x")]) == once


def test_signature_block_of_a_published_page(spark):
    row = {
        "has_signature": True, "signatory_text": "Jane Roe\nChief Executive Officer", "signature_date": "",
        "confidence": "high", "is_image_signature": False, "is_scanned": False,
    }
    df = spark.createDataFrame([tuple(row.values())],
                               "has_signature boolean, signatory_text string, signature_date string, confidence string,"
                               " is_image_signature boolean, is_scanned boolean")
    block = df.select(d.signature_markdown({k: F.col(k) for k in row})).first()[0]
    assert block == ("**Signature Information**\n- **Signatory:** Jane Roe\nChief Executive Officer\n"
                     "- **Detection confidence:** High\n")
    text = "approved\n\n[SIGNATURE_1]\n\n**Jane Roe**"
    out = integrated(spark, text, signatures=[("SIGNATURE_1", block)], has_signatures=True)
    assert out == ("approved\n\n## Signature 1\n\n**Signature Information**\n- **Signatory:** Jane Roe\n"
                   "Chief Executive Officer\n- **Detection confidence:** High\n\n**Jane Roe**")


ANALYSIS = "should_parse: {}\nhas_text: true\nhas_tables: true\nhas_figures: false\nhas_signatures: false"


def page_rows(spark, n, source="s"):
    rows = [(source, p, ANALYSIS.format("false" if p == 2 else "true"), f"page {p} [TABLE_1]", "TABLE_1\nt", None)
            for p in range(1, n + 1)]
    df = spark.createDataFrame(
        rows, "source_id string, page_number int, analysis string, text string, tables string, figures string")
    return d.with_analysis(df)


def test_documents_and_failures(spark):
    failed = spark.createDataFrame([("bad", "broken file")], "source_id string, error string")
    out = {r.source_id: r for r in d.build_documents(page_rows(spark, 3), failed=failed).collect()}
    assert (out["s"].total_pages, out["s"].processed_pages, out["s"].skipped_pages) == (3, 2, 1)
    assert out["s"].final_markdown == "page 1 \n\n## Table 1\n\nt\n\n---\n\npage 3 \n\n## Table 1\n\nt"
    assert (out["bad"].total_pages, out["bad"].final_markdown) == (0, "Processing failed: broken file")


def test_a_page_error_counts_as_skipped(spark):
    rows = page_rows(spark, 3).withColumn("error", F.when(F.col("page_number") == 1, F.lit("x")))
    stats = d.document_stats(rows).first()
    assert (stats.processed_pages, stats.skipped_pages, stats.total_tables) == (1, 2, 1)


def test_a_source_without_content_still_has_a_row(spark):
    rows = page_rows(spark, 2).filter("page_number = 2")
    out = d.build_documents(rows).first()
    assert (out.processed_pages, out.final_markdown) == (0, "")


def test_a_long_source_is_one_document(spark):
    """Over a thousand pages, delivered in any order, and pages numbered from 0."""
    out = d.build_documents(page_rows(spark, 1200).orderBy(F.desc("page_number"))).collect()
    assert [(r.total_pages, r.processed_pages, r.skipped_pages) for r in out] == [(1200, 1199, 1)]
    assert out[0].final_markdown == d.PAGE_RULE.join(
        f"page {n} \n\n## Table 1\n\nt" for n in range(1, 1201) if n != 2)
    from_zero = page_rows(spark, 4).withColumn("page_number", F.col("page_number") - 1)
    assert [r.total_pages for r in d.build_documents(from_zero).collect()] == [4]
    assert d.combine_pages(d.page_contents(from_zero)).count() == 1


def test_check_summary_and_limits(spark):
    contents = d.page_contents(page_rows(spark, 1).withColumn("text", F.lit("[TABLE_1] [TABLE_4] [FIGURE_2]")))
    check = d.integration_check(contents).first()
    assert (check.total_placeholders, check.remaining_placeholders, check.missing_tables) == (3, 1, ["[TABLE_4]"])
    assert d.page_summary(contents).first().summary == "Page 1: Extracted text, 1 table(s)"


def test_duplicate_responses_leave_one_page(spark):
    rows = spark.createDataFrame(
        [("s", 1, "text", "a"), ("s", 1, "text", "a"), ("s", 1, "tables", "b")],
        "source_id string, page_number int, kind string, response string")
    wide = responses.pages_wide(rows, ["text", "tables", "figures"])
    assert [tuple(r) for r in wide.collect()] == [("s", 1, "a", "b", None, None)]
