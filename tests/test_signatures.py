from pyspark.sql import functions as F

from ledgerline.operators import signatures as s
from ledgerline.operators import signers

DETECTION = """SIGNATURE_DETECTION:
- has_signatures: true
- signature_count: 2
- confidence: high

SIGNATURE_ANALYSIS:
SIGNATURE_1:
- signature_type: handwritten
- is_image: true
- is_scanned: false
- signature_block_format: formal
"""
EXTRACTION = """SIGNATORY_TEXT_1:
Oona Vell
Harbour Master

DATE_INFORMATION:
DATE_1:
- raw_date_text: 7 July 2021
- associated_signature: 1
- standardized_date: 2021-07-07
"""


def test_detection(values):
    found = values([DETECTION, "junk", None], s.parse_detection)
    assert (found[0].has_signatures, found[0].signature_count, found[0].confidence) == (True, 2, "high")
    # Section titles open blocks too, so the first block is the empty one.
    assert [b.signature_type for b in found[0].signatures_analysis] == ["unknown", "unknown", "handwritten"]
    numbered = values([DETECTION], lambda c: s.parse_detection(c, numbered_only=True))[0]
    assert [tuple(b) for b in numbered.signatures_analysis] == [("handwritten", True, False, "formal")]
    assert tuple(found[1])[:3] == (False, 0, "low")


def test_detection_keys_win_over_blocks(values):
    text = "SIGNATURE_1: confidence: medium\nsignature_count: none\nsignature_count: about 3\nconfidence: none"
    found = values([text], s.parse_detection)[0]
    assert (found.signature_count, found.confidence, found.signatures_analysis) == (3, "medium", [])


def test_extraction(values):
    found = values([EXTRACTION, "no sections", None], s.parse_extraction)
    assert found[0].signatory_texts == ["Oona Vell\nHarbour Master"]
    # The section title is the first, empty, date entry.
    assert [d.raw_date_text for d in found[0].dates] == ["", "7 July 2021"] and found[0].has_date
    assert (found[1].signatory_texts, found[1].dates, found[1].has_date) == ([], [], False)


def pages(spark, *rows):
    return spark.createDataFrame(list(rows), "source_id string, page_number int, detection string, extraction string")


def test_page_record(spark):
    made = s.signature_pages(pages(spark, ("a", 6, DETECTION, EXTRACTION), ("a", 7, "has_signatures: false", "")))
    row = made.collect()[0]
    assert made.count() == 1 and row.signatory_text == "Oona Vell\nHarbour Master"
    assert (row.is_image_signature, row.has_date, row.signature_date) == (False, False, "")
    plain = EXTRACTION.replace("DATE_INFORMATION:\n", "")
    dated = s.output_records(s.signature_pages(pages(spark, ("a", 6, DETECTION, plain)), numbered_only=True)).first()
    assert (dated.Presence_Signature_date, dated.Signature_Date, dated.Signature_Image) == ("Yes", "2021-07-07", "Yes")


def test_published_record(spark):
    text = ("Jane Roe\nChief Executive Officer Vehicles Asia Pacific\n"
            "Managing Director Example Vehicles Australia Pty Ltd")
    raw = spark.createDataFrame(
        [(True, text, False, False, False, "", "dir_0", 6, "high")],
        "has_signature boolean, signatory_text string, is_image_signature boolean, is_scanned boolean,"
        " has_date boolean, signature_date string, source_id string, page_number int, confidence string")
    assert s.output_records(raw).first().asDict() == {
        "Signature": "Yes", "Signature_Yes_text": text.replace("\n", " "), "Signature_Image": "No",
        "Signature_scanned": "No", "Presence_Signature_date": "No", "Signature_Date": "", "source_id": "dir_0",
        "page_number": 6, "confidence": "high"}
    summary = s.source_summary(s.output_records(raw)).first()
    assert tuple(summary) == ("dir_0", 1, 0, 0, 0, 1)


def test_person_records(spark):
    yes = "HAS_SIGNATURES: yes\nSIGNATURE_COUNT: 1\nIS_IMAGE: no\nIS_SCANNED: no\nCONFIDENCE: High"
    people = "SIGNATORY_1:\nNAME: A B\nTITLE: CEO\nCOMPANY: Acme\nDATE: 3 May 2024\nSIGNATORY_2:\nNAME: C"
    made = s.person_records(pages(
        spark, ("a", 1, "HAS_SIGNATURES: no", ""), ("a", 2, yes, people), ("b", 1, yes, "NO_SIGNATURES_FOUND"),
        ("b", 2, "HAS_SIGNATURES: no", "")))
    got = [(r.source_id, r.page_number, r.Signature, r.Signature_Yes_text, r.Signature_Date, r.confidence)
           for r in made.orderBy("source_id", "page_number", "Signature_Yes_text").collect()]
    assert got == [("a", 1, "No", "", "", "N/A"), ("a", 2, "Yes", "A B | CEO | Acme", "2024-05-03", "high"),
                   ("a", 2, "Yes", "C", "", "high")]


def test_clean_text_and_parts(values):
    assert values(["  A\n\tB* (x/y), é_1 “q”", None], s.clean_signatory) == ["A B (x/y), é_1 q", ""]
    parts = values(["John Smith", "jane, managing director", "Acme Holdings Limited", ""],
                   lambda c: F.struct(*[v.alias(k) for k, v in s.signatory_parts(c).items()]))
    assert [tuple(p) for p in parts] == [
        ("John Smith", "", ""), ("", "jane, managing director", ""),
        ("Acme Holdings Limited", "", "Acme Holdings Limited"), ("", "", "")]


def test_errors_and_consolidation(spark):
    failed = spark.createDataFrame([("a", "boom")], "source_id string, error string")
    row = s.error_records(failed).first()
    assert (row.Signature, row.Signature_Yes_text, row.page_number, row.confidence) == (
        "Error", "Processing Error: boom", 0, "error")
    thin = spark.createDataFrame([("x", "Yes")], "source_id string, Signature string")
    assert s.consolidated(thin).columns == s.OUTPUT_COLUMNS + ["source_id"]
    assert s.consolidated(thin).first().Signature_Date == ""


def test_corpus_summary_counts_sources_without_records(spark):
    records = s.error_records(spark.createDataFrame([("a", "x")], "source_id string, error string"))
    sources = spark.createDataFrame([("a",), ("b",), ("c",)], "source_id string")
    failed = spark.createDataFrame([("c",)], "source_id string")
    assert tuple(s.corpus_summary(records, sources, failed).first()) == (3, 2, 1, 0)


def hits(spark, text):
    df = spark.createDataFrame([(1, text)], "doc int, text string")
    made = signers.signer_hits(df, ["doc"]).orderBy("line_no").collect()
    return [(r.line_no, r.name, r.role) for r in made]


def test_signers(spark):
    text = "Intro\r\nSigned by John Smith\n\n•  on behalf\nTitle: Director"
    assert hits(spark, text) == [(1, "John Smith", "Director"), (3, None, "Director")]
    assert hits(spark, "firmado por Juan Pérez") == [(0, "Juan Pérez", None)]
    assert hits(spark, "Manager Maria Torres Ruiz") == [(0, "Manager Maria Torres Ruiz", None)]
    assert hits(spark, "Firma: ANA LÓPEZ") == [] and hits(spark, "firmamento Signedby A") == []
    assert hits(spark, "Signed here") == [] and hits(spark, "nothing at all") == []


def test_signer_rows_keep_pages_without_hits(spark):
    df = spark.createDataFrame([(1, "plain"), (2, "Signed by John Smith"), (3, "the director said")], "doc int, text string")
    made = signers.signer_rows(df, ["doc"]).orderBy("doc").collect()
    assert [(r.doc, r.name, r.raw_text_len) for r in made] == [(1, None, 5), (2, "John Smith", 20), (3, None, 17)]


def test_context_reaches_five_lines(spark):
    df = spark.createDataFrame([(1, "\n".join(f"l{i}" for i in range(20)))], "doc int, text string")
    row = signers.line_context(df, ["doc"]).filter("line_no = 10").first()
    assert row.context.split("\n") == [f"l{i}" for i in range(5, 16)]


def test_every_kind_of_space_and_break(values):
    text = "a • b\x0bc\x85d  e\r\n\n\t f\x1fg\rh"
    assert values([text], signers.clean_lines) == [["a b", "c", "d e", "f g", "h"]]
