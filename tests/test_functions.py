import datetime
from urllib.parse import urljoin

from pyspark.sql import functions as F

from ledgerline.functions import dates, measures, names, text, urls


def test_strip_takes_every_space_and_squeeze_joins_them(values):
    assert values(["\t a b\n", " x　", None, ""], text.strip) == ["a b", "x", None, ""]
    assert values(["a \t\n b c"], text.squeeze) == ["a b c"]


def test_blank_and_first_replacement(values):
    assert values([" ", "", None, " x "], text.blank_to_null) == [None, None, None, "x"]
    assert values(["a, , b, , c"], lambda c: text.replace_first(c, ", ,", ",")) == ["a, b, , c"]


def test_company_names(values):
    items = ["Acme Consulting Inc.", "Acme Corporation", "ACME  Co., Ltd.", "Acme Inc Holdings",
             "Société Générale Ltée", "Inc", None]
    assert values(items, names.normalize_company_name) == [
        "acmensulting", "acmeoration", "acme", "acme holdings", "société générale ltée", "inc", ""]
    assert values(items, names.match_key) == [
        "acme consulting", "acme", "acme", "acme  holdings", "société générale ltée", "", None]


def test_snake_case():
    pairs = {
        "RegAddress.PostTown": "reg_address_post_town", "HasRisk1": "has_risk1", "PDFURL": "pdfurl",
        "Company Name": "company_name", "_x__Y": "x_y", "statement_seq": "statement_seq", "IsUKFirm": "is_uk_firm",
    }
    assert {k: names.to_snake(k) for k in pairs} == pairs


def test_dates_in_and_out_of_range(values):
    day = datetime.date
    assert values(["2020-01-05", "31-12-2020", None, "2020-13-01"], dates.iso_date) == [
        day(2020, 1, 5), None, None, None]
    assert values(["05/03/2020", "5/3/2020", "31/31/2020"], dates.day_first_date) == [
        day(2020, 3, 5), day(2020, 3, 5), None]


def test_normalized_dates(values):
    items = ["2024-03-15x", "03/04/2024", "25/12/2024", "2024/1/5", "March 5, 2024", "5 march  2024", "soon", "",
             None, "1-2-2024"]
    yes = lambda c: dates.normalize_date(c, F.lit(True))
    assert values(items, yes) == [
        "2024-03-15x", "2024-03-04", "2024-12-25", "2024-01-05", "2024-03-05", "2024-03-05", "soon", "", "",
        "2024-01-02"]
    assert values(["2024-03-15"], lambda c: dates.normalize_date(c, F.lit(False))) == [""]
    more = ["5/3/24", "03 May 24", "May 3, 2024", "2024-05-03T10:00:00", "2024-05-03 10:00", "3rd of May 2024", "2024.05.03"]
    assert values(more, dates.normalize_free_date) == ["2024-05-03"] * 7
    odd = ["Sept 3, 2024", "25/12/24", "May 2024", "2024-05-03Tx"]
    assert values(odd, dates.normalize_free_date) == ["2024-09-03", "2024-12-25", "May 2024", "2024-05-03Tx"]
    free = ["3 May 2024", "May 3rd, 2024", "Fri, 3 May 2024", "3-May-2024", "20240503", "someday", ""]
    assert values(free, dates.normalize_free_date) == ["2024-05-03"] * 5 + ["someday", ""]


def test_measures(values):
    turnover = ["0-25", "25-50", "50-250", "250+", "Under £36 million", None]
    assert values(turnover, measures.size_band) == ["Micro", "Small", "Micro", "Large", "Unknown", "Unknown"]
    assert values(turnover, lambda c: measures.size_band(c, True))[2] == "Medium"
    assert values(["Australia, Japan", None, "x"], measures.list_length) == [2, 0, 1]
    assert values([2025, 2021, 2010, 2030, None], lambda c: measures.recency(c, 2025), "bigint") == [5, 1, 0, 10, 0]
    assert values(["ON", "MB", None], lambda c: measures.in_set(c, measures.MAJOR_PROVINCES)) == [True, False, False]


def test_additive_score_is_null_when_a_flag_is(spark):
    rows = spark.createDataFrame([(True, False), (True, None)], "a boolean, b boolean")
    assert [r[0] for r in rows.select(measures.additive_score(F.col("a"), F.col("b"))).collect()] == [1, None]


def test_address(spark):
    rows = [("1 High St", "", "Leeds", "", "LS1"), ("1 High St", "", "Leeds", None, "LS1"), ("", "", "", "", "")]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string")
    made = df.select(measures.joined_address(*[F.col(c) for c in "abcde"])).collect()
    assert [r[0] for r in made] == ["1 High St, Leeds, , LS1", None, ""]


def test_absolute_urls_agree_with_the_standard_library(values):
    base = "https://www.example.ca/cnt/rsrcs/ctlg/index.aspx?x=1"
    items = ["a.aspx?i=1", "/r/b", "../c", "../../../../d", "//h.example/e", "?q=2", "http://o.example/f", "", "#top",
             "./g/./h/..", "i/", "..", "/a/../b/./c", "mailto:a@b.c"]
    assert values(items, lambda c: urls.absolute_url(c, F.lit(base))) == [urljoin(base, i) for i in items]


def test_url_parts(values):
    assert values(["https://a/x.PDF?d=1", "https://a.org/x", "", None, "/f.docx"], urls.file_type) == [
        "pdf", "pdf", None, None, "docx"]
    assert values(["https://a.org/x/Report.pdf", "https://a.org/view?id=1"], urls.url_file_name)[0] == "Report.pdf"
    assert values(["https://a.org/x", "not a url", "//a.org", "ftp:/x"], urls.is_valid_url) == [
        True, False, False, False]


def test_page_urls(spark):
    rows = [(1, "http://a?p={page}", 2, 4), (2, "http://b", 7, 7), (3, "http://b", 1, 2), (4, "http://a?p={page}", 5, 4),
            (5, "http://a?p={page}", -1, 4), (6, None, 1, 1), (7, "http://c/{page}/{page}", 0, 0), (8, "http://a", None, 3)]
    made = urls.page_urls(spark.createDataFrame(rows, "id int, template string, first int, last int")).collect()
    good = sorted((r.id, r.page, r.url) for r in made if r.error is None)
    assert good == [(1, 2, "http://a?p=2"), (1, 3, "http://a?p=3"), (1, 4, "http://a?p=4"), (2, 7, "http://b"), (7, 0, "http://c/0/0")]
    assert {r.id: r.error.split()[0] for r in made if r.error} == {3: "several", 4: "range", 5: "first", 6: "template,", 8: "template,"}
    assert all(r.url is None and r.page is None for r in made if r.error) and len(made) == 10
    assert urls.page_urls(spark.createDataFrame([], "template string, first int, last int")).collect() == []


def test_one_long_range_is_many_tasks_work(spark):
    one = spark.createDataFrame([("http://a?p={page}", 1, 1_000_000)], "template string, first int, last int")
    pages = urls.page_urls(one)
    assert pages.count() == pages.distinct().count() == 1_000_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        per_task = urls.page_urls(one).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(per_task) > 4 and max(r["count"] for r in per_task) < 300_000
