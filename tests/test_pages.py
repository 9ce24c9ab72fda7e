import pytest
from pyspark.errors import AnalysisException

from ledgerline.operators import html, pages

STATEMENT = """<!DOCTYPE html><html><head><title>Library - Reports</title><script>var p="</p> 2029";</script></head>
<body><h2>Language selection</h2><h2>Acme Ltd (2024)</h2>
<h3>Subject</h3>
<ul><li><a href="#">Fighting Against Forced Labour and Child Labour in Supply Chains Act</a></li>
<li><a>SCALCA</a></li><li><a>Annual Reports: 2024</a></li><li><a>Manufacturing</a></li>
<li><a>Utilities</a></li><li><a>Chemical Manufacturing</a></li></ul>
<h3>Authors</h3><ul><li><a>Acme Ltd, author.</a></li><li><a>Sub One,author.</a></li><li><a>Sub Two</a></li></ul>
<h3>Publishers</h3><ul><li>City</li><li>Canada : Acme Ltd</li></ul>
<h3>Resource</h3><span>x</span><p>Report &amp; annex</p><p>second</p>
<a href="/a.pdf">other</a><a href="/x.pdf">Online access</a></body></html>"""
FRENCH = '<html lang="fr-CA"><body><h2>Rapport</h2><a href="/y.ashx">Accès en ligne</a></body></html>'
BARE = "<html><title>Site - Something - Name</title><p>year: 2019 reporting year: 2023, 2027</p></html>"
LONG_TITLE = "<title>Site - A longer page name - Library</title><p>English text</p><a href='/get?t=PDF'>g</a>"
NO_LANG_FR = "<html><!-- version en français --><h2></h2></html>"


def page_table(spark, *bodies):
    rows = [(i, f"https://p/{i}", b) for i, b in enumerate(bodies)]
    return spark.createDataFrame(rows, "page_id bigint, url string, html string")


def records(spark, *bodies):
    made = pages.page_records(html.parse_pages(page_table(spark, *bodies)), "CA")
    return made.orderBy("page_id").collect()


def test_statement_page(spark):
    r = records(spark, STATEMENT)[0].asDict()
    assert r == {
        "page_id": 0, "title": "Acme Ltd (2024)", "pdf_url": "/x.pdf", "year": 2024, "organization": "Acme Ltd",
        "language": "en", "file_type": "pdf",
        "reporting_law": "Fighting Against Forced Labour and Child Labour in Supply Chains Act",
        "legal_framework": "Supply Chains Act (SCALCA)", "statement_type": "mandatory",
        "industry_sector": "Manufacturing", "industry_sectors_additional": ["Utilities"],
        "industry_subsector": "Chemical Manufacturing", "industry_subsectors_additional": None,
        "parent_company": "Acme Ltd", "subsidiary_companies": ["Sub One", "Sub Two"], "company_country": "Canada",
        "document_type": "Report & annex", "source_url": "https://p/0", "jurisdiction": "CA",
    }


def test_other_pages(spark):
    french, bare, long_title, marked, empty = records(spark, FRENCH, BARE, LONG_TITLE, NO_LANG_FR, None)
    assert (french.title, french.pdf_url, french.language, french.file_type) == ("Rapport", "/y.ashx", "fr", "ashx")
    assert (bare.title, bare.year) == (None, 2023)
    assert (long_title.title, long_title.pdf_url, long_title.file_type, long_title.language) == (
        "A longer page name", "/get?t=PDF", "pdf", "en")
    # An empty heading that is not navigation ends the search for a title.
    assert (marked.title, marked.language) == (None, "fr")
    assert (empty.title, empty.language, empty.year) == (None, "en", None)


def test_organization_needs_a_changed_and_long_name(values):
    items = ["Acme Ltd (2024) - Modern Slavery Statement", "Acme Statement 2023", "Abc (2024)", "Acme Holdings", None]
    assert values(items, pages.organization) == ["Acme Ltd", None, None, None, None]


def test_lenient_tree():
    tree = html.page_elements("<ul><li>a<li>b</ul><br></br><h3>S<h3>T</h3></h3><p>1<p>2</p><a href>x</a>&copy;")
    assert [s["heading"] for s in tree["sections"]] == [None, "T"]
    assert tree["page_text"] == "abST12x©" and tree["links"][0]["href"] == ""


def test_search_links(spark):
    body = ("<table><tr><td><a href='dtls-en.aspx?d=PS&amp;i=1'>x</a><a href='dtls-en.aspx?d=PS&i=2'>y</a></td></tr>"
            "<tr><td><a href='/about'>z</a></td></tr></table>")
    links = pages.statement_links(html.parse_pages(page_table(spark, body)), "https://s.ca/ctlg/")
    assert [r.statement_url for r in links.collect()] == ["https://s.ca/ctlg/dtls-en.aspx?d=PS&i=1"]


def test_register_pdf(spark):
    bodies = [
        '<div id="the-statement-file"><iframe src="/statements/1/pdf/"></iframe></div>',
        '<div id="the-statement-file"><iframe></iframe></div><iframe src="https://c/x.PDF"></iframe>',
        '<a class="au-btn" href="/a">Other</a><a class="au-btn x" href="/get/1"> Download </a>',
        '<a href="https://f/z.pdf">file</a>', "<p>nothing</p>",
    ]
    found = html.parse_pages(page_table(spark, *bodies)).select("page_id", pages.register_pdf_url().alias("u"))
    site = pages.REGISTER_SITE
    assert [r.u for r in found.orderBy("page_id").collect()] == [
        f"{site}/statements/1/pdf/", "https://c/x.PDF", f"{site}/get/1", "https://f/z.pdf", None]


def test_countries(spark):
    names = ["Acme GmbH", "Acme AG", "Acme B.V. Amsterdam", "Acme", None, "acme gmbh"]
    df = spark.createDataFrame([(i, n, None) for i, n in enumerate(names)], "i int, title string, company_country string")
    found = [r.detected_country for r in pages.detect_country(df).orderBy("i").collect()]
    assert found == ["Germany", "Germany", "Netherlands", "Canada", "Canada", "Canada"]
    kept = spark.createDataFrame([("Acme GmbH", "Norway")], "title string, company_country string")
    assert pages.detect_country(kept).first().detected_country == "Norway"
    assert pages.country_filter(df, "GERMANY").count() == 2 and pages.country_filter(df, "").count() == 6


def test_a_country_filter_works_its_text_out_once(spark):
    made = pages.page_records(html.parse_pages(page_table(spark, STATEMENT)), "CA")
    plan = pages.country_filter(made, "canada")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("filter(h2") < 60  # 1,202 where each indicator worked it out


def test_required_fields(spark):
    df = spark.createDataFrame([("a", 1, ["x"]), ("", 1, ["x"]), ("a", 0, ["x"]), ("a", 1, []), ("a", None, ["x"])],
                               "t string, n int, l array<string>")
    assert df.filter(pages.has_required(df, ["t", "n", "l"])).count() == 1
    assert df.filter(pages.has_required(df, ["missing"])).count() == 0


def test_custom_extractor_skips_none(spark):
    pages_ = page_table(spark, "<h1>A</h1>", "<p>none</p>")

    def first_heading(root):
        found = root.find_all("h1")
        return {"heading": found[0].text()} if found else None

    made = html.extract_with(pages_, first_heading, "heading string")
    assert [tuple(r) for r in made.collect()] == [(0, "https://p/0", "A")]


def test_register_rows_keep_what_has_no_page(spark):
    register = spark.createDataFrame([("1", "https://p/0"), ("2", None), ("3", "https://p/9")], "idx string, statement_url string")
    found = html.parse_pages(page_table(spark, '<a href="/a.pdf">x</a>'))
    joined = pages.register_with_pdf(register, found).orderBy("idx")
    assert [(r.idx, r.pdf_url) for r in joined.collect()] == [("1", f"{pages.REGISTER_SITE}/a.pdf"), ("2", None), ("3", None)]


def test_links_of_a_custom_function(spark):
    body = '<a href="b.html">x</a><p><a href="/c">y</a></p><a>z</a>'

    def every_link(root):
        return [a.attrs["href"] for a in root.find_all("a") if "href" in a.attrs]

    made = html.links_with(page_table(spark, body, ""), every_link, "https://s.org/d/a.html")
    assert [(r.position, r.link) for r in made.collect()] == [(0, "https://s.org/d/b.html"), (1, "https://s.org/c")]


def test_only_wanted_elements_leave_the_parser(spark):
    rows = spark.createDataFrame([(1, "u", "<title>Some long title</title><h2>Search</h2><h2>Plan (2022)</h2><a href='/x.pdf'>x</a>"), (2, "u", None)],
                                 "page_id long, url string, html string")
    whole = html.parse_pages(rows)
    for rule, column in (("title", pages.title()), ("pdf_url", pages.pdf_url()), ("language", pages.language())):
        found = html.parse_pages(rows, wanted=pages.needs(rule))
        assert set(found.columns) == {"page_id", "url", *pages.NEEDS[rule]}
        ask = lambda df: sorted(map(tuple, df.select("page_id", column.alias("v")).collect()))
        assert ask(found) == ask(whole)
    assert html.parse_pages(rows, wanted=("h2",)).select("h2").schema.simpleString() == "struct<h2:array<string>>"
    with pytest.raises(ValueError, match="h7"):
        html.parse_pages(rows, wanted=("h2", "h7"))


def test_table_function_gives_the_rows_of_links_with(spark):
    rows = spark.createDataFrame([(1, "u1", "<a href='b'>x</a><a name='n'>y</a><a href='/c?d=1&amp;e'>z</a>"), (2, "u2", "<p>none</p>"), (3, "u3", None),
                                  (4, None, "<a href='b'>x</a>" * 500)], "page_id long, url string, html string")
    base = "https://a.org/x/"

    def anchors(root):
        return [a.attrs["href"] for a in root.find_all("a") if "href" in a.attrs]

    want = html.links_with(rows, anchors, base)
    got = html.lateral_links(rows, anchors, base)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str) and got.count() == 502


def test_table_function_in_sql_with_several_fields(spark):
    def labelled(root):
        for a in root.find_all("a"):
            yield a.attrs.get("href"), len(a.text())

    spark.udtf.register("labelled", html.page_table(labelled, "href string, size bigint"))
    rows = spark.createDataFrame([(1, "<a href='b'>xy</a><a>z</a>"), (2, "")], "page_id long, html string")
    got = spark.sql("SELECT page_id, l.* FROM {rows}, LATERAL labelled(html) l", rows=rows).collect()
    assert sorted(map(tuple, got)) == [(1, 0, "b", 2), (1, 1, None, 1)]
    with pytest.raises(AnalysisException, match="the page must be text"):
        spark.sql("SELECT * FROM labelled(7)").collect()


def test_batches_leave_the_parser_in_stretches(spark):
    import pyarrow as pa

    bodies = ["<h2>a</h2>"] * 1000 + [None, "<h2>b</h2>" + "x" * (3 << 20), "<h2>c</h2>"] + ["<p>" + "y" * 400_000] * 5
    given = pa.RecordBatch.from_pydict({"page_id": range(len(bodies)), "html": bodies})
    got = list(html.element_batches([given], "html", ["page_id"], pa.schema([html.ELEMENTS.field("h2")])))
    whole = pa.Table.from_batches(got).to_pydict()
    assert whole["page_id"] == list(range(len(bodies)))
    assert whole["h2"] == [["a"]] * 1000 + [[], ["b"], ["c"]] + [[]] * 5
    assert [b.num_rows for b in got] == [256, 256, 256, 233, 1, 3, 2, 1]


def test_a_tree_goes_once_it_was_read():
    import gc

    gc.collect()
    gc.disable()
    try:
        for _ in range(20):
            html.page_elements(STATEMENT)
        left = sum(isinstance(o, html.Node) for o in gc.get_objects())
    finally:
        gc.enable()
    assert left == 0
