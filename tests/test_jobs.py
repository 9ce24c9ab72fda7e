from pyspark.sql import functions as F

from ledgerline.plans import jobs
from ledgerline.plans.inputs import load, table
from ledgerline.streaming import result_log

FOLDER = "/root/testdata/sf0.001"


def test_profiles_written_and_summarised(spark, tmp_path):
    inputs = {
        c: (load(spark, FOLDER, f"{p}_statements"), load(spark, FOLDER, f"{p}_registry"))
        for c, p in (("australia", "au"), ("canada", "ca"), ("uk", "uk"))
    }
    summary = {r.data_country: r for r in jobs.run_profiles(spark, inputs, str(tmp_path), 2025).collect()}
    both = jobs.combined_profiles(spark, str(tmp_path), list(inputs))
    assert summary["all"].records == both.count() == sum(summary[c].records for c in inputs)
    assert summary["all"].join_success_rate is None and 0 < summary["uk"].join_success_rate <= 100
    from ledgerline.operators import report as reports

    for country in inputs:
        own = spark.read.parquet(f"{tmp_path}/profiles/{country}").agg(F.lit(1), reports.mean_completeness(
            spark.read.parquet(f"{tmp_path}/profiles/{country}")).alias("mean")).first().mean
        assert abs(summary[country].average_completeness - own) < 1e-9
    report = spark.read.json(f"{tmp_path}/reports/uk")
    score = report.filter("section = 'distribution.compliance_score'")
    assert score.agg({"value": "sum"}).first()[0] == summary["uk"].records
    assert report.filter("section = 'average'").count() == 1
    assert spark.read.json(f"{tmp_path}/reports/australia").filter("section = 'entities'").count() == 5


def test_records_of_both_jurisdictions(spark):
    canadian = jobs.extract_records(load(spark, FOLDER, "statement_pages"), "canadian")
    assert canadian.count() == 150
    detected = jobs.extract_records(load(spark, FOLDER, "statement_pages"), "canadian", "machinery")
    assert detected.count() == canadian.filter("lower(company_country) = 'machinery'").count()
    australian = jobs.extract_records(load(spark, FOLDER, "register_pages"), "australian")
    assert australian.count() == 125 and set(australian.columns) >= {"pdf_url", "source_url", "jurisdiction"}


def test_crawl_to_log(spark):
    path = result_log.new_log(spark, "crawl")
    jobs.crawl_to_log(result_log.stream_table(spark, FOLDER, "pages"), path)
    assert result_log.read_log(spark, path).count() == table(spark, FOLDER, "pages").count()


def test_stream_of_a_folder(spark, tmp_path):
    table(spark, FOLDER, "pages").repartition(5).write.parquet(f"{tmp_path}/pages.parquet")
    path = result_log.new_log(spark, "folder")
    jobs.crawl_to_log(result_log.stream_table(spark, str(tmp_path), "pages"), path)
    assert result_log.read_log(spark, path).count() == table(spark, FOLDER, "pages").count()


def test_text_page_ids(spark):
    from ledgerline.operators import html

    pages = spark.createDataFrame([("abc", "u", "<p>x")], "page_id string, url string, html string")
    assert html.extract_with(pages, lambda root: {"n": 1}, "n int").first().page_id == "abc"


def test_documents_and_signatures(spark):
    answers = load(spark, FOLDER, "responses")
    plain, signed = jobs.build_documents(answers), jobs.build_documents(answers, with_signatures=True)
    assert plain.count() == signed.count() == 20
    mark = "final_markdown LIKE '%**Signature Information**%'"
    assert plain.filter(mark).count() == 0 and signed.filter(mark).count() > 0
    assert jobs.build_signatures(answers).count() == 48


def test_profiles_from_files(spark, tmp_path):
    """Files with their own headers give the profile of the same rows in memory."""
    from ledgerline.plans.profiles import build_profiles
    from ledgerline.sources import sinks, tables

    statements = load(spark, FOLDER, "uk_statements").drop("statement_seq")
    registry = load(spark, FOLDER, "uk_registry")
    sinks.write_csv(statements, f"{tmp_path}/in/StatementSummaries2024.csv")
    dotted = registry.toDF(*[" " + c.replace("RegAddress_", "RegAddress.").replace("Mortgages_", "Mortgages.")
                             for c in registry.columns])
    sinks.write_csv(dotted, f"{tmp_path}/companies.csv")
    read = build_profiles(
        tables.read_uk_statements(spark, f"{tmp_path}/in"),
        tables.read_uk_registry(spark, f"{tmp_path}/companies.csv"), "uk")
    direct = build_profiles(statements, registry, "uk").select(*read.columns)
    from_files, in_memory = sorted(map(str, read.collect())), sorted(map(str, direct.collect()))
    assert len(from_files) == 150 and from_files == in_memory


def test_the_australian_profile_starts_with_its_key(spark):
    from ledgerline.plans.profiles import build_profiles

    made = build_profiles(load(spark, FOLDER, "au_statements"), load(spark, FOLDER, "au_registry"), "australia")
    assert made.columns[0] == "abn" and made.columns[-1] == "data_country"
