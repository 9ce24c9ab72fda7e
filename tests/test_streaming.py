from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import html, pages
from ledgerline.plans import jobs
from ledgerline.plans.inputs import load, table
from ledgerline.streaming import result_log

FOLDER = "/root/testdata/sf0.001"


def test_log_lines(spark):
    df = spark.createDataFrame(
        [("A, B\nC", None, "s"), ("", "/x,y.pdf", "s"), (None, "", "")], "title string, pdf_url string, source_url string")
    assert [tuple(r) for r in result_log.log_lines(df).collect()] == [
        ("A; B C", "s"), ("NO_TITLE", "/x;y.pdf"), ("NO_TITLE", "NO_URL")]
    line = df.limit(1).select(F.lit("2025-01-01").alias("timestamp"), "title", F.lit("u").alias("url"))
    assert line.select(result_log.encoded_line(F.col("timestamp"))).first()[0].startswith("2025-01-01,")


def test_stream_equals_batch(spark):
    path = result_log.new_log(spark, "t")
    stream = result_log.stream_table(spark, FOLDER, "pages")
    result_log.append_log(result_log.log_lines(pages.page_records(html.parse_pages(stream), "CA"), ["page_id"]), path)
    batch = pages.page_records(html.parse_pages(table(spark, FOLDER, "pages")), "CA")
    want = result_log.log_lines(batch, ["page_id"])
    assert sorted(map(tuple, result_log.read_log(spark, path).collect())) == sorted(map(tuple, want.collect()))


def test_a_second_run_adds_only_what_is_new(spark, tmp_path):
    source, path = str(tmp_path / "in"), result_log.new_log(spark, "t")
    schema = "n bigint, title string, pdf_url string"
    arrived = lambda: spark.readStream.schema(schema).parquet(source)
    batch = lambda a, b: spark.range(a, b).selectExpr("id AS n", "'t' AS title", "string(id) AS pdf_url")
    batch(0, 5).write.parquet(source)
    result_log.append_log(result_log.log_lines(arrived(), ["n"]), path)
    result_log.running_count(result_log.log_lines(arrived(), ["n"]), path)
    assert result_log.read_count(spark, path).first()[0] == 5
    batch(5, 8).write.mode("append").parquet(source)
    result_log.append_log(result_log.log_lines(arrived(), ["n"]), path)
    result_log.running_count(result_log.log_lines(arrived(), ["n"]), path)
    log = result_log.read_log(spark, path)
    assert log.count() == 8 and result_log.read_count(spark, path).first()[0] == 8
    assert [r.n for r in result_log.latest_log(log, 3, ["n"]).collect()] == [7, 6, 5]


def test_readers_of_the_count_never_meet_an_unfinished_one(spark, tmp_path):
    path, source = result_log.new_log(spark, "t"), str(tmp_path / "in")
    with pytest.raises(FileNotFoundError):
        result_log.read_count(spark, path)
    schema = "n bigint, title string, pdf_url string"
    seen = []
    for k in range(5):
        spark.range(k * 10, k * 10 + 10).selectExpr("id AS n", "'t' AS title", "string(id) AS pdf_url").write.mode("append").parquet(source)
        result_log.running_count(result_log.log_lines(spark.readStream.schema(schema).parquet(source), ["n"]), path)
        seen.append(result_log.read_count(spark, path).first()[0])
    assert seen == [10, 20, 30, 40, 50]
    versions = result_log._count_versions(spark, path)
    assert len(versions) == 3
    half = Path(f"{path}/count/batch={versions[-1] + 1}")
    half.mkdir()
    (half / "part-0.parquet").write_bytes(b"half")
    assert result_log.read_count(spark, path).first()[0] == 50


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    path, source = result_log.new_log(spark, "t"), str(tmp_path / "in")
    spark.range(6).selectExpr("id AS n", "'t' AS title").write.parquet(source)
    stream = lambda: spark.readStream.schema("n bigint, title string").parquet(source)
    result_log.running_count(stream(), path, ["title"])
    before = result_log.read_count(spark, path).inputFiles()
    commits = sorted(Path(f"{path}/_checkpoint_count/commits").glob("[0-9]*"))
    for file in commits[-1:]:  # the batch ran, but its commit was lost
        file.unlink()
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
    result_log.running_count(stream(), path, ["title"])
    assert result_log.read_count(spark, path).inputFiles() == before
    assert [tuple(r) for r in result_log.read_count(spark, path).collect()] == [("t", 6)]


def test_a_country_crawl_goes_on_from_its_checkpoint(spark, tmp_path):
    source, path = str(tmp_path / "in"), result_log.new_log(spark, "t")
    found = load(spark, FOLDER, "statement_pages")
    schema = found.schema
    stream = lambda: spark.readStream.schema(schema).parquet(source)
    found.where("page_id % 2 = 0").write.parquet(source)
    jobs.crawl_to_log(stream(), path, country="United States")
    first = result_log.read_log(spark, path).count()
    found.where("page_id % 2 = 1").write.mode("append").parquet(source)
    jobs.crawl_to_log(stream(), path, country="United States")
    jobs.crawl_to_log(stream(), path, country="United States")
    want = result_log.log_lines(jobs.extract_records(found, "canadian", "united states"), ["page_id"])
    got = result_log.read_log(spark, path)
    assert 0 < first < got.count() or first == got.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_heavy_work_on_one_file_is_dealt_over_the_cores(spark):
    path = result_log.new_log(spark, "t")
    stream = result_log.stream_table(spark, FOLDER, "customer", heavy=True)
    result_log.append_log(stream.select("c_custkey", F.spark_partition_id().alias("task")), path)
    log = result_log.read_log(spark, path)
    assert log.count() == table(spark, FOLDER, "customer").count()
    assert log.select("task").distinct().count() == spark.sparkContext.defaultParallelism
