import gzip
import re

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import pdf_lists, sinks, tables


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_globbed_files_with_different_headers(spark, tmp_path):
    write(tmp_path / "au_1.csv", 'idx, abn ,period_start,extra\n1,"11, 22",2020-01-01,z\n2,,31-12-2020,z\n')
    write(tmp_path / "au_2.csv", 'abn,idx\n"",3\n44,4\n')
    write(tmp_path / "other.csv", "idx\n9\n")
    df = tables.read_au_statements(spark, str(tmp_path))
    assert df.columns == ["idx", "period_start", "abn"]
    assert [tuple(r) for r in df.orderBy("idx").collect()] == [
        ("1", "2020-01-01", "11, 22"), ("2", "31-12-2020", None), ("3", None, ""), ("4", None, "44")]


def test_missing_paths(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_uk_statements(spark, str(tmp_path / "none"))
    with pytest.raises(FileNotFoundError):
        tables.read_uk_statements(spark, str(tmp_path))
    file = write(tmp_path / "x.csv", "a\n")
    with pytest.raises(NotADirectoryError):
        tables.read_uk_statements(spark, file)


def test_ragged_tab_file(spark, tmp_path):
    path = write(tmp_path / "asic.txt", "Company Name\tABN \tStatus\nAcme\t1\tRegistered\textra\nZed\t2\n\"Q\"\t3\tx\n")
    df = tables.read_au_registry(spark, path)
    assert df.columns == ["Company_Name", "Status", "ABN"]
    assert [tuple(r) for r in df.orderBy("ABN").collect()] == [
        ("Acme", "Registered", "1"), ("Zed", None, "2"), ("Q", "x", "3")]


def test_registry_headers_with_spaces_and_dots(spark, tmp_path):
    path = write(tmp_path / "ch.csv", 'CompanyName, CompanyNumber,RegAddress.PostTown,Junk\n"A, B",01,Leeds,1\n')
    assert tables.read_uk_registry(spark, path).collect()[0].asDict() == {
        "CompanyName": "A, B", "CompanyNumber": "01", "RegAddress_PostTown": "Leeds"}


def test_pdf_list_from_csv(spark, tmp_path):
    path = write(tmp_path / "list.csv", "pdf_url,note\nhttps://a/1.pdf,x\nhttps://a/2.pdf,y\n")
    assert [tuple(r) for r in pdf_lists.read_csv_sources(spark, path).orderBy("original_index").collect()] == [
        ("csv_0", "https://a/1.pdf", "document_0", 0), ("csv_1", "https://a/2.pdf", "document_1", 1)]
    rows = pdf_lists.numbered(tables.read_delimited(spark, path))
    meta = pdf_lists.csv_sources_with_metadata(rows).orderBy("source_id").collect()
    assert meta[1].source_id == "pdf_001" and meta[1].metadata.note == "y"
    with pytest.raises(ValueError):
        pdf_lists.csv_sources(spark.createDataFrame([("x", 0)], "url string, idx bigint"))


def test_pdf_list_from_directory(spark, tmp_path):
    write(tmp_path / "b.pdf", "12345")
    write(tmp_path / "A.PDF", "1")
    write(tmp_path / "sub" / "c.v2.pdf", "12")
    write(tmp_path / "note.txt", "")
    flat = pdf_lists.read_directory_sources(spark, str(tmp_path)).orderBy("source_id").collect()
    assert [(r.source_id, r.file_size) for r in flat] == [("dir_0_A", 1), ("dir_1_b", 5)]
    deep = pdf_lists.read_directory_sources(spark, str(tmp_path), recursive=True).orderBy("source_id").collect()
    assert [(r.source_id, r.relative_path) for r in deep][2] == ("dir_2_c.v2", "sub/c.v2.pdf")


def test_pdf_list_from_urls(spark, tmp_path):
    path = write(tmp_path / "u.txt", "# note\n\n https://a.org/x/Report.pdf \nhttps://a.org/view?id=1\nnot a url\n")
    got = pdf_lists.read_url_sources(spark, path).orderBy("original_index").collect()
    assert [(r.source_id, r.expected_filename) for r in got] == [
        ("url_0_Report", "Report.pdf"), ("url_1_document_1", "document_1.pdf"), ("url_2_document_2", "document_2.pdf")]
    listed = pdf_lists.numbered(pdf_lists.listed_urls(spark.read.text(path)))
    assert [r.message for r in pdf_lists.invalid_urls(listed).collect()] == ["Line 3: Invalid URL format: not a url"]


def test_numbering_over_many_partitions(spark):
    df = spark.range(1000).repartition(13).withColumn("v", F.col("id").cast("string"))
    made = pdf_lists.numbered(df, "v").collect()
    assert [r.v for r in sorted(made, key=lambda r: r.idx)] == sorted(str(i) for i in range(1000))


def test_numbering_by_line_over_many_blocks(spark, tmp_path):
    write(tmp_path / "b.txt", "".join(f"http://b/{i}\n" for i in range(4000)))
    write(tmp_path / "a.txt", "# note\n" + "".join(f"http://a/{i}\n\n" for i in range(300)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        made = pdf_lists.read_url_sources(spark, str(tmp_path))
        rows = made.collect()
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 8
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = [f"http://a/{i}" for i in range(300)] + [f"http://b/{i}" for i in range(4000)]
    assert [r.pdf_url for r in sorted(rows, key=lambda r: r.original_index)] == want
    assert [r.original_index for r in sorted(rows, key=lambda r: r.original_index)] == list(range(4300))
    assert not re.search("PythonRDD|Python", made._jdf.queryExecution().executedPlan().toString())


def test_numbering_orders_equal_values_and_empty_tables(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 1), (None, 3)], "v string, w int")
    assert [(r.v, r.w) for r in sorted(pdf_lists.numbered(df, "v").collect(), key=lambda r: r.idx)] == [(None, 3), ("a", 1), ("b", 1), ("b", 2)]
    assert pdf_lists.numbered(df.limit(0), "v").collect() == []


def test_one_large_registry_file_is_many_tasks_work(spark, tmp_path):
    path = write(tmp_path / "ch.csv", "CompanyName,CompanyNumber\n" + "".join(f'"Name, {i}",{i:08d}\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        split, whole = tables.read_uk_registry(spark, path), tables.read_uk_registry(spark, path, newlines=True)
        parts = [df.groupBy(F.spark_partition_id()).count().count() for df in (split, whole)]
        rows = [df.agg(F.count("*"), F.count_distinct("CompanyNumber"), F.max("CompanyName")).first() for df in (split, whole)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert parts[0] > 4 and parts[1] == 1
    assert rows[0] == rows[1] and tuple(rows[0]) == (20_000, 20_000, "Name, 9999")


def test_statements_may_hold_line_breaks_unless_told_otherwise(spark, tmp_path):
    write(tmp_path / "au_1.csv", 'idx,abn\n1,"a\nb"\n')
    assert tables.read_au_statements(spark, str(tmp_path)).first().abn == "a\nb"
    assert tables.read_au_statements(spark, str(tmp_path), newlines=False).count() == 2


def test_headers_are_read_without_a_job_per_file(spark, tmp_path):
    for k in range(12):
        write(tmp_path / f"au_{k:02d}.csv", f"idx,abn\n{k},x\n")
    with gzip.open(tmp_path / "au_zz.csv.gz", "wt") as file:
        file.write("abn,idx\ny,99\n")
    (tmp_path / "au_dir.csv").mkdir()
    write(tmp_path / "au_dir.csv" / "part-0.csv", "idx,abn\n50,d\n")
    assert tables.first_lines(spark, [str(tmp_path / n) for n in ("au_00.csv", "au_zz.csv.gz", "au_dir.csv")]) == ["idx,abn", "abn,idx", "idx,abn"]
    spark.sparkContext.setJobGroup("headers", "headers")
    df = tables.read_au_statements(spark, str(tmp_path))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers"))
    spark.sparkContext._jsc.clearJobGroup()
    assert jobs <= 3
    got = {(r.idx, r.abn) for r in df.collect()}
    assert got == {(str(k), "x") for k in range(12)} | {("50", "d")}


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(" a\n", "", ["x"]), (None, 'q"q', None)], "a string, b string, c array<string>")
    sinks.write_records(df, str(tmp_path / "out"), "csv")
    back = tables.read_delimited(spark, str(tmp_path / "out"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted([(" a\n", "", '["x"]'), (None, 'q"q', None)], key=str)
    with pytest.raises(ValueError):
        sinks.write_records(df, str(tmp_path / "x"), "xml")


def test_other_sinks(spark, tmp_path):
    records = spark.createDataFrame([("s1", "Yes"), ("s1", "No"), ("s2", "Yes")], "source_id string, Signature string")
    sinks.write_per_source(records, str(tmp_path / "per"), buckets=2, files_per_bucket=2)
    back = spark.read.json(str(tmp_path / "per"))
    assert sorted(map(tuple, back.select(*records.columns).collect())) == [("s1", "No"), ("s1", "Yes"), ("s2", "Yes")]
    assert back.groupBy("source_id").agg(F.count_distinct("bucket").alias("n")).filter("n > 1").isEmpty()
    docs = spark.createDataFrame([("s1", "# A\n\nb"), ("s2", "")], "source_id string, final_markdown string")
    sinks.write_markdown(docs, str(tmp_path / "md"))
    text = spark.read.json(str(tmp_path / "md"))
    assert {r.source_id: r.final_markdown for r in text.collect()} == {
        "s1": "# A\n\nb", "s2": "No content was extracted from the document."}
    links = spark.createDataFrame([("https://a",), ("https://b",), ("https://a",), (None,)], "url string")
    sinks.write_links(links, str(tmp_path / "links"), "ca", "2025-01-01 00:00:00")
    assert spark.read.text(str(tmp_path / "links" / "links")).count() == 2
    header = [r.value for r in spark.read.text(str(tmp_path / "links" / "header")).collect()]
    assert header[0] == "# Statement URLs collected for CA" and header[2] == "# Total URLs: 2"
    sinks.write_json(docs, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def test_directory_metadata(spark):
    files = spark.createDataFrame([("/in/a.b.pdf", 7, 4)], "path string, length bigint, idx bigint")
    row = pdf_lists.directory_sources_with_metadata(files).first()
    assert (row.source_id, tuple(row.metadata)) == ("pdf_004_a.b", ("a.b.pdf", 7))


def test_canadian_files(spark, tmp_path):
    statements = write(tmp_path / "s.csv", "organization, year ,junk\nA,2024,1\n")
    registry = write(tmp_path / "r.csv", "idx,business_name,derived_NAICS\n1,\"Acme, Inc.\",31\n")
    assert [tuple(r) for r in tables.read_ca_statements(spark, statements).collect()] == [("2024", "A")]
    assert tables.read_ca_registry(spark, registry).columns == ["idx", "business_name", "derived_NAICS"]
    assert tables.read_ca_registry(spark, registry).first().business_name == "Acme, Inc."
