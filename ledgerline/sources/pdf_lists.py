"""Lists of PDFs to work on: from a CSV, a directory or a file of URLs."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import strip
from ..functions.urls import is_valid_url, last_segment
from ..session import shared_dir
from .tables import read_delimited


def numbered(df: DataFrame, order: str | None = None) -> DataFrame:
    """0-based position of each row over the whole table, as ``idx``.

    Without ``order``, the rows come straight from files and are numbered by path and line: Spark reads a file block in
    one task, so a row's place is its place in the block after the rows of all blocks before. With ``order``, they are
    numbered by that column, equal values by the others; the sorted rows and their places are written once, since a second
    sort may cut its ranges elsewhere. Either way one task sums up the rows per block, never the rows.
    """
    place = F.monotonically_increasing_id()
    if order:
        rows = df.orderBy(order, *[c for c in df.columns if c != order])
        rows = written_once(rows.select("*", F.shiftright(place, 33).alias("_block"), place.alias("_place")))
    else:
        origin = df.metadataColumn("_metadata")
        rows = df.select("*", F.struct(origin["file_path"], origin["file_block_start"]).alias("_block"), place.alias("_place"))
    sizes = rows.groupBy("_block").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    offsets = sizes.select("_block", (before - F.col("_first")).alias("_offset"))
    return rows.join(offsets, "_block").select(*df.columns, (F.col("_place") + F.col("_offset")).alias("idx"))


def written_once(df: DataFrame) -> DataFrame:
    """The rows read from a table written in the shared folder, which the caller of the job clears."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def csv_sources(rows: DataFrame, idx: str = "idx") -> DataFrame:
    """Source rows from a table with pdf_url, optionally document_name, and its row number."""
    if "pdf_url" not in rows.columns:
        raise ValueError("the list needs a pdf_url column")
    number = F.col(idx).cast("string")
    name = F.concat(F.lit("document_"), number) if "document_name" not in rows.columns else F.col("document_name")
    return rows.select(
        F.concat(F.lit("csv_"), number).alias("source_id"),
        "pdf_url",
        name.alias("document_name"),
        F.col(idx).alias("original_index"),
    )


def csv_sources_with_metadata(rows: DataFrame, idx: str = "idx") -> DataFrame:
    """Source rows with a padded id and the whole input row kept as ``metadata``."""
    number = F.col(idx).cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return rows.select(
        F.concat(F.lit("pdf_"), padded).alias("source_id"),
        "pdf_url",
        F.struct(*[c for c in rows.columns if c != idx]).alias("metadata"),
    )


def read_csv_sources(spark: SparkSession, path: str) -> DataFrame:
    return csv_sources(numbered(read_delimited(spark, path)))


def _stem(path: str):
    return F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")


def directory_sources(files: DataFrame, root: str, idx: str = "idx") -> DataFrame:
    """Source rows from a listing of (path, length) and its row number by path."""
    name, stem = F.element_at(F.split("path", "/"), -1), _stem("path")
    relative = F.when(
        F.startswith("path", F.lit(root)), F.ltrim(F.substring("path", F.lit(len(root) + 1), F.length("path")), F.lit("/"))
    ).otherwise(name)
    return files.select(
        F.concat(F.lit("dir_"), F.col(idx).cast("string"), F.lit("_"), stem).alias("source_id"),
        F.col("path").alias("pdf_path"),
        stem.alias("document_name"),
        F.col("length").alias("file_size"),
        relative.alias("relative_path"),
    )


def directory_sources_with_metadata(files: DataFrame, idx: str = "idx") -> DataFrame:
    """Source rows with a padded id, and file name and size as ``metadata``."""
    number = F.col(idx).cast("string")
    padded = F.when(F.length(number) < 3, F.lpad(number, 3, "0")).otherwise(number)
    return files.select(
        F.concat(F.lit("pdf_"), padded, F.lit("_"), _stem("path")).alias("source_id"),
        F.col("path").alias("pdf_path"),
        F.struct(
            F.element_at(F.split("path", "/"), -1).alias("filename"), F.col("length").alias("size_bytes")
        ).alias("metadata"),
    )


def read_directory_sources(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """PDFs of a folder, numbered in path order; file contents are never read."""
    listing = (
        spark.read.format("binaryFile").option("pathGlobFilter", "*.{pdf,PDF}")
        .option("recursiveFileLookup", recursive).load(folder)
        .select(F.regexp_replace("path", "^file:/*", "/").alias("path"), "length")
    )
    return directory_sources(numbered(listing, "path"), folder.rstrip("/"))


def url_sources(urls: DataFrame, idx: str = "idx") -> DataFrame:
    """Source rows from numbered URLs; a name that is no PDF becomes document_<idx>.pdf."""
    number = F.col(idx).cast("string")
    name = last_segment(F.col("url"))
    file_name = F.when(F.endswith(name, F.lit(".pdf")), name).otherwise(
        F.concat(F.lit("document_"), number, F.lit(".pdf"))
    )
    stem = F.regexp_replace(file_name, r"(?<=.)\.pdf$", "")
    return urls.select(
        F.concat(F.lit("url_"), number, F.lit("_"), stem).alias("source_id"),
        F.col("url").alias("pdf_url"),
        stem.alias("document_name"),
        F.col(idx).alias("original_index"),
        file_name.alias("expected_filename"),
    )


def listed_urls(lines: DataFrame, value: str = "value") -> DataFrame:
    """URLs of a list: blank lines and # comments dropped."""
    url = strip(F.col(value))
    rest = [c for c in lines.columns if c != value]
    return lines.select(*rest, url.alias("url")).filter((F.col("url") != "") & ~F.startswith("url", F.lit("#")))


def read_url_sources(spark: SparkSession, path: str) -> DataFrame:
    return url_sources(numbered(listed_urls(spark.read.text(path))))


def invalid_urls(urls: DataFrame, idx: str = "idx") -> DataFrame:
    """One message per listed URL that lacks a scheme or a host."""
    line = (F.col(idx) + 1).cast("string")
    message = F.concat(F.lit("Line "), line, F.lit(": Invalid URL format: "), F.col("url"))
    return urls.filter(~is_valid_url(F.col("url"))).select(idx, "url", message.alias("message"))
