"""Where results go. Parquet unless a reader outside Spark needs text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flat_columns(df: DataFrame) -> DataFrame:
    """Lists, maps and structs as JSON text, for formats without them."""
    nested = [f.name for f in df.schema if f.dataType.typeName() in ("array", "map", "struct")]
    return df.withColumns({c: F.to_json(F.col(c)) for c in nested}) if nested else df


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV that reads back as written: spaces stay, and '' differs from null."""
    writer = flat_columns(df).write.mode(mode).option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    writer.csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("ignoreNullFields", True).json(path)


def write_records(df: DataFrame, path: str, file_format: str = "csv", mode: str = "overwrite") -> None:
    writers = {"csv": write_csv, "json": write_json}
    if file_format not in writers:
        raise ValueError(f"Unsupported file format: {file_format}")
    writers[file_format](df, path, mode)


def write_per_source(records: DataFrame, path: str, buckets: int = 256, files_per_bucket: int = 1) -> None:
    """JSON lines in folders ``bucket=n`` by a hash of the source, whose id stays a column.

    The number of folders does not grow with the sources; ``files_per_bucket``
    spreads the rows of a large source over as many tasks and files.
    """
    bucket = F.pmod(F.xxhash64("source_id"), F.lit(buckets))
    spread = F.pmod(F.xxhash64(*records.columns), F.lit(files_per_bucket))
    rows = records.withColumn("bucket", bucket).repartition("bucket", spread)
    rows.write.mode("overwrite").partitionBy("bucket").json(path)


def write_markdown(documents: DataFrame, path: str, text: str = "final_markdown", buckets: int = 256) -> None:
    """Documents as (source_id, text) in buckets; one without content gets a note."""
    note = "No content was extracted from the document."
    body = F.when(F.col(text) == "", note).otherwise(F.col(text))
    write_per_source(documents.select("source_id", body.alias(text)), path, buckets)


def write_links(links: DataFrame, path: str, jurisdiction: str, generated: str, url: str = "url") -> None:
    """Distinct links as text, and their header (total and time) beside them. A null is no link."""
    links.select(F.col(url).alias("value")).filter("value IS NOT NULL").distinct().write.mode("overwrite").text(f"{path}/links")
    total = links.sparkSession.read.text(f"{path}/links").agg(F.count("*").cast("string").alias("n"))
    rows = F.array(
        F.lit(f"# Statement URLs collected for {jurisdiction.upper()}"),
        F.lit(f"# Generated: {generated}"),
        F.concat(F.lit("# Total URLs: "), "n"),
        F.lit("#"),
    )
    total.select(F.explode(rows).alias("value")).write.mode("overwrite").text(f"{path}/header")
