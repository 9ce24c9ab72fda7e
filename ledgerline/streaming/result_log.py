"""The result log: an append-only table that can be read while records arrive."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import strip
from ..operators.selection import latest_entries
from ..session import shared_dir


def _first_filled(df: DataFrame, names: list[str], fallback: str) -> Column:
    have = [F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns]
    return F.coalesce(*have, F.lit(fallback))


def _one_field(c: Column) -> Column:
    return strip(F.translate(c, ",\n\r", ";  "))


def log_lines(records: DataFrame, keep: list[str] = (), timestamp: Column | None = None) -> DataFrame:
    """Title and URL of each record, free of separators.

    ``timestamp`` is a column of the record; a wall clock would make a replayed
    micro-batch differ from its first run.
    """
    title = _one_field(_first_filled(records, ["title", "statement_name"], "NO_TITLE"))
    url = _one_field(_first_filled(records, ["pdf_url", "statement_url", "source_url"], "NO_URL"))
    stamp = [timestamp.alias("timestamp")] if timestamp is not None else []
    return records.select(*keep, *stamp, title.alias("title"), url.alias("url"))


def encoded_line(stamp: Column) -> Column:
    """One text line of the log."""
    return F.concat_ws(",", stamp, "title", "url")


def stream_table(spark: SparkSession, folder: str, table: str, files_per_batch: int = 1000, heavy: bool = False) -> DataFrame:
    """A table's Parquet files as a stream, one file or a folder of part files; the schema comes from the files there now.

    ``heavy`` deals the rows of a micro-batch over all cores before work that is heavy per row, where the files there now have
    fewer splits than cores.
    """
    path = f"{folder}/{table}.parquet"
    now = spark.read.parquet(path)
    reader = spark.readStream.schema(now.schema).option("maxFilesPerTrigger", files_per_batch)
    files = now.inputFiles()
    if not files:
        raise FileNotFoundError(f"no files in {path}")
    if not any(f.endswith(f"/{table}.parquet") for f in files):
        rows = reader.parquet(path)
    else:
        rows = reader.option("pathGlobFilter", f"{table}.parquet").parquet(folder)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if heavy and now.rdd.getNumPartitions() < cores else rows


def new_log(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def append_log(lines: DataFrame, path: str) -> None:
    """Append everything that has arrived, then stop; a later call goes on from there.

    The checkpoint beside the table makes each file count once across restarts.
    """
    query = (
        lines.writeStream.outputMode("append").format("parquet")
        .option("checkpointLocation", f"{path}/_checkpoint").option("path", f"{path}/log")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/log")


def _count_versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the micro-batches whose count is wholly written, in order."""
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(f"{path}/count/batch=*/_SUCCESS")
    files = done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(done)
    return sorted(int(f.getPath().getParent().getName().removeprefix("batch=")) for f in files or [])


def _drop_version(spark: SparkSession, path: str, batch_id: int) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/count/batch={batch_id}")
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def running_count(lines: DataFrame, path: str, by: list[str] = (), keep: int = 3) -> None:
    """Count so far, a new version ``batch=<number>`` after every micro-batch.

    A version counts once its _SUCCESS file is there, so readers always find a whole one. A micro-batch that is replayed
    after a failure leaves its finished version as it is. All but the newest ``keep`` versions are removed.
    """
    counts = lines.groupBy(*by).agg(F.count("*").alias("count"))

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id in _count_versions(spark, path):
            batch.write.format("noop").mode("overwrite").save()  # the state has to be brought up to the batch all the same
            return
        batch.write.mode("overwrite").parquet(f"{path}/count/batch={batch_id}")
        for old in _count_versions(spark, path)[:-keep]:
            _drop_version(spark, path, old)

    query = (
        counts.writeStream.outputMode("complete").foreachBatch(save)
        .option("checkpointLocation", f"{path}/_checkpoint_count")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()


def read_count(spark: SparkSession, path: str) -> DataFrame:
    """The newest whole version of the running count."""
    versions = _count_versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"no count has been finished in {path}")
    return spark.read.parquet(f"{path}/count/batch={versions[-1]}")


def latest_log(log: DataFrame, n: int = 5, seq: list[str] = ("timestamp",)) -> DataFrame:
    return latest_entries(log, n, list(seq))
