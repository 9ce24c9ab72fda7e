"""The corpus pipeline: documents through one operator after another, each stage a written table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, mixing, secrets, toxicity
from ledgerline.llm.near_duplicates import near_duplicates
from ledgerline.llm.queries import vocabulary
from ledgerline.llm.tables import cut, read


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.5 or more go. The score depends on the text alone, so texts are scored where they lie."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.keep_ordinary(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the least id. Rows without an id stay."""
    kept = near_duplicates(docs).where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").select(docs.columns).union(docs.where("doc_id IS NULL"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Found secrets are replaced by a mark; every document stays, and n_chars follows the text."""
    rows = docs.select(F.struct(*docs.columns).alias("_document"), "text")  # out of reach of the columns that the scan adds
    scanned = secrets.scan(rows, *secrets.train(docs))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return scanned.withColumn("text", secrets.redact(scanned)).select(
        *[new[c].alias(c) if c in new else F.col("_document")[c].alias(c) for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's rate asks, in shuffled order."""
    return mixing.repeated(docs).select(docs.columns)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of the token ids of each text and of what they decode to."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    return byte_bpe.text_digests(docs, path)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Rows go to Python workers in batches of this many bytes at most, whatever the length of their texts.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 1 << 20


def in_small_batches(stage: Stage) -> Stage:
    """The stage with BATCH set for its session, where it stays: a stage's rows are made when the caller writes them. Workers are
    reused from stage to stage and keep the memory of their largest batch."""

    @wraps(stage)
    def bounded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set(BATCH, BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return bounded


STAGES: list[tuple[str, Stage]] = [(name, in_small_batches(stage)) for name, stage in (
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("encoding", encode_texts),
)]

#: Models, signatures and encodings cannot be told in SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each reading what its predecessor wrote. Null texts and ids pass all stages, but for mixing, where a source
    without any text has the rate 0; an empty table stays empty; further columns, whatever their names, are kept up to the encoding."""
    docs = read(spark, sf_dir, "documents")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n < len(STAGES) - 1:
            docs = cut(docs)
    return docs
