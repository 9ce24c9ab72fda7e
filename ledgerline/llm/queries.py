"""One query per operator, over whole tables, and SQL where SQL can tell the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import byte_bpe, fingerprints, hard_negatives, language_id, language_model, main_text, mixing, neighbours, secrets, token_alignment, toxicity
from ledgerline.llm.near_duplicates import near_duplicates
from ledgerline.llm.tables import read
from ledgerline.llm.token_counts import token_counts


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """The near-duplicate group of each of `documents`."""
    return near_duplicates(read(spark, folder, "documents"))


def op6_secrets(spark: SparkSession, folder: str) -> DataFrame:
    """The secrets found in each of `documents`, as spans."""
    return secrets.digest(read(spark, folder, "documents"))


def op7_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of each of `documents` encoded and decoded again."""
    path = vocabulary("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(byte_bpe.encode(read(spark, folder, "documents"), path, offsets=False), path)


def op9_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """The main text of each of `pages`."""
    return main_text.extract(read(spark, folder, "pages"))


def op10_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """The tokens of each of `documents`."""
    return token_counts(read(spark, folder, "documents"), vocabulary("piece_bpe_32k.model"))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of each of `documents` and of its edited text."""
    return fingerprints.compare_with_next(read(spark, folder, "documents"))


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """`documents` repeated by the rates of their sources."""
    return mixing.mix(read(spark, folder, "documents"))


def op4_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest neighbours of every 50th of `embeddings`."""
    return neighbours.search(read(spark, folder, "embeddings"))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """The toxicity of each of `documents`, learned from `labels`."""
    docs = read(spark, folder, "documents")
    return toxicity.score(docs, toxicity.train(docs, read(spark, folder, "labels")))


def op8_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of each of `documents`."""
    return language_model.score(read(spark, folder, "documents"))


def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector over all of `embeddings`."""
    return hard_negatives.hard_negatives(read(spark, folder, "embeddings"))


def op12_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of two vocabularies aligned over all of `documents`."""
    return token_alignment.align(read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def op13_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """The language of each of `documents`."""
    return language_id.languages(read(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (op1_near_dedup, op2_fingerprints, op3_mixing, op4_neighbours, op5_toxicity, op6_secrets, op7_byte_bpe, op8_lm_score, op9_main_text, op10_token_counts,
                                   op11_hard_negatives, op12_token_alignment, op13_language_id)}
ORACLES: dict[str, str] = {"op11_hard_negatives": hard_negatives.ORACLE}
