"""From raw documents to token ids in five stages, each on what the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import bagminhash, bpe, mixing, pii, quality
from stationlake.llm.common import table
from stationlake.llm.registry import PII_KEY, VOCABULARY
from stationlake.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier scores as good; the others go."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    score = quality.score(F.col("text").cast("string"), model)
    return docs.where(score >= quality.THRESHOLD)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each class of near duplicates."""
    return bagminhash.dedupe(docs)


def pseudonymous_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data, and n_chars of the new texts."""
    n_chars = F.char_length("text").cast("bigint")
    return pii.pseudonymise(docs, PII_KEY).withColumn("n_chars", n_chars)


def mixed_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: documents come up to twice, some not at all."""
    return mixing.mix(docs).select(*docs.columns)


def encoded_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their token ids, their number, and whether decoding gives the text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return bpe.round_trip(docs, VOCABULARY).select(
        *docs.columns,
        "ids",
        F.size("ids").cast("bigint").alias("n_tokens"),
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", distinct_documents),
    ("pii", pseudonymous_documents),
    ("mixing", mixed_documents),
    ("bpe", encoded_documents),
]

#: The classifier, the signatures and the keyed draws have no SQL equivalent.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs
