"""The queries of this subpackage over the given tables, and their SQL where there is one."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import (
    ann,
    bagminhash,
    bpe,
    counts,
    dialogue,
    fingerprints,
    html,
    lexical,
    maxscore,
    mixing,
    oracle,
    pii,
    quality,
    suffixes,
)
from stationlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

#: The key of the pseudonyms; a deployment sets its own.
PII_KEY = os.environ.get("STATIONLAKE_PII_KEY", "stationlake")
#: The vocabulary of the queries, at the same place on every machine.
VOCABULARY = str(public_tokenizers.path("byte_bpe_50k.json"))


def op1_ann(spark: SparkSession, sf: str) -> DataFrame:
    return ann.search(table(spark, sf, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op2_pii(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, found="n_replaced")


def op3_bpe(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return bpe.round_trip(docs, VOCABULARY).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_html(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url", "html")
    return html.extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )


def op5_bagminhash(spark: SparkSession, sf: str) -> DataFrame:
    return bagminhash.with_class(table(spark, sf, "documents").select("doc_id", "text"))


def op6_suffixes(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return suffixes.dedupe(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op7_mixing(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.plan(docs).select(
        "doc_id", "size", "source_size", "target", mixing.taken().alias("taken")
    )


def edits_of(text: Column, doc_id: Column) -> Column:
    """Three edits of a text that follow from it alone, each in terms of the text so far.

    A word's worth of characters at a quarter is turned round, a remark goes in at the half, and
    a twentieth of the text at three quarters goes out.
    """
    n = F.coalesce(F.char_length(text), F.lit(0))

    def change(start: Column, removed: Column, inserted: Column) -> Column:
        return F.struct(
            F.floor(start).cast("int").alias("start"),
            F.floor(removed).cast("int").alias("removed"),
            inserted.alias("inserted"),
        )

    turned = F.reverse(F.substring(text, F.floor(n / 4).cast("int") + 1, F.lit(12)))
    return F.array(
        change(n / 4, F.lit(12), turned),
        change(n / 2, F.lit(0), F.concat(F.lit(" (see "), doc_id.cast("string"), F.lit(") "))),
        change(n * 3 / 4, n / 20, F.lit("")),
    )


def op8_counts(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    # trees are built and edited in one pass, so that a worker keeps one set of words
    edited = counts.apply_edits(
        docs.withColumn("edits", edits_of(F.col("text"), F.col("doc_id"))),
        VOCABULARY,
        name="n_tokens_edited",
        before="n_tokens",
    )
    return edited.select(
        "doc_id",
        "n_tokens",
        "n_tokens_edited",
        "n_encoded",
        F.sha2("text", 256).alias("edited_sha256"),
    )


def op9_maxscore(spark: SparkSession, sf: str) -> DataFrame:
    return maxscore.search(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op10_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf, "labels"))
    return quality.with_scores(docs, model).select(
        "doc_id",
        quality.held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, sf, "documents"))


def op12_lexical(spark: SparkSession, sf: str) -> DataFrame:
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"), k=10)


def op13_dialogue(spark: SparkSession, sf: str) -> DataFrame:
    conversations = table(spark, sf, "conversations")
    return dialogue.report(dialogue.damage(conversations), conversations)


_QUERIES: dict[str, Query] = {
    "op1_ann": op1_ann,
    "op2_pii": op2_pii,
    "op3_bpe": op3_bpe,
    "op4_html": op4_html,
    "op5_bagminhash": op5_bagminhash,
    "op6_suffixes": op6_suffixes,
    "op7_mixing": op7_mixing,
    "op8_counts": op8_counts,
    "op9_maxscore": op9_maxscore,
    "op10_quality": op10_quality,
    "op11_fingerprints": op11_fingerprints,
    "op12_lexical": op12_lexical,
    "op13_dialogue": op13_dialogue,
}


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    """SQL that gives the rows of some of the queries."""
    return oracle.oracle_sql()
