"""The compression classifier: held-out accuracy, what it reads, and odd inputs."""

import zlib

import pytest
from pyspark.sql import functions as F

from stationlake.llm import quality
from stationlake.llm.common import table
from stationlake.llm.registry import op10_quality

from .conftest import ODD


def test_held_out_accuracy(spark, sf_dir):
    sf = sf_dir.replace("sf0.01", "sf0.1")
    labels = {r.doc_id: r.quality for r in table(spark, sf, "labels").collect()}
    rows = op10_quality(spark, sf).collect()
    assert len(rows) == table(spark, sf, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    judged = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(judged) > 500
    assert sum(p == q for p, q in judged) / len(judged) >= 0.98
    good = [p for p, q in judged if q == 1]
    assert sum(good) / len(good) >= 0.98


def test_held_out_labels_and_other_columns_have_no_influence(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = quality.train(docs, labels)
    flipped = labels.withColumn(
        "quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality"))
    )
    other = docs.withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})
    assert quality.train(other, flipped) == model


def test_odd_rows(spark, odd, none, sf_dir):
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = quality.with_scores(odd, model).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text or "", r.score) == r.score
    assert quality.with_scores(none, model).count() == 0
    assert {r[0] for r in odd.select(quality.held_out()).collect()} <= {True, False}


@pytest.mark.parametrize("labels,share", [([], 0.5), ([(1, 1), (8, 1)], None), ([(None, 1)], 0.5)])
def test_without_labels_of_both_kinds_all_scores_are_their_share(spark, odd, labels, share):
    given = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.train(odd, given)
    scores = {r.score for r in quality.with_scores(odd, model).collect()}
    assert len(scores) == 1
    assert share is None or abs(scores.pop() - share) < 1e-9


def test_contradicting_labels_are_left_out(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    twice = labels.unionByName(labels.limit(1).withColumn("quality", 1 - F.col("quality")))
    assert quality.train(docs, twice).weights
    assert quality.fit([("good text", 1), ("bad!!", 0), (None, 1), ("x", 7)]).weights
