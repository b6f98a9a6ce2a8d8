"""Mixing: targets against plain resharing, exact quotas, disjoint draws, the draws' statistics."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from stationlake.llm import mixing
from stationlake.llm.common import table
from stationlake.llm.registry import op7_mixing

from .conftest import ODD


def targets(sizes, share=1.5, most=2.0):
    """Shares by weight, again and again, until no source is above its limit."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(order)}
    left, out, free = share * sum(sizes.values()), {}, list(order)
    while free:
        level = left / sum(weight[s] for s in free)
        full = [s for s in free if level * weight[s] > most * sizes[s]]
        if not full:
            return out | {s: level * weight[s] for s in free}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in full]
    return out


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query(spark, sf_dir, sf):
    path = sf_dir.replace("sf0.01", sf)
    docs = {r.doc_id: r for r in table(spark, path, "documents").collect()}
    rows = op7_mixing(spark, path).collect()
    assert len(rows) == len(docs)
    sizes = Counter()
    for r in docs.values():
        sizes[r.source] += words(r.text)
    should, took = targets(sizes), Counter()
    for r in rows:
        source = docs[r.doc_id].source
        assert r.size == words(docs[r.doc_id].text) and r.source_size == sizes[source]
        assert r.target == pytest.approx(should[source], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        took[source] += r.taken
    assert all(took[s] == round(should[s]) for s in sizes)
    assert sorted(map(tuple, op7_mixing(spark, path).collect())) == sorted(map(tuple, rows))


@pytest.mark.parametrize("sizes", [
    {"a": 10, "b": 10_000, "c": 5}, {"a": 0, "b": 3, None: 4}, {"x": 7}, {"a": 0, "b": 0},
    {chr(97 + i): (i * 37) % 101 for i in range(26)},
])
def test_targets(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(df).collect()}
    should = targets(sizes)
    assert got.keys() == should.keys()
    assert all(got[s] == pytest.approx(should[s], rel=1e-12) for s in sizes)


def test_quotas_are_split_exactly(spark):
    quotas = {"a": 1000, "b": 333, None: 77, "c": 1}
    df = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    for shards in (1, 2, 13, 64):
        rows = mixing.split_quotas(df, shards, seed=1).collect()
        totals, per, parts = Counter(), Counter(), defaultdict(list)
        for r in rows:
            totals[r.source] += r.quota
            per[r.shard] += r.quota
            parts[r.source].append((r.first, r.quota))
        assert dict(totals) == quotas
        assert set(per) == set(range(shards)) and max(per.values()) - min(per.values()) <= 1
        for own in parts.values():  # consecutive and disjoint
            at = 0
            for first, quota in sorted(own):
                assert first == at or quota == 0
                at += quota


def test_draws_are_hypergeometric(spark):
    uniform = F.shiftrightunsigned(F.xxhash64("id"), 11).cast("double") / float(1 << 53)
    for n, k, m in ((1000, 300, 500), (10**8, 300, 5 * 10**7), (20, 19, 3), (5, 5, 2), (0, 0, 0)):
        value = mixing.hypergeometric(F.lit(n), F.lit(k), F.lit(m), uniform)
        row = spark.range(20_000).select(value.alias("x")).agg(
            F.avg("x"), F.var_pop("x"), F.min("x"), F.max("x")
        ).first()
        mean = m * k / max(n, 1)
        variance = mean * (1 - k / max(n, 1)) * (n - m) / max(n - 1, 1)
        assert abs(row[0] - mean) <= 5 * (variance / 20_000) ** 0.5 + 1e-9
        assert abs(row[1] - variance) <= 0.05 * variance + 1e-9
        assert row[2] >= max(0, m + k - n) and row[3] <= min(k, m)


def test_small_blocks_and_shards_give_a_whole_mix(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = mixing.mix(docs, block_words=2_000, shard_words=50_000).collect()
    sizes, took, times = Counter(), Counter(), Counter()
    for r in docs.collect():
        sizes[r.source] += words(r.text)
    for r in rows:
        took[r.source] += words(r.text)
        times[r.doc_id] += 1
    should = targets(sizes)
    longest = max(words(r.text) for r in docs.collect())
    assert all(abs(took[s] - should[s]) <= longest / 2 + 1 for s in sizes)
    assert max(times.values()) == 2
    shards = {r.shard for r in rows}
    assert len(shards) > 5
    plan = mixing.plan(docs, block_words=2_000, shard_words=50_000)
    assert sorted({d.shard for r in plan.collect() for d in r.draws}) == sorted(shards)


def test_odd_rows(odd, none):
    for df in (mixing.plan(odd), mixing.plan(odd.repartition(7, "doc_id"))):
        rows = df.collect()
        assert len(rows) == len(ODD)
        assert all(r.ids == "mine" for r in rows)
        sizes, took = Counter(), Counter()
        for r in rows:
            sizes[r.source] += r["size"]
            took[r.source] += sum(d.words for d in r.draws)
            assert sum(d.words for d in r.draws) <= 2 * r["size"]
        should = targets(sizes)
        assert dict(took) == {s: round(should[s]) for s in took}
    mixed = mixing.mix(odd)
    assert mixed.columns == [*(c for c in odd.columns if c != "shard"), "shard", "place"]
    assert {r.ids for r in mixed.collect()} == {"mine"}
    assert mixing.plan(none).count() == 0 and mixing.mix(none).count() == 0


def test_no_python_runs(odd):
    for df in (mixing.plan(odd), mixing.mix(odd)):
        text = df._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "Pandas" not in text and "Arrow" not in text


def test_texts_are_shuffled_once_into_their_shards(spark, sf_dir):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "256k")
    try:
        mixed = mixing.mix(table(spark, sf_dir, "documents"))
        text = mixed._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # blocks and sources are broadcast; but the rows at which a source ends nothing is put in order
    assert "SortMergeJoin" not in text
    assert len(re.findall(r"Exchange hashpartitioning\(shard", text)) == 1
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


@pytest.mark.parametrize("cut", [True, False])
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_copies_at_the_end_of_a_source(spark, cut, threshold):
    # each source is one block of copies, so that its target lies among equal rows
    df = spark.range(60).selectExpr(
        "id % 3 AS doc_id", "repeat('w ', 7) AS text",
        "CASE id % 3 WHEN 0 THEN 'a' WHEN 1 THEN 'b' END AS source", "id AS place_of",
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        rows = mixing.plan(df, cut=cut, whole_rows=True).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert sorted(r.place_of for r in rows) == list(range(60))
    took = Counter()
    for r in rows:
        took[r.source] += sum(d.words for d in r.draws)
        assert cut or all(d.words == 7 for d in r.draws)
    for source, t in targets({"a": 140, "b": 140, None: 140}).items():
        assert took[source] == round(t) if cut else abs(took[source] - t) <= 4
