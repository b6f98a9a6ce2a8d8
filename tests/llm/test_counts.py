"""Counts after edits against encoding the edited texts anew."""

import random

from pyspark.sql import functions as F

from stationlake.llm import counts
from stationlake.llm.bpe import vocabulary
from stationlake.llm.registry import VOCABULARY, edits_of, op8_counts

PARTS = ["a", "b", " ", "  ", "\n", "   ", "the", "ing", "'s", " \n", "<|endof", "text|>"]
PARTS += ["<|endoftext|>", "日", "1", "!", "\t"]


def test_edits_in_small_leaves(monkeypatch):
    monkeypatch.setattr(counts, "RUNS", 2)
    own, whole = counts.Counter(vocabulary(VOCABULARY)), vocabulary(VOCABULARY)
    pick = random.Random(5)

    def text(most):
        return "".join(pick.choices(PARTS, k=pick.randint(0, most)))

    for _ in range(1500):
        now = text(60)
        tokens, chars = counts.build(own, now)
        for _ in range(4):
            start, removed = pick.randint(0, len(now) + 2), pick.choice([0, 0, 1, 2, 5, 20, 1000])
            new = text(pick.choice([0, 1, 3, 30]))
            should = now[:start] + new + now[start + removed :]
            now, tokens, chars, _ = counts.edit(own, now, tokens, chars, start, removed, new)
            assert now == should
            assert tokens[1] == len(whole.encode(now)) and chars[1] == len(now)
            for tree in (tokens, chars):
                size = len(tree) // 2
                assert all(tree[i] == tree[2 * i] + tree[2 * i + 1] for i in range(1, size))


def test_only_the_region_of_an_edit_is_encoded():
    own = counts.Counter(vocabulary(VOCABULARY))
    text = " ".join(f"word{i}" for i in range(20_000))
    tokens, chars = counts.build(own, text)
    _, _, _, encoded = counts.edit(own, text, tokens, chars, 90_000, 3, "new words")
    assert 0 < encoded < 2_000


def test_odd_rows(spark, odd, none, path):
    edits = F.array(
        F.struct(F.lit(2).alias("start"), F.lit(3).alias("removed"), F.lit("new é").alias("inserted")),
        F.struct(F.lit(-5).alias("start"), F.lit(None).cast("int").alias("removed"),
                 F.lit(None).cast("string").alias("inserted")),
        F.struct(F.lit(10**6).alias("start"), F.lit(9).alias("removed"), F.lit("end").alias("inserted")),
    )
    rows = odd.drop("state").withColumn("edits", edits)
    with_state = counts.with_counts(odd, path).withColumn("edits", edits)
    for df in (counts.apply_edits(rows, path), counts.apply_edits(with_state, path)):
        for r, old in zip(df.collect(), odd.collect()):
            text = old.text or ""
            should = text[:2] + "new é" + text[5:] + "end"
            assert r.text == should and r.ids == "mine"
            assert r.n_tokens_before == counts.count_text(path, text)
            assert r.n_tokens == counts.count_text(path, should)
    unchanged = odd.drop("state").withColumn("edits", F.lit(None).cast(rows.schema["edits"].dataType))
    kept = counts.apply_edits(unchanged, path).collect()
    assert [r.text for r in kept] == [r.text for r in odd.collect()]
    assert counts.with_counts(none, path).count() == 0


def test_the_query_against_whole_encoding(spark, sf_dir):
    sf = sf_dir.replace("sf0.01", "sf0.001")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    edits = edits_of(F.col("text"), F.col("doc_id")).alias("e")
    should = {}
    for r in docs.select("doc_id", "text", edits).collect():
        text = r.text or ""
        before = counts.count_text(VOCABULARY, text)
        for e in r.e:
            text = text[: e.start] + (e.inserted or "") + text[e.start + e.removed :]
        should[r.doc_id] = (before, counts.count_text(VOCABULARY, text))
    rows = op8_counts(spark, sf).collect()
    assert {r.doc_id: (r.n_tokens, r.n_tokens_edited) for r in rows} == should
