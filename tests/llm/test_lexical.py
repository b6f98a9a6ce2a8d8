"""Ranked search against scores computed one by one, and the sharing of sums."""

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np

from stationlake.llm import lexical
from stationlake.llm.oracle import oracle_sql
from stationlake.llm.registry import op12_lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FOLD = {i: i + 32 for i in range(ord("A"), ord("Z") + 1)}


def cut(text):
    return TERM.findall((text or "").translate(FOLD))


def brute(docs, items, k):
    """Every score, by the formula alone."""
    texts = [(d, Counter(cut(t))) for d, t in docs if cut(t)]
    documents, total = len(texts), sum(sum(c.values()) for _, c in texts)
    having = Counter(t for _, c in texts for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, counts in texts:
            m = 10 + 90 * sum(counts.values()) * documents // total
            score = sum(
                math.floor(1000 * math.log((2 * documents + 2) / (2 * having[t] + 1)))
                * (10**9 * counts[t] // (1000 * counts[t] + 8 * m))
                for t in {*cut(text)} & counts.keys()
            )
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        for rank, (score, missing, doc) in enumerate(sorted(found)[:k], 1):
            out.append((item, rank, None if missing else doc, -score))
    return sorted(out, key=repr)


def rows(df):
    return sorted(((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect()), key=repr)


def test_terms():
    for text in ("Ünder ÉÀ_x-Y9 \t[z]{Q}`@:/", "日本 A\x00b\x7fc\x85d", "", " .,", "a" * 9):
        assert [t.decode() for t in lexical.terms(text.encode())] == cut(text)


def test_sums_are_shared_and_right():
    pick = random.Random(3)
    common = [pick.sample(range(60), 12) for _ in range(5)]
    sets = [sorted({*pick.choice(common), *pick.sample(range(60), 4)}) for _ in range(50)]
    sets += [[7], sets[0]]
    sharing = lexical.Sharing(sets, 60)
    added = sum(level.shape[1] for level in sharing.levels)
    assert added and added + len(sharing.operands) < 0.6 * sum(map(len, sets))
    table = np.zeros((sharing.rows, 8), np.int64)
    table[:60] = np.arange(480).reshape(60, 8) ** 3
    should = np.array([table[s].sum(axis=0) for s in sets])
    assert (sharing.sums(table) == should).all()


def test_against_brute_force(spark, odd, none, monkeypatch):
    pick = random.Random(11)
    words = [f"w{i}" for i in range(40)] + ["É", "Zz", "9"]
    docs = [(i % 90, " ".join(pick.choices(words, k=pick.randint(0, 30)))) for i in range(100)]
    docs += [(None, "w1 W2 w3"), (None, None), (7, ""), (8, "w1, " * 20_000), (8, "w1 w2")]
    items = [(i, " ".join(pick.choices(words, k=pick.randint(0, 9)))) for i in range(30)]
    items += [(None, "w1 w2"), (3, None), (3, "w1"), (3, "w1"), (4, "nowhere"), (5, "w5 " * 9_000)]
    d = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS item", "2 AS `a.b`")
    i = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS rank", "2 AS doc_id")
    should = brute(docs, items, 4)
    assert should and rows(lexical.search(d, i, k=4)) == should
    monkeypatch.setattr(lexical, "BLOCK_ITEMS", 7)
    monkeypatch.setattr(lexical, "CELLS", 500)
    assert rows(lexical.search(d.repartition(5), i, k=4)) == should
    empty = spark.createDataFrame([], "item_id long, text string")
    assert rows(lexical.search(d, empty)) == rows(lexical.search(none, i)) == []
    given = [(r.doc_id, r.text) for r in odd.collect()]
    asked = [(1, "the quick word"), (2, "日本語 x"), (3, "m")]
    found = lexical.search(odd, spark.createDataFrame(asked, "item_id long, text string"))
    assert rows(found) == brute(given, asked, 10)


def test_the_query_against_sql(spark, sf_dir):
    con = duckdb.connect()
    for name in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    should = sorted(con.execute(oracle_sql()["op12_lexical"]).fetchall(), key=repr)
    assert len(should) > 100 and rows(op12_lexical(spark, sf_dir)) == should
