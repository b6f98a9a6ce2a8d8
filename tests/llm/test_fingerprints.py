"""Fingerprints: differences that are read back against sets, edits against a plain loop."""

import hashlib
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from stationlake.llm import fingerprints as fp
from stationlake.llm.registry import op11_fingerprints


def brute(docs):
    """The contract's columns, with likeness from multisets of pieces."""
    order = sorted(range(len(docs)), key=lambda i: (docs[i][0] is not None, docs[i][0] or 0))
    out = []

    def near(a, b):
        a, b = Counter(fp.pieces(a)), Counter(fp.pieces(b))
        return (a & b).total() / (a | b).total() if a or b else 1.0

    for at, i in enumerate(order):
        text = docs[i][1] or ""
        following = docs[order[(at + 1) % len(order)]][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        digest = hashlib.sha256(new.encode()).hexdigest()
        out.append((docs[i][0], len(text), digest, near(text, new), near(text, following)))
    return sorted(out, key=repr)


def rows(df):
    found = df.collect()
    own = [(r.doc_id, r.n_chars, r.edited_sha256, r.near_edited, r.near_next) for r in found]
    return sorted(own, key=repr)


def test_recovered_differences_are_the_sets():
    pick = np.random.default_rng(2)
    pool = pick.integers(0, 2**64 - 1, 5000, np.uint64)
    left, right = [], []
    for _ in range(300):
        shared = pick.choice(pool, pick.integers(0, 60), False)
        sides = [np.unique(np.r_[shared, pick.choice(pool, pick.integers(0, n), False)]) for n in (8, 200)]
        left.append(sides[0])
        right.append(sides[1])
    left += [pool[:0], pool[:0], pool, pool[:3]]
    right += [pool[:0], pool[:5], pool[:0], pool[:3]]
    sizes = set()
    for a, b, (one, other, cells) in zip(left, right, fp.recover(left, right)):
        assert (one == np.setdiff1d(a, b)).all() and (other == np.setdiff1d(b, a)).all()
        sizes.add(cells)
    assert {fp.CELLS, 4 * fp.CELLS, 16 * fp.CELLS} <= sizes  # some were tried again
    same = np.array([7, 7, 8], np.uint64)  # two pieces with one digest can never be peeled
    (one, other, cells), = fp.recover([same], [same[:0]])
    assert list(one) == [7, 8] and not len(other) and cells == 0


def test_written_fingerprints_give_the_difference():
    paragraphs = [f"Sentence number {i} of the text." for i in range(400)]
    old = "\n".join(paragraphs)
    new = "\n".join([*paragraphs[:100], "A new one.", *paragraphs[103:]])
    one, other = fp.written([fp.digests(old), fp.digests(new)])
    removed, added = fp.read_difference(one, other)
    assert len(removed) == 3 and list(added) == list(fp.digests("A new one."))
    assert set(removed) == set(fp.digests("\n".join(paragraphs[100:103])))
    assert fp.read_difference(one, fp.written([fp.digests("other\n" * 50)])[0]) is None
    assert len(one) < 500 and one == fp.written([fp.digests(old)])[0]
    assert fp.written([fp.digests("a. b. a")]) != fp.written([fp.digests("a. b")])


def test_pieces():
    assert fp.pieces("One. Two!  Three\n\n four?\n") == ["One.", "Two!", "Three", "four?"]
    assert fp.pieces(" \n\t") == [] and fp.pieces("x" * 130) == ["x" * 64, "x" * 64, "x" * 2]


def test_columns_of_versions(spark, odd):
    versions = odd.selectExpr("*", "upper(text) AS `new.text`").withColumnRenamed("h", "removed")
    found = fp.with_fingerprint(fp.with_differences(versions, "text", "new.text"), "text").collect()
    assert [r.text for r in found] == [r.text for r in odd.collect()]
    for r in found:
        a, b = Counter(fp.pieces(r.text or "")), Counter(fp.pieces((r.text or "").upper()))
        d = r.differences
        assert (len(d.removed), len(d.added)) == ((a - b).total(), (b - a).total())
        assert d.likeness == ((a & b).total() / (a | b).total() if a or b else 1.0)
        assert r.removed == "mine" and r.fingerprint == fp.written([fp.digests(r.text)])[0]


def test_edits_of_odd_rows(spark, odd, none):
    given = [(r.doc_id, r.text) for r in odd.collect()]
    found = fp.compare_edits(odd.withColumn("a.b", F.lit(1)).withColumn("row", F.lit(2)))
    assert rows(found) == brute(given)
    assert fp.compare_edits(none).collect() == []
    one = odd.where("doc_id = 1")
    assert rows(fp.compare_edits(one)) == brute([r for r in given if r[0] == 1])


def test_many_ranges_and_a_hot_id(spark, monkeypatch):
    monkeypatch.setattr(fp, "BATCH_TEXTS", 3)
    pick = random.Random(4)
    texts = ["\n".join(f"{pick.choice('abc')} {pick.randint(0, 9)}." for _ in range(pick.randint(0, 40))) for _ in range(300)]
    docs = [(5 if i % 3 == 0 else i // 2, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    ranges = fp._in_ranges(df, "doc_id", "text").groupBy("bucket").count().collect()
    assert len(ranges) > 4 and max(r["count"] for r in ranges) < 100
    assert rows(fp.compare_edits(df)) == brute(docs)


def test_the_query_against_a_plain_loop(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    result = op11_fingerprints(spark, sf_dir)
    assert rows(result) == brute(docs)
    found = result.select("doc_id", "fingerprint").collect()
    by_id = dict(docs)
    first = {}
    for r in found:
        assert first.setdefault(by_id[r.doc_id] or "", r.fingerprint) == r.fingerprint
    assert len(set(first.values())) > 0.9 * len(first)
