"""Near duplicates: unbiased signatures, exact similarities, classes against all pairs."""

import gc
import os
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from stationlake.llm import bagminhash as near
from stationlake.llm import suffixes
from stationlake.llm.common import table
from stationlake.llm.registry import op5_bagminhash
from stationlake.session import materialise, shared_dir

from .conftest import ODD


def bag(text):
    words = (text or "").lower().split()
    if not words:
        return Counter()
    return Counter(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def jaccard(a, b):
    a, b = bag(a), bag(b)
    union = sum((a | b).values())
    return sum((a & b).values()) / union if union else 0


def all_pairs(rows, least=0.8):
    """Classes of rows (id, text) by their smallest id, from an index of all shingles."""
    bags = [bag(t) for _, t in rows]
    places = defaultdict(list)
    for i, b in enumerate(bags):
        for s, c in b.items():
            places[s].append((i, c))
    shared = Counter()
    for own in places.values():
        for x in range(len(own)):
            for y in range(x):
                shared[own[y][0], own[x][0]] += min(own[x][1], own[y][1])
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (a, b), n in shared.items():
        if n / (sum(bags[a].values()) + sum(bags[b].values()) - n) >= least:
            parent[root(a)] = root(b)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    return {i: (min(own), len(own)) for own in members.values() for i in own}


def edited(words, count, pick):
    words = list(words)
    for p in pick.choice(len(words), count, replace=False):
        words[p] = f"x{pick.integers(0, 10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    pick = np.random.default_rng(1)
    base = [f"w{i}" for i in pick.integers(0, 300, 400)]
    texts = [edited(base, k, pick) for k in (0, 2, 5, 8, 10, 20, 40, 80)]
    return texts + ["a b", "A b c", "", " \n", "spam " * 300, "spam " * 150, "spam " * 240 + "egg"]


def test_bags_and_similarities(family):
    data = [t.lower().encode() for t in family]
    bags = near.Bags(data)
    for i, text in enumerate(family):
        own = bags.count[bags.text == i]
        assert sorted(own) == sorted(bag(text).values())
    for i in range(len(family)):
        got = near.similarities([data[i]] * len(data), data)
        assert got == pytest.approx([jaccard(family[i], t) for t in family])


def test_signatures_estimate_the_weighted_similarity(family):
    slots = 4000
    bags = near.Bags([t.lower().encode() for t in family])
    times = near.signatures(bags, len(family), slots)
    for i in (0, 12):
        for j, text in enumerate(family):
            if bag(text) and bag(family[i]):
                true = jaccard(family[i], text)
                error = 5 * (true * (1 - true) / slots) ** 0.5 + 1e-9
                assert abs((times[i] == times[j]).mean() - true) <= error


def test_signatures_do_not_depend_on_other_texts():
    short = [" ".join(f"s{i}-{j}" for j in range(4 + n)) for i, n in enumerate((1, 2, 6, 10, 16))]
    others = [" ".join(f"o{i}-{j}" for j in range(300)) for i in range(60)]
    groups = [short, short + others[:1], others[:7] + short, short + others]
    found = []
    for texts in groups:
        bags = near.Bags([t.encode() for t in texts])
        times = near.signatures(bags, len(texts), near.BANDS * near.ROWS)
        at = texts.index(short[0])
        found.append(times[at : at + len(short)])
    for other in found[1:]:
        assert (found[0] == other).all()


def test_workers_keep_no_tables_of_long_texts():
    long = " ".join(f"w{i % 7}" for i in range(1_000_000)).encode()
    short = near.Bags([b"a b c d e f"])  # the tables that are kept
    gc.collect()
    tracemalloc.start()
    bags = near.Bags([long, b"a b c d e f"])
    assert bags.words.tolist() == [1_000_000, 6]
    assert (bags.hash[bags.text == 1] == short.hash).all()
    assert bags.count[bags.text == 0].tolist() and bags.count[bags.text == 0].sum() == 999_996
    del bags
    gc.collect()
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 1 << 20


def test_groups_fit_the_tables_that_are_kept():
    texts = [b"x" * 2_000] * 600
    assert [len(t) for t, in near._groups(texts)] == [132, 132, 132, 132, 72]
    assert near.PIECE + 2_000 + 132 < 2 * suffixes.PIECE


def test_memory_of_large_blocks_goes_back(monkeypatch):
    calls = []
    monkeypatch.setattr(near, "trim", lambda: calls.append(1))
    small, large = (pa.table({"x": pa.array([b"x" * n])}) for n in (100, near.PIECE))
    near._tidy(small, small)
    assert not calls
    near._tidy(small, large)
    assert len(calls) == 1


def test_texts_go_to_workers_in_small_batches(spark, monkeypatch):
    name, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", []

    def spied(df):
        seen.append(spark.conf.get(name))
        return materialise(df)

    monkeypatch.setattr(near, "materialise", spied)
    before = spark.conf.get(name, None)
    rows = spark.createDataFrame([(1, "a b c"), (2, "A b c"), (3, "d")], "doc_id long, text string")
    assert near.with_class(rows).count() == 3
    assert seen and set(seen) == {str(near.BATCH)}
    assert spark.conf.get(name, None) == before


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_against_all_pairs(spark, sf_dir, sf):
    path = sf_dir.replace("sf0.01", sf)
    rows = [(r.doc_id, r.text) for r in table(spark, path, "documents").collect()]
    got = op5_bagminhash(spark, path).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == all_pairs(rows)
    kept = near.dedupe(table(spark, path, "documents"))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r.class_id for r in got})


def test_families_chains_and_shared_passages(spark):
    pick = np.random.default_rng(2)
    base = [f"b{i}" for i in range(200)]
    passage = [f"p{i}" for i in range(60)]
    texts = [" ".join(base)] * 3
    # copies that are near the original, and too far from each other
    texts += [edited(base, 4, pick) for _ in range(40)]
    # a chain, each near the one before only
    chain = [f"c{i}" for i in range(300)]
    for i in range(6):
        texts.append(" ".join([f"d{i}-{j}" for j in range(20 * i)] + chain[20 * i :]))
    # texts with one passage in common, of which some are copies
    for i in range(60):
        own = [f"o{i}-{j}" for j in range(50)]
        texts += [" ".join(passage + own)] * (1 + (i % 7 == 0))
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.with_class(df).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == all_pairs(rows)


def test_bags_of_tokens_give_exact_similarities(family):
    data = [t.lower().encode() for t in family if bag(t)]
    texts = [t for t in family if bag(t)]
    tokens = []
    for t in data:
        bags = near.Bags([t])
        number = np.concatenate([np.arange(c) for c in bags.count]).astype(np.uint64)
        tokens.append(near.mixed(np.repeat(bags.hash, bags.count) + number * near.STEPS[1]))
    postings = near._Postings(tokens)
    sizes = np.array([len(t) for t in tokens])
    for i, own in enumerate(tokens):
        shared = postings.shared(own)
        got = shared / (sizes + len(own) - shared)
        assert got == pytest.approx([jaccard(texts[i], t) for t in texts])


def test_a_family_beyond_the_similarity_makes_no_row_per_pair(spark, monkeypatch):
    """Copies that are near their original's other copies only now and then."""
    pick = np.random.default_rng(5)
    base = [f"b{i}" for i in range(300)]
    rows = list(enumerate(edited(base, int(pick.integers(4, 9)), pick) for _ in range(250)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pairs = []
    whole = near._verified
    monkeypatch.setattr(
        near, "_verified", lambda p, *more: (pairs.append(p.count()), whole(p, *more))[1]
    )
    got = near.with_class(df).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == all_pairs(rows)
    first, second = pairs  # with the centres of up to 26 buckets each, and with the nearest one
    assert first <= near.BANDS * len(rows) and second <= len(rows)


def test_blocks_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 3)
    monkeypatch.setattr(near, "ROWS", 1)
    monkeypatch.setattr(near, "LIKELY", 0.0)
    pick = np.random.default_rng(3)
    rows = []
    for f in range(4):
        base = [f"f{f}-{i % 40}" for i in range(60)]
        rows += [(len(rows) + i, edited(base, int(i % 5), pick)) for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = near.with_class(df).collect()
    assert {r.doc_id: (r.class_id, r.class_size) for r in got} == all_pairs(rows)


def test_odd_rows(odd, none):
    rows = near.with_class(odd).collect()
    assert len(rows) == len(ODD)
    by_id = defaultdict(set)
    for r in rows:
        by_id[r.doc_id].add((r.class_id, r.class_size))
    assert by_id[1] == by_id[8] == {(1, 3)}
    assert by_id[2] == {(2, 1)} and by_id[3] == {(3, 1)} and by_id[None] == {(None, 1)}
    kept = near.dedupe(odd)
    assert kept.columns == odd.columns
    more = odd.selectExpr("*", *[f"'mine' AS `{c}`" for c in ("_i", "_h", "_k", "node", "a.b")])
    same = near.dedupe(more)
    assert same.columns == more.columns
    assert {tuple(r)[-5:] for r in same.collect()} == {("mine",) * 5}
    ids = sorted(str(r.doc_id) for r in kept.collect())
    assert ids == sorted(map(str, [1, 2, 3, 4, 5, 6, 7, None]))
    assert near.with_class(none).count() == 0 and near.dedupe(none).count() == 0


def test_dedupe_shuffles_the_rows_once(spark):
    df = spark.createDataFrame(
        [(None, "a b c"), (None, "a b c"), (0, "a b c"), (0, "d e f"), (0, "d e f"), (2, "")],
        "doc_id long, text string",
    )
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = near.dedupe(df)
        text = kept._jdf.queryExecution().executedPlan().toString()
        rows = kept.collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    # the rows, the classes, and the first of each class
    assert text.count("Exchange hashpartitioning") == 3
    assert sorted(map(tuple, rows), key=str) == [(0, "d e f"), (2, ""), (None, "a b c")]


def test_no_scratch_is_left_but_the_classes(spark):
    def folders():
        top = shared_dir(spark)
        return {f for f in os.listdir(top) if f.startswith("rows-")} if os.path.isdir(top) else set()

    before = folders()
    df = spark.range(40).selectExpr("id AS doc_id", "concat('a b c d e f g ', id % 4) AS text")
    found = near.classes(df)
    assert len(folders() - before) == 1
    assert found.count() == 40 and found.select("component").distinct().count() == 4
