"""Repeated passages against a look at every string."""

import hashlib
from collections import Counter, defaultdict

import pytest

from stationlake.llm import suffixes
from stationlake.llm.common import table
from stationlake.llm.registry import op6_suffixes

from .conftest import ODD


def brute(rows, depth=200):
    """Per id, sorted (bytes, removed, runs, kept) of its rows."""
    starts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        starts.update(hash(data[i : i + depth]) for i in range(len(data) - depth + 1))
    out = defaultdict(list)
    for i, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for j in range(len(data) - depth + 1):
            if starts[hash(data[j : j + depth])] > 1:
                gone[j : j + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(data, gone) if not g)
        runs = sum(g and (j == 0 or not gone[j - 1]) for j, g in enumerate(gone))
        out[i].append((len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return {i: sorted(v) for i, v in out.items()}


def found(df, depth=200):
    out = defaultdict(list)
    for r in suffixes.dedupe(df, depth).collect():
        digest = hashlib.sha256(r.kept).hexdigest()
        out[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, digest))
    return {i: sorted(v) for i, v in out.items()}


def letters(first, last, step=7):
    return "".join(chr(97 + (i * i * step + i // 3) % 26) for i in range(first, last))


ROWS = [
    (1, "abc" * 100), (2, "xy"), (3, None), (4, ""), (5, "é" * 150 + "Q"), (5, "Z" + "é" * 120),
    (None, "p" * 250), (7, letters(0, 900)), (8, letters(300, 520) + "tail"),
    (9, "same row " * 30), (9, "same row " * 30), (10, letters(0, 199, 5)), (11, letters(0, 199, 5)),
    (12, letters(0, 200, 11)), (13, "!!" + letters(0, 200, 11) + "??"),
    (14, letters(100, 700)), (15, letters(250, 451) + "#" + letters(250, 449)),
]


@pytest.mark.parametrize("piece", [1 << 18, 256])
def test_passages(spark, monkeypatch, piece):
    monkeypatch.setattr(suffixes, "PIECE", piece)
    df = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert found(df) == brute(ROWS)
    assert found(df, 150) == brute(ROWS, 150)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query(spark, sf_dir, sf):
    path = sf_dir.replace("sf0.01", sf)
    rows = [(r.doc_id, r.text) for r in table(spark, path, "documents").collect()]
    should = brute(rows)
    got = op6_suffixes(spark, path).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: [(r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)] for r in got} == should


def test_odd_rows(odd, none):
    assert found(odd) == brute([r[:2] for r in ODD])
    rows = suffixes.dedupe(odd).collect()
    assert {r.ids for r in rows} == {"mine"} and len(rows) == len(ODD)
    assert suffixes.dedupe(none).count() == 0
    with pytest.raises(ValueError):
        suffixes.dedupe(odd, 50)
