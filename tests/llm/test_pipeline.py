"""The pipeline, and the queries that SQL can check."""

import glob
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from stationlake.llm import registry
from stationlake.llm.common import table

from .test_mixing import targets, words
from .test_near import all_pairs
from .test_pii import PLANTED, luhn


def test_every_operator_is_registered():
    names = contract.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert set(registry.oracle_sql()) <= set(names)


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, [docs]
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        rows = corpus_pipeline.materialise(stage(spark, seen[-1], sf_dir))
        assert rows.columns[: len(columns)] == columns
        assert i == len(corpus_pipeline.STAGES) - 1 or rows.columns == columns
        seen.append(rows)
    raw, good, distinct, safe, mixed, coded = (df.collect() for df in seen)
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    kept = {r.doc_id for r in good}
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in clean) / len(clean) >= 0.98
    assert sum(q == 0 and d in kept for d, q in labels.items()) <= 0.1 * (len(labels) - len(clean))
    classes = all_pairs([(r.doc_id, r.text) for r in good])
    assert sorted(r.doc_id for r in distinct) == sorted({c for c, _ in classes.values()})
    before = {r.doc_id: r.text for r in distinct}
    for r in safe:
        values = [v for v in PLANTED.findall(before[r.doc_id]) if not v.isdigit() or luhn(v)]
        assert not any(v in r.text for v in values) and r.n_chars == len(r.text)
        assert values or r.text == before[r.doc_id]
    sizes, took = Counter(), Counter()
    for r in safe:
        sizes[r.source] += words(r.text)
    for r in mixed:
        took[r.source] += words(r.text)
    longest = max(words(r.text) for r in safe)
    assert all(abs(took[s] - t) <= longest / 2 + 1 for s, t in targets(sizes).items())
    texts = {r.doc_id: r.text for r in safe}
    assert all(r.text == texts[r.doc_id] for r in mixed)
    assert max(Counter(r.doc_id for r in mixed).values()) <= 2
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in coded)
    assert Counter(r.doc_id for r in coded) == Counter(r.doc_id for r in mixed)


def test_run_gives_the_last_stage(spark, sf_dir):
    rows = corpus_pipeline.run(spark, sf_dir.replace("sf0.01", "sf0.001"))
    assert rows.columns[-3:] == ["ids", "n_tokens", "round_trip"] and rows.count() > 0


@pytest.mark.parametrize("name", list(registry.oracle_sql()))
def test_same_rows_as_sql(name, spark, sf_dir):
    duck = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path)[: -len(".parquet")]
        duck.execute(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    ours = registry.queries()[name](spark, sf_dir)
    columns = sorted(ours.columns)
    left = Counter(tuple(r) for r in ours.select(*columns).collect())
    quoted = ", ".join(f'"{c}"' for c in columns)
    right = Counter(duck.execute(f"SELECT {quoted} FROM ({registry.oracle_sql()[name]})").fetchall())
    assert left == right and left
