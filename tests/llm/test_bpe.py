"""Encoding against the tokenizers library, and round trips."""

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stationlake.llm import bpe
from stationlake.llm.registry import VOCABULARY, op3_bpe

from .conftest import ODD

THEIRS = Tokenizer.from_file(VOCABULARY)


@pytest.fixture(scope="module")
def ours():
    return bpe.vocabulary(VOCABULARY)


def expected(text):
    return THEIRS.encode(text, add_special_tokens=False).ids


PARTS = ["a", "b", " ", "  ", "\n", "\x1c", "\x85", "\xa0", "　", "é", "ß", "日", "𝒜", "'s", "²"]
PARTS += ["1", "!", "=", "_", "<|endoftext|>", "<|endof", "​", "the", "ing", "\x00", "\t"]


def test_any_text_encodes_as_the_library_does(ours):
    pick = random.Random(3)
    for _ in range(3000):
        text = "".join(pick.choices(PARTS, k=pick.randint(0, 25)))
        assert ours.encode(text).tolist() == expected(text), text
        assert ours.decode(ours.encode(text)) == THEIRS.decode(
            expected(text), skip_special_tokens=False
        )


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcdefghinorst", max_size=80))
def test_words_without_spaces(text):
    assert bpe.vocabulary(VOCABULARY).encode(text).tolist() == expected(text)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=40))
def test_unicode_round_trips(text):
    text = text.encode("utf-8", "replace").decode()
    own = bpe.vocabulary(VOCABULARY)
    assert own.encode(text).tolist() == expected(text)
    assert own.decode(own.encode(text)) == text


def test_ids_that_are_no_text_decode_with_replacements(ours):
    import numpy as np

    for ids in ([0], [188, 50256, 255], [50255, 10, 200, 201]):
        assert ours.decode(np.array(ids)) == THEIRS.decode(ids, skip_special_tokens=False)
    assert ours.decode(np.array([-1, 10**6])) == ""


def test_odd_rows(odd, none, path):
    rows = bpe.decode(bpe.encode(odd, path), path).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        assert r.ids == expected(r.text or "")
        assert r.decoded == (r.text or "") and r.n_tokens == "mine"
    assert bpe.encode(none, path).count() == 0


def test_the_query_against_the_library(spark, sf_dir):
    sf = sf_dir.replace("sf0.01", "sf0.001")
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op3_bpe(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = expected(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_forgetting_changes_nothing(monkeypatch):
    pick = random.Random(12)
    parts = ["the", "ing", " ", "  ", "\n", "é", "日本", "'s", "1", ",", "!", "Ab", "zz", "\u0345", "ß", "x" * 70]
    texts = ["".join(pick.choices(parts, k=pick.randint(0, 40))) for _ in range(2000)]
    whole = bpe.Vocabulary(VOCABULARY)
    should = [whole.encode(t).tolist() for t in texts]
    monkeypatch.setattr(bpe, "CACHE_BYTES", 1)  # a generation of one word
    monkeypatch.setattr(bpe, "PAIRS", 1)
    forgetful = bpe.Vocabulary(VOCABULARY)
    assert [forgetful.encode(t).tolist() for t in texts] == should
    assert len(forgetful.young) <= 1 and len(forgetful.old) <= 1
    assert [expected(t) for t in texts] == should


def test_one_pass_gives_what_two_give(odd, none, path):
    two = bpe.decode(bpe.encode(odd, path), path)
    one = bpe.round_trip(odd, path)
    assert one.columns == two.columns and one.collect() == two.collect()
    assert bpe.round_trip(none, path).count() == 0
    text = one._jdf.queryExecution().executedPlan().toString()
    assert text.count("ArrowEvalPython") == 1 and text.count("both(") == 1
