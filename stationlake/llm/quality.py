"""A quality score from two zstandard dictionaries.

One dictionary is trained on good and one on bad labelled texts. A text is cut into pieces of
``PIECE`` bytes, and each piece is compressed with either dictionary; a piece that resembles the
good texts is smaller with the good one. The sizes, each divided by the bytes of the text, give
the features of a logistic calibration: the difference of the whole text, that of its worst
piece, and the good size itself, which is low for endless repetition. Pieces are needed as a
long text soon serves as its own dictionary.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ship, trim

#: Bytes of the pieces that are compressed on their own.
PIECE = 512
#: Bytes of a dictionary at most.
DICTIONARY = 112_640
#: Labelled rows from which the model is fitted, at most: those with the smallest hashes, whole.
SAMPLE_ROWS = 6_000
#: Scores from which a text counts as good.
THRESHOLD = 0.7

FEATURES = 5


@dataclass(frozen=True)
class Model:
    """Two dictionaries, and the calibration: centres, scales and weights of the features."""

    good: bytes
    bad: bytes
    centres: tuple[float, ...]
    scales: tuple[float, ...]
    weights: tuple[float, ...]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row's label is kept from training; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def _pieces(text: str | None) -> list[bytes]:
    data = (text or "").encode("utf-8", "replace")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def _dictionary(texts: list[str]) -> bytes:
    pieces = [p for t in texts for p in _pieces(t)]
    joined = b"".join(pieces)
    try:
        size = min(DICTIONARY, len(joined) // 8)
        return zstandard.train_dictionary(size, pieces).as_bytes()
    except (zstandard.ZstdError, ValueError):  # too few pieces: they are the dictionary
        return joined[:DICTIONARY]


@functools.lru_cache(maxsize=8)
def _compressor(dictionary: bytes) -> zstandard.ZstdCompressor:
    options = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if len(dictionary) < 8:
        return zstandard.ZstdCompressor(level=3, **options)
    content = zstandard.ZstdCompressionDict(dictionary)
    return zstandard.ZstdCompressor(level=3, dict_data=content, **options)


def features(text: str | None, good: bytes, bad: bytes) -> list[float]:
    """The features of a whole text; all 0 for a null or empty one."""
    pieces = _pieces(text)
    if not pieces:
        return [0.0] * FEATURES
    by_good, by_bad = _compressor(good).compress, _compressor(bad).compress
    sizes = [(len(by_good(p)), len(by_bad(p)), len(p)) for p in pieces]
    total = sum(n for _, _, n in sizes)
    good_size = sum(g for g, _, _ in sizes) / total
    apart = sum(b for _, b, _ in sizes) / total - good_size
    # the last piece is too short to tell much, unless it is the only one
    whole = [(b - g) / n for g, b, n in sizes if n >= PIECE // 2] or [apart]
    return [apart, min(whole), good_size, good_size**2, apart * good_size]


def fit(rows: list[tuple[str | None, int]]) -> Model:
    """A model from texts with labels, 1 for good.

    Five in eight rows make the dictionaries, the others the calibration. Without rows of both
    kinds the score is the share of good rows (one half without any row).
    """
    known = [(t, int(q)) for t, q in rows if q in (0, 1)]
    cut = len(known) * 5 // 8
    good = _dictionary([t for t, q in known[:cut] if q == 1 and t])
    bad = _dictionary([t for t, q in known[:cut] if q == 0 and t])
    rest = known[cut:]
    labels = np.array([q for _, q in rest], float)
    if not 0 < labels.sum() < len(labels):
        share = (sum(q for _, q in known) + 0.5) / (len(known) + 1)
        odds = float(np.log(share / (1 - share)))
        return Model(good, bad, (0.0,) * FEATURES, (1.0,) * FEATURES, (odds, *[0.0] * FEATURES))
    x = np.array([features(t, good, bad) for t, _ in rest])
    centres, scales = x.mean(0), x.std(0) + 1e-9
    z = np.c_[np.ones(len(x)), (x - centres) / scales]
    weights = np.zeros(z.shape[1])
    ridge = 1e-3 * len(z) * np.eye(z.shape[1])
    for _ in range(30):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(z @ weights, -30, 30)))
        curve = (z * (p * (1 - p) + 1e-9)[:, None]).T @ z + ridge
        weights += np.linalg.solve(curve, z.T @ (labels - p) - ridge @ weights)
    return Model(good, bad, *(tuple(map(float, v)) for v in (centres, scales, weights)))


def train(
    docs: DataFrame,
    labels: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Model:
    """Fit a model to at most ``sample_rows`` labelled rows that are not held out.

    Only the sample's ids (bounded by ``sample_rows``) are broadcast and only its texts come to
    the driver. Rows with null ids, texts or labels, and ids with two labels, are left out.
    """
    key = F.xxhash64(F.lit("quality"), "_id")
    chosen = (
        labels.select(F.col(doc_id).alias("_id"), F.col(label).cast("int").alias("_label"))
        .where(F.col("_id").isNotNull() & F.col("_label").isin(0, 1) & ~held_out("_id"))
        .groupBy("_id")
        .agg(F.min("_label").alias("_label"), F.max("_label").alias("_other"))
        .where("_label = _other")
        .drop("_other")
        .orderBy(key, "_id")
        .limit(sample_rows)
    )
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    sample = (
        texts.where("_text IS NOT NULL")
        .join(F.broadcast(chosen), "_id")
        .orderBy(key, "_id", F.xxhash64("_text"))
        .limit(sample_rows)
        .select("_text", "_label")
    )
    return fit([tuple(r) for r in sample.collect()])


def score(text: Column, model: Model) -> Column:
    """The probability that a whole text is good; defined for null and empty texts too."""
    ship()

    @F.arrow_udf("double")
    def scored(texts: pa.Array) -> pa.Array:
        x = np.array([features(t.as_py(), model.good, model.bad) for t in texts])
        trim()
        z = (x.reshape(-1, FEATURES) - model.centres) / model.scales
        linear = model.weights[0] + z @ np.array(model.weights[1:])
        return pa.array(1 / (1 + np.exp(-np.clip(linear, -30, 30))))

    return scored(text)


def with_scores(
    docs: DataFrame, model: Model, text: str = "text", name: str = "score"
) -> DataFrame:
    """``docs`` with each row's score; a column called ``name`` is replaced, others stay.

    Rows are scored one by one: repeats get equal scores, and an empty table stays empty.
    """
    return docs.withColumn(name, score(F.col(text).cast("string"), model))
