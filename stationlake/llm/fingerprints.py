"""Fingerprints of texts from which the paragraphs that differ can be read back.

A fingerprint is an invertible Bloom lookup sketch: a fixed number of cells, each with a count, a
sum of digests and a sum of their checks (sums modulo 2^64). A digest of every piece of the text
goes into one cell of each of four tables. Two fingerprints are subtracted cell by cell, which
takes out all pieces that both texts have. What is left is peeled: a cell whose count is 1 or -1
and whose check fits holds a single digest, which is taken out of its other cells, and so on.
Where peeling gets stuck, both texts' digests go into sketches four times as large, until it
succeeds.

Pieces are the sentences of each paragraph (a line), so that texts of one paragraph can be told
apart by degrees too; sentences over ``LONGEST`` characters are cut. The j-th repeat of a piece
has a digest of its own, which makes a text's digests a set. Pieces come without white space
around them, and their order plays no part. Texts without pieces have the empty fingerprint.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ship

#: Cells of a fingerprint; some half as many differing pieces can be read from two of them.
CELLS = 16
#: Tables that a digest goes to.
TABLES = 4
#: Characters of a piece at most.
LONGEST = 64
#: Cells that are peeled at a time; no result depends on it.
WIDE = 1_000_000
#: Texts, and their characters, that are compared at a time; no result depends on it.
BATCH_TEXTS, BATCH_CHARS = 256, 2_000_000
#: Rows that are sampled for each range of documents; balance depends on it, no result does.
SAMPLE = 20

_CELL = np.dtype([("count", "<i4"), ("digest", "<u8"), ("check", "<u8")])
_MIX = [np.uint64(0x9E3779B97F4A7C15 * (2 * i + 1) % 2**64) for i in range(TABLES + 1)]


def pieces(text: str) -> list[str]:
    """The pieces of a text, in order."""
    for mark in ".!?":
        text = text.replace(mark + " ", mark + "\n")
    out = []
    for piece in text.split("\n"):
        piece = piece.strip()
        if len(piece) <= LONGEST:
            if piece:
                out.append(piece)
        else:
            out += [piece[i : i + LONGEST] for i in range(0, len(piece), LONGEST)]
    return out


def digests(text: str | None) -> np.ndarray:
    """A 64-bit digest of each piece and repeat."""
    seen: dict[str, int] = {}
    out = []
    for piece in pieces(text or ""):
        n = seen.get(piece, 0)
        seen[piece] = n + 1
        out.append(xxhash.xxh3_64_intdigest(piece, n))
    return np.array(out, np.uint64)


def _mixed(values: np.ndarray, which: int, salt: int) -> np.ndarray:
    mixed = (values ^ (values >> np.uint64(29)) ^ np.uint64(salt)) * _MIX[which]
    mixed = (mixed ^ (mixed >> np.uint64(32))) * _MIX[0]
    return mixed >> np.uint64(32)


def _check(values: np.ndarray) -> np.ndarray:
    return _mixed(values, TABLES, 1)


def _places(values: np.ndarray, cells: int) -> np.ndarray:
    """The cells of each digest, a row per table."""
    each = np.uint64(cells // TABLES)
    places = [_mixed(values, t, cells) * each >> np.uint64(32) for t in range(TABLES)]
    return np.array([p + np.uint64(t) * each for t, p in enumerate(places)]).astype(np.int64)


class Sketches:
    """Sketches of equal size, one per row of ``count``, ``digest`` and ``check``."""

    def __init__(self, rows: int, cells: int):
        self.cells = cells
        self.count = np.zeros((rows, cells), np.int64)
        self.digest = np.zeros((rows, cells), np.uint64)
        self.check = np.zeros((rows, cells), np.uint64)

    def add(self, row: np.ndarray, values: np.ndarray, sign: np.ndarray) -> None:
        """Put digests into the sketches of the given rows, or take them out (sign -1)."""
        at = (_places(values, self.cells) + row * self.cells).ravel()
        as_sum = sign.astype(np.uint64)  # -1 becomes 2^64 - 1
        for table, x in (
            (self.count, sign),
            (self.digest, values * as_sum),
            (self.check, _check(values) * as_sum),
        ):
            np.add.at(table.reshape(-1), at, np.tile(x, TABLES))

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Take out all that can be read: (row, digest, sign), and which rows are empty now."""
        found = []
        count, digest, check = (x.reshape(-1) for x in (self.count, self.digest, self.check))
        while True:
            at = np.flatnonzero(np.abs(count) == 1)
            sign = count[at]
            value = digest[at] * sign.astype(np.uint64)
            fits = _check(value) * sign.astype(np.uint64) == check[at]
            row, value, sign = at[fits] // self.cells, value[fits], sign[fits]
            if not len(row):
                break
            order = np.lexsort((value, row))
            row, value, sign = row[order], value[order], sign[order]
            new = np.ones(len(row), bool)  # a digest may be alone in several of its cells
            new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
            row, value, sign = row[new], value[new], sign[new]
            self.add(row, value, -sign)
            found.append((row, value, sign))
        empty = ~(self.count.any(axis=1) | self.digest.any(axis=1) | self.check.any(axis=1))
        row, value, sign = (np.concatenate(x) for x in zip(*found)) if found else (
            np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        )
        return row, value, sign, empty


def _difference(
    left: Sequence[np.ndarray], right: Sequence[np.ndarray], cells: int
) -> Sketches:
    """The sketches of the left sets less those of the right sets."""
    out = Sketches(len(left), cells)
    for sets, sign in ((left, 1), (right, -1)):
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        out.add(row, np.concatenate(sets), np.full(len(row), sign))
    return out


Recovered = tuple[np.ndarray, np.ndarray, int]


def recover(
    left: Sequence[np.ndarray], right: Sequence[np.ndarray], cells: int = CELLS
) -> list[Recovered]:
    """For each pair of sets the digests of the left one alone, of the right one alone, and the
    cells that it took; pairs that get stuck are tried again with four times as many.

    Should two pieces of a text share their digest, no size helps; such sets are compared
    directly once the cells are many times the digests (0 cells).
    """
    out: list[Recovered | None] = [None] * len(left)
    todo = list(range(len(left)))
    while todo:
        stuck = []
        step = max(1, WIDE // cells)
        for start in range(0, len(todo), step):
            part = todo[start : start + step]
            rest = _difference([left[i] for i in part], [right[i] for i in part], cells)
            row, value, sign, empty = rest.peel()
            order = np.lexsort((value, row))
            row, value, sign = row[order], value[order], sign[order]
            ends = np.searchsorted(row, np.arange(len(part) + 1))
            for n, i in enumerate(part):
                own = slice(ends[n], ends[n + 1])
                if empty[n]:
                    v, s = value[own], sign[own]
                    out[i] = v[s > 0], v[s < 0], cells
                elif cells > 64 * (len(left[i]) + len(right[i]) + 1):
                    out[i] = np.setdiff1d(left[i], right[i]), np.setdiff1d(right[i], left[i]), 0
                else:
                    stuck.append(i)
        todo, cells = stuck, cells * 4
    return out


def likeness(left: int, right: int, differing: int) -> float:
    """Shared digests among all of both sets, by the sets' sizes; 1 if both are empty."""
    shared = (left + right - differing) // 2
    return shared / (shared + differing) if shared + differing else 1.0


def written(sets: Sequence[np.ndarray], cells: int = CELLS) -> list[str]:
    """The fingerprints of sets of digests, as text."""
    if not sets:
        return []
    sketches = _difference(sets, [np.zeros(0, np.uint64)] * len(sets), cells)
    packed = np.zeros(sketches.count.shape, _CELL)
    for field in _CELL.names:
        packed[field] = getattr(sketches, field)
    return [base64.b64encode(row.tobytes()).decode() for row in packed]


def read_difference(one: str, other: str) -> tuple[np.ndarray, np.ndarray] | None:
    """The digests in one fingerprint alone and in the other alone; None if they are too many."""
    cells = [np.frombuffer(base64.b64decode(x), _CELL) for x in (one, other)]
    rest = Sketches(1, len(cells[0]))
    rest.count[0] = cells[0]["count"].astype(np.int64) - cells[1]["count"]
    rest.digest[0] = cells[0]["digest"] - cells[1]["digest"]
    rest.check[0] = cells[0]["check"] - cells[1]["check"]
    _, value, sign, empty = rest.peel()
    return (np.sort(value[sign > 0]), np.sort(value[sign < 0])) if empty[0] else None


def with_fingerprint(docs: DataFrame, text: str = "text", name: str = "fingerprint") -> DataFrame:
    """``docs`` with the fingerprint of each whole text; null counts as empty.

    Equal texts have equal fingerprints. Other columns stay; one called ``name`` is replaced.
    """
    ship()

    @F.arrow_udf("string")
    def fingerprint(texts: pa.Array) -> pa.Array:
        return pa.array(written([digests(t.as_py()) for t in texts]), pa.string())

    return docs.withColumn(name, fingerprint(F.col(f"`{text}`").cast("string")))


def with_differences(
    df: DataFrame, old: str, new: str, name: str = "differences"
) -> DataFrame:
    """``df`` with the digests of the pieces that only one of two versions has.

    ``name`` is a struct of ``removed`` and ``added`` (arrays of long, ascending as unsigned
    numbers), ``likeness``, and ``cells``: those of the sketches that could be peeled. Nulls count
    as empty texts. Other columns stay; one called ``name`` is replaced.
    """
    ship()
    kind = "struct<removed: array<long>, added: array<long>, likeness: double, cells: long>"

    @F.arrow_udf(kind)
    def differences(olds: pa.Array, news: pa.Array) -> pa.Array:
        sides = [[digests(t.as_py()) for t in texts] for texts in (olds, news)]
        rows = [
            {
                "removed": removed.view(np.int64),
                "added": added.view(np.int64),
                "likeness": likeness(len(a), len(b), len(removed) + len(added)),
                "cells": cells,
            }
            for a, b, (removed, added, cells) in zip(*sides, recover(*sides))
        ]
        longs = pa.list_(pa.int64())
        fields = [("removed", longs), ("added", longs), ("likeness", pa.float64()), ("cells", pa.int64())]
        return pa.array(rows, pa.struct(fields))

    return df.withColumn(
        name, differences(F.col(f"`{old}`").cast("string"), F.col(f"`{new}`").cast("string"))
    )


def _in_ranges(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``bucket, ahead, doc_id, row, text``: documents in ranges of ascending ids, a task each.

    Every range begins with a document that is known beforehand. A copy of it, marked ``ahead``,
    also goes to the range before, so that each document meets the next one in its own task.
    That of the first range of all goes to the last range.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
        F.monotonically_increasing_id().alias("row"),
    )
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = rows.select("doc_id", "row")
    first = keys.agg(F.min(F.struct("doc_id", "row"))).first()[0]
    if first is None:
        bounds = []
    else:
        sample = keys.orderBy(F.xxhash64("row"), "row").limit(SAMPLE * ranges).collect()
        found = sorted(_key(*r) for r in sample)
        step = max(1, -(-len(found) // ranges))
        bounds = sorted({_key(*first), *found[step::step]})

    @F.arrow_udf("array<struct<bucket: int, ahead: boolean>>")
    def places(ids: pa.Array, numbers: pa.Array) -> pa.Array:
        out = []
        for key in map(_key, ids.to_pylist(), numbers.to_pylist()):
            bucket = bisect_right(bounds, key) - 1
            own = [{"bucket": bucket, "ahead": False}]
            if key == bounds[bucket]:
                own.append({"bucket": (bucket - 1) % len(bounds), "ahead": True})
            out.append(own)
        place = pa.struct([("bucket", pa.int32()), ("ahead", pa.bool_())])
        return pa.array(out, pa.list_(place))

    ship()
    placed = rows.withColumn("place", F.explode(places("doc_id", "row")))
    return (
        placed.select("place.bucket", "place.ahead", "doc_id", "row", "text")
        .repartitionById(max(1, len(bounds)), F.col("bucket"))
        .sortWithinPartitions("bucket", "ahead", F.col("doc_id").asc_nulls_first(), "row")
    )


def _key(doc_id: int | None, row: int) -> tuple[bool, int, int]:
    """Sorts like ``doc_id`` with nulls first, then ``row``."""
    return doc_id is not None, doc_id or 0, row


def edited(text: str, following: str) -> str:
    """``text`` with its second half replaced by as much of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_COMPARED = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
     ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
     ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """The rows of all documents but the last, which only follows."""
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    own, new = [digests(t) for t in texts], [digests(t) for t in changed]

    def near(others: list[np.ndarray]) -> list[float]:
        return [
            likeness(len(a), len(b), len(one) + len(other))
            for a, b, (one, other, _) in zip(own, others, recover(own[:-1], others))
        ]

    columns = [
        ids[:-1],
        [len(t) for t in texts[:-1]],
        [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        written(own[:-1]),
        written(new),
        near(new),
        near(own[1:]),
    ]
    arrays = [pa.array(x, f.type) for x, f in zip(columns, _COMPARED)]
    return pa.RecordBatch.from_arrays(arrays, schema=_COMPARED)


def compare_edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each document's fingerprint beside those of an edited version and of the next document.

    The next document is that of the next greater id; null ids come first, rows that repeat an
    id follow each other in the table's order, and the first row follows the last one. ``docs``
    must give its rows in the same order when read twice, as a stored table does. In the edited
    text the last ``floor(n_chars / 2)`` characters are replaced by the first as many, or all, of
    the next text. Null texts count as empty. An empty table gives no rows; other columns are
    left out.

    Texts are shuffled once, to ranges of documents; a task holds a few hundred at a time, and a
    long text on its own.
    """
    ship()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        at, size = None, 0
        for batch in batches:
            for bucket, ahead, number, value in zip(*(batch.column(i) for i in (0, 1, 2, 4))):
                if at != bucket.as_py():
                    at, ids, texts, size = bucket.as_py(), [], [], 0
                ids.append(number.as_py())
                texts.append(value.as_py())
                size += len(texts[-1])
                if len(texts) > 1 and (
                    ahead.as_py() or len(texts) > BATCH_TEXTS or size > BATCH_CHARS
                ):
                    yield _compared(ids, texts)
                    ids, texts = ids[-1:], texts[-1:]
                    size = len(texts[0])

    return _in_ranges(docs, doc_id, text).mapInArrow(
        compare,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
