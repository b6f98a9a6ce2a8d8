"""Removal of repeated passages by a depth-limited radix sort of suffixes.

Bytes that lie in a string of ``depth`` bytes which also starts elsewhere are found by sorting
suffixes through ``depth`` bytes only, most significant digits first; suffixes that end up in
the same group are the repeated strings. Sorting every suffix would move a row per byte, so the
passes are laid out such that almost all drop out before they are rows:

1. The first digit is ``GRAM`` bytes wide, and taken where its hash is the least of all such
   digits in a string of ``depth`` bytes. Equal strings have it at the same place, so each string
   belongs to one place (an anchor), and consecutive strings share it: one row for some
   ``depth`` / 2 strings. Anchors whose digit occurs once drop out with all their strings.
2. The second digit is the whole block of an anchor's strings. Blocks that occur twice are
   repeated as a whole: that settles copies and the inside of shared passages, one row a block.
3. Only the other blocks, at the ends of passages, are taken apart: into parts of ``PART`` strings
   with the same distance from their anchor, whose digit is what all strings of a part have in
   common; and what is left of these into single strings, grouped by their full depth.

Digits are compared by 128-bit hashes. Groups are only ever counted, map-side first, and joined
back, so no group meets in one task, however often a passage occurs.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm.common import ship, slices, trim
from stationlake.session import discard, materialise

GRAM, PART = 100, 16
#: Bytes that are hashed at a time, so that the arrays stay in a core's cache.
PIECE = 1 << 18
#: Odd multipliers of the hashes, and one that mixes.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
MIX = np.uint64(0xD6E8FEB86659FD93)


@functools.cache
def _powers(base: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        steps = np.full(count, b, np.uint64)
        steps[0] = 1
        out.append(np.cumprod(steps, dtype=np.uint64))
    return out[0], out[1]


class Hashes:
    """Hashes of all substrings of some bytes."""

    def __init__(self, data: np.ndarray, base: int):
        usual = len(data) < PIECE * 2
        # workers live on, so tables for longer data are not kept
        table, size = (_powers, PIECE * 2) if usual else (_powers.__wrapped__, len(data) + 1)
        self.up, self.down = table(base, size)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[: len(data)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def all(self, length: int) -> np.ndarray:
        """The hash of each substring of a length."""
        n = len(self.sums) - length
        return (self.sums[length:] - self.sums[:n]) * self.down[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * MIX
    return x ^ (x >> np.uint64(32))


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[: len(x) - step], x[step:])
        step *= 2
    if step < width:
        x = np.minimum(x[: len(x) - (width - step)], x[width - step :])
    return x


def _pieces(texts: pa.Array, depth: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Bytes of several texts in one array, with (text, first string, strings) of each part.

    Longer texts are cut into parts of ``PIECE`` strings, whose bytes overlap.
    """
    data, parts, size = [], [], 0
    for row, text in enumerate(texts):
        own = np.frombuffer((text.as_py() or "").encode("utf-8", "replace"), np.uint8)
        for first in range(0, len(own) - depth + 1, PIECE):
            part = own[first : first + PIECE + depth - 1]
            if size and size + len(part) > PIECE:
                yield np.concatenate(data), parts
                data, parts, size = [], [], 0
            data.append(part)
            parts.append((row, first, len(part) - depth + 1))
            size += len(part)
    if size:
        yield np.concatenate(data), parts


def anchors(texts: pa.Array, depth: int) -> tuple[np.ndarray, ...]:
    """Rows (text, first string, further strings, anchor, digit, block) of all anchors."""
    out = [[np.zeros(0, np.int64)] * 6]
    for data, parts in _pieces(texts, depth):
        one, two = (Hashes(data, b) for b in BASES)
        digits = mixed(one.all(GRAM))
        bits = np.uint64(int(len(data)).bit_length())
        places = np.arange(len(digits), dtype=np.uint64)
        packed = (digits >> bits << bits) | places  # equal digits: the first one
        least = _least(packed, depth - GRAM + 1) & ((np.uint64(1) << bits) - np.uint64(1))
        row, first, strings = (np.array(v, np.int64) for v in zip(*parts))
        begin = np.cumsum(strings + depth - 1) - (strings + depth - 1)
        for r, f, n, b in zip(row, first, strings, begin):
            own = least[b : b + n].astype(np.int64)
            cut = np.flatnonzero(own[1:] != own[:-1]) + 1
            low, high = np.r_[0, cut], np.r_[cut, n] - 1
            at = own[low]
            block = _pair(one, two, b + low, b + high + depth)
            of = np.full(len(low), r)
            out.append([of, f + low, high - low, f + at - b, digits[at].view(np.int64), block])
    return tuple(np.concatenate(c) for c in zip(*out))


def _pair(one: Hashes, two: Hashes, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed(one.of(start, end) ^ mixed(two.of(start, end))).view(np.int64)


def split(texts: pa.Array, rows: list[list[dict]], depth: int, part: int) -> tuple:
    """Rows as those of ``anchors``, each taken apart into parts of ``part`` strings.

    Parts are told apart by the distance of their strings from the anchor. The digit is what all
    strings of a whole part share (even if only some of them are in the row), the block all
    bytes of the row's strings.
    """
    out = [[np.zeros(0, np.int64)] * 6]
    for row, (text, own) in enumerate(zip(texts, rows)):
        data = np.frombuffer((text.as_py() or "").encode("utf-8", "replace"), np.uint8)
        for r in own:
            base = max(r["low"] - part, 0)
            near = data[base : r["low"] + r["more"] + depth + part]
            one, two = (Hashes(near, b) for b in BASES)
            strings = np.arange(r["low"], r["low"] + r["more"] + 1)
            group = (r["at"] - strings) // part
            cut = np.flatnonzero(group[1:] != group[:-1]) + 1
            low, high = strings[np.r_[0, cut]], strings[np.r_[cut, len(strings)] - 1]
            # the part's strings begin from at - (group + 1) * part + 1 to at - group * part
            last = r["at"] - group[np.r_[0, cut]] * part - base
            digit = _pair(one, two, last, last - part + 1 + depth)
            block = _pair(one, two, low - base, high - base + depth)
            of = np.full(len(low), row)
            out.append([of, low, high - low, np.full(len(low), r["at"]), digit, block])
    return tuple(np.concatenate(c) for c in zip(*out))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Texts with a key; only equal rows share one, and what holds for one holds for the other."""
    return docs.select(
        F.col(doc_id).cast("bigint").alias("id"),
        F.xxhash64(F.lit("suffix"), F.col(text)).alias("h"),
        F.col(text).cast("string").alias("t"),
    )


ROW = "id bigint, h bigint, low bigint, more int, at bigint, digit bigint, block bigint"


def _map(rows: DataFrame, work: Callable[[pa.RecordBatch], tuple]) -> DataFrame:
    """``work`` turns a batch into columns, the first of which says from which row each came."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole)):
            row, low, more, *columns = work(batch)
            keys = [batch.column(c).take(pa.array(row)) for c in ("id", "h")]
            own = [*keys, pa.array(low), pa.array(more.astype(np.int32)), *map(pa.array, columns)]
            yield pa.RecordBatch.from_arrays(own, [f.split()[0] for f in ROW.split(", ")])
        trim()

    return rows.mapInArrow(run, ROW)


def _settle(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What a digit pass settles, and one row of each block that the next pass has to split.

    Blocks that occur twice are repeated. Others can only share strings with blocks of the same
    digit, so they go on if there is another such block, and one of each of these with them.
    """
    place = F.struct("id", "h", "low", "more", "at")
    blocks = materialise(
        rows.groupBy("digit", "block").agg(
            F.count(F.lit(1)).alias("n"), F.min(place).alias("first")
        )
    )
    twice = blocks.where("n > 1").select("digit", "block")
    whole = rows.join(twice, ["digit", "block"]).select(
        "id", "h", "low", (F.col("low") + F.col("more")).alias("high")
    )
    whole = materialise(whole)
    unsettled = blocks.groupBy("digit").agg(F.sum("n").alias("all"), F.min("n").alias("least"))
    unsettled = unsettled.where("all > 1 AND least = 1").select("digit")
    left = materialise(blocks.join(unsettled, "digit", "left_semi").select("first.*"))
    discard(rows, blocks)
    return whole, left


def _with_rows(texts: DataFrame, left: DataFrame) -> DataFrame:
    """Texts with the rows that the next pass has to split."""
    lists = left.groupBy(F.col("id").alias("i"), F.col("h").alias("k")).agg(
        F.collect_list(F.struct("low", "more", "at")).alias("rows")
    )
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("k"))
    return texts.join(lists, same).drop("i", "k")


def spans(
    docs: DataFrame, depth: int = 200, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Runs of repeated strings: rows (id, h, low, high) of first bytes of strings.

    ``id`` and ``h`` are the key of ``_keyed``. Runs of a document may touch or overlap.
    """
    if depth < GRAM + PART:
        raise ValueError(f"depth must be at least {GRAM + PART} bytes")
    texts = _keyed(docs, doc_id, text).where(F.octet_length("t") >= depth)
    found = _map(texts, lambda batch: anchors(batch.column("t"), depth))
    # grouped by more than the digit, so that the join partitions both sides itself and Spark can
    # split the rows of a frequent digit
    digits = found.groupBy("digit", F.hash("digit").alias("_part")).count()
    digits = digits.where("count > 1").select("digit")
    rows = materialise(found.join(digits, "digit").select(found.columns))
    whole, left = _settle(rows)
    # texts that still matter; copies of a row are read once
    own = left.select("id", "h").distinct().select(F.col("id").alias("i"), F.col("h").alias("k"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.col("h") == F.col("k"))
    texts = texts.join(own, same, "left_semi").dropDuplicates(["id", "h"])
    texts = materialise(texts)
    for part in (PART, 1):
        rows = _map(
            _with_rows(texts, left),
            lambda batch, part=part: split(
                batch.column("t"), batch.column("rows").to_pylist(), depth, part
            ),
        )
        more, left = _settle(materialise(rows))
        whole = whole.unionByName(more)
    discard(texts)
    return whole


def _covered(text: Column, runs: Column, depth: int) -> Column:
    """Struct (n_bytes, n_removed, n_spans, kept) of a text and the runs of its strings."""

    @F.arrow_udf("n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    def cover(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for text, own in zip(texts, lists):
            data = (text.as_py() or "").encode("utf-8", "replace")
            pieces, at, removed, count = [], 0, 0, 0
            for low, high in sorted((r["low"], r["high"] + depth) for r in own.as_py() or ()):
                if low > at or not count:
                    pieces.append(data[at:low])
                    count += 1
                    removed += high - low
                else:
                    removed += max(high - at, 0)
                at = max(at, high)
            pieces.append(data[at:])
            out.append((len(data), removed, count, b"".join(pieces)))
        names = ["n_bytes", "n_removed", "n_spans", "kept"]
        kinds = [pa.int64()] * 3 + [pa.binary()]
        columns = zip(*out) if out else [()] * 4
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return cover(text, runs)


def dedupe(
    docs: DataFrame, depth: int = 200, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``docs`` without the bytes that lie in a repeated string of ``depth`` bytes.

    Whole texts are read as UTF-8 and strings never cross documents; those that overlap count,
    and all is judged on the input. Added are n_bytes, n_removed, n_spans (maximal removed runs)
    and kept (binary: the other bytes, which need not be UTF-8 at the cuts); columns of these
    names are replaced. Null texts count as empty and shorter texts than ``depth`` stay whole.
    Repeated rows repeat each other's strings, and so lose them. An empty table stays empty.
    """
    ship()
    runs = (
        spans(docs, depth, doc_id, text)
        .groupBy(F.col("id").alias("_id"), F.col("h").alias("_h"))
        .agg(F.collect_set(F.struct("low", "high")).alias("_runs"))
    )
    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    rows = docs.drop(*names).withColumn("_k", F.xxhash64(F.lit("suffix"), F.col(text)))
    same = F.col(doc_id).cast("bigint").eqNullSafe(F.col("_id")) & (F.col("_k") == F.col("_h"))
    cut = _covered(F.col(text).cast("string"), F.col("_runs"), depth)
    joined = rows.join(runs, same, "left").withColumn("_cut", cut)
    return joined.select(*rows.drop("_k").columns, *[F.col("_cut")[n].alias(n) for n in names])
