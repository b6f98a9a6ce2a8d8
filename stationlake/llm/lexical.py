"""Ranked lexical search for many items at once, sharing the sums of common term sets.

Scores are whole numbers in the manner of BM25, given in ``search``. All items of a block are
answered in two passes over the documents:

1. Every text is cut into terms once. A document keeps its number of terms and how often it has
   each term that some item asks for; from these rows Spark counts documents, terms and the
   documents of each term.
2. Every document adds up its terms for all items together. Which sums are worth sharing is mined
   beforehand: pairs of operands that at least two items have in common become a node, round
   after round, so that nodes stand for ever larger shared term sets. The nodes form a graph in
   which each partial sum of a document is computed once, level by level, and an item's score is
   the sum of the few nodes and terms that make up its term set.

A task keeps the best rows of each item and hands on no others; Spark merges them by rank.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ship, slices
from stationlake.session import discard, materialise

#: Items and bytes of their texts that are answered in one pass over the documents. Larger tables
#: of items take several passes; no result depends on it.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 8_000_000
#: Operands of an item, in order of frequency, among which a shared pair is looked for.
REACH = 16
#: Numbers in the table of partial sums that a task holds.
CELLS = 2_000_000

# Terms are runs of ASCII letters, ASCII digits and all characters beyond ASCII.
# In UTF-8 every byte of the latter is 128 or more, so that texts can be cut as bytes.
_FOLD = bytes(range(256)).lower()
_CUT = bytes(_FOLD[b] if b >= 128 or chr(b).isalnum() else ord(" ") for b in range(256))


def terms(text: bytes) -> list[bytes]:
    """The terms of a UTF-8 text in order; only A to Z are lower-cased."""
    return text.translate(_CUT).split()


class Sharing:
    """The graph of partial sums for some term sets, given as lists of term numbers.

    ``levels`` has pairs of rows to add, level by level; their sums take the rows after the
    terms. ``operands`` has the rows of all sets, one set after the other from ``starts``.
    """

    def __init__(self, sets: Sequence[Sequence[int]], n_terms: int):
        often = Counter(t for s in sets for t in s)
        lists = [sorted(s, key=lambda t: (-often[t], t)) for s in sets]
        depth: dict[int, int] = dict.fromkeys(range(n_terms), 0)
        made: dict[tuple[int, int], int] = {}
        while True:
            common = Counter(p for ops in lists for p in _pairs(ops))
            merged = False
            for at, ops in enumerate(lists):
                found = {p for p in _pairs(ops) if common[p] > 1}
                used: dict[int, int | None] = {}
                for pair in sorted(found, key=lambda p: (-common[p], p)):
                    if pair[0] in used or pair[1] in used:
                        continue
                    if pair not in made:
                        made[pair] = len(depth)
                        depth[len(depth)] = 1 + max(depth[pair[0]], depth[pair[1]])
                    used |= {pair[0]: made[pair], pair[1]: None}
                if used:
                    merged = True
                    kept = (used.get(o, o) for o in ops)
                    lists[at] = [o for o in kept if o is not None]
            if not merged:
                break
        # rows are numbered anew, so that each level is one run of rows
        order = sorted(depth, key=lambda n: (depth[n], n))
        row = {n: i for i, n in enumerate(order)}
        parts = {n: pair for pair, n in made.items()}
        levels: dict[int, list[tuple[int, int]]] = {}
        for n in order[n_terms:]:
            left, right = parts[n]
            levels.setdefault(depth[n], []).append((row[left], row[right]))
        self.levels = [np.array(levels[d]).T for d in sorted(levels)]
        self.operands = np.array([row[o] for ops in lists for o in ops], np.int64)
        self.starts = np.concatenate([[0], np.cumsum([len(ops) for ops in lists])])[:-1]
        self.starts = self.starts.astype(np.int64)
        self.rows = len(depth)

    def sums(self, table: np.ndarray) -> np.ndarray:
        """The sums of all sets by column; ``table`` has a row per term and room for the nodes."""
        at = self.rows - sum(level.shape[1] for level in self.levels)
        for left, right in self.levels:
            np.add(table[left], table[right], out=table[at : at + len(left)])
            at += len(left)
        return np.add.reduceat(table[self.operands], self.starts, axis=0)


def _pairs(ops: list[int]) -> Iterator[tuple[int, int]]:
    """Pairs of near operands, smaller number first."""
    for i, a in enumerate(ops):
        for b in ops[i + 1 : i + 1 + REACH]:
            yield (a, b) if a < b else (b, a)


class _Best:
    """The best documents of each item so far, highest score first, then least id, nulls last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.least = np.ones(items, np.int64)  # a score must be above 0
        nothing = np.zeros(0, np.int64)
        self.found = [(nothing, nothing, nothing.astype(bool))] * items

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document."""
        for item in np.flatnonzero((scores >= self.least[:, None]).any(axis=1)):
            at = np.flatnonzero(scores[item] >= self.least[item])
            own = zip(self.found[item], (scores[item, at], ids[at], missing[at]))
            s, d, m = (np.concatenate(x) for x in own)
            first = np.lexsort((d, m, -s))[: self.k]
            self.found[item] = s[first], d[first], m[first]
            if len(first) == self.k:
                self.least[item] = s[first[-1]]


def occurrences(
    docs: DataFrame, vocabulary: dict[bytes, int], doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """``doc_id, n, terms, tfs`` for every document with a term.

    ``n`` counts all its terms; ``terms`` and ``tfs`` have those of the vocabulary only.
    """
    ship()
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n", pa.int64()), ("terms", pa.list_(pa.int32())),
         ("tfs", pa.list_(pa.int64()))]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                out: tuple[list, list, list, list] = ([], [], [], [])
                for number, value in zip(part.column(0).to_pylist(), part.column(1)):
                    own = terms(value.as_py()) if value.is_valid else []
                    if own:
                        counts = Counter(own)
                        asked = sorted((vocabulary[t], counts[t]) for t in counts.keys() & known)
                        row = number, len(own), [t for t, _ in asked], [n for _, n in asked]
                        for column, x in zip(out, row):
                            column.append(x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, f.type) for x, f in zip(out, schema)], schema=schema
                )

    known = vocabulary.keys()
    texts = F.col(text).cast("string").cast("binary")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), texts.alias("text")).mapInArrow(
        count, "doc_id long, n long, terms array<int>, tfs array<long>"
    )


def _length_norm(n: int, documents: int, total: int) -> int:
    return 10 + 90 * n * documents // total


def _scored(
    found: DataFrame,
    sharing: Sharing,
    weights: np.ndarray,
    items: list[tuple[int, int | None]],
    documents: int,
    total: int,
    k: int,
) -> DataFrame:
    """Per task, the ``k`` best documents of each item: ``item, item_id, doc_id, score``."""
    ship()
    wide = max(1, min(512, CELLS // max(sharing.rows, len(sharing.operands), 1)))
    n_terms = len(weights)

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(items), k)
        for batch in batches:
            for part in slices(batch, wide):
                ids = part.column(0)
                lists, tfs = part.column(2), part.column(3)
                lengths = np.diff(lists.offsets.to_numpy())
                norm = [_length_norm(n, documents, total) for n in part.column(1).to_pylist()]
                norm = np.repeat(np.array(norm, np.int64), lengths)
                term = lists.flatten().to_numpy()
                tf = tfs.flatten().to_numpy()
                table = np.zeros((sharing.rows, part.num_rows), np.int64)
                column = np.repeat(np.arange(part.num_rows), lengths)
                table[term, column] = weights[term] * (10**9 * tf // (1000 * tf + 8 * norm))
                missing = ids.is_null().to_numpy(zero_copy_only=False)
                best.add(sharing.sums(table), ids.fill_null(0).to_numpy(), missing)
        for (item, item_id), (s, d, m) in zip(items, best.found):
            if len(s):
                yield pa.RecordBatch.from_pydict(
                    {
                        "item": pa.array([item] * len(s), pa.int64()),
                        "item_id": pa.array([item_id] * len(s), pa.int64()),
                        "doc_id": pa.array(d, pa.int64(), mask=m),
                        "score": pa.array(s, pa.int64()),
                    }
                )

    return found.mapInArrow(rank, "item long, item_id long, doc_id long, score long")


def weight(documents: int, having: Column) -> Column:
    """How much a term counts that ``having`` of the documents have."""
    share = F.lit(float(2 * documents + 2)) / (2 * having + 1)
    return F.floor(F.lit(1000.0) * F.log(share))


def _blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, bytes]]]:
    """The items with their texts, as many as are answered together."""
    block, size = [], 0
    texts = F.col(text).cast("string").cast("binary")
    rows = items.select(F.col(item_id).cast("long"), texts).toLocalIterator()
    for number, value in rows:
        if block and (len(block) == BLOCK_ITEMS or size + len(value or b"") > BLOCK_BYTES):
            yield block
            block, size = [], 0
        block.append((number, bytes(value or b"")))
        size += len(value or b"")
    if block:
        yield block


def _answer(
    docs: DataFrame, items: list, first: int, k: int, **names: str
) -> DataFrame | None:
    """The best documents of one block of items, ranked; None if no item has a term."""
    asked = [(first + i, number, set(terms(text))) for i, (number, text) in enumerate(items)]
    asked = [(i, number, own) for i, number, own in asked if own]
    if not asked:
        return None
    vocabulary = {t: i for i, t in enumerate(sorted(set().union(*(own for *_, own in asked))))}
    sharing = Sharing([sorted(vocabulary[t] for t in own) for *_, own in asked], len(vocabulary))
    found = materialise(occurrences(docs, vocabulary, **names))
    documents, total = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    weights = np.zeros(len(vocabulary), np.int64)  # a term that no document has gives no score
    having = found.select(F.explode("terms").alias("term")).groupBy("term").count()
    for term, value in having.select("term", weight(documents, F.col("count"))).collect():
        weights[term] = value
    numbers = [(i, number) for i, number, _ in asked]
    scored = _scored(found, sharing, weights, numbers, documents, total, k)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    rank = F.row_number().over(Window.partitionBy("item").orderBy(*order))
    ranked = scored.withColumn("rank", rank).where(F.col("rank") <= k)
    result = materialise(ranked.select("item_id", "rank", "doc_id", "score"))
    discard(found)
    return result


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``k`` best documents with a score above 0.

    A document's score is the sum of ``w * (10^9 tf div (1000 tf + 8 m))`` over the distinct
    terms of the item, with ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))`` and
    ``m = 10 + (90 n N) div L``: N documents with a term, L terms in all, n in the document, df
    documents with the term, tf times in this one. Equal scores come by ascending ``doc_id``.

    Null and empty texts have no terms: such a document counts nowhere, such an item has no rows.
    Null ids are kept and come last among equal scores. Repeated rows are documents, or items, of
    their own. Empty tables give no rows, and other columns play no part. A long text is held by
    one task, with its terms.
    """
    spark = docs.sparkSession
    result, first = None, 0
    for block in _blocks(items, item_id, item_text):
        found = _answer(docs, block, first, k, doc_id=doc_id, text=text)
        first += len(block)
        if found is not None:
            result = found if result is None else result.unionByName(found)
    if result is None:
        spark = docs.sparkSession
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return result
