"""Exact top-k search over postings by MaxScore.

A component and its sign are a term; a row has a posting for each of its components other than
0, in blocks of rows with an upper bound per term and block. For a query, the terms that can
raise a score are sorted by their bounds in the block. As long as the smallest bounds add up to
less than the k-th best score so far, rows that have only these terms cannot enter: the other
terms are essential, and only their postings are traversed. Rows found there are probed for the
remaining terms from the largest bound down, as long as they can still compete. Terms of the
opposite sign only lower a score and are probed last, rows that fall behind being dropped. Until
``k`` rows are known, and while the k-th score is not above 0, all terms are essential. The first
blocks of a shard are small, so that there is a k-th score soon.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable
from fractions import Fraction

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm import vectors as vec

#: Rows of the first block of a shard; each is twice as large as the one before, up to the last.
FIRST_BLOCK, BLOCK = 128, 4_096
#: Terms that are probed at a time.
PROBED = 8
#: Scores are 64-bit integers.
LEAST_LONG, MOST_LONG = -(2**63), 2**63 - 1


def weights(x: np.ndarray, scale: int) -> np.ndarray:
    """Integer weights of components: 64-bit ones, or Python's integers where these do not do."""
    if not x.size or np.abs(x).max() < 2**52 / scale:
        return np.floor(x * float(scale)).astype(np.int64)
    return _exact_weights(x, scale)


def _exact_weights(x: np.ndarray, scale: int) -> np.ndarray:
    floor = np.frompyfunc(lambda v: math.floor(Fraction(float(v)) * scale), 1, 1)
    return floor(x).astype(object)


class _Block:
    """The postings of consecutive rows."""

    def __init__(self, ids: np.ndarray, w: np.ndarray):
        self.ids, self.w, self.columns = ids, w, np.ascontiguousarray(w.T)
        rows, sizes, ends = [], [], [0]
        self.bound = np.zeros((2, w.shape[1]), w.dtype)
        for sign, strength in enumerate((w, -w)):
            for d in range(w.shape[1]):
                own = np.flatnonzero(strength[:, d] > 0).astype(np.int32)
                rows.append(own)
                sizes.append(strength[own, d])
                ends.append(ends[-1] + len(own))
                self.bound[sign, d] = sizes[-1].max() if len(own) else 0
        self.rows = np.concatenate(rows) if rows else np.zeros(0, np.int32)
        self.sizes = np.concatenate(sizes) if sizes else np.zeros(0, w.dtype)
        self.ends = ends

    def _traverse(self, terms: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the postings of some terms add to each row, and the rows that have any."""
        ranges = [slice(self.ends[t], self.ends[t + 1]) for t in terms.tolist()]
        total = np.zeros(len(self.ids), self.w.dtype)
        seen = np.zeros(len(self.ids), bool)
        if ranges:
            rows = np.concatenate([self.rows[r] for r in ranges])
            parts = [self.sizes[r] * v for r, v in zip(ranges, weights)]
            np.add.at(total, rows, np.concatenate(parts))
            seen[rows] = True
        return total, seen

    def offer(self, query_id: int, q: np.ndarray, least: int | None) -> tuple:
        """Places and scores of all rows that reach ``least`` (of all, if it is None).

        Only rows of an essential term are looked at if a score above 0 is needed.
        """
        used = np.flatnonzero(q)
        signs = (q[used] < 0).astype(int)
        bounds = np.abs(q[used]) * self.bound[signs, used]
        order = np.argsort(bounds, kind="stable")
        sums = np.cumsum(bounds[order])
        competing = least is not None and least > 0
        split = int(np.searchsorted(sums, least)) if competing else 0  # those add up to less
        first = order[split:]
        total, seen = self._traverse(signs[first] * len(q) + used[first], np.abs(q[used[first]]))
        if not competing:
            seen[:] = True
        seen &= self.ids != query_id
        rest = sums[split - 1] if split else 0
        near = np.flatnonzero(seen if least is None else seen & (total + rest >= least))
        have = total[near]
        against = np.abs(q[used]) * self.bound[1 - signs, used]
        lowering = np.argsort(-against, kind="stable")
        for terms, limit in ((order[:split][::-1], np.maximum), (lowering, np.minimum)):
            for i in range(0, len(terms), PROBED):
                some = terms[i : i + PROBED]
                parts = self.columns[used[some]].take(near, axis=1) * q[used[some], None]
                have = have + limit(parts, 0).sum(axis=0)
                if limit is np.maximum:
                    rest -= bounds[some].sum()
                if least is not None:
                    keep = have + rest >= least
                    near, have = near[keep], have[keep]
        return near, have


def _cuts(n: int) -> list[tuple[int, int]]:
    """First and last place of each block."""
    out, start, size = [], 0, min(FIRST_BLOCK, BLOCK)
    while start < n:
        out.append((start, min(start + size, n)))
        start, size = start + size, min(2 * size, BLOCK)
    return out


def index(ids: np.ndarray, x: np.ndarray, k: int, scale: int) -> Callable:
    """Postings of rows in the order of their ids, as a function that searches them."""
    cuts = _cuts(len(ids))

    def blocks(w: np.ndarray) -> list[_Block]:
        return [_Block(ids[a:b], w[a:b]) for a, b in cuts]

    w = weights(x, scale)
    quick = blocks(w)
    largest = [int(m) for m in np.abs(w).max(axis=0, initial=0)]

    @functools.cache
    def exact() -> list[_Block]:
        return quick if w.dtype == object else blocks(w.astype(object))

    def find(query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        q = weights(query, scale)
        most = sum(m * abs(int(v)) for m, v in zip(largest, q))
        fits = w.dtype != object and q.dtype != object and most < 2**62
        number = np.int64 if fits else object
        q = q.astype(number)
        places, scores = np.zeros(0, np.int64), np.zeros(0, number)
        for (start, _), block in zip(cuts, quick if fits else exact()):
            least = scores.min() if len(scores) == k else None
            more, values = block.offer(query_id, q, least)
            if not fits:
                values = np.array([min(max(v, LEAST_LONG), MOST_LONG) for v in values], object)
            places, scores = np.r_[places, more + start], np.r_[scores, values]
            top = vec.best(scores, ids[places], k)
            places, scores = places[top], scores[top]
        return places, scores.astype(np.int64)

    return find


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    scale: int = 256,
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """The ``k`` highest integer inner products for each row that is a query, exactly.

    Components x become floor(``scale`` * x), of any size. Returns query_id, rank (from 1), vec_id
    and score; ties go to smaller ids. Scores that a long cannot hold become the nearest long. A
    query's own id is no candidate;
    with fewer candidates than ``k`` all are returned. Vectors that are null or hold null or
    non-finite components take no part, nor do null ids; zero and empty vectors have score 0,
    and shorter vectors count as filled up with zeros. Repeated rows are candidates of their
    own, and a repeated query is asked once. Other columns are ignored.
    """
    rows = vectors.where(vec.sound(vector) & F.col(vec_id).isNotNull())

    def make(ids: np.ndarray, x: np.ndarray) -> Callable:
        return index(ids, x, k, scale)

    return vec.search(rows, is_query, k, make, vec_id, vector, "bigint")
