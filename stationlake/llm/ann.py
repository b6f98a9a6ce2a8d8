"""Approximate nearest neighbours by collision counting over single projections.

Every shard of rows has ``PROJECTIONS`` random projections, each kept as a sorted array of its
rows' values. A query opens a window around its own value in every array and counts for each row
in how many windows it lies; virtual rehashing widens all windows by a factor until enough rows
reach the collision threshold. All of these, not some of them, are verified by their exact inner
product. Where a first window holds more than half of an array, the rows beside it are counted
instead, which gives the same collisions.

Inner products become distances by one more component that gives all rows the same norm; it is 0
for queries, so it shows in the projections only.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.llm import vectors as vec

PROJECTIONS = 64
#: Share of the projections in which a row must meet the query.
THRESHOLD = 0.8
#: Windows are widened until this share of a shard's rows, but at least so many, pass.
SHARE, LEAST = 0.08, 500
#: First half width of the windows, in standard deviations of a projection, and its growth.
WIDTH, GROWTH = 1.35, 1.12


def _directions(width: int, count: int, seed: int) -> np.ndarray:
    """Orthogonal directions as long as there are any, of unit variance on the unit sphere."""
    rng = np.random.default_rng(seed)
    parts = []
    while sum(p.shape[1] for p in parts) < count:
        parts.append(np.linalg.qr(rng.normal(size=(width, width)))[0] * np.sqrt(width))
    return np.concatenate(parts, axis=1)[:, :count]


def _windows(arrays: list[np.ndarray], at: np.ndarray, reach: float) -> tuple[list, list]:
    """First places inside and after the window around a query's value in each sorted array."""
    low, high = zip(*(a.searchsorted((v - reach, v + reach)).tolist() for a, v in zip(arrays, at)))
    return list(low), list(high)


def _times(parts: list[np.ndarray], n: int) -> np.ndarray:
    """How often each of ``n`` rows comes."""
    return np.bincount(np.concatenate(parts), minlength=n) if parts else np.zeros(n, np.int64)


def index(ids: np.ndarray, x: np.ndarray, k: int, seed: int = 0) -> Callable:
    """Sorted projections of rows in the order of their ids, as a function that searches them."""
    n, width = x.shape
    norms = np.sqrt((x * x).sum(axis=1))
    longest = norms.max()
    lift = np.sqrt(np.maximum(longest**2 - norms**2, 0))
    directions = _directions(width + 1, PROJECTIONS, seed)
    values = (np.c_[x, lift] / longest) @ directions
    order = np.ascontiguousarray(np.argsort(values, axis=0, kind="stable").T.astype(np.int32))
    arrays = [values[order[j], j] for j in range(PROJECTIONS)]
    enough = min(n, max(LEAST, int(SHARE * n)) + k)
    needed = int(THRESHOLD * PROJECTIONS)

    def find(query_id: int, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = (query / np.sqrt((query * query).sum())) @ directions[:-1]
        reach = WIDTH
        low, high = _windows(arrays, at, reach)
        inside, beside = [], []
        for j, (first, last) in enumerate(zip(low, high)):
            if 2 * (last - first) > n:
                beside += [order[j, :first], order[j, last:]]
            else:
                inside.append(order[j, first:last])
        met = len(beside) // 2 + _times(inside, n) - _times(beside, n)
        near = np.flatnonzero(met >= needed)
        while len(near) < enough and (any(low) or min(high) < n):
            reach *= GROWTH
            lower, higher = _windows(arrays, at, reach)
            fresh = [order[j, lower[j] : low[j]] for j in range(PROJECTIONS)]
            fresh += [order[j, high[j] : higher[j]] for j in range(PROJECTIONS)]
            met += _times(fresh, n)
            low, high = lower, higher
            near = np.flatnonzero(met >= needed)
        near = near[ids[near] != query_id]
        scores = (x[near] * query).sum(axis=1)
        top = vec.best(scores, ids[near], k)
        return near[top], scores[top]

    return find


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    seed: int = 0,
) -> DataFrame:
    """The ``k`` rows with the largest inner products found for each row that is a query.

    Returns query_id, rank (from 1), vec_id and score, the exact inner product in double
    precision; ties go to smaller ids. A query's own id is no candidate; with fewer candidates
    than ``k`` all are returned. Vectors that are null, zero or empty or hold null or non-finite
    components take no part, nor do null ids; shorter vectors count as filled up with zeros.
    Repeated rows are candidates of their own, and a repeated query is asked once. Other columns
    are ignored, and an empty table gives no rows.
    """
    nonzero = F.exists(F.col(vector), lambda v: v != 0)
    rows = vectors.where(vec.sound(vector) & nonzero & F.col(vec_id).isNotNull())

    def make(ids: np.ndarray, x: np.ndarray) -> Callable:
        return index(ids, x, k, seed)

    return vec.search(rows, is_query, k, make, vec_id, vector, "double")
