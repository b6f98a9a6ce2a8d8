"""Searching a vector table by blocks: what both vector searches share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.llm.common import ship
from stationlake.session import materialise

#: Rows of a shard, and queries that meet a shard in one task, at most about.
SHARD_ROWS, QUERY_ROWS = 65_536, 65_536
#: Smaller tables are cut into more shards, for as many tasks as there are cores.
SMALLEST_SHARD = 4_096

Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple]


def sound(vector: str) -> Column:
    """Whether a vector is there and has finite components only."""
    x = F.col(vector)
    bad = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    return x.isNotNull() & ~bad


def matrix(lists: pa.ChunkedArray, width: int = 0) -> np.ndarray:
    """Rows of doubles; shorter vectors are filled up with zeros."""
    rows = lists.combine_chunks()
    lengths = rows.value_lengths().to_numpy(zero_copy_only=False)
    width = max(width, int(lengths.max()) if len(lengths) else 0)
    out = np.zeros((len(rows), width))
    out[np.arange(width) < lengths[:, None]] = rows.flatten().to_numpy()
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores, ties to smaller ids."""
    if len(scores) > k:
        kth = np.partition(scores, len(scores) - k)[len(scores) - k]
        near = np.flatnonzero(scores >= kth)
    else:
        near = np.arange(len(scores))
    return near[np.lexsort((ids[near], -scores[near]))[:k]]


def search(
    vectors: DataFrame,
    is_query: Column,
    k: int,
    make: Callable[[np.ndarray, np.ndarray], Callable],
    vec_id: str,
    vector: str,
    score_type: str,
) -> DataFrame:
    """The ``k`` best rows of ``vectors`` for each row that is a query.

    Rows are dealt to shards by the hash of their id, vector and number, so that a frequent id is
    spread, and queries to blocks; each pair of a shard and a block is one group. The numbers are
    written first: a task that runs again finds the same ones. There ``make`` gets the shard's ids and vectors and returns a
    function that finds, for a query id and vector, the places of its best rows and their
    scores. The shards' results are merged by rank.

    Returns query_id, rank, vec_id and score.
    """
    ship()
    rows = vectors.select(
        F.col(vec_id).cast("bigint").alias("id"),
        F.col(vector).alias("x"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
        F.monotonically_increasing_id().alias("number"),
    )
    rows = materialise(rows).withColumn("x", F.col("x").cast("array<double>"))
    n, asking = rows.agg(F.count(F.lit(1)), F.sum(F.col("asks").cast("bigint"))).first()
    tasks = vectors.sparkSession.sparkContext.defaultParallelism
    shards = max(-(-n // SHARD_ROWS), min(tasks, -(-n // SMALLEST_SHARD)), 1)
    blocks = max(-(-(asking or 0) // QUERY_ROWS), 1)
    key = F.xxhash64("id", "x")

    def every(count: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(count - 1)))

    asked = rows.where("asks").select(
        "id", "x", key.alias("key"), F.pmod(key, F.lit(blocks)).cast("int").alias("block")
    )
    asked = asked.withColumn("shard", every(shards)).groupBy("shard", "block")
    deal = F.pmod(F.xxhash64("id", "x", "number"), F.lit(shards)).cast("int")
    held = rows.select("id", "x", deal.alias("shard"))
    held = held.withColumn("block", every(blocks)).groupBy("shard", "block")
    number = pa.int64() if score_type == "bigint" else pa.float64()
    schema = pa.schema(
        [("key", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", number)]
    )

    def find(queries: pa.Table, shard: pa.Table) -> pa.Table:
        if not len(queries) or not len(shard):
            return schema.empty_table()
        order = np.argsort(shard["id"].to_numpy(), kind="stable")
        ids, x = shard["id"].to_numpy()[order], matrix(shard["x"])[order]
        q = matrix(queries["x"], x.shape[1])
        if q.shape[1] > x.shape[1]:
            x = np.pad(x, ((0, 0), (0, q.shape[1] - x.shape[1])))
        of = make(ids, x)
        # a key stands for one id and vector: repeated query rows are asked once
        keys, first = np.unique(queries["key"].to_numpy(), return_index=True)
        asked_ids = queries["id"].to_numpy()[first]
        found = [of(a, b) for a, b in zip(asked_ids, q[first])]
        counts = [len(p) for p, _ in found]
        return pa.table(
            [
                pa.array(np.repeat(keys, counts)),
                pa.array(np.repeat(asked_ids, counts)),
                pa.array(ids[np.concatenate([p for p, _ in found])]),
                pa.array(np.concatenate([s for _, s in found])).cast(number),
            ],
            schema=schema,
        )

    near = asked.cogroup(held).applyInArrow(
        find, f"key bigint, query_id bigint, vec_id bigint, score {score_type}"
    )
    place = Window.partitionBy("key", "query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        near.withColumn("rank", F.row_number().over(place))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
