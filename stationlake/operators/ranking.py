"""Row numbers per group: complete rankings, and the first k of each group."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stationlake.functions import map_batches, quoted, unused
from stationlake.session import materialise


def desc_order(value: str) -> Column:
    """Highest first: NaN counts as greatest, NULL comes last."""
    return F.col(quoted(value)).desc_nulls_last()


def asc_order(value: str) -> Column:
    """Lowest first: NULL comes before everything, NaN last."""
    return F.col(quoted(value)).asc_nulls_first()


def first_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "rn"
) -> DataFrame:
    """The first ``k`` rows of every group, numbered from 1.

    The filter sits directly on the window, so Spark cuts each group to ``k`` rows per input
    task before the shuffle: a group of any size sends at most ``k`` rows per task. (For ``k``
    above ``spark.sql.optimizer.windowGroupLimitThreshold``, 1000, it cuts after the shuffle.)
    """
    window = Window.partitionBy(*map(quoted, keys)).orderBy(*order)
    return df.withColumn(name, F.row_number().over(window)).where(F.col(quoted(name)) <= k)


def rank_desc(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie: Sequence[str] = (),
    name: str = "rn_valor_desc",
) -> DataFrame:
    """All rows with their position in the group, highest value first, then by ``tie``."""
    return _rank(df, keys, [desc_order(value), *map(F.col, map(quoted, tie))], name)


def rank_asc(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    tie: Sequence[str] = (),
    name: str = "rn_valor_asc",
) -> DataFrame:
    """All rows with their position in the group, lowest value first, then by ``tie``."""
    return _rank(df, keys, [asc_order(value), *map(F.col, map(quoted, tie))], name)


def _rank(df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str) -> DataFrame:
    """Rank every group over as many tasks as its rows fill; a column called ``name`` is replaced.

    Rows are range-partitioned by group, order, all other columns and the task they come from, so
    ranges cut through groups, values and equal rows alike. Every task sorts its range, counts
    within each group and writes the rows; that is the only copy, and the result reads it. A
    range can go on with one group of the range before, so what the counts lack is one number
    for each range. Adaptive execution merges small ranges.
    """
    columns = [c for c in df.columns if c != name]
    kinds = dict(df.dtypes)
    sortable = [c for c in columns if "map<" not in kinds[c] and "variant" not in kinds[c]]
    task = unused("task", *columns)
    part, at, inside, before, last = (
        unused(n, *columns, name) for n in ("part", "at", "inside", "before", "last")
    )
    ordered = [*(F.col(quoted(c)) for c in keys), *order, *(F.col(quoted(c)) for c in sortable)]
    ordered.append(F.col(task))
    sorted_ranges = (
        df.select(*map(quoted, columns), F.spark_partition_id().alias(task))
        .repartitionByRange(*ordered)
        .sortWithinPartitions(*ordered)
        .drop(task)
        .withColumn(part, F.spark_partition_id())
    )
    places = [columns.index(c) for c in keys]
    ranges = materialise(map_batches(sorted_ranges, _counting(places), at, inside))
    group = F.struct(*[F.col(quoted(c)).alias(f"k{i}") for i, c in enumerate(keys)])
    # one row for each range: its first and its last group, and the rows it has of the last
    ends = ranges.groupBy(part).agg(
        F.min_by(group, at).alias("first"),
        F.max_by(group, at).alias("last"),
        F.max_by(inside, at).alias("rows"),
    )
    # a first group has as many rows in earlier ranges as those that end with it
    sides = F.array(
        F.struct(F.col("first").alias("group"), F.lit(0).cast("bigint").alias("rows")),
        F.struct(F.col("last").alias("group"), "rows"),
    )
    earlier = Window.partitionBy("group").orderBy(last).rangeBetween(Window.unboundedPreceding, -1)
    offsets = (
        ends.select(F.col(part).alias(last), F.inline(sides))
        .withColumn(before, F.sum("rows").over(earlier))
        .where((F.col("rows") == 0) & (F.col(before) > 0))
        .select(last, before)
    )
    # the first group of a range is the one whose count is the row's place in the range
    more = F.when(F.col(inside) == F.col(at) + 1, F.col(before))
    return (
        ranges.join(F.broadcast(offsets), F.col(part) == F.col(last), "left")
        .withColumn(inside, F.col(inside) + F.coalesce(more, F.lit(0)))
        .select(*map(quoted, columns), F.col(inside).alias(name))
    )


def _counting(places: list[int]) -> Callable:
    """Numbers the rows of a sorted range, from 0, and those of each group in it, from 1."""

    # goes to the workers by value, so that they need not have this package
    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def codes(column):
            if pa.types.is_floating(column.type):
                column = pc.add(column, pa.scalar(0.0, column.type))  # -0.0 is 0.0
            coded = pc.dictionary_encode(column, null_encoding="encode")
            return coded.indices.to_numpy(zero_copy_only=False)

        done, seen, previous = 0, 0, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(p) for p in places]
            new = np.zeros(n, bool)
            if previous is None:
                new[0] = True
                for key in keys:
                    new[1:] |= np.diff(codes(key)) != 0
            else:
                for last, key in zip(previous, keys):
                    new |= np.diff(codes(pa.concat_arrays([last, key]))) != 0
            row = np.arange(n)
            start = np.maximum.accumulate(np.where(new, row, -1))
            number = np.where(start < 0, seen + row + 1, row - start + 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(done + row), pa.array(number)],
                names=[*batch.schema.names, "more0", "more1"],
            )
            done, seen = done + n, int(number[-1])
            previous = [key.slice(n - 1, 1) for key in keys]

    return count
