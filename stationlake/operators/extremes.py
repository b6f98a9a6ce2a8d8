"""The k highest and k lowest readings of each sensor-day, side by side in one row."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from stationlake.functions import map_batches, quoted
from stationlake.operators.ranking import asc_order, desc_order, first_k
from stationlake.schemas import GOLD_DIMS, GOLD_KEYS

# the rank partition of the literal form also has the name
RANK_KEYS = [*GOLD_KEYS, "localizacao"]

def value_columns(k: int, suffix: str = "valor") -> list[str]:
    return [f"{side}{i}_{suffix}" for side in ("top", "bottom") for i in range(1, k + 1)]


def daily_sensor_dims(df: DataFrame, cols: Sequence[str] = GOLD_DIMS) -> DataFrame:
    """Distinct descriptive rows; NULLs count as equal."""
    return df.select(*cols).distinct()


def _coder() -> Callable:
    """A function that numbers the rows of a batch, equal rows alike; it goes by value too."""

    def codes(batch, places):
        import numpy as np
        import pyarrow.compute as pc

        out = np.zeros(batch.num_rows, np.int64)
        for place in places:
            coded = pc.dictionary_encode(batch.column(place), null_encoding="encode")
            out = out * len(coded.dictionary) + coded.indices.to_numpy(zero_copy_only=False)
            if len(coded.dictionary) > 1:
                out = np.unique(out, return_inverse=True)[1]
        return out

    return codes


def cut_extremes(
    df: DataFrame, keys: Sequence[str], dims: Sequence[str], value: str, k: int
) -> DataFrame:
    """``dims`` and ``value`` of the rows that can matter: a state to be merged after a shuffle.

    Of each batch of input rows (``spark.sql.execution.arrow.maxRecordsPerBatch``) it keeps the
    ``k`` highest and ``k`` lowest of every key and one row of every label, without a shuffle. A
    group of any size so sends a few rows per batch. Rows are kept as they are, and those that a
    whole group keeps are among those that its batches keep.
    """
    columns = list(dict.fromkeys([*dims, value]))
    n_keys, n_dims = [columns.index(c) for c in keys], list(range(len(dims)))
    at = columns.index(value)
    codes = _coder()

    # goes to the workers by value, so that they need not have this package
    def cut(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def order(values):
            """Numbers that sort as the values do: NULL, numbers, NaN."""
            if not pa.types.is_floating(values.type):
                ranks = pc.rank(values, "ascending", null_placement="at_start", tiebreaker="dense")
                return np.zeros(len(values)), ranks.to_numpy()
            missing = values.is_null().to_numpy(zero_copy_only=False)
            numbers = values.to_numpy(zero_copy_only=False)
            nan = np.isnan(numbers)
            kind = np.where(missing, 0, np.where(nan, 2, 1))
            return kind, np.where(nan, 0, numbers)

        for batch in batches:
            if not batch.num_rows:
                continue
            group = codes(batch, n_keys)
            kind, number = order(batch.column(at))
            rows = np.lexsort((number, kind, group))
            starts = np.flatnonzero(np.r_[True, np.diff(group[rows]) > 0])
            sizes = np.diff(np.r_[starts, len(rows)])
            place = np.arange(len(rows)) - np.repeat(starts, sizes)
            keep = np.zeros(len(rows), bool)
            keep[rows] = (place < k) | (np.repeat(sizes, sizes) - place <= k)
            if n_dims != n_keys:
                keep[np.unique(codes(batch, n_dims), return_index=True)[1]] = True
            yield batch.filter(pa.array(keep))

    return map_batches(df.select(*map(quoted, columns)), cut)


def daily_extremes(
    df: DataFrame,
    keys: Sequence[str] = GOLD_KEYS,
    dims: Sequence[str] = GOLD_DIMS,
    value: str = "valor",
    k: int = 3,
) -> DataFrame:
    """One row per distinct ``dims`` with the ``k`` highest and lowest values of its key.

    ``dims`` hold the columns of ``keys``. Groups are ranked on ``keys`` alone, so two names under
    one id do not multiply rows. Ranks that a group does not have are NULL, and so are all values
    where a key column is NULL.

    One scan, one shuffle and one sort: batches are cut first, a group's rows meet in one task,
    where one order gives the ranks from either end. Groups are then read one after the other, so
    that a task holds the rows to sort, which can spill, and of one group the labels.
    """
    rows = cut_extremes(df, keys, dims, value, k)
    dims = list(dims)
    n_keys, n_dims = [dims.index(c) for c in keys], list(range(len(dims)))
    # groups and labels are told apart by their bits, so zeros get one sign, as in GROUP BY
    labels = [
        (F.when(c == 0, F.abs(c)).otherwise(c) if kind in ("float", "double") else c)
        for c, kind in ((F.col(quoted(d)), dict(rows.dtypes)[d]) for d in dims)
    ]
    columns = [c.alias(f"c{i}") for i, c in enumerate(labels)]
    plain = rows.select(*columns, F.col(quoted(value)).alias("v"))
    by = [f"c{i}" for i in n_keys]
    ranked = plain.repartition(*(by or [1])).sortWithinPartitions(*by, desc_order("v"))
    names = [*plain.columns[:-1], *(f"v{i}" for i in range(2 * k))]
    codes = _coder()

    # goes to the workers by value, so that they need not have this package
    def pick(batches):
        import numpy as np
        import pyarrow as pa

        def starts_of(batch):
            return np.flatnonzero(np.r_[True, np.diff(codes(batch, n_keys)) != 0])

        def spread(batch):
            """A row per label of some whole groups."""
            starts = starts_of(batch)
            sizes = np.diff(np.r_[starts, batch.num_rows])
            known = np.ones(len(starts), bool)
            for place in n_keys:
                known &= ~batch.column(place).is_null().to_numpy(zero_copy_only=False)[starts]
            label = np.unique(codes(batch, n_dims), return_index=True)[1]
            group = np.searchsorted(starts, label, "right") - 1
            out = [batch.column(i).take(pa.array(label)) for i in n_dims]
            values = batch.column(len(n_dims))
            for first, step in ((starts, 1), (starts + sizes - 1, -1)):
                for i in range(k):
                    missing = (~known | (sizes <= i))[group]
                    places = np.where(missing, 0, (first + step * i)[group])
                    out.append(values.take(pa.array(places, mask=missing)))
            return pa.RecordBatch.from_arrays(out, names=names)

        rest = None
        for batch in batches:
            if not batch.num_rows:
                continue
            if rest is not None:
                batch = pa.concat_batches([rest, batch])
            cut = int(starts_of(batch)[-1])
            if cut:
                yield spread(batch.slice(0, cut))
            # of the group that may go on only the rows that can matter
            rest = batch.slice(cut)
            keep = np.zeros(rest.num_rows, bool)
            keep[:k] = keep[max(len(keep) - k, 0) :] = True
            keep[np.unique(codes(rest, n_dims), return_index=True)[1]] = True
            rest = rest.filter(pa.array(keep))
        if rest is not None:
            yield spread(rest)

    *label_fields, field = plain.schema.fields
    picked = [StructField(f"v{i}", field.dataType) for i in range(2 * k)]
    found = ranked.mapInArrow(pick, StructType([*label_fields, *picked]))
    return found.toDF(*dims, *value_columns(k))


def daily_extremes_joined(
    df: DataFrame,
    keys: Sequence[str] = GOLD_KEYS,
    value: str = "valor",
    k: int = 3,
    dims: Sequence[str] = GOLD_DIMS,
    rank_keys: Sequence[str] = RANK_KEYS,
) -> DataFrame:
    """The literal form: one left join per rank.

    Ranks are per ``rank_keys`` but joined on ``keys``, so an id with two names multiplies its
    rows. Kept for comparison; ``daily_extremes`` gives the same rows where names follow ids.
    """
    out = daily_sensor_dims(df, dims)
    for side, order in (("top", desc_order(value)), ("bottom", asc_order(value))):
        for i in range(1, k + 1):
            ranked = first_k(df.select(*rank_keys, value), rank_keys, [order], i)
            nth = ranked.where(F.col("rn") == i).select(
                *keys, F.col(value).alias(f"{side}{i}_valor")
            )
            out = out.join(nth, list(keys), "left")
    return out.select(*dims, *value_columns(k))
