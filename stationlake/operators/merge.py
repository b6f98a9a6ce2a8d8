"""Insert-only merge and day replacement as plain DataFrame operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stationlake.functions import any_null, quoted, unused


#: Bits of a bitmap as Spark's functions build it, and the most bitmaps of a filter: 4 MB.
BITMAP_BITS = 32_768
BITMAPS = 1024


def _bit(keys: Sequence[str]) -> Column:
    """The number of a key's bit, from 1."""
    return F.pmod(F.xxhash64(*map(quoted, keys)), F.lit(BITMAPS * BITMAP_BITS)) + 1


def comparable(one: DataFrame, other: DataFrame, keys: Sequence[str]) -> bool:
    """Whether equal keys of both have equal hashes: same types, no floating point (-0.0 is 0.0)."""
    kinds = dict(one.dtypes), dict(other.dtypes)
    return all(
        kinds[0][k] == kinds[1][k] and kinds[0][k] not in ("float", "double") for k in keys
    )


def rows_met(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The target rows with a key that the batch may have; a few others pass too.

    The batch's keys are hashed into bitmaps, at most 4 MB in all whatever the batch's size,
    which every task looks its rows up in before anything is shuffled. NULL keys match nothing.
    """
    bit, bucket, bits = (unused(n, *target.columns) for n in ("bit", "bucket", "bits"))
    numbers = batch.where(~any_null(keys)).select(_bit(keys).alias(bit))
    bitmaps = numbers.groupBy(F.bitmap_bucket_number(bit).alias(bucket)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias(bits)
    )
    place = F.bitmap_bit_position(_bit(keys)).cast("int")
    byte = F.substring(F.col(bits), F.floor(place / 8).cast("int") + 1, F.lit(1))
    found = F.conv(F.hex(byte), 16, 10).cast("int")
    looked_up = target.where(~any_null(keys)).join(
        F.broadcast(bitmaps), F.bitmap_bucket_number(_bit(keys)) == F.col(bucket)
    )
    mask = F.get(F.array(*[F.lit(1 << i) for i in range(8)]), place % 8)
    return looked_up.where(found.bitwiseAND(mask) != 0).select(*map(quoted, target.columns))


def merge_insert_only(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    batch_keys: DataFrame | None = None,
) -> DataFrame:
    """The source rows to insert: those whose key the target does not hold.

    Columns are matched by name, ignoring case, and come in the target's order. Rows repeated
    in the source stay repeated, and a row with a NULL key never matches. If one key, or NULL,
    fills a large part of the source, adaptive execution splits that part of the join.

    ``batch_keys`` holds at least the keys of the source and is cheap to read, such as the rows
    that the source was made from. With it, only target rows with a key of the batch (and a few
    others) are shuffled, so that the merge's cost follows the batch and not the target.
    """
    columns = {c.lower(): c for c in source.columns}
    rows = source.select(*[F.col(quoted(columns[c.lower()])).alias(c) for c in target.columns])
    held = target.where(~any_null(keys)).select(*map(quoted, keys))
    if batch_keys is not None and comparable(held, batch_keys, keys):
        held = rows_met(held, batch_keys, keys)
    return rows.join(held, list(keys), "left_anti").select(*map(quoted, target.columns))


def split_valid(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with a complete key, and the rows a merge would insert again at every run."""
    return df.where(~any_null(keys)), df.where(any_null(keys))


def replace_days(
    target: DataFrame,
    source: DataFrame,
    day: str = "anomesdia",
    days: Sequence[int] | None = None,
) -> DataFrame:
    """The target with some days taken from the source: those given, else all the source has.

    Target rows without a day are left alone. Without ``days`` the whole source is added.
    """
    columns = [quoted(c) for c in target.columns]
    if days is None:
        # one row per calendar day at most, whatever the size of the source
        replaced = F.broadcast(source.select(day).where(F.col(day).isNotNull()).distinct())
        kept = target.join(replaced, day, "left_anti").select(*columns)
        return kept.unionByName(source.select(*columns))
    kept = target.where(F.col(day).isNull() | ~F.col(day).isin(*days))
    return kept.unionByName(source.where(F.col(day).isin(*days)).select(*columns))


def days_met(df: DataFrame, day: Column, column: str = "anomesdia") -> Column | None:
    """A condition on the target's day column that holds for just the days in ``df``.

    None if there is no day at all. Used to read only the target partitions that a batch can
    meet. The list has a number per calendar day of the batch, whatever its size.
    """
    days = df.select(day.alias("d")).where("d IS NOT NULL").distinct().collect()
    return F.col(column).isin(*sorted(r.d for r in days)) if days else None
