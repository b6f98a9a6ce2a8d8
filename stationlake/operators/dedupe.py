"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stationlake.functions import quoted, unused
from stationlake.operators.ranking import first_k

READING = ["sensors_id", "datetime"]


def dedupe_readings(
    df: DataFrame, keys: Sequence[str] = READING, order: Sequence[str] = ("data_ingestao",)
) -> DataFrame:
    """The first row per key by ``order``, then by all other columns; NULL keys are equal.

    Ordering by every column leaves only identical rows tied, so the result does not depend on
    how the input is split.
    """
    rest = [c for c in df.columns if c not in {*keys, *order}]
    ordering = [F.col(quoted(c)).asc_nulls_first() for c in [*order, *rest]]
    number = unused("first", *df.columns)
    return first_k(df, keys, ordering, 1, number).drop(number)
