"""Sliding windows of days, counted back from a given run date or instant."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stationlake.functions import day_number


def first_day(run_date: date, days: int) -> date | None:
    """First day of a window of ``days`` ending at ``run_date``; None means no lower bound."""
    return run_date - timedelta(days=days - 1) if days > 0 else None


def ingestion_window(
    df: DataFrame, run_date: date, days: int, column: str = "data_ingestao"
) -> DataFrame:
    """Rows ingested in the last ``days`` days; all rows for ``days <= 0``."""
    start = first_day(run_date, days)
    return df if start is None else df.where(F.col(column) >= F.lit(start))


def event_day_window(
    df: DataFrame, run_date: date, days: int, column: str = "anomesdia"
) -> DataFrame:
    """Rows measured in the last ``days`` days by day key; all rows for ``days <= 0``.

    Ranks are per day, so the window changes which days appear but no day's ranks.
    """
    start = first_day(run_date, days)
    return df if start is None else df.where(F.col(column) >= day_number(start))


def rolling_interval(
    df: DataFrame,
    now: datetime,
    days_back: int,
    column: str = "datetime",
    keep_null: bool = False,
) -> DataFrame:
    """Rows from the midnight ``days_back`` days before ``now`` up to ``now``, to the second.

    An aware ``now`` fixes instants; against a column without zone its wall-clock time counts.
    """
    end = now.replace(microsecond=0)
    start = (end - timedelta(days=days_back)).replace(hour=0, minute=0, second=0)
    kind = "timestamp"
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        kind, start, end = "timestamp_ntz", start.replace(tzinfo=None), end.replace(tzinfo=None)
    inside = F.col(column).between(
        F.lit(start.isoformat()).cast(kind), F.lit(end.isoformat()).cast(kind)
    )
    return df.where(F.col(column).isNull() | inside if keep_null else inside)
