from __future__ import annotations

from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType


def day_key(ts: str | Column) -> Column:
    """``yyyyMMdd`` as int, in the session zone; NULL for a NULL timestamp.

    Computed from the date parts: formatting and parsing text would cost several times as much.
    """
    day = (F.col(ts) if isinstance(ts, str) else ts).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def day_number(day: date) -> int:
    """The ``day_key`` of a calendar day."""
    return day.year * 10000 + day.month * 100 + day.day


def normalise_code(code: str | Column) -> Column:
    """Lookup form of a code. Strips spaces only: a tab or newline stays."""
    return F.lower(F.trim(code))


def any_null(names: Iterable[str]) -> Column:
    """True where at least one of the columns is NULL."""
    return reduce(lambda left, right: left | right, [F.col(quoted(n)).isNull() for n in names])


def quoted(name: str) -> str:
    """A column name as SQL text, whatever it contains."""
    return "`" + name.replace("`", "``") + "`"


def unused(name: str, *taken: str) -> str:
    """``name``, with underscores before it as long as a column is called so."""
    others = {t.lower() for t in taken}
    while name.lower() in others:
        name = f"_{name}"
    return name


def map_batches(df: DataFrame, function: Callable, *counted: str) -> DataFrame:
    """``df.mapInArrow`` for columns of any name, with more columns of type long behind them.

    ``function`` sees columns by their place.
    """
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    more = [StructField(f"more{i}", LongType()) for i in range(len(counted))]
    schema = StructType([*plain.schema.fields, *more])
    return plain.mapInArrow(function, schema).toDF(*df.columns, *counted)
