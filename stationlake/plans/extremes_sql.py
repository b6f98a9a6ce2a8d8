"""The literal extremes as one parameterised SQL statement, for those who keep their gold in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from stationlake.schemas import GOLD_DIMS, GOLD_KEYS

SIDES = {"top": "DESC NULLS LAST", "bottom": "ASC NULLS FIRST"}


def statement(k: int = 3) -> str:
    """SQL with the parameters ``:silver``, the name of a table, and ``:first_day``, which may be
    NULL. One CTE for the window, one for the labels, one per side and one per rank."""
    keys, dims = ", ".join(GOLD_KEYS), ", ".join(GOLD_DIMS)
    ctes = [
        "measured AS (SELECT * FROM IDENTIFIER(:silver) "
        "WHERE :first_day IS NULL OR anomesdia >= :first_day)",
        f"labels AS (SELECT DISTINCT {dims} FROM measured)",
    ]
    joins, values = [], []
    for side, order in SIDES.items():
        ctes.append(
            f"{side} AS (SELECT {keys}, valor, row_number() OVER "
            f"(PARTITION BY {keys}, localizacao ORDER BY valor {order}) AS place FROM measured)"
        )
        for i in range(1, k + 1):
            name = f"{side}{i}"
            ctes.append(
                f"{name} AS (SELECT {keys}, valor AS {name}_valor FROM {side} WHERE place = {i})"
            )
            joins.append(f"LEFT JOIN {name} USING ({keys})")
            values.append(f"{name}_valor")
    return f"WITH {', '.join(ctes)} SELECT {dims}, {', '.join(values)} FROM labels {' '.join(joins)}"


def daily_extremes_sql(
    spark: SparkSession, silver: str, first_day: int | None = None, k: int = 3
) -> DataFrame:
    """The rows of ``daily_extremes_joined`` over a table or view, from ``first_day`` on."""
    return spark.sql(statement(k), args={"silver": silver, "first_day": first_day})
