"""Checks that are computed while rows are written, without reading them again."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Stations that are told apart; the state of the check is a bin for each at most.
STATIONS_AT_MOST = 10_000


def observe_readings(df: DataFrame, listed: Collection[int]) -> tuple[DataFrame, Observation]:
    """``df`` with an observation of its readings, in landing columns, that fills as it is used.

    ``n_rows``; ``n_null_keys``: rows without sensor or time; ``n_no_station``; ``n_unlisted``:
    rows of stations that are not in ``listed``; ``n_two_names``: how many more pairs of station
    and name there are than stations (approximately), each of which multiplies rows of the
    literal extremes; ``stations``: rows per station, to be read by ``observed_counts``.

    Put it behind the last shuffle: what a task of the last stage has seen counts once, also if
    executors are lost.
    """
    station, name = F.col("location_id"), F.col("location")
    seen = Observation()
    metrics = [
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("sensors_id").isNull() | F.col("datetime").isNull()).alias("n_null_keys"),
        F.count_if(station.isNull()).alias("n_no_station"),
        F.count_if(station.isNotNull() & ~station.isin(*listed)).alias("n_unlisted"),
        (
            F.approx_count_distinct(F.when(station.isNotNull(), F.struct(station, name)))
            - F.approx_count_distinct(station)
        ).alias("n_two_names"),
        # exact as long as there is a bin for every station
        F.histogram_numeric(station, F.lit(STATIONS_AT_MOST)).alias("stations"),
    ]
    return df.observe(seen, *metrics), seen


def observed_counts(spark: SparkSession, seen: Observation) -> DataFrame | None:
    """``location_id, n_rows`` of the rows seen; None if there were too many stations to tell."""
    found = seen.get
    bins = found["stations"] or []
    if len(bins) >= STATIONS_AT_MOST:
        return None
    counts: dict[int | None, int] = {}
    for b in bins:
        counts[int(b["x"])] = counts.get(int(b["x"]), 0) + int(b["y"])
    if found["n_no_station"]:
        counts[None] = found["n_no_station"]
    return spark.createDataFrame(list(counts.items()), "location_id long, n_rows long")
