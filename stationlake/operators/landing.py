"""Flatten nested station payloads and count what was landed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def flatten_payload(df: DataFrame) -> DataFrame:
    """One flat row per measurement, in landing columns.

    Missing ``period``, ``parameter`` or ``coordinates`` give NULLs. Stations without sensors
    and sensors without measurements give no rows. ``datetime`` stays the text of the payload.
    """
    sensors = df.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("location"),
        F.col("coordinates.latitude").alias("lat"),
        F.col("coordinates.longitude").alias("lon"),
        F.explode("sensors").alias("sensor"),
    )
    measurements = sensors.select(
        "*",
        F.col("sensor.id").alias("sensors_id"),
        F.explode("sensor.measurements").alias("m"),
    )
    return measurements.select(
        "location_id",
        "sensors_id",
        "location",
        F.col("m.period.datetimeTo.local").alias("datetime"),
        "lat",
        "lon",
        F.col("m.parameter.name").alias("parameter"),
        F.col("m.parameter.units").alias("units"),
        F.col("m.value").alias("value"),
    )


def flatten_drifting_payload(df: DataFrame, payload: str = "payload") -> DataFrame:
    """``flatten_payload`` for payloads as text whose fields come and go or change their type.

    Landing columns, and ``measurement``: the whole measurement as VARIANT, with fields that the
    landing does not know. A value of another type counts if it can be read as the landing's type
    (``"12.5"`` as 12.5), and is NULL otherwise. What is no JSON, or no array where one belongs,
    gives no rows.
    """

    def field(value: Column, path: str, kind: str) -> Column:
        return F.try_variant_get(value, f"$.{path}", kind)

    station = F.try_parse_json(F.col(payload))
    sensors = df.select(station.alias("station")).select(
        "station",
        F.explode(field(F.col("station"), "sensors", "array<variant>")).alias("sensor"),
    )
    measurements = sensors.select(
        "station",
        "sensor",
        F.explode(field(F.col("sensor"), "measurements", "array<variant>")).alias("m"),
    )
    of, sensor, m = F.col("station"), F.col("sensor"), F.col("m")
    return measurements.select(
        field(of, "id", "bigint").alias("location_id"),
        field(sensor, "id", "bigint").alias("sensors_id"),
        field(of, "name", "string").alias("location"),
        field(m, "period.datetimeTo.local", "string").alias("datetime"),
        field(of, "coordinates.latitude", "double").alias("lat"),
        field(of, "coordinates.longitude", "double").alias("lon"),
        field(m, "parameter.name", "string").alias("parameter"),
        field(m, "parameter.units", "string").alias("units"),
        field(m, "value", "double").alias("value"),
        m.alias("measurement"),
    )


def landed_counts(df: DataFrame, key: str = "location_id") -> DataFrame:
    """Rows per station; a station without rows is absent."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
