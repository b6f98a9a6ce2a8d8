"""The driver's tables seen as sensor readings.

The test tables hold no readings, so ``events`` stands in for them: a user is a sensor, and
fixed rules add what the data lacks, namely NULLs, noisy spelling and an ingestion day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.functions import day_key, normalise_code
from stationlake.schemas import BRONZE_COLUMNS


TABLES = {
    "events": """
        event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE,
        props STRING
    """,
    "lineitem": """
        l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,
        l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE,
        l_returnflag STRING, l_linestatus STRING, l_shipdate TIMESTAMP_NTZ
    """,
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def events_as_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns plus ``event_id``."""
    events = table(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    station = user % 50
    loud = F.when(event % 7 == 0, F.upper("event_type")).otherwise(F.col("event_type"))
    padded = F.concat(F.lit(" "), loud, F.lit(" "))
    day = F.col("ts").cast("date")
    return events.select(
        "event_id",
        F.when(event % 97 != 0, station).alias("location_id"),
        user.alias("sensors_id"),
        F.concat(F.lit("L"), station.cast("string")).alias("location"),
        F.col("ts").alias("datetime"),
        (F.lit(-23.0) - station / F.lit(100.0)).alias("lat"),
        (F.lit(-46.0) - station / F.lit(100.0)).alias("lon"),
        F.when(event % 11 == 0, padded).otherwise(loud).alias("parameter"),
        F.lit("u").alias("units"),
        F.when(event % 13 != 0, F.col("value")).alias("value"),
        F.when(day < F.lit("2024-01-08").cast("date"), F.lit("historico_csv"))
        .otherwise(F.lit("api"))
        .alias("tipo_ingestao"),
        F.date_add(day, (event % 4).cast("int")).alias("data_ingestao"),
    )


def events_with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze columns; every reading arrives a second time one ingestion day later."""
    late = F.explode(F.array(F.lit(0), F.lit(1)))
    return (
        events_as_readings(spark, sf_dir)
        .withColumn("late", late)
        .withColumn("data_ingestao", F.date_add("data_ingestao", F.col("late")))
        .select(*BRONZE_COLUMNS)
    )


def events_as_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver columns without the lookups, plus ``event_id``."""
    return events_as_readings(spark, sf_dir).select(
        "event_id",
        F.col("location_id").alias("id_localizacao"),
        F.col("sensors_id").alias("id_sensor"),
        F.col("location").alias("localizacao"),
        F.col("datetime").alias("data_hora"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        F.col("parameter").alias("parametro"),
        normalise_code("parameter").alias("parametro_descricao"),
        F.col("units").alias("unidade"),
        F.col("value").alias("valor"),
        "tipo_ingestao",
        day_key("datetime").alias("anomesdia"),
        "data_ingestao",
    )


def nations_as_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names for the stations 0 to 24; the others stay unlisted."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("station_id"),
        F.col("n_name").alias("station_name"),
    )


def nations_as_dated_stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two or three names, one after the other, for the stations 0 to 24."""
    nation = table(spark, sf_dir, "nation")
    number = F.explode(F.sequence(F.lit(1), 2 + F.col("n_nationkey") % 2)).alias("number")
    start = F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.col("number") * 8, F.lit(6), F.lit(0), F.lit(0))
    return nation.select("*", number).select(
        F.col("n_nationkey").cast("bigint").alias("station_id"),
        F.concat("n_name", F.lit(" "), "number").alias("station_name"),
        start.alias("valid_from"),
    )


def events_as_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested payload per event: two sensors, the first with two measurements.

    Some payloads lack coordinates, a period, a parameter, measurements or all sensors.
    """
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")

    def measurement(number, code):
        return F.struct(
            F.when(
                event % 13 != 0,
                F.struct(
                    F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("local")).alias(
                        "datetimeTo"
                    )
                ),
            ).alias("period"),
            F.when(event % 17 != 0, F.struct(code.alias("name"), F.lit("u").alias("units"))).alias(
                "parameter"
            ),
            number.alias("value"),
        )

    def sensor(number, measurements):
        return F.struct(number.alias("id"), measurements.alias("measurements"))

    first = sensor(
        user * 2,
        F.array(
            measurement(value, F.col("event_type")),
            measurement(value + F.lit(1.0), F.upper("event_type")),
        ),
    )
    second = sensor(
        user * 2 + 1,
        F.when(event % 3 != 0, F.array(measurement(-value, F.lower("event_type")))),
    )
    position = F.struct(
        (user / F.lit(4.0)).alias("latitude"), (-user / F.lit(4.0)).alias("longitude")
    )
    return table(spark, sf_dir, "events").select(
        event.alias("id"),
        F.concat(F.lit("L"), event.cast("string")).alias("name"),
        F.when(event % 5 != 0, position).alias("coordinates"),
        F.when(event % 19 != 0, F.array(first, second)).alias("sensors"),
    )


def with_foreign_site(readings: DataFrame, station: int = 7) -> DataFrame:
    """Let a second site report under one station id, sometimes without a name."""
    here = F.col("location_id") == station
    odd = F.pmod(F.col("sensors_id") + F.dayofmonth("datetime"), F.lit(3))
    return readings.withColumn(
        "location",
        F.when(here & (odd == 1), F.lit("abroad"))
        .when(here & (odd == 2), F.lit(None))
        .otherwise(F.col("location")),
    )


def events_as_drifting_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payloads as text: values of every fourth are text, and every fifth has a new field."""
    payload = events_as_payload(spark, sf_dir)
    text = F.to_json(F.struct(*payload.columns))
    retyped = F.regexp_replace(text, '"value":([-0-9.E]+)', '"value":"$1"')
    text = F.when(F.col("id") % 4 == 0, retyped).otherwise(text)
    flagged = F.regexp_replace(text, '"value":', '"flag":{"ok":true},"value":')
    return payload.select(F.when(F.col("id") % 5 == 0, flagged).otherwise(text).alias("payload"))
