"""Queries over the driver's tables, one or more per operator."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake import operators as op
from stationlake.config import PipelineConfig
from stationlake.functions import day_key
from stationlake.operators.conform import API, HISTORY
from stationlake.plans import extremes_sql, incremental, jobs
from stationlake.schemas import (
    BRONZE,
    BRONZE_COLUMNS,
    GOLD_KEYS,
    LANDING_COLUMNS,
    LANDING_NTZ,
    READING_KEYS,
    SILVER,
    SILVER_COLUMNS,
    gold_schema,
)
from stationlake.session import materialise, scratch_path
from stationlake.sources import (
    append_days,
    append_history,
    read_bronze_window,
    read_history_csv,
    read_landing,
    read_silver_window,
    read_table,
    register_partition,
    write_bronze_day,
    write_landing,
)
from stationlake.sources import stand_in as src
from stationlake.sources.dims import PARAMETERS, STATIONS
from stationlake.sources.writers import BRONZE_PARTITIONS

Query = Callable[[SparkSession, str], DataFrame]

RUN_DATE = date(2024, 1, 30)
RUN_AT = datetime(2024, 1, 30, 10, 0, 0)
BRONZE_NTZ = BRONZE.replace("datetime TIMESTAMP", "datetime TIMESTAMP_NTZ")

# Event types that have a description; the others describe themselves.
EVENT_PARAMETERS = {"click": "Clicks", "view": "Page views", "purchase": "Purchases"}
FOREIGN = {"polluted_id": 7, "polluted_keep": ("L7",)}
CONFIG = PipelineConfig(run_at=RUN_AT, **FOREIGN)


def daily_extremes(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_extremes(src.events_as_silver(spark, sf))


def daily_extremes_joined(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_extremes_joined(src.events_as_silver(spark, sf))


def daily_extremes_sql(spark: SparkSession, sf: str) -> DataFrame:
    name = _name("silver")
    src.events_as_silver(spark, sf).createOrReplaceTempView(name)
    return extremes_sql.daily_extremes_sql(spark, name, 20240128)


def shipments(spark: SparkSession, sf: str) -> DataFrame:
    return src.table(spark, sf, "lineitem").withColumn(
        "ship_month", F.year("l_shipdate") * 100 + F.month("l_shipdate")
    )


SHIPMENT_KEYS = ["l_suppkey", "l_returnflag", "ship_month"]


def daily_extremes_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_extremes(
        shipments(spark, sf), SHIPMENT_KEYS, SHIPMENT_KEYS, "l_extendedprice"
    )


def daily_extremes_lineitem_status(spark: SparkSession, sf: str) -> DataFrame:
    dims = [*SHIPMENT_KEYS, "l_linestatus"]
    return op.daily_extremes(shipments(spark, sf), SHIPMENT_KEYS, dims, "l_extendedprice")


def daily_extremes_one_day(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf)
    return op.daily_extremes(silver.where(F.col("anomesdia") == 20240115))


def daily_extremes_window(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf)
    return op.daily_extremes(op.event_day_window(silver, RUN_DATE, 3))


def daily_extremes_top5(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_extremes(src.events_as_silver(spark, sf), k=5)


RANK_KEYS = ["id_localizacao", "id_sensor", "localizacao", "anomesdia"]


def rank_desc(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf).select(*RANK_KEYS, "event_id", "valor")
    return op.rank_desc(silver, RANK_KEYS, "valor", ["event_id"])


def rank_asc(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf).select(*RANK_KEYS, "event_id", "valor")
    return op.rank_asc(silver, RANK_KEYS, "valor", ["event_id"])


def rank_desc_by_station(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf).select("localizacao", "event_id", "valor")
    return op.rank_desc(silver, ["localizacao"], "valor", ["event_id"])


def hot_values(spark: SparkSession, sf: str) -> DataFrame:
    """Readings of which nine in ten have one value, in one group for a third of them."""
    event = F.col("event_id")
    return src.events_as_silver(spark, sf).select(
        F.when(event % 3 != 0, F.col("id_sensor")).alias("id_sensor"),
        "event_id",
        F.when(event % 10 == 0, F.col("valor")).otherwise(F.lit(0.0)).alias("valor"),
    )


def rank_desc_hot_value(spark: SparkSession, sf: str) -> DataFrame:
    return op.rank_desc(hot_values(spark, sf), ["id_sensor"], "valor", ["event_id"])


def daily_sensor_dims(spark: SparkSession, sf: str) -> DataFrame:
    return op.daily_sensor_dims(src.events_as_silver(spark, sf))


def canonical_station(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.events_as_readings(spark, sf).select("event_id", "location_id", "location")
    return op.canonical_station(readings, src.nations_as_stations(spark, sf))


def canonical_station_as_of(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.events_as_readings(spark, sf)
    columns = ["event_id", "location_id", "location", "datetime"]
    names = src.nations_as_dated_stations(spark, sf)
    return op.canonical_station_as_of(readings.select(*columns), names).select(*columns[:3])


def describe_parameter(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.events_as_readings(spark, sf).select("event_id", "parameter")
    return op.describe_parameter(readings, EVENT_PARAMETERS)


def describe_parameter_dim(spark: SparkSession, sf: str) -> DataFrame:
    # a dimension as a table, with codes in upper case and padded
    codes = src.table(spark, sf, "events").select("event_type").distinct()
    dim = codes.select(
        F.concat(F.lit(" "), F.upper("event_type")).alias("code"),
        F.concat(F.lit("About "), F.col("event_type")).alias("description"),
    ).where("code <> ' VIEW'")
    readings = src.events_as_readings(spark, sf).select("event_id", "parameter")
    return op.describe_parameter(readings, dim)


def filter_polluted_id(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.with_foreign_site(src.events_as_readings(spark, sf))
    return op.filter_polluted_id(readings, 7, ["L7"]).select(
        "event_id", "location_id", "location"
    )


def day_key_events(spark: SparkSession, sf: str) -> DataFrame:
    return src.table(spark, sf, "events").select("event_id", day_key("ts").alias("anomesdia"))


def day_key_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return (
        src.table(spark, sf, "lineitem")
        .groupBy(day_key("l_shipdate").alias("anomesdia"))
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


def conform_readings(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.with_foreign_site(src.events_as_readings(spark, sf))
    return op.conform_readings(
        op.filter_polluted_id(readings, 7, ["L7"]),
        src.nations_as_stations(spark, sf),
        EVENT_PARAMETERS,
    )


def conform_readings_normalised(spark: SparkSession, sf: str) -> DataFrame:
    return op.conform_readings(
        src.events_as_readings(spark, sf),
        src.nations_as_stations(spark, sf),
        EVENT_PARAMETERS,
        normalise=True,
    )


def dedupe_readings(spark: SparkSession, sf: str) -> DataFrame:
    return op.dedupe_readings(src.events_with_repeats(spark, sf))


def dedupe_lineitem(spark: SparkSession, sf: str) -> DataFrame:
    return op.dedupe_readings(
        src.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], ["l_shipdate"]
    )


def ingestion_window(spark: SparkSession, sf: str) -> DataFrame:
    return op.ingestion_window(src.events_as_readings(spark, sf), RUN_DATE, 3)


def event_day_window(spark: SparkSession, sf: str) -> DataFrame:
    return op.event_day_window(src.events_as_silver(spark, sf), RUN_DATE, 3)


def rolling_interval(spark: SparkSession, sf: str) -> DataFrame:
    return op.rolling_interval(src.events_as_readings(spark, sf), RUN_AT, 3)


def _some_timeless(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows with repeats, and NULL times at some sensors."""
    return op.conform_readings(
        src.events_with_repeats(spark, sf).withColumn(
            "datetime", F.when(F.col("sensors_id") % 23 != 0, F.col("datetime"))
        ),
        {},
        {},
    )


def _merge_sides(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Overlapping ingestion days, and other values in the source."""
    silver = _some_timeless(spark, sf)
    target = silver.where(F.col("data_ingestao") <= F.lit(date(2024, 1, 15)))
    source = silver.where(F.col("data_ingestao") >= F.lit(date(2024, 1, 12)))
    return target, source.withColumn("valor", F.col("valor") + F.lit(1.0))


def merge_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _merge_sides(spark, sf)
    return target.unionByName(op.merge_insert_only(target, source, READING_KEYS))


def merge_insert_only_pruned(spark: SparkSession, sf: str) -> DataFrame:
    # the other way round: a batch of three days against all readings
    silver = _some_timeless(spark, sf)
    batch = silver.where(F.col("data_ingestao") >= F.lit(date(2024, 1, 28)))
    target = silver.where("id_sensor % 5 <> 0")
    return op.merge_insert_only(target, batch, READING_KEYS, batch.select(*READING_KEYS))


def merge_insert_only_gold(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf)
    target = op.daily_extremes(silver.where(F.col("anomesdia") <= 20240115))
    source = op.daily_extremes(silver.where(F.col("anomesdia") >= 20240114))
    return target.unionByName(op.merge_insert_only(target, source, GOLD_KEYS))


def split_valid(spark: SparkSession, sf: str) -> DataFrame:
    valid, rejected = op.split_valid(_some_timeless(spark, sf), READING_KEYS)
    return (
        valid.withColumn("valid", F.lit(True))
        .unionByName(rejected.withColumn("valid", F.lit(False)))
        .select("id_localizacao", "id_sensor", "data_hora", "valor", "data_ingestao", "valid")
    )


def replace_days(spark: SparkSession, sf: str) -> DataFrame:
    silver = src.events_as_silver(spark, sf)
    late = silver.where(F.col("anomesdia").between(20240110, 20240112))
    return op.replace_days(silver, late.withColumn("valor", F.col("valor") + F.lit(1.0)))


def silver_batch(spark: SparkSession, sf: str) -> DataFrame:
    bronze = src.with_foreign_site(src.events_with_repeats(spark, sf))
    return jobs.silver_batch(bronze, CONFIG, src.nations_as_stations(spark, sf), EVENT_PARAMETERS)


def gold_from_silver(spark: SparkSession, sf: str) -> DataFrame:
    # silver is a table in the pipeline; gold reads it three times, so it is one here too
    return jobs.gold_batch(materialise(silver_batch(spark, sf)), CONFIG)


def tag_ingestion(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.events_as_readings(spark, sf).select(*LANDING_COLUMNS)
    return op.tag_ingestion(readings, HISTORY, RUN_DATE)


def tag_ingestion_today(spark: SparkSession, sf: str) -> DataFrame:
    readings = src.events_as_readings(spark, sf).select("event_id", *LANDING_COLUMNS)
    tagged = op.tag_ingestion(readings, API)
    age = F.date_diff(F.current_date(), "data_ingestao")
    return tagged.withColumn("age", age).drop("data_ingestao")


def landed_counts(spark: SparkSession, sf: str) -> DataFrame:
    return op.landed_counts(src.events_as_readings(spark, sf))


def flatten_payload(spark: SparkSession, sf: str) -> DataFrame:
    return op.flatten_payload(src.events_as_payload(spark, sf))


def flatten_drifting_payload(spark: SparkSession, sf: str) -> DataFrame:
    flat = op.flatten_drifting_payload(src.events_as_drifting_payload(spark, sf))
    flag = F.try_variant_get("measurement", "$.flag.ok", "boolean")
    return flat.withColumn("flag", F.coalesce(flag, F.lit(False))).drop("measurement")


def landing_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "landing")
    write_landing(src.events_as_readings(spark, sf), path, RUN_DATE)
    return read_landing(spark, path, RUN_DATE, LANDING_NTZ)


def history_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    csv, bronze = scratch_path(spark, "history"), scratch_path(spark, "bronze")
    (
        src.events_as_readings(spark, sf)
        .select(*LANDING_COLUMNS)
        .write.option("header", "true")
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(csv)
    )
    history = read_history_csv(spark, csv, LANDING_NTZ)
    append_history(op.tag_ingestion(history, HISTORY, RUN_DATE), bronze)
    return read_bronze_window(spark, bronze, RUN_DATE, 1, BRONZE_NTZ)


def bronze_rerun_idempotent(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    readings = src.events_as_readings(spark, sf).select(*LANDING_COLUMNS)
    for day in (date(2024, 1, 29), RUN_DATE, RUN_DATE):
        write_bronze_day(op.tag_ingestion(readings, API, day), path)
    return read_bronze_window(spark, path, RUN_DATE, 0, BRONZE_NTZ)


def bronze_window(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "bronze")
    write_bronze_day(src.events_as_readings(spark, sf).select(*BRONZE_COLUMNS), path)
    return read_bronze_window(spark, path, RUN_DATE, 3, BRONZE_NTZ)


def conform_readings_listed(spark: SparkSession, sf: str) -> DataFrame:
    # sensors spread over the listed stations and parameters, and one of each not listed
    def pick(values: list, seed) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (seed % len(values) + 1).cast("int"))

    user = F.col("sensors_id")
    readings = src.events_as_readings(spark, sf).withColumns(
        {
            "location_id": pick([*STATIONS, 1], user).cast("bigint"),
            "parameter": F.upper(pick([*PARAMETERS, "other"], user)),
        }
    )
    return op.conform_readings(readings).select(
        "id_localizacao", "id_sensor", "localizacao", "parametro", "parametro_descricao", "valor"
    )


def _lake(spark: SparkSession) -> PipelineConfig:
    root = scratch_path(spark, "lake")
    return PipelineConfig(
        run_at=RUN_AT,
        timezone=spark.conf.get("spark.sql.session.timeZone"),
        landing_path=f"{root}/landing",
        bronze_path=f"{root}/bronze",
        silver_path=f"{root}/silver",
        gold_path=f"{root}/gold",
        silver_days=0,
        gold_days=0,
        **FOREIGN,
    )


def _zoned(readings: DataFrame) -> DataFrame:
    return readings.withColumn("datetime", F.col("datetime").cast("timestamp"))


def jobs_bronze_to_gold(spark: SparkSession, sf: str) -> DataFrame:
    cfg = _lake(spark)
    readings = src.with_foreign_site(src.events_as_readings(spark, sf))
    write_landing(_zoned(readings), cfg.landing_path, cfg.run_date)
    jobs.run_bronze_daily(spark, cfg)
    jobs.run_silver(spark, cfg, src.nations_as_stations(spark, sf), EVENT_PARAMETERS)
    jobs.run_gold(spark, cfg)
    return read_table(spark, cfg.gold_path, gold_schema())


def jobs_silver_twice(spark: SparkSession, sf: str) -> DataFrame:
    # the second load has all readings with other values; those stored already stay as they are
    cfg = _lake(spark)
    bronze = _zoned(src.events_as_readings(spark, sf)).select(*BRONZE_COLUMNS)
    early = bronze.where(F.col("data_ingestao") <= F.lit(date(2024, 1, 15)))
    for load in (early, bronze.withColumn("value", F.col("value") + F.lit(1.0))):
        write_bronze_day(load, cfg.bronze_path)
        jobs.run_silver(spark, cfg, {}, {})
    silver = read_table(spark, cfg.silver_path, SILVER)
    return silver.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz"))


def jobs_silver_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    # jobs_silver_twice into a table that the merge need not shuffle
    cfg = replace(_lake(spark), silver_bucketed=_name("silver"), silver_buckets=8)
    bronze = _zoned(src.events_as_readings(spark, sf)).select(*BRONZE_COLUMNS)
    early = bronze.where(F.col("data_ingestao") <= F.lit(date(2024, 1, 15)))
    for load in (early, bronze.withColumn("value", F.col("value") + F.lit(1.0))):
        write_bronze_day(load, cfg.bronze_path)
        jobs.run_silver(spark, cfg, {}, {})
    silver = spark.table(cfg.silver_bucketed).select(*SILVER_COLUMNS)
    return silver.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz"))


def jobs_changed_days(spark: SparkSession, sf: str) -> DataFrame:
    # all but the readings of every tenth sensor, then all: gold follows what silver has touched
    root = _lake(spark)
    cfg = replace(root, ledger_path=scratch_path(spark, "ledger"), gold_mode="changed_days")
    bronze = _zoned(src.events_as_readings(spark, sf)).select(*BRONZE_COLUMNS)
    for load in (bronze.where("sensors_id % 10 <> 0 OR sensors_id IS NULL"), bronze):
        write_bronze_day(load, cfg.bronze_path)
        jobs.run_silver(spark, cfg, {}, {})
        jobs.run_gold(spark, cfg)
    return read_table(spark, cfg.gold_path, gold_schema())


def jobs_incremental(spark: SparkSession, sf: str) -> DataFrame:
    # three ingestion days are landed, brought, and joined by two more and a late file of the first
    cfg = _lake(spark)
    readings = _zoned(src.events_as_readings(spark, sf))
    checkpoint = scratch_path(spark, "checkpoint")

    def land(day: int, rows: DataFrame) -> None:
        own = rows.where(F.col("data_ingestao") == F.lit(date(2024, 1, day)))
        write_landing(own, cfg.landing_path, date(2024, 1, day))

    late = F.coalesce(F.col("location_id"), F.lit(0)) % 10 == 3
    for first in (True, False):
        for day in (10, 11, 12) if first else (13, 14):
            land(day, readings.where(~late) if day == 10 else readings)
        if not first:
            land(10, readings.where(late))
        incremental.run_incremental(spark, cfg, checkpoint, {}, {}, at_a_time=100)
    silver = read_table(spark, cfg.silver_path, SILVER)
    return silver.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz"))


def jobs_rejected(spark: SparkSession, sf: str) -> DataFrame:
    # records that do not fit, in the landing and in history files, and the files of one load twice
    cfg = replace(
        _lake(spark), history_path=scratch_path(spark, "history"),
        quarantine_path=scratch_path(spark, "quarantine"), ledger_path=scratch_path(spark, "ledger"),
    )
    events = src.table(spark, sf, "events").select("event_id")
    whole = "concat(id, ',1,here,2024-01-29T00:00:00Z,1.5,2.5,p,u,', id)"
    bad = "CASE id % 30 WHEN 0 THEN concat(id, ',x') WHEN 15 THEN replace({0}, '1.5', 'far') ELSE {0} END"
    csv = events.selectExpr("event_id AS id").selectExpr(f"{bad.format(whole)} AS value")
    header = spark.createDataFrame([(",".join(LANDING_COLUMNS),)], "value string")
    header.unionByName(csv).coalesce(1).sortWithinPartitions(F.col("value").startswith("location_id").desc()).write.text(cfg.history_path)
    line = "concat('{\"location_id\": ', id, ', \"value\": ', id, '}')"
    bad = "CASE id % 20 WHEN 0 THEN concat('{{', id) WHEN 10 THEN replace({0}, '}}', 'e}}') ELSE {0} END"
    json = events.selectExpr("event_id AS id").selectExpr(f"{bad.format(line)} AS value")
    json.write.text(f"{cfg.landing_path}/ingestion_date={cfg.run_date}")
    jobs.run_bronze_daily(spark, cfg)
    for _ in range(2):
        jobs.run_bronze_history(spark, cfg)
    good = read_bronze_window(spark, cfg.bronze_path, cfg.run_date, 1)
    aside = [
        spark.read.parquet(f"{cfg.quarantine_path}/{name}").select(F.lit(kind).alias("kind"), "record")
        for name, kind in (("landing", API), ("history", HISTORY))
    ]
    counts = good.groupBy(F.col("tipo_ingestao").alias("kind")).agg(F.count("value").alias("n"))
    rejected = aside[0].unionByName(aside[1]).groupBy("kind").agg(F.count("record").alias("n"))
    return counts.withColumn("good", F.lit(True)).unionByName(rejected.withColumn("good", F.lit(False)))


def silver_window(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "silver")
    silver = src.events_as_silver(spark, sf).drop("event_id")
    append_days(silver.withColumn("data_hora", F.col("data_hora").cast("timestamp")), path)
    window = read_silver_window(spark, path, RUN_DATE, 3)
    return window.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz"))


def bronze_window_table(spark: SparkSession, sf: str) -> DataFrame:
    # silver reads the registered table; the folder has later days that are not registered
    cfg = replace(_lake(spark), bronze_table=_name("bronze"), silver_days=3)
    bronze = _zoned(src.events_as_readings(spark, sf)).select(*BRONZE_COLUMNS)
    write_bronze_day(bronze, cfg.bronze_path)
    _bronze_table(spark, cfg)
    for day in (date(2024, 1, 28), date(2024, 1, 29), RUN_DATE):
        register_partition(spark, cfg.bronze_table, day, API)
    jobs.run_silver(spark, cfg, {}, {})
    silver = read_table(spark, cfg.silver_path, SILVER)
    return silver.withColumn("data_hora", F.col("data_hora").cast("timestamp_ntz"))


def _name(label: str) -> str:
    return f"{label}_{uuid.uuid4().hex}"


def _bronze_table(spark: SparkSession, cfg: PipelineConfig) -> None:
    spark.sql(
        f"CREATE TABLE {cfg.bronze_table} ({BRONZE}) USING parquet "
        f"PARTITIONED BY ({', '.join(BRONZE_PARTITIONS)}) LOCATION '{cfg.bronze_path}'"
    )


def _landed(spark: SparkSession, sf: str) -> tuple[PipelineConfig, DataFrame]:
    """The landing job over nested payloads of fifty stations, of which thirty are wanted."""
    lake = _lake(spark)
    cfg = replace(
        lake, payload_path=scratch_path(spark, "payload"), location_ids=tuple(range(30))
    )
    payload = src.events_as_payload(spark, sf).withColumn("id", F.col("id") % 50)
    payload.write.json(cfg.payload_path)
    return cfg, jobs.run_landing(spark, cfg)


def jobs_landing_counts(spark: SparkSession, sf: str) -> DataFrame:
    return _landed(spark, sf)[1]


def jobs_landing_to_bronze(spark: SparkSession, sf: str) -> DataFrame:
    cfg, _ = _landed(spark, sf)
    jobs.run_bronze_daily(spark, cfg)
    bronze = read_bronze_window(spark, cfg.bronze_path, RUN_DATE, 1)
    return bronze.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def jobs_history(spark: SparkSession, sf: str) -> DataFrame:
    # history and a daily load on one day, read through the table that both registered with
    cfg = replace(
        _lake(spark), history_path=scratch_path(spark, "history"), bronze_table=_name("bronze")
    )
    readings = _zoned(src.events_as_readings(spark, sf)).select(*LANDING_COLUMNS)
    (
        readings.write.option("header", "true")
        .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
        .option("ignoreLeadingWhiteSpace", "false")
        .option("ignoreTrailingWhiteSpace", "false")
        .csv(cfg.history_path)
    )
    _bronze_table(spark, cfg)
    write_landing(readings, cfg.landing_path, cfg.run_date)
    jobs.run_bronze_daily(spark, cfg)
    jobs.run_bronze_history(spark, cfg)
    bronze = spark.table(cfg.bronze_table)
    return bronze.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))


def jobs_gold_replace_days(spark: SparkSession, sf: str) -> DataFrame:
    # all of gold, then its last three days again: one has gone from silver, one has changed
    cfg = replace(_lake(spark), gold_mode="replace_days")
    silver = src.events_as_silver(spark, sf).drop("event_id")
    silver = silver.withColumn("data_hora", F.col("data_hora").cast("timestamp"))
    append_days(silver, cfg.silver_path)
    jobs.run_gold(spark, cfg)
    later = F.when(F.col("anomesdia") == 20240130, F.col("valor") + F.lit(1.0))
    changed = silver.where("anomesdia <> 20240129").withColumn(
        "valor", F.coalesce(later, F.col("valor"))
    )
    again = replace(cfg, silver_path=scratch_path(spark, "silver"), gold_days=3)
    append_days(changed, again.silver_path)
    jobs.run_gold(spark, again)
    return read_table(spark, cfg.gold_path, gold_schema())


_QUERIES: dict[str, Query] = {
    "daily_extremes": daily_extremes,
    "daily_extremes_joined": daily_extremes_joined,
    "daily_extremes_lineitem": daily_extremes_lineitem,
    "daily_extremes_lineitem_status": daily_extremes_lineitem_status,
    "daily_extremes_one_day": daily_extremes_one_day,
    "daily_extremes_window": daily_extremes_window,
    "daily_extremes_top5": daily_extremes_top5,
    "rank_desc": rank_desc,
    "rank_asc": rank_asc,
    "rank_desc_by_station": rank_desc_by_station,
    "rank_desc_hot_value": rank_desc_hot_value,
    "daily_sensor_dims": daily_sensor_dims,
    "canonical_station": canonical_station,
    "describe_parameter": describe_parameter,
    "describe_parameter_dim": describe_parameter_dim,
    "filter_polluted_id": filter_polluted_id,
    "day_key": day_key_events,
    "day_key_lineitem": day_key_lineitem,
    "conform_readings": conform_readings,
    "conform_readings_normalised": conform_readings_normalised,
    "dedupe_readings": dedupe_readings,
    "dedupe_lineitem": dedupe_lineitem,
    "ingestion_window": ingestion_window,
    "event_day_window": event_day_window,
    "rolling_interval": rolling_interval,
    "merge_insert_only": merge_insert_only,
    "merge_insert_only_pruned": merge_insert_only_pruned,
    "merge_insert_only_gold": merge_insert_only_gold,
    "split_valid": split_valid,
    "replace_days": replace_days,
    "silver_batch": silver_batch,
    "gold_from_silver": gold_from_silver,
    "tag_ingestion": tag_ingestion,
    "landed_counts": landed_counts,
    "flatten_payload": flatten_payload,
    "landing_roundtrip": landing_roundtrip,
    "history_csv_roundtrip": history_csv_roundtrip,
    "bronze_rerun_idempotent": bronze_rerun_idempotent,
    "bronze_window": bronze_window,
    "conform_readings_listed": conform_readings_listed,
    "jobs_bronze_to_gold": jobs_bronze_to_gold,
    "jobs_silver_twice": jobs_silver_twice,
    "silver_window": silver_window,
    "bronze_window_table": bronze_window_table,
    "jobs_landing_counts": jobs_landing_counts,
    "jobs_landing_to_bronze": jobs_landing_to_bronze,
    "jobs_history": jobs_history,
    "jobs_gold_replace_days": jobs_gold_replace_days,
    "canonical_station_as_of": canonical_station_as_of,
    "flatten_drifting_payload": flatten_drifting_payload,
    "tag_ingestion_today": tag_ingestion_today,
    "daily_extremes_sql": daily_extremes_sql,
    "jobs_silver_bucketed": jobs_silver_bucketed,
    "jobs_changed_days": jobs_changed_days,
    "jobs_incremental": jobs_incremental,
    "jobs_rejected": jobs_rejected,
}


def queries() -> dict[str, Query]:
    """Every registered query by name."""
    return dict(_QUERIES)
