"""The jobs of the pipeline: landing, bronze, silver, gold.

Each takes a session and a configuration and does its own I/O. A job that died half-way is
simply run again. Two things are not idempotent: history appended twice is there twice, and
without a quarantine rows with a NULL key are inserted again at every run, as no key matches
them. With a ledger, history is loaded once. One writer per table is assumed.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stationlake.config import PipelineConfig
from stationlake.functions import day_key
from stationlake.operators.checks import observe_readings, observed_counts
from stationlake.operators.conform import (
    API,
    HISTORY,
    Parameters,
    Stations,
    conform_readings,
    filter_polluted_id,
    tag_ingestion,
)
from stationlake.operators.dedupe import READING, dedupe_readings
from stationlake.operators.extremes import daily_extremes
from stationlake.operators.landing import flatten_payload, landed_counts
from stationlake.operators.merge import days_met, merge_insert_only, split_valid
from stationlake.operators.windows import (
    event_day_window,
    first_day,
    ingestion_window,
    rolling_interval,
)
from stationlake.schemas import (
    BRONZE_COLUMNS,
    GOLD_KEYS,
    READING_KEYS,
    SILVER,
    SILVER_COLUMNS,
    gold_schema,
)
from stationlake.sources import (
    append_bucketed,
    append_days,
    append_history,
    changed_days,
    merge_catalog_table,
    new_files,
    overwrite_days,
    read_bronze_window,
    read_history_records,
    read_landing,
    read_landing_records,
    read_payload,
    read_silver_window,
    read_table,
    record_days,
    record_files,
    record_taken,
    register_partition,
    replace_catalog_window,
    replace_window,
    set_aside,
    split_records,
    write_bronze_day,
    write_landing,
)
from stationlake.sources.dims import PARAMETERS, STATIONS


def _use_zone(spark: SparkSession, cfg: PipelineConfig) -> None:
    spark.conf.set("spark.sql.session.timeZone", cfg.timezone)


def run_landing(spark: SparkSession, cfg: PipelineConfig) -> DataFrame:
    """Flatten the payloads of the rolling interval into the day's landing directory.

    Only the configured stations are landed, if any are. Readings without a time are landed
    too. Returns the number of rows per station that the run has written, as observed while
    writing them.
    """
    return land(spark, cfg)[0]


def land(spark: SparkSession, cfg: PipelineConfig) -> tuple[DataFrame, dict]:
    """``run_landing`` with the other checks of ``observe_readings``."""
    _use_zone(spark, cfg)
    payload = read_payload(spark, cfg.payload_path)
    if cfg.location_ids:
        payload = payload.where(F.col("id").isin(*cfg.location_ids))
    flat = flatten_payload(payload).withColumn("_at", F.col("datetime").try_cast("timestamp"))
    rows = rolling_interval(flat, cfg.local_run_at, cfg.days_back, "_at", keep_null=True)
    seen: list[Observation] = []

    def check(written: DataFrame) -> DataFrame:
        observed, observation = observe_readings(written, STATIONS)
        seen.append(observation)
        return observed

    write_landing(rows, cfg.landing_path, cfg.run_date, check=check)
    counts = observed_counts(spark, seen[0])
    if counts is None:  # more stations than the check tells apart
        counts = landed_counts(read_landing(spark, cfg.landing_path, cfg.run_date))
    return counts, {k: v for k, v in seen[0].get.items() if k != "stations"}


def _accepted(records: DataFrame, cfg: PipelineConfig, source: str) -> DataFrame:
    """The rows that fit the schema; rejected records go to the quarantine, if there is one."""
    good, rejected = split_records(records)
    if cfg.quarantine_path:
        set_aside(rejected, f"{cfg.quarantine_path.rstrip('/')}/{source}", cfg.run_date)
    return good


def run_bronze_daily(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Type and tag the day's landing, replacing that day in bronze.

    Records that do not fit the schema go to the quarantine and never become rows of NULLs.
    """
    _use_zone(spark, cfg)
    landed = _accepted(
        read_landing_records(spark, cfg.landing_path, cfg.run_date), cfg, "landing"
    )
    write_bronze_day(tag_ingestion(landed, API, cfg.run_date), cfg.bronze_path)
    if cfg.bronze_table:
        register_partition(spark, cfg.bronze_table, cfg.run_date, API)


def run_bronze_history(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Append the history files to bronze under the run date.

    With a ledger, files that were loaded before, under whatever name, are passed over. (A run
    that dies between the append and its entry loads its files again; silver drops the repeats.)
    Rejected records go to the quarantine.
    """
    _use_zone(spark, cfg)
    path: str | list[str] = cfg.history_path
    if cfg.ledger_path:
        # a name per file; the rows of the files stay where they are
        files = new_files(spark, cfg.history_path, cfg.ledger_path).collect()
        if not files:
            return
        path = sorted(f.file for f in files)
    history = _accepted(read_history_records(spark, path), cfg, "history")
    append_history(tag_ingestion(history, HISTORY, cfg.run_date), cfg.bronze_path)
    if cfg.ledger_path:
        loaded = spark.createDataFrame([tuple(f) for f in files], "file string, fingerprint string")
        record_files(loaded, cfg.ledger_path, cfg.run_date)
    if cfg.bronze_table:
        register_partition(spark, cfg.bronze_table, cfg.run_date, HISTORY)


def silver_batch(
    bronze: DataFrame,
    cfg: PipelineConfig,
    stations: Stations = STATIONS,
    parameters: Parameters = PARAMETERS,
) -> DataFrame:
    """Bronze rows as silver rows: foreign site out, one row per reading, canonical names.

    The filter comes before the dedupe; otherwise a foreign row could stand for a reading and
    then be filtered out with it.
    """
    own = filter_polluted_id(bronze, cfg.polluted_id, cfg.polluted_keep)
    return conform_readings(
        dedupe_readings(own), stations, parameters, normalise=cfg.normalise_parameter
    )


def gold_batch(silver: DataFrame, cfg: PipelineConfig) -> DataFrame:
    """Silver rows as gold rows."""
    return daily_extremes(silver, k=cfg.k)


def _set_aside(
    rows: DataFrame,
    keys: list[str],
    batch: Callable[[DataFrame], DataFrame],
    layer: str,
    cfg: PipelineConfig,
) -> DataFrame:
    """The batch made from ``rows``, less those with an incomplete key if there is a quarantine.

    The input is split, not the batch, so neither part computes the other.
    """
    if not cfg.quarantine_path:
        return batch(rows)
    valid, rejected = split_valid(rows, keys)
    set_aside(batch(rejected), f"{cfg.quarantine_path.rstrip('/')}/{layer}", cfg.run_date)
    return batch(valid)


def run_silver(
    spark: SparkSession,
    cfg: PipelineConfig,
    stations: Stations = STATIONS,
    parameters: Parameters = PARAMETERS,
) -> None:
    """Merge the ingestion window of bronze into silver. The first write of a reading stays."""
    _use_zone(spark, cfg)
    if cfg.bronze_table:
        bronze = spark.table(cfg.bronze_table).select(*BRONZE_COLUMNS)
        bronze = ingestion_window(bronze, cfg.run_date, cfg.silver_days)
    else:
        bronze = read_bronze_window(spark, cfg.bronze_path, cfg.run_date, cfg.silver_days)
    batch = _set_aside(
        bronze, READING, lambda rows: silver_batch(rows, cfg, stations, parameters), "silver", cfg
    )
    if cfg.silver_table:
        merge_catalog_table(batch, cfg.silver_table, READING_KEYS)
        return
    if not cfg.silver_bucketed:
        target = read_table(spark, cfg.silver_path, SILVER)
    elif spark.catalog.tableExists(cfg.silver_bucketed):
        target = spark.table(cfg.silver_bucketed).select(*SILVER_COLUMNS)
    else:
        target = spark.createDataFrame([], SILVER)
    met = days_met(bronze, day_key("datetime"))
    if met is not None:
        target = target.where(met)
    read = bronze.select(F.col("sensors_id").alias("id_sensor"), F.col("datetime").alias("data_hora"))
    fresh = merge_insert_only(target, batch, READING_KEYS, read)
    if cfg.silver_bucketed:
        append_bucketed(fresh, cfg.silver_bucketed, READING_KEYS, cfg.silver_buckets)
        return
    if not cfg.ledger_path:
        append_days(fresh, cfg.silver_path, order=READING_KEYS)
        return
    # all days of the batch until the append is done, then those that it has touched
    run = f"{cfg.local_run_at:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"
    record_days(spark, cfg.ledger_path, run, _days_of(bronze))
    touched = Observation()
    days = F.collect_set("anomesdia").alias("days")  # a number per calendar day
    append_days(fresh, cfg.silver_path, order=READING_KEYS, check=lambda df: df.observe(touched, days))
    record_days(spark, cfg.ledger_path, run, touched.get["days"])


def _days_of(bronze: DataFrame) -> list[int]:
    """The event days of some rows, a number per calendar day."""
    days = bronze.select(day_key("datetime").alias("d")).where("d IS NOT NULL").distinct()
    return sorted(r.d for r in days.collect())


def _run_changed_days(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Recompute the days that silver runs have touched since gold last ran, however old.

    A run that dies takes up the same silver runs again.
    """
    runs, days = changed_days(spark, cfg.ledger_path)
    if days:
        silver = read_silver_window(spark, cfg.silver_path, cfg.run_date, 0)
        changed = silver.where(F.col("anomesdia").isin(*days))
        overwrite_days(gold_batch(changed, cfg), cfg.gold_path, order=["id_sensor"])
    record_taken(spark, cfg.ledger_path, runs)


def run_gold(spark: SparkSession, cfg: PipelineConfig) -> None:
    """Bring the extremes of the event window into gold.

    ``insert_only`` keeps the first version of a day, also if readings arrive later;
    ``replace_days`` makes gold's days of the window those of silver, and drops the others;
    ``changed_days`` recomputes just the days that silver has touched, in or out of the window.
    """
    _use_zone(spark, cfg)
    if cfg.gold_mode == "changed_days":
        _run_changed_days(spark, cfg)
        return

    def window(rows: DataFrame) -> DataFrame:
        return event_day_window(rows, cfg.run_date, cfg.gold_days)

    if cfg.silver_table or cfg.silver_bucketed:
        silver = window(spark.table(cfg.silver_table or cfg.silver_bucketed))
    else:
        silver = read_silver_window(spark, cfg.silver_path, cfg.run_date, cfg.gold_days)
    batch = _set_aside(silver, GOLD_KEYS, lambda rows: gold_batch(rows, cfg), "gold", cfg)
    if cfg.gold_mode == "replace_days":
        if cfg.gold_table:
            start = first_day(cfg.run_date, cfg.gold_days)
            number = None if start is None else int(start.strftime("%Y%m%d"))
            replace_catalog_window(batch, cfg.gold_table, number)
        else:
            schema = gold_schema(cfg.k)
            replace_window(batch, cfg.gold_path, window, schema, order=["id_sensor"])
        return
    if cfg.gold_table:
        merge_catalog_table(batch, cfg.gold_table, GOLD_KEYS)
        return
    # the batch lies in the window, so no other day of gold can hold its keys
    target = window(read_table(spark, cfg.gold_path, gold_schema(cfg.k)))
    fresh = merge_insert_only(target, batch, GOLD_KEYS, silver.select(*GOLD_KEYS))
    append_days(fresh, cfg.gold_path, order=["id_sensor"])
