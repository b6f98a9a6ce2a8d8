"""Bronze and silver brought up to date by what has arrived in the landing since the last run."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.config import PipelineConfig
from stationlake.operators.conform import Parameters, Stations
from stationlake.plans import jobs
from stationlake.sources.dims import PARAMETERS, STATIONS

FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"
DAY = r"ingestion_date=(\d{4}-\d{2}-\d{2})"


def landed_files(spark: SparkSession, landing_path: str, at_a_time: int | None = None) -> DataFrame:
    """A stream of ``ingestion_date`` of every file that is landed; contents are not read."""
    reader = spark.readStream.format("binaryFile").schema(FILES)
    reader = reader.option("recursiveFileLookup", "true")
    if at_a_time:
        reader = reader.option("maxFilesPerTrigger", at_a_time)
    day = F.regexp_extract("path", DAY, 1)
    return reader.load(landing_path).select(F.to_date(F.nullif(day, F.lit(""))).alias("day"))


def bring_day(
    spark: SparkSession,
    cfg: PipelineConfig,
    day: date,
    stations: Stations = STATIONS,
    parameters: Parameters = PARAMETERS,
) -> None:
    """The bronze and silver jobs of one ingestion day, whenever that was."""
    own = replace(cfg, run_at=datetime.combine(day, time(12)), silver_days=1)
    jobs.run_bronze_daily(spark, own)
    jobs.run_silver(spark, own, stations, parameters)


def run_incremental(
    spark: SparkSession,
    cfg: PipelineConfig,
    checkpoint: str,
    stations: Stations = STATIONS,
    parameters: Parameters = PARAMETERS,
    at_a_time: int | None = None,
    bring: Callable = bring_day,
) -> None:
    """Bring all ingestion days with new files into bronze and silver, and stop.

    A stream of landed files, with its progress in ``checkpoint``, tells which days have changed,
    be it the current one or one that files came late for. Each of these days is read whole, so
    that any split of its files gives the same rows: bronze replaces the day, and silver's merge
    inserts what it does not hold, earlier days first. Both may run again, so a run that dies
    between two batches, or within one, goes on from the last batch that was done. Event days
    that this touches are in the ledger, if there is one, for gold's ``changed_days``.
    """

    def bring_days(files: DataFrame, batch: int) -> None:
        # one row per ingestion day
        days = files.where("day IS NOT NULL").distinct().collect()
        for day in sorted(r.day for r in days):
            bring(spark, cfg, day, stations, parameters)

    query = (
        landed_files(spark, cfg.landing_path, at_a_time)
        .writeStream.foreachBatch(bring_days)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def run_incremental_job(spark: SparkSession, cfg: PipelineConfig) -> None:
    """``run_incremental`` with its progress beside the other ledgers."""
    if not cfg.ledger_path:
        raise ValueError("incremental takes a ledger_path")
    run_incremental(spark, cfg, f"{cfg.ledger_path.rstrip('/')}/incremental")
