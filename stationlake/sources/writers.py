"""Writes. Files are sized by rebalancing, which also splits a day or station that is too big."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.schemas import BRONZE_COLUMNS, LANDING_COLUMNS
from stationlake.session import discard, materialise
from stationlake.sources.readers import read_table

# the default JSON format would cut timestamps to milliseconds
MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"

# bronze is split by origin below the day, so that replacing a day of API rows cannot remove
# history that was loaded on the same day
BRONZE_PARTITIONS = ["data_ingestao", "tipo_ingestao"]


def _replace_partitions(df: DataFrame, path: str, partitions: list[str]) -> None:
    """Overwrite the partitions present in ``df``; an empty input replaces nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(path)
    )


def write_landing(
    df: DataFrame,
    path: str,
    day: date | str,
    max_records_per_file: int = 5_000_000,
    check: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Gzipped NDJSON below ``ingestion_date=<day>/station=<id>/``.

    A station has one file unless it is large: gzip cannot be split on reading, so big stations
    are cut into several. Stations without rows keep what they had. ``check`` may observe the
    rows as they are written.
    """
    rows = df.select(
        *LANDING_COLUMNS,
        F.lit(str(day)).alias("ingestion_date"),
        F.col("location_id").alias("station"),
    ).hint("rebalance", F.col("station"))
    (
        check(rows)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .option("ignoreNullFields", "false")
        .option("timestampFormat", MICROS + "XXX")
        .option("timestampNTZFormat", MICROS)
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("ingestion_date", "station")
        .json(path)
    )


def _bronze_files(df: DataFrame) -> DataFrame:
    return df.select(*BRONZE_COLUMNS).hint("rebalance", *map(F.col, BRONZE_PARTITIONS))


def write_bronze_day(df: DataFrame, path: str) -> None:
    """Replace the days present in ``df``: running a day again leaves one copy of it."""
    _replace_partitions(_bronze_files(df), path, BRONZE_PARTITIONS)


def append_history(df: DataFrame, path: str) -> None:
    """Add a history load. Appending the same load again adds it again."""
    _bronze_files(df).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)


def set_aside(rows: DataFrame, path: str, run_date: date) -> None:
    """Replace what a run put into a quarantine; without rows nothing of that run remains."""
    remove_partitions(rows.sparkSession, path, "run_date", [run_date])
    overwrite_days(rows.withColumn("run_date", F.lit(run_date)), path, "run_date")


def register_partition(spark: SparkSession, table: str, day: date | str, kind: str) -> None:
    """Tell the catalog about a partition written by path; harmless if it is known already."""
    day = date.fromisoformat(str(day))
    spark.sql(
        f"ALTER TABLE {table} ADD IF NOT EXISTS "
        f"PARTITION (data_ingestao = '{day}', tipo_ingestao = '{kind}')"
    )


def _by_day(df: DataFrame, day: str, order: Sequence[str]) -> DataFrame:
    """Sized for one directory per day, rows of a file in ``order``.

    The writer sorts by day anyway, so the order costs no further sort. Files in sensor order
    compress better, and the ranking by sensor finds its input nearly sorted.
    """
    return df.hint("rebalance", F.col(day)).sortWithinPartitions(day, *order)


def append_days(
    df: DataFrame,
    path: str,
    day: str = "anomesdia",
    order: Sequence[str] = (),
    check: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> None:
    """Append to a table partitioned by day; ``check`` may observe the rows as they are written."""
    check(_by_day(df, day, order)).write.mode("append").partitionBy(day).parquet(path)


def append_bucketed(
    df: DataFrame, table: str, keys: Sequence[str], buckets: int, day: str = "anomesdia"
) -> None:
    """Append to a catalog table of files, partitioned by day and bucketed by ``keys``.

    A join of the table on ``keys`` needs no shuffle of the table. Each day has a file per bucket
    and append; ``buckets`` follow the rows of a day's largest batch. The table is made by the
    first append.
    """
    (
        df.repartition(buckets, *map(F.col, keys))
        .write.mode("append")
        .format("parquet")
        .partitionBy(day)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def merge_catalog_table(
    df: DataFrame, table: str, keys: list[str], day: str = "anomesdia"
) -> None:
    """Insert-only merge into a catalog table whose format supports row-level changes.

    The day is part of the condition only so that the format can skip files without the batch's
    days. Spark's own file tables do not support this; use ``merge_insert_only`` for them. No
    such format is installed here: only what is handed over has been tested, the merge has not.
    """
    target = table.split(".")[-1]
    same = " AND ".join(f"{target}.{key} = source.{key}" for key in dict.fromkeys([day, *keys]))
    df.alias("source").mergeInto(table, F.expr(same)).whenNotMatched().insertAll().merge()


def overwrite_days(
    df: DataFrame, path: str, day: str = "anomesdia", order: Sequence[str] = ()
) -> None:
    """Replace the days present in ``df``. ``df`` must not read from ``path``."""
    _replace_partitions(_by_day(df, day, order), path, [day])


def remove_partitions(spark: SparkSession, path: str, column: str, values: Sequence) -> None:
    """Delete partitions of a table of files; those that are not there are passed over."""
    context = spark.sparkContext
    for value in values:
        folder = context._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{column}={value}")
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def replace_window(
    df: DataFrame,
    path: str,
    inside: Callable[[DataFrame], DataFrame],
    schema: str,
    day: str = "anomesdia",
    order: Sequence[str] = (),
) -> None:
    """Make the days of a window those of ``df``; days that ``df`` lacks go.

    ``inside`` keeps a table's rows of the window. New days are in place before old ones go.
    """
    spark = df.sparkSession
    rows = materialise(df)
    days = {r[0] for r in rows.select(day).distinct().collect()}
    stored = inside(read_table(spark, path, schema)).where(F.col(day).isNotNull())
    gone = {r[0] for r in stored.select(day).distinct().collect()} - days
    overwrite_days(rows, path, day, order)
    remove_partitions(spark, path, day, sorted(gone))
    discard(rows)


def replace_catalog_window(
    df: DataFrame, table: str, start: int | None, day: str = "anomesdia"
) -> None:
    """The same for a catalog table: days from ``start`` on (all, if None) become those of ``df``.

    One overwrite by condition, which a format with row-level changes does in one commit. As
    with ``merge_catalog_table``, only what is handed over has been tested.
    """
    inside = F.lit(True) if start is None else F.col(day) >= start
    df.writeTo(table).overwrite(inside)
